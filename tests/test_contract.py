import pytest
from pyspark.sql import types as T

from tidegate.contract import ContractError, TableContract
from tidegate.operators.quality import Accepted, NotNull, References, Unique

SPEC = {
    "name": "table0",
    "join": {"type": "merge_insert", "column": "date"},
    "file_details": {"sep": ",", "header": True, "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd HH:mm:ss"},
    "columns": [
        {"name": "date", "data_type": "date", "tests": ["unique", "not_null"]},
        {"name": "open", "data_type": "decimal(18,9)", "tests": ["not_null"]},
        {"name": "`is Good`", "data_type": "boolean"},
    ],
}


def test_from_mapping(spark):
    contract = TableContract.from_mapping("test_data", SPEC)
    assert contract.keys == ("date",)
    assert contract.strategy == "merge_insert"
    assert contract.rules == (Unique("date"), NotNull("date"), NotNull("open"))
    assert contract.has_header and contract.format == "csv"
    assert contract.raw_names == ["date", "open", "is Good"]
    assert contract.schema.fieldNames() == ["date", "open", "is_Good"]
    assert contract.ddl == "`date` date NOT NULL, `open` decimal(18,9) NOT NULL, `is_Good` boolean"
    assert contract.table_schema.fieldNames() == ["date", "open", "is_Good", "_hash", "_datetime_added"]
    assert all(f.nullable for f in contract.read_schema.fields)


def test_rules_with_values_and_parents(spark):
    parent = spark.range(3)
    spec = {
        "name": "t",
        "columns": [
            {"name": "a", "data_type": "int", "tests": [{"accepted_values": {"values": [1, 2]}}]},
            {"name": "b", "data_type": "bigint", "tests": [{"relationships": {"to": "parent", "field": "id"}}]},
        ],
    }
    contract = TableContract.from_mapping("s", spec, parents={"parent": parent})
    assert contract.rules[0] == Accepted("a", (1, 2))
    assert isinstance(contract.rules[1], References)
    assert contract.strategy == "insert" and contract.keys == ()
    with pytest.raises(ContractError, match="unknown test"):
        TableContract.from_mapping("s", {"name": "t", "columns": [{"name": "a", "data_type": "int", "tests": ["odd"]}]})


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"strategy": "merge_all"}, "unknown strategy"),
        ({"keys": ("b",)}, "key columns"),
        ({"table": "my table"}, "not usable"),
        ({"absent": "guess"}, "absent must be"),
        ({"partition_by": ("v",)}, "must be key columns"),
    ],
)
def test_unusable_contracts(changes, message):
    columns = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("v", T.StringType())])
    settings = {"source": "s", "table": "t", "columns": columns, "keys": ("a",), **changes}
    with pytest.raises(ContractError, match=message):
        TableContract(**settings)


def test_reserved_and_repeated_columns():
    for names, message in ((("_a",), "kept for engine"), (("a", "A"), "more than once")):
        columns = T.StructType([T.StructField(n, T.IntegerType()) for n in names])
        with pytest.raises(ContractError, match=message):
            TableContract("s", "t", columns, keys=(names[0],))


def test_row_expressions(spark):
    from tidegate.contract import ContractError

    def declared(*tests, column=()):
        columns = [{"name": "a b", "data_type": "int", "tests": list(column)}, {"name": "c", "data_type": "string"}]
        return TableContract.from_mapping("s", {"name": "t", "columns": columns, "tests": list(tests)})

    good = declared({"expression": "a_b > 1 OR c = 'x'", "name": "n"}, column=[{"expression": "BETWEEN 0 AND 9"}])
    good.check(spark)
    assert [(r.name, r.predicate) for r in good.rules] == [
        ("expression(`a_b` BETWEEN 0 AND 9)", "NOT (`a_b` BETWEEN 0 AND 9)"), ("n", "NOT (a_b > 1 OR c = 'x')"),
    ]
    for bad in ("nowhere > 1", "a_b >", "a_b + 1"):
        with pytest.raises(ContractError):
            declared({"expression": bad}).check(spark)
    with pytest.raises(ContractError):
        declared({"where": "a_b > 1"})
