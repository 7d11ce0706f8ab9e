"""The declared contract of one table: columns, keys, load strategy, reader options, rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidegate.functions.names import clean_label, clean_major_label, key_list
from tidegate.operators.quality import Accepted, NotNull, References, Rule, Unique, Where

# The load strategies a contract may name.
STRATEGIES = ("merge_date_rows", "merge_update", "merge_insert", "insert", "replace")


class ContractError(ValueError):
    """A contract, or a file measured against it, is not usable."""


@dataclass(frozen=True)
class TableContract:
    source: str
    table: str
    columns: T.StructType
    keys: tuple[str, ...]
    strategy: str = "merge_update"
    options: Mapping[str, object] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    # Pre-processing of the raw rows, and a per-file condition to go on at all.
    preprocess: Callable[[DataFrame], DataFrame] | None = None
    proceed: Column | None = None
    # What a file that omits a column does to rows it updates: "null" or "keep".
    absent: str = "null"
    on_duplicate: str = "all"
    # Key columns the table is partitioned by. Since they are part of the key, a merge
    # touches only partitions that the incoming rows name, and rewrites only those.
    partition_by: tuple[str, ...] = ()
    # What a replace takes as one delivery, the last of which stays: a "file", or the part files of a "folder".
    delivery: str = "file"

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(key_list(self.keys)))
        problems = self.problems()
        if problems:
            raise ContractError("; ".join(problems))

    def problems(self) -> list[str]:
        found = []
        for label in (self.source, self.table):
            if label != clean_major_label(label):
                found.append(f"name {label!r} is not usable, try {clean_major_label(label)!r}")
        if self.strategy not in STRATEGIES:
            found.append(f"unknown strategy {self.strategy!r}, expected one of {STRATEGIES}")
        names = [clean_label(f.name) for f in self.columns.fields]
        missing = [k for k in self.keys if k not in names]
        if missing:
            found.append(f"key columns {missing} are not among the columns {names}")
        reserved = [n for n in names if n.startswith("_")]
        if reserved:
            found.append(f"columns {reserved} start with _, which is kept for engine columns")
        lowered = [n.lower() for n in names]
        twice = sorted({n for n in lowered if lowered.count(n) > 1})
        if twice:
            found.append(f"columns {twice} appear more than once (case is ignored)")
        stray = [p for p in self.partition_by if p not in self.keys]
        if stray:
            found.append(f"partition columns {stray} must be key columns")
        if self.absent not in ("null", "keep"):
            found.append(f"absent must be 'null' or 'keep', not {self.absent!r}")
        if self.delivery not in ("file", "folder"):
            found.append(f"delivery must be 'file' or 'folder', not {self.delivery!r}")
        if self.absent == "keep" and self.format == "json":
            found.append("absent='keep' needs a header: JSON rows do not tell which columns a file lacks")
        return found

    def check(self, spark: SparkSession) -> None:
        """Refuse row rules that do not parse, name unknown columns or are no conditions; no file is read for it."""
        empty, found = spark.createDataFrame([], self.schema), []
        for rule in self.rules:
            try:
                if isinstance(rule, Where) and empty.selectExpr(rule.predicate).schema[0].dataType != T.BooleanType():
                    found.append(f"rule {rule.name!r} is no condition: {rule.predicate}")
            except (AnalysisException, ParseException) as error:
                found.append(f"rule {rule.name!r} cannot be used: {str(error).splitlines()[0]}")
        if found:
            raise ContractError("; ".join(found))

    @property
    def format(self) -> str:
        return "json" if self.options.get("type") == "json" else "csv"

    @property
    def reader_options(self) -> dict[str, object]:
        return {k: v for k, v in self.options.items() if k != "type"}

    @property
    def has_header(self) -> bool:
        return self.format == "csv" and str(self.options.get("header", "")).lower() == "true"

    @property
    def separator(self) -> str:
        return str(self.options.get("sep", ","))

    @property
    def raw_names(self) -> list[str]:
        return [f.name for f in self.columns.fields]

    @property
    def read_schema(self) -> T.StructType:
        """Raw names, every field nullable: bad text is NULL, not an error."""
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in self.columns.fields])

    @property
    def schema(self) -> T.StructType:
        """Clean names; staging and review tables are nullable throughout."""
        return T.StructType([T.StructField(clean_label(f.name), f.dataType, True) for f in self.columns.fields])

    @property
    def table_schema(self) -> T.StructType:
        """The loaded table: contract columns and the two lineage columns."""
        return T.StructType(
            [*self.schema.fields, T.StructField("_hash", T.IntegerType()), T.StructField("_datetime_added", T.TimestampType())]
        )

    @property
    def ddl(self) -> str:
        """Column list in SQL form; a not-null rule shows as NOT NULL."""
        firm = {r.column for r in self.rules if isinstance(r, NotNull)}
        return ", ".join(
            f"`{clean_label(f.name)}` {f.dataType.simpleString()}"
            + ("" if f.nullable and clean_label(f.name) not in firm else " NOT NULL")
            for f in self.columns.fields
        )

    @classmethod
    def from_mapping(
        cls, source: str, spec: Mapping, parents: Mapping[str, DataFrame] | None = None, **extra
    ) -> TableContract:
        """Build from the nested mapping form (name, join, file_details, columns with tests, tests of rows).

        A test of rows is {"expression": condition}, with a "name" if wanted, in the clean column names; as a
        column's test the condition goes on after the column, as in ">= 0". A row fails if it is false.
        """
        fields, rules = [], []
        for column in spec["columns"]:
            raw = column["name"].strip("`")
            data_type = T.StructType.fromDDL(f"c {column['data_type']}")[0].dataType
            fields.append(T.StructField(raw, data_type, column.get("nullable", True)))
            for test in column.get("tests", []):
                rules.append(_rule(clean_label(raw), test, parents or {}))
        rules += [_expression(test) for test in spec.get("tests", [])]
        join = spec.get("join", {})
        return cls(
            source=source,
            table=spec["name"],
            columns=T.StructType(fields),
            keys=join.get("column", ""),
            strategy=join.get("type", "insert"),
            options=dict(spec.get("file_details", {})),
            rules=tuple(rules),
            **extra,
        )


def _expression(test, column: str | None = None) -> Where:
    if not isinstance(test, Mapping) or not isinstance(test.get("expression"), str):
        raise ContractError(f"unknown test {test!r} of the table's rows")
    whole = test["expression"] if column is None else f"`{column}` {test['expression']}"
    return Where(test.get("name", f"expression({whole})"), f"NOT ({whole})")


def _rule(column: str, test, parents: Mapping[str, DataFrame]) -> Rule:
    if test == "not_null":
        return NotNull(column)
    if test == "unique":
        return Unique(column)
    if isinstance(test, Mapping) and "expression" in test:
        return _expression(test, column)
    if isinstance(test, Mapping) and "accepted_values" in test:
        return Accepted(column, tuple(test["accepted_values"]["values"]))
    if isinstance(test, Mapping) and "relationships" in test:
        link = test["relationships"]
        return References(column, parents[link["to"]], link["field"])
    raise ContractError(f"unknown test {test!r} on column {column!r}")
