import json
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import ContractError, TableContract
from tidegate.operators.quality import NotNull, quoted
from tidegate.sources.files import list_files, missing_files
from tidegate.sources.headers import audit, violations
from tidegate.sources.scan import FILE_NAME, proceeding, read_files, scan, stage_files, staged_rows

COLUMNS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open, high", T.DecimalType(18, 9)),
        T.StructField("is Good", T.BooleanType()),
    ]
)
OPTIONS = {"sep": ",", "header": True, "dateFormat": "yyyy-MM-dd"}


def contract(**changes):
    return TableContract("test_data", "table1", COLUMNS, **{"keys": ("date",), "options": OPTIONS, **changes})


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def values(df):
    return rows(df.select(F.date_format("date", "yyyy-MM-dd"), quoted("open_high").cast("string"), quoted("is_Good")))


def test_reordered_and_missing_columns(spark, tmp_path):
    write(tmp_path, "a.csv", 'date,"open, high",is Good\n2020-01-01,1.5,True\n2020-01-02,abc,\n')
    write(tmp_path, "b c+d.csv", '﻿is Good,date\r\nFalse,2020-01-03\r\n')
    write(tmp_path, "empty.csv", 'date,"open, high",is Good\n')
    frame, refused = read_files(spark, str(tmp_path), contract())
    assert values(frame) == rows(
        spark.createDataFrame(
            [("2020-01-01", "1.500000000", True), ("2020-01-02", None, None), ("2020-01-03", None, False)], "a string, b string, c boolean"
        )
    )
    assert refused.count() == 0
    assert {r[0] for r in frame.select(FILE_NAME).distinct().collect()} == {"a.csv", "b c+d.csv"}
    assert {r.file_name for r in list_files(spark, str(tmp_path)).collect()} == {"a.csv", "b c+d.csv", "empty.csv"}
    present = {tuple(r[0]) for r in frame.select("_present").distinct().collect()}
    assert present == {("date", "open_high", "is_Good"), ("is_Good", "date")}


def test_refused_files(spark, tmp_path):
    write(tmp_path, "good.csv", "date,is Good\n2020-01-01,True\n")
    write(tmp_path, "extra.csv", "date,volume\n2020-01-01,3\n")
    write(tmp_path, "nokey.csv", "is Good\nTrue\n")
    write(tmp_path, "twice.csv", "date,Date\n2020-01-01,2020-01-01\n")
    write(tmp_path, "blank.csv", "\n\n")
    with pytest.raises(ContractError, match="extra columns"):
        read_files(spark, str(tmp_path), contract())
    frame, refused = read_files(spark, str(tmp_path), contract(), "skip")
    assert frame.count() == 1
    found = {(r.path.rsplit("/", 1)[-1], r.reason, tuple(r.names)) for r in refused.collect()}
    assert found == {
        ("extra.csv", "extra columns", ("volume",)),
        ("nokey.csv", "key columns absent", ("date",)),
        ("blank.csv", "key columns absent", ("date",)),
        ("twice.csv", "extra columns", ("Date",)),
        ("twice.csv", "repeated columns", ("date",)),
    }


def test_a_header_the_schema_does_not_match_fails_the_scan(spark, tmp_path):
    write(tmp_path, "b.csv", 'is Good,date,"open, high"\nTrue,2020-01-01,1\n')
    with pytest.raises(Exception, match="(?i)header"):
        scan(spark, str(tmp_path), contract()).collect()


def test_other_separators_quotes_and_comments(spark, tmp_path):
    options = {**OPTIONS, "sep": "|", "quote": "'", "comment": "#"}
    write(tmp_path, "a.csv", "# made by hand\ndate|'open, high'|is Good\n2020-01-01|'2.5'|true\n")
    frame, _ = read_files(spark, str(tmp_path), contract(options=options))
    assert values(frame) == [("2020-01-01", "2.500000000", True)]
    write(tmp_path / "two", "a.csv", "date||is Good\n2020-01-01||true\n")
    frame, _ = read_files(spark, str(tmp_path / "two"), contract(options={**OPTIONS, "sep": "||"}))
    assert values(frame) == [("2020-01-01", None, True)]


def test_no_header(spark, tmp_path):
    write(tmp_path, "a.csv", "2020-01-01,1.5,True\n")
    frame, refused = read_files(spark, str(tmp_path), contract(options={"dateFormat": "yyyy-MM-dd"}))
    assert refused is None and values(frame) == [("2020-01-01", "1.500000000", True)]


def test_json_lines(spark, tmp_path):
    lines = [{"date": "2020-01-01", "open, high": 1.5, "is Good": True}, {"date": "2020-01-02", "other": 1}, {"open, high": "abc"}]
    write(tmp_path, "a.json", "\n".join(json.dumps(x) for x in lines))
    frame, refused = read_files(spark, str(tmp_path), contract(options={"type": "json", "dateFormat": "yyyy-MM-dd"}))
    assert refused is None and len(values(frame)) == 3
    assert ("2020-01-01", "1.500000000", True) in values(frame) and (None, None, None) in values(frame)


def test_staging(spark, tmp_path):
    write(tmp_path, "file1.csv", "date\n2020-01-01\n2020-01-02\n")
    doubled = contract(preprocess=lambda df: df.where("date > DATE'2020-01-01'"))
    staged = stage_files(spark, str(tmp_path), doubled)
    row = staged.first()
    assert staged.count() == 1 and row._hash == 1767481205 and row._increment == 0
    assert rows(stage_files(spark, str(tmp_path), doubled)) == rows(staged)


def test_files_that_may_not_proceed(spark, tmp_path):
    write(tmp_path, "a.csv", "date\n2020-01-01\n")
    write(tmp_path, "b.csv", "date\n2020-01-01\n2020-01-02\n")
    judged = contract(proceed=F.count(F.lit(1)) > 1)
    frame, _ = read_files(spark, str(tmp_path), judged)
    going, stopped = proceeding(staged_rows(frame, judged), judged)
    assert going.count() == 2 and rows(stopped) == [("a.csv",)]
    assert proceeding(going, contract())[1] is None


def test_audit_and_missing_files(spark, tmp_path):
    write(tmp_path, "a.csv", "date\n2020-01-01\n")
    files = list_files(spark, str(tmp_path))
    row = audit(files, contract()).first()
    assert row.absent == ["open, high", "is Good"] and not row.refused
    assert violations(audit(files, contract())).count() == 0
    claimed = spark.createDataFrame([("a.csv",), ("b.csv",)], "file_name string")
    assert rows(missing_files(claimed, files)) == [("b.csv",)]


def test_rule_on_cleaned_name(spark, tmp_path):
    assert "`is_Good` boolean NOT NULL" in contract(rules=(NotNull("is_Good"),)).ddl


def test_headers_as_written(spark, tmp_path):
    """Marks, comments, blank lines, quotes, empty names, odd file names; no Python worker reads them."""
    from tidegate.sources.headers import fields, headers

    write(tmp_path, "a +x%.csv", '﻿a,"b,c","d""e",\r\n1,2,3,4\r\n')
    write(tmp_path, "b[1].csv", "# note\n\n ,x,,y \n1,2\n")
    write(tmp_path, "c é.csv", "a\n")
    write(tmp_path, "d.csv", "\n\n")
    write(tmp_path, "e.csv", ",a\n")
    noted = contract(options={**OPTIONS, "comment": "#"})
    frame = headers(list_files(spark, str(tmp_path)), noted)
    got = {r.path.rsplit("/", 1)[-1]: r.header for r in frame.collect()}
    assert got == {
        "a +x%.csv": ["a", "b,c", 'd"e', ""], "b[1].csv": ["", "x", "", "y"], "c é.csv": ["a"], "d.csv": [], "e.csv": ["", "a"],
    }
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    lines = spark.createDataFrame([("a|'b|c'|d''",)], "l string")
    assert lines.select(fields(F.col("l"), "|", "'")).first()[0] == ["a", "b|c", "d''"]
    double = spark.createDataFrame([("a||b|c||d",)], "l string")
    assert double.select(fields(F.col("l"), "||", "'")).first()[0] == ["a", "b|c", "d"]


def test_unreadable_records_are_kept(spark, tmp_path):
    write(tmp_path, "a.csv", 'date,"open, high",is Good\n2020-01-01,abc,true\n2020-01-02,1.5,false\nx,y,z,too many\n')
    frame, _ = read_files(spark, str(tmp_path), contract())
    assert {r.date is None: r._record for r in frame.where("_record IS NOT NULL AND date IS NULL").collect()} == {True: "x,y,z,too many"}
    assert sorted(r._record or "" for r in frame.collect()) == ["", "2020-01-01,abc,true", "x,y,z,too many"]
    write(tmp_path / "j", "a.json", '{"date": "2020-01-01", "is Good": true}\n{"date": oops\n')
    frame, _ = read_files(spark, str(tmp_path / "j"), contract(options={"type": "json", "dateFormat": "yyyy-MM-dd"}))
    assert sorted(r._record or "" for r in frame.collect()) == ["", '{"date": oops']


def test_headers_are_read_as_text(spark, tmp_path, capsys):
    write(tmp_path, "a b+c.csv", '\t \n\u0000\n#a note\ndate,"open, high",is Good\n2020-01-01,1.5,True\n')
    write(tmp_path, "é%20.csv", "is Good,date\nTrue,2020-01-01\n")
    declared = contract(options={**OPTIONS, "comment": "#"})
    audited = audit(list_files(spark, str(tmp_path)), declared)
    found = {r.path.rsplit("/", 1)[-1]: (r.header, r.refused) for r in audited.collect()}
    assert found == {
        "a b+c.csv": (["date", "open, high", "is Good"], False),
        "é%20.csv": (["is Good", "date"], False),
    }
    capsys.readouterr()
    audited.explain("formatted")
    plan = capsys.readouterr().out
    assert "Scan text" in plan and "Scan csv" not in plan


def test_headers_in_other_encodings_are_decoded(spark, tmp_path):
    with open(tmp_path / "a.csv", "w", encoding="iso-8859-1") as f:
        f.write("date,Größe\n2020-01-01,1\n")
    declared = contract(options={**OPTIONS, "encoding": "ISO-8859-1"})
    audited = audit(list_files(spark, str(tmp_path)), declared)
    assert [r.header for r in audited.collect()] == [["date", "Größe"]]


def test_folder_of_a_file(spark, tmp_path):
    write(tmp_path / "in x%", "a+b %.csv", "date,is Good\n2020-01-01,True\n")
    frame, _ = read_files(spark, str(tmp_path / "in x%"), contract())
    row = frame.select(FILE_NAME, "_folder").first()
    assert row[0] == "a+b %.csv" and row[1].endswith("/in%20x%25")
