from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablelift.operators import catalog as cat
from tablelift.plans import chunks


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


COLS = (
    "owner string, table_name string, column_name string, data_type string, column_id int, "
    "nullable string, data_precision int, data_scale int, char_length int, char_used string, "
    "data_type_owner string, hidden_column string"
)


def column(table, name, ordinal, kind="NUMBER", owner=None, hidden="NO", used=None):
    return ("HR", table, name, kind, ordinal, "Y", 10, 0, 20, used, owner, hidden)


@pytest.fixture
def catalog(spark):
    key = "owner string, table_name string"
    return {
        "tables": frame(
            spark, f"{key}, num_rows int, avg_row_len int, temporary string",
            ("HR", "EMP", 100, 50, "N"), ("HR", "TMP", None, None, "Y"), ("HR", "BIG", 7, 3, None),
        ),
        "tab_cols": frame(
            spark, COLS,
            column("EMP", "NAME", 2, "VARCHAR2"), column("EMP", "ID", 1),
            column("EMP", "SYS_1", None), column("EMP", "HID", 3, hidden="YES"),
            column("BIG", "A", 1),
        ),
        "col_comments": frame(
            spark, f"{key}, column_name string, comments string", ("HR", "EMP", "ID", "key")
        ),
        "tab_comments": frame(spark, f"{key}, comments string", ("HR", "EMP", "people")),
        "external_tables": frame(spark, key, ("HR", "FEED")),
        "tab_partitions": frame(
            spark,
            "table_owner string, table_name string, partition_name string, partition_position int",
            ("HR", "EMP", "P2", 2), ("HR", "EMP", "P1", 1),
        ),
        "tab_subpartitions": frame(
            spark,
            "table_owner string, table_name string, partition_name string, "
            "subpartition_name string, subpartition_position int",
            ("HR", "EMP", "P1", "S2", 2), ("HR", "EMP", "P1", "S1", 1),
        ),
        "constraints": frame(
            spark, f"{key}, constraint_name string, constraint_type string",
            ("HR", "EMP", "PK", "P"), ("HR", "EMP", "U2", "U"), ("HR", "EMP", "U1", "U"),
            ("HR", "EMP", "FK", "R"),
        ),
        "cons_columns": frame(
            spark, "owner string, constraint_name string, column_name string, position int",
            ("HR", "PK", "B", 2), ("HR", "PK", "A", 1), ("HR", "U1", "X", 1), ("HR", "U2", "Z", 2),
            ("HR", "U2", "Y", 1), ("HR", "FK", "Q", 1),
        ),
        "segments": frame(
            spark, "owner string, segment_name string, bytes bigint",
            ("HR", "EMP", 10), ("HR", "EMP", 20),
        ),
    }


def test_manifest(catalog):
    rows = {r["name"]: r for r in cat.inspect_catalog(**catalog).collect()}
    emp = rows["EMP"]
    assert [(c["ordinal"], c["name"], c["comment"]) for c in emp["columns"]] == [
        (1, "ID", "key"), (2, "NAME", None),
    ]
    assert (emp["estimated_bytes"], emp["row_count"], emp["comment"]) == (30, 100, "people")
    assert emp["primary_key"] == ["A", "B"]
    assert emp["unique_keys"] == [["X"], ["Y", "Z"]]
    assert [(p["name"], [s["name"] for s in p["subpartitions"]]) for p in emp["partitions"]] == [
        ("P1", ["S1", "S2"]), ("P2", []),
    ]
    assert {n: r["table_type"] for n, r in rows.items()} == {
        "EMP": "TABLE", "TMP": "GTT", "BIG": "TABLE", "FEED": "EXTERNAL",
    }
    assert rows["BIG"]["estimated_bytes"] == 21
    assert rows["BIG"]["partitions"] == []
    assert rows["BIG"]["unique_keys"] == []


def test_without_segments_only_statistics_count(catalog):
    catalog = {**catalog, "segments": None}
    rows = {r["name"]: r["estimated_bytes"] for r in cat.inspect_catalog(**catalog).collect()}
    assert rows == {"EMP": 5000, "TMP": None, "BIG": 21, "FEED": None}


def test_plan_of_manifest(catalog):
    plan = chunks.plan_chunks(*chunks.manifest_frames(cat.inspect_catalog(**catalog)))
    got = {(r["table"], r["chunk"]): (r["strategy"], r["reason"]) for r in plan.collect()}
    assert got == {
        ("EMP", "subpartition-00001-00001-P1-S1"): ("partition", None),
        ("EMP", "subpartition-00001-00002-P1-S2"): ("partition", None),
        ("EMP", "partition-00002-P2"): ("partition", None),
        ("BIG", "whole"): ("whole_table", None),
        ("TMP", None): ("unsupported", chunks.TEMPORARY_REASON),
        ("FEED", None): ("unsupported", chunks.EXTERNAL_REASON),
    }


def plan_one(spark, *, columns=(), table_type="TABLE", parts=0, strategy=None):
    tables = frame(spark, "schema string, table string, table_type string", ("S", "T", table_type))
    cols = frame(
        spark,
        "schema string, table string, column_name string, data_type string, "
        "data_type_owner string, ordinal int",
        *(("S", "T", n, k, o, i) for i, (n, k, o) in enumerate(columns)),
    ) if columns else spark.createDataFrame(
        [], "schema string, table string, column_name string, data_type string, "
        "data_type_owner string, ordinal int")
    ps = spark.createDataFrame(
        [("S", "T", f"P{i}", i) for i in range(1, parts + 1)],
        "schema string, table string, partition_name string, partition_position int",
    )
    subs = spark.createDataFrame(
        [], "schema string, table string, partition_name string, subpartition_name string, "
        "subpartition_position int")
    over = None
    if strategy:
        over = frame(spark, "key string, strategy string", ("S.T", strategy))
    rows = chunks.plan_chunks(tables, cols, ps, subs, over).collect()
    return [(r["strategy"], r["chunk"], r["reason"]) for r in rows]


def test_whole_override_beats_partitions(spark):
    assert plan_one(spark, parts=3, strategy="whole") == [("whole_table", "whole", None)]


def test_other_override_is_unsupported(spark):
    ((strategy, chunk, reason),) = plan_one(spark, parts=3, strategy="range")
    assert (strategy, chunk) == ("unsupported", None)
    assert reason == (
        "strategy 'range' is not supported; use 'whole' to override the default strategy "
        "for this table"
    )


def test_whole_override_never_saves_an_unsupported_table(spark):
    ((strategy, _, reason),) = plan_one(
        spark, columns=[("OK", "NUMBER", None), ("F", "BFILE", None)], strategy="whole"
    )
    assert (strategy, reason) == ("unsupported", "column 'F' has unsupported type BFILE")


def test_first_bad_column_gives_the_reason(spark):
    columns = [("X", "XMLTYPE", "PUBLIC"), ("G", "SDO_GEOMETRY", "MDSYS"), ("it's", "T_A", "HR"),
               ("F", "BFILE", None)]
    ((_, _, reason),) = plan_one(spark, columns=columns)
    assert reason == "column \"it's\" has user-defined type HR.T_A"


def test_external_reason_comes_before_columns(spark):
    ((_, _, reason),) = plan_one(spark, columns=[("F", "BFILE", None)], table_type="EXTERNAL")
    assert reason == chunks.EXTERNAL_REASON


def test_existing_only_and_missing_schemas(spark):
    plan = frame(spark, "schema string, table string, strategy string",
                 ("A", "T", "whole_table"), ("A", "U", "whole_table"), ("B", "V", "whole_table"),
                 ("C", "W", "unsupported"))
    there = frame(spark, "schema string, table string", ("A", "T"))
    present, missing = chunks.existing_only(plan, there)
    assert [r["table"] for r in present.collect()] == ["T"]
    assert {r["table"] for r in missing.collect()} == {"U", "V", "W"}
    assert [r[0] for r in chunks.missing_schemas(plan, there).collect()] == ["B"]


def test_byte_columns_exclusions(spark):
    key = "owner string, table_name string"
    names = ["PLAIN", "VIRT", "PKEY", "SKEY", "CHARS"]
    cols = frame(spark, COLS, *(
        column("T", n, i, "VARCHAR2", used="C" if n == "CHARS" else "B")
        for i, n in enumerate(names)), column("EXT", "A", 1, "CHAR", used="B"),
        column("GTT", "A", 1, "CHAR", used="B"))
    tables = frame(spark, f"{key}, temporary string", ("HR", "T", None), ("HR", "EXT", "N"),
                   ("HR", "GTT", "Y"))
    one = lambda n: frame(spark, f"{key}, column_name string", ("HR", "T", n))
    got = cat.byte_columns(cols, tables, frame(spark, key, ("HR", "EXT")), one("VIRT"),
                           one("PKEY"), one("SKEY"))
    assert [r["column_name"] for r in got.collect()] == ["PLAIN"]


def test_audit_counts_bytes_and_characters(spark):
    df = frame(spark, "a string", ("ab",), ("éé",), (None,), ("abcd",))
    row = cat.byte_char_audit(df, {"a": 3}).first()
    assert (row["max_bytes"], row["max_chars"], row["multibyte_rows"]) == (4, 4, 1)
    assert (row["rows_over_bytes"], row["rows_over_chars"], row["needs_widening"]) == (2, 1, True)


def test_user_schemas(spark):
    df = frame(spark, "s string", ("sys",), ("XS$NULL",), ("HR",), ("System",))
    assert [r[0] for r in df.where(cat.is_user_schema(F.col("s"))).collect()] == ["HR"]
