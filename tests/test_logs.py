from __future__ import annotations

import random

from pyspark.sql import functions as F

from tablelift.operators import logs
from tablelift.sources.text import read_ddl_statements, read_log_lines

MODERN = """
Import job started
ORA-39083: Object type TABLE:"SALES"."INVOICES" failed to create with error:
ORA-00959: tablespace 'BILLING' does not exist
ora-39083: object type INDEX: "Stock"."Bin Index" failed to create with error:
Failing sql is: CREATE INDEX
ORA-00959: tablespace 'cold_store' does not exist
ORA-00959: tablespace 'Fast_Store' does not exist
ORA-39083: Object type TABLE:"SALES"."INVOICES" failed to create with error:
ORA-00959: tablespace 'ARCHIVE' does not exist
""".strip()
LEGACY = """
ORA-00959: tablespace 'EARLY' does not exist
CREATE TABLE "SALES"."INVOICES" ("NR" NUMBER)
IMP-00017: following statement failed with ORACLE error 959:
ORA-00959: tablespace 'BILLING' does not exist
create global temporary table "SALES"."SCRATCH" ("NR" NUMBER)
ORA-00959: tablespace 'temp2' does not exist
""".strip()
SHOW = """
. . importing table "ORPHAN" 1 rows
. importing SALES's objects into STAGE
. . importing table "INVOICES" 12 rows imported
. . importing table         "INVOICES" 12 rows imported
. importing SYSTEM's objects into SYSTEM
. . importing table "HELP"
   . Importing STOCK's objects into STAGE
. . importing table   "BINS"  0 rows imported
. . importing table "INVOICES"
""".strip()


def lines(spark, text, block=2):
    rows = [("log", i // block, i, line) for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "file string, block bigint, seq bigint, line string")


def objects(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["object"], set()).add(r["tablespace"])
    return found


def test_modern_and_legacy_attribution(spark):
    assert objects(logs.missing_tablespaces(lines(spark, MODERN))) == {
        "SALES.INVOICES": {"BILLING", "ARCHIVE"}, "Stock.Bin Index": {"COLD_STORE", "FAST_STORE"},
    }
    assert objects(logs.missing_tablespaces(lines(spark, LEGACY), legacy=True)) == {
        "<unknown>": {"EARLY"}, "SALES.INVOICES": {"BILLING"}, "SALES.SCRATCH": {"TEMP2"},
    }


def test_orphans_are_unknown_and_empty_is_empty(spark):
    orphan = lines(spark, "ORA-00959: tablespace 'X' does not exist")
    assert objects(logs.missing_tablespaces(orphan)) == {"<unknown>": {"X"}}
    assert objects(logs.missing_tablespaces(lines(spark, ""))) == {}


def test_forward_fill_with_one_hot_file_against_brute_force(spark):
    rnd = random.Random(7)
    rows, expected = [], {}
    for file, n in (("hot", 3000), ("a", 700), ("b", 5), ("none", 40)):
        last = None
        for seq in range(n):
            value = f"{file}{seq}" if file != "none" and rnd.random() < 0.02 else None
            last = value or last
            rows.append((file, seq // 64, seq, value))
            expected[file, seq] = last
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, block bigint, seq bigint, v string")
    filled = logs.forward_fill(df, F.col("v"), "f").collect()
    assert {(r["file"], r["seq"]): r["f"] for r in filled} == expected


def test_forward_fill_sorts_no_whole_file(spark):
    plan = logs.forward_fill(lines(spark, MODERN), F.col("line"), "f")
    text = plan._jdf.queryExecution().executedPlan().toString()
    windows = [w for w in text.split("\n") if "Window [" in w and "__own" in w]
    assert windows
    assert all("block" in w for w in windows)


def test_show_log(spark):
    got = {(r["schema"], r["table"]) for r in logs.shown_tables(lines(spark, SHOW)).collect()}
    assert got == {("SALES", "INVOICES"), ("STOCK", "BINS"), ("STOCK", "INVOICES")}


def ddl(spark, *texts):
    rows = [("ddl", 0, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "file string, block bigint, seq bigint, statement string")


def tables(df):
    rows = df.orderBy("block", "seq", "pos").collect()
    return [(r["schema"], r["table"]) for r in rows]


def test_quoted_names_win_and_keep_first_order(spark):
    df = ddl(
        spark,
        'CREATE TABLE "S"."B" (x);\nCREATE GLOBAL  TEMPORARY\nTABLE "S"."A""1" (x)',
        'create table "S"."B" (y); CREATE TABLE plain.t (x); CREATE TABLE "SYS"."X" (z)',
    )
    assert tables(logs.ddl_tables(df)) == [("S", "B"), ("S", 'A"1')]


def test_plain_names_when_only_system_ones_are_quoted(spark):
    df = ddl(spark, 'CREATE TABLE "SYS"."X" (z); create private temporary table own.t$1 (a)')
    assert tables(logs.ddl_tables(df)) == [("OWN", "T$1")]


def test_import_log_is_the_last_resort(spark):
    log = lines(spark, SHOW).withColumn("file", F.lit("ddl"))
    assert tables(logs.ddl_tables(ddl(spark, "nothing here"), log)) == [
        ("SALES", "INVOICES"), ("STOCK", "BINS"), ("STOCK", "INVOICES"),
    ]


def test_tablespaces(spark):
    df = ddl(spark, 'x TABLESPACE "Data" y tablespace  "USERS"', 'TABLESPACE "DATA"')
    assert [r["tablespace"] for r in logs.ddl_tablespaces(df).collect()] == ["DATA"]


def test_quota(spark):
    df = lines(spark, "ORA-01950: no privileges on tablespace 'q1' ora-01950: No privileges on "
                      "tablespace 'Q2'")
    assert {r["tablespace"] for r in logs.missing_quota(df).collect()} == {"Q1", "Q2"}


def test_codes(spark):
    df = lines(spark, "ORA-00942: x ora-39126\nORA-123 ORA-1234567 ORA-39143")
    assert {r["code"] for r in logs.ora_codes(df).collect()} == {942, 39126, 12345, 39143}
    assert {r["code"] for r in logs.fatal_codes(df).collect()} == {39126}
    assert logs.is_legacy_dump(df).first()["is_legacy"]


def test_behavior_of_codes(spark, one):
    wanted = {942: "skip", 959: "retry", 39151: "warn", 39083: "fatal", 77777: "fatal"}
    for code, behavior in wanted.items():
        assert one(logs.code_behavior(F.lit(code))) == behavior
    assert one(logs.listed_behavior(F.lit(77777))) is None


def test_exit_classes(spark):
    cases = [
        ("impdp", 0, "ORA-39126", "success"), ("impdp", 5, "x", "warning"),
        ("impdp", 5, "ORA-39126", "fatal"), ("impdp", 2, "ORA-77777", "warning"),
        ("imp", 5, "x", "fatal"), ("imp", 2, "x", "warning"), ("exp", 2, "ORA-01017", "fatal"),
        ("expdp", 2, "x", "fatal"), ("impdp", 1, "x", "fatal"),
    ]
    runs = spark.createDataFrame(
        [(str(i), t, c) for i, (t, c, _, _) in enumerate(cases)],
        "file string, tool string, return_code int",
    )
    text = spark.createDataFrame(
        [(str(i), o) for i, (_, _, o, _) in enumerate(cases)], "file string, line string"
    )
    got = {r["file"]: r["exit_class"] for r in logs.classify_exits(runs, text).collect()}
    assert got == {str(i): want for i, (_, _, _, want) in enumerate(cases)}


def test_import_error_levels(spark):
    rows = [("a", "IMP-00003: x ORA-00942"), ("b", "IMP-00017 IMP-00099"), ("c", "all well")]
    df = spark.createDataFrame(rows, "file string, line string")
    got = {r["file"]: (r["known_nonfatal"], r["unknown"], r["has_codes"], r["level"])
           for r in logs.classify_import_errors(df).collect()}
    assert got == {
        "a": (["IMP-00003", "ORA-00942"], [], True, "info"),
        "b": (["IMP-00017"], ["IMP-00099"], True, "warning"),
        "c": ([], [], False, "error"),
    }


def test_files_read_in_splits_keep_their_order(spark, tmp_path):
    text = "\n".join(
        f'ORA-39083: Object type TABLE:"S"."T{i}" failed to create\n'
        f"ORA-00959: tablespace 'TS{i}' does not exist"
        for i in range(500)
    )
    (tmp_path / "a.log").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_log_lines(spark, str(tmp_path))
        assert df.select("block").distinct().count() > 5
        found = objects(logs.missing_tablespaces(df))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {f"S.T{i}": {f"TS{i}"} for i in range(500)}


def test_ddl_file_read_by_statement(spark, tmp_path):
    (tmp_path / "x.sql").write_text(
        'CREATE TABLE "S"."A"\n(a) TABLESPACE\n"ONE";\n\nCREATE TABLE "S"."B;C" (b);\n'
    )
    df = read_ddl_statements(spark, str(tmp_path))
    assert tables(logs.ddl_tables(df)) == [("S", "A"), ("S", "B;C")]
    assert [r["tablespace"] for r in logs.ddl_tablespaces(df).collect()] == ["ONE"]
