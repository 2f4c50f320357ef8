from __future__ import annotations

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from source_fixture import LONG_NAME, SKIPPED, TABLES, catalog, frames

from tablelift import engine
from tablelift.functions.naming import table_path
from tablelift.functions.types import ColumnSpec
from tablelift.operators import ledger as led
from tablelift.operators.partitions import MAXVALUE, HashPartitions, RangePartitions
from tablelift.operators.project import failing_rows
from tablelift.operators.validate import count_output, count_output_chunks
from tablelift.sinks import files
from tablelift.sinks.files import read_output, write_output
from tablelift.sinks.metrics import RunMetrics, chunk_metrics, metrics_by_phase, read_metrics

COLUMNS = (ColumnSpec("v", "NUMBER", 10, 0), ColumnSpec("t", "VARCHAR2(20)"))


@pytest.fixture(scope="module")
def converted(spark, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("run"))
    return work, engine.run(spark, catalog(spark), versioned(spark), work)


def versioned(spark):
    """The frames, which have no files, with the version that lets a run resume."""
    return {k: engine.SourceTable(df, (), method, version="1") for k, (df, method) in frames(spark).items()}


def test_golden_counts(spark, converted):
    work, summary = converted
    rows = sum(n for t, (n, _) in TABLES.items() if t not in SKIPPED)
    assert rows == 654
    assert summary["statistics"] == {
        "total_output_rows": 654, "tables_total": len(TABLES), "tables_skipped": len(SKIPPED),
        "tables_converted": len(TABLES) - len(SKIPPED), "tables_failed": 0,
    }
    for table, (n, _) in TABLES.items():
        path = table_path(f"{work}/data", *table)
        if table in SKIPPED:
            assert not Path(path).exists()
        else:
            with engine.strict_session(spark):
                assert count_output(spark, "parquet", path) == n, table


def test_saved_report(converted):
    work, summary = converted
    (part,) = Path(work, "report", "summary").glob("*.txt")
    assert json.loads(part.read_text())["statistics"] == summary["statistics"]
    entries = [json.loads(line) for p in Path(work, "report", "entries").glob("*.json")
               for line in p.read_text().splitlines()]
    skipped = {(e["schema"], e["table"]): e["reason"] for e in entries if e["outcome"] == "skipped"}
    assert set(skipped) == SKIPPED
    assert skipped["AUDITLOG", "ATTACHMENTS"] == "column 'FILE_REF' has unsupported type BFILE"
    assert skipped["HRDATA", "EMP_TAGS"] == "column 'TAGS' has user-defined type HRDATA.TAG_LIST"


def test_chunks_of_partitioned_tables(spark, converted):
    work, _ = converted

    def chunks(schema, table):
        found = count_output_chunks(spark, "parquet", table_path(f"{work}/data", schema, table))
        return {r["chunk"] for r in found.collect()}

    listed = Path(table_path(f"{work}/data", "FINANCE", "TRANSACTION_DETAILS")).glob("chunk=*")
    assert len(list(listed)) == 12
    assert chunks("FINANCE", "TRANSACTION_LINES") <= chunks("FINANCE", "TRANSACTION_DETAILS")
    assert len(chunks("FINANCE", "TRANSACTIONS")) == 5
    assert len(chunks("AUDITLOG", "EVENT_STREAM")) > 5
    assert Path(table_path(f"{work}/data", "HRDATA", LONG_NAME), "chunk=whole").exists()


def test_types_and_exact_values(spark, converted):
    work, _ = converted
    read = lambda s, t: read_output(spark, "parquet", table_path(f"{work}/data", s, t))
    wide = read("FINANCE", "WIDE_DECIMALS")
    assert wide.schema["N_NEG"].metadata["oracle_decimal"] == "48,0"
    assert {r["N_NEG"] for r in wide.collect()} == {
        str(1234567890123456789 * 10**10), "-100000000000000000000",
    }
    assert wide.where("ROW_ID = 0").first()["N_NEG2"] == str(12345678901234567890 * 10**20)
    edge = read("FINANCE", "NUMERIC_EDGE")
    assert [f.dataType.simpleString() for f in edge.schema][:8] == [
        "bigint", "decimal(38,0)", "decimal(38,0)", "decimal(5,4)", "bigint", "decimal(22,0)",
        "decimal(5,5)", "double",
    ]
    assert [int(r["UNBOUNDED"]) for r in edge.orderBy("ROW_ID").collect()] == [1, 2, 3]
    assert "INTERNAL_NOTE" not in read("FINANCE", "ACCOUNTS").columns
    with engine.strict_session(spark):
        mixed = read("HRDATA", "MixedCase_Table")
    assert read("HRDATA", "JOBS").schema["JOB_ID"].metadata["oracle_comment"] == "the key"
    assert mixed.columns[:3] == ["CamelCase_Col", "SELECT", "camelcase_col"]
    spec = read("INVENTORY", "PRODUCT_SPECS").orderBy("SPEC_ID").first()["SPEC"]
    assert spec == '{"b": 0, "a": [1, null]}'
    assert read("INVENTORY", "STORE_LOCATIONS").orderBy("STORE_ID").first()[1] == "POINT (0.0 0.5)"
    txn = read("FINANCE", "TRANSACTIONS").orderBy("TXN_ID").first()
    assert txn["TXN_TS"] == "2024-01-01T00:00:00.000000000 UTC"


def test_second_run_redoes_nothing(spark, converted):
    work, summary = converted
    stamp = lambda: {p: p.stat().st_mtime_ns for p in Path(work, "data").rglob("*.parquet")}
    before = stamp()
    again = engine.run(spark, catalog(spark), versioned(spark), work)
    assert stamp() == before
    assert again["statistics"] == summary["statistics"]


@pytest.mark.parametrize("fmt", ["csv"])
def test_other_formats(spark, tmp_path, fmt):
    wanted = {("FINANCE", "TRANSACTION_DETAILS"), ("FINANCE", "NUMERIC_EDGE"),
              ("AUDITLOG", "LONG_BLOBS"), ("HRDATA", LONG_NAME), ("INVENTORY", "SUPPLIER_NOTES")}
    some = {k: v for k, v in frames(spark).items() if k in wanted}
    engine_catalog = catalog(spark)
    names = spark.createDataFrame(list(wanted), "owner string, table_name string")
    engine_catalog["tables"] = engine_catalog["tables"].join(names, ["owner", "table_name"], "left_semi")
    engine_catalog["external_tables"] = engine_catalog["external_tables"].limit(0)
    summary = engine.run(spark, engine_catalog, some, str(tmp_path), fmt)
    assert summary["statistics"]["total_output_rows"] == 80 + 3 + 5 + 0 + 15
    for table in wanted:
        path = table_path(f"{tmp_path}/data", *table)
        assert count_output(spark, fmt, path) == TABLES[table][0]


def source(spark, n=40, bad=None, method=None):
    df = spark.range(n).select(
        F.when(F.col("id") == (-1 if bad is None else bad), "x").otherwise(F.col("id").cast("string"))
        .alias("v"),
        F.concat(F.lit("t"), "id").alias("t"),
        F.col("id").alias("k"),
    )
    method = method or RangePartitions("k", [("A", 10), ("B", 20), ("M", MAXVALUE)])
    return engine.SourceTable(df, COLUMNS, method)


def plan_of(spark, *chunks, strategy="partition"):
    return spark.createDataFrame(
        [("S", "T", strategy, None, c, None, None) for c in chunks],
        "schema string, table string, strategy string, reason string, chunk string, "
        "partition_name string, subpartition_name string",
    )


CHUNKS = ("partition-00001-A", "partition-00002-B", "partition-00003-M")


def test_one_bad_chunk_does_not_take_the_others(spark, tmp_path):
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))
    out = str(tmp_path / "o")
    with pytest.raises(engine.ConversionFailed) as failure:
        engine.convert_plan(spark, plan_of(spark, *CHUNKS), {("S", "T"): source(spark, bad=15)},
                            out, ledger=ledger)
    got = {r["chunk"]: (r["status"], r["output_rows"]) for r in failure.value.results.collect()}
    assert got == {CHUNKS[0]: ("completed", 10), CHUNKS[1]: ("failed", None), CHUNKS[2]: ("completed", 20)}
    states = {r["chunk_name"]: r["status"] for r in ledger.latest().collect()}
    assert states == {CHUNKS[0]: "completed", CHUNKS[1]: "failed", CHUNKS[2]: "completed"}
    results = engine.convert_plan(spark, plan_of(spark, *CHUNKS), {("S", "T"): source(spark)}, out,
                                  ledger=ledger)
    assert {r["status"] for r in results.collect()} == {"completed"}
    back = read_output(spark, "parquet", f"{out}/S/T")
    assert sorted(r["v"] for r in back.collect()) == list(range(40))


def many_chunks(spark, n, bad, seen=None, expression=None):
    """A table of n chunks of 5 rows; ``seen`` counts how often a row is converted."""
    value = F.when(F.col("id").isin(list(bad)), "x").otherwise(F.col("id").cast("string"))
    df = spark.range(0, 5 * n, 1, 4).select(value.alias("v"), F.lit("t").alias("t"), F.floor(F.col("id") / 5).cast("int").alias("k"))
    if seen is not None:
        count = F.udf(lambda v: (seen.add(1), v)[1], "string").asNondeterministic()
        df = df.withColumn("v", count("v"))
    method = RangePartitions("k", [(f"P{i}", i + 1) for i in range(n)])
    columns = (replace(COLUMNS[0], expression=expression), COLUMNS[1]) if expression else COLUMNS
    return [f"partition-{i + 1:05d}-P{i}" for i in range(n)], engine.SourceTable(df, columns, method)


def test_failures_are_found_in_one_pass(spark, tmp_path):
    """200 chunks and one bad value: the failing write, one search, one write of all others; counts read the key alone."""
    seen = spark.sparkContext.accumulator(0)
    names, table = many_chunks(spark, 200, {503}, seen)
    metrics = RunMetrics(spark, str(tmp_path / "m"))
    results = engine.convert_plan(spark, plan_of(spark, *names), {("S", "T"): table}, str(tmp_path / "o"), metrics=metrics, raise_failures=False)
    got = {r["chunk"]: r for r in results.collect()}
    failed = [n for n, r in got.items() if r["status"] == "failed"]
    assert failed == [names[100]] and len(got) == 200
    assert got[names[100]]["error"] == "1 of 5 rows cannot be converted: v is no int64: x"
    assert seen.value <= 3 * 1000
    assert count_output(spark, "parquet", f"{tmp_path}/o/S/T") == 995
    measured = {r["chunk"]: r for r in chunk_metrics(read_metrics(spark, str(tmp_path / "m"))).collect()}
    assert len(measured) == 200 and measured[names[100]]["bad_rows"] == 1 and measured[names[100]]["bytes"] == 0
    assert all(r["input_rows"] == 5 and r["bytes"] > 0 and r["files"] == 1 for n, r in measured.items() if n != names[100])
    phases = {r["phase"]: r["n_runs"] for r in metrics_by_phase(read_metrics(spark, str(tmp_path / "m"))).collect()}
    assert phases == {"convert_table": 1, "count_source": 1, "write_chunks": 1, "find_failures": 1, "read_back": 1, "chunk": 200} | {"write_chunks": 2}


def test_failures_of_user_expressions_are_found_by_halves(spark, tmp_path):
    names, table = many_chunks(spark, 16, {12}, expression="cast({column} as int) * 2")
    results = engine.convert_plan(spark, plan_of(spark, *names), {("S", "T"): table}, str(tmp_path), raise_failures=False)
    assert {r["chunk"] for r in results.where("status = 'failed'").collect()} == {names[2]}
    assert sorted(r["v"] for r in read_output(spark, "parquet", f"{tmp_path}/S/T").collect()) == [2 * i for i in range(80) if i // 5 != 2]


def test_every_conversion_has_a_twin_that_sees_its_failures(spark):
    columns = (
        ColumnSpec("w", "NUMBER", 60, 2), ColumnSpec("d", "NUMBER", 5, 2), ColumnSpec("i", "NUMBER", 9, 0), ColumnSpec("j", "JSON"),
        ColumnSpec("g", "SDO_GEOMETRY"), ColumnSpec("b", "VARCHAR2(9)"), ColumnSpec("s", "DATE"),
    )
    kind = "w string, d string, i string, j string, g struct<gtype: int, elem_info: array<int>, ordinates: array<double>>, b binary, s string, chunk string"
    good = ("1" * 40, "1.5", "7", "{}", (2001, [1, 1, 1], [1.0, 2.0]), bytearray(b"\xff"), "2024-01-01")
    bad = ("x", "12345", "y", "{", (2001, [1, 2, 2], [1.0, 2.0]), None, "no date")
    rows = [(*good, "good"), (*[None] * 7, "null")]
    for i, value in enumerate(bad):
        if value is not None:
            rows.append((*good[:i], value, *good[i + 1 :], columns[i].name))
    df = spark.createDataFrame(rows, kind)
    found = {r["chunk"]: r for r in failing_rows(df, columns, "chunk").collect()}
    assert set(found) == {"w", "d", "i", "j", "g", "s"}
    assert all(r["bad_rows"] == 1 and r["reason"].startswith(f"{c} is no ") for c, r in found.items())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_all_empty_chunks_in_one_job(spark, tmp_path, fmt):
    names, table = many_chunks(spark, 300, set())
    table = replace(table, df=table.df.where("k < 2"))
    out = str(tmp_path / "o")
    stale = spark.range(3).select(F.col("id").alias("v"), F.lit("t").alias("t"), F.lit(names[7]).alias("chunk"))
    write_output(stale, fmt, f"{out}/S/T", chunked=True)
    jobs = []
    writer = engine.write_output
    with pytest.MonkeyPatch.context() as m:
        m.setattr(files, "write_output", lambda *a, **k: (jobs.append(1), writer(*a, **k)))
        results = engine.convert_plan(spark, plan_of(spark, *names), {("S", "T"): table}, out, fmt)
    assert len(jobs) == 1 and results.count() == 300
    assert count_output(spark, fmt, f"{out}/S/T") == 10
    assert not (tmp_path / "o" / "S" / "T" / "_empty").exists()
    one = read_output(spark, fmt, f"{out}/S/T/chunk={names[7]}")
    assert one.columns == ["v", "t"] and one.count() == 0


def test_only_what_changed_is_done_again(spark, tmp_path):
    """Three tables: one of its files is rewritten, one has no version, one stays; and a single file that feeds one chunk."""

    def rows(low, n, part):
        frame = spark.range(low, low + n).select(F.col("id").cast("string").alias("v"), F.lit("t").alias("t"), F.col("id").cast("int").alias("k"))
        frame.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/in/{part}")

    for name in ("A", "B"):
        for i in range(3):
            rows(10 * i, 10, f"{name}/p{i}")
    method = RangePartitions("k", [("A", 10), ("B", 20), ("M", MAXVALUE)])
    read = lambda name: spark.read.parquet(*[f"{tmp_path}/in/{name}/p{i}" for i in range(3)])
    plan_rows = [("S", t, "partition", None, c, None, None) for t in ("A", "B") for c in CHUNKS] + [("S", "C", "whole_table", None, "whole", None, None)]
    plan = spark.createDataFrame(plan_rows, plan_of(spark, "x").schema)
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))

    def go(bound=10):
        sources = {
            ("S", "A"): engine.SourceTable(read("A").where("k >= 0"), COLUMNS, replace(method, parts=[("A", bound), *method.parts[1:]])),
            ("S", "B"): engine.SourceTable(read("B"), COLUMNS, method),
            ("S", "C"): engine.SourceTable(source(spark).df, COLUMNS),
        }
        before = {p: p.stat().st_mtime_ns for p in Path(tmp_path, "o").rglob("*.parquet")}
        tree = engine.input_tree(plan, sources)
        result = engine.convert_plan(spark, plan, sources, f"{tmp_path}/o", ledger=ledger, inputs=tree, replace=True)
        after = {p: p.stat().st_mtime_ns for p in Path(tmp_path, "o").rglob("*.parquet")}
        assert result.where("status = 'completed'").count() == 7
        return {"/".join(p.parent.parts[-2:]) for p, t in after.items() if before.get(p) != t}

    chunks = lambda t, *names: {f"{t}/chunk={c}" for c in names}
    whole = chunks("C", "whole")
    assert go() == chunks("A", *CHUNKS) | chunks("B", *CHUNKS) | whole
    assert go() == whole  # no files, no version
    rows(10, 9, "B/p1")
    assert go() == chunks("B", CHUNKS[1]) | whole
    rows(5, 3, "A/p2")  # rows of the last chunk go, rows of the first come
    assert go() == chunks("A", CHUNKS[0], CHUNKS[2]) | whole
    assert go(bound=9) == chunks("A", *CHUNKS) | whole
    assert count_output(spark, "parquet", f"{tmp_path}/o/S/B") == 29


def test_killed_between_batches_equals_a_clean_run(spark, tmp_path):
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))
    out = str(tmp_path / "o")
    plan, sources = plan_of(spark, *CHUNKS), {("S", "T"): source(spark)}
    engine.convert_plan(spark, plan, sources, out, ledger=ledger)
    ledger.append_rows([("S.T", CHUNKS[1], led.RUNNING, None, None, None)])
    (part,) = [p for p in Path(out).rglob("*.parquet") if CHUNKS[1] in str(p)]
    (part.parent / "half-written.parquet").write_bytes(part.read_bytes())
    results = engine.convert_plan(spark, plan, sources, out, ledger=ledger)
    assert {r["chunk"]: r["output_rows"] for r in results.collect()} == dict(
        zip(CHUNKS, (10, 10, 20), strict=True))
    assert count_output(spark, "parquet", f"{out}/S/T") == 40


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_changed_chunk_set_leaves_no_stale_rows(spark, tmp_path, fmt):
    out = str(tmp_path / "o")
    engine.convert_plan(spark, plan_of(spark, *CHUNKS), {("S", "T"): source(spark)}, out, fmt)
    whole = plan_of(spark, "whole", strategy="whole_table")
    engine.convert_plan(spark, whole, {("S", "T"): source(spark, 25)}, out, fmt, replace=True)
    assert count_output(spark, fmt, f"{out}/S/T") == 25


@pytest.mark.parametrize("fmt", ["parquet"])
def test_stale_chunks_go_even_if_a_chunk_fails(spark, tmp_path, fmt):
    out = str(tmp_path / "o")
    whole = plan_of(spark, "whole", strategy="whole_table")
    engine.convert_plan(spark, whole, {("S", "T"): source(spark)}, out, fmt)
    results = engine.convert_plan(
        spark, plan_of(spark, *CHUNKS), {("S", "T"): source(spark, bad=15)}, out, fmt,
        raise_failures=False, replace=True)
    assert {r["chunk"]: r["status"] for r in results.collect()} == dict(
        zip(CHUNKS, ("completed", "failed", "completed"), strict=True))
    assert count_output(spark, fmt, f"{out}/S/T") == 30


def test_overflow_fails_even_in_a_lenient_session(spark, tmp_path):
    df = spark.sql("SELECT '123456789' AS v, 'x' AS t")
    columns = (ColumnSpec("v", "NUMBER", 20, 14), ColumnSpec("t", "VARCHAR2(9)"))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        results = engine.convert_plan(
            spark, plan_of(spark, "whole", strategy="whole_table"),
            {("S", "T"): engine.SourceTable(df, columns)}, str(tmp_path), raise_failures=False)
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    (row,) = results.collect()
    assert (row["status"], "NUMERIC_VALUE_OUT_OF_RANGE" in row["error"]) == ("failed", True)


def test_a_table_that_cannot_be_read_does_not_stop_the_others(spark, tmp_path):
    plan = spark.createDataFrame(
        [("S", t, "whole_table", None, "whole", None, None) for t in ("T", "NOCOL")],
        plan_of(spark, "x").schema)
    sources = {("S", "T"): source(spark),
               ("S", "NOCOL"): engine.SourceTable(spark.range(3), COLUMNS)}
    results = engine.convert_plan(spark, plan, sources, str(tmp_path), raise_failures=False)
    assert {r["table"]: r["status"] for r in results.collect()} == {
        "T": "completed", "NOCOL": "failed"}


def test_chunk_that_becomes_empty_loses_its_rows(spark, tmp_path):
    out = str(tmp_path / "o")
    for n in (40, 15):
        results = engine.convert_plan(spark, plan_of(spark, *CHUNKS), {("S", "T"): source(spark, n)}, out)
    assert {r["chunk"]: r["output_rows"] for r in results.collect()} == dict(
        zip(CHUNKS, (10, 5, 0), strict=True))
    assert count_output(spark, "parquet", f"{out}/S/T") == 15


def test_rows_outside_every_partition_fail(spark, tmp_path):
    method = RangePartitions("k", [("A", 10), ("B", 20)])
    results = engine.convert_plan(
        spark, plan_of(spark, *CHUNKS[:2]), {("S", "T"): source(spark, 25, method=method)},
        str(tmp_path / "o"), raise_failures=False)
    got = results.collect()
    assert {r["status"] for r in got} == {"failed"}
    assert all("rows outside the planned chunks: {None: 5}" in r["error"] for r in got)
    assert not (tmp_path / "o" / "S").exists()


def test_absent_table_and_schema(spark, tmp_path):
    plan = plan_of(spark, "whole", strategy="whole_table")
    with pytest.raises(ValueError, match="missing schemas: S"):
        engine.convert_plan(spark, plan, {("OTHER", "T"): source(spark)}, str(tmp_path))
    results = engine.convert_plan(spark, plan, {("S", "U"): source(spark)}, str(tmp_path))
    assert results.count() == 0


def test_partition_columns_of_the_source(spark, tmp_path):
    df = source(spark).df.withColumn("partition_name", F.when(F.col("k") < 7, "A").otherwise("B"))
    plan = spark.createDataFrame(
        [("S", "T", "partition", None, "partition-00001-A", "A", None),
         ("S", "T", "partition", None, "partition-00002-B", "B", None)],
        plan_of(spark, "x").schema,
    )
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))
    sources = {("S", "T"): engine.SourceTable(df, COLUMNS, clustered=True)}
    for _ in range(2):
        results = engine.convert_plan(spark, plan, sources, str(tmp_path / "o"), ledger=ledger)
        assert {r["chunk"]: r["output_rows"] for r in results.collect()} == {
            "partition-00001-A": 7, "partition-00002-B": 33}
        ledger.append_rows([("S.T", "partition-00002-B", led.RUNNING, None, None, None)])
    assert count_output(spark, "parquet", f"{tmp_path}/o/S/T") == 40


def test_one_chunk_with_a_third_of_all_rows(spark, tmp_path):
    method = HashPartitions(["g"], ["H1", "H2", "H3", "H4"], integer_key=True)
    df = spark.range(6000).select(
        F.col("id").alias("v"), F.lit("t").alias("t"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"))
    names = [f"partition-0000{i}-H{i}" for i in range(1, 5)]
    results = engine.convert_plan(
        spark, plan_of(spark, *names), {("S", "T"): engine.SourceTable(df, COLUMNS, method)},
        str(tmp_path / "o"))
    assert sum(r["output_rows"] for r in results.collect()) == 6000


def test_hot_chunk_is_split_over_tasks(spark, tmp_path):
    df = spark.range(0, 60000, 1, 4).select(
        F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("t"), F.lit("x").alias("u"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 8).alias("g"))
    method = RangePartitions("g", [("HOT", 1), ("M", MAXVALUE)])
    names = ("partition-00001-HOT", "partition-00002-M")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        engine.convert_plan(spark, plan_of(spark, *names),
                            {("S", "T"): engine.SourceTable(df, COLUMNS, method)}, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = Path(tmp_path, "S", "T", "chunk=partition-00001-HOT")
    assert len(list(hot.glob("*.parquet"))) > 1
    assert count_output(spark, "parquet", f"{tmp_path}/S/T") == 60000


def test_fingerprint_of_inputs_changes_the_ledger(spark):
    plan, sources = plan_of(spark, *CHUNKS), {("S", "T"): replace(source(spark), version="1")}
    same = engine.input_fingerprint(plan, sources)
    assert engine.input_fingerprint(plan, sources) == same
    assert engine.input_fingerprint(plan_of(spark, *CHUNKS[:2]), sources) != same


@pytest.mark.parametrize("fmt", ["parquet"])
def test_replaced_bytes_are_reported(spark, tmp_path, caplog, fmt):
    df = spark.createDataFrame(
        [(1, bytearray(b"ok")), (2, bytearray(b"\xff")), (3, bytearray(b"a\xc3"))],
        "v int, t binary",
    )
    plan = plan_of(spark, "whole", strategy="whole_table")
    with caplog.at_level("WARNING", "tablelift.engine"):
        engine.convert_plan(spark, plan, {("S", "T"): engine.SourceTable(df, COLUMNS)},
                            str(tmp_path / "o"), fmt)
    assert "S.T.t: bytes that are no UTF-8 replaced in about 2 rows" in caplog.text
    back = read_output(spark, fmt, f"{tmp_path}/o/S/T")
    assert {r["t"] for r in back.collect()} == {"ok", "�", "a�"}


def test_unknown_types_are_reported(spark, caplog):
    manifest = engine.inspect(
        {**catalog(spark), "tab_cols": spark.createDataFrame(
            [("S", "T", "A", "ROWID", 1, "Y", None, None, 0, None, None, "NO"),
             ("S", "T", "B", "NUMBER", 2, "Y", 5, 0, 0, None, None, "NO")],
            catalog(spark)["tab_cols"].schema),
         "tables": spark.createDataFrame([("S", "T", 1, 1, "N")], catalog(spark)["tables"].schema)})
    over = spark.createDataFrame([("S.T.B", None, "nonsense")],
                                 "key string, expression string, target string")
    with caplog.at_level("WARNING", "tablelift.engine"):
        columns = engine.table_columns(manifest, over)["S", "T"]
    assert "S.T.A: unknown type 'ROWID'" in caplog.text
    assert "S.T.B: unknown target type 'nonsense'" in caplog.text
    assert [c.target for c in columns] == [None, "nonsense"]


def test_overrides_reach_the_output(spark, tmp_path):
    table_over = spark.createDataFrame([("FINANCE.TRANSACTION_DETAILS", "whole")], "key string, strategy string")
    column_over = spark.createDataFrame(
        [("HRDATA.JOBS.JOB_TITLE", "upper(trim({column}))", None),
         ("HRDATA.JOBS.MIN_SALARY", None, "int32")],
        "key string, expression string, target string")
    wanted = [("HRDATA", "JOBS"), ("FINANCE", "TRANSACTION_DETAILS")]
    some = {k: v for k, v in frames(spark).items() if k in wanted}
    parts = catalog(spark)
    names = spark.createDataFrame(wanted, "owner string, table_name string")
    parts["tables"] = parts["tables"].join(names, ["owner", "table_name"], "left_semi")
    engine.run(spark, parts, some, str(tmp_path), table_overrides=table_over,
               column_overrides=column_over)
    jobs = read_output(spark, "parquet", table_path(f"{tmp_path}/data", "HRDATA", "JOBS"))
    assert jobs.schema["MIN_SALARY"].dataType.simpleString() == "int"
    assert jobs.where("JOB_TITLE IS NOT NULL AND JOB_TITLE <> upper(JOB_TITLE)").count() == 0
    details = Path(table_path(f"{tmp_path}/data", "FINANCE", "TRANSACTION_DETAILS"))
    assert [p.name for p in details.glob("chunk=*")] == ["chunk=whole"]


def test_fingerprint_covers_all_that_decides_the_output(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(5).select(F.col("id").cast("string").alias("v"), F.lit("t").alias("t"), F.col("id").alias("k")).write.parquet(path)

    def print_of(fmt="parquet", columns=COLUMNS, bound=10, **how):
        method = RangePartitions("k", [("A", bound), ("M", MAXVALUE)])
        table = engine.SourceTable(spark.read.parquet(path), columns, method, **how)
        return engine.input_fingerprint(plan_of(spark, *CHUNKS), {("S", "T"): table}, fmt)

    first = print_of()
    assert len(first) == 64 and print_of() == first
    others = [print_of("csv"), print_of(bound=11), print_of(version="2")]
    others += [print_of(columns=(replace(COLUMNS[0], expression="upper({column})"), *COLUMNS[1:])), print_of(columns=(replace(COLUMNS[0], target="string"), *COLUMNS[1:]))]
    spark.range(6).select(F.col("id").cast("string").alias("v"), F.lit("t").alias("t"), F.col("id").alias("k")).write.mode("overwrite").parquet(path)
    others.append(print_of())
    assert len({first, *others}) == 7
    none = {("S", "T"): source(spark)}  # no files, no version: never the same
    assert engine.input_fingerprint(plan_of(spark, *CHUNKS), none) != engine.input_fingerprint(plan_of(spark, *CHUNKS), none)


def test_partial_plans_keep_each_other(spark, tmp_path):
    out = str(tmp_path / "o")
    table = source(spark)
    for name, low in ((CHUNKS[0], 0), (CHUNKS[1], 10)):
        part = replace(table, df=table.df.where((F.col("k") >= low) & (F.col("k") < low + 10)))
        engine.convert_plan(spark, plan_of(spark, name), {("S", "T"): part}, out)
    assert count_output(spark, "parquet", f"{out}/S/T") == 20


def test_convert_table_is_strict_by_itself(spark, tmp_path):
    df = spark.sql("SELECT 1e30D AS v, 'x' AS t")
    table = engine.SourceTable(df, (ColumnSpec("v", "NUMBER", 5, 0), ColumnSpec("t", "VARCHAR2(9)")))
    work = engine.TableWork("S", "T", "whole_table", [engine.Chunk("whole")])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        (result,) = engine.convert_table(table, work, str(tmp_path), "parquet")
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert result.status == "failed"


def test_a_lost_ledger_is_restored_from_its_records(spark, tmp_path):
    out, plan, sources = str(tmp_path / "o"), plan_of(spark, *CHUNKS), {("S", "T"): source(spark)}
    engine.convert_plan(spark, plan, sources, out, ledger=led.ChunkLedger(spark, str(tmp_path / "l")))
    (tmp_path / "l" / "states").rename(tmp_path / "lost-states")
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))
    before = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    engine.convert_plan(spark, plan, sources, out, ledger=ledger)
    assert before == {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    assert {r["status"] for r in ledger.latest().collect()} == {"completed"}
