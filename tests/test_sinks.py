from __future__ import annotations

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablelift.operators.validate import count_output, count_output_chunks
from tablelift.sinks.files import (
    by_chunk,
    check_format,
    read_output,
    write_empty_chunk,
    write_output,
)
from tablelift.sinks.metrics import RunMetrics, metrics_by_phase, read_metrics
from tablelift.sources.tables import scan_fileset

FORMATS = ["parquet", "csv"]


def sample(spark):
    return spark.sql(
        """SELECT id AS n, cast(id AS int) i, cast(id / 4 AS double) d, cast(id / 4 AS float) f,
           id % 2 = 0 AS b, cast(id AS decimal(20,3)) / 7 AS dc, cast(-id AS decimal(38,0)) AS big,
           date_add(date'1969-12-30', cast(id AS int)) AS dt,
           timestamp_ntz'1969-12-31 23:59:59.999999' + make_dt_interval(0, 0, 0, id / 1000000) AS ts,
           encode(concat('b', id), 'UTF-8') AS bin,
           CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' a"b,\n\r x ' ELSE 'é漢' END AS s
           FROM range(1000)"""
    ).select(*[F.when(F.col("n") % 13 != 5, F.col(c)).alias(c) for c in
               ("i", "d", "f", "b", "dc", "big", "dt", "ts", "bin", "s")], "n")


@pytest.mark.parametrize("fmt", FORMATS)
def test_round_trip(spark, tmp_path, fmt):
    df = sample(spark)
    write_output(df, fmt, str(tmp_path / "o"))
    schema = None
    if fmt == "csv":
        df = df.withColumn("bin", F.base64("bin"))
        schema = df.schema
    back = read_output(spark, fmt, str(tmp_path / "o"), schema).select(df.columns)
    assert back.exceptAll(df).count() == 0
    assert df.exceptAll(back).count() == 0
    assert count_output(spark, fmt, str(tmp_path / "o")) == 1000


@pytest.mark.parametrize("fmt", FORMATS)
def test_chunks_and_replacement(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    names = ["p 1", "p/2", "p%3"]
    df = spark.range(30).select(
        F.col("id").alias("v"),
        F.get(F.array(*map(F.lit, names)), (F.col("id") % 3).cast("int")).alias("chunk"),
    )
    write_output(by_chunk(df), fmt, path, chunked=True)
    count = lambda: {r.chunk: r.output_rows for r in count_output_chunks(spark, fmt, path).collect()}
    assert count() == dict.fromkeys(names, 10)
    again = df.where(F.col("chunk") == "p/2").limit(4)
    write_output(again, fmt, path, chunked=True, replace="chunks")
    assert count() == {"p 1": 10, "p/2": 4, "p%3": 10}
    write_output(again, fmt, path, chunked=True)
    assert count() == {"p/2": 4}


@pytest.mark.parametrize("fmt", FORMATS)
def test_empty_chunk_is_readable(spark, tmp_path, fmt):
    df = sample(spark)
    write_empty_chunk(df, fmt, str(tmp_path / "t"), "whole")
    back = read_output(spark, fmt, str(tmp_path / "t" / "chunk=whole"))
    assert back.drop("chunk").columns == df.columns
    assert back.count() == 0
    assert count_output(spark, fmt, str(tmp_path / "t")) == 0


@pytest.mark.parametrize("fmt", FORMATS)
def test_one_column_with_nulls_keeps_its_rows(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a",), (None,), ("",), (None,)], "s string")
    write_output(df, fmt, str(tmp_path / "o"))
    assert count_output(spark, fmt, str(tmp_path / "o")) == 4


def test_parquet_keeps_field_metadata(spark, tmp_path):
    df = spark.range(2).select(F.col("id").alias("ID", metadata={"oracle_data_type": "NUMBER"}))
    write_output(df, "parquet", str(tmp_path / "o"))
    back = read_output(spark, "parquet", str(tmp_path / "o"))
    assert back.schema["ID"].metadata == {"oracle_data_type": "NUMBER"}


def test_csv_is_read_alike_by_the_csv_module(spark, tmp_path):
    write_output(sample(spark).coalesce(1), "csv", str(tmp_path / "o"))
    file = next(Path(tmp_path / "o").glob("*.csv"))
    with open(file, encoding="utf-8", newline="") as f:
        rows = list(csv.DictReader(f))
    assert len(rows) == 1000
    assert rows[2]["s"] == ' a"b,\n\r x '
    assert rows[1]["ts"] == "1970-01-01 00:00:00.000000"


def test_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown output format"):
        check_format("orc")
    with pytest.raises(ValueError, match="unknown output format"):
        write_output(spark.range(1), "xml", str(tmp_path / "o"))


def test_fileset_rules(spark, tmp_path):
    with pytest.raises(ValueError, match="at least one"):
        scan_fileset(spark, "parquet", [])
    with pytest.raises(ValueError, match="one directory"):
        scan_fileset(spark, "parquet", ["/a/x.parquet", "/b/y.parquet"])


def test_metrics_never_fail_the_work(spark, tmp_path):
    metrics = RunMetrics(spark, str(tmp_path / "m"))
    with pytest.raises(ZeroDivisionError), metrics.phase("bad", table="T"):
        1 / 0
    with metrics.phase("good"):
        pass
    metrics.flush()
    got = {r.phase: r.n_runs for r in
           metrics_by_phase(read_metrics(spark, str(tmp_path / "m"))).collect()}
    assert got == {"bad": 1, "good": 1}
    blocked = RunMetrics(spark, "nosuchscheme://x/y")
    with blocked.phase("p"):
        pass
    blocked.flush()


def test_hot_chunk_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(60000).select(
        F.col("id"), F.md5(F.col("id").cast("string")).alias("x"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 20))
        .alias("chunk"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        write_output(by_chunk(df.repartition(4)), "parquet", str(tmp_path / "t"), chunked=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "chunk=hot").glob("*.parquet"))) > 1
    assert count_output(spark, "parquet", str(tmp_path / "t")) == 60000


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_timestamps_through_instants(spark, zone):
    from tablelift.sources.avro import with_utc_instants, without_zone

    df = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.999999' AS t")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        instants = with_utc_instants(df)
        assert instants.select(F.unix_micros("t")).first()[0] == -1
        assert without_zone(instants).select(F.col("t").cast("string")).first()[0] == (
            "1969-12-31 23:59:59.999999"
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_avro_without_its_module_is_one_clear_error(spark, tmp_path):
    from tablelift.sources.avro import has_avro_module

    if has_avro_module(spark):
        pytest.skip("the module is there")
    for action in (lambda: write_output(spark.range(3), "avro", str(tmp_path / "o")), lambda: read_output(spark, "avro", str(tmp_path / "o"))):
        with pytest.raises(ValueError, match="spark-avro"):
            action()


def test_chunk_names_that_look_like_numbers(spark, tmp_path):
    df = spark.createDataFrame([("007", 1), ("010", 2), ("010", 3)], "chunk string, v int")
    for fmt in FORMATS:
        write_output(df, fmt, str(tmp_path / fmt), chunked=True)
        got = {r["chunk"]: r["output_rows"] for r in count_output_chunks(spark, fmt, str(tmp_path / fmt)).collect()}
        assert got == {"007": 1, "010": 2}
