"""Final names of written chunks, and CSV rows counted in splits."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablelift import engine
from tablelift.operators import validate
from tablelift.sinks import layout
from tablelift.sinks.files import read_output, write_output
from tablelift.sources.storage import Store


def names(path):
    return sorted(p.name for p in path.iterdir() if not p.name.startswith("."))


def rows(spark, n, files=1, chunk="a b/c"):
    return spark.range(0, n, 1, files).select("id", F.lit(chunk).alias("chunk"))


def test_final_names(spark, tmp_path):
    written, published = str(tmp_path / "w"), str(tmp_path / "p")
    write_output(rows(spark, 5), "parquet", written, chunked=True, replace="chunks")
    assert layout.publish_table(spark, written, published, ["a b/c", "absent"], "parquet") == {"a b/c": ["a%20b%2Fc.parquet"], "absent": []}
    assert names(tmp_path / "p") == ["a%20b%2Fc.parquet"]
    assert spark.read.parquet(published).count() == 5
    write_output(rows(spark, 9, 3), "parquet", written, chunked=True, replace="chunks")
    layout.publish_table(spark, written, published, ["a b/c"], "parquet")
    assert names(tmp_path / "p") == [f"a%20b%2Fc.part-0000{i}.parquet" for i in range(3)]
    write_output(rows(spark, 2, chunk="other"), "parquet", written, chunked=True, replace="chunks")
    layout.publish_table(spark, written, published, ["other"], "parquet", replace=True)
    assert names(tmp_path / "p") == ["other.parquet"]


@pytest.mark.parametrize("step", range(1, 12))
def test_a_crash_between_moves_is_made_good(spark, tmp_path, monkeypatch, step):
    written, published = str(tmp_path / "w"), str(tmp_path / "p")
    write_output(rows(spark, 4), "parquet", written, chunked=True, replace="chunks")
    layout.publish_table(spark, written, published, ["a b/c"], "parquet")
    write_output(rows(spark, 9, 3), "parquet", written, chunked=True, replace="chunks")
    left = [step]

    def dying(do):
        def run(*args):
            left[0] -= 1
            if left[0] == 0:
                raise KeyboardInterrupt
            return do(*args)

        return run

    with monkeypatch.context() as m:
        for name in ("rename", "remove"):
            m.setattr(Store, name, dying(getattr(Store, name)))
        try:
            layout.publish_table(spark, written, published, ["a b/c"], "parquet")
        except KeyboardInterrupt:
            pass
    layout.publish_table(spark, written, published, ["a b/c"], "parquet")
    assert spark.read.parquet(published).count() == 9
    assert names(tmp_path / "p") == [f"a%20b%2Fc.part-0000{i}.parquet" for i in range(3)]


def test_a_run_ends_in_files_of_its_chunks(spark, tmp_path):
    from source_fixture import catalog, frames

    wanted = [("HRDATA", "JOBS"), ("FINANCE", "TRANSACTION_DETAILS")]
    parts = catalog(spark)
    kept = spark.createDataFrame(wanted, "owner string, table_name string")
    parts["tables"] = parts["tables"].join(kept, ["owner", "table_name"], "left_semi")
    parts["external_tables"] = parts["external_tables"].limit(0)
    some = {k: engine.SourceTable(df.coalesce(1), (), method, version="1") for k, (df, method) in frames(spark).items() if k in wanted}
    for _ in range(2):
        engine.run(spark, parts, some, str(tmp_path), "csv", publish=True)
        assert names(tmp_path / "files" / "HRDATA" / "JOBS") == ["whole.csv"]
        details = names(tmp_path / "files" / "FINANCE" / "TRANSACTION_DETAILS")
        assert len(details) == 12 and all(n.startswith("subpartition-0000") and n.endswith(".csv") for n in details)
        assert validate.count_output(spark, "csv", f"{tmp_path}/files/FINANCE/TRANSACTION_DETAILS") == 80


@pytest.mark.parametrize("size", ["100000000", "4096", "61"])
def test_csv_rows_by_splits(spark, tmp_path, size):
    rnd = random.Random(5)
    signs = ['"', "\n", "a", '"\n"', ",", "\n\n", "", " ", "\r", '""', "é"]
    chunks = ["x", "y z", "a/b=c%", "p+q"]
    data = [("".join(rnd.choice(signs) for _ in range(rnd.randrange(9))) if rnd.random() > 0.1 else None, i, chunks[i % 4]) for i in range(600)]
    df = spark.createDataFrame(data, "t string, i int, chunk string").coalesce(1)
    write_output(df, "csv", f"{tmp_path}/o", chunked=True)
    write_output(df.select("t"), "csv", f"{tmp_path}/one")
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        counted = {r["chunk"]: r["output_rows"] for r in validate.count_output_chunks(spark, "csv", f"{tmp_path}/o").collect()}
        one = validate.count_output(spark, "csv", f"{tmp_path}/one")
        splits = spark.read.option("lineSep", "\n").text(f"{tmp_path}/one").rdd.getNumPartitions()
        assert validate.count_output(spark, "csv", f"{tmp_path}/none") == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert counted == {r["chunk"]: r["count"] for r in read_output(spark, "csv", f"{tmp_path}/o").groupBy("chunk").count().collect()} == dict.fromkeys(chunks, 150)
    assert one == read_output(spark, "csv", f"{tmp_path}/one").count() == 600
    assert splits > 10 or size != "61"
