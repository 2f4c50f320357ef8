"""The plans that matter at scale: what is read, shuffled and broadcast."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from driver_queries.registry import table
from driver_queries.scans import BY_YEAR, LINE_COLUMNS, YEAR_CUSTOMER
from tablelift.operators.ledger import latest_states
from tablelift.operators.partitions import assign, assign_by_reference, with_chunk
from tablelift.operators.project import project_columns
from tablelift.operators import logs
from tablelift.operators.validate import count_output_chunks, count_rows
from tablelift.sinks.files import by_chunk, write_output
from tablelift.sources.tables import scan_partition


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>(?:\n|$)", text, re.S)[1]))


def test_source_count_reads_only_the_key(spark):
    text = plan(count_rows(with_chunk(table(spark, SF_DIR, "lineitem"), BY_YEAR), ["chunk"]))
    assert read_columns(text) == {"l_shipdate"}
    assert "partial_count" in text


def test_conversion_is_one_scan_without_shuffle_or_python(spark):
    df = with_chunk(table(spark, SF_DIR, "lineitem"), BY_YEAR)
    text = plan(project_columns(df, LINE_COLUMNS, ["chunk"]))
    assert "Exchange" not in text
    assert "Python" not in text
    assert text.startswith("*(1)")


def test_write_shuffles_once_and_rebalances(spark):
    df = with_chunk(table(spark, SF_DIR, "orders"), YEAR_CUSTOMER)
    text = plan(by_chunk(df))
    assert text.count("Exchange") == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_unused_columns_are_not_read(spark):
    text = plan(project_columns(table(spark, SF_DIR, "lineitem"), LINE_COLUMNS[:2]))
    assert read_columns(text) == {"l_orderkey", "l_partkey"}


@pytest.fixture
def by_year(spark, tmp_path):
    path = str(tmp_path / "t")
    df = assign(table(spark, SF_DIR, "lineitem"), BY_YEAR).drop("partition_position")
    df.write.partitionBy("partition_name").parquet(path)
    return spark.read.parquet(path)


def test_one_partition_prunes_the_scan(by_year):
    text = plan(scan_partition(by_year, "P_1997").select("l_orderkey"))
    assert re.search(r"PartitionFilters: \[[^\]]*partition_name[^\]]*P_1997", text)
    assert read_columns(text) == {"l_orderkey"}


def test_filters_reach_the_scan(spark):
    df = project_columns(table(spark, SF_DIR, "orders"), ())
    assert df.columns == []
    orders = with_chunk(table(spark, SF_DIR, "orders"), YEAR_CUSTOMER)
    text = plan(orders.where("o_custkey > 10").select("chunk"))
    assert "GreaterThan(o_custkey,10)" in text


def test_output_count_reads_no_column(spark, tmp_path):
    path = str(tmp_path / "t")
    df = with_chunk(table(spark, SF_DIR, "orders"), YEAR_CUSTOMER)
    write_output(by_chunk(df), "parquet", path, chunked=True)
    assert "ReadSchema: struct<>" in plan(count_output_chunks(spark, "parquet", path))


def test_reference_join_carries_key_and_chunk_only(spark):
    joined = assign_by_reference(
        table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_linenumber"),
        table(spark, SF_DIR, "orders"),
        [("l_orderkey", "o_orderkey")],
        BY_YEAR.__class__("o_orderdate", BY_YEAR.parts),
    )
    text = plan(joined)
    scans = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert sorted(scans) == [
        "l_orderkey:bigint,l_linenumber:int", "o_orderkey:bigint,o_orderdate:timestamp_ntz",
    ]


def test_latest_state_reduces_before_the_shuffle(spark):
    text = plan(latest_states(table(spark, SF_DIR, "states")))
    assert "partial_max_by" in text
    assert "Window" not in text


def test_nothing_forces_a_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        from driver_queries import QUERIES

        for name in ("inspect_catalog", "plan_chunks", "override_lookup", "join_plan_results",
                     "log_missing_tablespaces", "antijoin_byte_columns"):
            df = QUERIES[name](spark, SF_DIR)
            df.collect()
            text = plan(df)
            assert "BroadcastHashJoin" not in text, name
            assert "NestedLoop" not in text, name
            assert "CartesianProduct" not in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_chunks_hold_every_row(spark):
    total = sum(r.n_rows for r in count_rows(
        with_chunk(table(spark, SF_DIR, "lineitem"), BY_YEAR), ["chunk"]).collect())
    assert total == table(spark, SF_DIR, "lineitem").agg(F.count("*")).first()[0]


def test_ddl_statements_are_scanned_once(spark):
    path_rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    statements = path_rows.select(F.col("source").alias("file"), F.col("text").alias("statement"), F.lit(0).alias("block"), F.col("doc_id").alias("seq"))
    text = plan(logs.ddl_tables(statements))
    assert text.count("FileScan") == text.count("Generate ") == 1
