"""Scans, partition methods, sinks and output counts."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.casts import TEXT_DECIMAL
from driver_queries.registry import query, scratch, shown, table
from tablelift import engine
from tablelift.functions.naming import safe_segment_col
from tablelift.functions.types import ColumnSpec
from tablelift.operators.partitions import (
    MAXVALUE,
    CompositePartitions,
    HashPartitions,
    IntervalPartitions,
    ListPartitions,
    RangePartitions,
    assign,
    assign_by_reference,
    with_chunk,
)
from tablelift.operators.project import project_columns
from tablelift.operators.validate import count_output, count_output_chunks, count_rows
from tablelift.sinks.files import by_chunk, read_output, write_empty_chunks, write_output
from tablelift.sinks.metrics import RunMetrics, chunk_metrics, metrics_by_phase, read_metrics
from tablelift.sources import tables as sources

LINE_COLUMNS = (
    ColumnSpec("l_orderkey", "NUMBER", 12, 0),
    ColumnSpec("l_partkey", "NUMBER", 24, 0),
    ColumnSpec("l_suppkey", "NUMBER", 12, 0),
    ColumnSpec("l_linenumber", "NUMBER", 4, 0),
    ColumnSpec("l_quantity", "NUMBER", 15, 2),
    ColumnSpec("l_extendedprice", "NUMBER", 15, 2),
    ColumnSpec("l_discount", "NUMBER", 15, 2),
    ColumnSpec("l_tax", "BINARY_DOUBLE"),
    ColumnSpec("l_returnflag", "CHAR(1)"),
    ColumnSpec("l_linestatus", "CHAR(1)"),
    ColumnSpec("l_shipdate", "DATE"),
)
LINE_SQL = f"""l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, l_suppkey,
    CAST(l_linenumber AS BIGINT) AS l_linenumber,
    CAST({TEXT_DECIMAL % ("l_quantity", "15,2")} AS VARCHAR) AS l_quantity,
    CAST({TEXT_DECIMAL % ("l_extendedprice", "15,2")} AS VARCHAR) AS l_extendedprice,
    CAST({TEXT_DECIMAL % ("l_discount", "15,2")} AS VARCHAR) AS l_discount,
    l_tax, l_returnflag, l_linestatus,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%n') AS l_shipdate"""

_YEARS = range(1995, 2001)
BY_YEAR = RangePartitions(
    "l_shipdate",
    [
        *((f"P_{y}", datetime.datetime(y + 1, 1, 1)) for y in _YEARS),
        ("P_MAX", MAXVALUE),
    ],
)
YEAR_SQL = "CASE " + " ".join(
    f"WHEN {{c}} < TIMESTAMP '{y + 1}-01-01' THEN '{{p}}{i:05d}{{m}}P_{y}'"
    for i, y in enumerate(_YEARS, 1)
) + f" ELSE '{{p}}{len(_YEARS) + 1:05d}{{m}}P_MAX' END"


def year_chunk_sql(column: str) -> str:
    return YEAR_SQL.format(c=column, p="partition-", m="-")


ORDERS_BY_YEAR = RangePartitions("o_orderdate", BY_YEAR.parts)
BY_CUSTOMER = HashPartitions(["o_custkey"], ["H1", "H2", "H3", "H4"], integer_key=True)
YEAR_CUSTOMER = CompositePartitions(ORDERS_BY_YEAR, BY_CUSTOMER)


def lines_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """Converted line items with their year chunk."""
    return project_columns(with_chunk(table(spark, sf, "lineitem"), BY_YEAR), LINE_COLUMNS, ["chunk"])


def year_chunks() -> list[str]:
    return [f"partition-{i:05d}-{name}" for i, name in enumerate(BY_YEAR.names(), 1)]


@query("scan_table", f"SELECT {LINE_SQL} FROM lineitem")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    df = sources.scan_table(spark, "parquet", f"{sf}/lineitem.parquet")
    return shown(project_columns(df, LINE_COLUMNS))


@query(
    "scan_partition",
    """SELECT l_orderkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""",
)
def scan_partition(spark: SparkSession, sf: str) -> DataFrame:
    """One partition of a dataset laid out by partition: only its directory is read."""
    path = scratch(spark, sf, "scan_partition")
    df = assign(table(spark, sf, "lineitem"), BY_YEAR).drop("partition_position")
    df.hint("rebalance", F.col("partition_name")).write.mode("overwrite").partitionBy(
        "partition_name"
    ).parquet(path)
    one = sources.scan_partition(sources.scan_table(spark, "parquet", path), "P_1997")
    return one.select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag")


@query(
    "scan_subpartition",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey % 4 = 2""",
)
def scan_subpartition(spark: SparkSession, sf: str) -> DataFrame:
    """The subpartition name wins: it is read in whichever partition it lies."""
    path = scratch(spark, sf, "scan_subpartition")
    df = assign(table(spark, sf, "orders"), YEAR_CUSTOMER)
    df = df.drop("partition_position", "subpartition_position")
    df.hint("rebalance", F.col("partition_name"), F.col("subpartition_name")).write.mode(
        "overwrite"
    ).partitionBy("partition_name", "subpartition_name").parquet(path)
    stored = sources.scan_table(spark, "parquet", path)
    return sources.scan_subpartition(stored, "H3", partition="P_1997").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@query(
    "scan_fileset",
    """SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice, true AS has_file FROM orders""",
)
def scan_fileset(spark: SparkSession, sf: str) -> DataFrame:
    """All files of one directory, named one by one."""
    path = scratch(spark, sf, "scan_fileset")
    table(spark, sf, "orders").repartition(4).write.mode("overwrite").parquet(path)
    files = [r["path"] for r in sources.list_files(spark, path).collect()]
    parts = [f for f in files if f.endswith(".parquet")]
    df = sources.scan_fileset(spark, "parquet", parts)
    return df.select(
        "o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice",
        F.col("source_file").endswith(".parquet").alias("has_file"),
    )


@query("sink_parquet", f"SELECT {LINE_SQL}, {year_chunk_sql('l_shipdate')} AS chunk FROM lineitem")
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, sf, "sink_parquet")
    df = lines_by_year(spark, sf)
    write_output(by_chunk(df), "parquet", path, chunked=True)
    return shown(read_output(spark, "parquet", path))


@query("sink_csv", "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents")
def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with line breaks and quotes survive the round trip."""
    path = scratch(spark, sf, "sink_csv")
    docs = table(spark, sf, "documents")
    write_output(docs, "csv", path)
    back = read_output(spark, "csv", path, docs.schema)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "sink_empty",
    """SELECT printf('partition-%05d-P%d', i, i) AS chunk, COUNT(o_orderkey) AS n_rows, true AS readable
    FROM (SELECT UNNEST(range(1, 501)) AS i) LEFT JOIN orders ON 1 + o_custkey % 7 = i GROUP BY i""",
)
def sink_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Five hundred chunks, of which seven have rows: each is a readable file with the columns."""
    path = scratch(spark, sf, "sink_empty")
    method = RangePartitions("part", [(f"P{i}", i + 1) for i in range(1, 501)])
    orders = table(spark, sf, "orders")
    parts = with_chunk(orders.withColumn("part", 1 + F.col("o_custkey") % 7), method).drop("part")
    write_output(by_chunk(parts), "parquet", path, chunked=True)
    filled = {r["chunk"] for r in count_output_chunks(spark, "parquet", path).collect()}
    names = [f"partition-{i:05d}-{n}" for i, n in enumerate(method.names(), 1)]
    write_empty_chunks(orders, "parquet", path, [n for n in names if n not in filled])
    # Any file without the columns fails this read; a chunk without a file is missing from the list.
    read = spark.read.schema(orders.schema).parquet(path).groupBy("chunk").agg(F.count("o_orderkey").alias("n_rows"))
    files = sources.list_files(spark, path).where(F.col("path").endswith(".parquet"))
    chunks = files.select(F.regexp_extract("path", r"/chunk=([^/]*)/", 1).alias("chunk")).distinct()
    return chunks.join(read, "chunk", "left").select("chunk", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.lit(True).alias("readable"))


@query(
    "sink_layout",
    """SELECT 'SALES/MKT%20' || c_nationkey % 3 || '%2A/' || CASE c_mktsegment WHEN 'AUTOMOBILE'
        THEN 'partition-00001-A%20uto' WHEN 'BUILDING' THEN 'partition-00002-B%2Fuild'
        ELSE 'partition-00003-REST' END || '.parquet' AS path, COUNT(*) AS n_rows
    FROM customer GROUP BY 1""",
)
def sink_layout(spark: SparkSession, sf: str) -> DataFrame:
    """The files that a conversion of three tables leaves under their final names, with their rows."""
    output = f"{scratch(spark, sf, 'sink_layout')}-{datetime.datetime.now().timestamp():.6f}"
    method = ListPartitions("c_mktsegment", [("A uto", ["AUTOMOBILE"]), ("B/uild", ["BUILDING"]), ("REST", None)])
    columns = (ColumnSpec("c_custkey", "NUMBER", 10, 0), ColumnSpec("c_name", "VARCHAR2(40)"))
    names = [f"MKT {i}*" for i in range(3)]
    rows = [("SALES", t, "partition", None, f"partition-{i:05d}-{n}", n, None) for t in names for i, n in enumerate(method.names(), 1)]
    plan = spark.createDataFrame(rows, "schema string, table string, strategy string, reason string, chunk string, partition_name string, subpartition_name string")
    customers = table(spark, sf, "customer").repartition(1)
    tables = {("SALES", t): engine.SourceTable(customers.where(F.col("c_nationkey") % 3 == i), columns, method, clustered=True) for i, t in enumerate(names)}
    results = engine.convert_plan(spark, plan, tables, f"{output}/data", "parquet")
    files = engine.publish_results(spark, results, f"{output}/data", f"{output}/files", "parquet")
    if engine.publish_results(spark, results, f"{output}/data", f"{output}/files", "parquet").count() != files.count():
        raise AssertionError("a second call changes the files")
    read = spark.read.option("recursiveFileLookup", "true").parquet(f"{output}/files")
    # file paths are URIs, whose percent signs stand for those of the names
    name = F.replace(F.substring_index(F.col("_metadata.file_path"), "/files/", -1), F.lit("%25"), F.lit("%"))
    return read.select(name.alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "sink_layout_names",
    """SELECT owner, table_name, column_name, '/out/' || url_encode(owner) || '/'
      || url_encode(table_name || ' ' || data_type || '/*~+') || '/' || url_encode(column_name)
      AS path FROM {tab_cols}""",
)
def sink_layout_names(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.concat("table_name", F.lit(" "), "data_type", F.lit("/*~+"))
    return table(spark, sf, "tab_cols").select(
        "owner", "table_name", "column_name",
        F.concat_ws(
            "/", F.lit("/out"), safe_segment_col(F.col("owner")), safe_segment_col(odd),
            safe_segment_col(F.col("column_name")),
        ).alias("path"),
    )


@query(
    "run_metrics",
    f"""SELECT 'count_source' AS what, 1 AS n, NULL::BIGINT AS input_rows, NULL::BIGINT AS output_rows, NULL::BOOLEAN AS measured
    UNION ALL SELECT 'write_chunks', 1, NULL, NULL, NULL UNION ALL SELECT 'read_back', 1, NULL, NULL, NULL
    UNION ALL SELECT 'convert_table', 1, NULL, NULL, NULL UNION ALL SELECT 'chunk', COUNT(DISTINCT {year_chunk_sql("o_orderdate")}), NULL, NULL, NULL FROM orders
    UNION ALL SELECT {year_chunk_sql("o_orderdate")}, 1, COUNT(*), COUNT(*), true FROM orders GROUP BY 1""",
)
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A conversion with its metrics: how often each phase ran, and rows, bytes and files of every chunk."""
    path = f"{scratch(spark, sf, 'run_metrics')}-{datetime.datetime.now().timestamp():.6f}"
    orders = table(spark, sf, "orders")
    metrics = RunMetrics(spark, f"{path}/metrics")
    columns = (ColumnSpec("o_orderkey", "NUMBER", 10, 0), ColumnSpec("o_totalprice", "NUMBER", 15, 2))
    present = [r[0] for r in with_chunk(orders, ORDERS_BY_YEAR).select("chunk").distinct().collect()]
    rows = [("SALES", "ORDERS", "partition", None, c, None, None) for c in present]
    plan = spark.createDataFrame(rows, "schema string, table string, strategy string, reason string, chunk string, partition_name string, subpartition_name string")
    engine.convert_plan(spark, plan, {("SALES", "ORDERS"): engine.SourceTable(orders, columns, ORDERS_BY_YEAR)}, f"{path}/data", metrics=metrics)
    kept = read_metrics(spark, f"{path}/metrics")
    none = F.lit(None).cast("bigint")
    phases = metrics_by_phase(kept).select(F.col("phase").alias("what"), F.col("n_runs").alias("n"), none.alias("input_rows"), none.alias("output_rows"), F.lit(None).cast("boolean").alias("measured"))
    good = (F.col("bytes") > 0) & (F.col("files") > 0) & (F.col("bad_rows") == 0) & (F.col("status") == "completed")
    chunks = chunk_metrics(kept).select(F.col("chunk").alias("what"), F.lit(1).cast("bigint").alias("n"), "input_rows", "output_rows", good.alias("measured"))
    return phases.unionByName(chunks)


@query(
    "count_rows",
    f"""SELECT {year_chunk_sql("l_shipdate")} AS chunk, COUNT(*) AS n_rows FROM lineitem
    GROUP BY 1""",
)
def count_rows_query(spark: SparkSession, sf: str) -> DataFrame:
    return count_rows(with_chunk(table(spark, sf, "lineitem"), BY_YEAR), ["chunk"])


def _count_written(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    path = scratch(spark, sf, f"count_output_{fmt}")
    docs = table(spark, sf, "documents").withColumn("chunk", F.concat(F.lit("p-"), "lang"))
    write_output(by_chunk(docs), fmt, path, chunked=True)
    per_chunk = count_output_chunks(spark, fmt, path)
    total = count_output(spark, fmt, path)
    return per_chunk.withColumn("total", F.lit(total).cast("bigint"))


_WRITTEN_SQL = """SELECT 'p-' || lang AS chunk, COUNT(*) AS output_rows,
    CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM documents GROUP BY lang"""


@query("count_output_parquet", _WRITTEN_SQL)
def count_output_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return _count_written(spark, sf, "parquet")


@query("count_output_csv", _WRITTEN_SQL)
def count_output_csv(spark: SparkSession, sf: str) -> DataFrame:
    return _count_written(spark, sf, "csv")


@query(
    "part_range",
    f"""SELECT {year_chunk_sql("l_shipdate")} AS chunk, COUNT(*) AS n_rows,
      CAST(SUM({TEXT_DECIMAL % ("l_extendedprice", "15,2")}) AS VARCHAR) AS total,
      strftime(MIN(l_shipdate), '%Y-%m-%dT%H:%M:%S.%n') AS first_day,
      strftime(MAX(l_shipdate), '%Y-%m-%dT%H:%M:%S.%n') AS last_day
    FROM lineitem GROUP BY 1""",
)
def part_range(spark: SparkSession, sf: str) -> DataFrame:
    df = with_chunk(table(spark, sf, "lineitem"), BY_YEAR)
    return shown(
        df.groupBy("chunk").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("total"),
            F.min("l_shipdate").alias("first_day"),
            F.max("l_shipdate").alias("last_day"),
        )
    )


@query(
    "part_list",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')
        THEN 'partition-00001-P_TECH' WHEN c_mktsegment = 'BUILDING' THEN 'partition-00002-P_BUILD'
        ELSE 'partition-00003-P_REST' END AS chunk,
      CASE WHEN c_custkey < 6000 THEN printf('partition-%05d-L%d', 1 + c_custkey % 2000, c_custkey % 2000)
        ELSE 'partition-02001-REST' END AS list_chunk FROM customer""",
)
def part_list(spark: SparkSession, sf: str) -> DataFrame:
    """A few lists, compared value by value, and two thousand, looked up in a table of their values."""
    segments = ListPartitions(
        "c_mktsegment",
        [("P_TECH", ["AUTOMOBILE", "MACHINERY"]), ("P_BUILD", ["BUILDING"]), ("P_REST", None)],
    )
    keys = ListPartitions("c_custkey", [*[(f"L{i}", [i, i + 2000, i + 4000]) for i in range(2000)], ("REST", None)])
    df = with_chunk(table(spark, sf, "customer"), keys).withColumnRenamed("chunk", "list_chunk")
    return with_chunk(df, segments).select("c_custkey", "chunk", "list_chunk")


@query(
    "part_hash",
    """SELECT o_orderkey, 'partition-0000' || (1 + o_custkey % 4) || '-H' || (1 + o_custkey % 4)
      AS chunk FROM orders""",
)
def part_hash(spark: SparkSession, sf: str) -> DataFrame:
    df = with_chunk(table(spark, sf, "orders"), BY_CUSTOMER)
    return df.select("o_orderkey", "chunk")


@query(
    "part_interval",
    """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-07-01'
        THEN 'partition-00001-P_INITIAL' ELSE printf('partition-%05d-SYS_P%04d%02d',
          2 + date_diff('month', TIMESTAMP '1996-07-01', date_trunc('month', o_orderdate)),
          year(o_orderdate), month(o_orderdate)) END AS chunk FROM orders""",
)
def part_interval(spark: SparkSession, sf: str) -> DataFrame:
    method = IntervalPartitions("o_orderdate", "P_INITIAL", datetime.date(1996, 7, 1))
    df = with_chunk(table(spark, sf, "orders"), method)
    return df.select("o_orderkey", "chunk")


_COMPOSITE_SQL = (
    YEAR_SQL.format(c="o_orderdate", p="subpartition-", m="@")
    .replace("@", "-0000' || (1 + o_custkey % 4) || '-")
    .replace("P_MAX'", "P_MAX-H' || (1 + o_custkey % 4)")
)
for _y in _YEARS:
    _COMPOSITE_SQL = _COMPOSITE_SQL.replace(f"P_{_y}'", f"P_{_y}-H' || (1 + o_custkey % 4)")


@query("part_composite", f"SELECT o_orderkey, {_COMPOSITE_SQL} AS chunk FROM orders")
def part_composite(spark: SparkSession, sf: str) -> DataFrame:
    df = with_chunk(table(spark, sf, "orders"), YEAR_CUSTOMER)
    return df.select("o_orderkey", "chunk")


_REFERENCE_SQL = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    {year_chunk_sql("o_orderdate")} AS chunk
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query("join_reference_partition", _REFERENCE_SQL)
def join_reference_partition(spark: SparkSession, sf: str) -> DataFrame:
    df = assign_by_reference(
        table(spark, sf, "lineitem"),
        table(spark, sf, "orders"),
        [("l_orderkey", "o_orderkey")],
        ORDERS_BY_YEAR,
    )
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "chunk")


@query(
    "part_reference",
    """SELECT chunk, COUNT(*) AS n_rows, COUNT(DISTINCT l_orderkey) AS n_parents FROM (
      SELECT l_orderkey, 'partition-0000' || (1 + l_orderkey % 4) || '-H' || (1 + l_orderkey % 4)
        AS chunk FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY chunk""",
)
def part_reference(spark: SparkSession, sf: str) -> DataFrame:
    """The parent is partitioned by a column of the key, so no join takes place."""
    method = HashPartitions(["o_orderkey"], ["H1", "H2", "H3", "H4"], integer_key=True)
    df = assign_by_reference(
        table(spark, sf, "lineitem"),
        table(spark, sf, "orders"),
        [("l_orderkey", "o_orderkey")],
        method,
    )
    return df.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("l_orderkey").alias("n_parents")
    )
