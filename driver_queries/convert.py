"""Conversion, validation, ledger, resume, report and views."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.casts import ORDER_COLUMNS, TEXT_DECIMAL
from driver_queries.catalog import named, plain
from driver_queries.registry import query, scratch, shown, table
from driver_queries.scans import (
    BY_YEAR,
    LINE_COLUMNS,
    LINE_SQL,
    ORDERS_BY_YEAR,
    YEAR_CUSTOMER,
    year_chunk_sql,
    year_chunks,
)
from tablelift import engine
from tablelift.functions.types import ColumnSpec
from tablelift.operators import ledger as led
from tablelift.operators import report, validate
from tablelift.operators.partitions import ListPartitions, partition_catalog
from tablelift.sinks.files import read_output, write_output
from tablelift.sources.tables import list_files


def _work(table_name: str, strategy: str, chunks: list[str]) -> engine.TableWork:
    return engine.TableWork("SALES", table_name, strategy, [engine.Chunk(c) for c in chunks])


def _fresh(spark: SparkSession, sf: str, name: str) -> str:
    return f"{scratch(spark, sf, name)}-{datetime.datetime.now().timestamp():.6f}"


def convert_lines(spark: SparkSession, sf: str, output: str) -> DataFrame:
    """Line items by year into typed Parquet; one row per chunk with both counts."""
    source = engine.SourceTable(table(spark, sf, "lineitem"), LINE_COLUMNS, BY_YEAR)
    work = _work("LINEITEM", "partition", year_chunks())
    results = engine.convert_table(source, work, output, "parquet")
    failed = [r.error for r in results if r.error]
    if failed:
        raise RuntimeError("; ".join(failed))
    rows = [(r.chunk, r.status, r.input_rows, r.output_rows) for r in results]
    return spark.createDataFrame(
        rows, "chunk string, status string, input_rows bigint, output_rows bigint"
    )


_LINES_SQL = f"""SELECT {year_chunk_sql("l_shipdate")} AS chunk, 'completed' AS status,
    COUNT(*) AS input_rows, COUNT(*) AS output_rows FROM lineitem GROUP BY 1"""


@query("convert_lineitem", _LINES_SQL)
def convert_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return convert_lines(spark, sf, scratch(spark, sf, "convert_lineitem"))


@query(
    "convert_table",
    f"""SELECT chunk, COUNT(*) AS n_rows,
      CAST(SUM({TEXT_DECIMAL % ("o_totalprice", "15,1")}) AS VARCHAR) AS total,
      strftime(MAX(o_orderdate), '%Y-%m-%dT%H:%M:%S.%n') AS last_day FROM (
        SELECT *, regexp_replace({year_chunk_sql("o_orderdate")}, '^partition-(\\d+)-(.*)$',
          'subpartition-\\1-0000' || (1 + o_custkey % 4) || '-\\2-H' || (1 + o_custkey % 4))
          AS chunk FROM orders) GROUP BY chunk""",
)
def convert_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by year and customer bucket: every chunk in one job, read back and summed."""
    output = scratch(spark, sf, "convert_table")
    orders = table(spark, sf, "orders")
    source = engine.SourceTable(orders, ORDER_COLUMNS, YEAR_CUSTOMER)
    results = engine.convert_table(source, _work("ORDERS", "partition", YEAR_CUSTOMER.labels()), output, "parquet")
    failed = [r.error for r in results if r.error]
    if failed:
        raise RuntimeError("; ".join(failed))
    written = read_output(spark, "parquet", f"{output}/SALES/ORDERS")
    return shown(
        written.groupBy("chunk").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("o_totalprice").cast("decimal(38,1)").alias("total"),
            F.max("o_orderdate").alias("last_day"),
        )
    )


_TABLES = {
    "LINEITEM": ("lineitem", LINE_COLUMNS, BY_YEAR),
    "ORDERS": ("orders", ORDER_COLUMNS, ORDERS_BY_YEAR),
    "CUSTOMER": (
        "customer",
        (
            ColumnSpec("c_custkey", "NUMBER", 10, 0),
            ColumnSpec("c_name", "VARCHAR2(40)"),
            ColumnSpec("c_acctbal", "NUMBER", 12, 2),
        ),
        None,
    ),
    "REGION": (
        "region",
        (ColumnSpec("r_regionkey", "NUMBER", 4, 0), ColumnSpec("r_name", "VARCHAR2(20)")),
        None,
    ),
}


def _plan(spark: SparkSession) -> DataFrame:
    rows = []
    for name, (_, _, method) in _TABLES.items():
        if method is None:
            rows.append(("SALES", name, "whole_table", None, "whole", None, None))
            continue
        for i, part in enumerate(method.names(), 1):
            chunk = f"partition-{i:05d}-{part}"
            rows.append(("SALES", name, "partition", None, chunk, part, None))
    rows.append(("SALES", "FEED", "unsupported", "external table", None, None, None))
    rows.append(("SALES", "GONE", "whole_table", None, "whole", None, None))
    return spark.createDataFrame(
        rows,
        "schema string, table string, strategy string, reason string, chunk string, "
        "partition_name string, subpartition_name string",
    )


def _sources(spark: SparkSession, sf: str) -> dict[tuple[str, str], engine.SourceTable]:
    return {
        ("SALES", name): engine.SourceTable(table(spark, sf, file), columns, method)
        for name, (file, columns, method) in _TABLES.items()
    }


_PLAN_SQL = f"""SELECT 'LINEITEM' AS table_name, {year_chunk_sql("l_shipdate")} AS chunk,
      COUNT(*) AS output_rows FROM lineitem GROUP BY 2
    UNION ALL SELECT 'ORDERS', {year_chunk_sql("o_orderdate")}, COUNT(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'CUSTOMER', 'whole', COUNT(*) FROM customer
    UNION ALL SELECT 'REGION', 'whole', COUNT(*) FROM region"""


@query(
    "convert_plan",
    f"""SELECT table_name, 'successful' AS outcome, chunk, output_rows, NULL AS bad FROM ({_PLAN_SQL})
    UNION ALL SELECT 'FEED', 'skipped', NULL, NULL, NULL
    UNION ALL SELECT 'GONE', 'skipped', NULL, NULL, NULL
    UNION ALL SELECT 'PART', CASE WHEN p_type = 'SMALL' THEN 'failed' ELSE 'successful' END, chunk,
      CASE WHEN p_type <> 'SMALL' THEN COUNT(*) END,
      CASE WHEN p_type = 'SMALL' THEN COUNT(*) || ' of ' || COUNT(*) || ' rows cannot be converted' END
    FROM (SELECT CASE p_type WHEN 'SMALL' THEN 'SMALL' WHEN 'PROMO' THEN 'PROMO' ELSE 'REST' END AS p_type,
        CASE p_type WHEN 'SMALL' THEN 'partition-00001-SMALL' WHEN 'PROMO' THEN 'partition-00002-PROMO'
          ELSE 'partition-00003-REST' END AS chunk FROM part) GROUP BY p_type, chunk""",
)
def convert_plan(spark: SparkSession, sf: str) -> DataFrame:
    """All tables; of the parts, whose code is a brand where they are small, one chunk fails."""
    kinds = ListPartitions("p_type", [("SMALL", ["SMALL"]), ("PROMO", ["PROMO"]), ("REST", None)])
    chunks = [f"partition-{i:05d}-{n}" for i, n in enumerate(kinds.names(), 1)]
    rows = [("SALES", "PART", "partition", None, c, n, None) for c, n in zip(chunks, kinds.names(), strict=True)]
    plan = _plan(spark)
    plan = plan.unionByName(spark.createDataFrame(rows, plan.schema))
    code = F.when(F.col("p_type") == "SMALL", F.col("p_brand")).otherwise(F.col("p_partkey").cast("string"))
    parts = table(spark, sf, "part").withColumn("p_code", code)
    columns = (ColumnSpec("p_code", "NUMBER", 10, 0), ColumnSpec("p_name", "VARCHAR2(60)"))
    sources = {**_sources(spark, sf), ("SALES", "PART"): engine.SourceTable(parts, columns, kinds)}
    results = engine.convert_plan(
        spark, plan, sources, scratch(spark, sf, "convert_plan"), "parquet", raise_failures=False
    )
    reasons = results.where("status = 'failed'").select("table", "chunk", F.substring_index("error", ":", 1).alias("bad"))
    entries = report.report_entries(plan, results).join(reasons, ["table", "chunk"], "left")
    return entries.select(F.col("table").alias("table_name"), "outcome", "chunk", "output_rows", "bad")


_RUN = {
    "ORDERS": ((ColumnSpec("o_orderkey", "NUMBER", 10, 0), ColumnSpec("o_totalprice", "NUMBER", 15, 2)), ORDERS_BY_YEAR),
    "CUSTOMER": (_TABLES["CUSTOMER"][1], None),
    "NATION": ((ColumnSpec("n_nationkey", "NUMBER", 4, 0), ColumnSpec("n_name", "VARCHAR2(25)")), None),
    "REGION": (_TABLES["REGION"][1], None),
}


def _catalog(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Catalog frames of the tables of ``_RUN``."""
    key = "owner string, table_name string"
    columns = [
        ("SALES", t, c.name, c.data_type, i, "Y", c.precision, c.scale, 40, "B", None, "NO")
        for t, (specs, _) in _RUN.items() for i, c in enumerate(specs, 1)
    ]
    parts, subs = partition_catalog(table(spark, sf, "orders"), "SALES", "ORDERS", ORDERS_BY_YEAR)
    none = spark.createDataFrame
    return {
        "tables": spark.createDataFrame([("SALES", t, 1, 40, "N") for t in _RUN], f"{key}, num_rows int, avg_row_len int, temporary string"),
        "tab_cols": spark.createDataFrame(
            columns,
            f"{key}, column_name string, data_type string, column_id int, nullable string, data_precision int, data_scale int, "
            "char_length int, char_used string, data_type_owner string, hidden_column string",
        ),
        "col_comments": none([], f"{key}, column_name string, comments string"),
        "tab_comments": none([], f"{key}, comments string"),
        "external_tables": none([], key),
        "tab_partitions": parts,
        "tab_subpartitions": subs,
        "constraints": none([], f"{key}, constraint_name string, constraint_type string"),
        "cons_columns": none([], "owner string, constraint_name string, column_name string, position int"),
    }


@query(
    "resume_skip_completed",
    f"""SELECT 'ORDERS' AS table_name, {year_chunk_sql("o_orderdate")} AS chunk, COUNT(*) AS output_rows,
      bool_or(year(o_orderdate) = 1997) AS redone FROM orders GROUP BY 2
    UNION ALL SELECT 'CUSTOMER', 'whole', COUNT(*), true FROM customer
    UNION ALL SELECT 'NATION', 'whole', COUNT(*), false FROM nation
    UNION ALL SELECT 'REGION', 'whole', COUNT(*), true FROM region""",
)
def resume_skip_completed(spark: SparkSession, sf: str) -> DataFrame:
    """A run is repeated after the files of the customers and of one year of orders were written anew; regions have no files and
    no version. Nothing else is done again."""
    output = _fresh(spark, sf, "resume")
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    orders.write.partitionBy("y").parquet(f"{output}/in/orders")
    for name in ("customer", "nation"):
        table(spark, sf, name).write.parquet(f"{output}/in/{name}")
    regions = [tuple(r) for r in table(spark, sf, "region").select("r_regionkey", "r_name").collect()]  # five rows

    def run() -> DataFrame:
        read = lambda name: spark.read.parquet(f"{output}/in/{name}")
        frames = {
            ("SALES", "ORDERS"): (read("orders"), ORDERS_BY_YEAR),
            ("SALES", "CUSTOMER"): (read("customer"), None),
            ("SALES", "NATION"): (read("nation"), None),
            ("SALES", "REGION"): (spark.createDataFrame(regions, "r_regionkey int, r_name string"), None),
        }
        summary = engine.run(spark, _catalog(spark, sf), frames, f"{output}/work")
        if summary["statistics"]["tables_failed"]:
            raise RuntimeError("a table failed")
        files = list_files(spark, f"{output}/work/data").where(F.col("path").endswith(".parquet"))
        files = spark.createDataFrame(files.select("path").collect(), "path string")  # one row per chunk
        return files.select("path", *[F.regexp_extract("path", r"/SALES/([^/]*)/chunk=([^/]*)/", i + 1).alias(c) for i, c in enumerate(("table_name", "chunk"))])

    before = run()
    table(spark, sf, "customer").write.mode("overwrite").parquet(f"{output}/in/customer")
    table(spark, sf, "orders").where(F.year("o_orderdate") == 1997).write.mode("overwrite").parquet(f"{output}/in/orders/y=1997")
    redone = run().join(before, "path", "left_anti").select("table_name", "chunk", F.lit(True).alias("redone")).distinct()
    latest = led.ChunkLedger(spark, f"{output}/work/ledger").latest().where("output_rows > 0")
    done = latest.select(F.split_part("table_name", F.lit("."), F.lit(2)).alias("table_name"), F.col("chunk_name").alias("chunk"), "output_rows")
    return done.join(redone, ["table_name", "chunk"], "left").withColumn("redone", F.coalesce("redone", F.lit(False)))


@query(
    "reload_idempotent",
    f"SELECT {LINE_SQL}, {year_chunk_sql('l_shipdate')} AS chunk FROM lineitem",
)
def reload_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Converted twice; the rows are there once."""
    output = scratch(spark, sf, "reload")
    convert_lines(spark, sf, output)
    convert_lines(spark, sf, output)
    return shown(read_output(spark, "parquet", f"{output}/SALES/LINEITEM"))


@query(
    "validate_counts",
    """SELECT p.chunk, COUNT(o.o_orderkey) AS input_rows,
      COUNT(CASE WHEN o.o_totalprice <= 490000 THEN 1 END) AS output_rows,
      COUNT(o.o_orderkey) = COUNT(CASE WHEN o.o_totalprice <= 490000 THEN 1 END) AS valid,
      CASE WHEN COUNT(o.o_orderkey) <> COUNT(CASE WHEN o.o_totalprice <= 490000 THEN 1 END)
        THEN printf('row count mismatch for SALES.ORDERS %s: imported=%d, output=%d', p.chunk,
          COUNT(o.o_orderkey), COUNT(CASE WHEN o.o_totalprice <= 490000 THEN 1 END)) END AS problem
    FROM (SELECT 'F' AS chunk UNION ALL SELECT 'O' UNION ALL SELECT 'P' UNION ALL SELECT 'X') p
    LEFT JOIN orders o ON o.o_orderstatus = p.chunk GROUP BY p.chunk""",
)
def validate_counts(spark: SparkSession, sf: str) -> DataFrame:
    """An output that lost its dearest orders is caught, chunk by chunk."""
    path = scratch(spark, sf, "validate_counts")
    orders = table(spark, sf, "orders").withColumn("chunk", F.col("o_orderstatus"))
    write_output(orders.where("o_totalprice <= 490000"), "parquet", path, chunked=True)
    planned = spark.createDataFrame([("F",), ("O",), ("P",), ("X",)], "chunk string")
    counts = validate.compare_counts(
        planned,
        validate.count_rows(orders, ["chunk"], "input_rows"),
        validate.count_output_chunks(spark, "parquet", path),
    )
    problem = validate.mismatch_text(
        F.lit("SALES.ORDERS"), F.col("chunk"), F.col("input_rows"), F.col("output_rows")
    )
    return counts.withColumn("problem", F.when(~F.col("valid"), problem))


_LATEST_SQL = """SELECT table_name, chunk_name, status, imported_rows,
      COALESCE(output_rows, parquet_rows) AS output_rows, error
    FROM {states} QUALIFY row_number() OVER (PARTITION BY table_name, chunk_name
      ORDER BY seq DESC) = 1"""


@query("ledger_latest", _LATEST_SQL)
def ledger_latest(spark: SparkSession, sf: str) -> DataFrame:
    return led.latest_states(table(spark, sf, "states"))


@query(
    "ledger_upsert",
    """SELECT table_name, chunk_name, status, imported_rows, output_rows, error FROM (
      SELECT table_name, chunk_name, 'running' AS status, CAST(NULL AS BIGINT) AS imported_rows,
        CAST(NULL AS BIGINT) AS output_rows, CAST(NULL AS VARCHAR) AS error, 0 AS batch
      FROM {state_plan}
      UNION ALL SELECT 'OWN.T' || o_custkey, o_orderpriority, 'completed', COUNT(*), COUNT(*), NULL,
        1 FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey, o_orderpriority)
    QUALIFY row_number() OVER (PARTITION BY table_name, chunk_name ORDER BY batch DESC) = 1""",
)
def ledger_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches: every chunk running, then those with filled orders completed."""
    ledger = led.ChunkLedger(spark, _fresh(spark, sf, "ledger_upsert"))
    number = F.lit(None).cast("bigint")
    none = F.lit(None).cast("string").alias("error")
    ledger.append(
        table(spark, sf, "state_plan").select(
            *led.KEY, F.lit("running").alias("status"), number.alias("imported_rows"),
            number.alias("output_rows"), none,
        )
    )
    done = table(spark, sf, "states").where("status = 'completed'")
    ledger.append(
        done.groupBy(*led.KEY)
        .agg(F.count(F.lit(1)).alias("imported_rows"))
        .select(
            *led.KEY, F.lit("completed").alias("status"), "imported_rows",
            F.col("imported_rows").alias("output_rows"), none,
        )
    )
    return ledger.latest().select(*led.KEY, *led.STATE_COLUMNS)


@query(
    "ledger_reconcile",
    """SELECT table_name, chunk_name, status, output_rows FROM (
      SELECT 'OWN.T' || o_custkey AS table_name, o_orderpriority AS chunk_name, 'completed' AS status,
        COUNT(*) AS output_rows FROM orders GROUP BY o_custkey, o_orderpriority)
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE 'OWN.T' || c_custkey = table_name
                      AND c_acctbal < 0)
    UNION ALL SELECT 'OWN.T' || c_custkey, p, 'failed', NULL FROM customer
    JOIN (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) o ON o_custkey = c_custkey
    WHERE c_acctbal < 0""",
)
def ledger_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Records of all chunks; the ledger knows only chunks of customers in debt, as failed."""
    ledger = led.ChunkLedger(spark, _fresh(spark, sf, "ledger_reconcile"))
    debtors = table(spark, sf, "customer").where("c_acctbal < 0")
    keys = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").count()
    states = keys.select(
        "o_custkey",
        F.concat(F.lit("OWN.T"), "o_custkey").alias("table_name"),
        F.col("o_orderpriority").alias("chunk_name"),
        F.lit("completed").alias("status"),
        F.col("count").alias("imported_rows"),
        F.col("count").alias("output_rows"),
        F.lit(None).cast("string").alias("error"),
    )
    known = states.join(debtors, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    empty = F.lit(None).cast("bigint")
    ledger.append(
        known.withColumns(
            {"status": F.lit("failed"), "imported_rows": empty, "output_rows": empty}
        )
    )
    ledger.write_records(states)
    ledger.reconcile()
    return ledger.latest().select("table_name", "chunk_name", "status", "output_rows")


@query(
    "filter_pending_chunks",
    f"""SELECT p.table_name, p.chunk_name FROM {{state_plan}} p
    WHERE NOT EXISTS (SELECT 1 FROM ({_LATEST_SQL}) s WHERE s.table_name = p.table_name
      AND s.chunk_name = p.chunk_name AND s.status = 'completed')""",
)
def filter_pending_chunks(spark: SparkSession, sf: str) -> DataFrame:
    latest = led.latest_states(table(spark, sf, "states"))
    return led.pending_chunks(table(spark, sf, "state_plan"), latest)


@query(
    "resume_chunks",
    f"""SELECT p.table_name, p.chunk_name, s.table_name IS NULL AS redo,
      CASE WHEN s.table_name IS NOT NULL THEN COALESCE(imported_rows, 0) END AS imported_rows,
      CASE WHEN s.table_name IS NOT NULL THEN COALESCE(output_rows, 0) END AS output_rows
    FROM {{state_plan}} p LEFT JOIN (SELECT * FROM ({_LATEST_SQL}) WHERE status = 'completed') s
      ON s.table_name = p.table_name AND s.chunk_name = p.chunk_name""",
)
def resume_chunks(spark: SparkSession, sf: str) -> DataFrame:
    latest = led.latest_states(table(spark, sf, "states"))
    return led.resume_chunks(table(spark, sf, "state_plan"), latest)


_FINGERPRINT_SQL = """SELECT o_custkey, sha256('img' || chr(31) || 'C' || o_custkey || chr(31)
      || string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority)) AS fingerprint
    FROM orders GROUP BY o_custkey"""


@query(
    "fingerprint_inputs",
    f"""SELECT c_custkey, fingerprint, CASE WHEN c_acctbal < 0 THEN 'unverified'
      WHEN c_mktsegment = 'BUILDING' THEN 'mismatch' ELSE 'match' END AS verdict
    FROM ({_FINGERPRINT_SQL}) JOIN customer ON c_custkey = o_custkey""",
)
def fingerprint_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer: image, name and the sorted list of order priorities."""
    orders = table(spark, sf, "orders")
    seen = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        led.listed(F.collect_set("o_orderpriority")).alias("names")
    )
    current = led.fingerprint(F.lit("img"), F.concat(F.lit("C"), "c_custkey"), F.col("names"))
    df = seen.withColumn("fingerprint", current).join(table(spark, sf, "customer"), "c_custkey")
    recorded = (
        F.when(F.col("c_acctbal") < 0, "")
        .when(F.col("c_mktsegment") == "BUILDING", F.sha2(F.col("c_name"), 256))
        .otherwise(F.col("fingerprint"))
    )
    verdict = led.fingerprint_check(recorded, F.col("fingerprint"))
    return df.select("c_custkey", "fingerprint", verdict.alias("verdict"))


_ENTRIES_SQL = """SELECT p.owner, p.table_name, p.strategy,
      CASE WHEN p.strategy = 'unsupported' OR r.chunk IS NULL THEN 'skipped'
           WHEN r.status = 'completed' THEN 'successful' ELSE 'failed' END AS outcome,
      r.chunk, CASE WHEN r.status = 'completed' THEN r.output_rows END AS output_rows,
      CASE WHEN r.status = 'completed' THEN r.output_path END AS output_path,
      CASE WHEN p.strategy = 'unsupported' THEN p.reason WHEN r.chunk IS NULL THEN
             'Staging table was absent at convert time (typically: source dump did not '
             || 'contain exportable metadata for this table).'
           WHEN r.status <> 'completed' THEN r.error END AS reason
    FROM {plan_tables} p LEFT JOIN {chunk_results} r ON r.owner = p.owner
      AND r.table_name = p.table_name AND p.strategy <> 'unsupported'"""


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_entries(
        named(table(spark, sf, "plan_tables")), named(table(spark, sf, "chunk_results"))
    )


@query("join_plan_results", _ENTRIES_SQL)
def join_plan_results(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_entries(spark, sf))


@query(
    "report_statistics",
    f"""SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_output_rows, COUNT(*) AS tables_total,
      COUNT(CASE WHEN NOT skipped THEN 1 END) AS tables_converted,
      COUNT(CASE WHEN skipped THEN 1 END) AS tables_skipped,
      COUNT(CASE WHEN failed THEN 1 END) AS tables_failed
    FROM (SELECT owner, table_name, SUM(output_rows) AS n, bool_or(outcome = 'skipped') AS skipped,
            bool_or(outcome = 'failed') AS failed
          FROM ({_ENTRIES_SQL}) GROUP BY owner, table_name)""",
)
def report_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_statistics(_entries(spark, sf))


@query(
    "results_rollup",
    """SELECT CASE GROUPING(chunk) + GROUPING(table_name) WHEN 0 THEN 'chunk' WHEN 1 THEN 'table'
        ELSE 'plan' END AS level, owner, table_name, chunk,
      CAST(COALESCE(SUM(output_rows), 0) AS BIGINT) AS output_rows
    FROM {chunk_results}
    GROUP BY GROUPING SETS ((owner, table_name, chunk), (owner, table_name), ())""",
)
def results_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return plain(validate.results_rollup(named(table(spark, sf, "chunk_results"))))


@query(
    "materialize_view",
    f"""SELECT c_custkey, c_name, c_mktsegment, COUNT(o_orderkey) AS n_orders,
      CAST(SUM({TEXT_DECIMAL % ("o_totalprice", "15,2")}) AS VARCHAR) AS total_amount,
      strftime(MAX(o_orderdate), '%Y-%m-%dT%H:%M:%S.%n') AS last_order
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
)
def materialize_view(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts with their transactions counted and summed before the join."""
    per_customer = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("o_orderkey").alias("n_orders"),
            F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("total_amount"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    view = customer.join(per_customer, "c_custkey", "left").withColumn(
        "n_orders", F.coalesce("n_orders", F.lit(0).cast("bigint"))
    )
    return shown(engine.materialize_view(view, scratch(spark, sf, "view_summary")))


@query(
    "materialize_view_filter",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def materialize_view_filter(spark: SparkSession, sf: str) -> DataFrame:
    view = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    view = view.select("o_orderkey", "o_custkey", "o_totalprice")
    return engine.materialize_view(view, scratch(spark, sf, "view_filter"))


@query(
    "materialize_view_details",
    """SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name, n_name, r_name, c_acctbal
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def materialize_view_details(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation, region = (table(spark, sf, n) for n in ("customer", "nation", "region"))
    view = (
        customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .join(region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
        .select(
            "c_custkey",
            F.concat("c_name", F.lit(" "), "c_mktsegment").alias("full_name"),
            "n_name", "r_name", "c_acctbal",
        )
    )
    return engine.materialize_view(view, scratch(spark, sf, "view_details"))


@query(
    "materialize_view_accounts",
    """SELECT c_custkey, c_name, o_orderkey, o_orderstatus AS account_status, o_totalprice
    FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def materialize_view_accounts(spark: SparkSession, sf: str) -> DataFrame:
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    view = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", "o_orderkey",
        F.col("o_orderstatus").alias("account_status"), "o_totalprice",
    )
    return engine.materialize_view(view, scratch(spark, sf, "view_accounts"))
