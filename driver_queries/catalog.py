"""Catalog joins and aggregates, filters, manifest and plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from tablelift.operators import catalog as cat
from tablelift.plans import chunks

NAMED = {"owner": "schema", "table_name": "table"}
PLAIN = {"schema": "owner", "table": "table_name"}
NORMALIZED_SQL = r"regexp_replace(upper(data_type), '\(\d+\)', '', 'g')"
SHOWN_SQL = (
    "CASE WHEN contains(%s, '''') THEN '\"' || %s || '\"' ELSE '''' || %s || '''' END"
)
COLUMN_REASON_SQL = f"""CASE
    WHEN {NORMALIZED_SQL} = 'BFILE' THEN 'column ' || {SHOWN_SQL.replace("%s", "column_name")}
      || ' has unsupported type BFILE'
    WHEN {NORMALIZED_SQL} IN ('XMLTYPE', 'SDO_GEOMETRY') THEN NULL
    WHEN data_type_owner IS NOT NULL THEN 'column ' || {SHOWN_SQL.replace("%s", "column_name")}
      || ' has user-defined type ' || data_type_owner || '.' || data_type END"""
TYPED_SQL = """SELECT t.owner, t.table_name, CASE
      WHEN EXISTS (SELECT 1 FROM {external_tables} e
                   WHERE e.owner = t.owner AND e.table_name = t.table_name) THEN 'EXTERNAL'
      WHEN t.temporary = 'Y' THEN 'GTT' ELSE 'TABLE' END AS table_type
    FROM {tables} t"""
UNSUPPORTED_SQL = f"""SELECT t.owner, t.table_name, CASE
      WHEN table_type = 'EXTERNAL'
        THEN 'external table — LOCATION file not available in staging container'
      WHEN table_type = 'GTT' THEN 'global temporary table — data is session-scoped and does not '
        || 'round-trip through Data Pump export'
      ELSE (SELECT arg_min(reason, ordinal) FROM (SELECT *, {COLUMN_REASON_SQL} AS reason
              FROM {{catalog_columns}}) c WHERE reason IS NOT NULL AND c.owner = t.owner
              AND c.table_name = t.table_name) END AS unsupported_reason
    FROM ({TYPED_SQL}) t"""
STRATEGY_SQL = f"""SELECT u.owner, u.table_name, CASE
      WHEN unsupported_reason IS NOT NULL THEN 'unsupported'
      WHEN wanted = 'whole' THEN 'whole_table'
      WHEN wanted IS NOT NULL THEN 'unsupported'
      WHEN EXISTS (SELECT 1 FROM {{tab_partitions}} p WHERE p.table_owner = u.owner
                   AND p.table_name = u.table_name) THEN 'partition'
      ELSE 'whole_table' END AS strategy,
    CASE WHEN unsupported_reason IS NOT NULL THEN unsupported_reason
      WHEN wanted <> 'whole' THEN 'strategy ''' || wanted || ''' is not supported; use ''whole'' '
        || 'to override the default strategy for this table' END AS reason
    FROM (SELECT u.*, CASE WHEN e.key IS NOT NULL THEN e.strategy ELSE c.strategy END AS wanted
          FROM ({UNSUPPORTED_SQL}) u
          LEFT JOIN {{table_overrides}} e ON e.key = u.owner || '.' || u.table_name
          LEFT JOIN {{table_overrides}} c ON c.key = upper(u.owner || '.' || u.table_name)) u"""
PARTITION_CHUNKS_SQL = """SELECT p.table_owner AS owner, p.table_name,
      CASE WHEN s.subpartition_name IS NULL
        THEN printf('partition-%05d-%s', partition_position, p.partition_name)
        ELSE printf('subpartition-%05d-%05d-%s-%s', partition_position, subpartition_position,
                    p.partition_name, subpartition_name) END AS chunk,
      p.partition_name, s.subpartition_name
    FROM {tab_partitions} p LEFT JOIN {tab_subpartitions} s
      ON s.table_owner = p.table_owner AND s.table_name = p.table_name
      AND s.partition_name = p.partition_name"""


def named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(NAMED)


def plain(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(PLAIN)


def typed_tables(spark: SparkSession, sf: str) -> DataFrame:
    typed = cat.with_table_type(table(spark, sf, "tables"), table(spark, sf, "external_tables"))
    return named(typed.select("owner", "table_name", "table_type"))


def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    visible = cat.visible_columns(table(spark, sf, "tab_cols"))
    return named(
        visible.select(
            "owner", "table_name", "column_name", "data_type", "data_type_owner",
            F.col("column_id").alias("ordinal"),
        )
    )


def partitions(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "tab_partitions")
    return df.withColumnsRenamed({"table_owner": "schema", "table_name": "table"})


def subpartitions(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "tab_subpartitions")
    return df.withColumnsRenamed({"table_owner": "schema", "table_name": "table"})


@query(
    "filter_hidden_columns",
    """SELECT owner, table_name, column_name, column_id FROM {tab_cols}
    WHERE column_id IS NOT NULL AND hidden_column = 'NO'""",
)
def filter_hidden_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = cat.visible_columns(table(spark, sf, "tab_cols"))
    return df.select("owner", "table_name", "column_name", "column_id")


@query(
    "filter_system_schemas",
    """SELECT owner, table_name, column_name FROM {tab_cols}
    WHERE upper(owner) NOT IN ('ANONYMOUS', 'APPQOSSYS', 'AUDSYS', 'CTXSYS', 'DBSFWUSER', 'DBSNMP',
      'DIP', 'DVF', 'DVSYS', 'GGSYS', 'GSMADMIN_INTERNAL', 'GSMCATUSER', 'GSMUSER', 'LBACSYS',
      'MDSYS', 'OJVMSYS', 'OLAPSYS', 'ORDDATA', 'ORDPLUGINS', 'ORDSYS', 'OUTLN',
      'REMOTE_SCHEDULER_AGENT', 'SYS', 'SYS$UMF', 'SYSBACKUP', 'SYSDG', 'SYSKM', 'SYSRAC',
      'SYSTEM', 'WMSYS', 'XDB', 'XS$NULL')""",
)
def filter_system_schemas(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "tab_cols").where(cat.is_user_schema(F.col("owner")))
    return df.select("owner", "table_name", "column_name")


@query(
    "filter_unsupported_columns",
    f"""SELECT owner, table_name, column_name, {COLUMN_REASON_SQL} AS reason
    FROM {{catalog_columns}} WHERE {COLUMN_REASON_SQL} IS NOT NULL""",
)
def filter_unsupported_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = chunks.unsupported_columns(catalog_columns(spark, sf))
    return plain(df).select("owner", "table_name", "column_name", "reason")


@query("filter_unsupported_tables", UNSUPPORTED_SQL)
def filter_unsupported_tables(spark: SparkSession, sf: str) -> DataFrame:
    df = chunks.unsupported_tables(typed_tables(spark, sf), catalog_columns(spark, sf))
    return plain(df).select("owner", "table_name", "unsupported_reason")


@query(
    "filter_external_temporary",
    """SELECT owner, table_name, num_rows FROM {tables} t
    WHERE NOT EXISTS (SELECT 1 FROM {external_tables} x
                      WHERE x.owner = t.owner AND x.table_name = t.table_name)
      AND (t.temporary IS NULL OR t.temporary = 'N')""",
)
def filter_external_temporary(spark: SparkSession, sf: str) -> DataFrame:
    df = cat.real_tables(table(spark, sf, "tables"), table(spark, sf, "external_tables"))
    return df.select("owner", "table_name", "num_rows")


@query(
    "join_column_comments",
    """SELECT c.owner, c.table_name, c.column_name, c.data_type, m.comments
    FROM {tab_cols} c LEFT JOIN {col_comments} m ON m.owner = c.owner
      AND m.table_name = c.table_name AND m.column_name = c.column_name
    WHERE c.column_id IS NOT NULL AND c.hidden_column = 'NO'""",
)
def join_column_comments(spark: SparkSession, sf: str) -> DataFrame:
    columns = cat.visible_columns(table(spark, sf, "tab_cols"))
    df = cat.with_column_comments(columns, table(spark, sf, "col_comments"))
    return df.select("owner", "table_name", "column_name", "data_type", "comments")


@query(
    "join_table_comments",
    """SELECT t.owner, t.table_name, t.num_rows, m.comments FROM {tables} t
    LEFT JOIN {tab_comments} m ON m.owner = t.owner AND m.table_name = t.table_name""",
)
def join_table_comments(spark: SparkSession, sf: str) -> DataFrame:
    df = cat.with_table_comments(table(spark, sf, "tables"), table(spark, sf, "tab_comments"))
    return df.select("owner", "table_name", "num_rows", "comments")


@query(
    "join_constraints",
    """SELECT k.owner, k.table_name, k.constraint_name, k.constraint_type, c.column_name, c.position
    FROM {constraints} k JOIN {cons_columns} c
      ON c.owner = k.owner AND c.constraint_name = k.constraint_name
    WHERE k.constraint_type IN ('P', 'U')""",
)
def join_constraints(spark: SparkSession, sf: str) -> DataFrame:
    return cat.key_columns(
        table(spark, sf, "constraints"), table(spark, sf, "cons_columns"), ["P", "U"]
    )


BYTE_COLUMNS_SQL = """SELECT tc.owner, tc.table_name, tc.column_name, tc.data_type, tc.char_length
    FROM {tab_cols} tc JOIN {tables} t ON t.owner = tc.owner AND t.table_name = tc.table_name
    WHERE tc.data_type IN ('VARCHAR2', 'CHAR') AND tc.char_used = 'B'
      AND NOT EXISTS (SELECT 1 FROM {external_tables} x
                      WHERE x.owner = t.owner AND x.table_name = t.table_name)
      AND (t.temporary IS NULL OR t.temporary = 'N')
      AND NOT EXISTS (SELECT 1 FROM {virtual_columns} v WHERE v.owner = tc.owner
                      AND v.table_name = tc.table_name AND v.column_name = tc.column_name)
      AND NOT EXISTS (SELECT 1 FROM {part_key_columns} p WHERE p.owner = tc.owner
                      AND p.table_name = tc.table_name AND p.column_name = tc.column_name)
      AND NOT EXISTS (SELECT 1 FROM {subpart_key_columns} s WHERE s.owner = tc.owner
                      AND s.table_name = tc.table_name AND s.column_name = tc.column_name)"""


@query("antijoin_byte_columns", BYTE_COLUMNS_SQL)
def antijoin_byte_columns(spark: SparkSession, sf: str) -> DataFrame:
    return cat.byte_columns(
        *(
            table(spark, sf, n)
            for n in (
                "tab_cols", "tables", "external_tables", "virtual_columns", "part_key_columns",
                "subpart_key_columns",
            )
        )
    )


@query(
    "byte_char_audit",
    """SELECT c AS column_name, n AS char_length, CAST(MAX(strlen(v)) AS INT) AS max_bytes,
      CAST(MAX(length(v)) AS INT) AS max_chars,
      CAST(COUNT(CASE WHEN strlen(v) > length(v) THEN 1 END) AS BIGINT) AS multibyte_rows,
      CAST(COUNT(CASE WHEN strlen(v) > n THEN 1 END) AS BIGINT) AS rows_over_bytes,
      CAST(COUNT(CASE WHEN length(v) > n THEN 1 END) AS BIGINT) AS rows_over_chars,
      COUNT(CASE WHEN strlen(v) > n THEN 1 END) > COUNT(CASE WHEN length(v) > n THEN 1 END)
        AS needs_widening
    FROM (SELECT 'text' AS c, 2000 AS n, text AS v FROM documents
          UNION ALL SELECT 'lang', 2, lang FROM documents
          UNION ALL SELECT 'source', 4, source FROM documents) GROUP BY c, n""",
)
def byte_char_audit(spark: SparkSession, sf: str) -> DataFrame:
    limits = {"text": 2000, "lang": 2, "source": 4}
    return cat.byte_char_audit(table(spark, sf, "documents"), limits)


SIZE_SQL = """SELECT t.owner, t.table_name, CAST(CASE WHEN COALESCE(b, 0) = 0
        THEN COALESCE(num_rows * avg_row_len, COALESCE(b, 0)) ELSE b END AS BIGINT)
        AS estimated_bytes
    FROM {tables} t LEFT JOIN (SELECT owner, segment_name, SUM(bytes) AS b FROM {segments}
      GROUP BY owner, segment_name) s ON s.owner = t.owner AND s.segment_name = t.table_name"""


@query("segment_bytes", SIZE_SQL)
def segment_bytes(spark: SparkSession, sf: str) -> DataFrame:
    df = cat.estimated_bytes(table(spark, sf, "tables"), table(spark, sf, "segments"))
    return df.select("owner", "table_name", "estimated_bytes")


PRIMARY_SQL = """SELECT k.owner, k.table_name,
      string_agg(c.column_name, ',' ORDER BY c.position, c.column_name) AS primary_key
    FROM {constraints} k JOIN {cons_columns} c
      ON c.owner = k.owner AND c.constraint_name = k.constraint_name
    WHERE k.constraint_type = 'P' GROUP BY k.owner, k.table_name"""
UNIQUE_SQL = """SELECT owner, table_name,
      string_agg(key, ';' ORDER BY constraint_name, key) AS unique_keys
    FROM (SELECT k.owner, k.table_name, k.constraint_name,
            string_agg(c.column_name, ',' ORDER BY c.position, c.column_name) AS key
          FROM {constraints} k JOIN {cons_columns} c
            ON c.owner = k.owner AND c.constraint_name = k.constraint_name
          WHERE k.constraint_type = 'U' GROUP BY k.owner, k.table_name, k.constraint_name)
    GROUP BY owner, table_name"""
PARTS_SQL = """SELECT owner, table_name,
      string_agg(position || '=' || name || '[' || subs || ']', ';' ORDER BY position, name)
        AS partitions
    FROM (SELECT p.table_owner AS owner, p.table_name, p.partition_name AS name,
            p.partition_position AS position, COALESCE(string_agg(s.subpartition_position || '='
              || s.subpartition_name, ',' ORDER BY s.subpartition_position,
              s.subpartition_name), '') AS subs
          FROM {tab_partitions} p LEFT JOIN {tab_subpartitions} s
            ON s.table_owner = p.table_owner AND s.table_name = p.table_name
            AND s.partition_name = p.partition_name
          GROUP BY p.table_owner, p.table_name, p.partition_name, p.partition_position)
    GROUP BY owner, table_name"""


def _parts_text(parts: str) -> Column:
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.concat(
                p.position, F.lit("="), p["name"], F.lit("["),
                F.array_join(
                    F.transform(
                        p.subpartitions, lambda s: F.concat(s.position, F.lit("="), s["name"])
                    ),
                    ",",
                ),
                F.lit("]"),
            ),
        ),
        ";",
    )


def _keys_text(keys: str) -> Column:
    return F.array_join(F.transform(keys, lambda k: F.array_join(k, ",")), ";")


@query("collect_primary_key", PRIMARY_SQL)
def collect_primary_key(spark: SparkSession, sf: str) -> DataFrame:
    df = cat.primary_keys(table(spark, sf, "constraints"), table(spark, sf, "cons_columns"))
    return df.withColumn("primary_key", F.array_join("primary_key", ","))


@query("collect_unique_keys", UNIQUE_SQL)
def collect_unique_keys(spark: SparkSession, sf: str) -> DataFrame:
    df = cat.unique_keys(table(spark, sf, "constraints"), table(spark, sf, "cons_columns"))
    return df.withColumn("unique_keys", _keys_text("unique_keys"))


@query("collect_subpartitions", PARTS_SQL)
def collect_subpartitions(spark: SparkSession, sf: str) -> DataFrame:
    df = cat.partition_lists(
        table(spark, sf, "tab_partitions"), table(spark, sf, "tab_subpartitions")
    )
    return df.withColumn("partitions", _parts_text("partitions"))


@query("table_type_classify", TYPED_SQL)
def table_type_classify(spark: SparkSession, sf: str) -> DataFrame:
    return plain(typed_tables(spark, sf))


@query(
    "inspect_catalog",
    f"""WITH described AS (
      SELECT z.owner, z.table_name, z.estimated_bytes, y.table_type, m.comments, t.num_rows,
        k.primary_key, u.unique_keys, p.partitions, c.column_list
      FROM ({SIZE_SQL}) z
      JOIN ({TYPED_SQL}) y ON y.owner = z.owner AND y.table_name = z.table_name
      JOIN {{tables}} t ON t.owner = z.owner AND t.table_name = z.table_name
      LEFT JOIN {{tab_comments}} m ON m.owner = z.owner AND m.table_name = z.table_name
      LEFT JOIN ({PRIMARY_SQL}) k ON k.owner = z.owner AND k.table_name = z.table_name
      LEFT JOIN ({UNIQUE_SQL}) u ON u.owner = z.owner AND u.table_name = z.table_name
      LEFT JOIN ({PARTS_SQL}) p ON p.owner = z.owner AND p.table_name = z.table_name
      LEFT JOIN (SELECT c.owner, c.table_name, string_agg(c.column_id || ':' || c.column_name || ':'
            || c.data_type || ':' || COALESCE(m.comments, ''), ';' ORDER BY c.column_id)
            AS column_list
          FROM {{tab_cols}} c LEFT JOIN {{col_comments}} m ON m.owner = c.owner
            AND m.table_name = c.table_name AND m.column_name = c.column_name
          WHERE c.column_id IS NOT NULL AND c.hidden_column = 'NO'
          GROUP BY c.owner, c.table_name) c
        ON c.owner = z.owner AND c.table_name = z.table_name)
    SELECT owner, table_name, estimated_bytes, CAST(num_rows AS BIGINT) AS row_count, table_type,
      comments AS note, COALESCE(primary_key, '') AS primary_key,
      COALESCE(unique_keys, '') AS unique_keys, COALESCE(partitions, '') AS partitions, column_list
    FROM described""",
)
def inspect_catalog(spark: SparkSession, sf: str) -> DataFrame:
    manifest = cat.inspect_catalog(
        **{
            n: table(spark, sf, n)
            for n in (
                "tables", "tab_cols", "col_comments", "tab_comments", "external_tables",
                "tab_partitions", "tab_subpartitions", "constraints", "cons_columns", "segments",
            )
        }
    )
    column_list = F.array_join(
        F.transform(
            "columns",
            lambda c: F.concat_ws(
                ":", c.ordinal, c["name"], c.data_type, F.coalesce(c.comment, F.lit(""))
            ),
        ),
        ";",
    )
    return manifest.select(
        F.col("schema").alias("owner"),
        F.col("name").alias("table_name"),
        "estimated_bytes", "row_count", "table_type",
        F.col("comment").alias("note"),
        F.array_join("primary_key", ",").alias("primary_key"),
        _keys_text("unique_keys").alias("unique_keys"),
        _parts_text("partitions").alias("partitions"),
        column_list.alias("column_list"),
    )


def _overrides(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "table_overrides")


@query("plan_strategy", STRATEGY_SQL)
def plan_strategy(spark: SparkSession, sf: str) -> DataFrame:
    return plain(
        chunks.plan_strategies(
            typed_tables(spark, sf),
            catalog_columns(spark, sf),
            partitions(spark, sf),
            _overrides(spark, sf),
        )
    )


@query(
    "plan_partitions",
    """SELECT p.table_owner AS owner, p.table_name, p.partition_name,
      printf('partition-%05d-%s', partition_position, p.partition_name) AS chunk
    FROM {tab_partitions} p
    WHERE NOT EXISTS (SELECT 1 FROM {tab_subpartitions} s
      WHERE s.table_owner = p.table_owner AND s.table_name = p.table_name
        AND s.partition_name = p.partition_name)""",
)
def plan_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """One chunk per partition, for all partitions that are not divided again."""
    divided = subpartitions(spark, sf)
    once = partitions(spark, sf).join(divided, ["schema", "table", "partition_name"], "left_anti")
    df = chunks.partition_chunks(once, divided)
    return plain(df).select("owner", "table_name", "partition_name", "chunk")


@query("plan_subpartitions", PARTITION_CHUNKS_SQL)
def plan_subpartitions(spark: SparkSession, sf: str) -> DataFrame:
    return plain(chunks.partition_chunks(partitions(spark, sf), subpartitions(spark, sf)))


PLAN_SQL = f"""SELECT s.owner, s.table_name, s.strategy, s.reason,
      CASE WHEN s.strategy = 'whole_table' THEN 'whole' ELSE c.chunk END AS chunk,
      c.partition_name, c.subpartition_name
    FROM ({STRATEGY_SQL}) s LEFT JOIN ({PARTITION_CHUNKS_SQL}) c
      ON c.owner = s.owner AND c.table_name = s.table_name AND s.strategy = 'partition'"""


def whole_plan(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.plan_chunks(
        typed_tables(spark, sf),
        catalog_columns(spark, sf),
        partitions(spark, sf),
        subpartitions(spark, sf),
        _overrides(spark, sf),
    )


@query("plan_chunks", PLAN_SQL)
def plan_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return plain(whole_plan(spark, sf))


@query(
    "scan_existing_only",
    f"""SELECT owner, table_name, chunk, true AS present FROM ({PLAN_SQL}) p
    WHERE EXISTS (SELECT 1 FROM {{tab_comments}} c
                  WHERE c.owner = p.owner AND c.table_name = p.table_name)
    UNION ALL SELECT DISTINCT owner, table_name, NULL, false FROM ({PLAN_SQL}) p
    WHERE NOT EXISTS (SELECT 1 FROM {{tab_comments}} c
                  WHERE c.owner = p.owner AND c.table_name = p.table_name)""",
)
def scan_existing_only(spark: SparkSession, sf: str) -> DataFrame:
    """Here a table exists in the source if it has a comment there."""
    there = named(table(spark, sf, "tab_comments").select("owner", "table_name"))
    present, missing = chunks.existing_only(whole_plan(spark, sf), there)
    columns = ["schema", "table", "chunk"]
    kept = present.select(*columns, F.lit(True).alias("present"))
    lost = missing.select(
        "schema", "table", F.lit(None).cast("string").alias("chunk"), F.lit(False).alias("present")
    )
    return plain(kept.unionByName(lost))
