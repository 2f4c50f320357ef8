"""Import-log and DDL analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from tablelift.operators import logs

MISSING_SQL = (
    r"upper(regexp_extract(line, 'ORA-00959:\s+tablespace\s+''([^'']+)''\s+does\s+not\s+exist', 1,"
    r" 'i'))"
)
MODERN_SQL = (
    r"CASE WHEN regexp_matches(line, 'ORA-39083:\s+Object\s+type\s+\S+\s*:\s*"
    r'"[^"]+"\."[^"]+"'
    r"', 'i') THEN regexp_extract(line, '"
    r'"([^"]+)"\."[^"]+"'
    r"', 1) || '.' || regexp_extract(line, '"
    r'"[^"]+"\."([^"]+)"'
    r"', 1) END"
)
LEGACY_SQL = MODERN_SQL.replace(
    r"ORA-39083:\s+Object\s+type\s+\S+\s*:\s*", r"\bCREATE\s+(GLOBAL\s+TEMPORARY\s+)?TABLE\s+"
).replace("regexp_extract(line, '\"", "regexp_extract(line, 'TABLE \"")


def _attributed(lines: str, header: str) -> str:
    return f"""SELECT file, seq, COALESCE(object, '<unknown>') AS object, tablespace FROM (
      SELECT file, seq, header, tablespace, last_value(header IGNORE NULLS) OVER (
        PARTITION BY file ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS object
      FROM (SELECT file, seq, {header} AS header, {MISSING_SQL} AS tablespace FROM {{{lines}}}))
    WHERE header IS NULL AND tablespace <> ''"""


@query("log_attribute_ffill", _attributed("log_lines", MODERN_SQL))
def log_attribute_ffill(spark: SparkSession, sf: str) -> DataFrame:
    return logs.attribute_errors(table(spark, sf, "log_lines")).select(
        "file", "seq", "object", "tablespace"
    )


@query(
    "log_attribute_ffill_legacy",
    _attributed("legacy_lines", LEGACY_SQL),
)
def log_attribute_ffill_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return logs.attribute_errors(table(spark, sf, "legacy_lines"), legacy=True).select(
        "file", "seq", "object", "tablespace"
    )


@query(
    "log_missing_tablespaces",
    f"""SELECT file, object, string_agg(DISTINCT tablespace, ',' ORDER BY tablespace)
      AS tablespaces FROM ({_attributed("log_lines", MODERN_SQL)}) GROUP BY file, object""",
)
def log_missing_tablespaces(spark: SparkSession, sf: str) -> DataFrame:
    missing = logs.missing_tablespaces(table(spark, sf, "log_lines"))
    return missing.groupBy("file", "object").agg(
        F.array_join(F.sort_array(F.collect_set("tablespace")), ",").alias("tablespaces")
    )


@query(
    "log_show_tables",
    r"""SELECT file, schema_name, table_name, MIN(seq) AS first_seq FROM (
      SELECT file, seq, t AS table_name, last_value(s IGNORE NULLS) OVER (PARTITION BY file
        ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS schema_name
      FROM (SELECT file, seq,
              CASE WHEN regexp_matches(trim(line), '^\.\s+importing\s+\S+''s\s+objects\s+into')
                THEN regexp_extract(trim(line), '^\.\s+importing\s+(\S+)''s\s', 1) END AS s,
              CASE WHEN regexp_matches(trim(line), '^\.\s+\.\s+importing\s+table\s+"[^"]+"')
                THEN regexp_extract(trim(line), '"([^"]+)"', 1) END AS t
            FROM {show_lines}))
    WHERE table_name IS NOT NULL AND schema_name IS NOT NULL AND schema_name <> 'SYSTEM'
    GROUP BY file, schema_name, table_name""",
)
def log_show_tables(spark: SparkSession, sf: str) -> DataFrame:
    return logs.shown_tables(table(spark, sf, "show_lines")).select(
        "file",
        F.col("schema").alias("schema_name"),
        F.col("table").alias("table_name"),
        F.col("seq").alias("first_seq"),
    )


@query(
    "log_missing_quota",
    r"""SELECT DISTINCT file, upper(regexp_extract(line,
      'ORA-01950:\s+no\s+privileges\s+on\s+tablespace\s+''([^'']+)''', 1, 'i')) AS tablespace
    FROM {log_lines} WHERE regexp_matches(line, 'ORA-01950:', 'i')""",
)
def log_missing_quota(spark: SparkSession, sf: str) -> DataFrame:
    return logs.missing_quota(table(spark, sf, "log_lines"))


CODES_SQL = r"""SELECT DISTINCT file, CAST(unnest(regexp_extract_all(line, 'ORA-(\d{{4,5}})', 1, 'i'))
    AS INT) AS code FROM {log_lines}"""


@query(
    "log_ora_codes",
    f"""SELECT c.file, c.code, l.is_legacy FROM ({CODES_SQL}) c
    JOIN (SELECT file, bool_or(contains(line, 'ORA-39142') OR contains(line, 'ORA-39143'))
            AS is_legacy FROM {{log_lines}} GROUP BY file) l ON l.file = c.file""",
)
def log_ora_codes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "log_lines")
    return logs.ora_codes(lines).join(logs.is_legacy_dump(lines), "file")


BEHAVIOR_SQL = """CASE
    WHEN code IN (942, 1430, 1543, 1918, 1920, 4043, 4080, 28102) THEN 'skip'
    WHEN code IN (959, 1950, 54, 1000, 12170, 12514, 12537, 12541) THEN 'retry'
    WHEN code IN (39082, 39151) THEN 'warn' ELSE 'fatal' END"""
FATAL_SQL = "code IN (1017, 1031, 28000, 31693, 39083, 39126)"


@query(
    "log_classify_codes",
    f"""SELECT file, code, {BEHAVIOR_SQL} AS behavior, {FATAL_SQL} AS listed_fatal
    FROM ({CODES_SQL})""",
)
def log_classify_codes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "log_lines")
    fatal = logs.fatal_codes(lines).withColumn("listed_fatal", F.lit(True))
    code = F.col("code")
    return (
        logs.ora_codes(lines)
        .join(fatal, ["file", "code"], "left")
        .select(
            "file", "code",
            logs.code_behavior(code).alias("behavior"),
            F.coalesce("listed_fatal", F.lit(False)).alias("listed_fatal"),
        )
    )


RUNS = """SELECT 'run-' || event_id AS file, CASE event_type WHEN 'view' THEN 'impdp'
    WHEN 'click' THEN 'imp' WHEN 'signup' THEN 'exp' WHEN 'error' THEN 'expdp' ELSE 'impdp' END AS tool,
    CAST(user_id % 6 AS INT) AS return_code FROM {events}"""


@query(
    "log_exit_class",
    f"""SELECT r.file, r.tool, r.return_code, CASE WHEN return_code = 0 THEN 'success'
      WHEN (tool = 'impdp' AND return_code IN (2, 5) OR tool IN ('imp', 'exp') AND return_code = 2)
        AND f.file IS NULL THEN 'warning' ELSE 'fatal' END AS exit_class
    FROM ({RUNS}) r LEFT JOIN (SELECT DISTINCT file FROM (
        SELECT 'run-' || seq AS file, CAST(unnest(regexp_extract_all(line, 'ORA-(\\d{{{{4,5}}}})', 1,
          'i')) AS INT) AS code FROM {{log_lines}}) WHERE {FATAL_SQL}) f ON f.file = r.file""",
)
def log_exit_class(spark: SparkSession, sf: str) -> DataFrame:
    """Every log line taken as the output of a tool run of its own."""
    runs = spark.sql(RUNS, events=table(spark, sf, "events"))
    lines = table(spark, sf, "log_lines")
    return logs.classify_exits(
        runs, lines.withColumn("file", F.concat(F.lit("run-"), "seq"))
    )


HARMLESS_SQL = """('IMP-00003', 'IMP-00017', 'IMP-00041', 'IMP-00098', 'IMP-00403', 'ORA-00942',
    'ORA-01435', 'ORA-04043', 'ORA-04080', 'ORA-23308')"""


@query(
    "log_imp_classify",
    f"""SELECT file, known_nonfatal, unknown, known_nonfatal <> '' OR unknown <> '' AS has_codes,
      CASE WHEN known_nonfatal = '' AND unknown = '' THEN 'error'
           WHEN unknown <> '' THEN 'warning' ELSE 'info' END AS level
    FROM (SELECT l.file,
        COALESCE(string_agg(DISTINCT CASE WHEN code IN {HARMLESS_SQL} THEN code END, ','
          ORDER BY CASE WHEN code IN {HARMLESS_SQL} THEN code END), '') AS known_nonfatal,
        COALESCE(string_agg(DISTINCT CASE WHEN code NOT IN {HARMLESS_SQL} THEN code END, ','
          ORDER BY CASE WHEN code NOT IN {HARMLESS_SQL} THEN code END), '') AS unknown
      FROM (SELECT DISTINCT 'user-' || (seq % 150) AS file FROM {{log_lines}}) l
      LEFT JOIN (SELECT 'user-' || (seq % 150) AS file,
          unnest(regexp_extract_all(line, '(IMP-\\d+|ORA-\\d+)', 1)) AS code FROM {{log_lines}}) c
        ON c.file = l.file
      GROUP BY l.file)""",
)
def log_imp_classify(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "log_lines").withColumn(
        "file", F.concat(F.lit("user-"), F.col("seq") % 150)
    )
    return logs.classify_import_errors(lines).select(
        "file",
        F.array_join("known_nonfatal", ",").alias("known_nonfatal"),
        F.array_join("unknown", ",").alias("unknown"),
        "has_codes",
        "level",
    )


QUOTED_SQL = r"""SELECT file, seq, 1 AS form,
    replace(unnest(regexp_extract_all(statement, '\bCREATE\s+(?:GLOBAL\s+TEMPORARY\s+|PRIVATE\s+TEMPORARY\s+)?TABLE\s+"((?:[^"]|"")+)"\."((?:[^"]|"")+)"', 1, 'i')), '""', '"') AS schema_name,
    replace(unnest(regexp_extract_all(statement, '\bCREATE\s+(?:GLOBAL\s+TEMPORARY\s+|PRIVATE\s+TEMPORARY\s+)?TABLE\s+"((?:[^"]|"")+)"\."((?:[^"]|"")+)"', 2, 'i')), '""', '"') AS table_name
    FROM {ddl_statements}"""
PLAIN_SQL = r"""SELECT file, seq, 2 AS form,
    upper(unnest(regexp_extract_all(statement, '\bCREATE\s+(?:GLOBAL\s+TEMPORARY\s+|PRIVATE\s+TEMPORARY\s+)?TABLE\s+([A-Z_$#][A-Z0-9_$#]*)\.([A-Z_$#][A-Z0-9_$#]*)\b', 1, 'i'))) AS schema_name,
    upper(unnest(regexp_extract_all(statement, '\bCREATE\s+(?:GLOBAL\s+TEMPORARY\s+|PRIVATE\s+TEMPORARY\s+)?TABLE\s+([A-Z_$#][A-Z0-9_$#]*)\.([A-Z_$#][A-Z0-9_$#]*)\b', 2, 'i'))) AS table_name
    FROM {ddl_statements}"""


@query(
    "scan_ddl_tables",
    f"""WITH found AS (SELECT * FROM ({QUOTED_SQL} UNION ALL {PLAIN_SQL})
        WHERE upper(schema_name) NOT IN ('SYS', 'SYSTEM'))
    SELECT f.file, schema_name, table_name, MIN(seq) AS first_seq FROM found f
    JOIN (SELECT file, MIN(form) AS form FROM found GROUP BY file) b
      ON b.file = f.file AND b.form = f.form
    GROUP BY f.file, schema_name, table_name""",
)
def scan_ddl_tables(spark: SparkSession, sf: str) -> DataFrame:
    return logs.ddl_tables(table(spark, sf, "ddl_statements")).select(
        "file",
        F.col("schema").alias("schema_name"),
        F.col("table").alias("table_name"),
        F.col("seq").alias("first_seq"),
    )


@query(
    "scan_ddl_tablespaces",
    r"""SELECT DISTINCT file, tablespace FROM (SELECT file,
        upper(unnest(regexp_extract_all(statement, '\bTABLESPACE\s+"([^"]+)"', 1, 'i'))) AS tablespace
      FROM {ddl_statements})
    WHERE tablespace NOT IN ('SYSTEM', 'SYSAUX', 'USERS', 'TEMP', 'UNDOTBS1')""",
)
def scan_ddl_tablespaces(spark: SparkSession, sf: str) -> DataFrame:
    return logs.ddl_tablespaces(table(spark, sf, "ddl_statements"))


@query(
    "distinct_first",
    """SELECT user_id, event_type, MIN(event_id) AS event_id FROM events
    GROUP BY user_id, event_type""",
)
def distinct_first(spark: SparkSession, sf: str) -> DataFrame:
    return logs.first_seen(table(spark, sf, "events"), ["user_id", "event_type"], ["event_id"])
