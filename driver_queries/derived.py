"""Catalog, log and state tables derived from the driver tables.

Plain SQL that Spark and DuckDB read alike; names in braces are tables. Every
ten orders make one catalog table, each order a column, partition and constraint
of it, each line item a key column or subpartition; events make log lines.
"""

from __future__ import annotations

# Catalog table number of an order key, its owner and its name.
_NUMBER = "CAST(FLOOR(%s / 10) AS BIGINT)"


def _owner(key: str) -> str:
    number = _NUMBER % key
    return (
        f"CASE {number} % 7 WHEN 0 THEN 'sys' WHEN 1 THEN 'Xdb' "
        f"ELSE 'OWN' || ({number} % 7) END"
    )


def _name(key: str) -> str:
    return f"'T' || {_NUMBER % key}"


def _own(key: str) -> str:
    return f"{_owner(key)} AS owner, {_name(key)} AS table_name"


def _moved(key: str) -> str:
    """A key whose table has partitions: those of every third table belong to the next one, so that some tables have none."""
    return f"({key} + CASE WHEN {_NUMBER % key} % 3 = 0 THEN 10 ELSE 0 END)"


DERIVED: dict[str, str] = {
    "numbered": f"""
        SELECT {_own("o_orderkey")}, {_NUMBER % "o_orderkey"} AS t, o_orderkey AS k,
               o_custkey, o_orderstatus, o_orderpriority, o_totalprice
        FROM {{orders}}""",
    "tables": """
        SELECT owner, table_name,
               CASE WHEN COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) < 2 THEN NULL
                    ELSE t * 10 END AS num_rows,
               CASE WHEN COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) < 2 THEN NULL
                    ELSE 50 + t % 40 END AS avg_row_len,
               CASE WHEN COUNT(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) = 0 THEN 'Y'
                    WHEN COUNT(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) = 1 THEN NULL
                    ELSE 'N' END AS temporary
        FROM {numbered} GROUP BY owner, table_name, t""",
    "external_tables": """
        SELECT owner, table_name FROM {numbered} GROUP BY owner, table_name
        HAVING COUNT(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END) = 0""",
    "tab_cols": """
        SELECT owner, table_name,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'c''' || k ELSE 'C' || k END AS column_name,
               CASE k % 97 WHEN 0 THEN 'BFILE' WHEN 1 THEN 'ADDRESS_T' WHEN 2 THEN 'XMLTYPE'
                    WHEN 3 THEN 'SDO_GEOMETRY' WHEN 4 THEN 'ROWID' ELSE
               CASE k % 12 WHEN 0 THEN 'VARCHAR2' WHEN 1 THEN 'Date' WHEN 2 THEN 'CHAR'
                    WHEN 3 THEN 'TIMESTAMP(6)' WHEN 4 THEN 'TIMESTAMP(6) WITH TIME ZONE'
                    WHEN 5 THEN 'INTERVAL DAY(2) TO SECOND(6)' WHEN 6 THEN 'RAW'
                    WHEN 7 THEN 'BINARY_DOUBLE' WHEN 8 THEN 'CLOB' ELSE 'NUMBER' END
               END AS data_type,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
                    ELSE k END AS column_id,
               CASE WHEN o_orderstatus = 'O' THEN 'N' ELSE 'Y' END AS nullable,
               CASE WHEN o_custkey % 79 = 0 THEN NULL
                    ELSE CAST(o_custkey % 79 AS INT) END AS data_precision,
               CASE WHEN k % 50 = 49 THEN NULL ELSE CAST(k % 50 AS INT) - 12 END AS data_scale,
               CAST(o_custkey % 400 AS INT) AS char_length,
               CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'B' END AS char_used,
               CASE k % 97 WHEN 1 THEN 'HR' WHEN 2 THEN 'PUBLIC' WHEN 3 THEN 'MDSYS' END
                    AS data_type_owner,
               CASE WHEN o_totalprice > 450000 THEN 'YES' ELSE 'NO' END AS hidden_column
        FROM {numbered}""",
    "col_comments": f"""
        SELECT {_own("l_orderkey")}, 'C' || l_orderkey AS column_name,
               'seen in ' || COUNT(*) || ' lines' AS comments
        FROM {{lineitem}} GROUP BY l_orderkey""",
    "tab_comments": f"""
        SELECT {_own("p_partkey")}, MIN(p_name) AS comments FROM {{part}}
        GROUP BY {_owner("p_partkey")}, {_name("p_partkey")}""",
    "segments": f"""
        SELECT {_owner("l_suppkey")} AS owner, {_name("l_suppkey")} AS segment_name,
               l_partkey * 1024 AS bytes
        FROM {{lineitem}}""",
    "tab_partitions": f"""
        SELECT {_owner(_moved("o_orderkey"))} AS table_owner, {_name(_moved("o_orderkey"))} AS table_name,
               'P' || o_orderkey AS partition_name,
               1 + o_orderkey % 10 + {_moved("o_orderkey")} - o_orderkey AS partition_position
        FROM {{orders}}""",
    # The line items of odd orders divide the partition before their own, which stays whole.
    "tab_subpartitions": f"""
        SELECT {_owner(_moved("l_orderkey"))} AS table_owner, {_name(_moved("l_orderkey"))} AS table_name,
               'P' || (l_orderkey - l_orderkey % 2) AS partition_name,
               'SP' || l_linenumber || CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE 'B' END AS subpartition_name,
               8 - l_linenumber + 8 * (l_orderkey % 2) AS subpartition_position
        FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber""",
    "constraints": """
        SELECT owner, table_name, 'K' || k AS constraint_name,
               CASE o_orderpriority WHEN '2-HIGH' THEN 'P' WHEN '3-MEDIUM' THEN 'U'
                    WHEN '5-LOW' THEN 'U' WHEN '1-URGENT' THEN 'R' ELSE 'C' END AS constraint_type
        FROM {numbered}""",
    "cons_columns": f"""
        SELECT {_owner("l_orderkey")} AS owner, 'K' || l_orderkey AS constraint_name,
               'C' || l_partkey AS column_name, l_linenumber AS position
        FROM {{lineitem}}""",
    "virtual_columns": """
        SELECT owner, table_name, 'C' || k AS column_name
        FROM {numbered} WHERE o_totalprice < 60000""",
    "part_key_columns": """
        SELECT owner, table_name, 'C' || MIN(k) AS column_name
        FROM {numbered} GROUP BY owner, table_name""",
    "subpart_key_columns": """
        SELECT owner, table_name, 'C' || MAX(k) AS column_name
        FROM {numbered} GROUP BY owner, table_name""",
    "table_overrides": f"""
        SELECT CASE WHEN s_acctbal > 4000 THEN o || '.' || n ELSE UPPER(o || '.' || n) END AS key,
               CASE WHEN s_nationkey < 8 THEN 'whole' WHEN s_nationkey < 16 THEN 'range' END
                    AS strategy
        FROM (SELECT {_owner("s_suppkey * 10")} AS o, {_name("s_suppkey * 10")} AS n, s_acctbal,
                     s_nationkey FROM {{supplier}}) s""",
    "column_overrides": f"""
        SELECT CASE WHEN p_size > 25 THEN o || '.' || n || '.' || c
                    ELSE UPPER(o || '.' || n || '.' || c) END AS key,
               CASE WHEN p_type = 'SMALL' THEN NULL ELSE 'trim({{{{column}}}})' END AS expression,
               CASE WHEN p_brand < 'Brand#2' THEN NULL ELSE 'int32' END AS target
        FROM (SELECT {_owner("p_partkey")} AS o, {_name("p_partkey")} AS n,
                     'C' || p_partkey AS c, p_size, p_type, p_brand FROM {{part}}) p""",
    "catalog_columns": """
        SELECT owner, table_name, column_name, data_type, data_type_owner,
               column_id AS ordinal
        FROM {tab_cols} WHERE column_id IS NOT NULL AND hidden_column = 'NO'""",
    "log_lines": """
        SELECT 'log-' || (user_id % 8) AS file, CAST(FLOOR(event_id / 1000) AS BIGINT) AS block,
               event_id AS seq,
               CASE event_type
                    WHEN 'view' THEN 'ORA-39083: Object type TABLE:"S' || (user_id % 7) || '"."T'
                         || CAST(FLOOR(value) AS BIGINT) || '" failed to create'
                    WHEN 'click' THEN 'ORA-00959: tablespace ''ts_' || CAST(FLOOR(value) AS BIGINT)
                         || ''' does not exist'
                    WHEN 'purchase' THEN 'ora-01950: no privileges on tablespace ''Quota_'
                         || user_id || ''''
                    WHEN 'signup' THEN 'IMP-00003: ORACLE error 942, then ORA-00942 and ORA-'
                         || (1000 + user_id)
                    ELSE 'IMP-000' || (10 + user_id % 40) || ': near ' || props END AS line
        FROM {events}""",
    "legacy_lines": """
        SELECT 'log-' || (user_id % 8) AS file, CAST(FLOOR(event_id / 1000) AS BIGINT) AS block,
               event_id AS seq,
               CASE event_type
                    WHEN 'view' THEN '"CREATE GLOBAL TEMPORARY TABLE "S' || (user_id % 7) || '"."T'
                         || CAST(FLOOR(value) AS BIGINT) || '" (...)"'
                    WHEN 'click' THEN 'ORA-00959: tablespace ''ts_' || CAST(FLOOR(value) AS BIGINT)
                         || ''' does not exist'
                    ELSE 'IMP-00003: ORACLE error 959 encountered' END AS line
        FROM {events}""",
    "show_lines": """
        SELECT 'log-' || (user_id % 8) AS file, CAST(FLOOR(event_id / 1000) AS BIGINT) AS block,
               event_id AS seq,
               CASE event_type
                    WHEN 'signup' THEN '. importing ' || CASE user_id % 9 WHEN 0 THEN 'SYSTEM'
                         ELSE 'S' || (user_id % 9) END || '''s objects into X'
                    WHEN 'click' THEN '  . . importing table  "T' || CAST(FLOOR(value) AS BIGINT)
                         || '"   ' || user_id || ' rows'
                    ELSE 'Connected to: ' || props END AS line
        FROM {events}""",
    "ddl_statements": """
        SELECT 'ddl-' || (o_custkey % 60) AS file, CAST(FLOOR(o_orderkey / 1000) AS BIGINT) AS block,
               o_orderkey AS seq,
               CASE WHEN o_custkey % 60 < 20 OR (o_custkey % 60 < 40 AND o_orderstatus = 'F')
                    THEN 'CREATE ' || CASE WHEN o_orderstatus = 'P' THEN 'GLOBAL  TEMPORARY '
                         ELSE '' END || 'TABLE "' || CASE WHEN o_orderpriority = '5-LOW' THEN 'Sys'
                         ELSE 'Own' || (o_custkey % 60) END || '"."T""' || (o_orderkey % 500)
                         || '" ("A" NUMBER) TABLESPACE "ts_' || o_orderstatus || '"'
                    ELSE 'create table ' || CASE WHEN o_orderpriority = '5-LOW' THEN 'sys.'
                         ELSE 'own.' END || 't' || (o_orderkey % 500) || ' (a number) tablespace "'
                         || CASE WHEN o_orderpriority = '1-URGENT' THEN 'Users' ELSE
                         'data' || (o_custkey % 30) END || '"; CREATE TABLE plain.x$'
                         || (o_orderkey % 90) || ' (b date)' END AS statement
        FROM {orders}""",
    "states": """
        SELECT 'OWN.T' || o_custkey AS table_name, o_orderpriority AS chunk_name,
               CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'completed'
                    ELSE 'failed' END AS status,
               CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 3 END AS imported_rows,
               CASE WHEN o_orderstatus = 'F' AND o_totalprice < 250000 THEN o_orderkey * 3 END
                    AS output_rows,
               CASE WHEN o_orderstatus = 'F' AND o_totalprice >= 250000 THEN o_orderkey * 3 END
                    AS parquet_rows,
               CASE WHEN o_orderstatus = 'P' THEN 'ORA-0' || o_custkey END AS error,
               o_orderkey AS seq
        FROM {orders}""",
    "state_plan": """
        SELECT DISTINCT 'OWN.T' || o_custkey AS table_name, o_orderpriority AS chunk_name
        FROM {orders}
        UNION ALL SELECT 'OWN.T' || c_custkey, 'whole' FROM {customer}""",
    "plan_tables": """
        SELECT owner, table_name,
               CASE WHEN temporary = 'Y' THEN 'unsupported' WHEN temporary IS NULL THEN 'whole_table'
                    ELSE 'partition' END AS strategy,
               CASE WHEN temporary = 'Y' THEN 'temporary ' || table_name END AS reason
        FROM {tables}""",
    "chunk_results": """
        SELECT owner, table_name, 'P' || k AS chunk,
               CASE WHEN o_totalprice > 400000 THEN 'failed' ELSE 'completed' END AS status,
               o_custkey AS input_rows, o_custkey AS output_rows,
               '/out/' || owner || '/' || table_name || '/P' || k AS output_path,
               CASE WHEN o_totalprice > 400000 THEN 'overflow in ' || k END AS error
        FROM {numbered}""",
}
