"""Oracle-shaped tables with generated rows, their catalog frames and partition methods."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.operators.partitions import (
    DEFAULT,
    MAXVALUE,
    CompositePartitions,
    HashPartitions,
    IntervalPartitions,
    ListPartitions,
    RangePartitions,
    assign_by_reference,
    partition_catalog,
)

LONG_NAME = "LONG_TABLE_NAME_" + "X" * 100

# rows, then "NAME TYPE" per column
TABLES: dict[tuple[str, str], tuple[int, str]] = {
    ("HRDATA", "DEPARTMENTS"): (5, "DEPT_ID NUMBER(6), DEPT_NAME VARCHAR2(60), LOCATION VARCHAR2(100), MANAGER_ID NUMBER(6)"),
    ("HRDATA", "JOBS"): (10, "JOB_ID VARCHAR2(10), JOB_TITLE VARCHAR2(50), MIN_SALARY NUMBER(8,2), MAX_SALARY NUMBER(8,2)"),
    ("HRDATA", "EMPLOYEES"): (30, "EMP_ID NUMBER(6), FIRST_NAME VARCHAR2(40), HIRE_DATE DATE, SALARY NUMBER(8,2), COMMISSION_PCT NUMBER(2,2), STATUS CHAR(1), TENURE INTERVAL YEAR(2) TO MONTH, BIO NCLOB"),
    ("HRDATA", "EMP_PREFERENCES"): (30, "EMP_ID NUMBER(6), PREF_KEY VARCHAR2(40), PREF_VALUE VARCHAR2(200)"),
    ("HRDATA", "MixedCase_Table"): (5, "CamelCase_Col VARCHAR2(50), SELECT VARCHAR2(50), camelcase_col VARCHAR2(50)"),
    ("HRDATA", LONG_NAME): (0, "ID NUMBER(8), PAYLOAD VARCHAR2(80)"),
    ("HRDATA", "DEPT_LOCATIONS"): (4, "LOC_ID NUMBER(6), CITY VARCHAR2(40)"),
    ("HRDATA", "DEPT_LOCATION_PHONES"): (4, "LOC_ID NUMBER(6), PHONE VARCHAR2(20)"),
    ("INVENTORY", "WAREHOUSES"): (3, "WAREHOUSE_ID NUMBER(4), COUNTRY_CODE CHAR(2), CAPACITY NUMBER(10)"),
    ("INVENTORY", "PRODUCTS"): (24, "PRODUCT_ID NUMBER(8), REGION VARCHAR2(10), UNIT_PRICE NUMBER(12,4), CREATED_DATE DATE"),
    ("INVENTORY", "STOCK_LEVELS"): (45, "STOCK_ID NUMBER(10), QUANTITY NUMBER(10), LAST_UPDATED TIMESTAMP(6)"),
    ("INVENTORY", "SUPPLIERS"): (10, "SUPPLIER_ID NUMBER(8), NAME VARCHAR2(80)"),
    ("INVENTORY", "SUPPLIER_NOTES"): (15, "NOTE_ID NUMBER(8), NOTE CLOB"),
    ("INVENTORY", "ORDERS"): (20, "ORDER_ID NUMBER, CUSTOMER_NAME VARCHAR2(80), ORDER_DATE DATE, ORDER_TOTAL NUMBER(12,2)"),
    ("INVENTORY", "ORDER_ITEMS"): (20, "ITEM_ID NUMBER, ORDER_ID NUMBER, QUANTITY NUMBER(10)"),
    ("INVENTORY", "PRODUCT_SPECS"): (10, "SPEC_ID NUMBER(8), SPEC JSON"),
    ("INVENTORY", "STORE_LOCATIONS"): (3, "STORE_ID NUMBER(8), LOCATION SDO_GEOMETRY"),
    ("FINANCE", "ACCOUNTS"): (20, "ACCOUNT_ID NUMBER(8), EMP_ID NUMBER(6), ACCOUNT_TYPE VARCHAR2(20), BALANCE NUMBER(14,2), NOTES CLOB"),
    ("FINANCE", "TRANSACTIONS"): (100, "TXN_ID NUMBER(10), ACCOUNT_ID NUMBER(8), TXN_DATE DATE, TXN_TS TIMESTAMP(6) WITH TIME ZONE, AMOUNT NUMBER(12,2), DURATION INTERVAL DAY(2) TO SECOND(0)"),
    ("FINANCE", "MV_ACCOUNT_SUMMARY"): (20, "ACCOUNT_ID NUMBER(8), TXN_COUNT NUMBER, TOTAL_AMOUNT NUMBER(38,2)"),
    ("FINANCE", "NUMERIC_EDGE"): (3, "ROW_ID NUMBER(8), BIG38 NUMBER(38), UNBOUNDED NUMBER, SMALL_DEC NUMBER(5,4), NEG_SCALE NUMBER(10,-2), NEG_SCALE_WIDE NUMBER(20,-2), FRAC_SCALE NUMBER(2,5), LEGACY_FLOAT FLOAT(126)"),
    ("FINANCE", "WIDE_DECIMALS"): (3, "ROW_ID NUMBER(10), N_NEG NUMBER(38,-10), N_NEG2 NUMBER(30,-20), N_FRAC NUMBER(5,40), N_128 NUMBER(20,4)"),
    ("FINANCE", "TRANSACTION_DETAILS"): (80, "DETAIL_ID NUMBER(10), ACCOUNT_ID NUMBER(8), TXN_DATE DATE, AMOUNT NUMBER(12,2)"),
    ("FINANCE", "TRANSACTION_LINES"): (60, "LINE_ID NUMBER(10), DETAIL_ID NUMBER(10), DESCRIPTION VARCHAR2(200)"),
    ("FINANCE", "TRANSACTION_DOCS"): (5, "DOC_ID NUMBER(8), RAW_XML XMLTYPE"),
    ("FINANCE", "CHECK_NOT_NULL"): (5, "ID NUMBER, VAL NUMBER, NOTE VARCHAR2(80)"),
    ("AUDITLOG", "CHANGE_LOG"): (50, "LOG_ID NUMBER(10), CHANGED_AT TIMESTAMP(6) WITH LOCAL TIME ZONE, OLD_VALUES CLOB"),
    ("AUDITLOG", "EVENT_STREAM"): (60, "EVENT_ID NUMBER(10), EVENT_TIME DATE, PAYLOAD VARCHAR2(200)"),
    ("AUDITLOG", "LONG_NOTES"): (5, "ID NUMBER(8), NOTE LONG"),
    ("AUDITLOG", "LONG_BLOBS"): (5, "ID NUMBER(8), PAYLOAD LONG RAW"),
    ("AUDITLOG", "GTT_STAGING"): (0, "STAGE_ID NUMBER(10), STAGE_KEY VARCHAR2(60)"),
    ("INVENTORY", "EXT_PRICE_FEED"): (7, "PRICE_ID NUMBER(8), UNIT_PRICE NUMBER(12,4)"),
    ("AUDITLOG", "ATTACHMENTS"): (2, "ID NUMBER(8), FILE_REF BFILE"),
    ("FINANCE", "CUSTOMER_PROFILE"): (2, "ID NUMBER(8), ADDR ADDRESS_T"),
    ("HRDATA", "EMP_TAGS"): (2, "ID NUMBER(8), TAGS TAG_LIST"),
}

TEMPORARY = ("AUDITLOG", "GTT_STAGING")
EXTERNAL = ("INVENTORY", "EXT_PRICE_FEED")
SKIPPED = {
    TEMPORARY, EXTERNAL, ("AUDITLOG", "ATTACHMENTS"), ("FINANCE", "CUSTOMER_PROFILE"),
    ("HRDATA", "EMP_TAGS"),
}

_DETAILS = CompositePartitions(
    RangePartitions(
        "TXN_DATE",
        [
            ("P_2024", datetime.datetime(2025, 1, 1)),
            ("P_2025", datetime.datetime(2026, 1, 1)),
            ("P_MAX", MAXVALUE),
        ],
    ),
    HashPartitions(["ACCOUNT_ID"], ["S1", "S2", "S3", "S4"], integer_key=True),
)
METHODS = {
    ("INVENTORY", "PRODUCTS"): ListPartitions(
        "REGION", [("P_NORTH", ["R0"]), ("P_SOUTH", ["R1", "R2"]), ("P_INTL", DEFAULT)]
    ),
    ("FINANCE", "TRANSACTIONS"): RangePartitions(
        "TXN_DATE",
        [
            ("P_Q1", datetime.datetime(2024, 4, 1)), ("P_Q2", datetime.datetime(2024, 7, 1)),
            ("P_Q3", datetime.datetime(2024, 10, 1)), ("P_Q4", datetime.datetime(2025, 1, 1)),
            ("P_MAX", MAXVALUE),
        ],
    ),
    ("AUDITLOG", "CHANGE_LOG"): HashPartitions(["LOG_ID"], ["H1", "H2", "H3", "H4"]),
    ("FINANCE", "TRANSACTION_DETAILS"): _DETAILS,
    ("AUDITLOG", "EVENT_STREAM"): IntervalPartitions(
        "EVENT_TIME", "P_INITIAL", datetime.date(2024, 1, 1)
    ),
}

_SPECIAL = {
    "N_NEG": "CASE id WHEN 0 THEN '12345678901234567890000000000' ELSE '-1E+20' END",
    "N_NEG2": "concat('1234567890123456789', id, repeat('0', 20))",
    "N_FRAC": "concat('1.234', id, 'E-37')",
    "UNBOUNDED": "cast(id + 0.5 AS decimal(38,1))",
    "REGION": "concat('R', id % 4)",
    "JOB_ID": "concat('J', id)",
    "TXN_DATE": "timestamp_ntz'2024-01-15 00:00:00' + make_dt_interval(cast(id * 11 AS int))",
    "EVENT_TIME": "timestamp_ntz'2023-11-15 00:00:00' + make_dt_interval(cast(id * 5 AS int))",
    "SPEC": "concat('{\"b\": ', id, ', \"a\": [1, null]}')",
    "LOCATION": "named_struct('gtype', 2001, 'elem_info', array(1, 1, 1), 'ordinates', "
                "array(cast(id AS double), 0.5D))",
    "RAW_XML": "concat('<d>', id, '</d>')",
    "EMP_ID": "id",
    "ACCOUNT_ID": "id % 20",
}


def columns_of(text: str) -> list[tuple[str, str, int | None, int | None]]:
    """(name, type, precision, scale) of ``NAME TYPE, ...``."""
    found = []
    for part in re.split(r",\s+(?=\w+ [A-Z])", text):
        name, kind = part.split(" ", 1)
        number = re.fullmatch(r"NUMBER(?:\((\d+)(?:,(-?\d+))?\))?", kind)
        if number:
            precision = int(number[1]) if number[1] else None
            scale = int(number[2]) if number[2] else (0 if precision else None)
            found.append((name, "NUMBER", precision, scale))
        else:
            found.append((name, re.sub(r"(CHAR2?|FLOAT)\(\d+\)", r"\1", kind), None, None))
    return found


def _value(table: tuple[str, str], name: str, kind: str, precision, scale) -> str:
    if name in _SPECIAL and not (name == "LOCATION" and table[1] != "STORE_LOCATIONS"):
        return _SPECIAL[name]
    if kind == "NUMBER":
        if precision == 2 and scale == 5:
            return "cast(id / 100000 AS decimal(5,5))"
        if scale and scale > 0:
            return f"cast(id % 10 / {10 ** min(scale, 4)} AS decimal({max(precision, scale)},{scale}))"
        return f"cast(id * {100 if scale and scale < 0 else 1} AS decimal(38,0))"
    if kind == "FLOAT":
        return "cast(id / 3 AS double)"
    if kind == "DATE" or kind == "TIMESTAMP(6)":
        return "timestamp_ntz'2020-02-29 12:00:00.000001' + make_dt_interval(cast(id AS int))"
    if kind.startswith("TIMESTAMP"):
        return "cast('2024-01-01 00:00:00' AS timestamp) + make_dt_interval(0, cast(id AS int))"
    if kind.startswith("INTERVAL YEAR"):
        return "make_ym_interval(1, cast(id % 12 AS int))"
    if kind.startswith("INTERVAL DAY"):
        return "make_dt_interval(0, cast(id AS int))"
    if kind == "LONG RAW":
        return "encode(concat('raw', id), 'UTF-8')"
    return f"CASE WHEN id % 7 = 6 THEN NULL ELSE concat('{name.lower()} \"', id, '\"\n') END"


def rows_of(spark: SparkSession, table: tuple[str, str]) -> DataFrame:
    count, text = TABLES[table]
    return spark.range(count).select(
        *[F.expr(_value(table, *c)).alias(c[0]) for c in columns_of(text)]
    )


def frames(spark: SparkSession) -> dict:
    """Readable rows and partition method of every table that can be read."""
    found = {}
    for table in TABLES:
        if table not in SKIPPED:
            found[table] = (rows_of(spark, table), METHODS.get(table))
    details = found["FINANCE", "TRANSACTION_DETAILS"][0]
    lines = found["FINANCE", "TRANSACTION_LINES"][0]
    chunked = assign_by_reference(lines, details, [("DETAIL_ID", "DETAIL_ID")], _DETAILS)
    found["FINANCE", "TRANSACTION_LINES"] = (chunked, None)
    return found


def catalog(spark: SparkSession) -> dict[str, DataFrame]:
    """The catalog frames of all tables, skipped ones too."""
    key = "owner string, table_name string"
    cols, tables = [], []
    for (owner, table), (count, text) in TABLES.items():
        if (owner, table) != EXTERNAL:
            tables.append((owner, table, count, 40, "Y" if (owner, table) == TEMPORARY else "N"))
        for i, (name, kind, precision, scale) in enumerate(columns_of(text), 1):
            user = "HRDATA" if kind in ("ADDRESS_T", "TAG_LIST") else None
            user = {"XMLTYPE": "PUBLIC", "SDO_GEOMETRY": "MDSYS"}.get(kind, user)
            cols.append((owner, table, name, kind, i, "Y", precision, scale, 40, "B", user, "NO"))
    cols.append(("FINANCE", "ACCOUNTS", "INTERNAL_NOTE", "VARCHAR2", None, "Y", None, None, 200,
                 "B", None, "YES"))
    parts = subs = None
    for table in [*METHODS, ("FINANCE", "TRANSACTION_LINES")]:
        method = METHODS.get(table, _DETAILS)
        p, s = partition_catalog(rows_of(spark, table), *table, method)
        parts = p if parts is None else parts.unionByName(p)
        subs = s if subs is None else subs.unionByName(s)
    empty = spark.createDataFrame
    return {
        "tables": spark.createDataFrame(
            tables, f"{key}, num_rows int, avg_row_len int, temporary string"
        ),
        "tab_cols": spark.createDataFrame(
            cols,
            f"{key}, column_name string, data_type string, column_id int, nullable string, "
            "data_precision int, data_scale int, char_length int, char_used string, "
            "data_type_owner string, hidden_column string",
        ),
        "col_comments": spark.createDataFrame(
            [("HRDATA", "JOBS", "JOB_ID", "the key")], f"{key}, column_name string, comments string"
        ),
        "tab_comments": empty([("HRDATA", "JOBS", "all jobs")], f"{key}, comments string"),
        "external_tables": empty([EXTERNAL], key),
        "tab_partitions": parts,
        "tab_subpartitions": subs,
        "constraints": empty(
            [("HRDATA", "EMP_PREFERENCES", "PK1", "P")],
            f"{key}, constraint_name string, constraint_type string",
        ),
        "cons_columns": empty(
            [("HRDATA", "PK1", "EMP_ID", 1), ("HRDATA", "PK1", "PREF_KEY", 2)],
            "owner string, constraint_name string, column_name string, position int",
        ),
    }
