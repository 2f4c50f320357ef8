"""Type decisions, conversions, text forms and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries.registry import query, shown, table
from tablelift.functions import casts, text_forms
from tablelift.functions import types as tt
from tablelift.operators.project import project_columns, resolve_overrides

# The decision of a declared type, spelled out once more for the SQL side.
NUMBER_SQL = """CASE
    WHEN p IS NULL AND s <= 0 THEN 'decimal128(38,0)'
    WHEN p IS NULL THEN 'decimal128(38,' || CASE WHEN s > 38 THEN 38 ELSE s END || ')'
    WHEN s < 0 AND p - s > 76 THEN 'double'
    WHEN s < 0 AND p - s <= 18 THEN 'int64'
    WHEN s < 0 AND p - s <= 38 THEN 'decimal128(' || (p - s) || ',0)'
    WHEN s < 0 THEN 'decimal256(' || (p - s) || ',0)'
    WHEN s = 0 AND p <= 18 THEN 'int64'
    WHEN s = 0 AND p <= 38 THEN 'decimal128(' || p || ',0)'
    WHEN s = 0 AND p <= 76 THEN 'decimal256(' || p || ',0)'
    WHEN s = 0 THEN 'double'
    WHEN GREATEST(p, s) > 76 THEN 'double'
    WHEN GREATEST(p, s) <= 38 THEN 'decimal128(' || GREATEST(p, s) || ',' || s || ')'
    ELSE 'decimal256(' || GREATEST(p, s) || ',' || s || ')' END"""
TYPE_SQL = f"""CASE
    WHEN n = 'NUMBER' THEN {NUMBER_SQL}
    WHEN n IN ('FLOAT', 'BINARY_FLOAT', 'BINARY_DOUBLE') THEN 'double'
    WHEN n IN ('RAW', 'LONG RAW', 'BLOB') THEN 'binary'
    WHEN n IN ('DATE', 'TIMESTAMP') THEN 'timestamp_us'
    ELSE 'string' END"""
NORMALIZED_SQL = r"regexp_replace(upper(data_type), '\(\d+\)', '', 'g')"
# Decimal of the shortest text of a double, the rule for double inputs.
TEXT_DECIMAL = "CAST(CAST(CAST(%s AS VARCHAR) AS DECIMAL(24,8)) AS DECIMAL(%s))"


@query(
    "type_number",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {NUMBER_SQL} AS token
    FROM (SELECT *, CASE WHEN l_partkey % 91 = 90 THEN NULL ELSE 1 + l_partkey % 90 END AS p,
                 COALESCE(CASE WHEN l_suppkey % 100 = 99 THEN NULL ELSE l_suppkey % 100 - 40 END, 0)
                 AS s FROM lineitem)""",
)
def type_number(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    p = F.when(F.col("l_partkey") % 91 != 90, 1 + F.col("l_partkey") % 90)
    s = F.when(F.col("l_suppkey") % 100 != 99, F.col("l_suppkey") % 100 - 40)
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        tt.number_token_col(p, s).alias("token"),
    )


@query(
    "type_map",
    f"""SELECT owner, table_name, column_name, n AS normalized,
      COALESCE(target, {TYPE_SQL}) AS token,
      n IN ('NUMBER', 'FLOAT', 'BINARY_FLOAT', 'BINARY_DOUBLE', 'CHAR', 'NCHAR', 'VARCHAR2',
            'NVARCHAR2', 'CLOB', 'NCLOB', 'LONG', 'RAW', 'LONG RAW', 'BLOB', 'DATE', 'TIMESTAMP',
            'ANYDATA', 'INTERVAL DAY TO SECOND', 'INTERVAL YEAR TO MONTH', 'JSON', 'SDO_GEOMETRY',
            'TIMESTAMP WITH LOCAL TIME ZONE', 'TIMESTAMP WITH TIME ZONE', 'UROWID', 'XMLTYPE')
        AS known
    FROM (SELECT *, {NORMALIZED_SQL} AS n, data_precision AS p, COALESCE(data_scale, 0) AS s,
                 CASE WHEN char_length < 20 THEN 'float32' END AS target
          FROM {{tab_cols}})""",
)
def type_map(spark: SparkSession, sf: str) -> DataFrame:
    target = F.when(F.col("char_length") < 20, "float32")
    kind = F.col("data_type")
    return table(spark, sf, "tab_cols").select(
        "owner", "table_name", "column_name",
        tt.normalize_type_col(kind).alias("normalized"),
        tt.type_token_col(kind, F.col("data_precision"), F.col("data_scale"), target).alias("token"),
        tt.is_known_type_col(kind).alias("known"),
    )


ORDER_COLUMNS = (
    tt.ColumnSpec("o_orderkey", "NUMBER", 12, 0, "order number"),
    tt.ColumnSpec("o_custkey", "NUMBER", 24, 0),
    tt.ColumnSpec("o_orderstatus", "CHAR(1)"),
    tt.ColumnSpec("o_totalprice", "NUMBER", 15, 1, "price, one digit"),
    tt.ColumnSpec("o_orderdate", "DATE"),
    tt.ColumnSpec("o_orderpriority", "VARCHAR2(15)"),
)
_ORDER_FIELDS = (
    ("o_orderkey", "bigint", "NUMBER", "order number"),
    ("o_custkey", "decimal(24,0)", "NUMBER", None),
    ("o_orderstatus", "string", "CHAR(1)", None),
    ("o_totalprice", "decimal(15,1)", "NUMBER", "price, one digit"),
    ("o_orderdate", "timestamp_ntz", "DATE", None),
    ("o_orderpriority", "string", "VARCHAR2(15)", None),
)


@query(
    "schema_build",
    " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{n}' AS name, '{t}' AS spark_type, '{o}' AS declared, "
        f"{repr(c) if c else 'CAST(NULL AS VARCHAR)'} AS note, COUNT({n}) AS filled, "
        f"COUNT(DISTINCT {TEXT_DECIMAL % (n, '24,1') if n == 'o_totalprice' else n}) AS n_values "
        "FROM orders"
        for i, (n, t, o, c) in enumerate(_ORDER_FIELDS, 1)
    ),
)
def schema_build(spark: SparkSession, sf: str) -> DataFrame:
    """The declared schema, each field with what the converted column holds."""
    df = project_columns(table(spark, sf, "orders"), ORDER_COLUMNS)
    schema = tt.build_schema(ORDER_COLUMNS)
    if [f.dataType for f in df.schema] != [f.dataType for f in schema]:
        raise AssertionError("converted columns do not have the declared types")
    facts = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("spark_type"),
            F.lit(f.metadata["oracle_data_type"]).alias("declared"),
            F.lit(f.metadata.get("oracle_comment")).cast("string").alias("note"),
            F.count(f.name).alias("filled"),
            F.count_distinct(f.name).alias("n_values"),
        )
        for i, f in enumerate(schema.fields, 1)
    ]
    return df.agg(F.array(*facts).alias("f")).select(F.inline("f"))


@query(
    "project_columns",
    f"""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
      CAST({TEXT_DECIMAL % ("o_totalprice", "15,1")} AS VARCHAR) AS o_totalprice,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%n') AS o_orderdate, o_orderpriority FROM orders""",
)
def project(spark: SparkSession, sf: str) -> DataFrame:
    return shown(project_columns(table(spark, sf, "orders"), ORDER_COLUMNS))


@query(
    "project_override_expr",
    """SELECT c_custkey, trim(c_name) || ' <' || lower(c_mktsegment) || '>' AS c_name,
      upper(c_mktsegment) AS c_mktsegment FROM customer""",
)
def project_override_expr(spark: SparkSession, sf: str) -> DataFrame:
    columns = (
        tt.ColumnSpec("c_custkey", "NUMBER", 10, 0),
        tt.ColumnSpec(
            "c_name", "VARCHAR2(40)",
            expression="concat(trim({column}), ' <', lower(c_mktsegment), '>')",
        ),
        tt.ColumnSpec("c_mktsegment", "VARCHAR2(10)", expression="upper({column})"),
    )
    return project_columns(table(spark, sf, "customer"), columns)


@query(
    "project_override_type",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS INT) AS c_nationkey,
      c_acctbal > 0 AS c_acctbal, c_name,
      CAST({TEXT_DECIMAL % ("c_acctbal", "12,1")} AS VARCHAR) AS rounded
    FROM customer""",
)
def project_override_type(spark: SparkSession, sf: str) -> DataFrame:
    columns = (
        tt.ColumnSpec("c_custkey", "NUMBER", 10, 0, target="string"),
        tt.ColumnSpec("c_nationkey", "NUMBER", 10, 0, target="int32"),
        tt.ColumnSpec("c_acctbal", "NUMBER", 12, 2, expression="{column} > 0", target="bool"),
        tt.ColumnSpec("c_name", "VARCHAR2(40)", target="no such type"),
        tt.ColumnSpec("rounded", "NUMBER", 12, 2, target="decimal128(12,1)"),
    )
    df = table(spark, sf, "customer").withColumn("rounded", F.col("c_acctbal"))
    return shown(project_columns(df, columns))


@query(
    "override_lookup",
    """SELECT c.owner, c.table_name, c.column_name,
      CASE WHEN e.key IS NOT NULL THEN e.expression ELSE u.expression END AS expression,
      CASE WHEN e.key IS NOT NULL THEN e.target ELSE u.target END AS target
    FROM {tab_cols} c
    LEFT JOIN {column_overrides} e ON e.key = c.owner || '.' || c.table_name || '.' || c.column_name
    LEFT JOIN {column_overrides} u
      ON u.key = upper(c.owner || '.' || c.table_name || '.' || c.column_name)""",
)
def override_lookup(spark: SparkSession, sf: str) -> DataFrame:
    columns = table(spark, sf, "tab_cols").select("owner", "table_name", "column_name")
    key = F.concat_ws(".", "owner", "table_name", "column_name")
    return resolve_overrides(columns, table(spark, sf, "column_overrides"), key)


@query(
    "cast_string",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS VARCHAR) AS number_text,
      CAST(l_quantity AS VARCHAR) AS double_text, CAST(l_quantity * 1e7 AS VARCHAR) AS large_text,
      CAST(l_quantity / 131072 AS VARCHAR) AS small_text, md5(l_returnflag || l_linestatus) AS bytes_md5
    FROM lineitem""",
)
def cast_string(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    both = F.encode(F.concat("l_returnflag", "l_linestatus"), "UTF-8")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        casts.convert(F.col("l_linenumber"), T.IntegerType(), "string").alias("number_text"),
        casts.convert(F.col("l_quantity"), T.DoubleType(), "string").alias("double_text"),
        casts.convert(F.col("l_quantity") * 1e7, T.DoubleType(), "string").alias("large_text"),
        casts.convert(F.col("l_quantity") / 131072, T.DoubleType(), "string").alias("small_text"),
        F.md5(casts.convert(both, T.BinaryType(), "string")).alias("bytes_md5"),
    )


@query(
    "utf8_lossy",
    """SELECT doc_id, md5(chr(65533) || text || chr(65533) || 'A' || chr(65533)) AS repaired_md5,
      md5(text) AS clean_md5, length(text) + 4 AS n_repaired, true AS damaged, false AS clean_damaged
    FROM documents""",
)
def utf8_lossy(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    clean = F.encode("text", "UTF-8")
    broken = F.concat(F.unhex(F.lit("C3")), clean, F.unhex(F.lit("FF41E282")))
    fixed = text_forms.utf8_lossy(broken)
    return docs.select(
        "doc_id",
        F.md5(fixed.cast("binary")).alias("repaired_md5"),
        F.md5(text_forms.utf8_lossy(clean).cast("binary")).alias("clean_md5"),
        F.length(fixed).cast("bigint").alias("n_repaired"),
        text_forms.has_bad_utf8(broken).alias("damaged"),
        text_forms.has_bad_utf8(clean).alias("clean_damaged"),
    )


@query(
    "cast_binary",
    """SELECT doc_id, octet_length(encode(text)) AS n_bytes, md5(text) AS bytes_md5,
      hex(encode(lang)) AS lang_hex FROM documents""",
)
def cast_binary(spark: SparkSession, sf: str) -> DataFrame:
    text = casts.convert(F.col("text"), T.StringType(), "binary")
    same = casts.convert(F.encode("lang", "UTF-8"), T.BinaryType(), "binary")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.md5(text).alias("bytes_md5"),
        F.hex(same).alias("lang_hex"),
    )


@query(
    "cast_int",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(trunc(l_extendedprice) AS BIGINT) AS price, CAST(trunc(-l_extendedprice) AS BIGINT)
      AS negative FROM lineitem""",
)
def cast_int(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        casts.convert(price, T.DoubleType(), "int64").alias("price"),
        casts.convert(-price, T.DoubleType(), "int64").alias("negative"),
    )


@query(
    "cast_double",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price, CAST(l_orderkey AS DOUBLE) AS key
    FROM lineitem""",
)
def cast_double(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("l_extendedprice").cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        casts.convert(text, T.StringType(), "double").alias("price"),
        casts.convert(F.col("l_orderkey"), T.LongType(), "double").alias("key"),
    )


@query(
    "cast_decimal",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST({TEXT_DECIMAL % ("l_extendedprice", "15,1")} AS VARCHAR) AS price,
      CAST({TEXT_DECIMAL % ("l_discount", "10,1")} AS VARCHAR) AS discount,
      CAST({TEXT_DECIMAL % ("-l_extendedprice", "38,0")} AS VARCHAR) AS whole
    FROM lineitem""",
)
def cast_decimal(spark: SparkSession, sf: str) -> DataFrame:
    price, double = F.col("l_extendedprice"), T.DoubleType()
    return shown(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            casts.convert(price, double, "decimal128(15,1)").alias("price"),
            casts.convert(F.col("l_discount"), double, "decimal128(10,1)").alias("discount"),
            casts.convert(-price, double, "decimal128(38,0)").alias("whole"),
        )
    )


@query(
    "cast_wide_decimal",
    """SELECT o_orderkey,
      '-' || (o_custkey + 1) || '1234567890123456789' || repeat('0', 10) AS neg_scale,
      (o_custkey + 1) || repeat('9', 30) || CASE WHEN o_orderstatus = 'F'
        THEN '99.12' ELSE '98.50' END AS kept,
      CASE WHEN o_orderstatus = 'F' THEN (o_custkey + 1) || repeat('9', 32)
        ELSE (o_custkey + 1) || repeat('9', 32) END AS rounded,
      '0.' || repeat('0', 30) || lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS fraction
    FROM orders""",
)
def cast_wide_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """Digits past 38: scientific, plain with rounding up through nines, pure fraction."""
    orders = table(spark, sf, "orders")
    base = (F.col("o_custkey") + 1).cast("string")
    nines = F.concat(base, F.lit("9" * 30))
    kept = F.concat(nines, F.when(F.col("o_orderstatus") == "F", "99.12").otherwise("98.50"))
    fraction = F.concat(F.lit("0"), F.lpad(F.col("o_orderkey").cast("string"), 15, "0"))
    text = T.StringType()
    return orders.select(
        "o_orderkey",
        casts.convert(
            F.concat(F.lit("-"), base, F.lit("1234567890123456789E+10")), text, "decimal256(60,0)"
        ).alias("neg_scale"),
        casts.convert(kept, text, "decimal256(60,2)").alias("kept"),
        casts.convert(kept, text, "decimal256(60,0)").alias("rounded"),
        casts.convert(F.concat(fraction, F.lit("e-45")), text, "decimal256(45,45)").alias(
            "fraction"
        ),
    )


@query(
    "cast_timestamp",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%n') AS kept,
      strftime(CAST(CAST(ts AS DATE) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%n') AS from_date,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%n') AS from_text FROM events""",
)
def cast_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    return shown(
        table(spark, sf, "events").select(
            "event_id",
            casts.convert(ts, T.TimestampNTZType(), "timestamp_us").alias("kept"),
            casts.convert(ts.cast("date"), T.DateType(), "timestamp_us").alias("from_date"),
            casts.convert(ts.cast("string"), T.StringType(), "timestamp_us").alias("from_text"),
        )
    )


@query(
    "fmt_tstz",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%n') || ' UTC' AS utc_text,
      strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%n') || ' America/New_York' AS local_text
    FROM events""",
)
def fmt_tstz(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        text_forms.iso_zoned(F.col("ts"), F.lit("UTC")).alias("utc_text"),
        text_forms.iso_zoned(F.col("ts"), F.lit("America/New_York")).alias("local_text"),
    )


@query(
    "fmt_tsltz",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%n') AS local_text FROM events",
)
def fmt_tsltz(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", text_forms.iso_local(F.col("ts")).alias("local_text")
    )


@query(
    "fmt_interval_ds",
    """SELECT event_id, printf('%s%02d %02d:%02d:%02d.%06d', CASE WHEN us < 0 THEN '-' ELSE '+' END,
        abs(us) // 86400000000, abs(us) // 3600000000 % 24, abs(us) // 60000000 % 60,
        abs(us) // 1000000 % 60, abs(us) % 1000000) AS text
    FROM (SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')
            + CAST(floor(value) AS BIGINT) * 8640000000 AS us FROM events)""",
)
def fmt_interval_ds(spark: SparkSession, sf: str) -> DataFrame:
    gap = F.col("ts") - F.expr("timestamp_ntz'2024-01-15 12:00:00'")
    extra = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.floor("value") * 8640).cast("decimal(18,6)")
    )
    return table(spark, sf, "events").select(
        "event_id", text_forms.day_second_text(gap + extra).alias("text")
    )


@query(
    "fmt_interval_ym",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      printf('%s%02d-%02d', CASE WHEN m < 0 THEN '-' ELSE '+' END, abs(m) // 12, abs(m) % 12) AS text
    FROM (SELECT *, (year(l_shipdate) - 1998) * 12 + month(l_shipdate) - 6 AS m FROM lineitem)""",
)
def fmt_interval_ym(spark: SparkSession, sf: str) -> DataFrame:
    months = (F.year("l_shipdate") - 1998) * 12 + F.month("l_shipdate") - 6
    interval = F.make_ym_interval(F.lit(0), months)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        text_forms.year_month_text(interval).alias("text"),
    )


@query(
    "json_serialize",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
      '{{"k":' || json_extract_string(props, '$.k') || '}}' AS text,
      '{{"n": 1234567890123456789012345678901234567890.50, "n": 1.10, "in": [' || props || ']}}' AS passed
    FROM events""",
)
def json_serialize(spark: SparkSession, sf: str) -> DataFrame:
    text = text_forms.json_text(F.col("props"), canonical=True)
    long = F.concat(
        F.lit('{"n": 1234567890123456789012345678901234567890.50, "n": 1.10, "in": ['),
        "props",
        F.lit("]}"),
    )
    return table(spark, sf, "events").select(
        "event_id",
        F.get_json_object(text, "$.k").cast("bigint").alias("k"),
        text.alias("text"),
        text_forms.json_text(long).alias("passed"),
    )


@query(
    "xml_serialize",
    """SELECT c_custkey, '<CUSTOMER><c_custkey>' || c_custkey || '</c_custkey><c_name>' || c_name
      || '</c_name><c_mktsegment>' || c_mktsegment || '</c_mktsegment></CUSTOMER>' AS document,
      '<n>' || c_name || '</n>' AS passed FROM customer""",
)
def xml_serialize(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct("c_custkey", "c_name", "c_mktsegment").alias("x"),
        F.concat(F.lit("<n>"), "c_name", F.lit("</n>")).alias("t"),
    )
    return customer.select(
        "c_custkey",
        text_forms.xml_text(F.col("x"), customer.schema["x"].dataType, "CUSTOMER").alias(
            "document"
        ),
        text_forms.xml_text(F.col("t"), T.StringType()).alias("passed"),
    )


@query(
    "geometry_wkt",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      'POINT (' || l_quantity || ' ' || l_tax || ')' AS point,
      'LINESTRING (' || l_quantity || ' ' || l_tax || ', ' || l_discount || ' 1.5)' AS line,
      'POLYGON ((0.0 0.0, ' || l_quantity || ' 0.0, ' || l_quantity || ' 9.0, 0.0 0.0), '
        || '(1.0 1.0, 2.0 1.0, 2.0 ' || l_tax || ', 1.0 1.0))' AS area
    FROM lineitem""",
)
def geometry_wkt(spark: SparkSession, sf: str) -> DataFrame:
    def shape(gtype: int, starts: list[int], *ordinates: object) -> Column:
        triplets = [v for s in starts for v in (s, gtype, 1)]
        values = [F.col(o) if isinstance(o, str) else F.lit(float(o)) for o in ordinates]
        return text_forms.geometry_wkt(
            F.struct(
                F.lit(gtype).alias("gtype"),
                F.array(*map(F.lit, triplets)).alias("elem_info"),
                F.array(*values).alias("ordinates"),
            )
        )

    q, tax = "l_quantity", "l_tax"
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        shape(2001, [1], q, tax).alias("point"),
        shape(2002, [1], q, tax, "l_discount", 1.5).alias("line"),
        shape(2003, [1, 9], 0, 0, q, 0, q, 9, 0, 0, 1, 1, 2, 1, 2, tax, 1, 1).alias("area"),
    )


@query(
    "nested_to_json",
    f"""SELECT s_suppkey, '{{{{"balance":"' || CAST({TEXT_DECIMAL % ("s_acctbal", "12,2")} AS VARCHAR)
      || '","home":{{{{"name":"' || n_name || '","region":' || n_regionkey || '}}}},"missing":null,"name":"'
      || s_name || '","tags":["' || s_nationkey || '","' || n_name || '"]}}}}' AS text
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def nested_to_json(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    df = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    nested = df.select(
        "s_suppkey",
        F.struct(
            F.encode("s_name", "UTF-8").alias("name"),
            F.struct(F.col("n_regionkey").alias("region"), F.col("n_name").alias("name")).alias(
                "home"
            ),
            F.array(F.col("s_nationkey").cast("string"), F.col("n_name")).alias("tags"),
            F.col("s_acctbal").cast("decimal(12,2)").alias("balance"),
            F.lit(None).cast("string").alias("missing"),
        ).alias("o"),
    )
    return nested.select(
        "s_suppkey", text_forms.nested_json(F.col("o"), nested.schema["o"].dataType).alias("text")
    )
