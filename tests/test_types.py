from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import types as tt

NUMBERS = [
    (10, 0, "int64"), (18, 0, "int64"), (19, 0, "decimal128(19,0)"), (38, 0, "decimal128(38,0)"),
    (30, 4, "decimal128(30,4)"), (40, 2, "decimal256(40,2)"), (80, 2, "double"),
    (10, -2, "int64"), (20, -2, "decimal128(22,0)"), (38, -10, "decimal256(48,0)"),
    (70, -10, "double"), (2, 5, "decimal128(5,5)"), (2, 40, "decimal256(40,40)"),
    (2, 2, "decimal128(2,2)"), (10, None, "int64"), (None, None, "decimal128(38,0)"),
    (None, 0, "decimal128(38,0)"), (None, 4, "decimal128(38,4)"), (None, 50, "decimal128(38,38)"),
    (None, -2, "decimal128(38,0)"),
]


@pytest.mark.parametrize(("precision", "scale", "token"), NUMBERS)
def test_number_token(precision, scale, token):
    assert tt.number_token(precision, scale) == token


def test_both_faces_agree(spark):
    precisions = [None, *range(1, 90)]
    scales = [None, *range(-60, 90, 3)]
    kinds = ["NUMBER", "FLOAT", "varchar2(20)", "BLOB", "TIMESTAMP(6)", "ROWID"]
    rows = [(k, p, s) for k, (p, s) in zip(
        itertools.cycle(kinds), itertools.product(precisions, scales), strict=False)]
    rows += [("NUMBER", p, s) for p, s in itertools.product(precisions, scales)]
    df = spark.createDataFrame(rows, "kind string, p int, s int")
    got = df.select("*", tt.type_token_col(F.col("kind"), F.col("p"), F.col("s")).alias("t"))
    for r in got.collect():
        assert r.t == tt.type_token(r.kind, r.p, r.s), r


@pytest.mark.parametrize(
    ("declared", "token"),
    [
        ("FLOAT", "double"), ("BINARY_DOUBLE", "double"), ("nvarchar2(10)", "string"),
        ("CLOB", "string"), ("RAW(16)", "binary"), ("LONG RAW", "binary"), ("BLOB", "binary"),
        ("DATE", "timestamp_us"), ("TIMESTAMP(9)", "timestamp_us"),
        ("TIMESTAMP(6) WITH TIME ZONE", "string"),
        ("TIMESTAMP(6) WITH LOCAL TIME ZONE", "string"),
        ("INTERVAL DAY(2) TO SECOND(6)", "string"), ("JSON", "string"), ("XMLTYPE", "string"),
        ("SDO_GEOMETRY", "string"), ("UROWID", "string"), ("ROWID", "string"),
    ],
)
def test_type_token(declared, token):
    assert tt.type_token(declared) == token


def test_override_wins_even_when_unknown():
    assert tt.type_token("NUMBER", 10, 0, "float32") == "float32"
    assert tt.spark_type("no such type") == T.StringType()
    assert not tt.is_known_target("no such type")
    assert tt.is_known_target("decimal128(10,2)")


@pytest.mark.parametrize(
    ("token", "expected"),
    [
        ("int64", T.LongType()), ("int32", T.IntegerType()), ("float32", T.FloatType()),
        ("float64", T.DoubleType()), ("bool", T.BooleanType()), ("date32", T.DateType()),
        ("timestamp[us]", T.TimestampNTZType()), ("timestamp_us", T.TimestampNTZType()),
        ("binary", T.BinaryType()), ("decimal128(22,0)", T.DecimalType(22, 0)),
        ("decimal256(48,0)", T.StringType()),
    ],
)
def test_spark_type(token, expected):
    assert tt.spark_type(token) == expected


def test_schema_order_nullability_and_metadata():
    schema = tt.build_schema(
        [
            tt.ColumnSpec("B", "NUMBER", 38, -10, "wide"),
            tt.ColumnSpec("A", "VARCHAR2(10)"),
            tt.ColumnSpec("C", "NUMBER", 5, 0, None, None, "int32"),
        ]
    )
    assert schema.names == ["B", "A", "C"]
    assert all(f.nullable for f in schema)
    assert schema["B"].metadata == {
        "oracle_data_type": "NUMBER", "oracle_comment": "wide", "oracle_decimal": "48,0",
    }
    assert schema["A"].metadata == {"oracle_data_type": "VARCHAR2(10)"}
    assert schema["C"].dataType == T.IntegerType()
