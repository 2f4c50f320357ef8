from __future__ import annotations

import json
from decimal import ROUND_HALF_UP, Context, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import casts, naming, text_forms
from tablelift.functions.types import ColumnSpec
from tablelift.operators.project import project_columns, resolve_overrides


def test_null_stays_null(spark, one):
    cases = [
        ("string", T.StringType(), "int64"), ("string", T.StringType(), "decimal128(10,2)"),
        ("string", T.StringType(), "decimal256(48,0)"), ("binary", T.BinaryType(), "string"),
        ("date", T.DateType(), "timestamp_us"), ("double", T.DoubleType(), "string"),
    ]
    for cast, source, token in cases:
        assert one(casts.convert(F.lit(None).cast(cast), source, token)) is None


@pytest.mark.parametrize(
    ("value", "token", "expected"),
    [
        (2.5, "int64", 2), (-2.5, "int64", -2), (1.005, "decimal128(10,2)", Decimal("1.01")),
        (-0.125, "decimal128(10,2)", Decimal("-0.13")), (1.5, "decimal128(38,0)", Decimal(2)),
        (7.0, "string", "7.0"), (3.0, "bool", True),
    ],
)
def test_numbers(one, value, token, expected):
    assert one(casts.convert(F.lit(value), T.DoubleType(), token)) == expected


def test_overflow_fails(one):
    with pytest.raises(PySparkException):
        one(casts.convert(F.lit("123456"), T.StringType(), "decimal128(5,2)"))
    with pytest.raises(PySparkException):
        one(casts.convert(F.lit("9" * 49), T.StringType(), "decimal256(48,0)"))
    with pytest.raises(PySparkException):
        one(casts.convert(F.lit("12x"), T.StringType(), "decimal256(48,0)"))


def test_fixture_wide_decimals(one):
    big = str(1234567890123456789 * 10**10)
    assert one(casts.convert(F.lit(big), T.StringType(), "decimal256(48,0)")) == big
    big2 = str(12345678901234567890 * 10**20)
    assert one(casts.convert(F.lit("12345678901234567890E20"), T.StringType(),
                             "decimal256(50,0)")) == big2


@settings(max_examples=8, deadline=None)
@given(
    values=st.lists(
        st.decimals(allow_nan=False, allow_infinity=False, min_value=-(10**30), max_value=10**30),
        min_size=20,
        max_size=40,
    ),
    scale=st.sampled_from([0, 2, 40]),
)
def test_wide_decimal_against_decimal_module(spark, values, scale):
    texts = [str(v) for v in values] + ["0.5", "-0.5", "9.5", "99.995", "-0.004", "1E-60", "5E-41"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    wide = casts.to_wide_decimal_text(F.col("t"), 76, scale)
    for r in df.select("t", wide.alias("w")).collect():
        exact = Decimal(r.t).quantize(
            Decimal(1).scaleb(-scale), ROUND_HALF_UP, Context(prec=120)
        )
        expected = f"{exact:f}"
        if not exact:
            expected = expected.lstrip("-")
        assert r.w == expected, r.t


@pytest.mark.parametrize(
    "raw", [b"ok", "é漢".encode(), b"\xff", b"a\xc3", b"\xe2\x82A", b"\xf0\x9f\x98", b"\x80\x80x"]
)
def test_utf8_lossy_is_the_replacing_decode(spark, raw):
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    text, bad = df.select(
        text_forms.utf8_lossy(F.col("b")), text_forms.has_bad_utf8(F.col("b"))
    ).first()
    assert text == raw.decode("utf-8", "replace")
    assert bad == ("�" in text)


def test_zoned_text_ignores_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 07:30:00.12' AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(
            text_forms.iso_local(F.col("t")),
            text_forms.iso_zoned(F.col("t"), F.lit("Asia/Tokyo")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row[0] == "2024-03-10T07:30:00.120000000"
    assert row[1] == "2024-03-10T16:30:00.120000000 Asia/Tokyo"


def test_instant_text(spark, one):
    ts = F.lit("2024-01-02 03:04:05.6").cast("timestamp")
    assert one(text_forms.iso_instant(ts)) == "2024-01-02T03:04:05.600000000 UTC"


@pytest.mark.parametrize(
    ("sql", "text"),
    [
        ("interval '5 04:03:02.5' day to second", "+05 04:03:02.500000"),
        ("interval '-1 02:03:04' day to second", "-01 02:03:04.000000"),
        ("interval '123 00:00:00' day to second", "+123 00:00:00.000000"),
        ("make_dt_interval(0, 0, 0, -0.5)", "-00 00:00:00.500000"),
        ("interval '0 00:00:00' day to second", "+00 00:00:00.000000"),
    ],
)
def test_day_second_text(one, sql, text):
    assert one(text_forms.day_second_text(F.expr(sql))) == text


def test_day_second_without_fraction(one):
    value = F.expr("interval '5 04:03:02.5' day to second")
    assert one(text_forms.day_second_text(value, 2, 0)) == "+05 04:03:02"


@pytest.mark.parametrize(
    ("sql", "text"),
    [
        ("interval '5-3' year to month", "+05-03"), ("interval '-1-2' year to month", "-01-02"),
        ("interval '100-0' year to month", "+100-00"),
    ],
)
def test_year_month_text(one, sql, text):
    assert one(text_forms.year_month_text(F.expr(sql))) == text


def test_nested_json_sorts_keys_and_keeps_nulls(spark):
    df = spark.sql(
        """SELECT named_struct('b', 1.10BD, 'a', array(named_struct('z',
           timestamp_ntz'2024-01-01 00:00:00', 'c', x'41', 'd', date'2024-02-03')), 'n',
           cast(null AS string), 'm', map('y', 2.0BD, 'x', null)) AS s"""
    )
    text = df.select(text_forms.nested_json(F.col("s"), df.schema["s"].dataType)).first()[0]
    assert json.loads(text) == {
        "a": [{"c": "A", "d": "2024-02-03", "z": "2024-01-01T00:00:00"}],
        "b": "1.10", "m": {"x": None, "y": "2.0"}, "n": None,
    }
    assert list(json.loads(text)) == ["a", "b", "m", "n"]


def test_unknown_geometry_fails(spark):
    df = spark.sql(
        "SELECT named_struct('gtype', 2004, 'elem_info', array(1,1,1), 'ordinates', array(1D)) g"
    )
    with pytest.raises(PySparkException):
        df.select(text_forms.geometry_wkt(F.col("g"))).collect()


def test_projection_order_expression_and_pruning(spark):
    df = spark.createDataFrame([(" x ", 1, "h")], "NAME string, ID int, HIDDEN string")
    out = project_columns(
        df,
        [
            ColumnSpec("ID", "NUMBER", 10, 0, "key"),
            ColumnSpec("NAME", "VARCHAR2(9)", expression="upper(trim({column}))"),
        ],
    )
    assert out.columns == ["ID", "NAME"]
    assert out.schema["ID"].metadata == {"oracle_data_type": "NUMBER", "oracle_comment": "key"}
    assert out.first() == (1, "X")


def test_projection_of_quoted_names(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`CamelCase_Col` string, `SELECT` string, `x.y``z` string")
    names = ["CamelCase_Col", "SELECT", "x.y`z"]
    out = project_columns(df, [ColumnSpec(n, "VARCHAR2(50)") for n in names])
    assert out.columns == names
    assert tuple(out.first()) == ("a", "b", "c")


def test_overrides_exact_then_upper(spark):
    df = spark.createDataFrame([("s.t",), ("S.T",), ("q.r",)], "name string")
    over = spark.createDataFrame([("s.t", None), ("S.T", "u"), ("Q.R", "v")], "key string, o string")
    got = {r.name: r.o for r in resolve_overrides(df, over, F.col("name")).collect()}
    assert got == {"s.t": None, "S.T": "u", "q.r": "v"}


@pytest.mark.parametrize("name", ["HR", "a b/c", "x~*+%", 'Q"1', "é", "A.B-C_d", "M&M's"])
def test_safe_segment_faces_agree(one, name):
    assert one(naming.safe_segment_col(F.lit(name))) == naming.safe_segment(name)


def test_partition_directory_is_what_spark_writes(spark, tmp_path):
    names = ["p-1 A", "x/y", "100%", "a=b", "q'\"{}[]^:?*#\\", "ü"]
    df = spark.createDataFrame([(1, n) for n in names], "v int, chunk string")
    df.write.partitionBy("chunk").parquet(str(tmp_path / "t"))
    found = {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("chunk=")}
    assert found == {naming.partition_directory("chunk", n) for n in names}


@pytest.mark.parametrize(
    "value", [1e7, 123456789.5, 0.0005, 0.0001, 1e-5, 1.5e-7, 1e15, 1e16, 1.25e17, -1e7, -0.00012, 0.0, -0.0, 100.5, float("nan"), float("-inf"), 1e100]
)
def test_floating_numbers_as_text(one, value):
    assert one(casts.to_text(F.lit(value).cast("double"), T.DoubleType())) == str(value)


def test_json_passes_unchanged(one):
    for text in ('{"b": 12345678901234567890123456789012345678901234567890, "a": 1.10}', '{"a":1,"a":2}', "null", "[1, 2]"):
        assert one(text_forms.json_text(F.lit(text))) == text
    with pytest.raises(Exception, match="not JSON"):
        one(text_forms.json_text(F.lit("{broken")))


def test_intervals_show_their_declared_digits(spark):
    df = spark.sql("select interval '5 04:03:02.25' day to second as d, interval '7-2' year to month as y")

    def text(column, declared):
        value = casts.convert_declared(F.col(column), df.schema[column].dataType, declared, "string")
        return df.select(value).first()[0]

    assert text("d", "INTERVAL DAY(9) TO SECOND(0)") == "+000000005 04:03:02"
    assert text("d", "INTERVAL DAY(2) TO SECOND(3)") == "+05 04:03:02.250"
    assert text("y", "INTERVAL YEAR(4) TO MONTH") == "+0007-02"


def test_geometry_shapes(spark):
    def wkt(gtype, info, ordinates):
        shape = F.struct(F.lit(gtype).alias("gtype"), F.array(*map(F.lit, info)).alias("elem_info"), F.array(*map(F.lit, ordinates)).alias("ordinates"))
        return spark.range(1).select(text_forms.geometry_wkt(shape)).first()[0]

    assert wkt(2003, [1, 1003, 3], [1.0, 2.0, 3.0, 1e7]) == "POLYGON ((1.0 2.0, 3.0 2.0, 3.0 10000000.0, 1.0 10000000.0, 1.0 2.0))"
    assert wkt(2001, [1, 1, 1], [12345678.5, 0.0005]) == "POINT (12345678.5 0.0005)"
    for info in ([1, 1003, 4], [1, 1005, 2], [1, 1003, 2]):
        with pytest.raises(Exception, match="unsupported geometry"):
            wkt(2003, info, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    with pytest.raises(Exception, match="unsupported geometry"):
        wkt(2002, [1, 2, 2], [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])


def test_fractions_of_a_second_in_nested_json(spark):
    df = spark.sql("select named_struct('t', timestamp_ntz'2024-01-02 03:04:05.5', 'u', timestamp_ntz'2024-01-02 03:04:05', 'd', date'2024-01-02', 'm', map('k', 1), 'l', array(named_struct('a', 1))) as o")
    text = df.select(text_forms.nested_json(F.col("o"), df.schema["o"].dataType)).first()[0]
    assert text == '{"d":"2024-01-02","l":[{"a":1}],"m":{"k":1},"t":"2024-01-02T03:04:05.500000","u":"2024-01-02T03:04:05"}'
