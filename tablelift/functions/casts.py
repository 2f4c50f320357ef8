"""Conversion of a source column to its target type. NULL always stays NULL."""

from __future__ import annotations

import functools
import re
from decimal import MAX_EMAX, MIN_EMIN, ROUND_HALF_UP, Context, Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import text_forms
from tablelift.functions.types import DECIMAL_DIGITS, decimal_shape, normalize_type, spark_type


def to_text(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BinaryType):
        return text_forms.utf8_lossy(value)
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        return text_forms.nested_json(value, source)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return text_forms.plain_number(value)
    return value.cast("string")


def to_bytes(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BinaryType):
        return value
    return F.encode(value.cast("string"), "UTF-8")


def to_wide_decimal_text(value: Column, precision: int, scale: int, attempt: bool = False) -> Column:
    """Exact plain decimal text, rounded half up to ``scale``; more than ``precision`` digits and text that is no number fail the
    job, as an overflow does for narrow decimals. With ``attempt`` they give NULL.

    Values already in plain form with few enough digits are only padded, in compiled code. Spark's own decimals end at 38 digits,
    so all others are rounded as exact decimals, a batch of Arrow values at a time.
    """
    text = F.trim(value.cast("string"))
    whole = f"(?:0|[1-9]\\d{{0,{precision - scale - 1}}})" if precision > scale else "0"
    plain = rf"^(?:-(?=.*[1-9]))?{whole}"
    integer, few = text.rlike(plain + "$"), text.rlike(plain + rf"\.\d{{0,{scale}}}$")
    others = _rounded(precision, scale, attempt)(F.when(~integer & ~few, text))
    if not scale:
        return F.when(integer, text).otherwise(others)
    padded = F.rpad(text, F.instr(text, ".") + scale, F.lit("0"))
    return F.when(integer, F.concat(text, F.lit("." + "0" * scale))).when(few, padded).otherwise(others)


def rounded_decimal(text: str, precision: int, scale: int) -> str:
    """One number in any notation and of any length as plain text with ``scale`` digits after the point."""
    if not _NUMBER.fullmatch(text):
        raise ValueError(f"not a decimal: {text}")
    if not text.upper().split("E")[0].strip("+-.0"):
        number = Decimal(0).quantize(Decimal(1).scaleb(-scale))
    else:
        try:
            number = Decimal(text).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP, Context(prec=precision, Emax=MAX_EMAX, Emin=MIN_EMIN))
        except InvalidOperation:
            if text.upper().partition("E")[2].startswith("-"):  # beyond all exponents
                number = Decimal(0).quantize(Decimal(1).scaleb(-scale))
            else:
                raise ValueError(f"more than {precision} digits: {text}") from None
    shown = f"{number:f}"
    return shown if number else shown.lstrip("-")


_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", re.ASCII)


@functools.cache
def _rounded(precision: int, scale: int, attempt: bool):
    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return rounded_decimal(text, precision, scale)
        except ValueError:
            if attempt:
                return None
            raise

    @F.arrow_udf("string")
    def rounded(texts: pa.Array) -> pa.Array:
        return pa.array([one(t) for t in texts.to_pylist()], pa.string())

    return rounded


def convert(value: Column, source: T.DataType, token: str, attempt: bool = False) -> Column:
    """Expression giving ``value`` as the target type named by ``token``; with ``attempt`` NULL where that would fail."""
    shape = decimal_shape(token)
    if shape and shape[0] > DECIMAL_DIGITS:
        return to_wide_decimal_text(value, *shape, attempt)
    target = spark_type(token)
    if isinstance(target, T.StringType):
        return to_text(value, source)
    if isinstance(target, T.BinaryType):
        return to_bytes(value, source)
    if source == target:
        return value
    if isinstance(source, T.BinaryType):
        value = text_forms.utf8_lossy(value)
    return value.try_cast(target) if attempt else value.cast(target)


def convert_declared(value: Column, source: T.DataType, declared: str, token: str, attempt: bool = False) -> Column:
    """``convert`` after the declared type's own text form, where it has one.

    ``declared`` is the type as written, with its digits; intervals are shown with as many.
    """
    parts = {name: int(n) for name, n in re.findall(r"(DAY|YEAR|SECOND) ?\((\d+)\)", declared.upper())}
    declared = normalize_type(declared)
    if isinstance(source, T.DayTimeIntervalType):
        value = text_forms.day_second_text(value, parts.get("DAY", 2), parts.get("SECOND", 6))
        source = T.StringType()
    elif isinstance(source, T.YearMonthIntervalType):
        value, source = text_forms.year_month_text(value, parts.get("YEAR", 2)), T.StringType()
    elif declared == "TIMESTAMP WITH TIME ZONE" and isinstance(source, T.TimestampType):
        value, source = text_forms.iso_instant(value), T.StringType()
    elif declared in ("TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITH LOCAL TIME ZONE") and isinstance(
        source, (T.TimestampType, T.TimestampNTZType)
    ):
        value, source = text_forms.iso_local(value), T.StringType()
    elif declared == "JSON" and isinstance(source, T.StringType):
        value = text_forms.json_text(value, attempt=attempt)
    elif declared == "XMLTYPE":
        value, source = text_forms.xml_text(value, source), T.StringType()
    elif declared == "SDO_GEOMETRY" and isinstance(source, T.StructType):
        value, source = text_forms.geometry_wkt(value, attempt), T.StringType()
    return convert(value, source, token, attempt)
