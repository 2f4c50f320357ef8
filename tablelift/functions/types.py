"""Declared source type -> target type, as one rule with two faces.

``number_token`` / ``type_token`` decide for one declaration in Python (used to
build a ``StructType``); ``number_token_col`` / ``type_token_col`` are the same
decision as Column expressions over a catalog frame with any number of columns.
A test asserts that both faces agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source type names and numeric limits of the type table.
STRING_NAMES = ("CHAR", "NCHAR", "VARCHAR2", "NVARCHAR2", "CLOB", "NCLOB", "LONG")
BINARY_NAMES = ("RAW", "LONG RAW", "BLOB")
FLOAT_NAMES = ("FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE")
TIMESTAMP_NAMES = ("DATE", "TIMESTAMP")
TEXT_FORM_NAMES = (
    "ANYDATA",
    "INTERVAL DAY TO SECOND",
    "INTERVAL YEAR TO MONTH",
    "JSON",
    "SDO_GEOMETRY",
    "TIMESTAMP WITH LOCAL TIME ZONE",
    "TIMESTAMP WITH TIME ZONE",
    "UROWID",
    "XMLTYPE",
)
UNSUPPORTED_NAMES = ("BFILE",)
BUILTIN_OWNED_NAMES = ("XMLTYPE", "SDO_GEOMETRY")
LONG_DIGITS = 18
DECIMAL_DIGITS = 38
WIDE_DECIMAL_DIGITS = 76

_KNOWN = (
    ("double", FLOAT_NAMES),
    ("string", STRING_NAMES + TEXT_FORM_NAMES),
    ("binary", BINARY_NAMES),
    ("timestamp_us", TIMESTAMP_NAMES),
)
_LENGTH = r"\(\d+\)"
_DECIMAL_TOKEN = re.compile(r"decimal(?:128|256)\((\d+),(\d+)\)")

# Target-type names a user may ask for, beside the decimal tokens.
_SPARK_TYPES: dict[str, T.DataType] = {
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "int16": T.ShortType(),
    "int8": T.ByteType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "bool": T.BooleanType(),
    "date32": T.DateType(),
    "timestamp_us": T.TimestampNTZType(),
    "timestamp[us]": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    """One exported column, as declared in the catalog."""

    name: str
    data_type: str
    precision: int | None = None
    scale: int | None = None
    comment: str | None = None
    expression: str | None = None
    target: str | None = None


def normalize_type(data_type: str) -> str:
    return re.sub(_LENGTH, "", data_type.upper())


def normalize_type_col(data_type: Column) -> Column:
    return F.regexp_replace(F.upper(data_type), _LENGTH, "")


def number_token(precision: int | None, scale: int | None) -> str:
    """Target token of ``NUMBER(precision, scale)``.

    The value is kept exact: a negative scale widens the digits, a scale above
    the precision means a pure fraction of ``scale`` digits.
    """
    scale = scale or 0
    if precision is None:
        return f"decimal128({DECIMAL_DIGITS},{min(max(scale, 0), DECIMAL_DIGITS)})"
    digits = precision - scale if scale < 0 else max(precision, scale)
    scale = max(scale, 0)
    if scale == 0 and digits <= LONG_DIGITS:
        return "int64"
    if digits <= DECIMAL_DIGITS:
        return f"decimal128({digits},{scale})"
    if digits <= WIDE_DECIMAL_DIGITS:
        return f"decimal256({digits},{scale})"
    return "double"


def number_token_col(precision: Column, scale: Column) -> Column:
    scale = F.coalesce(scale.cast("int"), F.lit(0))
    precision = precision.cast("int")
    kept = F.greatest(scale, F.lit(0))
    digits = F.when(scale < 0, precision - scale).otherwise(F.greatest(precision, scale))

    def decimal(width: int, digits: Column, scale: Column) -> Column:
        return F.format_string(f"decimal{width}(%d,%d)", digits, scale)

    limit = F.lit(DECIMAL_DIGITS)
    return (
        F.when(precision.isNull(), decimal(128, limit, F.least(kept, limit)))
        .when((kept == 0) & (digits <= LONG_DIGITS), F.lit("int64"))
        .when(digits <= DECIMAL_DIGITS, decimal(128, digits, kept))
        .when(digits <= WIDE_DECIMAL_DIGITS, decimal(256, digits, kept))
        .otherwise(F.lit("double"))
    )


def type_token(
    data_type: str,
    precision: int | None = None,
    scale: int | None = None,
    target: str | None = None,
) -> str:
    """Target token of one declared column; ``target`` is the user's override."""
    if target:
        return target
    name = normalize_type(data_type)
    if name == "NUMBER":
        return number_token(precision, scale)
    return next((token for token, names in _KNOWN if name in names), "string")


def type_token_col(
    data_type: Column, precision: Column, scale: Column, target: Column | None = None
) -> Column:
    name = normalize_type_col(data_type)
    chain = F.when(name == "NUMBER", number_token_col(precision, scale))
    for token, names in _KNOWN:
        chain = chain.when(name.isin(*names), F.lit(token))
    chain = chain.otherwise(F.lit("string"))
    if target is None:
        return chain
    return F.coalesce(F.when(target != "", target), chain)


_KNOWN_NAMES = ("NUMBER", *(n for _, names in _KNOWN for n in names))


def is_known_type(data_type: str) -> bool:
    """False for a type that is exported as text only for want of a better rule."""
    return normalize_type(data_type) in _KNOWN_NAMES


def is_known_type_col(data_type: Column) -> Column:
    return normalize_type_col(data_type).isin(*_KNOWN_NAMES)


def is_known_target(token: str) -> bool:
    return token in _SPARK_TYPES or _DECIMAL_TOKEN.fullmatch(token) is not None


def decimal_shape(token: str) -> tuple[int, int] | None:
    """``(precision, scale)`` of a decimal token, else None."""
    match = _DECIMAL_TOKEN.fullmatch(token)
    return (int(match[1]), int(match[2])) if match else None


def spark_type(token: str) -> T.DataType:
    """Spark type of a token; decimals past 38 digits are carried as exact text."""
    shape = decimal_shape(token)
    if shape:
        return T.DecimalType(*shape) if shape[0] <= DECIMAL_DIGITS else T.StringType()
    return _SPARK_TYPES.get(token, T.StringType())


def field_metadata(column: ColumnSpec, token: str) -> dict[str, str]:
    metadata = {"oracle_data_type": column.data_type}
    if column.comment:
        metadata["oracle_comment"] = column.comment
    shape = decimal_shape(token)
    if shape and shape[0] > DECIMAL_DIGITS:
        metadata["oracle_decimal"] = f"{shape[0]},{shape[1]}"
    return metadata


def build_schema(columns: Iterable[ColumnSpec]) -> T.StructType:
    """Schema in the given order; every field nullable, source facts as metadata."""
    fields = []
    for column in columns:
        token = type_token(column.data_type, column.precision, column.scale, column.target)
        fields.append(
            T.StructField(column.name, spark_type(token), True, field_metadata(column, token))
        )
    return T.StructType(fields)
