"""Select list of an export: order, conversion, overrides, field metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.casts import convert, convert_declared
from tablelift.functions.types import ColumnSpec, field_metadata, normalize_type, type_token


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def export_column(df: DataFrame, column: ColumnSpec) -> Column:
    """Expression for one column; the user's expression wins over the declared text form."""
    token = type_token(column.data_type, column.precision, column.scale, column.target)
    if column.expression:
        value = F.expr(column.expression.replace("{column}", quoted(column.name)))
        exported = convert(value, df.select(value).schema[0].dataType, token)
    else:
        value = F.col(quoted(column.name))
        exported = convert_declared(value, df.schema[column.name].dataType, column.data_type, token)
    return exported.alias(column.name, metadata=field_metadata(column, token))


def project_columns(
    df: DataFrame, columns: Sequence[ColumnSpec], keep: Sequence[str | Column] = ()
) -> DataFrame:
    """The exported columns in catalog order; everything else is pruned from the scan."""
    return df.select(*[export_column(df, c) for c in columns], *keep)


def failure(df: DataFrame, column: ColumnSpec) -> Column:
    """Why a row's value of one column cannot be converted; NULL if it can.

    The conversion's fallible twin gives NULL where the conversion itself fails, and nowhere else for a value that is there.
    """
    token = type_token(column.data_type, column.precision, column.scale, column.target)
    if column.expression:
        value = F.expr(column.expression.replace("{column}", quoted(column.name)))
        source = df.select(value).schema[0].dataType
        tried = convert(value, source, token, attempt=True)
    else:
        value = F.col(quoted(column.name))
        source = df.schema[column.name].dataType
        tried = convert_declared(value, source, column.data_type, token, attempt=True)
    shown = value.cast("string") if isinstance(source, T.AtomicType) else F.to_json(F.struct(value.alias("v")))
    text = F.concat(F.lit(f"{column.name} is no {token}: "), F.coalesce(F.left(shown, F.lit(200)), F.lit("")))
    return F.when(value.isNotNull() & tried.isNull(), text)


def failing_rows(df: DataFrame, columns: Sequence[ColumnSpec], chunk: str) -> DataFrame:
    """(chunk, bad_rows, reason): the chunks that hold rows which cannot be converted, how many, and one reason, in one pass."""
    reasons = F.coalesce(*[failure(df, c) for c in columns], F.lit(None).cast("string"))
    tried = df.select(F.col(chunk), reasons.alias("reason"))
    found = tried.groupBy(chunk).agg(F.count("reason").alias("bad_rows"), F.min("reason").alias("reason"))
    return found.where("bad_rows > 0")


def lossy_text_columns(df: DataFrame, columns: Sequence[ColumnSpec]) -> list[str]:
    """Byte columns that become text and so may lose malformed sequences."""
    return [
        c.name
        for c in columns
        if not c.expression
        and isinstance(df.schema[c.name].dataType, T.BinaryType)
        and type_token(c.data_type, c.precision, c.scale, c.target) == "string"
    ]


def resolve_overrides(df: DataFrame, overrides: DataFrame, key: Column) -> DataFrame:
    """Left join of an override frame (column ``key`` plus values) on exact, then upper-cased key.

    The exact match wins as a whole row. Keys of ``overrides`` must be unique.
    """
    values = [c for c in overrides.columns if c != "key"]
    found = F.struct(*[F.col(quoted(c)) for c in values])
    exact = overrides.select(F.col("key").alias("__exact"), found.alias("__by_exact"))
    upper = overrides.select(F.col("key").alias("__upper"), found.alias("__by_upper"))
    joined = (
        df.withColumn("__key", key)
        .join(exact, F.col("__key") == F.col("__exact"), "left")
        .join(upper, F.upper("__key") == F.col("__upper"), "left")
        .withColumn("__found", F.coalesce("__by_exact", "__by_upper"))
    )
    return joined.select(
        *[F.col(quoted(c)) for c in df.columns],
        *[F.col("__found")[c].alias(c) for c in values],
    )
