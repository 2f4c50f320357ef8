"""Avro reads with Spark's own module; where it is not deployed, a clear error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_avro_module(spark: SparkSession) -> bool:
    try:
        spark.read.format("avro").schema("c int").load([])
    except AnalysisException as error:
        return "AVRO" not in str(error).upper()
    return True


def need_avro_module(spark: SparkSession) -> None:
    if not has_avro_module(spark):
        raise ValueError("the format avro needs Spark's Avro module (spark-avro) on the class path of driver and executors")


def with_utc_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as the instants of their UTC reading, as Avro stores them."""
    fields = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    in_utc = {n: F.concat(F.col(n).cast("string"), F.lit("Z")).cast("timestamp") for n in fields}
    return df.withColumns(in_utc) if fields else df


def without_zone(df: DataFrame) -> DataFrame:
    """The way back: instants as zone-less timestamps of their UTC reading."""
    fields = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    local = {
        n: F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.col(n).cast("timestamp_ntz")
        )
        for n in fields
    }
    return df.withColumns(local) if fields else df


def read_avro(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    need_avro_module(spark)
    paths = path if isinstance(path, str) else list(path)
    return without_zone(spark.read.format("avro").load(paths))
