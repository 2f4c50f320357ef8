"""Log lines and DDL statements as ordered rows, read in splits.

Spark numbers no lines across splits. Rows of one split come in file order, so
``(file, block, seq)`` with ``block`` = start of the split and ``seq`` increasing
inside it orders a file of any size without reading it in one task. Compressed
files that cannot be split stay one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, path: str | list[str], separator: str | None) -> DataFrame:
    reader = spark.read
    if separator is not None:
        reader = reader.option("lineSep", separator)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def read_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read(spark, path, None).withColumnRenamed("value", "line")


def read_ddl_statements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per statement; a statement ends with a semicolon at the end of a line."""
    return _read(spark, path, ";\n").withColumnRenamed("value", "statement")
