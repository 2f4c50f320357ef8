"""Scans of already readable tables, whole or one chunk at a time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from posixpath import dirname
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows fetched per round trip from a database source.
FETCH_ROWS = 10_000


def scan_table(
    spark: SparkSession,
    fmt: str,
    path: str | Sequence[str],
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A file-based table; pruning and push-down are left to the scan."""
    if fmt == "avro":
        from tablelift.sources.avro import read_avro

        return read_avro(spark, path)
    return spark.read.format(fmt).options(**dict(options or {})).load(path)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    predicates: Sequence[str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, read in parallel by chunk predicates or by column ranges."""
    properties = {"fetchsize": str(FETCH_ROWS), **dict(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("partition_column needs bounds and partitions")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=str(partitions),
        )
    return reader.load()


def in_chunk(
    *,
    partition: str | None = None,
    subpartition: str | None = None,
    partition_column: str = "partition_name",
    subpartition_column: str = "subpartition_name",
) -> Column:
    """Predicate for one chunk; a subpartition name wins over a partition name."""
    if subpartition is not None:
        return F.col(subpartition_column) == subpartition
    if partition is not None:
        return F.col(partition_column) == partition
    return F.lit(True)


def scan_partition(df: DataFrame, partition: str) -> DataFrame:
    """Rows of one partition; on a partition column this prunes the scan itself."""
    return df.where(in_chunk(partition=partition))


def scan_subpartition(
    df: DataFrame, subpartition: str, partition: str | None = None
) -> DataFrame:
    return df.where(in_chunk(partition=partition, subpartition=subpartition))


def scan_fileset(spark: SparkSession, fmt: str, paths: Sequence[str]) -> DataFrame:
    """Several files of one directory as one input, each row with its ``source_file``."""
    if not paths:
        raise ValueError("a file set needs at least one path")
    parents = {dirname(path.rstrip("/")) for path in paths}
    if len(parents) != 1:
        raise ValueError(f"all paths of a file set must share one directory, got {sorted(parents)}")
    df = scan_table(spark, fmt, list(paths))
    if fmt == "avro":
        return df
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of every file under a directory; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def file_states(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of the files a frame reads; contents are not read."""
    listing = spark.read.format("binaryFile").load([unquote(f) for f in files])
    return listing.select("path", "length", "modificationTime")
