"""Typed output datasets: one directory per table, one ``chunk=`` directory per chunk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.naming import partition_directory
from tablelift.sources.avro import need_avro_module, read_avro, with_utc_instants
from tablelift.sources.storage import Store

# Fixed value: the output formats.
FORMATS = ("parquet", "avro", "csv")
CHUNK = "chunk"

# Values are kept as they are: no trimming, quotes doubled, microseconds shown.
_CSV_WRITE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}
_CSV_READ = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "nullValue": "\u0000",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown output format {fmt!r}, expected one of {', '.join(FORMATS)}")
    return fmt


def csv_ready(df: DataFrame) -> DataFrame:
    """Binary columns as base64 text, said so in the field metadata.

    The writer drops a line that would be empty, so the NULLs of a one-column table
    are written as empty strings, which the field metadata says too.
    """
    columns = []
    only = len(df.columns) == 1
    for f in df.schema.fields:
        value = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, T.BinaryType):
            value = F.base64(value).alias(f.name, metadata={**f.metadata, "encoding": "base64"})
        if only:
            how = {**f.metadata, "encoding": "base64"} if isinstance(f.dataType, T.BinaryType) else f.metadata
            value = F.coalesce(value.cast("string"), F.lit("")).alias(f.name, metadata={**how, "null": "empty string"})
        columns.append(value)
    return df.select(*columns)


def by_chunk(df: DataFrame) -> DataFrame:
    """Rows gathered by chunk before a write, so that a chunk is a few good-sized files.

    The rebalance hint lets adaptive execution split a large chunk over many tasks
    and join small ones, instead of every task writing a file for every chunk.
    """
    return df.hint("rebalance", F.col(CHUNK))


def write_output(
    df: DataFrame,
    fmt: str,
    path: str,
    *,
    chunked: bool = False,
    replace: str = "all",
) -> None:
    """Write ``df``; a chunked one by its ``chunk`` column.

    ``replace``: ``all`` rewrites the whole dataset, ``chunks`` only the chunks that
    ``df`` has rows of.
    """
    check_format(fmt)
    if fmt == "csv":
        df = csv_ready(df)
    if fmt == "avro":
        need_avro_module(df.sparkSession)
        df = with_utc_instants(df)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**_CSV_WRITE)
    if chunked:
        mode = "dynamic" if replace == "chunks" else "static"
        writer = writer.option("partitionOverwriteMode", mode).partitionBy(CHUNK)
    writer.save(path)


def write_empty_chunk(df: DataFrame, fmt: str, table_path: str, chunk: str) -> None:
    """A readable file with the schema and no rows for a chunk that got none."""
    write_empty_chunks(df, fmt, table_path, [chunk])


def write_empty_chunks(df: DataFrame, fmt: str, table_path: str, chunks: Sequence[str]) -> None:
    """The same for any number of chunks by one job: the file is written once, and copied under every name.

    A copy is complete before it takes the place of what the chunk held. Readers do not see the folder of the copies; what a
    crash leaves there is removed by the next call.
    """
    store = Store(df.sparkSession, table_path)
    staging = f"{table_path}/_empty"
    store.remove(staging)
    empty = df.drop(CHUNK).limit(0).coalesce(1)
    write_output(empty, fmt, f"{staging}/file")
    for i, chunk in enumerate(chunks):
        target = f"{table_path}/{partition_directory(CHUNK, chunk)}"
        copy = f"{staging}/copy-{i}"
        store.copy(f"{staging}/file", copy)
        store.remove(target)
        store.rename(copy, target)
    store.remove(staging)


def read_output(
    spark: SparkSession,
    fmt: str,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read back written files; CSV comes back as text unless a schema is given."""
    check_format(fmt)
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "avro":
        return read_avro(spark, paths)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**_CSV_READ)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)
