"""Row counts of sources and outputs, and their comparison chunk by chunk."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.sinks.files import read_output


class CountMismatch(ValueError):
    """Source and output of a chunk differ in rows."""


def count_rows(df: DataFrame, chunk: Sequence[str | Column], name: str = "n_rows") -> DataFrame:
    """Rows of every chunk in one pass; only the chunk columns are read."""
    return df.groupBy(*chunk).agg(F.count(F.lit(1)).alias(name))


def csv_split_counts(lines: DataFrame) -> DataFrame:
    """(file, start, lines, outside, inside, quotes) per split of CSV files.

    A split cannot know whether it begins inside of a quoted value, so it counts the lines that end a record for both cases:
    ``outside`` and ``inside``, and how many quotes it holds. ``lines``: ``value``, ``file`` and ``start`` of its split, in the order
    of the file. Only the number of quotes and whether it is empty is looked at of a line.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    seen = lines.select("file", "start", quotes.alias("quotes"), (F.col("value") == "").alias("empty"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            places = batch.column("file").dictionary_encode()
            file, start = places.indices.to_numpy(), batch.column("start").to_numpy()
            quotes, empty = batch.column("quotes").to_numpy(), batch.column("empty").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], (file[1:] != file[:-1]) | (start[1:] != start[:-1]), [True]]))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                held = found.setdefault((places.dictionary[int(file[lo])].as_py(), int(start[lo])), [0, 0, 0, 0])
                after = (held[3] + np.cumsum(quotes[lo:hi])) % 2  # parity at the end of each line, if the split begins outside
                before = np.concatenate([[held[3] % 2], after[:-1]])
                for side in (0, 1):  # an empty line between two records is none
                    held[1 + side] += int(((after == side) & ~(empty[lo:hi] & (before == side))).sum())
                held[0] += hi - lo
                held[3] += int(quotes[lo:hi].sum())
        rows = [(f, s, *h) for (f, s), h in found.items()]
        names = ["file", "start", "lines", "outside", "inside", "quotes"]
        kinds = [pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return seen.mapInArrow(split, "file string, start bigint, lines bigint, outside bigint, inside bigint, quotes bigint")


def csv_file_counts(spark: SparkSession, path: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """(file, output_rows) of CSV files as this library writes them: header first, quotes doubled, line breaks inside of quotes.

    Large files are read in splits. Of every split the quotes before it, a sum over the short list of splits of its file, say which
    of its two counts holds. A file without any line has no row.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.csv*")
    text = reader.text([path] if isinstance(path, str) else list(path))
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    splits = csv_split_counts(lines)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quoted = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    counted = splits.select("file", F.when(quoted, F.col("inside")).otherwise(F.col("outside")).alias("records"))
    return counted.groupBy("file").agg((F.sum("records") - 1).alias("output_rows"))


def count_output(spark: SparkSession, fmt: str, path: str | Sequence[str]) -> int:
    """Rows in written files; Parquet answers from its footers, CSV is counted in splits without parsing values."""
    if fmt == "csv":
        return csv_file_counts(spark, path).agg(F.coalesce(F.sum("output_rows"), F.lit(0))).first()[0]
    return read_output(spark, fmt, path).count()


def count_output_chunks(spark: SparkSession, fmt: str, table_path: str) -> DataFrame:
    """``(chunk, output_rows)`` of one written table."""
    if fmt == "csv":
        directory = F.regexp_extract("file", r"/chunk=([^/]*)/[^/]*$", 1)
        # file paths are URIs, whose percent signs stand for those of the directory names
        name = F.url_decode(F.replace(F.url_decode(F.replace(directory, F.lit("+"), F.lit("%2B"))), F.lit("+"), F.lit("%2B")))
        return csv_file_counts(spark, table_path).groupBy(name.alias("chunk")).agg(F.sum("output_rows").alias("output_rows"))
    written = read_output(spark, fmt, table_path)
    # Chunk names are text, also those that look like numbers.
    schema = T.StructType([f for f in written.schema.fields if f.name != "chunk"]).add("chunk", "string")
    written = read_output(spark, fmt, table_path, schema)
    return count_rows(written.select("chunk"), ["chunk"], "output_rows")


def compare_counts(planned: DataFrame, source: DataFrame, output: DataFrame) -> DataFrame:
    """``planned`` chunks with both counts; a chunk without rows counts 0.

    The full join also brings up rows outside every planned chunk.
    """
    zero = F.lit(0).cast("bigint")
    return (
        planned.join(source, "chunk", "full")
        .join(output, "chunk", "full")
        .withColumns(
            {
                "input_rows": F.coalesce("input_rows", zero),
                "output_rows": F.coalesce("output_rows", zero),
            }
        )
        .withColumn("valid", F.col("input_rows") == F.col("output_rows"))
    )


def checked_counts(
    table: str, chunks: Sequence[str], source: Mapping[str, int], output: Mapping[str, int]
) -> dict[str, tuple[int, int]]:
    """``compare_counts`` for the chunks of one table whose counts are at hand: both counts of each, or an error that names the
    first one that differs. A chunk without rows counts 0."""
    counts = {name: (source.get(name, 0), output.get(name, 0)) for name in chunks}
    for name, (imported, written) in counts.items():
        if imported != written:
            raise CountMismatch(f"row count mismatch for {table} {name}: imported={imported}, output={written}")
    return counts


def mismatch_text(table: Column, chunk: Column, imported: Column, output: Column) -> Column:
    return F.format_string(
        "row count mismatch for %s %s: imported=%d, output=%d", table, chunk, imported, output
    )


def results_rollup(results: DataFrame) -> DataFrame:
    """Output rows per chunk, per table and in total; an empty result counts 0."""
    return (
        results.rollup("schema", "table", "chunk")
        .agg(
            F.coalesce(F.sum("output_rows"), F.lit(0)).cast("bigint").alias("output_rows"),
            F.grouping_id().alias("__level"),
        )
        .withColumn(
            "level",
            F.when(F.col("__level") == 0, "chunk").when(F.col("__level") == 1, "table")
            .when(F.col("__level") == 7, "plan"),
        )
        .where(F.col("level").isNotNull())
        .drop("__level")
    )
