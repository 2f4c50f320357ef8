"""Token counts: an exact histogram of encoded lengths, with suffix sums that answer every context limit."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelift.llm import common, tokens


def lengths(docs: DataFrame, text: str = "text", file: str | None = None) -> DataFrame:
    """(n_tokens, n_docs), one row per encoded length and task. Null texts count as empty: length 0."""
    import pyarrow as pa

    file = file or tokens.vocabulary()

    def counted(batches):
        ids, seen = tokens.word_ids(file), Counter()
        for batch in batches:
            seen.update(len(ids.encode(t)) // 4 for t in batch.column(0).to_pylist())
        if seen:
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(seen.keys(), pa.int64()), "n_docs": pa.array(seen.values(), pa.int64())})

    return docs.select(common.text_bytes(text).alias("text")).mapInArrow(counted, "n_tokens long, n_docs long")


def histogram(docs: DataFrame, text: str = "text", file: str | None = None, block: int = 512) -> DataFrame:
    """One row per distinct encoded length L, with answers for the context limit L.

    n_tokens (L), n_docs and tokens of that length; docs_le, docs_ge, tokens_le, tokens_ge (running and suffix sums, L included);
    truncated_tokens: sum of min(length, L) over all documents; quantile: share of documents of at most L tokens.
    An empty table gives no row. The sums run over blocks of ``block`` lengths and over the block totals, so that no task
    orders all lengths.
    """
    hist = common.written(lengths(docs, text, file).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "lengths")
    hist = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / block).cast("long").alias("block"))
    totals = hist.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(0))
    totals = totals.select(
        "block",
        F.coalesce(F.sum("b_docs").over(earlier), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("b_tokens").over(earlier), F.lit(0)).alias("tokens_before"),
        F.sum("b_docs").over(all_rows).alias("all_docs"),
        F.sum("b_tokens").over(all_rows).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        hist.join(totals, "block")
        .withColumn("docs_le", F.col("docs_before") + F.sum("n_docs").over(inside))
        .withColumn("tokens_le", F.col("tokens_before") + F.sum("tokens").over(inside))
    )
    docs_ge = F.col("all_docs") - F.col("docs_le") + F.col("n_docs")
    return sums.select(
        "n_tokens",
        "n_docs",
        "tokens",
        "docs_le",
        docs_ge.alias("docs_ge"),
        "tokens_le",
        (F.col("all_tokens") - F.col("tokens_le") + F.col("tokens")).alias("tokens_ge"),
        (F.col("tokens_le") + F.col("n_tokens") * (F.col("all_docs") - F.col("docs_le"))).alias("truncated_tokens"),
        (F.col("docs_le") / F.col("all_docs")).alias("quantile"),
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """For any context limits: limit, tokens kept after truncation, tokens cut off, documents longer than the limit."""
    cases = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit")
    return (
        hist.select(cases, "n_tokens", "n_docs", "tokens")
        .groupBy("limit")
        .agg(
            F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("kept_tokens"),
            F.sum(F.greatest(F.col("n_tokens") - F.col("limit"), F.lit(0)) * F.col("n_docs")).alias("cut_tokens"),
            F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"),
        )
    )


def length_at(hist: DataFrame, q: float) -> int | None:
    """Smallest encoded length that at least a share ``q`` of all documents does not exceed."""
    return hist.filter(F.col("quantile") >= q).agg(F.min("n_tokens")).first()[0]


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Histogram of all documents."""
    return histogram(common.table(spark, sf_dir, "documents"))
