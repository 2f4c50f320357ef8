"""The corpus pipeline: every stage one operator, written as Parquet and read again as the documents of the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm import common, exact_dedup, language_id, mixing, near_dedup, packing


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin; dictionaries come from the documents that name their language."""
    # columns that the answer would replace keep their own values
    names = {c: common.free(docs, f"own_{i}") for i, c in enumerate(docs.columns) if c != "text"}
    plain = docs.select("text", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    found = language_id.identify(plain, language_id.learn(docs)).filter("accepted")
    return found.select(*[F.col(f"`{names[c]}`").alias(c) if c in names else F.col(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of rows that repeat its id and text, one.

    Only rows that go or are there twice are looked for. Where these are few, which is counted, no text is moved at all.
    """
    found = exact_dedup.groups(docs, F.pmod(F.xxhash64("doc_id"), F.lit(3)), 3)
    own, sha, again = (common.free(docs, n) for n in ("copy_doc", "copy_sha", "copy_again"))
    rows = found.groupBy(F.col("doc_id").alias(own), F.col("text_sha256").alias(sha)).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    marks = common.written(rows.filter("not kept or n > 1").select(own, sha, F.col("kept").alias(again)), "copies")
    here = common.free(docs, "copy_here")
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(here) == F.col(sha))
    joined = docs.withColumn(here, F.lower(F.hex(exact_dedup.digest(exact_dedup.normalised("text"))))).join(common.sent_if_small(marks, 120), same, "left")
    twice = joined.filter(F.col(again)).dropDuplicates([own, sha])
    return joined.filter(F.col(again).isNull()).unionByName(twice).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by four fifths of its five-word shingles."""
    own = common.free(docs, "near_doc")
    rows = near_dedup.near_groups(docs, near_dedup.Join(width=5)).groupBy(F.col("doc_id").alias(own)).agg(F.max("kept").alias("kept"))
    gone = common.written(rows.filter("not kept").select(own), "near-copies")
    return docs.join(common.sent_if_small(gone, 40), F.col("doc_id") == F.col(own), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    # columns that the mix would replace keep their own values
    names = {c: common.free(docs, f"own_{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "source", "text")}
    plain = docs.select("doc_id", "source", "text", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    mixed = mixing.mix(plain).withColumn(common.free(plain, "own_copy"), F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return mixed.select(*[F.col(f"`{names[c]}`").alias(c) if c in names else F.col(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix packed into sequences; one row per piece."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact copies", drop_copies),
    ("near copies", drop_near_copies),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

# Language identification, tokenizers and the joins on shingles have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and reread before the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
