"""Exact dedup: batches of documents against immutable snapshots that are screened by binary-fuse filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common
from tablelift.llm.fuse import FuseFilter

SPACE = r"[\x20\x09-\x0D]+"
BUCKET_KEYS = 100_000


def normalised(text: str) -> Column:
    """The text without white space of ASCII; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, "")


def digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def _keys(digests) -> np.ndarray:
    return np.frombuffer(b"".join(d[8:16] for d in digests), np.uint64)


def _build(pdf):
    """One filter over all digests of a bucket of a snapshot."""
    import pandas as pd

    made = FuseFilter.build(np.unique(_keys(pdf["digest"])))
    row = {"bucket": pdf["bucket"].iloc[0], "seed": made.seed, "segment": made.segment, "segments": made.segments, "prints": made.prints.tobytes()}
    return pd.DataFrame([row])


def _screen(incoming, filters):
    """Incoming digests of a bucket with whether any snapshot may hold them."""
    found = np.zeros(len(incoming), bool)
    if len(incoming):
        keys = _keys(incoming["digest"])
        for f in filters.itertuples():
            found |= FuseFilter(f.seed, f.segment, f.segments, np.frombuffer(f.prints, np.uint8)).contains(keys)
    return incoming.assign(screened=found)


def groups(docs: DataFrame, batch: Column, batches: int, text: str = "text") -> DataFrame:
    """One row per document with the group of equal texts it belongs to, as batches 0, 1, ... of documents arrive.

    ``batch`` numbers each row's batch, below ``batches``. The digests of a batch are grouped among themselves first; one per group
    is screened by the filters of all earlier snapshots. What the filters do not know is new and goes straight into the next
    snapshot, with filters of its own; the rest joins the exact buckets, where it either meets its group or is new as well. No
    snapshot is changed afterwards, and no digest is looked for anywhere else: at the end the groups are the rows of all snapshots,
    and only those that were met get the counts of the rows that met them. The texts of digests that more than one document has are
    compared byte by byte; should two texts share a digest, their group is split by text.

    Columns: doc_id, keep_id (most code points in the original text, then smallest id), group_size, kept, text_sha256. Null texts
    count as empty and form one group. Repeated rows count in group_size, and all rows with the id that stays are kept; null ids
    come after all others. An empty table gives no row. Other columns are not read.
    """
    points = F.char_length(F.coalesce(text, F.lit("")))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), points.alias("points"), batch.cast("int").alias("batch"), normalised(text).alias("norm"))
    whole = whole.withColumn("digest", digest(F.col("norm")))
    rows = common.written(whole.drop("norm"), "digests")
    buckets = max(1, -(-rows.count() // BUCKET_KEYS))
    best = F.struct("points", (-F.col("doc_id")).alias("minus"))
    snapshots, met, filters = None, None, None
    for b in range(batches):
        own = rows.filter(F.col("batch") == b).groupBy("digest").agg(F.count("*").alias("n"), F.max(best).alias("best"))
        bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")
        new = own.select("digest", "n", "best.points", "best.minus", bucket.alias("bucket"))
        if filters is not None:
            screened = new.withColumn("minus", F.col("minus").cast("string")).groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(
                _screen, "digest binary, n long, points int, minus string, bucket int, screened boolean"
            )
            screened = common.written(screened.withColumn("minus", F.col("minus").cast("long")), "screened")
            held = snapshots.select("digest", F.lit(True).alias("held"))
            positives = screened.filter("screened").drop("screened").join(held, "digest", "left")
            positives = common.written(positives, "positives")
            hits = positives.filter("held").drop("held", "bucket")
            met = hits if met is None else met.unionByName(hits)
            new = screened.filter("not screened").drop("screened").unionByName(positives.filter("held is null").drop("held"))
        new = common.written(new, "snapshot")
        snapshots = new if snapshots is None else snapshots.unionByName(new)
        if b + 1 < batches:
            made = new.select("bucket", "digest").groupBy("bucket").applyInPandas(_build, "bucket int, seed int, segment long, segments long, prints binary")
            made = common.written(made, "filters")
            filters = made if filters is None else filters.unionByName(made)
    merged = snapshots.select("digest", "n", F.struct("points", "minus").alias("best"))
    if met is not None:
        more = met.groupBy("digest").agg(F.sum("n").alias("more"), F.max(F.struct("points", "minus")).alias("other"))
        more = common.sent_if_small(common.written(more, "met"), 100)
        merged = merged.join(more, "digest", "left").select("digest", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), F.greatest("best", "other").alias("best"))
    merged = common.written(merged.select("digest", "n", (-F.col("best.minus")).alias("keep_id")), "groups")
    shared = common.sent_if_small(merged.filter("n > 1").select("digest"), 100)
    differ = whole.select("digest", "norm").join(shared, "digest", "left_semi").groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    differ = common.written(differ.filter("low <> high").select("digest"), "collisions")
    out = rows.join(merged, "digest")
    if not differ.isEmpty():
        whole = whole.join(differ, "digest", "left_semi")
        split = whole.groupBy("digest", "norm").agg(F.count("*").alias("n"), F.max(best).alias("best"))
        split = whole.join(split.select("digest", "norm", "n", (-F.col("best.minus")).alias("keep_id")), ["digest", "norm"])
        out = out.join(differ, "digest", "left_anti").select("doc_id", "keep_id", "n", "digest").unionByName(split.select("doc_id", "keep_id", "n", "digest"))
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents, arriving in three batches by a hash of their id."""
    return groups(common.table(spark, sf_dir, "documents"), F.pmod(F.xxhash64("doc_id"), F.lit(3)), 3)


SQL = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents),
g as (
  select norm, count(*) as group_size, first(doc_id order by points desc, doc_id) as keep_id from t group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256
from t join g using (norm)
"""
