"""Small helpers of the corpus operators: shared folder, written tables, words, components."""

from __future__ import annotations

import itertools
import tempfile
import uuid
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: dict[str, str] = {}
_names = itertools.count()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a new temporary one only where that is unset and Spark runs locally."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="llm-")
    return _fallback[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read again: lineage ends there and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{next(_names)}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sent_if_small(df: DataFrame, row_bytes: int, limit: int = 16_000_000) -> DataFrame:
    """``df`` marked to be sent to all tasks if its counted rows of ``row_bytes`` each stay below ``limit``; else as it is, and a
    join with it deals both sides by their keys."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column, null as empty: what the Python side works on."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def crc_fold(doc_id: int | None, parts: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers (finalizer of the splitmix generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def parts(texts: list[bytes], limit: int = 4_000_000):
    """Bounds of runs of texts of about ``limit`` bytes."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def most_frequent(counts: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of the largest values of ``column`` (1 and up), whole steps of a sixteenth of an octave at a time.

    Only the sizes of the steps, a thousand at most, come to the driver; no task sends more rows than the result has.
    """
    step = F.floor(F.log2(column) * 16).cast("int")
    sizes = counts.groupBy(step.alias("step")).count().collect()
    low, total = None, 0
    for r in sorted(sizes, reverse=True):
        total += r["count"]
        if total > limit:
            break
        low = r["step"]
    return counts.limit(0) if low is None else counts.filter(step >= low)


class Forest:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """True if the two were apart; the smaller root stays."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.parent[b] = a
        return True


def _local_stars(batches):
    """Each task's edges shrunk to one edge from every node to the smallest node it reaches inside the task."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def root(x: int) -> int:
        up = parent.setdefault(x, x)
        while up != x:
            parent[x] = parent.setdefault(up, up)
            x, up = up, parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_pydict({"u": pa.array(part, pa.int64()), "v": pa.array([root(x) for x in part], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)``: columns node, component (smallest node reachable).

    Alternates large-star and small-star steps: a node's neighbours are pointed at the smallest one among them, first the larger
    neighbours, then the smaller ones, until no edge changes. Every step is an aggregate (minimum per node, reduced inside each
    task) and a join, so a hub with a third of all edges is never gathered. Nodes without an edge are not returned.
    """
    stars = written(edges.select("u", "v").filter("u <> v").mapInArrow(_local_stars, "u long, v long"), "edges")
    seen = None
    while True:
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large")
        # every edge now points from a larger to a smaller node
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        stars = written(small.distinct(), "small")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            ends = stars.unionByName(stars.select(F.col("v").alias("u"), "v"))
            return ends.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
        seen = state
