"""Embedding near-dedup: spherical-cap filters from structured random product codes, joined and verified in double precision."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common
from tablelift.llm.common import Forest
from tablelift.llm.near_dedup import _runs, by_key


@dataclass(frozen=True)
class Caps:
    """The filters: every direction is one code word in each of ``parts`` blocks of the (randomly rotated) vector."""

    cosine: float = 0.9
    parts: int = 2
    words: int = 48  # code words per block: words ** parts directions
    tables: int = 16  # independent codes
    deviations: float = 3.04  # inner product at which a vector is in a cap, in standard deviations of a random unit vector's
    seed: int = 7
    block_rows: int = 2_000

    def threshold(self, dim: int) -> float:
        """The inner product that a random unit vector exceeds as often as a normal variable does ``deviations``: caps hold the same
        share of all vectors in any dimension. In few dimensions a cap of that share is narrower than linked pairs are apart; there
        it reaches from the middle of a pair at the least cosine beyond both of its ends."""
        if dim >= 32:  # as good as normal
            return self.deviations / dim**0.5
        share = 0.5 * math.erfc(self.deviations / 2**0.5)
        angle = np.linspace(0, np.pi, 100_001)
        density = np.sin(angle) ** max(dim - 2, 0)
        wanted = float(np.cos(angle[np.searchsorted(np.cumsum(density), share * density.sum())]))
        return min(wanted, 0.92 * ((1 + self.cosine) / 2) ** 0.5)

    def codes(self, dim: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        """For every table a rotation and, per block, unit vectors scaled so that whole directions have length 1."""
        rng = np.random.default_rng(self.seed)
        out = []
        for _ in range(self.tables):
            turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            words = [rng.standard_normal((self.words, len(b))) for b in np.array_split(np.arange(dim), self.parts) if len(b)]
            words = [w / np.linalg.norm(w, axis=1, keepdims=True) / len(words) ** 0.5 for w in words]
            out.append((turn, [np.unique(w, axis=0) if w.shape[1] == 1 else w for w in words]))  # one number has two signs
        return out


def directions(unit: np.ndarray, code, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) of every cap that holds a row, all of them: blocks are decoded one by one, and a partial word is given up as
    soon as the best rest cannot lift it over the threshold. A row in no cap gets its best direction."""
    turn, words = code
    turned = unit @ turn
    cuts = np.cumsum([0, *(w.shape[1] for w in words)])
    scores = [turned[:, a:b] @ w.T for a, b, w in zip(cuts[:-1], cuts[1:], words, strict=True)]
    best_rest = np.cumsum([s.max(axis=1) for s in reversed(scores)], axis=0)[::-1]
    row = np.arange(len(unit))
    bound = np.minimum(threshold, best_rest[0])
    name, total = np.zeros(len(unit), np.int64), np.zeros(len(unit))
    for j, s in enumerate(scores):
        rest = best_rest[j + 1][row] if j + 1 < len(scores) else np.zeros(len(row))
        reach = total[:, None] + s[row]
        at, word = np.nonzero(reach + rest[:, None] >= bound[row][:, None] - 1e-9)
        row, name, total = row[at], name[at] * s.shape[1] + word, reach[at, word]
    return row, name


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, numbers): double vectors of the rows that can link at all. Null, zero and empty vectors and vectors with a null or
    non-finite component cannot; nor can null ids."""
    numbers = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("numbers"))
    fine = F.forall("numbers", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("numbers", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("numbers").isNotNull() & fine)


def _units(column, dim: int) -> np.ndarray:
    """Unit vectors in double precision; scaled by the largest component first, so that squares stay finite."""
    raw = column.to_pylist()
    raw = np.stack([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in raw]).astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _caps(unit: np.ndarray, dim: int, codes, how: Caps) -> tuple[np.ndarray, np.ndarray]:
    """(row, cap) over all tables; caps of vectors of different length have different numbers."""
    rows, names = [], []
    for t, code in enumerate(codes):
        row, name = directions(unit, code, how.threshold(dim))
        rows.append(row)
        names.append(((np.int64(dim) * how.tables + t) << np.int64(32)) + name)
    return np.concatenate(rows), np.concatenate(names)


def near_vectors(table: DataFrame, how: Caps = Caps()) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Equal vectors are one class from the start, so that copies are never paired. Each class is listed under all caps that hold it,
    in every table; classes that share a cap are verified by cosine. A pair found under several caps counts under the smallest one
    alone, so that exact numbers of links need no pair rows. Caps with many rows are compared in pairs of blocks.

    Vectors of different length never link. Vectors that cannot link (null, zero, null or non-finite components) have no links and
    are their own component. Rows that repeat an id are vectors of their own: they count as links of each other and share the id's
    component. A null id has no links and a null component. An empty table gives no row.
    """
    import pyarrow as pa

    usable = vectors(table)
    packed = common.written(usable.select("vec_id", F.size("numbers").alias("dim"), "numbers").mapInArrow(_packed, "vec_id long, dim int, raw binary"), "vectors")
    classes = common.written(packed.groupBy("dim", "raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")

    def listed(batches):
        made: dict[int, list] = {}
        for batch in batches:
            dims, reps, raws = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                codes = made.setdefault(dim, how.codes(dim))
                row, cap = _caps(_units(raws.take(pa.array(at)), dim), dim, codes, how)
                yield pa.RecordBatch.from_pydict({"rep": pa.array(reps[at[row]], pa.int64()), "cap": pa.array(cap, pa.int64())})

    held = common.written(classes.select("dim", "rep", "raw").mapInArrow(listed, "rep long, cap long"), "caps")
    sizes = common.written(held.groupBy("cap").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    blocks = F.ceil(F.col("size") / F.lit(how.block_rows)).cast("int")
    spread = held.join(sizes, "cap").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spread = spread.select("cap", "rep", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    spread = spread.select("cap", "rep", "block", low.alias("low"), high.alias("high"), F.xxhash64("cap", low * F.col("blocks") + high).alias("key"))
    full = spread.join(classes, "rep").select("key", "cap", "rep", "block", "low", "high", "dim", "raw", "copies")

    def verified(batches):
        made: dict[int, list] = {}
        for found in by_key(batches, "key"):
            keys = found.column("key").to_numpy()
            for a, b in _runs(keys):
                if b - a > 1:
                    yield _verify(found.slice(a, b - a), how, made)

    pairs = full.repartition("key").sortWithinPartitions("key").mapInArrow(verified, "rep long, links long, root long")
    pairs = common.written(pairs.filter("links > 0 or root <> rep"), "verified")
    linked = common.components(pairs.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    counts = pairs.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.join(counts, "rep", "left").join(linked, F.col("rep") == F.col("node"), "left")
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    named = common.written(named.select("dim", "raw", links.alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "named")
    done = packed.join(named, ["dim", "raw"]).select("vec_id", "n_links", "component_id")
    flag = F.coalesce(F.col("numbers").isNotNull() & F.forall("numbers", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("numbers", lambda x: x != 0), F.lit(False))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding"), lambda x: x.cast("double")).alias("numbers"))
    rest = rows.filter(~flag | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _packed(batches):
    """Vectors as bytes: of floats if those hold them exactly, else of doubles. Negative zero counts as zero, so that equal vectors
    have equal bytes."""
    import pyarrow as pa

    for batch in batches:
        raw = []
        for x in batch.column(2).to_pylist():
            wide = np.array(x, np.float64) + 0.0
            with np.errstate(over="ignore"):
                slim = wide.astype(np.float32)
            raw.append((slim if (slim == wide).all() else wide).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["vec_id", "dim", "raw"])


def _verify(table, how: Caps, made: dict):
    """Links inside one cap (or between two blocks of it): per row the copies it links with that count here, and its root."""
    import pyarrow as pa

    dim, cap = table.column("dim")[0].as_py(), table.column("cap")[0].as_py()
    crossed = table.column("low")[0].as_py() != table.column("high")[0].as_py()
    order = np.argsort(table.column("rep").to_numpy(), kind="stable")
    reps, copies, block = (table.column(c).to_numpy()[order] for c in ("rep", "copies", "block"))
    unit = _units(table.column("raw"), dim)[order]
    links, forest, number = np.zeros(len(reps), np.int64), Forest(len(reps)), np.arange(len(reps))
    earlier = None
    for at in range(0, len(reps), 512):
        near = (unit[at : at + 512] @ unit.T >= how.cosine) & (number[at : at + 512, None] < number)
        if crossed:
            near &= block[at : at + 512, None] != block
        if not near.any():
            continue
        if earlier is None:  # which smaller caps hold each row: a pair that shares one counts there
            row, held = _caps(unit, dim, made.setdefault(dim, how.codes(dim)), how)
            row, held = row[held < cap], held[held < cap]
            names, column = np.unique(held, return_inverse=True)
            earlier = np.zeros((len(reps), len(names)), np.float32)
            earlier[row, column] = 1
        near &= earlier[at : at + 512] @ earlier.T == 0
        links[at : at + 512] += near @ copies
        links += copies[at : at + 512] @ near
        for x, y in zip(*(i.tolist() for i in np.nonzero(near)), strict=True):
            forest.join(at + x, y)
    roots = reps[[forest.root(i) for i in range(len(reps))]]
    return pa.RecordBatch.from_pydict({"rep": pa.array(reps), "links": pa.array(links), "root": pa.array(roots)})


def op9_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """All embeddings, whatever their labels."""
    return near_vectors(common.table(spark, sf_dir, "embeddings"))
