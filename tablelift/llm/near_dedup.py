"""MinHash near-dedup: chosen-path similarity join over sets of word shingles.

Every distinct set is a row of minwise values. In each of several independent trees a node picks one coordinate, sometimes two, and
sends each of its rows to the child named by the row's value there. Small nodes are compared exhaustively; larger ones branch again.
What the trees propose is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common
from tablelift.llm.common import Forest, mix64


@dataclass(frozen=True)
class Join:
    """Shingle width, similarity in percent, and how the trees are grown."""

    width: int = 2
    percent: int = 80
    coordinates: int = 64
    trees: int = 16
    second: float = 0.25  # chance that a node branches on a second coordinate: 0.8 * 1.25 = 1
    small: int = 128  # nodes up to this size are compared exhaustively
    slack: float = 4.0  # standard deviations below the threshold at which minwise values still propose a pair
    node_rows: int = 20_000  # nodes above it branch as Spark rows, below it inside a task
    levels: int = 8
    block_shingles: int = 3_000_000

    @property
    def agreeing(self) -> int:
        """Coordinates that must agree for a pair to be proposed."""
        s, k = self.percent / 100, self.coordinates
        return max(1, int(k * s - self.slack * (k * s * (1 - s)) ** 0.5))


class WordHash(dict):
    """64-bit hashes of words; at most ``entries`` are kept."""

    def __init__(self, entries: int = 300_000) -> None:
        super().__init__()
        self.entries = entries

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.entries:
            self.clear()
        self[word] = value
        return value


_words = WordHash()


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text with A-Z lowered; fewer words than ``width`` are one shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([_words[w] for w in words], np.uint64)
    span = min(width, len(h))
    total = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        total += h[i : len(h) - span + 1 + i] * np.uint64(0x9E3779B97F4A7C15 + 2 * i * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    return np.unique(mix64(total))


def factors(coordinates: int) -> np.ndarray:
    return mix64(np.arange(1, 2 * coordinates + 1, dtype=np.uint64)).reshape(2, -1, 1) | np.uint64(1)


def minwise(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """16 bits of the minwise value of every coordinate."""
    low = None
    for at in range(0, len(hashes), 2048):
        part = (hashes[at : at + 2048] * by[0] + by[1]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return (mix64(low) & np.uint64(0xFFFF)).astype("<u2")


def sketches(docs: DataFrame, how: Join, text: str = "text") -> DataFrame:
    """(doc_id, mark, n, whole, minima): a hash of the text, size of its set, 128-bit hash of the whole set, minwise values."""
    import pyarrow as pa

    def run(batches):
        by = factors(how.coordinates)
        for batch in batches:
            rows = []
            for t in batch.column(2).to_pylist():
                s = shingles(t, how.width)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), minwise(s, by).tobytes() if len(s) else b""))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["doc_id", "mark", "n", "whole", "minima"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), common.text_bytes(text).alias("text"))
    return plain.mapInArrow(run, "doc_id long, mark long, n long, whole binary, minima binary")


def children(path: np.ndarray, minima: np.ndarray, how: Join) -> tuple[np.ndarray, np.ndarray]:
    """For each row (its node's 64-bit path, its minwise values): row numbers and paths of the children it goes to."""
    draw = mix64(path)
    first = (draw % np.uint64(how.coordinates)).astype(np.int64)
    second = (first + 1 + ((draw >> np.uint64(16)) % np.uint64(how.coordinates - 1)).astype(np.int64)) % how.coordinates
    two = np.flatnonzero((draw >> np.uint64(40)) % np.uint64(1000) < np.uint64(int(1000 * how.second)))
    rows = np.concatenate([np.arange(len(path)), two])
    chosen = np.concatenate([first, second[two]])
    value = minima[rows, chosen].astype(np.uint64)
    return rows, mix64(path[rows] ^ mix64((chosen.astype(np.uint64) << np.uint64(16)) + value + np.uint64(1)))


def roots(how: Join) -> np.ndarray:
    return mix64(np.arange(1, how.trees + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _matrix(column, how: Join) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, how.coordinates)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal keys."""
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


class Node:
    """Compares rows; keeps the proposed links as a forest."""

    def __init__(self, n: np.ndarray, minima: np.ndarray, how: Join) -> None:
        self.n, self.minima, self.how, self.forest = n, minima, how, Forest(len(n))
        self.links: list[tuple[int, int]] = []

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if self.forest.join(x, y):
                self.links.append((x, y))

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether rows a and b (broadcast against each other) may be as similar as asked."""
        low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
        return ((self.minima[a] == self.minima[b]).sum(axis=-1) >= self.how.agreeing) & (100 * low >= self.how.percent * high)

    def equal_sized(self, members: np.ndarray) -> None:
        """Compare all pairs inside every row of ``members`` (nodes of one size)."""
        for d in range(1, members.shape[1]):
            a, b = members[:, :-d].ravel(), members[:, d:].ravel()
            for at in range(0, len(a), 100_000):
                x, y = a[at : at + 100_000], b[at : at + 100_000]
                hit = self.near(x, y)
                self.link(x[hit], y[hit])

    def grow(self, members: np.ndarray, path: np.uint64, level: int) -> None:
        """One node: compared if it is small or deep, else branched."""
        if len({self.forest.root(x) for x in members.tolist()}) == 1:
            return
        if len(members) <= self.how.small or level >= self.how.levels:
            for i in range(len(members) - 1):
                rest = members[i + 1 :]
                hit = rest[self.near(members[i], rest)]
                self.link(np.full(len(hit), members[i]), hit)
            return
        rows, paths = children(np.full(len(members), path), self.minima[members], self.how)
        order = np.argsort(paths, kind="stable")
        rows, paths = rows[order], paths[order]
        for a, b in _runs(paths):
            if b - a > 1:
                self.grow(members[rows[a:b]], paths[a], level + 1)


def by_key(batches, key: str) -> Iterator:
    """Tables that hold all rows of their keys, from batches sorted by key."""
    import pyarrow as pa

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now])
        keys = now.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield now.slice(0, cut)
        held = now.slice(cut)
    if held is not None:
        yield held


def _edges(u, v):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def proposals(classes: DataFrame, how: Join) -> DataFrame:
    """Edges (u, v) between representatives that share a node of some tree and may be similar; a forest for every node."""
    import pyarrow as pa

    def grown(batches):
        start = roots(how)
        for batch in batches:
            if not batch.num_rows:
                continue
            minima = _matrix(batch.column(1), how)
            ids = batch.column(0).to_numpy()
            path = np.repeat(start, len(ids))
            rows, paths = children(path, np.tile(minima, (how.trees, 1)), how)
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths.view(np.int64)), "rep": pa.array(ids[rows % len(ids)])})

    def branched(batches):
        for batch in batches:
            if batch.num_rows:
                rows, paths = children(batch.column(0).to_numpy().view(np.uint64), _matrix(batch.column(2), how), how)
                yield pa.RecordBatch.from_pydict({"path": pa.array(paths.view(np.int64)), "rep": pa.array(batch.column(1).to_numpy()[rows])})

    minima = classes.select("rep", "n", "minima")
    here = common.written(classes.select("rep", "minima").mapInArrow(grown, "path long, rep long"), "nodes")
    leaves = None
    for level in range(1, how.levels + 1):
        sizes = here.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
        sizes = common.written(sizes, "sizes")
        fits = F.col("size") <= how.node_rows
        last = level == how.levels
        ready = here.join(sizes.filter(fits).select("path"), "path").select("path", F.lit(0).alias("pair"), "rep", F.lit(level).alias("level"))
        leaves = ready if leaves is None else leaves.unionByName(ready)
        large = sizes.filter(~fits)
        if not large.limit(1).count():
            break
        over = here.join(large, "path")
        if last:
            # copies of thousands of kinds that no coordinate tells apart: compared in pairs of blocks, each of bounded size
            blocks = F.ceil(F.col("size") / F.lit(how.node_rows // 2)).cast("int")
            over = over.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
            over = over.select("path", "rep", "block", "blocks", other)
            pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
            leaves = leaves.unionByName(over.select("path", pair.alias("pair"), "rep", F.lit(level).alias("level")))
        else:
            here = common.written(over.select("path", "rep").join(minima, "rep").select("path", "rep", "minima").mapInArrow(branched, "path long, rep long"), "nodes")

    def compared(batches):
        for table in by_key(batches, "key"):
            keys, reps, n = (table.column(c).to_numpy() for c in ("key", "rep", "n"))
            paths, level = table.column("path").to_numpy().view(np.uint64), table.column("level").to_numpy()
            node = Node(n, _matrix(table.column("minima"), how), how)
            same: dict[int, list[int]] = {}
            for a, b in _runs(keys):
                if b - a <= 24:
                    same.setdefault(b - a, []).append(a)
                else:
                    node.grow(np.arange(a, b), paths[a], int(level[a]))
            for size, starts in same.items():
                if size > 1:
                    node.equal_sized(np.array(starts)[:, None] + np.arange(size))
            yield _edges(reps[[x for x, _ in node.links]], reps[[y for _, y in node.links]])

    key = F.when(F.col("pair") == 0, F.col("path")).otherwise(F.xxhash64("path", "pair"))
    full = leaves.join(minima, "rep").select(key.alias("key"), "path", "level", "rep", "n", "minima")
    return full.repartition("key").sortWithinPartitions("key").mapInArrow(compared, "u long, v long")


def confirmed(reps: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the sets as every pair with the asked similarity would, found on the full sets.

    One set at a time is intersected with all others; sets of the largest part need no turn of their own, as any link from
    outside is found from the outside.
    """
    forest, links, m = Forest(len(sets)), [], len(sets)
    sizes = np.array([len(s) for s in sets])
    whole, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flags = np.zeros(len(whole), bool)
    turn = np.ones(m, bool)
    part = np.arange(m)
    while True:
        names, count = np.unique(part, return_counts=True)
        if len(names) == 1:
            return links
        waiting = np.flatnonzero(turn & (part != names[count.argmax()])) if count.max() > 1 else np.flatnonzero(turn)
        if not len(waiting):
            return links
        p = int(waiting[0])
        turn[p] = False
        own = ids[starts[p] : starts[p] + sizes[p]]
        flags[own] = True
        shared = np.add.reduceat(flags[ids], starts, dtype=np.int64)
        flags[own] = False
        for q in np.flatnonzero(100 * shared >= percent * (sizes[p] + sizes - shared)).tolist():
            if forest.join(p, q):
                links.append((reps[p], reps[q]))
                part = np.array([forest.root(x) for x in range(m)]) if m < 64 else np.where(part == max(part[p], part[q]), min(part[p], part[q]), part)


def near_groups(docs: DataFrame, how: Join, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links), kept.

    Documents with the same set of shingles are one class from the start; only classes go through the trees. The proposed components
    are read again and confirmed on the full sets, in blocks of a bounded number of shingles where a component is large. Documents
    without words or text have an empty set and link with nothing. A class is known by a hash of its set, so an id on rows with
    different texts has a class for each of them. Rows with a null id are left out and come back with a null component, kept. An
    empty table gives no row.
    """
    import pyarrow as pa

    rows = common.written(sketches(docs, how, text), "sketches")
    sets = rows.filter("n > 0 and doc_id is not null")
    classes = sets.groupBy("whole", "n").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.min("minima").alias("minima"))
    classes = common.written(classes.select("whole", "n", F.xxhash64("whole", "n").alias("rep"), "first.doc_id", "first.mark", "minima"), "classes")
    candidates = common.components(common.written(proposals(classes, how), "proposed"))
    members = common.written(candidates.join(classes.select("rep", "n"), F.col("node") == F.col("rep")).select("rep", "component", "n"), "members")
    volume = members.groupBy("component").agg(F.sum("n").alias("volume"))
    spread = members.join(common.written(volume, "volume"), "component")
    spread = spread.withColumn("blocks", F.greatest(F.ceil(F.col("volume") / F.lit(how.block_shingles)), F.lit(1)).cast("int"))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spread = spread.select("rep", "component", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    spread = spread.select("rep", F.xxhash64("component", pair).alias("key")).distinct()

    def verified(batches):
        for table in by_key(batches, "key"):
            keys, reps = table.column("key").to_numpy(), table.column("rep").to_pylist()
            texts = table.column("text").to_pylist()
            found = []
            for a, b in _runs(keys):
                own = dict(zip(reps[a:b], texts[a:b], strict=True))
                if len(own) > 1:
                    found += confirmed([*own], [shingles(t, how.width) for t in own.values()], how.percent)
            yield _edges([x for x, _ in found], [y for _, y in found])

    wanted = spread.join(classes.select("rep", "doc_id", "mark"), "rep")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), common.text_bytes(text).alias("text"))
    full = wanted.join(texts, ["doc_id", "mark"]).select("key", "rep", "text").repartition("key").sortWithinPartitions("key")
    linked = common.components(common.written(full.mapInArrow(verified, "u long, v long"), "links"))
    joined = linked.join(classes.select("rep", "doc_id"), F.col("node") == F.col("rep"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("least"))
    linked = common.written(joined.join(least, "component").select("node", F.col("least").alias("component")), "least")
    named = classes.select("whole", "n", "rep", "doc_id").join(linked, F.col("rep") == F.col("node"), "left")
    named = common.written(named.select("whole", "n", F.coalesce("component", "doc_id").alias("component")), "named")
    out = rows.select("doc_id", "n", "whole").join(named, ["whole", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents by sets of two-word shingles."""
    return near_groups(common.table(spark, sf_dir, "documents"), Join())
