"""Line dedup: an exact set-similarity join of lines by prefix, positional, length and bitmap filters; later matches are removed.

Lines are sets of words with A-Z lowered. Words are ordered from rare to frequent, and a line is listed under its first words only:
two lines as similar as asked share one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common
from tablelift.llm.common import mix64, parts
from tablelift.llm.near_dedup import by_key


@dataclass(frozen=True)
class Lines:
    percent: int = 80
    frequent: int = 200_000  # words whose exact rank is sent to all tasks; all others are rarer and come before them, by hash
    at_once: int = 16  # candidates of a line under one word that are verified in the first round; a second round has the rest
    block_rows: int = 4_000
    held_bits: int = 26  # bits, 8 MB, that tell words of one line from others
    sent_lines: int = 500_000  # up to so many lines to verify, their places are sent to all tasks; beyond it texts are joined with them

    def overlap(self, n, m):
        """Least number of common words of lines with n and m words: the smallest o with 100 * o >= percent * (n + m - o)."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def prefix(self, n):
        """Words under which a line of n words is listed."""
        return n - -(-self.percent * n // 100) + 1


def _sorted(*keys: np.ndarray) -> np.ndarray:
    """Order by keys that are not negative, the first one first; no two rows are alike. Packed into one number where that fits."""
    bits = [int(k.max()).bit_length() if len(k) else 0 for k in keys]
    if sum(bits) > 63:
        return np.lexsort(keys[::-1])
    packed = np.zeros(len(keys[0]), np.int64)
    for k, b in zip(keys, bits, strict=True):
        packed = (packed << b) | k
    return np.argsort(packed)


_byte = mix64(np.arange(1, 257))  # a random number for every byte: letters A-Z have those of a-z, white space has none
_byte[65:91] = _byte[97:123]
_white = np.zeros(256, bool)
_white[[32, *range(9, 14)]] = True
_byte[_white] = 0


class Sets:
    """The word sets of all lines of some texts, as flat arrays: ``words`` holds the distinct words of line after line, by hash.

    A word's hash is the sum of its bytes' numbers, each times a number of its place in the word, so all words of the texts are hashed
    at once.
    """

    def __init__(self, texts: list[bytes]) -> None:
        self.lines = np.fromiter((t.count(b"\n") + 1 for t in texts), np.int64, len(texts))
        count = int(self.lines.sum())
        flat = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        white = _white[flat]
        first = np.concatenate([[True], white[:-1]]) & ~white
        begins = np.flatnonzero(first)
        if len(begins):
            low = begins[0]
            place = np.arange(low, len(flat)) - np.repeat(begins, np.diff(np.append(begins, len(flat))))
            place[white[low:]] = 0
            by_place = mix64(np.arange(1 << 20, (1 << 20) + int(place.max()) + 1)) | np.uint64(1)
            h = mix64(np.add.reduceat(_byte[flat[low:]] * by_place[place], begins - low))
        else:
            h = np.empty(0, np.uint64)
        of = np.cumsum(flat == 10)[begins]
        shift = np.uint64(max(1, int(count).bit_length()))
        packed = (of.astype(np.uint64) << (np.uint64(64) - shift)) | (h >> shift)  # line, then the upper bits of the hash
        order = np.argsort(packed)
        packed = packed[order]
        if np.any((packed[1:] == packed[:-1]) & (h[order][1:] != h[order][:-1])):  # hashes alike in these bits
            order = np.lexsort((h, of))
        h, of = h[order], of[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        self.words, self.of = h[new], of[new]
        self.size = np.bincount(self.of, minlength=count)
        self.start = np.cumsum(self.size) - self.size
        self.doc = np.repeat(np.arange(len(texts)), self.lines)
        self.number = np.arange(count) - np.repeat(np.cumsum(self.lines) - self.lines, self.lines)
        self.full = np.flatnonzero(self.size)  # lines with words

    def reduce(self, how: np.ufunc, values: np.ndarray) -> np.ndarray:
        """``values`` of the words combined per line with words."""
        return how.reduceat(values, self.start[self.full]) if len(self.full) else values[:0]

    def classes(self) -> np.ndarray:
        """A 64-bit name of the word set of every line with words."""
        total = self.reduce(np.add, mix64(self.words))
        return mix64(total + self.size[self.full].astype(np.uint64)).view(np.int64)


STEP = 1_000_000  # bytes of text hashed at once; the arrays of a step take some sixty times as much


def _sets(batch, column: int):
    """(rows of the batch, their Sets), a step of texts at a time."""
    texts = batch.column(column).to_pylist()
    for lo, hi in parts(texts, STEP):
        yield range(lo, hi), Sets(texts[lo:hi])


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """Ids and texts; rows without id or text have no lines."""
    return docs.filter(F.col("doc_id").isNotNull() & F.col(text).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))


def _read(batches):
    """(class, doc_id, line, number of words) of every line with words, and (word, null, null, lines that hold it), summed up for some
    millions of words at a time."""
    import pyarrow as pa

    held: list[tuple[np.ndarray, np.ndarray]] = []
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())

    def out(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, k) if c is not None else pa.nulls(len(columns[0]), k) for c, k in zip(columns, kinds, strict=True)], names=["name", "doc_id", "line", "n"])

    def counts():
        words, of = np.concatenate([w for w, _ in held]), np.concatenate([c for _, c in held])
        order = np.argsort(words)
        words, of = words[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        return words[first], np.add.reduceat(of, first)

    for batch in batches:
        ids = batch.column(0).to_numpy()
        for rows, sets in _sets(batch, 1):
            yield out((sets.classes(), ids[rows.start + sets.doc[sets.full]], sets.number[sets.full], sets.size[sets.full]))
            if len(sets.words):
                held.append(np.unique(sets.words, return_counts=True))
            if sum(len(w) for w, _ in held) > 2_000_000:
                held[:] = [counts()]
                if len(held[0][0]) > 1_000_000:
                    words, lines = held.pop()
                    yield out((words.view(np.int64), None, None, lines))
    if held:
        words, lines = counts()
        yield out((words.view(np.int64), None, None, lines))


class Ranks:
    """The order of words from rare to frequent, in bounded memory: words of one line, all others by hash, the most frequent by count.

    ``frequent`` has the hashes of the most frequent words in ascending order, ``rank`` and ``lines`` their place in the order (from 2) and their
    counts; no other word has more than ``rest`` lines. ``held`` has a bit for every word of two lines or more, at the upper bits of its hash;
    a word of one line may share it and is then taken for one of more, which costs a row and changes no result.
    """

    def __init__(self, frequent: np.ndarray, rank: np.ndarray, lines: np.ndarray, rest: int, held: np.ndarray) -> None:
        self.frequent, self.rank, self.lines, self.rest, self.held = frequent, rank, lines, rest, held
        self.first = np.searchsorted(frequent >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64)).astype(np.int32)
        self.longest = int(np.diff(self.first).max()) if len(frequent) else 0
        self.shift = np.uint64(64 - (8 * len(held)).bit_length() + 1)

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, most lines that may hold the word); order 0 and one line for a word that no other line has."""
        bit = words >> self.shift
        more = (self.held[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
        order, lines = more.astype(np.int64), np.where(more, self.rest, 1)
        bucket = (words >> np.uint64(44)).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        left = np.flatnonzero(at < end)
        for step in range(self.longest):
            left = left[at[left] + step < end[left]]
            place = at[left] + step
            same = self.frequent[place] == words[left]
            order[left[same]], lines[left[same]] = self.rank[place[same]], self.lines[place[same]]
        return order, lines


HELD_BLOCKS = 64


def _held(counts: DataFrame, bits: int) -> np.ndarray:
    """2 ** ``bits`` bits, set at the upper bits of the words of ``counts``; 64 blocks are filled in tasks, whatever the number of words."""
    import pyarrow as pa

    size = (1 << bits) // HELD_BLOCKS

    def run(batches):
        filled: dict[int, np.ndarray] = {}
        for batch in batches:
            at = (batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            for block in np.unique(at // size).tolist():
                own = np.unique(at[at // size == block] - block * size)
                np.bitwise_or.at(filled.setdefault(block, np.zeros(size // 8, np.uint8)), own >> 3, (1 << (own & 7)).astype(np.uint8))
        for block, x in filled.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "bytes": pa.array([x.tobytes()], pa.binary())})

    by_block = counts.select("word").repartition(HELD_BLOCKS, F.shiftrightunsigned("word", 64 - HELD_BLOCKS.bit_length() + 1))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in by_block.mapInArrow(run, "block int, bytes binary").collect():  # the bits, once
        out[r["block"] * (size // 8) : (r["block"] + 1) * (size // 8)] = np.frombuffer(r["bytes"], np.uint8)
    return out


ROW = "word long, class long, size int, place int, doc_id long, line int, low long, high long, heavy boolean"
COLUMNS = {n: np.dtype({"long": "<i8", "int": "<i4", "boolean": "?"}[k]) for n, k in (c.split() for c in ROW.split(", "))}
ROW_BYTES = sum(k.itemsize for k in COLUMNS.values())
HELD_ROWS = 200_000  # listed rows that a task holds, some 11 MB, before it deals them out


def _packed(columns: dict[str, np.ndarray], buckets: int):
    """(bucket, rows): the listed rows of each bucket as the bytes of one column after the other. Rows of a light word share a bucket; those of
    heavy ones are spread by class."""
    import pyarrow as pa

    by = mix64(np.where(columns["heavy"], columns["class"] ^ columns["word"], columns["word"])) % np.uint64(buckets)
    order = np.argsort(by, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], by[order][1:] != by[order][:-1]]))
    cuts = [*starts.tolist(), len(order)]
    sides = [columns[n][order].astype(k, copy=False) for n, k in COLUMNS.items()]
    blocks = [b"".join([x[lo:hi].tobytes() for x in sides]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(by[order][starts].astype(np.int32)), pa.array(blocks, pa.binary())], names=["bucket", "rows"])


def _unpacked(batches):
    """The listed rows of bucket after bucket, from packed batches sorted by bucket."""
    held: list[bytes] = []
    last = None

    def columns():
        out = {n: [] for n in COLUMNS}
        for block in held:
            n, at = len(block) // ROW_BYTES, 0
            for c, k in COLUMNS.items():
                out[c].append(np.frombuffer(block, k, n, at))
                at += n * k.itemsize
        held.clear()
        return {c: np.concatenate(x) for c, x in out.items()}

    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if held and bucket != last:
                yield columns()
            held.append(block.as_py())
            last = bucket
    if held:
        yield columns()


def _listed(docs: DataFrame, ranks: Ranks, how: Lines, text: str, buckets: int) -> DataFrame:
    """(bucket, rows) with a row per listed word of every distinct line of a task: word, class, size, place of the word, position, and a bitmap of
    128 bits, each the parity of the words that fall on it; ``heavy`` says that more than ``block_rows`` lines may hold the word. Words that no other
    line has take their places, but are not listed. Rows may come in any order: a line is listed again wherever it stands before
    the position listed so far, so its least listed position is its first one in the table."""

    def run(batches):
        done: dict[int, tuple[int, int]] = {}  # class -> least position listed
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for rows, sets in _sets(batch, 1):
                name = sets.classes()
                fresh = np.zeros(len(sets.size), bool)
                doc, number = ids[rows.start + sets.doc[sets.full]], sets.number[sets.full]
                by = np.lexsort((number, doc, name))
                by = by[np.concatenate([[True], name[by][1:] != name[by][:-1]])] if len(by) else by  # each class at its first position here
                for i, x, d, n in zip(sets.full[by].tolist(), name[by].tolist(), doc[by].tolist(), number[by].tolist(), strict=True):
                    if x not in done or (d, n) < done[x]:
                        done[x] = (d, n)
                        fresh[i] = True
                if len(done) > 300_000:
                    done.clear()
                bit = np.uint64(1) << (sets.words & np.uint64(63))
                upper = (sets.words & np.uint64(64)) > 0
                low = sets.reduce(np.bitwise_xor, np.where(upper, np.uint64(0), bit))
                high = sets.reduce(np.bitwise_xor, np.where(upper, bit, np.uint64(0)))
                used = np.flatnonzero(fresh[sets.of])
                words, of = sets.words[used], sets.of[used]
                order, lines = ranks.of(words)
                by = _sorted(of, order, used - sets.start[of])  # equal order: by hash
                place = used - sets.start[of]  # as many words of a line as before, so the same places
                at = np.flatnonzero((place < how.prefix(sets.size[of])) & (order[by] > 0))
                own, by = of[at], by[at]
                line = np.searchsorted(sets.full, own)
                columns = (words[by].view(np.int64), name[line], sets.size[own], place[at], ids[rows.start + sets.doc[own]], sets.number[own])
                columns += (low.view(np.int64)[line], high.view(np.int64)[line], lines[by] > how.block_rows)
                if len(own):
                    held.append(tuple(c.astype(k, copy=False) for c, k in zip(columns, COLUMNS.values(), strict=True)))
                    size += len(own)
                if size >= HELD_ROWS:
                    yield _packed(dict(zip(COLUMNS, map(np.concatenate, zip(*held, strict=True)), strict=True)), buckets)
                    held.clear()
                    size = 0
        if held:
            yield _packed(dict(zip(COLUMNS, map(np.concatenate, zip(*held, strict=True)), strict=True)), buckets)

    return _texts(docs, text).mapInArrow(run, "bucket int, rows binary")


def _met(rows: DataFrame, key: str, how: Lines, limit: int | None) -> DataFrame:
    """(later, earlier, more, row) of the candidates among all rows of a key; ``rows`` are sorted by it, or by bucket if they are packed. ``row`` holds
    rows that have to meet again: heavy ones, which pass, and those of lines with more than ``limit`` candidates under the key and of these
    candidates, each once."""
    import pyarrow as pa

    kinds = {"l": pa.int64(), "i": pa.int32(), "b": pa.bool_()}
    fields = [(n, kinds[k[0]]) for n, k in (c.split() for c in ROW.split(", "))]

    def again(columns):
        row = pa.StructArray.from_arrays([c.cast(k) for c, (_, k) in zip(columns, fields, strict=True)], fields=list(pa.struct(fields)))
        none = pa.nulls(len(row), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, pa.nulls(len(row), pa.bool_()), row], names=["later", "earlier", "more", "row"])

    packed = "bucket" in rows.columns

    def tables(batches):
        if packed:
            yield from _unpacked(batches)
            return
        for table in by_key(batches, key):
            yield {n: table.column(n).to_numpy(zero_copy_only=False) for n in table.column_names}

    def run(batches):
        for c in tables(batches):
            heavy = c.pop("heavy")
            if heavy.any():
                at = np.flatnonzero(heavy)
                yield again([*(pa.array(c[n][at]) for n, _ in fields[:-1]), pa.array(heavy[at])])
                c = {n: x[~heavy] for n, x in c.items()}
            c = {n: x.view(np.uint64) if n in ("low", "high") else x for n, x in c.items()}
            if not len(c[key]):
                continue
            for later, earlier, more, left in _table(c, key, how, limit):
                found = [pa.array(later, pa.int64()), pa.array(earlier, pa.int64()), pa.array(more, pa.bool_()), pa.nulls(len(later), pa.struct(fields))]
                yield pa.RecordBatch.from_arrays(found, names=["later", "earlier", "more", "row"])
                if len(left):
                    columns = [c[key if n == "word" else n][left] for n, _ in fields[:-1]]
                    columns = [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in columns]
                    yield again([*columns, pa.array(np.zeros(len(left), bool))])

    return rows.mapInArrow(run, f"later long, earlier long, more boolean, row struct<{ROW.replace(' ', ':').replace(',:', ',')}>")


def candidates(listed: DataFrame, how: Lines) -> tuple[DataFrame, DataFrame]:
    """(later, earlier, more): lines that pass all filters under some word, as classes, the later first; at most ``at_once`` per line and word, those
    of the closest bitmaps, and ``more`` says that others are left. The second frame has the rows among which these others are found.

    The rows of a word meet in one bucket if no more than ``block_rows`` lines hold it. Those of other words are spread over all buckets, which
    let them pass; they are counted, reduced to one row a class, and meet in blocks, pair of blocks by pair of blocks.
    """
    met = common.written(_met(listed.repartition("bucket").sortWithinPartitions("bucket"), "word", how, how.at_once), "met")
    heavy = met.filter("row.heavy").select("row.*")
    heavy = heavy.groupBy("word", "class").agg(F.min_by(F.struct("size", "place", "doc_id", "line", "low", "high"), F.struct("doc_id", "line")).alias("r"))
    heavy = common.written(heavy.select("word", "class", "r.*"), "heavy")
    sizes = common.written(heavy.groupBy("word").agg(F.count("*").alias("rows")).filter("rows > 1"), "sizes")
    spread = heavy.join(sizes, "word")
    spread = spread.withColumn("blocks", F.ceil(F.col("rows") / F.lit(how.block_rows // 2)).cast("int")).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    spread = spread.withColumn("key", F.xxhash64("word", pair)).withColumn("heavy", F.lit(False)).drop("word", "rows", "blocks", "block", "other")
    blocks = common.written(_met(spread.repartition("key").sortWithinPartitions("key"), "key", how, how.at_once), "blocks")
    both = met.unionByName(blocks)
    return both.filter("row is null").drop("row"), both.filter("not row.heavy").select("row.*")


def others(rows: DataFrame, how: Lines, only: DataFrame) -> DataFrame:
    """(later, earlier): all candidates of the classes ``only`` among ``rows``, which met before."""
    asked = common.sent_if_small(only.select("class", F.lit(True).alias("asked")), 16)
    rows = rows.join(asked, "class", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    words = common.written(rows.filter("asked").select("word").distinct(), "asked")
    rows = rows.join(common.sent_if_small(words, 8), "word")
    return _met(rows.repartition("word").sortWithinPartitions("word"), "word", how, None).select("later", "earlier")


PAIRS = 250_000  # compared at a time


def _closest(j: np.ndarray, i: np.ndarray, apart: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs by j and distance, and whether each is one of the first ``limit`` of its j."""
    order = np.lexsort((i, apart, j))
    starts = np.flatnonzero(np.concatenate([[True], j[order][1:] != j[order][:-1]]))
    return order, np.arange(len(j)) - np.repeat(starts, np.diff(np.append(starts, len(j)))) < limit


def _table(c: dict[str, np.ndarray], by: str, how: Lines, limit: int | None):
    """The candidates under all words of a table, for some lines after the other: later and earlier classes, whether the later one has others
    under the word, and the rows of such lines and of their candidates. Lines of a word are in order of size, so that each is compared only with
    those before it that are long enough."""
    order = np.lexsort((c["line"], c["doc_id"], c["class"], c[by]))
    key, name = c[by][order], c["class"][order]
    order = order[np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])]  # each class at its first position
    turn = np.empty(len(c[by]), np.int64)
    turn[np.lexsort((c["class"], c["line"], c["doc_id"]))] = np.arange(len(turn))
    # in order of position; of one position (an id that occurs twice), neither is before the other
    order = order[np.lexsort((turn[order], c["size"][order], c[by][order]))]
    turn, key, name = turn[order], c[by][order], c["class"][order]
    doc, line, low, high = (c[n][order] for n in ("doc_id", "line", "low", "high"))
    size, place = c["size"][order].astype(np.int64), c["place"][order].astype(np.int64)
    asked = c["asked"][order] if "asked" in c else None
    _, group = np.unique(key, return_inverse=True)
    width = int(size.max()) + 1
    least = -(-how.percent * size // 100)
    start = np.searchsorted(group * width + size, group * width + least)  # the first line that is long enough
    count = np.arange(len(key)) - start
    total = np.cumsum(count)
    lo = 0
    while lo < len(key):
        # all pairs of the lines of a word are looked at together, so that a line's candidates are complete
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, "right"))
        hi = max(int(np.searchsorted(group, group[min(hi, len(key) - 1)])), lo) if hi < len(key) else hi
        hi = hi if hi > lo else int(np.searchsorted(group, group[lo], "right"))
        held = [np.empty(0, np.int64)] * 3  # later, earlier, distance
        again = np.zeros(len(key), bool)
        at = lo
        while at < hi:
            to = min(max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")), at + 1), hi)
            n = count[at:to]
            j = np.repeat(np.arange(at, to), n)
            i = np.arange(len(j)) + np.repeat(start[at:to] - (np.cumsum(n) - n), n)
            both = size[i] + size[j]
            need = how.overlap(both, 0)
            apart = np.bitwise_count(low[i] ^ low[j]).astype(np.int64) + np.bitwise_count(high[i] ^ high[j])
            fit = np.flatnonzero(both - apart >= 2 * need)
            i, j, need, apart = i[fit], j[fit], need[fit], apart[fit]
            p, q = place[i], place[j]
            fit = (np.minimum(size[i] - p, size[j] - q) + np.minimum(p, q) >= need) & ((doc[i] != doc[j]) | (line[i] != line[j]))
            i, j, apart = i[fit], j[fit], apart[fit]
            after = turn[i] > turn[j]
            i, j = np.where(after, j, i), np.where(after, i, j)
            if asked is not None:
                fit = asked[j]
                i, j, apart = i[fit], j[fit], apart[fit]
            at = to
            if limit is None:
                yield name[j], name[i], np.zeros(len(j), bool), order[:0]
                continue
            held = [np.concatenate(x) for x in zip(held, (j, i, apart), strict=True)]
            if len(held[0]) > 8 * PAIRS:  # one more than the limit stays, to tell that there are others
                by_line, close = _closest(*held, limit + 1)
                again[held[1][by_line[~close]]] = True
                held = [x[by_line[close]] for x in held]
        lo = hi
        if len(held[0]):
            by_line, close = _closest(*held, limit)
            j, i = held[0][by_line], held[1][by_line]
            open_lines = np.zeros(len(key), bool)
            open_lines[j[~close]] = True
            again[i[open_lines[j]]] = True
            yield name[j[close]], name[i[close]], open_lines[j[close]], order[np.flatnonzero(again | open_lines)]


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, how: Lines, text: str) -> DataFrame:
    """(later, earlier) of the pairs whose full sets are as similar as asked; sets come from each class's first line."""
    import pyarrow as pa

    named = pairs.select(F.col("later").alias("class")).union(pairs.select(F.col("earlier").alias("class"))).distinct()
    wanted = named.join(classes, "class").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line", "class"))).alias("wanted"), F.count("*").alias("n"))
    wanted = common.written(wanted, "wanted")
    lines = wanted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted = F.broadcast(wanted.drop("n")) if lines <= how.sent_lines else wanted.drop("n")

    def own(batches):
        for batch in batches:
            wanted, names, found = batch.column(1).to_pylist(), [], []
            for rows, sets in _sets(batch, 0):
                name = dict(zip(sets.full.tolist(), sets.classes().tolist(), strict=True))
                first = np.cumsum(sets.lines) - sets.lines
                for i, row in enumerate(rows):
                    for w in wanted[row]:
                        at = int(first[i]) + w["line"]
                        # an id that occurs twice has two texts; only the line meant has this class
                        if w["line"] < sets.lines[i] and name.get(at) == w["class"]:
                            names.append(w["class"])
                            found.append(sets.words[sets.start[at] : sets.start[at] + sets.size[at]].tobytes())
            yield pa.RecordBatch.from_pydict({"class": pa.array(names, pa.int64()), "words": pa.array(found, pa.binary())})

    sets = _texts(docs, text).join(wanted, "doc_id").select("text", "wanted").mapInArrow(own, "class long, words binary")
    sets = common.written(sets.dropDuplicates(["class"]), "sets")
    both = pairs.join(sets.select(F.col("class").alias("later"), F.col("words").alias("x")), "later")
    both = both.join(sets.select(F.col("class").alias("earlier"), F.col("words").alias("y")), "earlier").select("later", "earlier", "x", "y")

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                n, m = len(x) // 8, len(y) // 8
                both = n + m - len(np.unique(np.frombuffer(x + y, np.uint64)))
                keep.append(100 * both >= how.percent * (n + m - both))
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["later", "earlier"])

    return both.mapInArrow(check, "later long, earlier long")


BUCKETS = 1_000  # at least, so that tasks get even shares
BUCKET_WORDS = 1_000_000  # of all lines, in a bucket of a large table


def removed_lines(docs: DataFrame, how: Lines = Lines(), text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed (numbers of its removed lines, from 0, in order).

    A line goes if any line before it, by id and then by number, has word sets with a Jaccard similarity of at least ``percent``;
    whether that line stays itself does not matter. Lines without words stay. A null text has no lines, an empty one a single line.
    Rows that repeat an id hold lines at the same positions, which are not before each other; their removed lines are one list. Null ids
    take no part. Lines with equal word sets are told by 64-bit hashes, as are words. An empty table gives no row.
    """
    read = common.written(_texts(docs, text).mapInArrow(_read, "name long, doc_id long, line int, n long"), "read")
    lines = read.filter("doc_id is not null").select(F.col("name").alias("class"), "doc_id", "line")
    classes = lines.groupBy("class").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("lines")).select("class", "first.doc_id", "first.line", "lines")
    classes = common.written(classes, "classes")
    counts = read.filter("doc_id is null").groupBy(F.col("name").alias("word")).agg(F.sum("n").alias("lines"))
    counts = common.written(counts.filter("lines > 1"), "words")
    top = common.most_frequent(counts, "lines", how.frequent).toPandas().sort_values(["lines", "word"], ascending=[False, True])  # bounded
    frequent = top["word"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(frequent)
    rank = np.arange(len(frequent) + 1, 1, -1)[by_hash]  # the most frequent last
    lowest = int(top["lines"].min()) if len(top) else 1
    largest = counts.filter(F.col("lines") < lowest) if len(top) else counts
    rest = largest.agg(F.coalesce(F.max("lines"), F.lit(1))).first()[0]
    ranks = Ranks(frequent[by_hash], rank, top["lines"].to_numpy(np.int64)[by_hash], rest, _held(counts, how.held_bits))
    spoken = counts.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]  # a fifth of them is listed, or little more
    listed = _listed(docs, ranks, how, text, max(BUCKETS, spoken // BUCKET_WORDS))
    met, left = candidates(listed, how)
    pairs = common.written(met.groupBy("later", "earlier").agg(F.max("more").alias("more")), "pairs")
    found = common.written(verified(docs, pairs, classes, how, text), "found")
    open_classes = pairs.groupBy("later").agg(F.max("more").alias("more")).filter("more").join(found.select("later").distinct(), "later", "left_anti")
    open_classes = common.written(open_classes.select(F.col("later").alias("class")), "open")
    if not open_classes.isEmpty():
        rest = common.written(others(left, how, open_classes).distinct().join(pairs, ["later", "earlier"], "left_anti"), "pairs")
        found = found.unionByName(common.written(verified(docs, rest, classes, how, text), "found"))
    gone = found.select(F.col("later").alias("class"), F.lit(True).alias("gone")).distinct()
    decided = classes.select("class", F.struct("doc_id", "line").alias("first"), "lines").join(gone, "class", "left")
    decided = decided.filter("gone or lines > 1").drop("lines")  # the only line of a class is its first
    flagged = lines.join(common.written(decided, "decided"), "class")
    flagged = flagged.filter(F.coalesce("gone", F.lit(False)) | (F.struct("doc_id", "line") != F.col("first")))
    flagged = flagged.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed"))
    total = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1, F.lit(0)).alias("n_lines"))
    out = total.join(flagged.withColumnRenamed("doc_id", "own"), F.col("doc_id") == F.col("own"), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def cleaned(docs: DataFrame, removed: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the removed lines; columns as they are, whatever their names."""
    own, gone = common.free(docs, "line_doc"), common.free(docs, "line_gone")
    left = F.filter(F.split(F.col(text), "\n", -1), lambda line, i: ~F.coalesce(F.array_contains(gone, i), F.lit(False)))
    marks = removed.filter("n_removed > 0").select(F.col("doc_id").alias(own), F.col("removed").alias(gone)).dropDuplicates([own])
    out = docs.join(marks, F.col("doc_id") == F.col(own), "left")
    shorter = F.when(F.col(gone).isNotNull(), F.array_join(left, "\n")).otherwise(F.col(text)).alias(text)
    return out.select(*[shorter if c == text else F.col(f"`{c}`") for c in docs.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """The lines of all documents."""
    return removed_lines(common.table(spark, sf_dir, "documents"))
