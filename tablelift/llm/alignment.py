"""Cross-tokenizer alignment: token-byte incidence matrices in CSR form, whose products link the tokens of two tokenizers.

Texts are cut where both tokenizers always begin a new token: before a single space between other signs, and before a single line
break. Tokens of such a unit depend on nothing outside of it, so each unit is encoded and multiplied once and looked up from then on.
"""

from __future__ import annotations

import functools
import hashlib
import re
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common
from tablelift.llm.tokens import byte_letters

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
B_BITS, PAIR_BITS = 20, 40  # of the second id, and of a pair of ids in one integer
# Units of these signs are merged from the ranks of the vocabulary; all others go through the whole library.
PLAIN = re.compile(r"[\n\x20-\x7eÀ-ÖØ-öø-ÿ]{1,200}")
CUT = re.compile(r"(?<=[^ ])(?= \S)|(?<=\S)(?=\n\S)")
UNEVEN = re.compile(r"\s\s")
SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


class Csr(NamedTuple):
    """Rows of a sparse matrix: ``at[i]:at[i+1]`` are the places of row i in ``columns`` and ``values``."""

    at: np.ndarray
    columns: np.ndarray
    values: np.ndarray


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] numbers, then those of the next run."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def product(x: Csr, y: Csr) -> Csr:
    """x · y row by row: each entry (i, k) of x adds row k of y to row i of the result."""
    counts = np.diff(y.at)[x.columns]
    rows = np.repeat(np.repeat(np.arange(len(x.at) - 1), np.diff(x.at)), counts)
    from_y = _runs(y.at[x.columns], counts)
    columns, values = y.columns[from_y], np.repeat(x.values, counts) * y.values[from_y]
    if len(rows):
        fall = (rows[1:] == rows[:-1]) & (columns[1:] < columns[:-1])
        if fall.any():
            order = np.lexsort((columns, rows))
            rows, columns, values = rows[order], columns[order], values[order]
        first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])]))
        rows, columns, values = rows[first], columns[first], np.add.reduceat(values, first)
    return Csr(np.searchsorted(rows, np.arange(len(x.at))), columns, values)


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens by bytes, from the ends of tokens that lie one after another."""
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(total), np.ones(total, np.int64))


def transposed(x: Csr, columns: int) -> Csr:
    order = np.argsort(x.columns, kind="stable")
    rows = np.repeat(np.arange(len(x.at) - 1), np.diff(x.at))
    return Csr(np.searchsorted(x.columns[order], np.arange(columns + 1)), rows[order], x.values[order])


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> Csr:
    """A · Bᵀ: tokens of A by tokens of B, the bytes that they share."""
    a, b = token_bytes(ends_a), token_bytes(ends_b)
    return product(a, transposed(b, len(b.columns)))


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of every token of A and of B, and how many there are; groups end where tokens of both end."""
    place = np.searchsorted(ends_b, ends_a)
    cuts = ends_a[ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a] if len(ends_b) else ends_b
    return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), len(cuts)


def shared(group_a: np.ndarray, group_b: np.ndarray, groups: int) -> Csr:
    """A·Gᵀ of the token-group incidences: tokens of A by tokens of B that lie in one group."""
    a = Csr(np.arange(len(group_a) + 1), group_a, np.ones(len(group_a), np.int64))
    b = Csr(np.arange(len(group_b) + 1), group_b, np.ones(len(group_b), np.int64))
    return product(a, transposed(b, groups))


class Aligner:
    """Both tokenizers and the units seen so far: sums (SUMS), groups as text, and linked id pairs of each."""

    def __init__(self, file_a: str, file_b: str, entries: int = 400_000) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.entries = entries
        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        byte = {c: b for b, c in byte_letters().items()}
        special = self.a.get_added_tokens_decoder()
        vocabulary = {t: i for t, i in self.a.get_vocab().items() if i not in special}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}
        self.merge = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.a_bytes[i] = t
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of this vocabulary reaches over the end of a word")
        self.space = self.b.piece_to_id("▁")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.sums, self.ok = np.zeros((0, len(SUMS)), np.int64), np.zeros(0, bool)
        self.pairs, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    @staticmethod
    def units(text: str) -> list[str]:
        """Names of the units of " " + ``text``; a name is its unit without the first space, or a whole unit that begins with
        white space."""
        if not (UNEVEN.search(text) or text[0].isspace() or text[-1].isspace()):
            return text.replace("\n", " \n").split(" ")
        return [u if u[0] == "\n" or u[1:2].isspace() or len(u) == 1 else u[1:] for u in CUT.split(" " + text)]

    def encoded(self, names: list[str]) -> tuple[list[str], list[list[int]], list[list[int]]]:
        """The units named, and their ids by both tokenizers."""
        units = [n if n[0] in " \n" else " " + n for n in names]
        a = [self.merge(u) if PLAIN.fullmatch(u) else self.a.encode(u, add_special_tokens=False).ids for u in units]
        b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        # the library puts a space before a line break, too
        b = [ids if u[0] == " " else ids[1:] if ids[:1] == [self.space] else [] for u, ids in zip(units, b, strict=True)]
        return units, a, b

    def add(self, names: list[str]) -> None:
        """Encode and multiply units that are new, all in one pair of matrices."""
        units, a, b = self.encoded(names)
        fits = np.ones(len(units), bool)
        for i, (u, x, y) in enumerate(zip(units, a, b, strict=True)):
            plain = u.encode()
            if b"".join(map(self.a_bytes.__getitem__, x)) != plain or b"".join(map(self.b_bytes.__getitem__, y)) != plain:
                fits[i] = False
                a[i] = b[i] = []
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        linked = overlaps(ends_a, ends_b)
        of_a, of_b, groups = groups_of(ends_a, ends_b)
        unit_a = np.repeat(np.arange(len(units)), n_a)
        links = np.diff(linked.at)
        pairs = np.repeat(ids_a << B_BITS, links) | ids_b[linked.columns]
        per_group = np.bincount(of_a, minlength=groups) * np.bincount(of_b, minlength=groups)
        unit_of_group = np.zeros(groups, np.int64)
        unit_of_group[of_a] = unit_a
        count = functools.partial(np.bincount, minlength=len(units))
        n_links = count(unit_a, links).astype(np.int64)
        sums = np.stack([n_a, n_b, count(unit_of_group), n_links, count(unit_of_group, per_group)], axis=1).astype(np.int64)
        self.sums, self.ok = np.concatenate([self.sums, sums]), np.concatenate([self.ok, fits])
        self.pairs, self.at = np.concatenate([self.pairs, pairs]), np.concatenate([self.at, self.at[-1] + np.cumsum(n_links)])
        first_a, first_b = (np.concatenate([[0], np.cumsum(np.bincount(x, minlength=groups))]).tolist() for x in (of_a, of_b))
        text_a, text_b = list(map(self.a_text.__getitem__, ids_a.tolist())), list(map(self.b_text.__getitem__, ids_b.tolist()))
        of_unit = np.concatenate([[0], np.cumsum(count(unit_of_group))]).tolist()
        join = ",".join
        parts = [join(text_a[s:e]) + "|" + join(text_b[f:g]) for s, e, f, g in zip(first_a, first_a[1:], first_b, first_b[1:], strict=False)]
        self.index.update(zip(names, range(len(self.texts), len(self.texts) + len(names)), strict=True))
        self.texts += [parts[s] if e == s + 1 else ";".join(parts[s:e]) for s, e in zip(of_unit, of_unit[1:], strict=False)]

    def found(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(units of all texts by number, where each text's units begin)."""
        units = [self.units(t) if t else [] for t in texts]
        new = set().union(*units).difference(self.index)
        if new:
            self.add(list(new))
        flat = np.fromiter(map(self.index.__getitem__, chain.from_iterable(units)), np.int64)
        return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))])


@functools.lru_cache(maxsize=2)
def aligner(file_a: str, file_b: str) -> Aligner:
    """One per Python worker and pair of files."""
    return Aligner(file_a, file_b)


def _sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values`` summed from at[i] to at[i+1]."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[at[1:]] - total[at[:-1]]


def _batches(batches, column: int, model: Aligner):
    """(batch, rows, units by number, bounds, whether a text has tokens) of some megabytes of text at a time."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        for lo, hi in common.parts(texts, 2_000_000):
            if len(model.index) > model.entries:
                model.clear()
            flat, at = model.found([t.decode("utf-8", "replace") for t in texts[lo:hi]])
            yield batch, range(lo, hi), flat, at, (np.diff(at) > 0) & (_sum((~model.ok[flat]).astype(np.int64), at) == 0)


LINKED = ", ".join(f"{s} long" for s in SUMS) + ", groups_sha256 string, pairs array<long>, times array<int>"


def linked(docs: DataFrame, text: str = "text", files: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: row (a number of its own), doc_id, SUMS, groups_sha256, and the distinct pairs of ids that its links
    hold, in order, with how many links hold each."""
    import pyarrow as pa
    from pyspark import TaskContext

    files = files or (public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))

    def run(batches):
        model, row = aligner(*files), TaskContext.get().partitionId() << 32
        for batch, rows, flat, at, valid in _batches(batches, 1, model):
            sums = _sum(model.sums[flat], at) * valid[:, None]
            digests = [hashlib.sha256(";".join(map(model.texts.__getitem__, flat[s:e].tolist())).encode()).hexdigest() if v else "" for s, e, v in zip(at, at[1:], valid, strict=False)]
            used = flat[np.repeat(valid, np.diff(at))]
            held = model.pairs[_runs(model.at[used], np.diff(model.at)[used])]
            held = np.sort((np.repeat(np.arange(len(rows)), sums[:, SUMS.index("n_links")]) << PAIR_BITS) | held)
            first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.zeros(0, np.int64)
            times, held = np.diff(np.append(first, len(held))), held[first]
            cuts = pa.array(np.searchsorted(held >> PAIR_BITS, np.arange(len(rows) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(held & ((1 << PAIR_BITS) - 1))), pa.ListArray.from_arrays(cuts, pa.array(times, pa.int32()))]
            numbers = [pa.array(range(row, row + len(rows)), pa.int64()), batch.column(0).slice(rows.start, len(rows)), *[pa.array(c) for c in sums.T]]
            row += len(rows)
            yield pa.RecordBatch.from_arrays([*numbers, pa.array(digests, pa.string()), *lists], names=["row", "doc_id", *SUMS, "groups_sha256", "pairs", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes(text).alias("text"))
    return rows.mapInArrow(run, f"row long, doc_id long, {LINKED}")


def _flat(batch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False)


def _pair_sums(batches):
    """(pair, n) of each task, from lists of pairs and times."""
    import pyarrow as pa

    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate([n for _, n in held]), len(pairs)).astype(np.int64)

    def out():
        pairs, n = merged()
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    for batch in batches:
        held.append((_flat(batch, "pairs"), _flat(batch, "times").astype(np.int64)))
        if sum(len(p) for p, _ in held) > 4_000_000:
            held[:] = [merged()]
            if len(held[0][0]) > 2_000_000:
                yield out()
    if held:
        yield out()


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, a, b, n, best) of the rows of ``linked``: how many links hold the ids a and b linked, and whether no id of the first
    tokenizer is linked with b more often."""
    counts = rows.select("pairs", "times").mapInArrow(_pair_sums, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = common.written(counts.select("pair", F.shiftright("pair", B_BITS).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)).cast("int").alias("b"), "n"), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def links(docs: DataFrame, text: str = "text", files: tuple[str, str] | None = None) -> DataFrame:
    """Every link of every text: doc_id, group_id, a_at, b_at (token numbers), a, b (ids), bytes (shared; 0: they only lie in one group)."""
    import pyarrow as pa

    files = files or (public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))
    names = ["doc_id", "group_id", "a_at", "b_at", "a", "b", "bytes"]

    def run(batches):
        model = aligner(*files)
        for batch, rows, flat, at, valid in _batches(batches, 1, model):
            for i, row in enumerate(rows):
                if not valid[i]:
                    continue
                group = token_a = token_b = 0
                for lo in range(int(at[i]), int(at[i + 1]), 2000):
                    chosen = [model.texts[u] for u in flat[lo : min(lo + 2000, at[i + 1])].tolist()]
                    sides = [[list(map(int, s.split(","))) for s in g.split("|")] for u in chosen for g in u.split(";")]
                    ids_a, ids_b = (np.array([x for g in sides for x in g[k]]) for k in (0, 1))
                    ends_a, ends_b = np.cumsum(model.a_size[ids_a]), np.cumsum(model.b_size[ids_b])
                    of_a, of_b, n = groups_of(ends_a, ends_b)
                    both, over = shared(of_a, of_b, n), overlaps(ends_a, ends_b)
                    key = lambda x: np.repeat(np.arange(len(ids_a)), np.diff(x.at)) * len(ids_b) + x.columns
                    all_links, value = key(both), np.zeros(len(both.columns), np.int64)
                    value[np.searchsorted(all_links, key(over))] = over.values
                    a, b = all_links // len(ids_b), all_links % len(ids_b)
                    columns = (of_a[a] + group, a + token_a, b + token_b, ids_a[a], ids_b[b], value)
                    ids = batch.column(0).slice(row, 1).take(pa.array(np.zeros(len(a), np.int64)))
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int64()) for c in columns]], names=names)
                    group, token_a, token_b = group + n, token_a + len(ids_a), token_b + len(ids_b)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, group_id long, a_at long, b_at long, a long, b long, bytes long")


def aligned(docs: DataFrame, text: str = "text", files: tuple[str, str] | None = None, frequent: int = 1_000_000) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared (pairs in one group).

    Texts are encoded once; their links are written as lists of distinct pairs and read again for the counts and for the sums.
    Counts of at most ``frequent`` pairs of ids, the most frequent ones, are sent to all tasks; links of all other pairs are joined.
    Null and empty texts, and texts whose tokens do not give back the text, have zeros and an empty digest and add nothing to the
    counts. Rows that repeat an id, or have none, are rows of their own. An empty table gives no row. Other columns are not read.
    """
    import pyarrow as pa

    rows = common.written(linked(docs, text, files), "linked")
    counts = common.written(pair_counts(rows), "counts")
    top = common.most_frequent(counts, "n", frequent).select("pair", "n", "best").toPandas().sort_values("pair")  # bounded by the parameter
    known = docs.sparkSession.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))

    def run(batches):
        pairs, n, best = known.value
        for batch in batches:
            held, times = _flat(batch, "pairs"), _flat(batch, "times").astype(np.int64)
            at = np.concatenate([[0], np.cumsum(batch.column("pairs").value_lengths().to_numpy())])
            place = np.minimum(np.searchsorted(pairs, held), max(len(pairs) - 1, 0))
            hit = pairs[place] == held if len(pairs) else np.zeros(len(held), bool)
            each = np.zeros((len(held), 2), np.int64)
            each[hit, 0], each[hit, 1] = times[hit] * best[place[hit]], times[hit] * n[place[hit]]
            sums = _sum(each, at)
            left = np.flatnonzero(~hit)
            rest = pa.StructArray.from_arrays([pa.array(held[left]), pa.array(times[left])], ["pair", "times"])
            rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(left, at), pa.int32()), rest)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sums[:, 0]), pa.array(sums[:, 1]), rest], names=["row", "best", "total", "rare"])

    found = rows.select("row", "pairs", "times").mapInArrow(run, "row long, best long, total long, rare array<struct<pair: bigint, times: bigint>>")
    found = common.written(found, "summed")
    rest = found.select("row", F.explode("rare").alias("rare")).select("row", "rare.pair", "rare.times")
    rest = rest.join(counts.select("pair", "n", F.col("best").cast("long").alias("is_best")), "pair")
    rest = rest.select("row", (F.col("times") * F.col("is_best")).alias("best"), (F.col("times") * F.col("n")).alias("total"))
    sums = found.select("row", "best", "total").unionByName(rest).groupBy("row").agg(F.sum("best").alias("n_best"), F.sum("total").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")


def op12_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    """The texts of all documents."""
    return aligned(common.table(spark, sf_dir, "documents"))
