"""Spelling variants by reduced alphabets: words over few symbols, their one-edit neighbourhoods joined with the reduced vocabulary.

Letters are hashed to a few symbols. Words that differ by one edit have reduced words that differ by one edit at most, so every pair
meets where the neighbourhood of one reduced word holds the other. The originals decide.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common


@dataclass(frozen=True)
class Variants:
    letters: int = 6  # least code points of a word
    times: int = 5  # least occurrences of a word, and how many times as frequent its form is
    noise: int = 199  # a run whose hash this divides loses a code point; 0: none does
    symbols: int = 6
    long: int = 64  # longer words meet by their ends instead of by neighbourhoods
    end: int = 24  # letters of an end


RUNS = r"[a-zÀ-ÿ]"
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that powers keep 64 bits


def _counted(how: Variants):
    """(word, n) of each task, from (doc_id, text in bytes)."""
    import pyarrow as pa

    def run(batches):
        runs = regex.compile(f"{RUNS}{{{how.letters},}}")
        seen: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Counter(runs.findall(text.lower().decode("utf-8", "replace")))  # bytes: only A-Z are lowered
                if how.noise:
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    hit = [(w, h) for w in found if (h := zlib.crc32(w.encode(), start)) % how.noise == 0]
                    lost = [(w, h % len(w), found.pop(w)) for w, h in hit]
                    for w, at, n in lost:
                        if len(w) > how.letters:
                            found[w[:at] + w[at + 1 :]] += n
                seen.update(found)
                if len(seen) > 400_000:
                    yield out()
                    seen.clear()
        yield out()

    return run


def vocabulary(docs: DataFrame, how: Variants = Variants(), text: str = "text") -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough. Null texts have none, a null id counts as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes(text).alias("text"))
    words = rows.mapInArrow(_counted(how), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= how.times)


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """Words of one length as rows of symbols from 1 on."""
    n = len(words[0])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n)
    return common.mix64(points.ravel().astype(np.uint64) + np.uint64(1)).reshape(points.shape) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]), dtype=np.uint64)


def keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial of each row of symbols."""
    return (rows * _powers(rows.shape[1])[: rows.shape[1]]).sum(axis=1, dtype=np.uint64)


def neighbourhoods(rows: np.ndarray, symbols: int) -> np.ndarray:
    """Per row the polynomials of the row itself, of every row with one symbol replaced and of every row with one symbol less.

    Rows with one symbol more are left to the longer word of a pair, whose neighbourhood holds the shorter one.
    """
    n = rows.shape[1]
    power = _powers(n)
    terms = rows * power[:n]
    own = terms.sum(axis=1, dtype=np.uint64)[:, None]
    steps = np.arange(1, symbols, dtype=np.uint64)
    other = (rows[:, :, None] - np.uint64(1) + steps) % np.uint64(symbols) + np.uint64(1)
    replaced = own[:, :, None] - terms[:, :, None] + other * power[None, :n, None]
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    shifted = rows * np.concatenate([[np.uint64(0)], power[: n - 1]])  # every symbol one place earlier
    after = shifted.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(shifted, axis=1, dtype=np.uint64)
    return np.concatenate([own, replaced.reshape(len(rows), -1), before + after], axis=1)


def _keyed(how: Variants, neighbours: bool):
    """Rows (key, size, word, n): a word under its own reduced word, or under all of its neighbourhood, each key once.

    Words over ``long`` letters, and those of just ``long`` as the shorter of a pair, stand under the hashes of both of their ends:
    an edit leaves one of them as it is.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            words, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            size = np.fromiter(map(len, words), np.int64, len(words))
            for length in np.unique(size).tolist():
                at = np.flatnonzero(size == length)
                for part in np.array_split(at, 1 + len(at) // 4096):
                    if length <= how.long and len(part):
                        rows = reduced(words[part].tolist(), how.symbols)
                        key = neighbourhoods(rows, how.symbols) if neighbours else keys(rows)[:, None]
                        yield from out(key, words[part], n[part], pa)
                if length > how.long or length == how.long and not neighbours:
                    ends = [[zlib.crc32(w[: how.end].encode()) << 1, zlib.crc32(w[-how.end :].encode()) << 1 | 1] for w in words[at]]
                    yield from out(np.array(ends, np.uint64) | np.uint64(1 << 40), words[at], n[at], pa)

    def out(key: np.ndarray, words: np.ndarray, n: np.ndarray, pa):
        key = np.sort(key, axis=1)
        fresh = np.ones(key.shape, bool)
        fresh[:, 1:] = key[:, 1:] != key[:, :-1]
        of = np.repeat(np.arange(len(key)), fresh.sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[fresh].view(np.int64)), pa.array(words, pa.string()).take(pa.array(of)), pa.array(n).take(pa.array(of))], names=["key", "word", "n"]
        )

    return run


def near_pairs(vocabulary: DataFrame, how: Variants = Variants()) -> DataFrame:
    """(a, n_a, b, n_b): every two words that differ by exactly one inserted, deleted or replaced code point, each pair once."""
    kind = "key long, word string, n long"
    words = vocabulary.select("word", "n")
    around = words.mapInArrow(_keyed(how, True), kind).withColumnsRenamed({"word": "a", "n": "n_a"})
    plain = words.mapInArrow(_keyed(how, False), kind).withColumnsRenamed({"word": "b", "n": "n_b"})
    longer = F.length("a") - F.length("b")
    found = around.join(plain, "key").filter((longer == 1) | ((longer == 0) & (F.col("a") < F.col("b"))))
    found = found.filter(F.levenshtein("a", "b", 1) == 1)
    # words that agree in both ends have met twice
    return found.select("a", "n_a", "b", "n_b").filter(F.length("a") <= how.long).unionByName(
        found.filter(F.length("a") > how.long).select("a", "n_a", "b", "n_b").distinct()
    )


def forms(vocabulary: DataFrame, pairs: DataFrame, how: Variants = Variants()) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n. A form is at least ``times`` times as frequent as its word, so a chain
    of forms has at most as many steps as the largest n has digits to that base, and following it twice as far each time ends."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n"))
    both = both.union(pairs.select("b", "a", "n_a"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = vocabulary.join(near, "word", "left")
    fits = -F.col("best.less") >= how.times * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"))
    found = common.written(found, "forms")
    step = common.written(found.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = common.written(step.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        step = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            break
    out = found.join(step, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, how: Variants = Variants(), text: str = "text") -> DataFrame:
    """Word, form, root, n, n_near and form_n of every word of ``docs``.

    Null and empty texts hold no word; an empty table gives no row. Rows that repeat an id or a text count each for itself; a null id
    enters the hash as empty. Ties for the form go to the smallest word in code-point order. Other columns are not read.
    """
    words = common.written(vocabulary(docs, how, text), "vocabulary")
    return forms(words, common.written(near_pairs(words, how), "near"), how)


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """The words of all documents."""
    return variants(common.table(spark, sf_dir, "documents"))
