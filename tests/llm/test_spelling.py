"""Spelling variants against a plain count and comparison of all one-edit neighbours."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np

from tablelift.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def plain(rows, noise=199, letters=6, times=5):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if noise and h % noise == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            count[word] += 1
    n = {w: c for w, c in count.items() if len(w) >= letters and c >= times}
    near, gaps = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            gaps[w[:k], w[k + 1 :]].add(w)
            shorter = w[:k] + w[k + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=str)


def test_documents_equal_the_plain_form(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op11_spelling_variants"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def made(rnd):
    """Long words, chains of forms, ties, words beside the bound of long ones, letters of two bytes and signs beyond them."""
    words = {"Straße": 400, "strasße": 60, "straẞe": 9, "letters": 125, "lettérs": 25, "lettérz": 5, "abcdef×": 30, "abcdef÷": 30, "abcdefg": 6}
    for n in (63, 64, 65, 66, 500):
        base = "".join(rnd.choice("abcdé") for _ in range(n))
        words[base] = 50
        for k in (0, n // 2, n - 1):
            words[base[:k] + base[k + 1 :]] = 5 + k % 7
            words[base[:k] + "z" + base[k + 1 :]] = 6
    words["a" * 64], words["a" * 65], words["a" * 66], words["a" * 65 + "b"] = 5, 30, 6, 7
    return [(i % 400, f"{w}, {w.upper() if w.isascii() else w}") for i, (w, n) in enumerate(words.items()) for _ in range((n + 1) // 2)]


def test_made_words(spark):
    rows = made(random.Random(1)) + [(None, "nullid " * 7), (3, None), (4, ""), (5, "tiny " * 50), (6, "same word\n" * 4), (6, "same word\n" * 4)]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, word string, n int, Form int")
    got = spelling.variants(df).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)
    calm = spelling.variants(df, spelling.Variants(noise=0, symbols=2, long=10, end=4)).collect()
    assert sorted(map(tuple, calm), key=str) == plain(rows, noise=0)
    assert spelling.variants(df.limit(0)).count() == 0


def test_neighbourhoods_hold_every_edit():
    rng = np.random.default_rng(0)
    for n in (2, 6, 11):
        rows = rng.integers(1, 4, (5, n)).astype(np.uint64)
        around = spelling.neighbourhoods(rows, 3)
        for row, keys in zip(rows, around, strict=True):
            edits = [row] + [np.concatenate([row[:k], [x], row[k + 1 :]]) for k in range(n) for x in (1, 2, 3)]
            less = [np.delete(row, k) for k in range(n)]
            wanted = {int(spelling.keys(np.array([e], np.uint64))[0]) for e in [*edits, *less]}
            assert wanted == set(keys.tolist())
