"""Cross-tokenizer alignment against the libraries on whole texts, token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tablelift.llm import alignment, queries, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECE_BPE))
    byte = {c: x for x, c in tokens.byte_letters().items()}
    special = a.get_added_tokens_decoder()
    a_bytes = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab().items() if i not in special}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def both(text):
        """Spans (id, from, to) of both tokenizers; None where they do not give back the text."""
        sides = []
        for ids, to_bytes in ((a.encode(" " + text, add_special_tokens=False).ids, a_bytes.get), (b.encode(text), b_bytes)):
            spans, at = [], 0
            for i in ids:
                spans.append((i, at, at + len(to_bytes(i))))
                at = spans[-1][2]
            if b"".join(to_bytes(i) for i in ids) != (" " + text).encode():
                return None
            sides.append(spans)
        return sides

    return both


def wanted(rows, both):
    found = []
    for doc, text in rows:
        sides = both(text) if text else None
        if sides is None:
            found.append((doc, None, None, [], []))
            continue
        a, b = sides
        links = [(x, y) for x, s, e in a for y, f, g in b if s < g and f < e] if len(a) * len(b) < 10**6 else []
        if not links:
            j = 0
            for x, s, e in a:
                while b[j][2] <= s:
                    j += 1
                k = j
                while k < len(b) and b[k][1] < e:
                    links.append((x, b[k][0]))
                    k += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [",".join(str(x) for x, s, e in a if lo <= s and e <= hi) + "|" + ",".join(str(x) for x, s, e in b if lo <= s and e <= hi) for lo, hi in zip([0, *cuts], cuts, strict=False)] if len(a) < 3000 else None
        found.append((doc, a, b, links, groups))
    counts = Counter(x for r in found for x in r[3])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (d, 0, 0, 0, 0, 0, 0, "") if a is None else (
            d, len(a), len(b), None if g is None else len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), None if g is None else hashlib.sha256(";".join(g).encode()).hexdigest())
        for d, a, b, x, g in found
    ]


def same(got, rows, both):
    left = [tuple(None if w[i] is None else v for i, v in enumerate(r[:8])) for r, w in zip(sorted(map(tuple, got), key=str), sorted(wanted(rows, both), key=str), strict=True)]
    assert sorted(left, key=str) == sorted(wanted(rows, both), key=str)


ODD = [
    (1, "a  b"), (2, " lead"), (3, "trail "), (4, "x\n\ny z"), (5, "\n"), (6, " "), (7, "▁a b"), (8, None), (9, ""), (10, "a \n b\t\tc"), (11, "中文 🙂 ½ é"),
    (12, "<|endoftext|> <s> </s> <unk>"), (14, "a b  c\x1c d\x85 e"), (15, "don't 'll  's"), (16, "ab\ncd"), (16, "ab\n cd"), (None, "ab cd"), (17, "\r\nq \r\n q"), (18, "\x00 \x00"), (18, "\x00 \x00"),
]


def test_documents_equal_the_libraries(spark, coders):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' where length(text) < 3000").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(alignment.aligned(df).collect(), rows, coders)
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_cross_tokenizer_alignment"](spark, SF).collect()}
    assert len(got) == duckdb.sql(f"select count(*) from '{SF}/documents.parquet'").fetchall()[0][0]


@pytest.mark.parametrize("frequent", [1_000_000, 50, 0])
def test_odd_texts_and_rare_pairs(spark, coders, frequent):
    rnd = random.Random(3)
    signs = " \n\tab,é中  1's.▁🙂\x1f"
    rows = ODD + [(100 + k, "".join(rnd.choice(signs if k % 3 else signs[:8]) for _ in range(rnd.randrange(1, 30)))) for k in range(400)]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, row int, n_a int, Best string")
    same(alignment.aligned(df, frequent=frequent).collect(), rows, coders)


def test_long_words_and_empty_tables(spark, coders):
    rows = [(1, "w" * 30_000), (2, "ab " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(alignment.aligned(df).collect(), rows, coders)
    assert alignment.aligned(df.limit(0)).count() == alignment.links(df.limit(0)).count() == 0


def test_links_are_products_of_incidences(spark, coders):
    rows = [(1, "unbelievable colours\nof naïveté 12345"), (2, "▁no"), (3, None)]
    got = alignment.links(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    a, b = coders(rows[0][1])
    shared = {(i, j): min(e, g) - max(s, f) for i, (_, s, e) in enumerate(a) for j, (_, f, g) in enumerate(b)}
    assert {r["doc_id"] for r in got} == {1}
    assert {(r["a_at"], r["b_at"]): r["bytes"] for r in got if r["bytes"]} == {k: v for k, v in shared.items() if v > 0}
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    group = lambda e: np.searchsorted(cuts, e)
    assert {(r["a_at"], r["b_at"], r["group_id"]) for r in got} == {(i, j, group(e)) for i, (_, _, e) in enumerate(a) for j, (_, _, g) in enumerate(b) if group(e) == group(g)}


def test_product_equals_dense():
    rng = np.random.default_rng(0)
    for n, k, m in ((5, 7, 4), (1, 1, 1), (20, 3, 9), (4, 6, 0)):
        x, y = (rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((n, k), (k, m)))
        csr = lambda d: alignment.Csr(np.concatenate([[0], np.cumsum((d != 0).sum(axis=1))]), np.nonzero(d)[1], d[np.nonzero(d)])
        made = alignment.product(csr(x), csr(y))
        dense = np.zeros((n, m), np.int64)
        dense[np.repeat(np.arange(n), np.diff(made.at)), made.columns] = made.values
        assert (dense == x @ y).all()
