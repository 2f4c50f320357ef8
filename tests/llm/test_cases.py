"""Cases that operators once got wrong: clashing names, ids with two texts, filters that must matter, few dimensions, long texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelift.llm import embedding_dedup, exact_dedup, language_id, line_dedup, mixing, near_dedup, toxicity

NAMES = ("_draw", "_prior", "_own", "_last", "tilt", "Size", "Score", "removed", "Copies", "Lang_Pred", "mix_draw", "copy_sha", "near_doc", "own_1", "line_doc")


@pytest.fixture(scope="module")
def named(spark):
    """Texts in two languages with copies and near copies, beside columns named as those of the operators."""
    words = {"en": "the of and with for this that from which have", "de": "der die das und mit von nicht eine sich auch"}
    rows = []
    for lang, text in words.items():
        own = text.split()
        for i in range(30):
            body = [own[(i * k + k * k) % 10] + ("er" if (i + k) % 3 else "ing") for k in range(60)]
            rows.append((len(rows), " ".join(body), lang, f"s{i % 3}"))
            if i % 5 == 0:
                rows.append((len(rows), "  " + " ".join(body), lang, "s0"))
            if i % 5 == 1:
                rows.append((len(rows), " ".join([*body, "odd"]), lang, "s1"))
    rows += [(5, rows[5][1], "en", "s2"), (7, None, None, None), (None, "the of and with this " * 9, "en", None), (900, "", "de", "s1"), (901, "123 !!", None, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({n: F.lit(f"own {n}") for n in NAMES}).repartition(3)


def test_clashing_names_pass(spark, named):
    mixed = mixing.mix(named)
    assert [c for c in mixed.columns if c.lower() in ("size", "copies")] == ["size", "copies"]
    assert {r["tilt"] for r in mixed.collect()} == {"own tilt"} and mixed.count() == named.count()
    found = language_id.identify(named, language_id.learn(named))
    assert "Score" not in found.columns and found.filter("score >= 0").count() == named.count()
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.tag(named, toxicity.learn(named, labels, F.lit(True))).filter("score >= 0").count() == named.count()
    cleaned = line_dedup.cleaned(named, line_dedup.removed_lines(named))
    assert cleaned.columns == named.columns and {r["removed"] for r in cleaned.collect()} == {"own removed"}


def test_the_whole_pipeline(spark, named, tmp_path):
    """Which rows remain after each stage, by plain means; and all words of the mix are packed."""
    import corpus_pipeline

    from tablelift.llm import packing, tokens

    named.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{tmp_path}/{len(kept)}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == named.columns
        assert docs.select(*NAMES).distinct().count() == 1
        kept[name] = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [(r["doc_id"], r["text"]) for r in named.collect()]
    language = language_id.identify(named, language_id.learn(named)).filter("accepted").collect()
    assert kept["language"] == Counter((r["doc_id"], r["text"]) for r in language) and sum(kept["language"].values()) < len(rows)
    groups = {}
    for doc, text in kept["language"]:
        groups.setdefault("".join(text.split()), []).append((-len(text), doc is None, doc or 0, doc, text))
    assert kept["exact copies"] == Counter((d, t) for own in groups.values() for *_, d, t in [min(own)])
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k in kept["exact copies"] for w in [k[1].lower().split()]}
    group = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if None not in (a[0], b[0]) and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                old, new = sorted((group[a], group[b]), reverse=True)
                group = {k: new if v == old else v for k, v in group.items()}
    assert kept["near copies"] == Counter({k for k, v in group.items() if k == v}) and len(kept["near copies"]) < len(kept["exact copies"])
    assert set(kept["mixture"]) <= set(kept["near copies"]) and max(kept["mixture"].values()) <= 2
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    coder = tokens.WordIds(tokens.vocabulary())
    wanted = sum(n * (len(coder.encode(t.encode())) // 4 + 1) for (_, t), n in kept["mixture"].items())
    assert sum(r["length"] for r in pieces) == wanted and packing.pack(docs).agg(F.sum("length")).first()[0] == wanted


def test_balance_meets_its_targets_or_says_so(spark):
    cells = [("a", 1.0, 10), ("b", 0.5, 10), ("b", 1.5, 20), ("c", 1.0, 7), ("d", 0.2, 50), ("d", 1.9, 50)]
    frame = spark.createDataFrame(cells, "source string, prior double, size long")
    targets = {"a": 20.0, "b": 59.9, "c": 0.0, "d": 3.0}
    kind = "source string, source_size long, target double"
    tilt = {r["source"]: r["tilt"] for r in mixing.balance(frame, spark.createDataFrame([(s, 9, t) for s, t in targets.items()], kind), 2.0).collect()}
    for source, target in targets.items():
        mass = sum(n * min(2.0, p * np.exp(tilt[source])) for s, p, n in cells if s == source)
        assert abs(mass - target) <= 1e-8 * max(target, 1)
    with pytest.raises(RuntimeError, match="after 3 rounds"):
        mixing.balance(frame, spark.createDataFrame([("a", 10, 25.0)], kind), 2.0, rounds=3)


@pytest.mark.parametrize("says", [True, False])
def test_the_filters_of_exact_dedup_decide(spark, monkeypatch, says):
    """One that always says yes costs a join and changes nothing; one that forgets keys loses groups."""
    rows = [(i, f"text {i % 40}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    batch = F.pmod("doc_id", F.lit(3))
    plain = sorted(map(tuple, exact_dedup.groups(docs, batch, 3).collect()))
    assert {r[2] for r in plain} == {3} and sum(r[3] for r in plain) == 40

    def screen(incoming, filters):
        return incoming.assign(screened=np.full(len(incoming), says))

    monkeypatch.setattr(exact_dedup, "_screen", screen)
    assert (sorted(map(tuple, exact_dedup.groups(docs, batch, 3).collect())) == plain) is says


def test_texts_under_one_digest_are_told_apart(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a a"), (2, "aa"), (3, "b"), (4, "bb"), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in exact_dedup.groups(docs, F.lit(0), 1).collect()}
    assert got[1]["keep_id"] == got[2]["keep_id"] == 1 and got[3]["group_size"] == 1 and got[5]["text_sha256"] == hashlib.sha256().hexdigest()


def test_ids_with_two_texts_lose_no_link(spark):
    a, b = "one two three four five six seven eight nine ten eleven", "red blue green black white grey pink brown gold teal navy"
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "quite another text of its own")]
    got = [(r["doc_id"], r["component_id"]) for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), near_dedup.Join()).collect()]
    assert sorted(got) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_pairs_are_found_at_any_depth():
    """Pairs at the threshold under the rows that all share most of their values, as below a hot passage: recall by level."""
    rng, how = np.random.default_rng(0), near_dedup.Join()
    pairs = 1500
    one = rng.integers(0, 60_000, (pairs, how.coordinates)).astype(np.uint16)
    agree = np.zeros((pairs, how.coordinates), bool)
    agree[:, : round(0.8 * how.coordinates)] = True
    agree = rng.permuted(agree, axis=1)
    two = np.where(agree, one, one + 1).astype(np.uint16)
    met = np.zeros(pairs, bool)
    for root in near_dedup.roots(how):
        paths = [(np.arange(pairs), np.full(pairs, root, np.uint64))]
        for _ in range(6):
            at, path = paths[-1]
            row, child = near_dedup.children(path, one[at], how)
            other, twin = near_dedup.children(path, two[at], how)
            assert (row == other).all()
            same = child == twin
            paths.append((at[row[same]], child[same]))
        met[paths[-1][0]] = True
    assert met.mean() > 0.998


@pytest.mark.parametrize("dim", [1, 2, 3, 4, 8, 12, 16, 64])
def test_recall_of_caps_in_any_dimension(dim):
    how, rng = embedding_dedup.Caps(), np.random.default_rng(dim)
    one = rng.standard_normal((800, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    away = rng.standard_normal((800, dim))
    away -= (away * one).sum(axis=1, keepdims=True) * one
    two = one if dim == 1 else 0.9 * one + 0.19**0.5 * away / np.linalg.norm(away, axis=1, keepdims=True)
    codes = how.codes(dim)
    held = [set(zip(*(x.tolist() for x in embedding_dedup._caps(v, dim, codes, how)), strict=True)) for v in (one, two)]
    assert len({r for r, _ in held[0] & held[1]}) >= 0.99 * 800


def test_toxicity_learns_from_long_texts(spark):
    """All offending documents are long: their windows are learned from, and long held-out texts are told apart."""
    clean, bad = [f"plain{i % 50}" for i in range(400)], "vileword hateful"
    rows = []
    for i in range(120):
        words = [clean[(i * 7 + k * 3) % 400] for k in range(1500)]
        if i % 2:
            for k in range(0, 1500, 30):
                words[k] = bad
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    for most in (40_000, 2_000):
        model = toxicity.learn(docs, labels, F.col("doc_id") < 80, max_chars=most)
        scored = toxicity.tag(docs.filter("doc_id >= 80"), model).collect()
        assert all((r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in scored)
