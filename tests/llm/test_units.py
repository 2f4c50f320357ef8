"""Pieces that need no Spark: exactness against plain forms."""

from __future__ import annotations

import copy

import numpy as np
import pytest

from tablelift.llm import embedding_dedup, fuse, lm_scoring, near_dedup, packing, tokens, toxicity


def test_word_ids_equal_the_library():
    coder = tokens.WordIds(tokens.vocabulary(), entries=500)
    texts = ["Don't stop! İstanbul ΑΣ σας é ½ ĳ 12345 naïve's!! 中文 🙂 <|endoftext|> x<|startoftext|>Y", "", " \t\n", "a b 　c"]
    texts += [" ".join("a" + chr(i) + "B." for i in range(33, 0x800)), "w" * 5000]
    texts += [t.replace("</w>", "") for t in list(coder.library.get_vocab())[::40]]
    for text in texts:
        wanted = np.array(coder.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert coder.encode(text.encode()) == wanted, text[:40]


@pytest.mark.parametrize("n", [1, 2, 10, 1000, 50_000])
def test_fuse_filter_has_no_false_negative(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    made = fuse.FuseFilter.build(keys)
    assert made.contains(keys).all()
    others = np.random.default_rng(n + 1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert made.contains(others).mean() < 0.01


def test_packer_keeps_every_token_once():
    rng = np.random.default_rng(0)
    packer = packing.Packer((512, 1024, 2048, 4096), 8)
    sizes = rng.integers(1, 9000, 400).tolist()
    for i, n in enumerate(sizes):
        packer.add(i, n)
        if i % 50 == 49:
            packer.pack()
    packer.finish()
    seen = {i: [] for i in range(len(sizes))}
    padding = 0
    for tier, window in packer.done:
        length = sum(p[0] for p in window)
        assert length <= tier <= 4096
        padding += 0 if length & (length - 1) == 0 else 4096 - length
        for n, doc, start in window:
            seen[doc].append((start, n))
    for i, n in enumerate(sizes):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at
            at += length
        assert at == n
    assert padding < 0.01 * sum(sizes)


def test_forward_backward_equals_the_plain_recursion():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 63, 64, 65, 300, 2])
    scores = rng.normal(0, 3, lengths.sum())
    moves, start = np.array([[1.0, 0.3], [0.7, 1.9]]), np.array([1.0, 0.4])
    got = toxicity.marginals(toxicity.Blocks(lengths), scores, moves, start)
    at = 0
    for n in lengths.tolist():
        e = np.stack([np.ones(n), np.exp(scores[at : at + n])], axis=1)
        f, b = np.ones((n, 2)), np.ones((n, 2))
        for t in range(n):
            f[t] = (start if t == 0 else f[t - 1] @ moves) * e[t]
            f[t] /= f[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = moves @ (b[t + 1] * e[t + 1])
            b[t] /= b[t].sum()
        p = (f * b)[:, 1] / (f * b).sum(axis=1)
        assert np.allclose(got[at : at + n], p)
        at += n


def test_spans_are_character_offsets():
    text = "é bad  worse ok"
    assert toxicity._spans(text.encode(), [1, 2]) == [{"start": 2, "end": 12}]


def test_caps_are_all_directions_over_the_threshold():
    how = embedding_dedup.Caps(words=6, parts=3, tables=1)
    unit = np.random.default_rng(2).standard_normal((50, 24))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    turn, words = how.codes(24)[0]
    cuts = np.cumsum([0, *(w.shape[1] for w in words)])
    row, name = embedding_dedup.directions(unit, (turn, words), 0.4)
    found = set(zip(row.tolist(), name.tolist(), strict=True))
    for i, x in enumerate(unit @ turn):
        total = {
            (a * 6 + b) * 6 + c: x[: cuts[1]] @ words[0][a] + x[cuts[1] : cuts[2]] @ words[1][b] + x[cuts[2] :] @ words[2][c]
            for a in range(6) for b in range(6) for c in range(6)
        }
        over = {k for k, v in total.items() if v >= 0.4} or {max(total, key=total.get)}
        assert over == {k for j, k in found if j == i}


def test_confirmed_finds_the_components_of_all_pairs():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 4000, 60)) for _ in range(6)]
    sets = [np.unique(np.concatenate([rng.permutation(b)[: len(b) - rng.integers(0, 12)], rng.integers(5000, 9000, rng.integers(0, 6))])).astype(np.uint64) for b in base for _ in range(15)]

    def parts(links):
        forest = near_dedup.Forest(len(sets))
        for a, b in links:
            forest.join(a, b)
        return [forest.root(i) for i in range(len(sets))]

    pairs = []
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
    assert parts(near_dedup.confirmed(list(range(len(sets))), sets, 80)) == parts(pairs)


def test_model_probabilities_do_not_leave_the_range():
    shape = lm_scoring.Shape(steps=1, classes=8, batch=8)
    file = lm_scoring.public_tokenizers.path(lm_scoring.SUBWORDS)
    coder, texts = lm_scoring.subwords(file), [b"the cat sat on the mat", b"dogs run far away", b""]
    assert [coder.unpacked(coder.packed(t.split())).tolist() for t in texts] == [coder.ids(t.split()).tolist() for t in texts]
    model = lm_scoring.train(texts, None, shape, file)
    x, y, _ = model.windows([coder.ids(t.split()) for t in texts])
    wanted = model.log_prob(x, y)
    for more in (300, -300):  # on all choices alike, so the probabilities stay
        model.p["bias"] += np.float32(more)
        model.p["next"] += np.float32(more)
        assert np.allclose(model.log_prob(x, y), wanted, atol=1e-3)
        assert all(np.isfinite(g).all() for g in model.gradients(x, y).values())
        model.p["bias"] -= np.float32(more)
        model.p["next"] -= np.float32(more)


def test_model_gradients_and_probabilities():
    shape = lm_scoring.Shape(steps=3, classes=8, batch=8)
    file = lm_scoring.public_tokenizers.path(lm_scoring.SUBWORDS)
    texts = [b"the cat sat on the mat again and again", b"dogs run far away from the cat", b""] * 4
    model = lm_scoring.train(texts, None, shape, file)
    coder = lm_scoring.subwords(file)
    x, y, owner = model.windows([coder.ids(t.lower().split()) for t in texts])
    assert (y != model.pad).sum() == sum(len(coder.ids(t.split())) for t in texts)  # each id is scored once
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    loss = lambda: -model.log_prob(x, y).sum() / (y != model.pad).sum()
    for k, g in model.gradients(x, y).items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = model.p[k][i]
        model.p[k][i] = old + 1e-4
        up = loss()
        model.p[k][i] = old - 1e-4
        down = loss()
        model.p[k][i] = old
        assert abs((up - down) / 2e-4 - g[i]) < 1e-5, k
    # over all next ids the probabilities add up to one
    seen = np.repeat(x[:1], model.other + 1, axis=0)
    every = np.full((model.other + 1, shape.stride), model.pad)
    every[:, 3] = np.arange(model.other + 1)
    logs = model.log_prob(seen, every)[:, 3]
    logs[model.other] += np.log(max(1, model.vocabulary - model.other))
    assert abs(np.exp(logs).sum() - 1) < 1e-9


def test_rows_are_summed_by_their_places_however_often_these_occur():
    rng = np.random.default_rng(8)
    for at, size in ((rng.integers(0, 700, 3000), 900), (np.full(500, 3), 5), (np.minimum(rng.geometric(0.05, (40, 25)), 60) - 1, 60), (np.array([2]), 4)):
        values = rng.standard_normal((at.size, 7))
        wanted = np.zeros((size, 7))
        np.add.at(wanted, at.ravel(), values)
        sums = lm_scoring._Sums(at, size)
        assert np.allclose(sums.of(values), wanted)
        moved = rng.permutation(at.size)
        held = np.zeros_like(values)
        held[moved] = values
        assert np.allclose(sums.through(moved).of(held), wanted)


def test_words_of_many_texts_are_split_and_encoded_as_one_by_one():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    letters = [" ", "\n", "\x0b", "\x1c", "\u00a0", "\u2003", "\u200b", "A", "b", "'s", "1", ".", "é", "中", "🙂", "\u0301", "\0"]
    letters = [t.encode() for t in letters] + [b"\xff"]
    texts = [b"".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(0, 30))) for _ in range(3000)] + [b"", b" ", b"W" * 900 + b" x"]
    for kind in (pa.binary(), pa.large_binary()):
        words, which, sizes = lm_scoring._split(pa.array([b"not in view", *texts], kind).slice(1))
        names, ends = words.to_pylist(), np.cumsum(sizes)
        flat = [names[i] for i in which]
        assert [flat[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)] == [t.lower().split() for t in texts]
    assert [lm_scoring._split(pa.array([b"", b" "], pa.binary()))[i].tolist() for i in (1, 2)] == [[], [0, 0]]
    file = lm_scoring.public_tokenizers.path(lm_scoring.SUBWORDS)
    coder, calls = lm_scoring.Subwords(file, entries=100), []
    wanted = [coder.alone(w) for w in names]
    plain = coder.encode
    coder.encode = lambda t: calls.append(t) or plain(t)
    assert coder.each(names) == wanted and coder.each(names[::-1]) == wanted[::-1] and len(coder) <= 100
    calls.clear()
    many = [b"word%d" % i for i in range(4000)]
    assert b"".join(coder.each(many)) == lm_scoring.subwords(file).packed(many)
    assert len(calls) == 1


def test_learning_is_adam_on_the_rows_in_view():
    shape = lm_scoring.Shape(classes=4, batch=4)
    file = lm_scoring.public_tokenizers.path(lm_scoring.SUBWORDS)
    texts = [b"the cat sat on the mat again and again and ran away " * 6, b"dogs run far away from the cat", b""] * 3
    start = lm_scoring.train(texts[:1], None, shape, file)
    model, coder = copy.copy(start), lm_scoring.subwords(file)
    x, y, _ = start.windows([coder.ids(t.split()) for t in texts])
    before = {k: v.copy() for k, v in start.p.items()}
    model.learn(x, y, 2.0, 0.25, 0.25)
    assert all((start.p[k] == v).all() for k, v in before.items())  # the model that it came from stays

    plain, order = copy.copy(start), np.random.default_rng(5).permutation(len(x))
    plain.p = {k: v.astype(np.float64) for k, v in before.items()}
    m, s = ({k: np.zeros_like(v) for k, v in plain.p.items()} for _ in range(2))
    steps = -(-2 * len(x) // shape.batch)
    for step in range(1, steps + 1):
        pick = order[np.arange((step - 1) * shape.batch, step * shape.batch) % len(x)]
        rate = shape.rate * min(1, step / 20) * (1 - 0.25 - 0.25 * step / (steps + 1)) ** 0.5
        for k, g in plain.gradients(x[pick], y[pick]).items():
            at = np.unique(x[pick]) if k in lm_scoring.BY_INPUT else slice(None)
            m[k][at] = 0.9 * m[k][at] + 0.1 * g[at]
            s[k][at] = 0.99 * s[k][at] + 0.01 * g[at] ** 2
            move = m[k][at] / (1 - 0.9**step) / (np.sqrt(s[k][at] / (1 - 0.99**step)) + 1e-8)
            plain.p[k][at] -= rate * (0.2 if k in ("next", "bias") else 1) * move
    wanted = plain.log_prob(x, y)
    assert np.abs(model.log_prob(x, y) - wanted).max() < 0.01 and np.abs(start.log_prob(x, y) - wanted).max() > 0.1
    # a class of more targets than are taken at a time, and windows of many blocks
    tables, more = lm_scoring.Tables(plain), lm_scoring.Tables(plain)
    more.limit = 3
    for a, b in zip(tables.gradients(x, y, tables.rows, plain.pad), more.gradients(x, y, more.rows, plain.pad), strict=True):
        assert np.allclose(a, b, atol=1e-12)
    assert np.allclose(more.log_prob(np.tile(x, (30, 1)), np.tile(y, (30, 1))), np.tile(wanted, (30, 1)))
