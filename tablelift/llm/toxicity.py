"""Toxicity: a linear-chain conditional random field tags offending tokens; its marginals give spans and document scores.

Labels exist for documents only, so tokens are labelled from them: in a toxic document those tokens whose word or word beginning is
far more frequent in toxic documents than in clean ones.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.llm import common

BLOCK = 64
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")
EDGES = b".,;:!?\"'()[]{}<>|*-_#/\\"


def features(word: bytes) -> tuple[bytes, ...]:
    """The word without signs around it, lower case, and its beginnings of three to eight bytes."""
    plain = word.strip(EDGES).decode("utf-8", "replace").lower().encode()
    return (b"=" + plain, *(plain[:k] for k in (3, 4, 5, 6, 7, 8) if len(plain) > k))


class Blocks:
    """Token scores of many documents, cut into blocks of BLOCK positions; no block holds two documents."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = np.asarray(lengths, np.int64)
        self.count = np.maximum(-(-self.lengths // BLOCK), 1)
        self.first = np.concatenate([[0], np.cumsum(self.count)[:-1]])
        self.blocks = int(self.count.sum())
        start = np.repeat(self.first * BLOCK, self.lengths)
        within = np.arange(int(self.lengths.sum())) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.at = start + within  # place of every token in the flat blocks
        self.mask = np.zeros(self.blocks * BLOCK, bool)
        self.mask[self.at] = True
        self.mask = self.mask.reshape(self.blocks, BLOCK)
        self.order = np.argsort(-self.count, kind="stable")


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def forward_backward(blocks: Blocks, scores: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(forward, backward) messages, both (blocks, BLOCK, 2) and scaled; exact over whole documents.

    ``scores`` is the advantage of the toxic state at every token, ``moves`` the 2 x 2 factors between neighbours, ``start`` those of
    the first token. Each block first gives its transfer matrix, the matrices of a document are chained, and then every block runs
    from its true boundary; padding leaves messages as they are.
    """
    n = blocks.blocks
    (m00, m01), (m10, m11) = moves.tolist()
    flat = np.ones(n * BLOCK)
    flat[blocks.at] = np.exp(np.clip(scores, -30, 30))
    e = np.ascontiguousarray(flat.reshape(n, BLOCK).T)  # one row per position, as the steps need them
    mask = np.ascontiguousarray(blocks.mask.T)
    inner = np.ones(n, bool)
    inner[blocks.first] = False
    # transfer matrices: row vectors are multiplied from the left; the first token of a document has no move before it
    a, b, c, d = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
    for t in range(BLOCK):
        on = mask[t] if t else mask[t] & inner
        a, b = np.where(on, a * m00 + b * m10, a), np.where(on, a * m01 + b * m11, b)
        c, d = np.where(on, c * m00 + d * m10, c), np.where(on, c * m01 + d * m11, d)
        scale = 1 / (a + b + c + d)  # padding has e = 1
        a, b, c, d = a * scale, b * scale * e[t], c * scale, d * scale * e[t]
    enter, leave = np.empty((n, 2)), np.empty((n, 2))
    docs = blocks.order
    now = np.broadcast_to(start, (len(docs), 2)).copy()
    longest = int(blocks.count.max(initial=0))
    for k in range(longest):
        docs = docs[: int((blocks.count[docs] > k).sum())]
        at = blocks.first[docs] + k
        now = now[: len(docs)]
        enter[at] = now
        x, y = now[:, 0], now[:, 1]
        now = _scaled(np.stack([x * a[at] + y * c[at], x * b[at] + y * d[at]], axis=1))
    docs = blocks.order
    back = np.ones((len(docs), 2))
    for k in range(longest - 1, -1, -1):
        here = int((blocks.count[docs] > k).sum())
        at = blocks.first[docs[:here]] + k
        leave[at] = back[:here]
        x, y = back[:here, 0], back[:here, 1]
        back[:here] = _scaled(np.stack([a[at] * x + b[at] * y, c[at] * x + d[at] * y], axis=1))
    forward, backward = np.empty((BLOCK, n, 2)), np.empty((BLOCK, n, 2))
    x, y = enter[:, 0], enter[:, 1]
    for t in range(BLOCK):
        on = mask[t] if t else mask[t] & inner
        x, y = np.where(on, x * m00 + y * m10, x), np.where(on, x * m01 + y * m11, y) * e[t]
        scale = 1 / (x + y)
        x, y = x * scale, y * scale
        forward[t, :, 0], forward[t, :, 1] = x, y
    x, y = leave[:, 0], leave[:, 1]
    for t in range(BLOCK - 1, -1, -1):
        scale = 1 / (x + y)
        x, y = x * scale, y * scale
        backward[t, :, 0], backward[t, :, 1] = x, y
        z = y * e[t]
        on = mask[t] if t else mask[t] & inner
        x, y = np.where(on, m00 * x + m01 * z, x), np.where(on, m10 * x + m11 * z, y)
    return forward.transpose(1, 0, 2), backward.transpose(1, 0, 2)


def marginals(blocks: Blocks, scores: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at every token."""
    forward, backward = forward_backward(blocks, scores, moves, start)
    both = _scaled(forward * backward).reshape(-1, 2)
    return both[blocks.at, 1]


@dataclass
class Field:
    """A trained field and the logistic step from token marginals to a document score."""

    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = -6.0
    moves: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.ones(2))
    document: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0, 0, 0]))

    def summary(self, lengths: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Per document: 1, log odds of its likeliest token, of expected offending tokens, and their share."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        total = np.bincount(owner, p, len(lengths))
        top = np.full(len(lengths), 1e-6)
        np.maximum.at(top, owner, np.clip(p, 1e-6, 1 - 1e-6))
        share = total / np.maximum(lengths, 1)
        return np.stack([np.ones(len(lengths)), np.log(top / (1 - top)) / 5, np.log1p(total), np.sqrt(share) * 5], axis=1)

    def score(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.document, -30, 30)))


class Emissions(dict):
    """word -> advantage of the toxic state; at most ``entries`` words are kept."""

    def __init__(self, model: Field, entries: int = 300_000) -> None:
        super().__init__()
        self.model, self.entries = model, entries

    def __missing__(self, word: bytes) -> float:
        weights = self.model.weights
        value = self.model.bias + sum(weights.get(f, 0.0) for f in features(word))
        if len(word) < 100:
            if len(self) >= self.entries:
                self.clear()
            self[word] = value
        return value


def fit(texts: list[bytes], labels: list[int], rounds: int = 40, odds: float = 3.0, share: float = 0.025, max_features: int = 20_000) -> Field:
    """Train on labelled documents held in memory."""
    labels = np.array(labels, bool)
    if not labels.any() or labels.all():
        return Field()
    words = [t.split() for t in texts]
    known: dict[bytes, tuple[bytes, ...]] = {}
    seen = (Counter(), Counter())
    for doc, toxic in zip(words, labels.tolist(), strict=True):
        own = set()
        for w in set(doc):
            own.update(known.setdefault(w, features(w)))
        seen[toxic].update(own)
    many = np.array([(~labels).sum(), labels.sum()]) + 1.0
    least = max(4, share * labels.sum())

    def advantage(f: bytes) -> float:
        return float(np.log((seen[1][f] + 0.5) / many[1]) - np.log((seen[0][f] + 0.5) / many[0]))

    toxic = {f for f, n in seen[1].items() if n >= least and advantage(f) > odds}
    common_ones = [f for f, n in (seen[0] + seen[1]).most_common(max_features) if n >= least]
    number = {f: i + 1 for i, f in enumerate(dict.fromkeys([*sorted(toxic), *common_ones]))}
    lengths = np.array([len(d) for d in words])
    blocks = Blocks(lengths)
    width = 7
    # words with the same known features are one kind
    kinds: dict[tuple[int, ...], int] = {}
    of_word = {w: kinds.setdefault(tuple(number[f] for f in fs if f in number), len(kinds)) for w, fs in known.items()}
    ids = np.array([(list(fs) + [0] * width)[:width] for fs in kinds], np.int32).reshape(-1, width)
    marked = {number[f] for f in toxic}
    bad = np.array([not marked.isdisjoint(fs) for fs in kinds], bool)
    kind = np.array([of_word[w] for doc in words for w in doc], np.int64)
    truth = bad[kind] & np.repeat(labels, lengths) if len(kind) else np.zeros(0, bool)
    # parameters: weights (number 0 is absent), bias, moves 01 10 11, start
    theta = np.zeros(len(number) + 1 + 5)
    theta[-5:] = [-5.0, -1.0, 0.0, 0.0, -1.0]
    first = np.cumsum(lengths)[lengths > 0] - lengths[lengths > 0]
    follows = np.ones(len(kind), bool)
    follows[first] = False
    before = np.flatnonzero(follows) - 1
    pair = np.array([[0, 0], [0, 0]], float)
    for i in (0, 1):
        for j in (0, 1):
            pair[i, j] = ((truth[before] == i) & (truth[before + 1] == j)).sum()
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    flat = ids.ravel()
    size = max(1, int(truth.sum()))

    def parts():
        moves = np.exp(np.array([[0.0, theta[-4]], [theta[-3], theta[-2]]]))
        return (theta[ids].sum(axis=1) + theta[-5])[kind], moves, np.array([1.0, np.exp(theta[-1])])

    for step in range(1, rounds + 1):
        theta[0] = 0
        scores, moves, start = parts()
        forward, backward = forward_backward(blocks, scores, moves, start)
        p = _scaled(forward * backward).reshape(-1, 2)[blocks.at, 1]
        f, b = forward.reshape(-1, 2)[blocks.at], backward.reshape(-1, 2)[blocks.at]
        e = np.stack([np.ones(len(scores)), np.exp(np.clip(scores, -30, 30))], axis=1)
        joint = f[before][:, :, None] * moves * (e * b)[before + 1][:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        expected = joint.sum(axis=0)
        slope = np.zeros_like(theta)
        gap = truth - p
        per_kind = np.bincount(kind, gap, len(ids))
        slope[: len(number) + 1] = np.bincount(flat, np.repeat(per_kind, width), len(number) + 1)
        slope[-5] = gap.sum()
        slope[-4], slope[-3], slope[-2] = (pair - expected)[[0, 1, 1], [1, 0, 1]]
        slope[-1] = gap[first].sum()
        slope = slope / size - 1e-4 * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta += 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    theta[0] = 0
    scores, moves, start = parts()
    model = Field({f: float(theta[i]) for f, i in number.items() if abs(theta[i]) > 1e-3}, float(theta[-5]), moves, start)
    x = model.summary(lengths, marginals(blocks, scores, moves, start))
    # logistic regression with a little weight decay, by Newton steps
    y, w = labels.astype(float), np.zeros(x.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - q) - 0.5 * w)
    model.document = w
    return model


def learn(docs: DataFrame, labels: DataFrame, train: Column, per_label: int = 800, max_chars: int = 40_000, text: str = "text") -> Field:
    """Train on a bounded sample: of toxic and of clean documents of every length about ``per_label`` each, chosen by a hash of their
    text; of a longer one, a window of ``max_chars`` characters at a hashed place. Rows without id, text or label are left out; an
    id labelled more than once counts as toxic if any row says so. Without a toxic or a clean document the field is untrained: every
    text then gets the same low score."""
    named = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", F.col(text).alias("text")).filter(train & F.col("text").isNotNull())
    ids = rows.filter(F.length("text") > 0).select("doc_id", F.pmod(F.xxhash64("text"), F.lit(1 << 30)).alias("draw")).join(named, "doc_id")
    ids = common.written(ids.dropDuplicates(["draw", "toxic"]), "labelled")
    counts = {r[0]: r[1] for r in ids.groupBy((F.col("toxic") == 1).alias("toxic")).count().collect()}
    limit = F.when(F.col("toxic") == 1, min(1.0, per_label / max(1, counts.get(True, 0)))).otherwise(min(1.0, per_label / max(1, counts.get(False, 0))))
    chosen = ids.filter(F.col("draw") < limit * F.lit(1 << 30))
    start = F.pmod(F.xxhash64("text", F.lit("window")), F.greatest(F.length("text") - max_chars + 1, F.lit(1)))
    windows = rows.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").select(F.substr("text", (start + 1).cast("int"), F.lit(max_chars)).alias("text"), "toxic")
    sample = sorted((r["text"], int(r["toxic"] == 1)) for r in windows.collect())
    return fit([t.encode() for t, _ in sample], [y for _, y in sample])


def tag(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1), spans (start and end, in characters, of tokens more likely offending than not) and offending (the
    expected number of such tokens), over whole texts of any length.

    Null and empty texts have no tokens, no spans and the score of a document without offence. Input columns of the added names, in whatever
    case, are replaced; all others, repeated rows and null ids pass. An empty table gives no row.
    """
    import pyarrow as pa

    added = T.StructType.fromDDL("score double, spans array<struct<start: int, end: int>>, offending double")
    kept = [c for c in docs.columns if c.lower() not in added.names]
    at = kept.index(text)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        emit = Emissions(model)
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in batch.column(at).to_pylist()]
            scores, spans, offending = [], [], []
            for lo, hi in common.parts(texts):
                words = [t.split() for t in texts[lo:hi]]
                lengths = np.array([len(w) for w in words])
                u = np.array([emit[w] for doc in words for w in doc], np.float64)
                p = marginals(Blocks(lengths), u, model.moves, model.start)
                scores += model.score(model.summary(lengths, p)).tolist()
                owner = np.repeat(np.arange(len(lengths)), lengths)
                offending += np.bincount(owner, p, len(lengths)).tolist()
                cuts = np.cumsum(lengths) - lengths
                hits: dict[int, list[int]] = {}
                for i in np.flatnonzero(p > 0.5).tolist():
                    hits.setdefault(int(owner[i]), []).append(i - int(cuts[owner[i]]))
                spans += [_spans(texts[lo + i], hits[i]) if i in hits else [] for i in range(hi - lo)]
            columns = [pa.array(scores, pa.float64()), pa.array(spans, span_type), pa.array(offending, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added.names])

    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *added.fields]))


def _spans(text: bytes, tokens: list[int]) -> list[dict[str, int]]:
    """Character offsets of the given tokens, neighbours joined."""
    wanted, found = set(tokens), []
    point = last = 0
    previous = -2
    for i, m in enumerate(TOKEN.finditer(text)):
        if i in wanted:
            point += len(text[last : m.start()].decode("utf-8", "replace"))
            end = point + len(m.group().decode("utf-8", "replace"))
            if previous == i - 1:
                found[-1]["end"] = end
            else:
                found.append({"start": point, "end": end})
            point, last, previous = end, m.end(), i
    return found


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document, by a field trained outside of the held-out third."""
    docs = common.table(spark, sf_dir, "documents")
    fold = common.fold(F.col("doc_id"), 3)
    model = learn(docs, common.table(spark, sf_dir, "labels"), fold != 1)
    found = tag(docs.select("doc_id", (fold == 1).alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans", "offending")
