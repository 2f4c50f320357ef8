"""Packing: documents routed to context-size tiers, each tier packed, gaps of long windows filled from shorter tiers.

Every task packs the documents it reads, in buffers of a bounded number of tokens; nothing is shuffled. What a buffer leaves
incomplete goes on to the next one, so that only the end of a task has odd lengths, which are cut at powers of two.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common, tokens

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Packer:
    """Piece lists by tier; a piece is (length, document number, start)."""

    def __init__(self, tiers: tuple[int, ...], max_pad: int) -> None:
        self.tiers = tuple(sorted(tiers))
        self.max_pad = max_pad
        self.open: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self.tiers}
        self.done: list[tuple[int, list[tuple[int, int, int]]]] = []

    def route(self, length: int) -> int:
        """The smallest tier that holds a piece of that length."""
        return self.tiers[bisect.bisect_left(self.tiers, length)]

    def add(self, doc: int, n: int) -> None:
        longest = self.tiers[-1]
        whole = n - n % longest
        for start in range(0, whole, longest):
            self.done.append((longest, [(longest, doc, start)]))
        if n > whole:
            self.open[self.route(n - whole)].append((n - whole, doc, whole))

    def take(self, tier: int, gap: int) -> tuple[int, int, int] | None:
        """The longest waiting piece of at most ``gap`` tokens, from this tier or a shorter one."""
        for t in reversed(self.tiers):
            if t <= tier and (at := bisect.bisect_right(self.open[t], (gap, 1 << 62, 0)) - 1) >= 0:
                return self.open[t].pop(at)
        return None

    def cut(self, tier: int, gap: int) -> tuple[int, int, int] | None:
        """The first ``gap`` tokens of the shortest waiting piece that is longer; its rest waits on."""
        for t in self.tiers:
            if t <= tier and (at := bisect.bisect_right(self.open[t], (gap, 1 << 62, 0))) < len(self.open[t]):
                length, doc, start = self.open[t].pop(at)
                bisect.insort(self.open[self.route(length - gap)], (length - gap, doc, start + gap))
                return gap, doc, start
        return None

    def waiting(self, tier: int) -> int:
        return sum(p[0] for t in self.tiers if t <= tier for p in self.open[t])

    def pack(self) -> None:
        """Fill as many windows as the waiting pieces can, longest tier first; all but the longest must come out exactly full."""
        for t in self.tiers:
            self.open[t].sort()
        for tier in reversed(self.tiers):
            slack = self.max_pad if tier == self.tiers[-1] else 0
            while self.open[tier] and self.waiting_at_least(tier):
                piece = self.open[tier].pop()
                window, gap = [piece], tier - piece[0]
                while gap > 0 and (piece := self.take(tier, gap)):
                    window.append(piece)
                    gap -= piece[0]
                if gap > slack and (piece := self.cut(tier, gap)):
                    window.append(piece)
                    gap = 0
                if gap > slack:
                    raise AssertionError("a window that could be filled was not")
                self.done.append((tier, window))

    def waiting_at_least(self, tier: int) -> bool:
        """Whether the waiting pieces of this tier and the shorter ones fill one window."""
        total = 0
        for t in reversed(self.tiers):
            if t <= tier:
                for p in reversed(self.open[t]):
                    total += p[0]
                    if total >= tier:
                        return True
        return False

    def finish(self) -> None:
        """Cut all that waits into sequences of powers of two."""
        rest = [p for t in reversed(self.tiers) for p in reversed(self.open[t])]
        for t in self.tiers:
            self.open[t] = []
        total = sum(p[0] for p in rest)
        while total:
            size = min(self.tiers[-1], 1 << (total.bit_length() - 1))
            window, gap = [], size
            while gap:
                length, doc, start = rest.pop(0)
                part = min(length, gap)
                window.append((part, doc, start))
                if part < length:
                    rest.insert(0, (length - part, doc, start + part))
                gap -= part
            self.done.append((size, window))
            total -= size


def step_groups(sequences: list[tuple[int, list]], step_tokens: int) -> list[int]:
    """A group for each sequence: groups hold one tier and about ``step_tokens`` tokens, and their attention costs (squares of piece
    lengths) are evened out by dealing the sequences to and fro in order of cost."""
    groups, first = [0] * len(sequences), 0
    by_tier: dict[int, list[int]] = {}
    for i, (tier, _) in enumerate(sequences):
        by_tier.setdefault(tier, []).append(i)
    for tier in sorted(by_tier, reverse=True):
        members = sorted(by_tier[tier], key=lambda i: (-sum(p[0] ** 2 for p in sequences[i][1]), i))
        n = -(-len(members) * tier // step_tokens)
        for k, i in enumerate(members):
            turn, at = divmod(k, n)
            groups[i] = first + (at if turn % 2 == 0 else n - 1 - at)
        first += n
    return groups


def pack_batches(batches: Iterator, file: str, end_id: int, tiers: tuple[int, ...], max_pad: int, step_tokens: int, buffer_tokens: int):
    import pyarrow as pa
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 32
    coder, end = tokens.word_ids(file), end_id.to_bytes(4, "little")
    packer = Packer(tiers, max_pad)
    docs: dict[int, tuple[int | None, bytes]] = {}  # documents with pieces that wait
    number = next_sequence = next_group = held = 0

    def flush():
        nonlocal next_sequence, next_group, held
        sequences, packer.done = packer.done, []
        groups = step_groups(sequences, step_tokens)
        rows = []
        for (tier, window), group in zip(sequences, groups, strict=True):
            offset = 0
            for length, doc, start in window:
                doc_id, ids = docs[doc]
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                rows.append((doc_id, start, length, crc, len(ids) // 4, base + next_sequence, offset, tier, base + next_group + group))
                offset += length
            next_sequence += 1
        next_group += max(groups, default=-1) + 1
        left = {p[1] for t in packer.tiers for p in packer.open[t]}
        for doc in [d for d in docs if d not in left]:
            del docs[doc]
        held = sum(len(docs[d][1]) // 4 for d in left)
        for at in range(0, len(rows), 50_000):
            columns = list(zip(*rows[at : at + 50_000], strict=True))
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = coder.encode(text) + end
            docs[number] = (doc_id, ids)
            packer.add(number, len(ids) // 4)
            number += 1
            held += len(ids) // 4
            if held >= buffer_tokens:
                packer.pack()
                yield from flush()
    packer.pack()
    packer.finish()
    yield from flush()


def pack(
    docs: DataFrame,
    text: str = "text",
    file: str | None = None,
    end_id: int = 2,
    tiers: tuple[int, ...] = (512, 1024, 2048, 4096),
    max_pad: int = 8,
    step_tokens: int = 65_536,
    buffer_tokens: int = 2_000_000,
) -> DataFrame:
    """One row per piece of a document: where it starts there, its length, checksum of its ids, and its place in a sequence.

    ``tiers`` are powers of two. A document of at most the longest tier goes to the smallest tier that holds it; of a longer one
    full windows are cut and the rest is routed. Each window takes the longest pieces that fit, of its tier and the shorter ones,
    then a cut piece for the gap left; only windows of the longest tier may stay up to ``max_pad`` short. ``step_group`` joins
    sequences of one tier into steps of about ``step_tokens`` tokens and even attention cost.

    Null and empty texts are the end id alone. Repeated rows and null ids are packed like any other, row by row. Columns other than
    doc_id and the text are not read. An empty table gives no row. Sequence numbers carry the task's number in their upper half.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    file = file or tokens.vocabulary()

    def run(batches):
        return pack_batches(batches, file, end_id, tiers, max_pad, step_tokens, buffer_tokens)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes(text).alias("text")).mapInArrow(run, SCHEMA)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(common.table(spark, sf_dir, "documents"))
