"""An append-only dataset of small batches, merged below a snapshot so that a read touches a bounded number of them."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablelift.sources.storage import Store

MARK = "_COMMITTED"
BATCH, MERGED = "batch-", "merged-"


class BatchLog:
    """Batches in directories of their own, numbered in the order of their writing.

    A directory counts only with its mark file, which is written last: a batch, or a snapshot, is there as a whole or not at all. A
    snapshot holds all that its number and every lower one held; of the committed snapshots the highest counts, with the batches above
    it. What lies below it is removed only then, so a crash at any point leaves either the old batches or the snapshot of them.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str, schema: str, merge: Callable[[DataFrame], DataFrame], most: int = 16) -> None:
        self._spark, self.path, self._fmt, self._schema, self._merge, self._most = spark, path, fmt, schema, merge, most
        self._last = 0

    def _committed(self, store: Store) -> tuple[int, list[int], list[str]]:
        """(newest snapshot or 0, batches above it, files that lie loose)."""
        names = {BATCH: [], MERGED: []}
        loose = []
        for e in store.entries(self.path):
            for kind, found in names.items():
                if e.directory and e.name.startswith(kind):
                    found.append(int(e.name.removeprefix(kind)))
            if not e.directory and not e.name.startswith(("_", ".")):
                loose.append(f"{self.path}/{e.name}")
        has_mark = lambda kind, n: store.exists(f"{self.path}/{kind}{n:020d}/{MARK}")
        newest = next((n for n in sorted(names[MERGED], reverse=True) if has_mark(MERGED, n)), 0)
        return newest, [n for n in sorted(names[BATCH]) if n > newest and has_mark(BATCH, n)], loose

    def paths(self) -> list[str]:
        """All that a read touches."""
        newest, batches, loose = self._committed(Store(self._spark, self.path))
        merged = [f"{self.path}/{MERGED}{newest:020d}"] if newest else []
        return merged + [f"{self.path}/{BATCH}{n:020d}" for n in batches] + loose

    def read(self) -> DataFrame:
        paths = self.paths()
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).option("mode", "DROPMALFORMED").format(self._fmt).load(paths)

    def next_number(self) -> int:
        self._last = max(self._last + 1, time.time_ns())
        return self._last

    def append(self, rows: DataFrame, number: int | None = None) -> None:
        """Add one batch; every ``most`` of them are merged."""
        self._write(rows, f"{BATCH}{number or self.next_number():020d}")
        if len(self._committed(Store(self._spark, self.path))[1]) >= self._most:
            self.compact()

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").format(self._fmt).save(f"{self.path}/{name}")
        Store(self._spark, self.path).mark(f"{self.path}/{name}/{MARK}")

    def compact(self) -> None:
        """Merge everything into a new snapshot and remove what it replaces."""
        store = Store(self._spark, self.path)
        newest, batches, loose = self._committed(store)
        if not batches:
            return
        # Loose files belong to somebody else: they stay, and are read beside the snapshot.
        paths = [p for p in self.paths() if p not in loose]
        rows = self._spark.read.schema(self._schema).format(self._fmt).load(paths)
        self._write(self._merge(rows), f"{MERGED}{batches[-1]:020d}")
        self._clean(store, batches[-1])

    def _clean(self, store: Store, newest: int) -> None:
        for e in store.entries(self.path):
            for kind in (BATCH, MERGED):
                if e.directory and e.name.startswith(kind):
                    number = int(e.name.removeprefix(kind))
                    if number < newest or kind == BATCH and number == newest:
                        store.remove(f"{self.path}/{e.name}")
