"""A tree of hashes over all that decides an output: files, then chunks, tables and the plan.

A resumed run compares from the top: a table whose hash is the recorded one is as it was; of any other table only those chunks are
done again whose own hash has changed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.sources.tables import file_states

LEAVES = "chunk string, leaf string"


def combined(*parts: str) -> str:
    """Hash of a node from the hashes or texts below it, in order."""
    return sha256(chr(31).join(parts).encode()).hexdigest()


def digest(rows: DataFrame) -> str:
    """SHA-256 over all rows, in whatever order: rows are hashed, gathered by the first digits of their hash, and the hashes of
    those groups are hashed again."""
    row = F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256)
    groups = rows.select(row.alias("h")).groupBy(F.substring("h", 1, 2).alias("g"))
    parts = groups.agg(_of_all("h").alias("h"))
    return parts.agg(_of_all("h")).first()[0]


def _of_all(hashes: str) -> Column:
    return F.sha2(F.array_join(F.sort_array(F.collect_list(hashes)), ""), 256)


def chunk_leaves(df: DataFrame, chunk: str) -> DataFrame:
    """(chunk, leaf): hash of the path, size and time of every file that holds rows of the chunk; only the columns that decide the
    chunk are read. Raises AnalysisException if rows cannot be traced to files."""
    of_file = F.sha2(F.to_json(F.struct("_metadata.file_path", "_metadata.file_size", F.unix_micros("_metadata.file_modification_time"))), 256)
    held = df.select(F.col(chunk).cast("string").alias("chunk"), of_file.alias("file")).distinct()
    # two levels, so that a chunk of very many files is not one list
    some = held.groupBy("chunk", F.substring("file", 1, 2).alias("g")).agg(_of_all("file").alias("file"))
    return some.groupBy("chunk").agg(_of_all("file").alias("leaf"))


@dataclass
class TableInputs:
    """The node of one table. ``state`` is the hash of its files or its version, None if that cannot be known; ``declared`` that of
    format, columns and partitions. Leaves are looked up only when the whole table is not as it was."""

    declared: str
    state: str | None
    traced: Callable[[], Mapping[str, str]] | None = None
    _leaves: Mapping[str, str] | None = field(default=None, repr=False)

    @property
    def table_hash(self) -> str | None:
        return None if self.state is None else combined(self.declared, self.state)

    def leaf(self, chunk: str) -> str | None:
        """Hash of one chunk; of a chunk without rows that of no files."""
        if self.state is None:
            return None
        if self._leaves is None:
            self._leaves = {}
            if self.traced is not None:
                try:
                    self._leaves = self.traced()
                except AnalysisException:  # rows of more than one source: the table is the smallest part known
                    self.traced = None
        below = self._leaves.get(chunk, "") if self.traced is not None else self.state
        return combined(self.declared, chunk, below)

    def same(self, chunk: str, leaf: str | None, table_hash: str | None) -> bool:
        """Whether the chunk is as recorded."""
        if self.state is None or not (leaf or table_hash):
            return False
        return table_hash == self.table_hash or leaf == self.leaf(chunk)


def table_inputs(df: DataFrame, declared: Sequence[str], version: str | None, with_chunk: Callable[[], DataFrame] | None, chunk: str) -> TableInputs:
    """The node of a table. ``with_chunk`` gives its rows with their chunk; None if it is one chunk."""
    node = combined(df.schema.json(), *declared)
    if version is not None:
        return TableInputs(node, combined("version", version))
    files = sorted(df.inputFiles())
    if not files:
        return TableInputs(node, None)
    state = digest(file_states(df.sparkSession, files))
    if with_chunk is None:
        return TableInputs(node, state)
    return TableInputs(node, state, lambda: {r["chunk"]: r["leaf"] for r in chunk_leaves(with_chunk(), chunk).collect()})


def plan_hash(plan: DataFrame, tables: Mapping[tuple[str, str], TableInputs]) -> str | None:
    """The root; None if a table is not known."""
    nodes = [t.table_hash for _, t in sorted(tables.items())]
    if None in nodes:
        return None
    return combined(digest(plan), *[".".join(key) for key in sorted(tables)], *nodes)
