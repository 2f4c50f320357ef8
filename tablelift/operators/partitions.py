"""Partition methods: which partition a row belongs to, decided row by row.

Every method but a reference join is a plain expression, so assigning chunks
costs no shuffle. The position and name columns feed the chunk names of
:mod:`tablelift.plans.chunks`.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAXVALUE = None
DEFAULT = None
# Values of a list from which they are looked up in a table instead of compared one by one, and up to which that table is sent to
# all tasks (some tens of bytes each).
LOOKED_UP, SENT = 64, 200_000

PARTITION = ("partition_position", "partition_name")
SUBPARTITION = ("subpartition_position", "subpartition_name")


def literal(value: Any) -> Column:
    """A bound or list value; a datetime means its own reading, in whatever zone this runs."""
    if isinstance(value, datetime.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def _halving(value: Column, bounds: Sequence[Any], choices: Sequence[Any], low: int) -> Column:
    """The choice after the last bound at or below ``value``, by nested halving.

    A comparison with NULL takes the upper half, so NULL ends at the last choice.
    """
    if not bounds:
        return F.lit(choices[low]) if low < len(choices) else F.lit(None)
    middle = len(bounds) // 2
    return F.when(
        value < literal(bounds[middle]), _halving(value, bounds[:middle], choices, low)
    ).otherwise(_halving(value, bounds[middle + 1 :], choices, low + middle + 1))


def _nth(choices: Sequence[Any], index: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in choices]), index)


def chunk_label(position: int, name: str) -> str:
    return f"partition-{position:05d}-{name}"


class _Listed:
    """A method with a fixed list of partitions; ``pick`` gives each row one of as many choices."""

    def names(self) -> list[str]:
        raise NotImplementedError

    def pick(self, choices: Sequence[Any]) -> Column:
        raise NotImplementedError

    def position(self) -> Column:
        return self.pick(range(1, len(self.names()) + 1)).cast("int")

    def name(self) -> Column:
        return self.pick(self.names())

    def chunk(self) -> Column:
        return self.pick([chunk_label(i, n) for i, n in enumerate(self.names(), 1)])


@dataclass(frozen=True)
class RangePartitions(_Listed):
    """``(name, exclusive upper bound)`` in order; MAXVALUE as last bound takes the rest.

    NULL sorts above every value, so it falls into the MAXVALUE partition. A row
    above the last bound gets a NULL partition.
    """

    column: str
    parts: Sequence[tuple[str, Any]]

    def names(self) -> list[str]:
        return [name for name, _ in self.parts]

    def pick(self, choices: Sequence[Any]) -> Column:
        bounds = [bound for _, bound in self.parts if bound is not MAXVALUE]
        return _halving(F.col(self.column), bounds, choices, 0)


@dataclass(frozen=True)
class ListPartitions(_Listed):
    """``(name, values)`` in order; DEFAULT as values takes what no list names."""

    column: str
    parts: Sequence[tuple[str, Sequence[Any] | None]]

    def names(self) -> list[str]:
        return [name for name, _ in self.parts]

    def lookup(self) -> dict[Any, int]:
        """Number of the list of every value, from 0; of a value named twice the last counts."""
        return {v: i for i, (_, values) in enumerate(self.parts) if values is not DEFAULT for v in values}

    @property
    def looked_up(self) -> bool:
        return sum(len(values) for _, values in self.parts if values is not DEFAULT) > LOOKED_UP

    def default(self) -> int | None:
        return next((i for i, (_, values) in enumerate(self.parts) if values is DEFAULT), None)

    def pick(self, choices: Sequence[Any]) -> Column:
        # One flat case expression, so that no number of partitions nests; of a value named twice the last counts.
        value = F.col(self.column)
        rest = [c for c, (_, values) in zip(choices, self.parts, strict=True) if values is DEFAULT]
        listed = [(c, v) for c, (_, v) in zip(choices, self.parts, strict=True) if v is not DEFAULT]
        chosen = None
        for choice, values in reversed(listed):
            known = [literal(v) for v in values if v is not None]
            match = F.coalesce(value.isin(*known), F.lit(False)) if known else F.lit(False)
            if None in values:
                match = match | value.isNull()
            chosen = F.when(match, F.lit(choice)) if chosen is None else chosen.when(match, F.lit(choice))
        last = F.lit(rest[0]) if rest else F.lit(None)
        return last if chosen is None else chosen.otherwise(last)


@dataclass(frozen=True)
class HashPartitions(_Listed):
    """Stable, total, disjoint buckets; integers by remainder, other keys by hash."""

    columns: Sequence[str]
    buckets: Sequence[str]
    integer_key: bool = False

    def names(self) -> list[str]:
        return list(self.buckets)

    def pick(self, choices: Sequence[Any]) -> Column:
        key = F.xxhash64(*self.columns)
        if self.integer_key:
            key = F.coalesce(F.col(self.columns[0]).cast("bigint"), F.lit(0))
        return _nth(choices, F.pmod(key, F.lit(len(self.buckets))).cast("int"))


@dataclass(frozen=True)
class IntervalPartitions:
    """Monthly partitions above an initial bound (the first of a month).

    Position and name follow from the row's own month, so no global ranking is
    needed; months without rows simply have no partition.
    """

    column: str
    initial_name: str
    initial_bound: datetime.date

    def __post_init__(self) -> None:
        if self.initial_bound.day != 1:
            raise ValueError(
                f"monthly intervals start on the first of a month, not on {self.initial_bound}"
            )

    def position(self) -> Column:
        value = F.col(self.column)
        first = self.initial_bound.year * 12 + self.initial_bound.month
        months = F.year(value) * 12 + F.month(value) - first
        return F.when(months < 0, F.lit(1)).otherwise(months + 2).cast("int")

    def name(self) -> Column:
        value = F.col(self.column)
        month = (F.year(value) * 100 + F.month(value)).cast("string")
        return F.when(value < F.lit(self.initial_bound), F.lit(self.initial_name)).otherwise(
            F.concat(F.lit("SYS_P"), F.lpad(month, 6, "0"))
        )

    def chunk(self) -> Column:
        position = F.lpad(self.position().cast("string"), 5, "0")
        return F.concat(F.lit("partition-"), position, F.lit("-"), self.name())


Partitions = RangePartitions | ListPartitions | HashPartitions | IntervalPartitions


@dataclass(frozen=True)
class CompositePartitions:
    """Partitions, each split again by the same subpartition method."""

    partitions: RangePartitions | ListPartitions | HashPartitions
    subpartitions: RangePartitions | ListPartitions | HashPartitions

    def labels(self) -> list[str]:
        return [
            f"subpartition-{i:05d}-{j:05d}-{name}-{sub}"
            for i, name in enumerate(self.partitions.names(), 1)
            for j, sub in enumerate(self.subpartitions.names(), 1)
        ]

    def chunk(self) -> Column:
        width = len(self.subpartitions.names())
        index = (self.partitions.position() - 1) * width + self.subpartitions.position() - 1
        return _nth(self.labels(), index)


def _with_number(df: DataFrame, level: Partitions, name: str) -> tuple[DataFrame, Column]:
    """``df``, with a column ``name`` if it needs one, and the number of a row's partition, from 0; NULL if no partition takes it."""
    if not (isinstance(level, ListPartitions) and level.looked_up):
        return df, level.position() - 1
    known = level.lookup()
    kind = df.schema[level.column].dataType
    # Datetimes mean their own reading; all others are compared as their own type with the column.
    moments = any(isinstance(v, datetime.datetime) for v in known)
    rows = [(v.isoformat(sep=" ") if isinstance(v, datetime.datetime) else v, i) for v, i in known.items()]
    if all(v is None for v in known):
        values = df.sparkSession.createDataFrame(rows, T.StructType([T.StructField(f"{name}_value", kind), T.StructField(name, T.IntegerType())]))
    else:
        values = df.sparkSession.createDataFrame(rows, [f"{name}_value", name])
        values = values.select((F.col(f"{name}_value").cast("timestamp_ntz") if moments else F.col(f"{name}_value")).alias(f"{name}_value"), F.col(name).cast("int").alias(name))
    if len(known) <= SENT:
        values = F.broadcast(values)
    joined = df.join(values, F.col(level.column).eqNullSafe(F.col(f"{name}_value")), "left").drop(f"{name}_value")
    return joined, F.coalesce(F.col(name), F.lit(level.default()))


def assign(df: DataFrame, method: Partitions | CompositePartitions) -> DataFrame:
    """``df`` with the position and name of its partition (and subpartition)."""
    levels = [(method, PARTITION)]
    if isinstance(method, CompositePartitions):
        levels = [(method.partitions, PARTITION), (method.subpartitions, SUBPARTITION)]
    added, columns = {}, df.columns
    for level, (position, name) in levels:
        if isinstance(level, ListPartitions) and level.looked_up:
            df, number = _with_number(df, level, f"__{position}")
            added.update({position: (number + 1).cast("int"), name: _nth(level.names(), number)})
        else:
            added.update({position: level.position(), name: level.name()})
    return df.withColumns(added).select(*[F.col("`" + c.replace("`", "``") + "`") for c in [*columns, *added]])


def with_chunk(df: DataFrame, method: Partitions | CompositePartitions) -> DataFrame:
    """``df`` with the name of its ``chunk``; NULL for a row no partition takes.

    The chunk is an expression of the row. Only lists of very many values are looked up, by a join with a table of the values.
    """
    levels = [method.partitions, method.subpartitions] if isinstance(method, CompositePartitions) else [method]
    if not any(isinstance(level, ListPartitions) and level.looked_up for level in levels):
        return df.withColumn("chunk", method.chunk())
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != "chunk"]
    df, number = _with_number(df, levels[0], "__partition")
    labels = [chunk_label(i, n) for i, n in enumerate(levels[0].names(), 1)]
    if len(levels) == 2:
        df, sub = _with_number(df, levels[1], "__subpartition")
        number, labels = number * len(levels[1].names()) + sub, method.labels()
    return df.select(*columns, _nth(labels, number.cast("int")).alias("chunk"))


def partition_catalog(
    df: DataFrame, owner: str, table: str, method: Partitions | CompositePartitions
) -> tuple[DataFrame, DataFrame]:
    """Catalog rows of a table's partitions and subpartitions, for planning.

    Only interval partitions depend on the data: the months that occur.
    """
    spark = df.sparkSession
    first = method.partitions if isinstance(method, CompositePartitions) else method
    if isinstance(first, IntervalPartitions):
        seen = df.select(first.name().alias("n"), first.position().alias("p")).distinct()
    else:
        listed = [(n, i) for i, n in enumerate(first.names(), 1)]
        seen = spark.createDataFrame(listed, "n string, p int")
    keys = [F.lit(owner).alias("table_owner"), F.lit(table).alias("table_name")]
    partitions = seen.select(
        *keys, F.col("n").alias("partition_name"), F.col("p").alias("partition_position")
    )
    subs = []
    if isinstance(method, CompositePartitions):
        subs = [
            (name, sub, j)
            for name in first.names()
            for j, sub in enumerate(method.subpartitions.names(), 1)
        ]
    subpartitions = spark.createDataFrame(
        subs, "partition_name string, subpartition_name string, subpartition_position int"
    ).select(*keys, "*")
    return partitions, subpartitions


def assign_by_reference(
    child: DataFrame,
    parent: DataFrame,
    keys: Sequence[tuple[str, str]],
    method: Partitions | CompositePartitions,
) -> DataFrame:
    """Each child row with the ``chunk`` of its parent, along (child, parent) key columns.

    When the parent's partition columns are part of the key, the child holds
    them itself and no join is needed. Otherwise it is an inner equi-join that
    carries only key and chunk of the parent; adaptive execution splits a hot
    key, since every child row meets one parent row at most.
    """
    to_child = {parent_column: child_column for child_column, parent_column in keys}
    if _key_columns(method) <= to_child.keys():
        return with_chunk(child, _renamed(method, to_child))
    owners = with_chunk(parent, method).select(
        *[F.col(p).alias(f"__{p}") for _, p in keys], "chunk"
    )
    on = [F.col(c) == F.col(f"__{p}") for c, p in keys]
    return child.join(owners, on, "inner").select(*child.columns, "chunk")


def _key_columns(method: Partitions | CompositePartitions) -> set[str]:
    if isinstance(method, CompositePartitions):
        return _key_columns(method.partitions) | _key_columns(method.subpartitions)
    return set(method.columns) if isinstance(method, HashPartitions) else {method.column}


def _renamed(
    method: Partitions | CompositePartitions, names: dict[str, str]
) -> Partitions | CompositePartitions:
    if isinstance(method, CompositePartitions):
        return CompositePartitions(
            _renamed(method.partitions, names), _renamed(method.subpartitions, names)
        )
    if isinstance(method, HashPartitions):
        return replace(method, columns=[names[c] for c in method.columns])
    return replace(method, column=names[method.column])
