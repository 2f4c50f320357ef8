"""Registration of queries with their SQL, table access and a shared scratch folder."""

from __future__ import annotations

import functools
import string
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries.derived import DERIVED
from tablelift.functions.text_forms import iso_local

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` names driver tables plainly and derived ones in braces."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = _expanded(oracle)
        return function

    return register


def _names(template: str) -> list[str]:
    fields = (f for _, f, _, _ in string.Formatter().parse(template) if f)
    return list(dict.fromkeys(fields))


def _needed(template: str) -> list[str]:
    """Derived tables a text needs, each after those it is made of."""
    ordered: list[str] = []
    for name in _names(template):
        if name in DERIVED:
            for inner in [*_needed(DERIVED[name]), name]:
                if inner not in ordered:
                    ordered.append(inner)
    return ordered


def _expanded(oracle: str) -> str:
    """The SQL with each derived table as a common table expression."""

    def plain(template: str) -> str:
        return template.format(**{n: n for n in _names(template)})

    parts = [f"{n} AS ({plain(DERIVED[n])})" for n in _needed(oracle)]
    body = plain(oracle).strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or one that Spark derives from driver tables."""
    if name not in DERIVED:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {n: table(spark, sf_dir, n) for n in _names(DERIVED[name])}
    return spark.sql(DERIVED[name], **inputs)


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tablelift-")


def scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder for written tables: the cluster's shared one, a local one only if none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    data = sf_dir.rstrip("/").rsplit("/", 1)[-1]
    return f"{shared or _own_folder()}/tablelift/{spark.sparkContext.applicationId}/{data}/{name}"


def shown(df: DataFrame) -> DataFrame:
    """Exact values as text, so that every engine's client shows them alike."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            value = value.cast("string")
        elif isinstance(f.dataType, T.TimestampNTZType):
            value = iso_local(value)
        elif isinstance(f.dataType, T.BinaryType):
            value = F.hex(value)
        columns.append(value.alias(f.name))
    return df.select(*columns)
