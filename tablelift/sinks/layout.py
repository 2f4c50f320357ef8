"""Final names: ``<schema>/<table>/<chunk>.<format>``, given to the files of written chunks by renaming them."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession

from tablelift.functions.naming import partition_directory, safe_segment
from tablelift.sinks.files import CHUNK, check_format
from tablelift.sources.storage import Store

PLAN = "_publish-"


def final_names(chunk: str, fmt: str, files: int) -> list[str]:
    """The names of a chunk's files: one by its own name, several with their number."""
    name = safe_segment(chunk)
    return [f"{name}.{fmt}"] if files == 1 else [f"{name}.part-{i:05d}.{fmt}" for i in range(files)]


def _of_chunk(name: str, chunk: str, fmt: str) -> bool:
    own = safe_segment(chunk)
    return name == f"{own}.{fmt}" or name.startswith(f"{own}.part-") and name.endswith(f".{fmt}")


def publish_chunk(spark: SparkSession, written: str, published: str, chunk: str, fmt: str) -> list[str]:
    """Move the files of one written chunk of the table at ``written`` to their final names below ``published``; returns these.

    All moves are written down before the first of them and done again after a crash, so a chunk ends up whole under its names
    whenever the next call comes. A chunk that is published already and not written anew stays as it is; files of a former version
    go with the moves.
    """
    check_format(fmt)
    store = Store(spark, published)
    store.make_directory(published)
    plan, source = f"{published}/{PLAN}{safe_segment(chunk)}.json", f"{written}/{partition_directory(CHUNK, chunk)}"
    there = [e.name for e in store.entries(published) if not e.directory and _of_chunk(e.name, chunk, fmt)]
    if store.exists(plan):
        moves = json.loads(store.read_text(plan))
    else:
        files = [e.name for e in store.entries(source) if not e.directory and not e.name.startswith(("_", "."))]
        if not files:
            return there
        moves = dict(zip(files, final_names(chunk, fmt, len(files)), strict=True))
        store.write_text(plan, json.dumps(moves))
    for name, target in moves.items():
        if store.exists(f"{source}/{name}"):
            store.remove(f"{published}/{target}")
            store.rename(f"{source}/{name}", f"{published}/{target}")
    for name in set(there) - set(moves.values()):
        store.remove(f"{published}/{name}")
    store.remove(source)
    store.remove(plan)
    return sorted(moves.values())


def publish_table(spark: SparkSession, written: str, published: str, chunks: Iterable[str], fmt: str, replace: bool = False) -> dict[str, list[str]]:
    """``publish_chunk`` for all chunks of a table; with ``replace`` files of chunks that are not named go."""
    names = {chunk: publish_chunk(spark, written, published, chunk, fmt) for chunk in chunks}
    if replace:
        store = Store(spark, published)
        kept = {n for own in names.values() for n in own}
        for e in store.entries(published):
            if e.name not in kept and not e.directory and not e.name.startswith("_"):
                store.remove(f"{published}/{e.name}")
    return names
