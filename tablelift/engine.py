"""Inspect, plan, convert, report: the driver functions.

Only metadata (plan, chunk counts, states) reaches the driver. Each table is
one write job for all its chunks, between a count of the source and a count of
what can be read back.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from contextlib import contextmanager
from dataclasses import dataclass, field
from dataclasses import replace as dataclass_replace
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablelift.errors import SPARK_ERRORS, first_line, message
from tablelift.functions.naming import partition_directory, table_path
from tablelift.functions.text_forms import has_bad_utf8
from tablelift.functions.types import ColumnSpec, is_known_target, is_known_type
from tablelift.operators.catalog import inspect_catalog
from tablelift.operators.fingerprints import TableInputs, combined, plan_hash, table_inputs
from tablelift.operators.ledger import (
    COMPLETED,
    FAILED,
    HASH_SCHEMA,
    HASHES,
    RUNNING,
    ChunkLedger,
    resume_chunks,
)
from tablelift.operators.partitions import CompositePartitions, Partitions, with_chunk
from tablelift.operators.project import (
    failing_rows,
    lossy_text_columns,
    project_columns,
    quoted,
    resolve_overrides,
)
from tablelift.operators.report import report_entries, write_report
from tablelift.operators.validate import checked_counts, count_output_chunks
from tablelift.plans.chunks import (
    BY_PARTITION,
    UNSUPPORTED,
    existing_only,
    manifest_frames,
    missing_schemas,
    plan_chunks,
)
from tablelift.sinks.files import CHUNK, by_chunk, check_format, write_empty_chunks, write_output
from tablelift.sinks.layout import publish_table
from tablelift.sinks.metrics import RunMetrics
from tablelift.sources.storage import Store

LOGGER = logging.getLogger(__name__)

# Fixed value: tables recorded together.
BATCH_TABLES = 20
BATCH_SECONDS = 30

RESULT_SCHEMA = (
    "schema string, table string, chunk string, status string, input_rows bigint, "
    "output_rows bigint, output_path string, error string"
)


@dataclass(frozen=True)
class SourceTable:
    """A readable table with its declared columns and how it is partitioned.

    Without ``method`` a partitioned table must bring a ``chunk`` column, or
    ``partition_name`` (and ``subpartition_name``) columns of its own. ``clustered``
    says that rows of a chunk lie together (files per partition, rows in order of
    the partition key): then the write needs no shuffle. ``version`` names the state of a
    source without files, such as a database: a resumed run redoes such a table, and only it,
    unless the version is given and the same.
    """

    df: DataFrame
    columns: Sequence[ColumnSpec]
    method: Partitions | CompositePartitions | None = None
    clustered: bool = False
    version: str | None = None


@dataclass(frozen=True)
class Chunk:
    name: str
    partition: str | None = None
    subpartition: str | None = None


@dataclass(frozen=True)
class ChunkResult:
    chunk: str
    status: str
    input_rows: int | None = None
    output_rows: int | None = None
    output_path: str | None = None
    error: str | None = None


@dataclass
class TableWork:
    """The planned chunks of one table, and those a ledger holds as completed."""

    schema: str
    table: str
    strategy: str
    chunks: list[Chunk] = field(default_factory=list)
    done: list[ChunkResult] = field(default_factory=list)

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}"

    @property
    def pending(self) -> list[Chunk]:
        completed = {r.chunk for r in self.done}
        return [c for c in self.chunks if c.name not in completed]


_STRICT = {"spark.sql.caseSensitive": "true", "spark.sql.ansi.enabled": "true"}
_strict_lock = threading.Lock()
_strict_users = 0
_strict_before: dict[str, str] = {}


@contextmanager
def strict_session(spark: SparkSession) -> Iterator[None]:
    """While this lasts, overflow fails and names that differ only in case are different.

    Runs that overlap in time share the settings: the first one makes them, the last one restores what was before.
    """
    global _strict_users
    with _strict_lock:
        if not _strict_users:
            _strict_before.update({key: spark.conf.get(key) for key in _STRICT})
            for key, value in _STRICT.items():
                spark.conf.set(key, value)
        _strict_users += 1
    try:
        yield
    finally:
        with _strict_lock:
            _strict_users -= 1
            if not _strict_users:
                for key, value in _strict_before.items():
                    spark.conf.set(key, value)


class RowsOutsidePlan(ValueError):
    """Source rows belong to no chunk of the plan."""


class ConversionFailed(RuntimeError):
    """Raised at the end of a run in which chunks failed; the others are written."""

    def __init__(self, failures: list[str], results: DataFrame) -> None:
        shown = failures[:20]
        more = "" if len(shown) == len(failures) else f" (the first {len(shown)} of {len(failures)}; all are in .results)"
        super().__init__(f"{len(failures)} chunk(s) failed{more}: " + "; ".join(shown))
        self.results = results


def inspect(catalog: Mapping[str, DataFrame], path: str | None = None) -> DataFrame:
    """Manifest of the catalog frames, saved to ``path`` when one is given."""
    return _saved(inspect_catalog(**catalog), path)


def plan(
    manifest: DataFrame, overrides: DataFrame | None = None, path: str | None = None
) -> DataFrame:
    """Chunk plan of a manifest, saved to ``path`` when one is given."""
    return _saved(plan_chunks(*manifest_frames(manifest), overrides), path)


def _saved(df: DataFrame, path: str | None) -> DataFrame:
    if path is None:
        return df
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def table_columns(
    manifest: DataFrame, overrides: DataFrame | None = None
) -> dict[tuple[str, str], list[ColumnSpec]]:
    """Column declarations per table, with the user's expressions and target types."""
    columns = manifest_frames(manifest)[1]
    if overrides is None:
        nothing = F.lit(None).cast("string")
        columns = columns.withColumns({"expression": nothing, "target": nothing})
    else:
        columns = resolve_overrides(
            columns,
            overrides.select("key", "expression", "target"),
            F.concat_ws(".", "schema", "table", "column_name"),
        )
    declared: dict[tuple[str, str], list[ColumnSpec]] = {}
    rows = columns.orderBy("schema", "table", "ordinal").toLocalIterator()
    for r in rows:
        place = f"{r['schema']}.{r['table']}.{r['column_name']}"
        if r["target"] and not is_known_target(r["target"]):
            LOGGER.warning("%s: unknown target type %r, exported as text", place, r["target"])
        elif not r["target"] and not is_known_type(r["data_type"]):
            LOGGER.warning("%s: unknown type %r, exported as text", place, r["data_type"])
        spec = ColumnSpec(
            r["column_name"], r["data_type"], r["precision"], r["scale"],
            r["comment"], r["expression"], r["target"],
        )
        declared.setdefault((r["schema"], r["table"]), []).append(spec)
    return declared


def with_chunks(source: SourceTable, strategy: str, chunks: Sequence[Chunk]) -> DataFrame:
    """The source rows with the name of their chunk."""
    if strategy != BY_PARTITION:
        return source.df.withColumn(CHUNK, F.lit(chunks[0].name))
    if source.method is None and CHUNK in source.df.columns:
        return source.df
    if source.method is None:
        return _with_planned_chunks(source.df, chunks)
    return with_chunk(source.df, source.method)


def _with_planned_chunks(df: DataFrame, chunks: Sequence[Chunk]) -> DataFrame:
    """Chunk names looked up by partition columns the source brings along."""
    rows = [(c.subpartition, c.partition, c.name) for c in chunks]
    names = df.sparkSession.createDataFrame(rows, "__sub string, __part string, chunk string")
    same = F.col("partition_name") == F.col("__part")
    if "subpartition_name" in df.columns:
        same = same & F.col("subpartition_name").eqNullSafe(F.col("__sub"))
    return df.join(names, same, "left").drop("__sub", "__part")


def _present_chunks(spark: SparkSession, path: str) -> set[str]:
    """``chunk=`` directories that exist below a table path."""
    return {e.name for e in Store(spark, path).entries(path) if e.directory and e.name.startswith(f"{CHUNK}=")}


def _read_counts(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    try:
        return count_output_chunks(spark, fmt, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "chunk string, output_rows bigint")


def convert_table(
    source: SourceTable,
    work: TableWork,
    output: str,
    fmt: str,
    metrics: RunMetrics | None = None,
    replace: bool = False,
) -> list[ChunkResult]:
    """Write the pending chunks of one table and check them; failures are results, not errors.

    All chunks go in one job. If that job fails, one aggregate finds the chunks that hold values no
    conversion takes, and all others go in one further job; what still fails then is found by
    halving. Chunks of other plans in the same output stay, unless ``replace`` asks for their
    removal; they go only after the chunks of this plan have been written and checked.
    """
    if not work.pending and not replace:
        return list(work.done)
    metrics = metrics or RunMetrics(source.df.sparkSession, None)
    with metrics.phase(
        "convert_table", table=work.qualified, chunks=len(work.pending), format=fmt
    ):
        try:
            with strict_session(source.df.sparkSession):
                return _convert_pending(source, work, output, fmt, replace, metrics)
        except Exception as error:  # noqa: BLE001 - other tables must go on, whatever this was
            LOGGER.warning("%s failed: %s", work.qualified, first_line(error))
            failed = [ChunkResult(c.name, FAILED, error=message(error)) for c in work.pending]
            return [*work.done, *failed]


def _convert_pending(
    source: SourceTable, work: TableWork, output: str, fmt: str, replace: bool, metrics: RunMetrics
) -> list[ChunkResult]:
    path = table_path(output, work.schema, work.table)
    spark = source.df.sparkSession
    planned = {partition_directory(CHUNK, c.name) for c in work.chunks}
    others = _present_chunks(spark, path) - planned
    if others and not replace:
        LOGGER.warning("%s: the output keeps %d chunk(s) of other plans", work.qualified, len(others))
    results = list(work.done)
    if work.pending:
        results += _Conversion(source, work, path, fmt, metrics).run()
    if replace and any(r.status == COMPLETED for r in results):
        for name in others:
            Store(spark, path).remove(f"{path}/{name}")
    return results


class _Conversion:
    """The pending chunks of one table on their way into the output."""

    def __init__(self, source: SourceTable, work: TableWork, path: str, fmt: str, metrics: RunMetrics) -> None:
        self.source, self.work, self.path, self.fmt, self.metrics = source, work, path, fmt, metrics
        self.names = [c.name for c in work.pending]
        df = with_chunks(source, work.strategy, work.chunks)
        if work.done:
            df = df.where(F.col(CHUNK).isNull() | ~F.col(CHUNK).isin([r.chunk for r in work.done]))
        self.df = df
        self.rows: dict[str, int] = {}
        self.bad_rows: dict[str, int] = {}

    def run(self) -> list[ChunkResult]:
        with self.metrics.phase("count_source", table=self.work.qualified):
            self.rows = self._count()
        try:
            results = self._write(self.names)
        except (*SPARK_ERRORS, ValueError) as error:
            LOGGER.warning("%s: %s; looking for the chunks at fault", self.work.qualified, first_line(error))
            results = self._apart(error)
        if self.metrics.kept:
            self._measure(results)
        return results

    def _count(self) -> dict[str, int]:
        """Source rows per chunk; one row per planned chunk and one for all others together, whatever the source holds."""
        planned = F.when(F.col(CHUNK).isin(self.names), F.col(CHUNK))
        chunk = F.col(CHUNK).cast("string")
        counted = (
            self.df.groupBy(planned.alias("planned"))
            .agg(F.count(F.lit(1)).alias("input_rows"), F.min(chunk).alias("low"), F.max(chunk).alias("high"))
            .collect()
        )
        for r in counted:
            if r["planned"] is None:
                # The plan does not fit the data: no chunk may pass for the whole table.
                span = r["low"] if r["low"] == r["high"] else f"{r['low']} to {r['high']}"
                raise RowsOutsidePlan(
                    f"{self.work.qualified}: rows outside the planned chunks: {{{span}: {r['input_rows']}}}"
                )
        return {r["planned"]: r["input_rows"] for r in counted}

    def _apart(self, error: Exception) -> list[ChunkResult]:
        """The chunks at fault as failed ones, all others written."""
        if len(self.names) == 1:
            return [ChunkResult(self.names[0], FAILED, error=message(error))]
        reasons = self._reasons()
        failed = [ChunkResult(n, FAILED, error=reasons[n]) for n in self.names if n in reasons]
        good = [n for n in self.names if n not in reasons]
        if not failed:
            return self._halved(good, error)
        try:
            return failed + (self._write(good) if good else [])
        except (*SPARK_ERRORS, ValueError) as again:
            return failed + self._halved(good, again)

    def _reasons(self) -> dict[str, str]:
        """Chunks with rows that cannot be converted, and why; one pass over all of them. Empty if that pass fails itself, as an
        expression of the user's own may."""
        try:
            with self.metrics.phase("find_failures", table=self.work.qualified):
                found = failing_rows(self.df, self.source.columns, CHUNK).collect()
        except SPARK_ERRORS as error:
            LOGGER.warning("%s: %s", self.work.qualified, first_line(error))
            return {}
        self.bad_rows = {r[CHUNK]: r["bad_rows"] for r in found}
        return {r[CHUNK]: f"{r['bad_rows']} of {self.rows.get(r[CHUNK], 0)} rows cannot be converted: {r['reason']}" for r in found}

    def _halved(self, names: list[str], error: Exception) -> list[ChunkResult]:
        """Chunks of which some fail for a reason of their own, which is not known: half of them at a time."""
        if len(names) == 1:
            return [ChunkResult(names[0], FAILED, error=message(error))]
        results = []
        for half in (names[: len(names) // 2], names[len(names) // 2 :]):
            try:
                results += self._write(half)
            except (*SPARK_ERRORS, ValueError) as inner:
                results += self._halved(half, inner)
        return results

    def _write(self, names: list[str]) -> list[ChunkResult]:
        """Write some chunks in one job and check what can be read back."""
        work, source, spark = self.work, self.source, self.df.sparkSession
        df = self.df if len(names) == len(self.names) else self.df.where(F.col(CHUNK).isin(names))
        filled = [n for n in names if self.rows.get(n)]
        if filled:
            lossy = lossy_text_columns(df, source.columns)
            observed = Observation()
            if lossy:
                damaged = [F.count_if(has_bad_utf8(F.col(quoted(n)))).alias(n) for n in lossy]
                df = df.observe(observed, *damaged)
            # Shuffled before the conversion: source values are narrower than their text forms,
            # and the conversion then runs in as many tasks as the write.
            if len(filled) > 1 and not source.clustered:
                df = by_chunk(df)
            exported = project_columns(df, source.columns, [CHUNK])
            with self.metrics.phase("write_chunks", table=work.qualified, chunks=len(filled)):
                write_output(exported, self.fmt, self.path, chunked=True, replace="chunks")
            for name, rows in (observed.get if lossy else {}).items():
                if rows:
                    LOGGER.warning(
                        "%s.%s: bytes that are no UTF-8 replaced in about %d rows (data may be lost)",
                        work.qualified, name, rows,
                    )
        unfilled = [n for n in names if not self.rows.get(n)]
        if unfilled:
            with self.metrics.phase("write_empty", table=work.qualified, chunks=len(unfilled)):
                write_empty_chunks(project_columns(source.df, source.columns), self.fmt, self.path, unfilled)
        with self.metrics.phase("read_back", table=work.qualified):
            written = {r[CHUNK]: r["output_rows"] for r in _read_counts(spark, self.fmt, self.path).collect()}
        counts = checked_counts(work.qualified, names, self.rows, written)
        return [
            ChunkResult(name, COMPLETED, *counts[name], f"{self.path}/{partition_directory(CHUNK, name)}") for name in names
        ]

    def _measure(self, results: list[ChunkResult]) -> None:
        """One record per chunk: rows in and out, rows that cannot be converted, bytes and files in the output."""
        store = Store(self.df.sparkSession, self.path)
        for r in results:
            files = [e.length for e in store.entries(f"{self.path}/{partition_directory(CHUNK, r.chunk)}") if not e.name.startswith(("_", "."))]
            if r.status == FAILED:
                files = []
            self.metrics.record(
                "chunk", table=self.work.qualified, chunk=r.chunk, status=r.status, rows=self.rows.get(r.chunk, 0),
                output_rows=r.output_rows or 0, bad_rows=self.bad_rows.get(r.chunk, 0), bytes=sum(files), files=len(files),
            )


def _work_list(
    plan_df: DataFrame,
    ledger: ChunkLedger | None,
    output: str,
    inputs: Mapping[tuple[str, str], TableInputs] | None = None,
) -> list[TableWork]:
    """Plan rows per table, completed chunks with their recorded counts; with ``inputs`` only those whose own inputs are as recorded."""
    chunks = plan_df.where(F.col("strategy") != UNSUPPORTED).withColumns(
        {
            "table_name": F.concat_ws(".", "schema", "table"),
            "chunk_name": F.col("chunk"),
        }
    )
    if ledger is None:
        states = plan_df.sparkSession.createDataFrame(
            [], "table_name string, chunk_name string, status string, "
            f"imported_rows bigint, output_rows bigint, {HASH_SCHEMA}"
        )
    else:
        states = ledger.latest()
    works: dict[tuple[str, str], TableWork] = {}
    rows = resume_chunks(chunks, states).orderBy("schema", "table", "chunk").toLocalIterator()
    for r in rows:
        key = (r["schema"], r["table"])
        work = works.setdefault(key, TableWork(*key, r["strategy"]))
        work.chunks.append(Chunk(r["chunk"], r["partition_name"], r["subpartition_name"]))
        known = inputs is None or key in inputs and inputs[key].same(r["chunk"], *[r[h] for h in HASHES])
        if not r["redo"] and known:
            target = f"{table_path(output, *key)}/{partition_directory(CHUNK, r['chunk'])}"
            work.done.append(
                ChunkResult(r["chunk"], COMPLETED, r["imported_rows"], r["output_rows"], target)
            )
    return list(works.values())


def convert_plan(
    spark: SparkSession,
    plan_df: DataFrame,
    sources: Mapping[tuple[str, str], SourceTable],
    output: str,
    fmt: str = "parquet",
    *,
    ledger: ChunkLedger | None = None,
    metrics: RunMetrics | None = None,
    parallel_tables: int = 4,
    raise_failures: bool = True,
    replace: bool = False,
    inputs: Mapping[tuple[str, str], TableInputs] | None = None,
) -> DataFrame:
    """Convert every supported table of the plan; returns one row per chunk tried.

    Tables the plan names but ``sources`` lacks are left out with a warning. A
    failed chunk is recorded and the rest goes on; ``raise_failures`` raises at the end. States
    that the ledger has lost are first restored from its rowcount records. ``replace`` removes
    chunks of other plans from tables that are converted whole. With ``inputs`` (``input_tree``) a
    completed chunk is done again if its own inputs are not those recorded with it.
    """
    check_format(fmt)
    catalog = spark.createDataFrame(list(sources), "schema string, table string")
    supported = plan_df.where(F.col("strategy") != UNSUPPORTED)
    present, missing = existing_only(supported, catalog)
    gone = [r[0] for r in missing_schemas(plan_df, catalog).collect()]
    if gone:
        raise ValueError(
            "source does not match the manifest (missing schemas: "
            + ", ".join(sorted(gone))
            + "). Inspect it again before converting."
        )
    for r in missing.collect():
        LOGGER.warning("skipping %s.%s: not in the source", r["schema"], r["table"])
    if ledger is not None:
        ledger.reconcile()
    works = _work_list(present, ledger, output, inputs)
    if ledger is not None:
        running = [
            (w.qualified, c.name, RUNNING, None, None, None) for w in works for c in w.pending
        ]
        if running:
            ledger.append_rows(running)
    rows: list[tuple] = []
    failures: list[str] = []
    with strict_session(spark), ThreadPoolExecutor(max_workers=parallel_tables) as pool:
        jobs = {
            pool.submit(convert_table, sources[(w.schema, w.table)], w, output, fmt, metrics, replace): w
            for w in works
        }
        with _LedgerBatches(ledger, inputs or {}) as finished:
            for job in as_completed(jobs):
                work, results = jobs[job], job.result()
                if work.pending:
                    finished.add(work, results)
                for r in results:
                    rows.append((work.schema, work.table, *_as_tuple(r)))
                    if r.status == FAILED:
                        failures.append(f"{work.qualified} {r.chunk}: {r.error}")
    if metrics is not None:
        metrics.flush()
    results_df = spark.createDataFrame(rows, RESULT_SCHEMA)
    if failures and raise_failures:
        raise ConversionFailed(failures, results_df)
    return results_df


class _LedgerBatches:
    """Records finished tables in batches, so that many small tables are few ledger writes.

    A crash loses at most the batch at hand, whose chunks are then done again.
    """

    def __init__(self, ledger: ChunkLedger | None, inputs: Mapping[tuple[str, str], TableInputs]) -> None:
        self._ledger, self._inputs = ledger, inputs
        self._rows: list[tuple] = []
        self._tables, self._since = 0, time.monotonic()

    def __enter__(self) -> _LedgerBatches:
        return self

    def __exit__(self, *_: object) -> None:
        self._flush()

    def add(self, work: TableWork, results: Sequence[ChunkResult]) -> None:
        node = self._inputs.get((work.schema, work.table))
        for r in results:
            hashes = (node.leaf(r.chunk), node.table_hash) if node is not None and r.status == COMPLETED else ()
            self._rows.append((work.qualified, r.chunk, r.status, r.input_rows, r.output_rows, r.error, *hashes))
        self._tables += 1
        if self._tables >= BATCH_TABLES or time.monotonic() - self._since > BATCH_SECONDS:
            self._flush()

    def _flush(self) -> None:
        if self._ledger is not None and self._rows:
            self._ledger.append_rows(self._rows, record=True)
        self._rows, self._tables, self._since = [], 0, time.monotonic()


def _as_tuple(r: ChunkResult) -> tuple:
    return r.chunk, r.status, r.input_rows, r.output_rows, r.output_path, r.error


def input_tree(
    plan_df: DataFrame, sources: Mapping[tuple[str, str], SourceTable], fmt: str = "parquet"
) -> dict[tuple[str, str], TableInputs]:
    """Per planned table the hashes of all that decides its chunks: format, every field of the columns, partition methods with
    their bounds, and the data, by path, size and time of each file that holds rows of a chunk. A source without files counts by
    its ``version``, and without one it is never the same twice."""
    rows = plan_df.where(F.col("strategy") != UNSUPPORTED).select("schema", "table", "strategy", "chunk", "partition_name", "subpartition_name")
    strategies: dict[tuple[str, str], tuple[str, list[Chunk]]] = {}
    for r in rows.orderBy("schema", "table", "chunk").toLocalIterator():
        _, chunks = strategies.setdefault((r["schema"], r["table"]), (r["strategy"], []))
        chunks.append(Chunk(r["chunk"], r["partition_name"], r["subpartition_name"]))
    tree = {}
    for key, source in sources.items():
        strategy, chunks = strategies.get(key, (None, []))
        traced = None
        if strategy == BY_PARTITION:
            traced = lambda source=source, strategy=strategy, chunks=chunks: with_chunks(source, strategy, chunks)
        declared = [fmt, *[repr(c) for c in source.columns], repr(source.method), str(strategy)]
        tree[key] = table_inputs(source.df, declared, source.version, traced, CHUNK)
    return tree


def input_fingerprint(
    plan_df: DataFrame, sources: Mapping[tuple[str, str], SourceTable], fmt: str = "parquet"
) -> str:
    """The root of ``input_tree``: one SHA-256 over the plan and all tables; never the same twice if a table is not known."""
    root = plan_hash(plan_df.select("schema", "table", "strategy", "chunk"), input_tree(plan_df, sources, fmt))
    return root or combined(str(time.time_ns()))


def run(
    spark: SparkSession,
    catalog: Mapping[str, DataFrame],
    frames: Mapping[
        tuple[str, str],
        SourceTable | tuple[DataFrame, Partitions | CompositePartitions | None],
    ],
    work_dir: str,
    fmt: str = "parquet",
    *,
    table_overrides: DataFrame | None = None,
    column_overrides: DataFrame | None = None,
    publish: bool = False,
) -> dict:
    """Inspect, plan, convert and report in one go; a second call resumes the first.

    ``frames``: the readable rows of each table and their partition method, or a ``SourceTable``
    (whose columns, if empty, come from the catalog). A chunk is done again if anything that decides
    it has changed: format, plan, override, bound, or a file with rows of it. What a former plan left is removed.
    With ``publish`` the files of completed chunks end as ``files/<schema>/<table>/<chunk>.<format>``.
    Returns the report summary; manifest, plan, data, ledger, metrics and report lie in ``work_dir``.
    """
    started = datetime.now(UTC)
    manifest = inspect(catalog, f"{work_dir}/manifest")
    plan_df = plan(manifest, table_overrides, f"{work_dir}/plan")
    columns = table_columns(manifest, column_overrides)
    sources = {}
    for key, given in frames.items():
        if key in columns:
            table = given if isinstance(given, SourceTable) else SourceTable(given[0], (), given[1])
            sources[key] = table if table.columns else dataclass_replace(table, columns=columns[key])
    ledger = ChunkLedger(spark, f"{work_dir}/ledger")
    metrics = RunMetrics(spark, f"{work_dir}/metrics")
    results = convert_plan(
        spark,
        plan_df,
        sources,
        f"{work_dir}/data",
        fmt,
        ledger=ledger,
        metrics=metrics,
        raise_failures=False,
        replace=True,
        inputs=input_tree(plan_df, sources, fmt),
    )
    if publish:
        publish_results(spark, results, f"{work_dir}/data", f"{work_dir}/files", fmt, replace=True)
    return write_report(
        report_entries(plan_df, results),
        f"{work_dir}/report",
        output_format=fmt,
        input_paths=[f"{s}.{t}" for s, t in sources],
        started_at=started,
        completed_at=datetime.now(UTC),
    )


def publish_results(
    spark: SparkSession, results: DataFrame, output: str, published: str, fmt: str, replace: bool = False
) -> DataFrame:
    """Give the completed chunks of a conversion their final names: (schema, table, chunk, path), one row per file."""
    done = results.where(F.col("status") == COMPLETED).select("schema", "table", "chunk").orderBy("schema", "table", "chunk")
    tables: dict[tuple[str, str], list[str]] = {}
    for r in done.toLocalIterator():
        tables.setdefault((r["schema"], r["table"]), []).append(r["chunk"])
    rows = []
    for key, chunks in tables.items():
        target = table_path(published, *key)
        named = publish_table(spark, table_path(output, *key), target, chunks, fmt, replace)
        rows += [(*key, chunk, f"{target}/{name}") for chunk, names in named.items() for name in names]
    return spark.createDataFrame(rows, "schema string, table string, chunk string, path string")


def materialize_view(df: DataFrame, path: str) -> DataFrame:
    """A view delivered as a plain table: written once, then read like any source."""
    return _saved(df, path)
