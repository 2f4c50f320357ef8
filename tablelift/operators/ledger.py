"""Chunk ledger: an append-only frame of chunk states; the latest row per chunk counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.sinks.batches import BatchLog

KEY = ["table_name", "chunk_name"]
RUNNING, COMPLETED, FAILED = "running", "completed", "failed"
STATE_SCHEMA = (
    "table_name string, chunk_name string, status string, "
    "imported_rows bigint, output_rows bigint, error string"
)
STATE_COLUMNS = ["status", "imported_rows", "output_rows", "error"]
# What a completed chunk was made of: hashes of its own inputs and of its whole table.
HASHES = ["input_hash", "table_hash"]
RECORD_SCHEMA = "table_name string, chunk_name string, status string, imported_rows bigint, output_rows bigint"
HASH_SCHEMA = ", ".join(f"{name} string" for name in HASHES)


def latest_states(states: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """State of every chunk: the row with the highest ``order`` per (table, chunk).

    An aggregate instead of a window: each task first reduces its own rows, so a
    chunk with very many states is never sorted in one place. An old
    ``parquet_rows`` column is read where ``output_rows`` is absent.
    """
    if "parquet_rows" in states.columns:
        newer = [F.col("output_rows")] if "output_rows" in states.columns else []
        states = states.withColumn("output_rows", F.coalesce(*newer, F.col("parquet_rows")))
    kept = [*STATE_COLUMNS, *[h for h in HASHES if h in states.columns]]
    last = F.max_by(F.struct(*kept), F.struct(*order))
    return states.groupBy(*KEY).agg(last.alias("__last")).select(*KEY, "__last.*")


def pending_chunks(plan: DataFrame, latest: DataFrame) -> DataFrame:
    """Plan chunks (``table_name``, ``chunk_name``, ...) whose state is not ``completed``."""
    return plan.join(latest.where(F.col("status") == COMPLETED), KEY, "left_anti")


def resume_chunks(plan: DataFrame, latest: DataFrame) -> DataFrame:
    """Every plan chunk with ``redo``; completed ones carry their recorded counts, and hashes where there are some."""
    hashes = [h for h in HASHES if h in latest.columns]
    done = latest.where(F.col("status") == COMPLETED).select(
        *KEY, "imported_rows", "output_rows", *hashes, F.lit(True).alias("__done")
    )
    redo = F.col("__done").isNull()
    return plan.join(done, KEY, "left").select(
        *plan.columns,
        redo.alias("redo"),
        *[
            F.when(~redo, F.coalesce(n, F.lit(0).cast("bigint"))).alias(n)
            for n in ("imported_rows", "output_rows")
        ],
        *hashes,
    )


def unrecorded(records: DataFrame, latest: DataFrame) -> DataFrame:
    """Rowcount records of chunks the ledger does not know; malformed records are dropped.

    A record without a status was written after a completed chunk.
    """
    valid = records.where(F.col("table_name").isNotNull() & F.col("chunk_name").isNotNull())
    hashes = [h for h in HASHES if h in records.columns]
    one = valid.groupBy(*KEY).agg(
        F.max(
            F.struct(
                F.coalesce("status", F.lit(COMPLETED)).alias("status"),
                "imported_rows",
                "output_rows",
                *hashes,
            )
        ).alias("__r")
    )
    return (
        one.select(*KEY, "__r.*", F.lit(None).cast("string").alias("error"))
        .join(latest, KEY, "left_anti")
    )


def fingerprint(*fields: Column) -> Column:
    """SHA-256 of the fields joined by 0x1F; list fields are sorted and joined by commas."""
    return F.sha2(F.concat_ws(chr(31), *fields), 256)


def listed(names: Column) -> Column:
    return F.array_join(F.sort_array(names), ",")


def fingerprint_check(recorded: Column, current: Column) -> Column:
    """``unverified`` without a recorded value, else ``match`` or ``mismatch``."""
    return (
        F.when(F.coalesce(recorded, F.lit("")) == "", "unverified")
        .when(recorded == current, "match")
        .otherwise("mismatch")
    )


class ChunkLedger:
    """Ledger dataset in a shared folder, written by one driver.

    Every batch of states becomes visible as a whole or not at all, even if the job dies while it is written. Batches are merged
    into snapshots, so that a read touches a bounded number of them however long the run has lasted.
    """

    def __init__(self, spark: SparkSession, path: str, merge_after: int = 16) -> None:
        self._spark = spark
        self.path = path.rstrip("/")
        order = "batch bigint, seq bigint"
        self.states = BatchLog(
            spark, f"{self.path}/states", "parquet", f"{STATE_SCHEMA}, {HASH_SCHEMA}, {order}", _newest_rows, merge_after
        )
        self.records = BatchLog(
            spark, f"{self.path}/records", "json", f"{RECORD_SCHEMA}, {HASH_SCHEMA}", lambda rows: rows.distinct(), merge_after
        )

    def append(self, states: DataFrame) -> None:
        """Insert or replace the states of ``states`` in one step."""
        batch = self.states.next_number()
        columns = [*STATE_COLUMNS, *[F.col(h) if h in states.columns else F.lit(None).cast("string").alias(h) for h in HASHES]]
        rows = states.select(*KEY, *columns).withColumns({"batch": F.lit(batch), "seq": F.monotonically_increasing_id()})
        self.states.append(rows, batch)

    def append_rows(self, rows: Iterable[tuple], record: bool = False) -> None:
        """Insert states, with or without their hashes; with ``record`` those of completed chunks are also kept as rowcount records."""
        width = len(STATE_SCHEMA.split(",")) + len(HASHES)
        rows = [(*r, *[None] * (width - len(r))) for r in rows]
        states = self._spark.createDataFrame(rows, f"{STATE_SCHEMA}, {HASH_SCHEMA}").coalesce(1)
        self.append(states)
        if record:
            self.write_records(states.where(F.col("status") == COMPLETED))

    def latest(self) -> DataFrame:
        return latest_states(self.states.read(), ["batch", "seq"])

    def write_records(self, states: DataFrame) -> None:
        """JSON rowcount records beside the ledger, kept in case the ledger is lost."""
        hashes = [h for h in HASHES if h in states.columns]
        self.records.append(states.select(*KEY, "status", "imported_rows", "output_rows", *hashes))

    def reconcile(self, records_path: str | None = None) -> int:
        """Insert recorded chunks the ledger has lost; returns how many. ``records_path``: JSON records that lie elsewhere."""
        records = self.records.read()
        if records_path is not None:
            schema = f"{RECORD_SCHEMA}, {HASH_SCHEMA}"
            records = self._spark.read.schema(schema).option("mode", "DROPMALFORMED").json(records_path)
        lost = unrecorded(records, self.latest())
        count = lost.count()
        if count:
            self.append(lost)
        return count


def _newest_rows(states: DataFrame) -> DataFrame:
    """Of every chunk its last row as it was written."""
    columns = [c for c in states.columns if c not in KEY]
    last = F.max_by(F.struct(*columns), F.struct("batch", "seq")).alias("__last")
    return states.groupBy(*KEY).agg(last).select(*KEY, "__last.*")
