"""Timed phases of a run, kept as JSON lines. Metrics never fail the work they time."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.errors import SPARK_ERRORS, first_line

LOGGER = logging.getLogger(__name__)


class RunMetrics:
    """Collects ``phase``, fixed fields and ``took_ms``; ``path=None`` keeps nothing."""

    def __init__(self, spark: SparkSession, path: str | None) -> None:
        self._spark, self._path = spark, path
        self._rows: list[tuple[str, dict[str, str], float | None]] = []

    @property
    def kept(self) -> bool:
        return self._path is not None

    def record(self, name: str, **fields: object) -> None:
        """Something measured that is not a span of time."""
        self._rows.append((name, {k: str(v) for k, v in fields.items()}, None))

    @contextmanager
    def phase(self, name: str, **fields: object) -> Iterator[None]:
        start = time.perf_counter()
        try:
            yield
        finally:
            took = round((time.perf_counter() - start) * 1000.0, 2)
            self._rows.append((name, {k: str(v) for k, v in fields.items()}, took))

    def flush(self) -> None:
        rows, self._rows = self._rows, []
        if not self._path or not rows:
            return
        try:
            schema = "phase string, fields map<string,string>, took_ms double"
            frame = self._spark.createDataFrame(rows, schema).coalesce(1)
            frame.write.mode("append").json(self._path)
        except SPARK_ERRORS as error:
            LOGGER.warning("run metrics not written: %s", first_line(error))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    schema = "phase string, fields map<string,string>, took_ms double"
    return spark.read.schema(schema).json(path)


def chunk_metrics(metrics: DataFrame) -> DataFrame:
    """One row per measured chunk: table_name, chunk, status, input_rows, output_rows, bad_rows, bytes, files."""
    field = lambda name: F.col("fields")[name]
    numbers = {"input_rows": "rows", "output_rows": "output_rows", "bad_rows": "bad_rows", "bytes": "bytes", "files": "files"}
    return metrics.where("phase = 'chunk'").select(
        field("table").alias("table_name"), field("chunk").alias("chunk"), field("status").alias("status"),
        *[field(f).cast("bigint").alias(name) for name, f in numbers.items()],
    )


def metrics_by_phase(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("phase").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum("took_ms").alias("total_ms"),
        F.max("took_ms").alias("max_ms"),
    )
