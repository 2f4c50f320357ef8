"""Conversion report from a plan and the chunk results."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.plans.chunks import TABLE, UNSUPPORTED

# Fixed value: reason text of a supported table that gave no result.
ABSENT_REASON = (
    "Staging table was absent at convert time (typically: source dump did not "
    "contain exportable metadata for this table)."
)


def report_entries(plan: DataFrame, results: DataFrame) -> DataFrame:
    """One row per *successful* or *failed* chunk and per *skipped* table.

    ``plan``: one row per chunk or more per table. ``results``: (schema, table,
    chunk, status, output_rows, output_path, error) per tried chunk. A table of
    which every chunk failed was tried, so it is not skipped.
    """
    tables = plan.select(*TABLE, "strategy", "reason").distinct()
    tried = results.select(*TABLE, "chunk", "status", "output_rows", "output_path", "error")
    # Unsupported tables have no results even if some were left from an earlier plan.
    joined = tables.alias("p").join(
        tried.alias("r"),
        [
            *[F.col(f"p.{k}") == F.col(f"r.{k}") for k in TABLE],
            F.col("p.strategy") != UNSUPPORTED,
        ],
        "left",
    )
    absent = F.col("r.chunk").isNull()
    return joined.select(
        "p.schema",
        "p.table",
        "p.strategy",
        F.when(absent, "skipped")
        .when(F.col("r.status") == "completed", "successful")
        .otherwise("failed")
        .alias("outcome"),
        F.col("r.chunk").alias("chunk"),
        F.when(F.col("r.status") == "completed", F.col("r.output_rows")).alias("output_rows"),
        F.when(F.col("r.status") == "completed", F.col("r.output_path")).alias("output_path"),
        F.when(F.col("p.strategy") == UNSUPPORTED, F.col("p.reason"))
        .when(absent, ABSENT_REASON)
        .when(F.col("r.status") != "completed", F.col("r.error"))
        .alias("reason"),
    )


def report_statistics(entries: DataFrame) -> DataFrame:
    """One row: output rows, tables in all, converted, skipped, and with failed chunks."""
    per_table = entries.groupBy(*TABLE).agg(
        F.sum("output_rows").alias("rows"),
        F.bool_or(F.col("outcome") == "skipped").alias("skipped"),
        F.bool_or(F.col("outcome") == "failed").alias("failed"),
    )
    return per_table.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_output_rows"),
        F.count(F.lit(1)).alias("tables_total"),
        F.count_if(~F.col("skipped")).alias("tables_converted"),
        F.count_if("skipped").alias("tables_skipped"),
        F.count_if("failed").alias("tables_failed"),
    )


def write_report(
    entries: DataFrame,
    path: str,
    *,
    output_format: str,
    input_paths: list[str],
    started_at: datetime,
    completed_at: datetime,
) -> dict:
    """Save entries and summary as JSON datasets; returns the summary."""
    entries.write.mode("overwrite").json(f"{path}/entries")
    spark = entries.sparkSession
    saved = spark.read.schema(entries.schema).json(f"{path}/entries")
    summary = {
        "version": 1,
        "generated_at": datetime.now(completed_at.tzinfo).isoformat(timespec="seconds"),
        "started_at": started_at.isoformat(timespec="seconds"),
        "completed_at": completed_at.isoformat(timespec="seconds"),
        "output_format": output_format,
        "input_paths": sorted(input_paths),
        "statistics": report_statistics(saved).first().asDict(),
    }
    row = spark.createDataFrame([(json.dumps(summary),)], "value string").coalesce(1)
    row.write.mode("overwrite").text(f"{path}/summary")
    return summary
