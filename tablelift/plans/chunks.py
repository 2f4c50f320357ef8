"""From catalog frames to one row per chunk, for all tables at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions.types import (
    BUILTIN_OWNED_NAMES,
    UNSUPPORTED_NAMES,
    normalize_type_col,
)
from tablelift.operators.project import resolve_overrides

TABLE = ["schema", "table"]

# Strategy names and reason texts of a plan.
WHOLE, BY_PARTITION, UNSUPPORTED = "whole_table", "partition", "unsupported"
EXTERNAL_REASON = "external table — LOCATION file not available in staging container"
TEMPORARY_REASON = (
    "global temporary table — data is session-scoped and does not "
    "round-trip through Data Pump export"
)
STRATEGY_REASON = (
    "strategy %s is not supported; use 'whole' to override "
    "the default strategy for this table"
)


def _shown(text: Column) -> Column:
    """Text in quotes: single ones unless the text itself holds a single quote only."""
    slashed = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.when(
        text.contains("'") & ~text.contains('"'), F.concat(F.lit('"'), slashed, F.lit('"'))
    ).otherwise(F.concat(F.lit("'"), F.replace(slashed, F.lit("'"), F.lit("\\'")), F.lit("'")))


def column_reason(name: Column, data_type: Column, type_owner: Column) -> Column:
    """Why a column cannot be exported, or NULL."""
    normalized = normalize_type_col(data_type)
    label = F.concat(F.lit("column "), _shown(name))
    user_type = F.concat(label, F.lit(" has user-defined type "), type_owner, F.lit("."), data_type)
    return (
        F.when(
            normalized.isin(*UNSUPPORTED_NAMES),
            F.concat(label, F.lit(" has unsupported type "), normalized),
        )
        .when(normalized.isin(*BUILTIN_OWNED_NAMES), None)
        .when(F.coalesce(type_owner, F.lit("")) != "", user_type)
    )


def unsupported_columns(columns: DataFrame) -> DataFrame:
    """Columns that cannot be exported, with the reason."""
    reason = column_reason(F.col("column_name"), F.col("data_type"), F.col("data_type_owner"))
    return columns.withColumn("reason", reason).where(F.col("reason").isNotNull())


def unsupported_tables(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """``tables`` with ``unsupported_reason``: table type first, then the first bad column."""
    first_bad = (
        unsupported_columns(columns)
        .groupBy(*TABLE)
        .agg(F.min_by("reason", "ordinal").alias("__column_reason"))
    )
    return (
        tables.join(first_bad, TABLE, "left")
        .withColumn(
            "unsupported_reason",
            F.when(F.col("table_type") == "EXTERNAL", EXTERNAL_REASON)
            .when(F.col("table_type") == "GTT", TEMPORARY_REASON)
            .otherwise(F.col("__column_reason")),
        )
        .drop("__column_reason")
    )


def partition_chunk(position: Column, name: Column) -> Column:
    return F.format_string("partition-%05d-%s", position.cast("long"), name)


def subpartition_chunk(
    position: Column, sub_position: Column, name: Column, sub_name: Column
) -> Column:
    return F.format_string(
        "subpartition-%05d-%05d-%s-%s",
        position.cast("long"),
        sub_position.cast("long"),
        name,
        sub_name,
    )


def partition_chunks(partitions: DataFrame, subpartitions: DataFrame) -> DataFrame:
    """One row per subpartition, or per partition that has none.

    ``partitions`` (schema, table, partition_name, partition_position),
    ``subpartitions`` (schema, table, partition_name, subpartition_name,
    subpartition_position). One left join serves both kinds.
    """
    joined = partitions.join(subpartitions, [*TABLE, "partition_name"], "left")
    whole = F.col("subpartition_name").isNull()
    position, name = F.col("partition_position"), F.col("partition_name")
    return joined.select(
        *TABLE,
        F.when(whole, partition_chunk(position, name))
        .otherwise(
            subpartition_chunk(
                position, F.col("subpartition_position"), name, F.col("subpartition_name")
            )
        )
        .alias("chunk"),
        "partition_name",
        "subpartition_name",
    )


def plan_strategies(
    tables: DataFrame, columns: DataFrame, partitions: DataFrame, overrides: DataFrame | None
) -> DataFrame:
    """``(schema, table, strategy, reason)`` per table.

    Order of rules: unsupported table, override ``whole``, any other override
    (unsupported), no partitions, partitions.
    """
    planned = unsupported_tables(tables, columns)
    if overrides is None:
        planned = planned.withColumn("__strategy", F.lit(None).cast("string"))
    else:
        planned = resolve_overrides(
            planned,
            overrides.select("key", F.col("strategy").alias("__strategy")),
            F.concat_ws(".", "schema", "table"),
        )
    divided = partitions.select(*TABLE).distinct().withColumn("__divided", F.lit(True))
    wanted = F.col("__strategy")
    refused = F.format_string(STRATEGY_REASON, _shown(wanted))
    bad = F.col("unsupported_reason").isNotNull()
    return planned.join(divided, TABLE, "left").select(
        *TABLE,
        F.when(bad, UNSUPPORTED)
        .when(wanted == "whole", WHOLE)
        .when(wanted.isNotNull(), UNSUPPORTED)
        .when(F.col("__divided"), BY_PARTITION)
        .otherwise(WHOLE)
        .alias("strategy"),
        F.when(bad, F.col("unsupported_reason"))
        .when(wanted.isNotNull() & (wanted != "whole"), refused)
        .alias("reason"),
    )


def plan_chunks(
    tables: DataFrame,
    columns: DataFrame,
    partitions: DataFrame,
    subpartitions: DataFrame,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """The plan: one row per chunk, and one row without chunk per unsupported table."""
    strategies = plan_strategies(tables, columns, partitions, overrides).alias("s")
    chunks = partition_chunks(partitions, subpartitions).alias("c")
    same_table = [F.col(f"s.{k}") == F.col(f"c.{k}") for k in TABLE]
    return strategies.join(
        chunks, [*same_table, F.col("s.strategy") == BY_PARTITION], "left"
    ).select(
        "s.*",
        F.when(F.col("s.strategy") == WHOLE, "whole").otherwise(F.col("c.chunk")).alias("chunk"),
        "c.partition_name",
        "c.subpartition_name",
    )


def manifest_frames(manifest: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Flat ``(tables, columns, partitions, subpartitions)`` of a nested manifest."""
    named = manifest.withColumnRenamed("name", "table")
    tables = named.select(*TABLE, "table_type")
    columns = named.select(*TABLE, F.inline("columns")).withColumnRenamed("name", "column_name")
    parts = named.select(*TABLE, F.inline("partitions"))
    partitions = parts.select(
        *TABLE, F.col("name").alias("partition_name"), F.col("position").alias("partition_position")
    )
    subpartitions = parts.select(
        *TABLE, F.col("name").alias("partition_name"), F.explode("subpartitions").alias("sub")
    ).select(
        *TABLE,
        "partition_name",
        F.col("sub.name").alias("subpartition_name"),
        F.col("sub.position").alias("subpartition_position"),
    )
    return tables, columns, partitions, subpartitions


def existing_only(plan: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plan rows whose table exists in the source, and the tables that do not."""
    present = plan.join(catalog, TABLE, "left_semi")
    missing = plan.select(*TABLE).distinct().join(catalog, TABLE, "left_anti")
    return present, missing


def missing_schemas(plan: DataFrame, catalog: DataFrame) -> DataFrame:
    """Schemas with supported tables in the plan of which the source has no table left."""
    wanted = plan.where(F.col("strategy") != UNSUPPORTED).select("schema").distinct()
    return wanted.join(catalog, "schema", "left_anti")
