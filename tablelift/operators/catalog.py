"""Catalog discovery over all tables at once.

Input frames have one row per catalog entry (``owner``, ``table_name``, ...).
Everything is keyed on ``(owner, table_name)``, so the aggregates and the joins
after them share one partitioning. Arrays are only built for groups the source
database itself bounds: columns of a table, columns of a key, partitions of a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE = ["owner", "table_name"]

# The schemas and tablespaces the source database maintains itself.
SYSTEM_SCHEMAS = (
    "ANONYMOUS", "APPQOSSYS", "AUDSYS", "CTXSYS", "DBSFWUSER", "DBSNMP", "DIP", "DVF",
    "DVSYS", "GGSYS", "GSMADMIN_INTERNAL", "GSMCATUSER", "GSMUSER", "LBACSYS", "MDSYS",
    "OJVMSYS", "OLAPSYS", "ORDDATA", "ORDPLUGINS", "ORDSYS", "OUTLN",
    "REMOTE_SCHEDULER_AGENT", "SYS", "SYS$UMF", "SYSBACKUP", "SYSDG", "SYSKM", "SYSRAC",
    "SYSTEM", "WMSYS", "XDB", "XS$NULL",
)
SYSTEM_TABLESPACES = ("SYSTEM", "SYSAUX", "USERS", "TEMP", "UNDOTBS1")


def is_user_schema(schema: Column) -> Column:
    return ~F.upper(schema).isin(*SYSTEM_SCHEMAS)


def visible_columns(tab_cols: DataFrame) -> DataFrame:
    return tab_cols.where(F.col("column_id").isNotNull() & (F.col("hidden_column") == "NO"))


def with_column_comments(columns: DataFrame, comments: DataFrame) -> DataFrame:
    return columns.join(comments, [*TABLE, "column_name"], "left")


def with_table_comments(tables: DataFrame, comments: DataFrame) -> DataFrame:
    return tables.join(comments, TABLE, "left")


def real_tables(tables: DataFrame, external: DataFrame) -> DataFrame:
    """Tables that are neither external nor temporary."""
    kept = tables.where(F.coalesce(F.col("temporary"), F.lit("N")) == "N")
    return kept.join(external, TABLE, "left_anti")


def key_columns(constraints: DataFrame, cons_columns: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Columns of the constraints of the given kinds (``P`` primary, ``U`` unique)."""
    wanted = constraints.where(F.col("constraint_type").isin(*kinds)).select(
        *TABLE, "constraint_name", "constraint_type"
    )
    members = cons_columns.select("owner", "constraint_name", "column_name", "position")
    return wanted.join(members, ["owner", "constraint_name"], "inner")


def _in_order(order: Sequence[str], value: str) -> Column:
    """Array of ``value`` in the order of the ``order`` columns (ties by the value)."""
    pairs = F.array_sort(F.collect_list(F.struct(*order, value)))
    return F.transform(pairs, lambda p: p[value])


def primary_keys(constraints: DataFrame, cons_columns: DataFrame) -> DataFrame:
    members = key_columns(constraints, cons_columns, ["P"])
    return members.groupBy(*TABLE).agg(_in_order(["position"], "column_name").alias("primary_key"))


def unique_keys(constraints: DataFrame, cons_columns: DataFrame) -> DataFrame:
    """One ordered column list per unique constraint, the lists ordered by constraint name."""
    members = key_columns(constraints, cons_columns, ["U"])
    keys = members.groupBy(*TABLE, "constraint_name").agg(
        _in_order(["position"], "column_name").alias("key")
    )
    return keys.groupBy(*TABLE).agg(_in_order(["constraint_name"], "key").alias("unique_keys"))


def partition_lists(tab_partitions: DataFrame, tab_subpartitions: DataFrame) -> DataFrame:
    """Partitions of each table in order, each with its subpartitions in order."""
    owner = F.col("table_owner").alias("owner")
    subs = (
        tab_subpartitions.select(
            owner,
            "table_name",
            "partition_name",
            F.col("subpartition_position").cast("long").alias("position"),
            F.col("subpartition_name").alias("name"),
        )
        .groupBy(*TABLE, "partition_name")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("position", "name"))),
                lambda s: F.struct(s["name"].alias("name"), s["position"].alias("position")),
            ).alias("subpartitions")
        )
    )
    parts = tab_partitions.select(
        owner,
        "table_name",
        "partition_name",
        F.col("partition_position").cast("long").alias("position"),
    )
    none = F.array().cast("array<struct<name:string,position:bigint>>")
    nested = parts.join(subs, [*TABLE, "partition_name"], "left").select(
        *TABLE,
        "position",
        F.col("partition_name").alias("name"),
        F.coalesce("subpartitions", none).alias("subpartitions"),
    )
    return nested.groupBy(*TABLE).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "name", "subpartitions"))),
            lambda p: F.struct(p["name"].alias("name"), p["position"].alias("position"),
                               p["subpartitions"].alias("subpartitions")),
        ).alias("partitions")
    )


def segment_bytes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("owner", F.col("segment_name").alias("table_name")).agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("segment_bytes")
    )


def estimated_bytes(tables: DataFrame, segments: DataFrame | None) -> DataFrame:
    """Allocated bytes per table; without any, rows times average row length.

    ``segments`` is None when the view is not readable: then only statistics remain.
    """
    if segments is None:
        sized = tables.withColumn("segment_bytes", F.lit(None).cast("long"))
    else:
        sized = tables.join(segment_bytes(segments), TABLE, "left").withColumn(
            "segment_bytes", F.coalesce("segment_bytes", F.lit(0).cast("long"))
        )
    by_statistics = F.col("num_rows").cast("long") * F.col("avg_row_len").cast("long")
    empty = F.coalesce(F.col("segment_bytes"), F.lit(0)) == 0
    return sized.withColumn(
        "estimated_bytes",
        F.when(empty, F.coalesce(by_statistics, F.col("segment_bytes"))).otherwise(
            F.col("segment_bytes")
        ),
    ).drop("segment_bytes")


def with_table_type(tables: DataFrame, external: DataFrame) -> DataFrame:
    """EXTERNAL if listed as such, else GTT if temporary, else TABLE."""
    listed = external.select(*TABLE).distinct().withColumn("__external", F.lit(True))
    return (
        tables.join(listed, TABLE, "left")
        .withColumn(
            "table_type",
            F.when(F.col("__external"), "EXTERNAL")
            .when(F.col("temporary") == "Y", "GTT")
            .otherwise("TABLE"),
        )
        .drop("__external")
    )


def column_lists(columns: DataFrame) -> DataFrame:
    """Visible columns of each table as one ordered array."""
    entry = F.struct(
        F.col("column_id").cast("long").alias("ordinal"),
        F.col("column_name").alias("name"),
        F.col("data_type"),
        (F.col("nullable") == "Y").alias("nullable"),
        F.col("data_precision").cast("int").alias("precision"),
        F.col("data_scale").cast("int").alias("scale"),
        F.col("char_length").cast("int").alias("char_length"),
        F.col("char_used"),
        F.col("data_type_owner"),
        F.col("comments").alias("comment"),
    )
    return columns.groupBy(*TABLE).agg(F.array_sort(F.collect_list(entry)).alias("columns"))


def inspect_catalog(
    *,
    tables: DataFrame,
    tab_cols: DataFrame,
    col_comments: DataFrame,
    tab_comments: DataFrame,
    external_tables: DataFrame,
    tab_partitions: DataFrame,
    tab_subpartitions: DataFrame,
    constraints: DataFrame,
    cons_columns: DataFrame,
    segments: DataFrame | None = None,
) -> DataFrame:
    """The manifest: one row per table. External tables count even if only listed as such."""
    stated = tables.select(*TABLE, "num_rows", "avg_row_len", "temporary")
    listed = external_tables.select(*TABLE).distinct().join(tables, TABLE, "left_anti")
    every = stated.unionByName(listed, allowMissingColumns=True)
    described = with_table_comments(
        with_table_type(estimated_bytes(every, segments), external_tables),
        tab_comments.select(*TABLE, F.col("comments").alias("comment")),
    )
    columns = column_lists(with_column_comments(visible_columns(tab_cols), col_comments))
    manifest = described
    for part in (
        columns,
        partition_lists(tab_partitions, tab_subpartitions),
        primary_keys(constraints, cons_columns),
        unique_keys(constraints, cons_columns),
    ):
        manifest = manifest.join(part, TABLE, "left")
    names = F.array().cast("array<string>")
    no_parts = F.array().cast(
        "array<struct<name:string,position:bigint,"
        "subpartitions:array<struct<name:string,position:bigint>>>>"
    )
    return manifest.select(
        F.col("owner").alias("schema"),
        F.col("table_name").alias("name"),
        "columns",
        "estimated_bytes",
        F.col("num_rows").cast("long").alias("row_count"),
        F.coalesce("partitions", no_parts).alias("partitions"),
        F.coalesce("primary_key", names).alias("primary_key"),
        F.coalesce("unique_keys", F.array().cast("array<array<string>>")).alias("unique_keys"),
        "table_type",
        "comment",
    )


def byte_columns(
    tab_cols: DataFrame,
    tables: DataFrame,
    external: DataFrame,
    virtual_columns: DataFrame,
    part_key_columns: DataFrame,
    subpart_key_columns: DataFrame,
) -> DataFrame:
    """Byte-sized string columns of real tables that may be widened to characters."""
    kept = tab_cols.where(
        F.col("data_type").isin("VARCHAR2", "CHAR") & (F.col("char_used") == "B")
    ).join(real_tables(tables, external), TABLE, "left_semi")
    for excluded in (virtual_columns, part_key_columns, subpart_key_columns):
        kept = kept.join(excluded, [*TABLE, "column_name"], "left_anti")
    return kept.select(*TABLE, "column_name", "data_type", "char_length")


def byte_char_audit(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Which string columns outgrow their size when it is counted in bytes.

    One pass over the named columns only; one result row per column.
    """
    measured = []
    for name, limit in limits.items():
        octets, chars = F.octet_length(F.col(name)), F.char_length(F.col(name))
        measured.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(limit).alias("char_length"),
                F.max(octets).alias("max_bytes"),
                F.max(chars).alias("max_chars"),
                F.count_if(octets > chars).alias("multibyte_rows"),
                F.count_if(octets > limit).alias("rows_over_bytes"),
                F.count_if(chars > limit).alias("rows_over_chars"),
            )
        )
    audit = df.agg(F.array(*measured).alias("audit")).select(F.inline("audit"))
    return audit.withColumn("needs_widening", F.col("rows_over_bytes") > F.col("rows_over_chars"))
