"""Import-log and DDL analytics: text rows in, structured rows out.

Log lines come as ``(file, block, seq, line)``: ``block`` and ``seq`` order the
lines of a file, and a block is bounded in size (see
:mod:`tablelift.sources.text`). No operator gathers a whole file in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.operators.catalog import SYSTEM_TABLESPACES, is_user_schema

UNKNOWN_OBJECT = "<unknown>"

# Patterns of the log and DDL texts.
ORA_CODE = r"(?i)ORA-(\d{4,5})"
TOOL_CODE = r"(IMP-\d+|ORA-\d+)"
MODERN_HEADER = r'(?i)ORA-39083:\s+Object\s+type\s+\S+\s*:\s*"([^"]+"\."[^"]+)"'
LEGACY_HEADER = (
    r"(?i)\bCREATE\s+(?:GLOBAL\s+TEMPORARY\s+|PRIVATE\s+TEMPORARY\s+)?TABLE\s+"
    r'"([^"]+"\."[^"]+)"'
)
MISSING_TABLESPACE = r"(?i)ORA-00959:\s+tablespace\s+'([^']+)'\s+does\s+not\s+exist"
MISSING_QUOTA = r"(?i)ORA-01950:\s+no\s+privileges\s+on\s+tablespace\s+'([^']+)'"
QUOTED_TABLE = (
    r"(?i)\bCREATE\s+(?:GLOBAL\s+TEMPORARY\s+|PRIVATE\s+TEMPORARY\s+)?TABLE\s+"
    r'"((?:[^"]++|"")+)"\."((?:[^"]++|"")+)"'
)
PLAIN_TABLE = (
    r"(?i)\bCREATE\s+(?:GLOBAL\s+TEMPORARY\s+|PRIVATE\s+TEMPORARY\s+)?TABLE\s+"
    r"([A-Z_$#][A-Z0-9_$#]*)\.([A-Z_$#][A-Z0-9_$#]*)\b"
)
TABLESPACE = r'(?i)\bTABLESPACE\s+"([^"]+)"'
SHOWN_SCHEMA = r"(?i)^\.\s+importing\s+(\S+)'s\s+objects\s+into"
SHOWN_TABLE = r'(?i)^\.\s+\.\s+importing\s+table\s+"([^"]+)"'

# What each known code means for a run.
CODE_BEHAVIOR = {
    "skip": (942, 1430, 1543, 1918, 1920, 4043, 4080, 28102),
    "retry": (959, 1950, 54, 1000, 12170, 12514, 12537, 12541),
    "warn": (39082, 39151),
    "fatal": (1017, 1031, 28000, 31693, 39083, 39126),
}
LEGACY_DUMP_CODES = ("ORA-39142", "ORA-39143")
HARMLESS_CODES = (
    "IMP-00003", "IMP-00017", "IMP-00041", "IMP-00098", "IMP-00403",
    "ORA-00942", "ORA-01435", "ORA-04043", "ORA-04080", "ORA-23308",
)
WARNING_RETURN_CODES = {"impdp": (2, 5), "imp": (2,), "exp": (2,)}


def forward_fill(
    df: DataFrame, value: Column, name: str, file: Sequence[str] = ("file",)
) -> DataFrame:
    """Adds ``name``: the latest non-null ``value`` at or before each row of its file.

    Two steps, so that a file of any size spreads over tasks: the last value of
    each block (pre-aggregated) is carried over the short list of blocks, then
    every block is filled on its own, starting with what was carried in.
    """
    keys = [*file, "block"]
    marked = df.withColumn("__value", value)
    last_in_block = marked.groupBy(*keys).agg(
        F.max_by("__value", F.when(F.col("__value").isNotNull(), F.col("seq"))).alias("__last")
    )
    before = Window.partitionBy(*file).orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = last_in_block.select(
        *keys, F.last("__last", ignorenulls=True).over(before).alias("__carried")
    )
    so_far = Window.partitionBy(*keys).orderBy("seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        marked.join(carried, keys, "left")
        .withColumn("__own", F.last("__value", ignorenulls=True).over(so_far))
        .withColumn(name, F.coalesce("__own", "__carried"))
        .drop("__value", "__own", "__carried")
    )


def _group(text: Column, pattern: str, group: int) -> Column:
    """One capture group of the first match, NULL without a match; no group may be empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _mentions(text: Column, *words: str) -> Column:
    """Cheap test that spares most lines the patterns."""
    upper = F.upper(text)
    return reduce(or_, [upper.contains(w) for w in words])


def _all_groups(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _object_name(line: Column, pattern: str) -> Column:
    """``SCHEMA.TABLE`` of a header line, NULL for any other line."""
    return F.replace(_group(line, pattern, 1), F.lit('"."'), F.lit("."))


def attribute_errors(lines: DataFrame, *, legacy: bool = False) -> DataFrame:
    """``(file, object, tablespace)`` per missing-tablespace line.

    The object is the latest header at or before the line, ``<unknown>`` before
    any. A header line itself is never taken as an error line.
    """
    line = F.col("line")
    header = _object_name(line, LEGACY_HEADER if legacy else MODERN_HEADER)
    tablespace = F.upper(_group(line, MISSING_TABLESPACE, 1))
    mentioned = _mentions(line, "ORA-00959", "CREATE" if legacy else "ORA-39083")
    relevant = lines.where(mentioned).select(
        "file",
        "block",
        "seq",
        header.alias("header"),
        F.when(header.isNull(), tablespace).alias("tablespace"),
    )
    filled = forward_fill(relevant, F.col("header"), "object")
    return filled.where(F.col("tablespace").isNotNull()).select(
        "file", "block", "seq",
        F.coalesce("object", F.lit(UNKNOWN_OBJECT)).alias("object"),
        "tablespace",
    )


def missing_tablespaces(lines: DataFrame, *, legacy: bool = False) -> DataFrame:
    """``(file, object, tablespace)``, each once."""
    return attribute_errors(lines, legacy=legacy).select("file", "object", "tablespace").distinct()


def missing_quota(lines: DataFrame) -> DataFrame:
    names = F.transform(_all_groups(F.col("line"), MISSING_QUOTA), F.upper)
    return lines.select("file", F.explode(names).alias("tablespace")).distinct()


def _user_tables(found: DataFrame) -> DataFrame:
    return found.where(is_user_schema(F.col("schema")))


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each key once, with the ``order`` columns of its first row.

    Pre-aggregates in every task; ordering the result by ``order`` gives the order
    of first occurrence.
    """
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*order)).alias("__first"))
        .select(*keys, "__first.*")
    )


def shown_tables(lines: DataFrame) -> DataFrame:
    """``(file, schema, table, block, seq)`` of an import progress log.

    A table line before any schema line is dropped, as are system schemas.
    """
    line = F.trim(F.regexp_replace("line", r"[\t\r]", " "))
    schema, table = _group(line, SHOWN_SCHEMA, 1), _group(line, SHOWN_TABLE, 1)
    relevant = lines.where(_mentions(F.col("line"), "IMPORTING")).select(
        "file", "block", "seq", schema.alias("__schema"), table.alias("table")
    )
    filled = forward_fill(relevant, F.col("__schema"), "schema")
    found = _user_tables(filled.where(F.col("table").isNotNull() & F.col("schema").isNotNull()))
    return first_seen(found, ["file", "schema", "table"], ["block", "seq"])


def _named(text: Column, pattern: str, form: int, clean: Callable[[Column], Column]) -> Column:
    """Every name a pattern finds in a statement, as structs in order of mention."""
    both = F.arrays_zip(
        _all_groups(text, pattern, 1).alias("schema"), _all_groups(text, pattern, 2).alias("table")
    )
    return F.transform(
        both,
        lambda pair, pos: F.struct(
            F.lit(form).alias("form"),
            pos.alias("pos"),
            clean(pair["schema"]).alias("schema"),
            clean(pair["table"]).alias("table"),
        ),
    )


def ddl_tables(statements: DataFrame, log_lines: DataFrame | None = None) -> DataFrame:
    """``(file, schema, table)`` created in DDL text, with the place of the first mention.

    Per file: quoted names if there are any of a user schema, else plain names
    (upper-cased), else the names of an import progress log. The statements are scanned once
    for both kinds of names.
    """
    order = ["block", "seq", "pos"]
    keys = ["file", "schema", "table"]
    text = F.col("statement")
    names = F.concat(
        _named(text, QUOTED_TABLE, 1, lambda c: F.replace(c, F.lit('""'), F.lit('"'))),
        _named(text, PLAIN_TABLE, 2, F.upper),
    )
    found = statements.select("file", "block", "seq", F.explode(names).alias("name"))
    found = _user_tables(found.select("file", "block", "seq", "name.*"))
    found = first_seen(found, [*keys, "form"], order)
    if log_lines is not None:
        shown = shown_tables(log_lines).withColumns({"form": F.lit(3), "pos": F.lit(0)})
        found = found.unionByName(shown)
    # distinct tables of a file, not its statements, pass this window
    best = F.min("form").over(Window.partitionBy("file"))
    return found.withColumn("best", best).where("form = best").select(*keys, *order)


def ddl_tablespaces(statements: DataFrame) -> DataFrame:
    names = F.transform(_all_groups(F.col("statement"), TABLESPACE), F.upper)
    found = statements.select("file", F.explode(names).alias("tablespace"))
    return found.where(~F.col("tablespace").isin(*SYSTEM_TABLESPACES)).distinct()


def ora_codes(lines: DataFrame) -> DataFrame:
    """``(file, code)``: every ORA code of each log once."""
    codes = _all_groups(F.col("line"), ORA_CODE).cast("array<int>")
    return lines.select("file", F.explode(codes).alias("code")).distinct()


def is_legacy_dump(lines: DataFrame) -> DataFrame:
    """Per log whether it says that the dump has the legacy format."""
    line = F.col("line")
    hit = F.bool_or(line.contains(LEGACY_DUMP_CODES[0]) | line.contains(LEGACY_DUMP_CODES[1]))
    return lines.groupBy("file").agg(hit.alias("is_legacy"))


def code_behavior(code: Column) -> Column:
    """skip, retry, warn or fatal; a code nobody listed is fatal."""
    return F.coalesce(listed_behavior(code), F.lit("fatal"))


def listed_behavior(code: Column) -> Column:
    chain = F
    for behavior, codes in CODE_BEHAVIOR.items():
        chain = chain.when(code.isin(*codes), F.lit(behavior))
    return chain


def fatal_codes(lines: DataFrame) -> DataFrame:
    """Codes that are *listed* as fatal; unlisted ones are left out."""
    return ora_codes(lines).where(listed_behavior(F.col("code")) == "fatal")


def exit_class(tool: Column, return_code: Column, promoted: Column) -> Column:
    """success, warning or fatal of a tool run.

    ``promoted``: whether the output holds a code listed as fatal, which turns a
    warning return code into a fatal one.
    """
    warning = F.lit(False)
    for name, codes in WARNING_RETURN_CODES.items():
        warning = warning | ((tool == name) & return_code.isin(*codes))
    return (
        F.when(return_code == 0, "success")
        .when(warning & ~F.coalesce(promoted, F.lit(False)), "warning")
        .otherwise("fatal")
    )


def classify_exits(runs: DataFrame, lines: DataFrame) -> DataFrame:
    """``runs`` (file, tool, return_code) with the class of each run's exit."""
    fatal = fatal_codes(lines).select("file").distinct().withColumn("__fatal", F.lit(True))
    return (
        runs.join(fatal, "file", "left")
        .withColumn(
            "exit_class", exit_class(F.col("tool"), F.col("return_code"), F.col("__fatal"))
        )
        .drop("__fatal")
    )


def classify_import_errors(lines: DataFrame) -> DataFrame:
    """Per log: codes seen, split into known harmless and unknown, and the log level.

    Codes are made distinct before they are gathered, so a log with very many
    error lines reduces in every task first.
    """
    seen = lines.select(
        "file", F.explode_outer(_all_groups(F.col("line"), TOOL_CODE)).alias("code")
    ).distinct()
    known = F.col("code").isin(*HARMLESS_CODES)
    gathered = seen.groupBy("file").agg(
        F.sort_array(F.collect_set(F.when(known, F.col("code")))).alias("known_nonfatal"),
        F.sort_array(F.collect_set(F.when(~known, F.col("code")))).alias("unknown"),
    )
    return gathered.withColumn(
        "has_codes", (F.size("known_nonfatal") > 0) | (F.size("unknown") > 0)
    ).withColumn(
        "level",
        F.when(~F.col("has_codes"), "error")
        .when(F.size("unknown") > 0, "warning")
        .otherwise("info"),
    )
