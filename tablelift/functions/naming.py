"""Names of output directories and of partition values inside them."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Spark escapes in ``column=value`` directory names.
_PARTITION_ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}


def safe_segment(name: str) -> str:
    """Reversible path segment: percent-encoded except ``A-Za-z0-9_.-~``, case kept."""
    return quote(name, safe="")


def safe_segment_col(name: Column) -> Column:
    encoded = F.url_encode(name)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def partition_directory(column: str, value: str) -> str:
    """Directory Spark itself uses for ``column = value`` in a partitioned write."""
    escaped = "".join(f"%{ord(c):02X}" if c in _PARTITION_ESCAPED else c for c in value)
    return f"{column}={escaped}"


def table_path(root: str, schema: str, table: str) -> str:
    return "/".join([root.rstrip("/"), safe_segment(schema), safe_segment(table)])
