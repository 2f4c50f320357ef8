"""The queries of ``__spark_entry__``: each operator over whole driver tables."""

from __future__ import annotations

from driver_queries import catalog, casts, convert, logs, scans  # noqa: F401
from driver_queries.registry import ORACLES, QUERIES  # noqa: F401
