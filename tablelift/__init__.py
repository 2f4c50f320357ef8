"""tablelift: move whole database schemas into open file formats with Spark jobs.

Catalog frames in, typed and partition-wise chunked datasets out, with a chunk
ledger, count validation, a conversion report and import-log analytics.
"""

__version__ = "0.1.0"
