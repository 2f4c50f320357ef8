"""Catalog, projection, partition, ledger, validation, report and log operators."""
