"""Readers: tables, chunks of tables, file sets, catalogs, logs and DDL text."""
