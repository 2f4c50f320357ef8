"""Chunk plans: what to convert, table by table and chunk by chunk."""
