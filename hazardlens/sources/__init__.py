"""Readers: derived fixture input, landed JSON pages, CSV/parquet files, tables."""
