"""Readers and writers: parquet tables, delimited files, run records, models."""
