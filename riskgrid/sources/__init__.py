"""Scans and sinks: CSV, Parquet tables, partition replacement, model folders."""
