"""Scans and sinks: CSV, Parquet tables, staged publish, test-data views."""
