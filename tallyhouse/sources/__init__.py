"""Readers and writers: CSV, parquet, JDBC, and committed table versions."""
