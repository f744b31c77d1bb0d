"""Readers and writers: Parquet tables, CSV, JDBC, landed JSON pages, workbooks, logs, sinks."""
