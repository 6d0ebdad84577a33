"""Readers: files, incremental extracts, JDBC, paged APIs and nested JSON."""
