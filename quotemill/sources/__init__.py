"""Readers, stand-in tables and idempotent Parquet sinks."""
