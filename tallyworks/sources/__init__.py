"""Readers with explicit schemas, and the mapping of the shared test tables."""

from tallyworks.sources.readers import read_csv, read_json, read_parquet, read_table

__all__ = ["read_csv", "read_json", "read_parquet", "read_table"]
