"""Table sources."""

from keelson.sources.parquet_tables import read_table

__all__ = ["read_table"]
