"""Table sources: declared commerce schemas, parquet readers and the stand-in
mapping from the supplied test tables."""

from souk.sources.standin import standin_tables
from souk.sources.tables import SCHEMAS, Tables, conform, read_tables

__all__ = ["SCHEMAS", "Tables", "conform", "read_tables", "standin_tables"]
