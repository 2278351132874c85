"""Inputs: the parquet tables and the derived frames the catalog builds from them."""

from quarry.sources.derived import edges, matches, roster, services
from quarry.sources.tables import TABLES, Tables, write_bucketed

__all__ = ["TABLES", "Tables", "edges", "matches", "roster", "services", "write_bucketed"]
