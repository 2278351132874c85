"""Query catalog (operators bound to the driver's tables), the DuckDB oracle
SQL for every query, and the literal Spark SQL baselines."""

from quarry.plans.catalog import CATALOG
from quarry.plans.oracles import SQL

__all__ = ["CATALOG", "SQL"]
