"""quarry: analytical DataFrame operators for PySpark.

Each operator takes DataFrames plus parameters and returns a DataFrame; all
of them are compositions of built-in Spark SQL functions, so Catalyst plans
them and whole-stage codegen runs them.  Layout:

- ``quarry.sources``    parquet tables and the derived inputs the catalog uses
- ``quarry.functions``  small column helpers (money, weekdays, date ranges)
- ``quarry.operators``  the operators, grouped by family
- ``quarry.plans``      the query catalog and its DuckDB oracle SQL
"""

from quarry.session import ensure_checkpoint_dir, make_session

__all__ = ["make_session", "ensure_checkpoint_dir"]
