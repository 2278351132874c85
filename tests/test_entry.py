"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_and_has_a_stable_schema(spark):
    m = load_entry()
    df = m.entry(spark)
    assert df.schema.simpleString() == "struct<part_id:bigint,month:int,part_summary:double>"
    assert len(df.collect()) == 10


def test_every_query_has_an_oracle_and_aliased_columns(spark):
    from quarry.plans.catalog import CATALOG

    m = load_entry()
    q, sql = m.queries(), m.oracle_sql()
    assert set(CATALOG) <= set(sql) <= set(q) and len(CATALOG) == 43
    for key in CATALOG:
        cols = q[key](spark, "/root/testdata/sf0.001").columns
        assert all(c.isidentifier() and not c.startswith("_") for c in cols), (key, cols)
