"""Benchmark: every catalog query at one scale factor, one JSON line out.

    BENCH_SF_DIR   scale-factor directory (default /root/testdata/sf0.1)
    BENCH_CPUS     local[N] (default 8)
    BENCH_RUNS     timed runs per query, the median is reported (default 3)
    BENCH_ORACLE   1 to also time the literal SQL in DuckDB (default 1)
    BENCH_LITERAL  1 to also time the plain Spark SQL form of every operator
                   (default 0; EXISTS-with-OR alone takes ~40 s at sf0.1)

Each query is executed in full through the ``noop`` sink (the whole plan
runs, no rows travel to the driver).  A short untimed warm-up runs first so
the JVM's JIT does not land on the first query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.catalog import CATALOG  # noqa: E402
from quarry.session import make_session  # noqa: E402


def run_spark(spark, key: str, root: str) -> float:
    t0 = time.perf_counter()
    CATALOG[key](spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def run_literal(spark, root: str, runs: int) -> dict:
    """Median of ``runs``; a form that takes over 20 s runs once."""
    from quarry.plans.literal import LITERAL_SQL, literal_query
    out = {}
    for key in LITERAL_SQL:
        taken = []
        while len(taken) < runs and not (taken and taken[0] > 20):
            t0 = time.perf_counter()
            literal_query(spark, key, root).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - t0)
        out[key] = round(statistics.median(taken), 4)
    return out


def run_duckdb(root: str, runs: int) -> dict:
    try:
        from quarry.plans.check import duck_connection
        from quarry.plans.oracles import SQL
    except Exception:  # duckdb missing: skip the comparison
        return {}
    con = duck_connection(root)
    con.execute(f"SET threads = {int(os.environ.get('BENCH_CPUS', '8'))}")
    out = {}
    for key in CATALOG:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            con.execute(SQL[key]).fetchall()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[key] = round(best, 4)
    return out


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    with_oracle = os.environ.get("BENCH_ORACLE", "1") == "1"
    with_literal = os.environ.get("BENCH_LITERAL", "0") == "1"
    m = re.search(r"sf([0-9.]+)", root)
    sf = float(m.group(1)) if m else None

    spark = make_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                         app_name="quarry-bench",
                         extra={"spark.driver.memory": "8g"})
    for key in ("children_threshold", "rolling_dense_sum", "match_points"):
        run_spark(spark, key, root)

    times = {}
    for key in CATALOG:
        times[key] = round(statistics.median(run_spark(spark, key, root) for _ in range(runs)), 4)
    literal = {}
    if with_literal:
        try:
            literal = run_literal(spark, root, runs)
        except Exception as exc:  # optional comparison: never lose the main result
            print(f"literal timing skipped: {exc}", file=sys.stderr)
    spark.stop()

    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
    }
    if literal:
        result["literal_spark_sql_sec"] = literal
    if with_oracle:
        try:
            duck = run_duckdb(root, runs)
        except Exception as exc:  # optional comparison: never lose the main result
            print(f"duckdb timing skipped: {exc}", file=sys.stderr)
            duck = {}
        if duck:
            result["duckdb_literal_sql_sec"] = duck
            result["duckdb_literal_sql_total"] = round(sum(duck.values()), 3)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
