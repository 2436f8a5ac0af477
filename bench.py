"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the time to derive and land the hydrology views from the tables
(``fixture_build``, the part that grows with the scale factor) plus the sum of
the per-query times.  After one untimed warm-up pass over all headline queries,
each is executed in full (``noop`` sink, every column computed) three times and
the fastest run is reported.

``BENCH_FULL=1`` adds one run of the full workload size, 587 gauges x 640 issue
dates, over basins hashed from the customer and supplier keys
(``full_workload``; not part of ``value``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from functools import cached_property

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from basinflow.fixtures import Fixtures  # noqa: E402

HEADLINE = [
    "mixed_samples",      # flagship: 106-step mixed-resolution samples
    "annual_samples",     # 366-step annual recipe
    "target_segments",    # streamflow-only sequences
    "resample_weekly",    # 7-day anchored resample
    "nearest_issue",      # nearest as-of join
    "drop_report",        # gate report from the candidate grid
    "drop_bad_groups",    # group scope of the missing-value gate
    "normalize",          # train statistics applied to every split
    "pack_samples",       # arrays per sample
    "kge",                # per-sample skill
    "kge_cdf",            # distributed ranking
    "metric_means",       # batch means of all metrics in one pass
    "assign_batches",     # distributed batch numbering
    "rdb_flow",           # text source parse
]

FULL_GAUGES = 587
FULL_STRIDE = 3
FULL_BLOCKS = {          # 366 + 122 + 152 = 640 issue dates
    "train": ("1996-01-01", "1998-12-31"),
    "validation": ("1999-01-01", "1999-12-31"),
    "test": ("2000-01-01", "2001-03-30"),
}


class WideFixtures(Fixtures):
    """The fixture views with many basins: keys modulo FULL_GAUGES."""

    def _land_path(self, name: str) -> str:
        return super()._land_path(f"wide-{name}")

    @cached_property
    def nations(self):
        n = self.spark.range(FULL_GAUGES).select(F.col("id").cast("int").alias("n_nationkey"))
        return n.select("n_nationkey", F.lit("").alias("n_name"), F.lit(0).alias("n_regionkey"))

    @cached_property
    def flow_daily(self):
        orders = self.table("orders", "o_custkey", "o_orderdate", "o_totalprice")
        return (orders.groupBy((F.col("o_custkey") % FULL_GAUGES).alias("k"), F.to_date("o_orderdate").alias("date"))
                .agg(F.sum("o_totalprice").alias("q")))

    @cached_property
    def obs_daily(self):
        items = self.table("lineitem", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_tax", "l_discount")
        return (items.groupBy((F.col("l_suppkey") % FULL_GAUGES).alias("k"), F.to_date("l_shipdate").alias("date"))
                .agg(F.sum("l_quantity").alias("p"), F.avg("l_extendedprice").alias("t"), F.sum("l_tax").alias("s"),
                     F.avg("l_discount").alias("u"), F.max("l_discount").alias("v"),
                     F.count(F.lit(1)).cast("double").alias("dp")))


def run(df) -> float:
    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - t


def full_workload(spark, sf_dir) -> dict:
    from basinflow.functions.columns import gauge_suffix
    from basinflow.operators import calendar as cal
    from basinflow.operators import samples as smp
    f = WideFixtures(spark, sf_dir)
    t = time.time()
    for view in (f.flow_dense, f.obs, f.fcst):
        view.count()
    build = time.time() - t
    cand = cal.candidates(f.gauges.select(gauge_suffix("gauge_id").alias("basin_id")), FULL_BLOCKS, FULL_STRIDE, key="basin_id")
    samples = smp.mixed_samples(f.flow_dense, f.obs, f.fcst, cand, FULL_BLOCKS, FULL_STRIDE)
    return {"gauges": FULL_GAUGES, "candidates": cand.count(), "fixture_build": round(build, 1), "mixed_samples": round(run(samples), 1)}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from basinflow.plans.queries import REGISTRY
    from basinflow.session import local_session

    spark = local_session(cores=cpus)
    t0 = time.time()
    f = Fixtures(spark, sf_dir)
    for view in (f.flow_dense, f.obs, f.fcst):
        view.count()
    _ = (f.rdb_dir, f.names_csv)
    fixture_build = time.time() - t0

    # One untimed pass: JIT compilation of Spark's generated code would
    # otherwise be charged to whichever queries happen to run first.
    for name in HEADLINE:
        run(REGISTRY[name][0](spark, sf_dir))

    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(3):
            t = time.time()
            run(REGISTRY[name][0](spark, sf_dir))
            dt = time.time() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(fixture_build + sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "fixture_build": round(fixture_build, 3),
        "stat": "fixture_build + min of 3 full executions after one warm-up pass",
    }
    if os.environ.get("BENCH_FULL"):
        out["full_workload"] = full_workload(spark, sf_dir)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
