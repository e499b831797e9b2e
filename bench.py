"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query runs to completion through Spark's no-op sink (the whole plan
executes, nothing is collected). Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Extra entries, reported but not added to the total, compare strategies on
the same rows: ``gold_one_pass`` (GROUPING SETS once, checkpointed, five
tables from it) against ``gold_per_table_recount`` (one aggregate per table,
each counted twice before being written, plus a total count); and
``month_run`` (the run for one month) against
``month_reference_pass_structure`` (the same month with the pass structure of
a per-month pipeline that re-counts at every step).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import uuid  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tripyard.operators import gold as G  # noqa: E402
from tripyard.operators import validate as V  # noqa: E402
from tripyard.operators.clean import clean_trips  # noqa: E402
from tripyard.plans.registry import queries  # noqa: E402
from tripyard.plans.job import run_frame  # noqa: E402
from tripyard.session import local_session, scratch_dir  # noqa: E402
from tripyard.sources.fixtures import fixture_raw_trips  # noqa: E402

HEADLINE = [
    "clean_trips",
    "flagged_trips",
    "silver_clean",
    "silver_rejected",
    "validation_stats",
    "rejection_reasons",
    "trips_by_day",
    "trips_by_zone",
    "payment_summary",
    "hourly_demand",
    "zone_avg_fare",
    "top_zones",
    "constraint_violations",
    "documented_checks",
    "load_counts",
    "silver_clean_events",
    "trips_by_day_events",
    "load_counts_events",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def materialized_silver(spark, sf_dir):
    """Silver rows as the run has them: written once, then read."""
    flagged = V.flag_trips(clean_trips(fixture_raw_trips(spark, sf_dir))).checkpoint(eager=True)
    return V.silver_layout(V.valid_trips(flagged)).checkpoint(eager=True)


def gold_one_pass(silver):
    partials = G.gold_partials(silver).checkpoint(eager=True)
    for table in G.gold_tables(partials).values():
        run_noop(table)


def gold_per_table_recount(silver):
    silver.count()
    for name in G.GOLD_KEYS:
        table = G.gold_table(silver, name)
        table.count()
        table.count()
        run_noop(table)


def reference_pass_structure_month(spark, sf_dir):
    """One month (events) with the pass structure of a per-month pipeline
    that re-counts at every step: clean (count raw, count clean, write
    staging in 4 files), validate (read staging, count valid, count rejected,
    reason histogram, write valid in 4 and rejected in 2 files), silver
    (read, count, write; read, count, write), gold (five tables, each
    counted twice then written, plus a separate total count). Same operators,
    same rows; bench-only comparison, not part of the library."""
    root = scratch_dir(spark, "refstyle")
    raw = fixture_raw_trips(spark, sf_dir, "events")
    raw.count()
    clean = clean_trips(raw)
    clean.count()
    clean.coalesce(4).write.mode("overwrite").parquet(f"{root}/staging")
    staged = spark.read.parquet(f"{root}/staging")
    valid, rejected = V.split_valid_rejected(V.flag_trips(staged))
    valid.count()
    rejected.count()
    rejected.groupBy("rejection_reason").count().orderBy(F.desc("count")).collect()
    valid.coalesce(4).write.mode("overwrite").parquet(f"{root}/valid")
    V.rejected_layout(rejected).coalesce(2).write.mode("overwrite").parquet(f"{root}/rejected")
    silver = V.silver_layout(spark.read.parquet(f"{root}/valid"))
    silver.count()
    silver.count()
    silver.write.mode("overwrite").parquet(f"{root}/silver")
    rej = spark.read.parquet(f"{root}/rejected")
    rej.count()
    rej.write.mode("overwrite").parquet(f"{root}/silver_rejected")
    gold_in = V.silver_layout(spark.read.parquet(f"{root}/valid"))
    gold_in.count()
    for name in G.GOLD_KEYS:
        table = G.gold_table(gold_in, name)
        table.count()
        table.count()
        table.write.mode("overwrite").parquet(f"{root}/gold_{name}")


def our_run_month(spark, sf_dir):
    """The same month through the run (one raw pass, staging partitions,
    one-pass gold), including its warehouse tables and summary."""
    root = scratch_dir(spark, "ourrun")
    raw = fixture_raw_trips(spark, sf_dir, "events")
    run_frame(spark, raw, [(2024, 1)], f"{root}/wh", f"{root}/work", prefix=f"b{uuid.uuid4().hex[:6]}_")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="tripyard-bench")
    qs = queries()
    run_noop(qs["clean_trips"](spark, sf_dir))  # warm-up: JIT, file listing cache
    times = {}
    for key in HEADLINE:
        times[key] = timed(lambda: run_noop(qs[key](spark, sf_dir)))
    silver = materialized_silver(spark, sf_dir)
    extra = {
        "gold_one_pass": timed(lambda: gold_one_pass(silver)),
        "gold_per_table_recount": timed(lambda: gold_per_table_recount(silver)),
        "month_reference_pass_structure": timed(lambda: reference_pass_structure_month(spark, sf_dir)),
        "month_run": timed(lambda: our_run_month(spark, sf_dir)),
    }
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {**times, **extra},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
