"""Print the physical plans of the run's main steps (formatted explain).

Usage: python scripts/show_plans.py [sf_dir]

Lands the events fixture as a monthly raw file, then explains:
1. raw file -> clean + rules (one Project over the scan, lineage constants);
2. staging read of the valid partitions of one month (partition pruning);
3. the GROUPING SETS aggregate over silver (column and partition pruning,
   Expand + partial aggregate before one exchange);
4. the top-zones report (window over aggregated rows only).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripyard.operators import clean as C  # noqa: E402
from tripyard.operators import gold as G  # noqa: E402
from tripyard.operators import validate as V  # noqa: E402
from tripyard.session import local_session, scratch_dir  # noqa: E402
from tripyard.sinks.warehouse import Warehouse, read_staging, write_staging  # noqa: E402
from tripyard.sources import raw_files as R  # noqa: E402
from tripyard.sources.fixtures import fixture_raw_trips  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    root = scratch_dir(spark, "plans")
    R.land_raw_files(fixture_raw_trips(spark, sf_dir, "events"), f"{root}/landing")
    periods = [(2024, 1)]
    raw = R.read_raw_trips(spark, [R.raw_file_path(f"{root}/landing", 2024, 1, R.SPARK_LAYOUT)])
    flagged = V.flag_trips(C.clean_trips(raw))
    print("=== 1. raw monthly file -> clean + rules")
    flagged.explain("formatted")
    write_staging(flagged, f"{root}/staging")
    valid = read_staging(spark, f"{root}/staging", periods, valid=True)
    print("=== 2. staging: valid partitions of 2024-01")
    V.silver_layout(valid).explain("formatted")
    wh = Warehouse(spark, f"{root}/wh", prefix="plans_")
    wh.create_tables()
    wh.replace_periods("silver_clean", V.silver_layout(valid), periods)
    silver = wh.read("silver_clean", periods)
    print("=== 3. gold groupings over silver")
    G.gold_partials(silver).explain("formatted")
    print("=== 4. top zones")
    G.top_zones(silver, 10).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
