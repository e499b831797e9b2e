"""The monthly run for any number of months, in few passes over the data.

raw files --(1 pass)--> staging (cleaned + flagged, partitioned by period and
validity) --> silver clean (valid partitions) and silver rejected (rejected
partitions) --> gold: one GROUPING SETS pass over silver clean, clustered by
month and checkpointed (it is small: days + zones + payment codes + hours per
month), then five tables from it. The rejected load and the five gold writes
run as concurrent jobs. The run summary comes from rows counted on the writes.
All tables are written beside what is stored and checked; only then their
periods change over, in one logged step, with one audit time for the run.

Compared with one job per month that re-counts at every step, the raw data
is read once, the valid trips twice (silver write, gold read) and the
rejected trips once, whatever the number of months.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripyard.functions.numeric import rounded_percent
from tripyard.operators.clean import bronze_layout, clean_trips
from tripyard.operators.gold import conform, gold_partials, gold_row_counts, wide_gold_tables
from tripyard.operators.quality import (
    check_conditions,
    constraint_violations,
    observe_checks,
    require_none,
    table_name,
)
from tripyard.operators.stats import rejection_reasons
from tripyard.operators.validate import flag_trips, rejected_layout, silver_layout
from tripyard.schema import (
    FIRST_YEAR,
    GOLD_SCHEMAS,
    MIN_RAW_FILE_BYTES,
    PERIOD_COLUMNS,
    REJECTED_SOURCE_COLUMNS,
)
from tripyard.sinks.warehouse import (
    PreparedLoad,
    Warehouse,
    in_periods,
    read_staging,
    staged_counts_seen,
    staging_counts_exprs,
    staging_schema,
    write_staging,
)
from tripyard.sources.raw_files import (
    FLAT_LAYOUT,
    file_inventory,
    raw_file_path,
    read_raw_trips,
    require_valid_files,
    resolve_periods,
)


@dataclass
class RunResult:
    summary: DataFrame
    loaded: dict[str, dict[tuple[int, int], int]] = field(default_factory=dict)
    staging_root: str = ""
    # (table, check, column) -> rows breaking a warehouse constraint (C1-C5);
    # a run with any such row raises ConstraintViolation instead
    violations: dict[tuple[str, str, str], int] = field(default_factory=dict)
    # A7 per month: (reference_year, reference_month, rejection_reason, count)
    reasons: DataFrame | None = None


def prepare_silver_and_gold(
    spark: SparkSession,
    staging_root: str,
    warehouse: Warehouse,
    periods: list[tuple[int, int]],
    schema: StructType | None = None,
    staged: dict[tuple[int, int], tuple[int, int]] | None = None,
    loaded_at: dt.datetime | None = None,
) -> tuple[list[PreparedLoad], dict[tuple[str, str, str], int]]:
    """S11-S13 for the given periods, reading the staging partitions: the
    prepared loads of both silver and all gold tables, nothing of which is
    stored yet, and the gold constraint checks (C1-C5)."""
    valid = read_staging(spark, staging_root, periods, valid=True, schema=schema)
    # Rows per month are known from the staging counts (and from the small
    # gold groupings); each load only verifies them against what it wrote.
    valid_rows = {p: v for p, (_, v) in staged.items()} if staged else None
    rejected_rows = {p: t - v for p, (t, v) in staged.items()} if staged else None
    silver = warehouse.prepare("silver_clean", silver_layout(valid), periods, expected=valid_rows, loaded_at=loaded_at)
    rejected = rejected_layout(read_staging(spark, staging_root, periods, valid=False, schema=schema))
    # The gold groupings are small (bounded by months x keys, not by trips).
    # Clustering them by period makes each month's rows one task, so every
    # gold table gets one file per month instead of one per task and month,
    # and the payment share window needs no further shuffle. A reliable
    # checkpoint (shared folder) then cuts the lineage: the five table writes
    # reuse it without re-reading silver, and it survives executor loss.
    partials = (
        gold_partials(warehouse.prepared_rows(silver))
        .repartition(*PERIOD_COLUMNS)
        .checkpoint(eager=True)
    )
    wide = wide_gold_tables(partials)
    # Gold constraints are checked on the small groupings: a total beyond its
    # column stops the run before any period of any table is replaced.
    violations = {
        (r.table_name, r.check_name, r.column_name): r.violations for r in constraint_violations(wide).collect()
    }
    require_none(violations)
    gold_rows = gold_row_counts(partials, periods)
    writes = {name: conform(name, rows) for name, rows in wide.items()}
    writes["silver_rejected"] = rejected
    expected = {**gold_rows, "silver_rejected": rejected_rows}
    # Independent jobs run concurrently (the gold ones have few tasks).
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        futures = [
            pool.submit(warehouse.prepare, k, df, periods, False, expected.get(k), loaded_at)
            for k, df in writes.items()
        ]
        return [silver, *(f.result() for f in futures)], violations


def _staging_checks() -> tuple[list[tuple[str, str, str]], list[tuple[str, str, Column]]]:
    """The constraints of both silver tables over flagged trips: their names
    (table, check, column) and the conditions, each on the rows of its table."""
    valid = F.col("rejection_reason").isNull()
    names, checks = [], []
    for key, when in (("silver_clean", valid), ("silver_rejected", ~valid)):
        renamed = {f"raw_{n}" for n, _ in REJECTED_SOURCE_COLUMNS} if key == "silver_rejected" else set()
        for check, col, broken in check_conditions(key, when):
            if col not in renamed:  # those may be null and have no limits
                names.append((table_name(key), check, col))
                checks.append((check, col, broken))
    return names, checks


SUMMARY_SCHEMA = "reference_year smallint, reference_month smallint, metric string, value double"


def observed_summary(
    spark: SparkSession,
    staged: dict[tuple[int, int], tuple[int, int]],
    loaded: dict[str, dict[tuple[int, int], int]],
) -> DataFrame:
    """(reference_year, reference_month, metric, value) of the run, from
    the row counts of the written partitions. Every requested period reports its
    totals (0 and pct_rejected 0 when it had no rows); a table reports a
    period only when it loaded rows for it."""
    rows = []
    for (y, m), (total, valid) in sorted(staged.items()):
        rejected = total - valid
        pct = 0.0 if total == 0 else float(
            (Decimal(rejected * 100) / Decimal(total)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        )
        rows += [(y, m, "total", float(total)), (y, m, "total_valid", float(valid)),
                 (y, m, "total_rejected", float(rejected)), (y, m, "pct_rejected", pct)]
    for key, counts in loaded.items():
        rows += [(y, m, f"{key}_rows", float(n)) for (y, m), n in sorted(counts.items()) if n > 0]
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def run_summary(
    spark: SparkSession, staging_root: str, warehouse: Warehouse, periods: list[tuple[int, int]]
) -> DataFrame:
    """S14 recomputed from the written tables (an audit of the observed
    summary). Counts touch only partition columns, so they read Parquet row
    counts, not data columns."""
    staged = (
        read_staging(spark, staging_root, periods)
        .groupBy(*PERIOD_COLUMNS)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("total_valid"))
    )
    stats = staged.select(
        *PERIOD_COLUMNS,
        F.col("total").cast("double").alias("total"),
        F.col("total_valid").cast("double").alias("total_valid"),
        (F.col("total") - F.col("total_valid")).cast("double").alias("total_rejected"),
        rounded_percent(F.col("total") - F.col("total_valid"), F.col("total"), "decimal(5,2)")
        .cast("double").alias("pct_rejected"),
    )
    metrics = ["total", "total_valid", "total_rejected", "pct_rejected"]
    out = stats.select(
        *PERIOD_COLUMNS,
        F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]),
                                    F.array(*[F.col(m) for m in metrics]))).alias("metric", "value"),
    )
    for key in ["silver_clean", "silver_rejected", *GOLD_SCHEMAS]:
        counted = (
            warehouse.read(key, periods)
            .groupBy(*PERIOD_COLUMNS)
            .agg(F.count(F.lit(1)).cast("double").alias("value"))
            .select(*PERIOD_COLUMNS, F.lit(f"{key}_rows").alias("metric"), "value")
        )
        out = out.unionByName(counted)
    return out


def run(
    spark: SparkSession,
    periods: list[tuple[int, int]],
    raw_root: str,
    warehouse_root: str,
    work_root: str,
    layout: str = FLAT_LAYOUT,
    min_file_bytes: int = MIN_RAW_FILE_BYTES,
    load_bronze: bool = False,
    first_year: int = FIRST_YEAR,
) -> RunResult:
    """The whole run over raw monthly files for the given periods: period
    arguments checked (S4), raw files checked (S3), then scanned (S1)."""
    periods = resolve_periods(periods, first_year=first_year)
    inventory = file_inventory(spark, raw_root, periods, min_file_bytes, layout)
    require_valid_files(inventory)
    raw = read_raw_trips(spark, [raw_file_path(raw_root, y, m, layout) for y, m in periods])
    return run_frame(spark, raw, periods, warehouse_root, work_root, load_bronze=load_bronze)


def run_frame(
    spark: SparkSession,
    raw: DataFrame,
    periods: list[tuple[int, int]],
    warehouse_root: str,
    work_root: str,
    prefix: str = "",
    rebalance: bool = False,
    load_bronze: bool = False,
) -> RunResult:
    """The run over an already scanned raw frame (RAW_SCHEMA + lineage columns).

    ``rebalance`` is for inputs whose tasks mix months (see write_staging).
    """
    started = dt.datetime.now(dt.timezone.utc)  # the audit time of all tables
    warehouse = Warehouse(spark, warehouse_root, prefix)
    warehouse.create_tables()
    staging_root = f"{work_root.rstrip('/')}/staging-{uuid.uuid4().hex[:12]}"
    flagged = flag_trips(clean_trips(raw)).filter(in_periods(periods))
    # Silver constraints are observed on the staging write, so a row that the
    # warehouse would not take stops the run before a period is replaced.
    names, checks = _staging_checks()
    # Rows per month and validity are counted on that write, too.
    observed, seen = observe_checks(flagged, "staging_checks", [(str(i), c, e) for i, (_, c, e) in enumerate(checks)])
    counting = Observation("staging_counts")
    write_staging(observed.observe(counting, *staging_counts_exprs(periods)), staging_root, rebalance=rebalance)
    violations = dict(zip(names, seen().values(), strict=True))
    require_none(violations)
    staged = staged_counts_seen(counting.get, periods)
    loads, gold_violations = prepare_silver_and_gold(
        spark, staging_root, warehouse, periods, staging_schema(flagged), staged, started
    )
    violations.update(gold_violations)
    if load_bronze:
        loads.append(warehouse.prepare("bronze", bronze_layout(raw), periods, rebalance, loaded_at=started))
    # Everything is written and checked: all tables change over together.
    warehouse.switch(loads, started)
    loaded = {load.key: load.rows for load in loads}
    summary_loads = {k: v for k, v in loaded.items() if k != "bronze"}
    # A7 from the rejected staging partitions: only the reason column is read.
    reasons = rejection_reasons(
        read_staging(spark, staging_root, periods, valid=False, schema=staging_schema(flagged))
    )
    return RunResult(
        observed_summary(spark, staged, summary_loads), loaded, staging_root, violations, reasons
    )
