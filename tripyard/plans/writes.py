"""Registered queries that write and read back (sources and sinks).

Each writes into a fresh folder under the session's shared checkpoint
directory, then returns the read-back result as a DataFrame.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripyard.functions.periods import file_name_from_path
from tripyard.operators.clean import bronze_layout, clean_trips
from tripyard.operators.quality import ConstraintViolation, stored_violations, table_name
from tripyard.operators.validate import flag_trips, silver_layout, valid_trips
from tripyard.plans.job import RunResult, run_frame
from tripyard.schema import GOLD_SCHEMAS, PERIOD_COLUMNS, TABLE_SCHEMAS
from tripyard.session import scratch_dir
from tripyard.sinks.warehouse import Warehouse, in_periods, read_staging, staging_schema, write_staging
from tripyard.sources.fixtures import fixture_periods, fixture_raw_trips
from tripyard.sources.raw_files import (
    SPARK_LAYOUT,
    file_inventory,
    land_raw_files,
    listed_files,
    raw_file_path,
    read_raw_trips,
)


def staging_roundtrip(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """Flagged trips written once, partitioned by period and validity,
    and read back with partition pruning."""
    flagged = flag_trips(clean_trips(fixture_raw_trips(spark, sf_dir, source)))
    root = scratch_dir(spark, "staging")
    write_staging(flagged, root, rebalance=True)
    back = read_staging(spark, root)
    return back.select(*flagged.columns)


def _read_and_drop(wh: Warehouse, key: str) -> DataFrame:
    """A loaded table by its files, the catalog entries of this query dropped."""
    out = wh.files(key).select(*[f.name for f in TABLE_SCHEMAS[key]])
    wh.drop_tables()
    return out


def _silver_from_staging(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    flagged = flag_trips(clean_trips(fixture_raw_trips(spark, sf_dir, source)))
    root = scratch_dir(spark, "staging")
    write_staging(flagged, root, rebalance=True)
    return silver_layout(read_staging(spark, root, valid=True, schema=staging_schema(flagged)))


def period_replace(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """Silver clean loaded, then reloaded for the same periods;
    the table must hold each trip once."""
    periods = fixture_periods(spark, sf_dir, source)
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"), prefix=_prefix("pr"))
    wh.create_tables()
    silver = _silver_from_staging(spark, sf_dir, source)
    wh.replace_periods("silver_clean", silver, periods)
    wh.replace_periods("silver_clean", silver, periods)
    return _read_and_drop(wh, "silver_clean")


def empty_reload(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """All periods loaded, then reloaded with rows for the odd months
    only; the even months must be empty."""
    periods = fixture_periods(spark, sf_dir, source)
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"), prefix=_prefix("er"))
    wh.create_tables()
    silver = _silver_from_staging(spark, sf_dir, source)
    wh.replace_periods("silver_clean", silver, periods)
    wh.replace_periods("silver_clean", silver.where("reference_month % 2 = 1"), periods)
    return _read_and_drop(wh, "silver_clean")


def bronze_table(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """S15 raw.yellow_taxi: raw trips loaded with lineage (period replace),
    read back without the load time."""
    raw = fixture_raw_trips(spark, sf_dir, source)
    periods = fixture_periods(spark, sf_dir, source)
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"), prefix=_prefix("bz"))
    wh.create_tables()
    wh.replace_periods("bronze", bronze_layout(raw), periods, rebalance=True)
    return _read_and_drop(wh, "bronze")


def _loaded_run(spark: SparkSession, sf_dir: str, source: str) -> tuple[RunResult, Warehouse]:
    raw = fixture_raw_trips(spark, sf_dir, source)
    periods = fixture_periods(spark, sf_dir, source)
    work = scratch_dir(spark, "run")
    wh = Warehouse(spark, f"{work}/warehouse", _prefix("run"))
    return run_frame(spark, raw, periods, wh.root, f"{work}/work", prefix=wh.prefix, rebalance=True), wh


def load_counts(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """The whole run; its summary (period, metric, value)."""
    result, wh = _loaded_run(spark, sf_dir, source)
    wh.drop_tables()
    return result.summary


def _loaded_table(key: str):
    """The whole run, then one of its loaded tables."""

    def query(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
        return _read_and_drop(_loaded_run(spark, sf_dir, source)[1], key)

    return query


def failed_reload(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """S9, S11-S13 all or nothing: the whole run, then a run over the same
    months whose first month has a day with more revenue than its gold column
    takes. The run fails after silver is written; every table must hold the
    rows of the first run: (period, metric, value)."""
    result, wh = _loaded_run(spark, sf_dir, source)
    raw = fixture_raw_trips(spark, sf_dir, source)
    periods = fixture_periods(spark, sf_dir, source)
    start = F.make_timestamp_ntz("reference_year", "reference_month", F.lit(1), F.lit(8), F.lit(0), F.lit(0))
    usual = {"passenger_count": 1, "trip_distance": 1, "RatecodeID": 1, "PULocationID": 1, "DOLocationID": 1, "fare_amount": 1, "tip_amount": 0}
    trip = raw.where((F.col("reference_year") == periods[0][0]) & (F.col("reference_month") == periods[0][1])).limit(1).withColumns({
        **{c: F.lit(v).cast(raw.schema[c].dataType) for c, v in usual.items()}, "total_amount": F.lit(9e7),
        "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + F.expr("INTERVAL 10 MINUTES")})
    many = trip.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(12_000)))).drop("copy")
    try:
        run_frame(spark, raw.unionByName(many), periods, wh.root, scratch_dir(spark, "failed"), prefix=wh.prefix, rebalance=True)
    except ConstraintViolation:
        pass
    else:
        raise AssertionError("a total beyond its column was loaded")
    counts = [
        wh.files(key).groupBy(*PERIOD_COLUMNS).agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(*PERIOD_COLUMNS, F.lit(f"{key}_rows").alias("metric"), "value")
        for key in ("silver_clean", "silver_rejected", *GOLD_SCHEMAS)
    ]
    wh.drop_tables()
    return reduce(DataFrame.unionByName, counts)


def audit_times(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """The whole run, then a run of the odd months. For each table and
    period: whether every row has its load time, whether that is the time of
    the period's other tables, and whether it is later than the first run's."""
    _, wh = _loaded_run(spark, sf_dir, source)
    raw = fixture_raw_trips(spark, sf_dir, source).where("reference_month % 2 = 1")
    odd = [p for p in fixture_periods(spark, sf_dir, source) if p[1] % 2]
    run_frame(spark, raw, odd, wh.root, scratch_dir(spark, "again"), prefix=wh.prefix, rebalance=True)
    found = reduce(DataFrame.unionByName, [
        wh.files(key).groupBy(*PERIOD_COLUMNS).agg(
            (F.count("loaded_at") == F.count(F.lit(1))).alias("filled"), F.min("loaded_at").alias("first"), F.max("loaded_at").alias("last"))
        .withColumn("table_name", F.lit(table_name(key)))
        for key in ("silver_clean", "silver_rejected", *GOLD_SCHEMAS)
    ]).checkpoint(eager=True)  # periods x tables
    wh.drop_tables()
    own = found.where(F.col("table_name") == table_name("silver_clean")).select(*PERIOD_COLUMNS, F.col("first").alias("stamp"))
    start = found.agg(F.min("first").alias("start"))  # one row
    return found.join(own, PERIOD_COLUMNS).join(F.broadcast(start)).select(
        "table_name", *PERIOD_COLUMNS, "filled",
        ((F.col("first") == F.col("stamp")) & (F.col("last") == F.col("stamp"))).alias("same_run"),
        (F.col("first") > F.col("start")).alias("reloaded"))


def stored_checks(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """C1-C5 on stored tables: the whole run, then March's rows of the gold
    tables appended once more beside the loader; the checks of all loaded
    tables over March."""
    _, wh = _loaded_run(spark, sf_dir, source)
    march = [p for p in fixture_periods(spark, sf_dir, source) if p[1] == 3]
    for key in GOLD_SCHEMAS:
        stored = spark.table(wh.table(key)).where(in_periods(march))
        stored.checkpoint(eager=True).write.insertInto(wh.table(key))
    found = stored_violations(wh, march, ["silver_clean", "silver_rejected", *GOLD_SCHEMAS]).checkpoint(eager=True)
    wh.drop_tables()
    return found


def raw_file_scan(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """Raw trips landed as monthly files, scanned back for all months.
    Each month has two groups of parts with different footers: the files of
    the second have the passenger count as a whole number."""
    root = scratch_dir(spark, "landing")
    raw = fixture_raw_trips(spark, sf_dir, source)
    whole = F.pmod(F.hash("tpep_pickup_datetime", "fare_amount"), F.lit(2)) == 1
    land_raw_files(raw.where(~whole), root)
    land_raw_files(raw.where(whole).withColumn("passenger_count", F.col("passenger_count").cast("long")), root, mode="append")
    paths = [raw_file_path(root, y, m, SPARK_LAYOUT) for y, m in fixture_periods(spark, sf_dir, source)]
    return read_raw_trips(spark, paths)


def valid_trips_scan(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """The valid trips of all months but the Junes, straight from the
    landed files: one scan of several months, whose literal month bounds reach
    the Parquet reader."""
    root = scratch_dir(spark, "landing")
    land_raw_files(fixture_raw_trips(spark, sf_dir, source), root)
    periods = [p for p in fixture_periods(spark, sf_dir, source) if p[1] != 6]
    raw = read_raw_trips(spark, [raw_file_path(root, y, m, SPARK_LAYOUT) for y, m in periods])
    return valid_trips(flag_trips(clean_trips(raw)), periods)


def raw_file_inventory(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """S3: the file check. Of the months, every third is not landed and every
    third has one trip only; the threshold is the largest of the latter."""
    root = scratch_dir(spark, "landing")
    raw = fixture_raw_trips(spark, sf_dir, source)
    periods = fixture_periods(spark, sf_dir, source)
    kind = F.col("reference_month") % 3
    land_raw_files(raw.where(kind == 2), root)
    land_raw_files(raw.where(kind == 1).dropDuplicates(["source_file"]), root, mode="append")
    small = {(y, m): raw_file_path(root, y, m, SPARK_LAYOUT) for y, m in periods if m % 3 == 1}
    most = listed_files(spark, list(small.values())).agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]
    found = file_inventory(spark, root, periods, min_bytes=most, layout=SPARK_LAYOUT)
    return found.select(
        "reference_year", "reference_month", file_name_from_path(F.col("path")).alias("file_name"), "is_valid")


def _prefix(tag: str) -> str:
    return f"ty_{tag}_{uuid.uuid4().hex[:8]}_"


WRITE_QUERIES = {
    "staging_roundtrip": staging_roundtrip,
    "period_replace": period_replace,
    "bronze_table": bronze_table,
    "load_counts": load_counts,
    "raw_file_scan": raw_file_scan,
    "valid_trips_scan": valid_trips_scan,
    "file_inventory": raw_file_inventory,
    "empty_reload": empty_reload,
    "failed_reload": failed_reload,
    "audit_times": audit_times,
    "stored_checks": stored_checks,
    **{f"loaded_{key}": _loaded_table(key) for key in ("silver_rejected", *GOLD_SCHEMAS)},
}
