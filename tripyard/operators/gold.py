"""Gold aggregates A1-A5 (with P10 period keys and the P11 payment label) and
the documented top-zones report.

Gold reads the silver layout: measures are NUMERIC(10,2), so every sum is an
exact decimal sum (the same on any partitioning) and every mean is
``round(sum / count, 2)`` of that exact sum.

Each builder is one hash aggregate keyed by period + its own key. For loading
all five tables, :func:`gold_tables` computes the four distinct groupings in a
single scan with GROUPING SETS (zone tables share one grouping) and derives
the five tables from that small result, instead of one scan per table.
Partial aggregation runs map-side, so a hot key (one zone, one day, one
payment code holding a third of the rows) sends one partial row per task to
the final aggregate, never its raw rows.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tripyard.functions.numeric import money, rounded_mean, rounded_percent
from tripyard.functions.periods import days_in_month
from tripyard.schema import GOLD_KEYS, GOLD_SCHEMAS, PAYMENT_LABELS, PERCENT, PERIOD_COLUMNS

PERIOD = PERIOD_COLUMNS
# Holds every sum of NUMERIC(10,2) values a table can have.
WIDE = DecimalType(28, 2)

# Measures summed over decimals, with their non-null counts for the means.
_SUMMED = {
    "dist": "trip_distance",
    "fare": "fare_amount",
    "tip": "tip_amount",
    "revenue": "total_amount",
    "duration": "trip_duration_minutes",
}


def gold_input(silver: DataFrame) -> DataFrame:
    """The 12 columns gold needs from silver (column pruning reaches the scan)."""
    return silver.select(
        *PERIOD,
        F.to_date("pickup_datetime").alias("trip_date"),
        F.hour("pickup_datetime").cast("smallint").alias("hour_of_day"),
        "pu_location_id",
        "do_location_id",
        "payment_type",
        "passenger_count",
        *_SUMMED.values(),
    )


def _partials() -> list[Column]:
    out = [F.count(F.lit(1)).alias("n"), F.sum("passenger_count").alias("pax")]
    for short, col in _SUMMED.items():
        out += [F.sum(col).alias(f"{short}_sum"), F.count(col).alias(f"{short}_n")]
    return out


def _total(short: str) -> Column:
    """Wider than the table's column; _conform narrows it, the checks compare."""
    return F.col(f"{short}_sum")


def _mean(short: str) -> Column:
    return rounded_mean(F.col(f"{short}_sum"), F.col(f"{short}_n"), WIDE)


def _finish_day(p: DataFrame) -> DataFrame:
    return p.select(
        *PERIOD, "trip_date",
        F.col("n").alias("total_trips"),
        F.col("pax").alias("total_passengers"),
        _total("dist").alias("total_distance_miles"),
        _total("fare").alias("total_fare_amount"),
        _total("tip").alias("total_tip_amount"),
        _total("revenue").alias("total_revenue"),
        _mean("fare").alias("avg_fare_amount"),
        _mean("dist").alias("avg_trip_distance"),
        _mean("duration").alias("avg_trip_duration_min"),
    )


def _finish_zone(p: DataFrame) -> DataFrame:
    return p.select(
        *PERIOD, "pu_location_id",
        F.col("n").alias("total_trips"),
        _total("revenue").alias("total_revenue"),
        _mean("fare").alias("avg_fare_amount"),
        _mean("dist").alias("avg_trip_distance"),
        _mean("tip").alias("avg_tip_amount"),
    )


def payment_label(code: Column) -> Column:
    """Label of a payment code; null for codes outside the table."""
    labels = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in PAYMENT_LABELS.items()))
    return labels[code.cast("int")]


def _finish_payment(p: DataFrame) -> DataFrame:
    # The period total is a window over the few aggregated rows of the period,
    # not a second pass over the trips.
    period_trips = F.sum("n").over(Window.partitionBy(*PERIOD_COLUMNS))
    return p.select(
        *PERIOD, "payment_type",
        payment_label(F.col("payment_type")).alias("payment_type_desc"),
        F.col("n").alias("total_trips"),
        _total("revenue").alias("total_revenue"),
        _total("tip").alias("total_tip_amount"),
        _mean("tip").alias("avg_tip_amount"),
        rounded_percent(F.col("n"), period_trips, PERCENT).alias("pct_of_total_trips"),
    )


def _finish_hour(p: DataFrame) -> DataFrame:
    days = days_in_month(F.col("reference_year"), F.col("reference_month"))
    return p.select(
        *PERIOD, "hour_of_day",
        F.col("n").alias("total_trips"),
        # mean over the calendar days of the month, not the days with trips
        money(F.round(F.col("n") / days, 2), WIDE).alias("avg_trips_per_day"),
        _total("revenue").alias("total_revenue"),
        _mean("fare").alias("avg_fare_amount"),
    )


def _finish_zone_fare(p: DataFrame) -> DataFrame:
    return p.select(
        *PERIOD, "pu_location_id",
        F.col("n").alias("total_trips"),
        _mean("fare").alias("avg_fare_amount"),
        _mean("revenue").alias("avg_total_amount"),
        _mean("tip").alias("avg_tip_amount"),
        _mean("dist").alias("avg_trip_distance"),
        _mean("duration").alias("avg_duration_minutes"),
    )


_FINISH = {
    "trips_by_day": _finish_day,
    "trips_by_zone": _finish_zone,
    "payment_summary": _finish_payment,
    "hourly_demand": _finish_hour,
    "zone_avg_fare": _finish_zone_fare,
}


def conform(name: str, wide: DataFrame) -> DataFrame:
    """A gold table's column types. A total that does not fit its NUMERIC is
    null here; the run checks the wide rows before it replaces anything."""
    return wide.select(*[
        (money(F.col(f.name), f.dataType) if isinstance(f.dataType, DecimalType) else F.col(f.name).cast(f.dataType)).alias(f.name)
        for f in GOLD_SCHEMAS[name]
    ])


def gold_table(silver: DataFrame, name: str) -> DataFrame:
    """One gold table: a single hash aggregate on (period, key)."""
    inp = gold_input(silver)
    partial = inp.groupBy(*PERIOD_COLUMNS, *GOLD_KEYS[name]).agg(*_partials())
    return conform(name, _FINISH[name](partial))


def trips_by_day(silver: DataFrame) -> DataFrame:
    return gold_table(silver, "trips_by_day")


def trips_by_zone(silver: DataFrame) -> DataFrame:
    return gold_table(silver, "trips_by_zone")


def payment_summary(silver: DataFrame) -> DataFrame:
    return gold_table(silver, "payment_summary")


def hourly_demand(silver: DataFrame) -> DataFrame:
    return gold_table(silver, "hourly_demand")


def zone_avg_fare(silver: DataFrame) -> DataFrame:
    return gold_table(silver, "zone_avg_fare")


_SET_KEYS = ["trip_date", "pu_location_id", "payment_type", "hour_of_day"]


def _grouping_id(present: list[str]) -> int:
    """Spark's grouping_id for a set over PERIOD + _SET_KEYS (bit set = absent)."""
    cols = PERIOD_COLUMNS + _SET_KEYS
    return sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in present)


def gold_partials(silver: DataFrame) -> DataFrame:
    """All gold groupings in one scan: GROUPING SETS over the four keys.

    The result is small (per period: days + zones + payment codes + hours) and
    carries ``gid`` to tell the groupings apart.
    """
    inp = gold_input(silver)
    sets = [[*PERIOD_COLUMNS, key] for key in _SET_KEYS]
    return inp.groupingSets(sets, *PERIOD_COLUMNS, *_SET_KEYS).agg(
        *_partials(), F.grouping_id().alias("gid")
    )


def wide_gold_tables(partials: DataFrame) -> dict[str, DataFrame]:
    """The five gold tables from :func:`gold_partials` (materialise it first
    when several tables are written, so the trips are scanned once), sums and
    means in types that hold any of them."""
    out = {}
    for name, keys in GOLD_KEYS.items():
        part = partials.filter(F.col("gid") == _grouping_id(PERIOD_COLUMNS + keys))
        out[name] = _FINISH[name](part)
    return out


def gold_tables(partials: DataFrame) -> dict[str, DataFrame]:
    """The five gold tables in their column types."""
    return {name: conform(name, wide) for name, wide in wide_gold_tables(partials).items()}


def gold_row_counts(partials: DataFrame, periods: list[tuple[int, int]]) -> dict[str, dict]:
    """Rows per month of each gold table, from :func:`gold_partials` (one
    small job over the groupings; the zone tables share theirs)."""
    counted = {
        (r.reference_year, r.reference_month, r.gid): r.n
        for r in partials.groupBy(*PERIOD_COLUMNS, "gid").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    return {
        name: {(y, m): counted.get((y, m, _grouping_id(PERIOD_COLUMNS + keys)), 0) for y, m in periods}
        for name, keys in GOLD_KEYS.items()
    }


def top_zones(silver: DataFrame, k: int = 10) -> DataFrame:
    """Documented report: the k busiest pickup and dropoff zones per period.

    One scan with two grouping sets; the rank is a window over at most
    2 x 263 aggregated rows per period. Ties go to the lower zone id.
    """
    if k < 1:
        raise ValueError("k must be positive")
    inp = silver.select(*PERIOD, "pu_location_id", "do_location_id")
    counts = inp.groupingSets(
        [[*PERIOD_COLUMNS, "pu_location_id"], [*PERIOD_COLUMNS, "do_location_id"]],
        *PERIOD_COLUMNS, "pu_location_id", "do_location_id",
    ).agg(F.count(F.lit(1)).alias("total_trips"), F.grouping("pu_location_id").alias("g"))
    sides = counts.select(
        *PERIOD,
        F.when(F.col("g") == 0, F.lit("pickup")).otherwise(F.lit("dropoff")).alias("side"),
        F.when(F.col("g") == 0, F.col("pu_location_id"))
        .otherwise(F.col("do_location_id")).alias("location_id"),
        "total_trips",
    )
    rank = F.row_number().over(
        Window.partitionBy(*PERIOD_COLUMNS, "side").orderBy(F.desc("total_trips"), "location_id")
    )
    return sides.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        *PERIOD, "side", F.col("rank").cast("int"), "location_id", "total_trips"
    )
