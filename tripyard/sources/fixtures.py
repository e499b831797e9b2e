"""Raw trips derived from the test tables (events, lineitem).

The test data has no taxi trips, so each row of a test table is mapped to one
raw trip with deliberate defects at fixed key residues (nulls, out-of-period
pickups, zero distances, bad zones, negative fares ...). The mapping reads
the scanned table once: no shuffle, and the work grows with the table. ``events`` gives one reference month (2024-01); ``lineitem`` gives a
month per ship date (83 months in one plan).

Output: the 19 raw columns (RAW_SCHEMA) plus the lineage columns
(source_file, reference_year, reference_month): the monthly raw file the row
stands for and its period.

The mapping is made by one-row generators. Catalyst does not copy generator
expressions into the filters and projections above, so what a query measures
is the engine's own plan over 22 plain columns, as over scanned files, and not
the mapping repeated inside every rule. A few columns a generator keep each
generated method small enough to be compiled. The period comes from the first
generator, so that a filter on it spares the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripyard.functions.periods import raw_file_name
from tripyard.schema import RAW_SCHEMA

SOURCES = ("events", "lineitem")
COLUMNS_A_GENERATOR = 4


def _base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        F.col("event_id").alias("k"),
        F.col("user_id").alias("u"),
        F.col("ts"),
        F.col("value").alias("v"),
        F.lit(2024).alias("ry"),
        F.lit(1).alias("rm"),
    )


def _base_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    offset = (F.col("l_orderkey") * 61 + F.col("l_partkey") * 7) % 86400
    return li.select(
        k.alias("k"),
        F.col("l_partkey").alias("u"),
        (F.col("l_shipdate") + _seconds(offset)).alias("ts"),
        (F.col("l_quantity") + F.col("l_discount")).alias("v"),
        F.year("l_shipdate").alias("ry"),
        F.month("l_shipdate").alias("rm"),
    )


def _seconds(n: Column) -> Column:
    return n * F.expr("INTERVAL '1' SECOND")


def _days(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' DAY")


def _dbl(x) -> Column:
    return F.lit(float(x))


def _raw_from_base(base: DataFrame) -> DataFrame:
    k, u, ts, v = F.col("k"), F.col("u"), F.col("ts"), F.col("v")

    def every(n):
        return k % n == 0

    null = F.lit(None)
    tip = (k * 7 % 1000).cast("double") / 100
    cols = {
        "VendorID": F.when(every(53), null).otherwise(1 + k % 2),
        "tpep_pickup_datetime": F.when(every(101), null)
        .when(every(97), ts - _days(40))
        .when(every(103), ts + _days(31))
        .otherwise(ts),
        "tpep_dropoff_datetime": F.when(every(107), null)
        .when(every(89), ts)
        .when(every(103), ts + _days(32))
        .otherwise(ts + _seconds(61 + (u * 37 + k * 13) % 5400)),
        "passenger_count": F.when(every(59), null)
        .when(every(61), _dbl(0))
        .when(every(67), _dbl(9))
        .otherwise((1 + k % 6).cast("double")),
        "trip_distance": F.when(every(71), _dbl(0))
        .when(every(73), _dbl(501))
        .when(every(139), null)
        .otherwise(((u * 7 + k * 31) % 2400 * 10 + 17).cast("double") / 1000),
        "RatecodeID": F.when(every(79), _dbl(99))
        .when(every(47), null)
        .otherwise((1 + k % 6).cast("double")),
        "store_and_fwd_flag": F.when(every(43), null).when(every(5), "Y").otherwise("N"),
        "PULocationID": F.when(every(83), F.lit(264)).otherwise(1 + (u * 11 + k) % 263),
        "DOLocationID": F.when(every(109), F.lit(0)).otherwise(1 + (u * 17 + k * 3) % 263),
        "payment_type": F.when(every(41), null)
        .when(every(113), _dbl(0))
        .otherwise((1 + k % 6).cast("double")),
        "fare_amount": F.when(every(127), _dbl(-1)).when(every(131), null).otherwise(v),
        "extra": F.when(every(31), null).otherwise((k % 5).cast("double") / 2),
        "mta_tax": F.when(every(29), null).otherwise(_dbl(0.5)),
        "tip_amount": F.when(every(137), _dbl(-0.5)).when(every(37), null).otherwise(tip),
        "tolls_amount": F.when(every(19), _dbl(6.94)).otherwise(_dbl(0)),
        "improvement_surcharge": F.when(every(29), null).otherwise(_dbl(1)),
        "total_amount": F.when(every(149), null).otherwise(v + tip + 3),
        "congestion_surcharge": F.when(every(29), null).otherwise(_dbl(1)),
        "Airport_fee": F.when(every(23), _dbl(1.75)).otherwise(null),
    }
    lineage = {
        "source_file": raw_file_name(F.col("ry"), F.col("rm")),
        "reference_year": F.col("ry").cast("smallint"),
        "reference_month": F.col("rm").cast("smallint"),
    }
    mapped = [c.alias(name) for name, c in lineage.items()]
    mapped += [cols[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA]
    out = base
    for i in range(0, len(mapped), COLUMNS_A_GENERATOR):
        out = out.select("*", F.inline(F.array(F.struct(*mapped[i:i + COLUMNS_A_GENERATOR]))))
    return out.select(*RAW_SCHEMA.names, *lineage)


def fixture_raw_trips(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    """Raw trips (RAW_SCHEMA + lineage columns) mapped from a test table."""
    if source == "events":
        base = _base_events(spark, sf_dir)
    elif source == "lineitem":
        base = _base_lineitem(spark, sf_dir)
    else:
        raise ValueError(f"unknown fixture source {source!r}; expected one of {SOURCES}")
    return _raw_from_base(base)


def fixture_periods(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> list[tuple[int, int]]:
    """The reference months a fixture covers (at most a few hundred pairs)."""
    if source == "events":
        return [(2024, 1)]
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = li.select(F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")).distinct().collect()
    return sorted((r.y, r.m) for r in rows)
