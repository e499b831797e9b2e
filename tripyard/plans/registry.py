"""Registered queries: one per operator of the inventory, over whole tables.

Each query maps a test table to raw trips (``lineitem``: 83 months in one
plan; ``events``: one month), runs the engine's stages up to the operator and
returns its result. Keys without a suffix use ``lineitem``; keys ending in
``_events`` use ``events``.

For comparison with the SQL oracle, fixed-point columns are returned as DOUBLE
(the nearest double to the decimal, identical in both engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

from tripyard.operators import clean as C
from tripyard.operators import gold as G
from tripyard.operators import quality as Q
from tripyard.operators import stats as S
from tripyard.operators import validate as V
from tripyard.plans import oracle as O
from tripyard.plans.writes import WRITE_QUERIES
from tripyard.schema import LINEAGE_COLUMNS, TABLE_SCHEMAS
from tripyard.sources.fixtures import fixture_raw_trips
from tripyard.sources.raw_files import period_calendar

Query = Callable[[SparkSession, str], DataFrame]


def decimals_as_double(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _flagged(raw: DataFrame) -> DataFrame:
    return V.flag_trips(C.clean_trips(raw))


def _silver(raw: DataFrame) -> DataFrame:
    return V.silver_layout(V.valid_trips(_flagged(raw)))


def _broken(key: str, rows: DataFrame) -> DataFrame:
    """Rows of a table, and copies of some that break its constraints: of
    January with every NOT NULL column null, of February with every NUMERIC at
    1e13, of March as they are (twice), of April with 300 letters behind every
    text, of May with the hour 24."""
    schema = TABLE_SCHEMAS[key]
    plain = rows.select(*[
        (F.col(f.name).cast("double") if isinstance(f.dataType, DecimalType) else F.col(f.name)).alias(f.name) for f in schema])
    required = {f.name: F.lit(None).cast(plain.schema[f.name].dataType) for f in schema if not f.nullable}
    numerics = {f.name: F.lit(1e13) for f in schema if isinstance(f.dataType, DecimalType)}
    texts = {f.name: F.concat(f.name, F.repeat(F.lit("x"), 300)) for f in schema if isinstance(f.dataType, StringType)}
    hours = {"hour_of_day": F.lit(24).cast("smallint")} if key == "hourly_demand" else {}

    def row(changed: dict):
        return F.struct(*[changed.get(n, F.col(n)).alias(n) for n in plain.columns])

    months = {3: {}, **{n: c for n, c in ((1, required), (2, numerics), (4, texts), (5, hours)) if c}}
    both = F.array(row({}))
    for number, changed in months.items():
        both = F.when(F.col("reference_month") == number, F.array(row({}), row(changed))).otherwise(both)
    return plain.select(F.inline(both))


def _constraints(raw: DataFrame) -> DataFrame:
    """C1-C5 over the rows of all eight tables with broken ones among them."""
    flagged = _flagged(raw)
    valid, rejected = V.split_valid_rejected(flagged)
    gold = G.wide_gold_tables(G.gold_partials(V.silver_layout(valid)).checkpoint(eager=True))
    tables = {"bronze": C.bronze_layout(raw), "silver_clean": valid, "silver_rejected": V.rejected_layout(rejected), **gold}
    return Q.constraint_violations({key: _broken(key, rows) for key, rows in tables.items()})


def _all_rules(raw: DataFrame) -> DataFrame:
    """Every trip with all rules it breaks, as bits and as text."""
    flagged = V.flag_all_rules(C.clean_trips(raw))
    return flagged.withColumn("reasons", F.concat_ws(", ", V.reasons_of(F.col("broken_rules"))))


def _with_path(raw: DataFrame) -> DataFrame:
    """Raw trips that know only the path of their file (P6 parses it)."""
    path = F.concat(F.lit("store://landing/"), F.col("source_file"), F.lit("/part-00000.parquet"))
    return raw.withColumn("source_path", path).drop(*LINEAGE_COLUMNS)


# stage name -> function of the raw fixture frame
STAGES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "raw_trips": lambda raw: raw,
    "bronze_trips": C.bronze_layout,
    "normalized_trips": C.normalize_columns,
    "typed_trips": lambda raw: C.cast_types(C.normalize_columns(raw)),
    "filled_trips": lambda raw: C.treat_nulls(C.cast_types(C.normalize_columns(raw))),
    "derived_trips": lambda raw: C.derive_fields(
        C.treat_nulls(C.cast_types(C.normalize_columns(raw)))
    ),
    "tagged_trips": lambda raw: C.add_lineage(
        C.derive_fields(C.treat_nulls(C.cast_types(C.normalize_columns(_with_path(raw)))))
    ),
    "clean_trips": C.clean_trips,
    "flagged_trips": _flagged,
    "broken_rules_per_trip": _all_rules,
    "valid_trips": lambda raw: V.valid_trips(_flagged(raw)),
    "rejected_trips": lambda raw: V.rejected_trips(_flagged(raw)),
    "silver_clean": _silver,
    "silver_rejected": lambda raw: V.rejected_layout(V.rejected_trips(_flagged(raw))),
    "validation_stats": lambda raw: S.validation_stats(_flagged(raw)),
    "rejection_reasons": lambda raw: S.rejection_reasons(_flagged(raw)),
    "trips_by_day": lambda raw: G.trips_by_day(_silver(raw)),
    "trips_by_zone": lambda raw: G.trips_by_zone(_silver(raw)),
    "payment_summary": lambda raw: G.payment_summary(_silver(raw)),
    "hourly_demand": lambda raw: G.hourly_demand(_silver(raw)),
    "zone_avg_fare": lambda raw: G.zone_avg_fare(_silver(raw)),
    "top_zones": lambda raw: G.top_zones(_silver(raw), 10),
    "constraint_violations": _constraints,
    "documented_checks": Q.documented_checks,
    "period_calendar": lambda raw: period_calendar(raw, 1993, 2024),
}

SOURCES = {"": "lineitem", "_events": "events"}


def _stage_query(stage: str, source: str) -> Query:
    fn = STAGES[stage]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_as_double(fn(fixture_raw_trips(spark, sf_dir, source)))

    run.__name__ = f"{stage}_{source}"
    return run


def _write_query(name: str, source: str) -> Query:
    fn = WRITE_QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_as_double(fn(spark, sf_dir, source))

    run.__name__ = f"{name}_{source}"
    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for suffix, source in SOURCES.items():
        for stage in STAGES:
            out[stage + suffix] = _stage_query(stage, source)
    for name in WRITE_QUERIES:
        out[name] = _write_query(name, "lineitem")
    out["load_counts_events"] = _write_query("load_counts", "events")
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for suffix, source in SOURCES.items():
        for stage in STAGES:
            out[stage + suffix] = O.stage_sql(stage, source)
    for name in WRITE_QUERIES:
        sql = O.write_sql(name, "lineitem")
        if sql is not None:
            out[name] = sql
    out["load_counts_events"] = O.write_sql("load_counts", "events")
    return out
