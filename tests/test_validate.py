import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types

from conftest import trip
from tripyard.functions.numeric import money
from tripyard.operators import clean as C
from tripyard.operators import validate as V
from tripyard.operators.quality import check_conditions, observe_checks, table_checks
from tripyard.schema import SILVER_CLEAN_SCHEMA, SILVER_REJECTED_SCHEMA, TABLE_SCHEMAS

T = dt.datetime


def reasons(raw_frame, *rows):
    return [r.rejection_reason for r in V.flag_trips(C.clean_trips(raw_frame(*rows))).collect()]


def at(pickup, period=(2024, 1), minutes=10, **kw):
    return trip(tpep_pickup_datetime=pickup, tpep_dropoff_datetime=pickup + dt.timedelta(minutes=minutes),
                period=period, **kw)


def test_valid_trip_has_no_reason(raw_frame):
    assert reasons(raw_frame, trip()) == [None]


def test_period_bounds_half_open(raw_frame):
    got = reasons(
        raw_frame,
        at(T(2024, 1, 1, 0, 0, 0)),
        at(T(2024, 1, 31, 23, 59, 59, 999999)),
        at(T(2024, 2, 1, 0, 0, 0)),
        at(T(2023, 12, 31, 23, 59, 59, 999999)),
    )
    assert got == [None, None, "pickup_datetime out of reference period",
                   "pickup_datetime out of reference period"]


def test_december_and_leap_february(raw_frame):
    got = reasons(
        raw_frame,
        at(T(2023, 12, 31, 23, 0), period=(2023, 12)),
        at(T(2024, 1, 1, 0, 0), period=(2023, 12)),
        at(T(2024, 2, 29, 12, 0), period=(2024, 2)),
    )
    assert got == [None, "pickup_datetime out of reference period", None]


def test_missing_period_is_out_of_period(raw_frame):
    assert reasons(raw_frame, trip(reference_year=None)) == ["pickup_datetime out of reference period"]


@pytest.mark.parametrize(
    "field,value,expected",
    [
        ("tpep_pickup_datetime", None, "pickup_datetime is null"),
        ("tpep_dropoff_datetime", None, "dropoff_datetime is null"),
        ("tpep_dropoff_datetime", T(2024, 1, 15, 10, 0, 0), "dropoff_datetime <= pickup_datetime"),
        ("passenger_count", None, "invalid passenger_count"),
        ("passenger_count", 0.0, "invalid passenger_count"),
        ("passenger_count", 0.9, "invalid passenger_count"),
        ("passenger_count", 8.0, None),
        ("passenger_count", 8.9, None),
        ("passenger_count", 9.0, "invalid passenger_count"),
        ("trip_distance", 0.0, "invalid trip_distance"),
        ("trip_distance", 0.004, "invalid trip_distance"),
        ("trip_distance", 500.0, None),
        ("trip_distance", 500.004, None),
        ("trip_distance", 500.01, "invalid trip_distance"),
        ("trip_distance", float("nan"), "invalid trip_distance"),
        ("PULocationID", 0, "invalid pu_location_id"),
        ("PULocationID", 1, None),
        ("PULocationID", 263, None),
        ("PULocationID", 264, "invalid pu_location_id"),
        ("DOLocationID", None, "invalid do_location_id"),
        ("DOLocationID", 264, "invalid do_location_id"),
        ("fare_amount", 0.0, None),
        ("fare_amount", -0.004, None),
        ("fare_amount", -0.01, "invalid fare_amount"),
        ("fare_amount", None, "invalid fare_amount"),
        ("fare_amount", float("nan"), "invalid fare_amount"),
        ("tip_amount", None, None),
        ("tip_amount", -0.01, "negative tip_amount"),
        ("RatecodeID", None, None),
        ("RatecodeID", 0.0, "invalid rate_code_id"),
        ("RatecodeID", 1.0, None),
        ("RatecodeID", 6.0, None),
        ("RatecodeID", 7.0, "invalid rate_code_id"),
        ("RatecodeID", 99.0, "invalid rate_code_id"),
    ],
)
def test_rule_boundaries(raw_frame, field, value, expected):
    assert reasons(raw_frame, trip(**{field: value})) == [expected]


def test_first_broken_rule_wins(raw_frame):
    row = trip(passenger_count=0.0, trip_distance=0.0, tip_amount=-1.0)
    assert reasons(raw_frame, row) == ["invalid passenger_count"]


def test_split_and_layouts(raw_frame):
    flagged = V.flag_trips(C.clean_trips(raw_frame(trip(), trip(PULocationID=0), trip(fare_amount=12.345))))
    valid, rejected = V.split_valid_rejected(flagged)
    assert valid.count() == 2 and rejected.count() == 1
    assert "rejection_reason" not in valid.columns
    silver = V.silver_layout(valid)
    assert [f.name for f in silver.schema] == [f.name for f in SILVER_CLEAN_SCHEMA]
    assert [str(r.fare_amount) for r in silver.orderBy("fare_amount").collect()] == ["12.35", "15.00"]
    rej = V.rejected_layout(rejected)
    assert [(f.name, f.dataType) for f in rej.schema] == [(f.name, f.dataType) for f in SILVER_REJECTED_SCHEMA]
    r = rej.collect()[0]
    assert r.rejection_reason == "invalid pu_location_id" and r.raw_pu_location_id == 0


def test_all_broken_rules_are_kept_and_the_first_is_the_reason(raw_frame):
    rows = [trip(), trip(tip_amount=-1.0), trip(PULocationID=0, tip_amount=-1.0, RatecodeID=9.0),
            trip(tpep_pickup_datetime=None, tpep_dropoff_datetime=None, passenger_count=None, trip_distance=None,
                 PULocationID=None, DOLocationID=None, fare_amount=None, tip_amount=None, RatecodeID=None)]
    flagged = V.flag_all_rules(C.clean_trips(raw_frame(*rows)))
    got = flagged.select("broken_rules", "rejection_reason", V.reasons_of(flagged["broken_rules"]).alias("all")).collect()
    names = [reason for reason, _ in V.rules()]
    assert got[0]["broken_rules"] == 0 and got[0]["rejection_reason"] is None and got[0]["all"] == []
    assert got[1]["all"] == [names[9]]
    assert got[2]["all"] == [names[6], names[9], names[10]] and got[2]["rejection_reason"] == names[6]
    assert got[3]["all"] == [names[0], names[1], names[2], *names[4:9]] and got[3]["rejection_reason"] == names[0]


def test_observed_and_aggregated_checks_count_the_rows_that_are_not_stored(spark):
    """NUMERIC(10,2) around its bounds, as the cast to it decides."""
    nan, inf = float("nan"), float("inf")
    values = [None, 0.0, 99999998.99, 99999999.0, 99999999.99, 99999999.994, 99999999.995, 1e8, nan, inf,
              -99999999.0, -99999999.994, -99999999.995, -inf]
    schema = types.StructType([types.StructField(f.name, types.DoubleType() if isinstance(f.dataType, types.DecimalType) else f.dataType)
                           for f in TABLE_SCHEMAS["silver_clean"]])
    fixed = {"reference_year": 2024, "store_and_fwd_flag": "YN"}
    rows = spark.createDataFrame(
        [tuple(v if isinstance(f.dataType, types.DoubleType) else fixed.get(f.name) for f in schema) for v in values], schema)
    found = {(r.check_name, r.column_name): r.violations for r in table_checks("silver_clean", rows).collect()}
    observed, seen = observe_checks(rows, "bounds", check_conditions("silver_clean"))
    assert len(observed.collect()) == len(values)
    assert seen() == found
    stored = [r[0] for r in rows.select(money(F.col("fare_amount"))).collect()]
    lost = sum(s is None for s in stored)
    assert lost == 7
    assert found["not_null", "fare_amount"] == lost and found["numeric_10_2", "fare_amount"] == lost - 1
    assert found["not_null", "reference_month"] == len(values) and found["not_null", "reference_year"] == 0
    assert found["max_length", "store_and_fwd_flag"] == len(values) and found["max_length", "source_file"] == 0
