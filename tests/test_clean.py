import datetime as dt
import math

from conftest import trip
from tripyard.operators import clean as C


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_normalize_renames_and_keeps_lineage(raw_frame):
    df = C.normalize_columns(raw_frame(trip()))
    assert df.columns[:3] == ["vendor_id", "pickup_datetime", "dropoff_datetime"]
    assert "airport_fee" in df.columns and "rate_code_id" in df.columns
    assert df.columns[-3:] == ["source_file", "reference_year", "reference_month"]


def test_codes_truncate_toward_zero(raw_frame):
    r = one(C.cast_types(C.normalize_columns(raw_frame(trip(passenger_count=8.9, RatecodeID=0.5)))))
    assert r.passenger_count == 8
    assert r.rate_code_id == 0


def test_unrepresentable_codes_become_minus_one(raw_frame):
    df = raw_frame(trip(passenger_count=70000.0, PULocationID=65537, RatecodeID=float("nan")))
    r = one(C.treat_nulls(C.cast_types(C.normalize_columns(df))))
    assert r.passenger_count == -1
    assert r.pu_location_id == -1  # would wrap to 1 (a valid zone) without the guard
    assert r.rate_code_id == -1  # not replaced by the default 1


def test_round_half_up_on_decimal_text(raw_frame):
    r = one(C.cast_types(C.normalize_columns(raw_frame(trip(fare_amount=1.005, trip_distance=0.004)))))
    assert r.fare_amount == 1.01
    assert r.trip_distance == 0.0


def test_null_defaults_and_nan(raw_frame):
    df = raw_frame(trip(VendorID=None, RatecodeID=None, payment_type=None, store_and_fwd_flag=None,
                        tip_amount=float("nan"), extra=None, Airport_fee=None, total_amount=None,
                        fare_amount=float("nan")))
    r = one(C.treat_nulls(C.cast_types(C.normalize_columns(df))))
    assert (r.vendor_id, r.rate_code_id, r.payment_type, r.store_and_fwd_flag) == (0, 1, 5, "N")
    assert (r.tip_amount, r.extra, r.airport_fee) == (0.0, 0.0, 0.0)
    assert r.total_amount is None  # never filled
    assert math.isnan(r.fare_amount)  # never filled


def test_duration_uses_whole_seconds(raw_frame):
    p = dt.datetime(2024, 1, 15, 10, 0, 0, 900000)
    d = dt.datetime(2024, 1, 15, 10, 0, 2, 100000)
    r = one(C.clean_trips(raw_frame(trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=d))))
    assert r.trip_duration_minutes == round(2 / 60, 2)


def test_speed_from_rounded_inputs_and_null_when_not_positive(raw_frame):
    p = dt.datetime(2024, 1, 15, 10, 0, 0)
    rows = [
        trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=30), trip_distance=10.004),
        trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(microseconds=500000)),
        trip(trip_distance=0.0),
    ]
    got = [r.trip_speed_mph for r in C.clean_trips(raw_frame(*rows)).collect()]
    assert got[0] == 20.0  # 10.00 / 0.5 h
    assert got[1] is None  # sub-second trip: duration 0
    assert got[2] is None


def test_lineage_from_path(spark):
    df = spark.createDataFrame([("/x/yellow_tripdata_2023-12.parquet/part-0.parquet",)], "source_path string")
    r = one(C.add_lineage(df.withColumn("source_file", df.source_path)))
    assert (r.reference_year, r.reference_month, r.source_file) == (2023, 12, "yellow_tripdata_2023-12.parquet")


def test_clean_column_order(raw_frame):
    from tripyard.schema import CLEAN_COLUMNS

    assert C.clean_trips(raw_frame(trip())).columns == CLEAN_COLUMNS
