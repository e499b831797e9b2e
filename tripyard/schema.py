"""Layouts of every table the engine reads or writes, and the fixed rule values.

All trip timestamps are TIMESTAMP_NTZ: the month bounds, ``to_date`` and
``hour`` must not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# --- fixed values: these must equal the source system's for equal results ---
# Raw column names as published in the monthly trip files, in file order.
RAW_COLUMNS = [
    ("VendorID", IntegerType()),
    ("tpep_pickup_datetime", TimestampNTZType()),
    ("tpep_dropoff_datetime", TimestampNTZType()),
    ("passenger_count", DoubleType()),
    ("trip_distance", DoubleType()),
    ("RatecodeID", DoubleType()),
    ("store_and_fwd_flag", StringType()),
    ("PULocationID", IntegerType()),
    ("DOLocationID", IntegerType()),
    ("payment_type", DoubleType()),
    ("fare_amount", DoubleType()),
    ("extra", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("improvement_surcharge", DoubleType()),
    ("total_amount", DoubleType()),
    ("congestion_surcharge", DoubleType()),
    ("Airport_fee", DoubleType()),
]
# Snake-case renames; columns not listed keep their name.
RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "Airport_fee": "airport_fee",
}
# Code columns narrowed to SMALLINT.
SHORT_COLUMNS = [
    "vendor_id", "passenger_count", "rate_code_id",
    "pu_location_id", "do_location_id", "payment_type",
]
# Measures rounded to two decimals while cleaning.
ROUNDED_COLUMNS = ["fare_amount", "tip_amount", "total_amount", "trip_distance"]
# Null defaults applied after casting and rounding.
NULL_DEFAULTS = {
    "vendor_id": 0,
    "store_and_fwd_flag": "N",
    "rate_code_id": 1,
    "payment_type": 5,
    "extra": 0.0,
    "mta_tax": 0.0,
    "tip_amount": 0.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.0,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
}
# Rule limits.
LOCATION_ID_MIN = 1
LOCATION_ID_MAX = 263
RATE_CODE_MIN = 1
RATE_CODE_MAX = 6
MAX_PASSENGERS = 8
MAX_TRIP_DISTANCE = 500.0
# Rejection reasons, in rule order (first matching rule wins).
REASON_PICKUP_NULL = "pickup_datetime is null"
REASON_DROPOFF_NULL = "dropoff_datetime is null"
REASON_OUT_OF_PERIOD = "pickup_datetime out of reference period"
REASON_DROPOFF_BEFORE = "dropoff_datetime <= pickup_datetime"
REASON_PASSENGERS = "invalid passenger_count"
REASON_DISTANCE = "invalid trip_distance"
REASON_PU = "invalid pu_location_id"
REASON_DO = "invalid do_location_id"
REASON_FARE = "invalid fare_amount"
REASON_TIP = "negative tip_amount"
REASON_RATE = "invalid rate_code_id"
REASONS = [
    REASON_PICKUP_NULL, REASON_DROPOFF_NULL, REASON_OUT_OF_PERIOD,
    REASON_DROPOFF_BEFORE, REASON_PASSENGERS, REASON_DISTANCE, REASON_PU,
    REASON_DO, REASON_FARE, REASON_TIP, REASON_RATE,
]
# Payment code labels; any other code has no label.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
# Monthly raw file name and the smallest accepted raw file size.
RAW_FILE_NAME = "yellow_tripdata_{year}-{month:02d}.parquet"
RAW_FILE_PATTERN = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet"
MIN_RAW_FILE_BYTES = 10 * 1024 * 1024
FIRST_YEAR = 2019
# --- end of fixed values ---

# Stand-in for a code that is present but does not fit SMALLINT (or is NaN):
# it fails every range rule instead of wrapping or becoming a default.
UNREPRESENTABLE_CODE = -1

PERIOD_COLUMNS = ["reference_year", "reference_month"]
LINEAGE_COLUMNS = ["source_file", "reference_year", "reference_month"]

RAW_SCHEMA = StructType([StructField(n, t, True) for n, t in RAW_COLUMNS])

# Column order of the cleaned trips.
CLEAN_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "rate_code_id", "store_and_fwd_flag", "pu_location_id",
    "do_location_id", "payment_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "airport_fee", "trip_duration_minutes",
    "trip_speed_mph", "reference_year", "reference_month", "source_file",
]

# --- fixed values: warehouse table layouts (names, order, types, keys, limits) ---
MONEY = DecimalType(10, 2)   # NUMERIC(10,2)
TOTAL = DecimalType(14, 2)   # NUMERIC(14,2)
PERCENT = DecimalType(5, 2)  # NUMERIC(5,2)

# silver.yellow_taxi_clean, business columns in table order.
SILVER_CLEAN_SCHEMA = StructType([
    StructField("source_file", StringType()),
    StructField("reference_year", ShortType(), False),
    StructField("reference_month", ShortType(), False),
    StructField("vendor_id", ShortType()),
    StructField("pickup_datetime", TimestampNTZType(), False),
    StructField("dropoff_datetime", TimestampNTZType(), False),
    StructField("passenger_count", ShortType(), False),
    StructField("trip_distance", MONEY, False),
    StructField("rate_code_id", ShortType()),
    StructField("store_and_fwd_flag", StringType()),
    StructField("pu_location_id", ShortType(), False),
    StructField("do_location_id", ShortType(), False),
    StructField("payment_type", ShortType()),
    StructField("fare_amount", MONEY, False),
    StructField("extra", MONEY),
    StructField("mta_tax", MONEY),
    StructField("tip_amount", MONEY),
    StructField("tolls_amount", MONEY),
    StructField("improvement_surcharge", MONEY),
    StructField("total_amount", MONEY),
    StructField("congestion_surcharge", MONEY),
    StructField("airport_fee", MONEY),
    StructField("trip_duration_minutes", MONEY),
    StructField("trip_speed_mph", MONEY),
])
SILVER_MONEY_COLUMNS = [f.name for f in SILVER_CLEAN_SCHEMA if f.dataType == MONEY]
SILVER_NOT_NULL = [f.name for f in SILVER_CLEAN_SCHEMA if not f.nullable]

# silver.rejected_records: lineage, reason, and the cleaned values under raw_ names.
REJECTED_SOURCE_COLUMNS = [
    ("vendor_id", IntegerType()),
    ("pickup_datetime", TimestampNTZType()),
    ("dropoff_datetime", TimestampNTZType()),
    ("passenger_count", DoubleType()),
    ("trip_distance", DoubleType()),
    ("rate_code_id", DoubleType()),
    ("pu_location_id", IntegerType()),
    ("do_location_id", IntegerType()),
    ("payment_type", DoubleType()),
    ("fare_amount", DoubleType()),
    ("tip_amount", DoubleType()),
    ("total_amount", DoubleType()),
]
SILVER_REJECTED_SCHEMA = StructType(
    [
        StructField("source_file", StringType()),
        StructField("reference_year", ShortType()),
        StructField("reference_month", ShortType()),
        StructField("rejection_reason", StringType(), False),
    ]
    + [StructField("raw_" + n, t) for n, t in REJECTED_SOURCE_COLUMNS]
)

# raw.yellow_taxi (bronze): lineage and the raw values under warehouse names.
BRONZE_SCHEMA = StructType(
    [
        StructField("source_file", StringType()),
        StructField("reference_year", ShortType()),
        StructField("reference_month", ShortType()),
    ]
    + [
        StructField(
            {"VendorID": "vendor_id", "RatecodeID": "rate_code_id",
             "PULocationID": "pu_location_id", "DOLocationID": "do_location_id",
             "Airport_fee": "airport_fee"}.get(n, n),
            t,
        )
        for n, t in RAW_COLUMNS
    ]
)


def _gold(key_fields, measures):
    return StructType(
        [StructField("reference_year", ShortType(), False),
         StructField("reference_month", ShortType(), False)]
        + key_fields + measures
    )


GOLD_SCHEMAS = {
    "trips_by_day": _gold(
        [StructField("trip_date", DateType(), False)],
        [
            StructField("total_trips", LongType(), False),
            StructField("total_passengers", LongType()),
            StructField("total_distance_miles", TOTAL),
            StructField("total_fare_amount", TOTAL),
            StructField("total_tip_amount", TOTAL),
            StructField("total_revenue", TOTAL),
            StructField("avg_fare_amount", MONEY),
            StructField("avg_trip_distance", MONEY),
            StructField("avg_trip_duration_min", MONEY),
        ],
    ),
    "trips_by_zone": _gold(
        [StructField("pu_location_id", ShortType(), False)],
        [
            StructField("total_trips", LongType(), False),
            StructField("total_revenue", TOTAL),
            StructField("avg_fare_amount", MONEY),
            StructField("avg_trip_distance", MONEY),
            StructField("avg_tip_amount", MONEY),
        ],
    ),
    "payment_summary": _gold(
        [StructField("payment_type", ShortType(), False)],
        [
            StructField("payment_type_desc", StringType()),
            StructField("total_trips", LongType(), False),
            StructField("total_revenue", TOTAL),
            StructField("total_tip_amount", TOTAL),
            StructField("avg_tip_amount", MONEY),
            StructField("pct_of_total_trips", PERCENT),
        ],
    ),
    "hourly_demand": _gold(
        [StructField("hour_of_day", ShortType(), False)],
        [
            StructField("total_trips", LongType(), False),
            StructField("avg_trips_per_day", MONEY),
            StructField("total_revenue", TOTAL),
            StructField("avg_fare_amount", MONEY),
        ],
    ),
    "zone_avg_fare": _gold(
        [StructField("pu_location_id", ShortType(), False)],
        [
            StructField("total_trips", LongType(), False),
            StructField("avg_fare_amount", MONEY),
            StructField("avg_total_amount", MONEY),
            StructField("avg_tip_amount", MONEY),
            StructField("avg_trip_distance", MONEY),
            StructField("avg_duration_minutes", MONEY),
        ],
    ),
}
GOLD_KEYS = {
    "trips_by_day": ["trip_date"],
    "trips_by_zone": ["pu_location_id"],
    "payment_summary": ["payment_type"],
    "hourly_demand": ["hour_of_day"],
    "zone_avg_fare": ["pu_location_id"],
}
# Warehouse namespaces and table names.
TABLES = {
    "bronze": ("raw", "yellow_taxi"),
    "silver_clean": ("silver", "yellow_taxi_clean"),
    "silver_rejected": ("silver", "rejected_records"),
    **{name: ("gold", name) for name in GOLD_SCHEMAS},
}
TABLE_SCHEMAS = {
    "bronze": BRONZE_SCHEMA,
    "silver_clean": SILVER_CLEAN_SCHEMA,
    "silver_rejected": SILVER_REJECTED_SCHEMA,
    **GOLD_SCHEMAS,
}
# Text length limits of the warehouse (CHAR/VARCHAR).
LENGTH_LIMITS = {
    "silver_clean": {"source_file": 255, "store_and_fwd_flag": 1},
    "silver_rejected": {"source_file": 255, "rejection_reason": 255},
    "bronze": {"source_file": 255, "store_and_fwd_flag": 3},
    "payment_summary": {"payment_type_desc": 50},
}
# --- end of fixed values ---
