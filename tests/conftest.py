import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql.types import ShortType, StringType, StructField, StructType  # noqa: E402

from tripyard.schema import RAW_SCHEMA  # noqa: E402
from tripyard.session import local_session  # noqa: E402

RAW_WITH_LINEAGE = StructType(
    list(RAW_SCHEMA.fields)
    + [
        StructField("source_file", StringType()),
        StructField("reference_year", ShortType()),
        StructField("reference_month", ShortType()),
    ]
)

DEFAULT_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 1, 15, 10, 0, 0),
    "tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 10, 20, 0),
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1.0,
    "fare_amount": 15.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 20.0,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
    "source_file": "yellow_tripdata_2024-01.parquet",
    "reference_year": 2024,
    "reference_month": 1,
}

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", app="tripyard-tests")
    yield session
    session.stop()


def trip(**overrides):
    row = {**DEFAULT_TRIP, **overrides}
    if "period" in overrides:
        y, m = overrides["period"]
        row.update(reference_year=y, reference_month=m,
                   source_file=f"yellow_tripdata_{y}-{m:02d}.parquet")
        del row["period"]
    return tuple(row[f.name] for f in RAW_WITH_LINEAGE)


@pytest.fixture
def raw_frame(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), RAW_WITH_LINEAGE)

    return make
