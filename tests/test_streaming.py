import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from conftest import RAW_WITH_LINEAGE, TESTDATA, trip
from tripyard.session import scratch_dir
from tripyard.sinks.warehouse import Warehouse
from tripyard.sources import raw_files as R
from tripyard.sources.fixtures import fixture_raw_trips
from tripyard.streaming.landing import month_roots, start_monthly_loads


def test_month_roots():
    got = month_roots(["/l/file=yellow_tripdata_2024-01.parquet/part-1.parquet",
                       "/l/yellow_tripdata_2023-12.parquet", "/l/other.parquet"])
    assert got == {(2024, 1): "/l/file=yellow_tripdata_2024-01.parquet",
                   (2023, 12): "/l/yellow_tripdata_2023-12.parquet"}


def test_new_months_are_loaded_once(spark):
    root = scratch_dir(spark, "stream")
    landing, ckpt = f"{root}/landing", f"{root}/ckpt"
    R.land_raw_files(fixture_raw_trips(spark, TESTDATA, "events"), landing)
    q = start_monthly_loads(spark, landing, f"{root}/wh", f"{root}/work", ckpt, min_file_bytes=0, prefix="st_")
    q.awaitTermination()
    wh = Warehouse(spark, f"{root}/wh", prefix="st_")
    assert wh.read("silver_clean").count() == 817
    # a second month lands later; a restart loads only the new file
    p = dt.datetime(2024, 2, 5, 8, 0)
    feb = spark.createDataFrame(
        [trip(period=(2024, 2), tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=9))],
        RAW_WITH_LINEAGE)
    R.land_raw_files(feb, landing)
    q = start_monthly_loads(spark, landing, f"{root}/wh", f"{root}/work2", ckpt, min_file_bytes=0, prefix="st_")
    q.awaitTermination()
    counts = {r.reference_month: r["count"] for r in wh.read("silver_clean").groupBy("reference_month").count().collect()}
    assert counts == {1: 817, 2: 1}


def test_parts_of_one_month_across_batches_load_once(spark):
    root = scratch_dir(spark, "stream-parts")
    month_dir = R.raw_file_path(f"{root}/landing", 2024, 1, R.SPARK_LAYOUT)
    raw = fixture_raw_trips(spark, TESTDATA, "events")
    raw.drop("source_file", "reference_year", "reference_month").repartition(3).write.parquet(month_dir)
    q = start_monthly_loads(spark, f"{root}/landing", f"{root}/wh", f"{root}/work", f"{root}/ckpt",
                            min_file_bytes=0, max_files_per_trigger=1, prefix="stp_")
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    wh = Warehouse(spark, f"{root}/wh", prefix="stp_")
    assert wh.read("silver_clean").count() == 817
    assert wh.read("silver_rejected").count() == 183


def test_a_split_month_over_the_threshold_loads_and_an_undersized_one_raises(spark):
    root = scratch_dir(spark, "stream-size")
    month_dir = R.raw_file_path(f"{root}/landing", 2024, 1, R.SPARK_LAYOUT)
    raw = fixture_raw_trips(spark, TESTDATA, "events")
    raw.drop("source_file", "reference_year", "reference_month").repartition(3).write.parquet(month_dir)
    sizes = [r.length for r in R.listed_files(spark, [month_dir]).collect()]
    assert len(sizes) == 3
    q = start_monthly_loads(spark, f"{root}/landing", f"{root}/wh", f"{root}/work", f"{root}/ckpt",
                            min_file_bytes=max(sizes) + 1, max_files_per_trigger=1, prefix="sts_")
    q.awaitTermination()
    assert Warehouse(spark, f"{root}/wh", prefix="sts_").read("silver_clean").count() == 817
    q = start_monthly_loads(spark, f"{root}/landing", f"{root}/wh2", f"{root}/work2", f"{root}/ckpt2",
                            min_file_bytes=sum(sizes) + 1, prefix="stu_")
    with pytest.raises(StreamingQueryException, match="invalid raw files"):
        q.awaitTermination()


def test_a_month_at_two_places_is_an_error():
    with pytest.raises(ValueError, match="landed at"):
        month_roots(["/l/a/yellow_tripdata_2024-01.parquet", "/l/b/yellow_tripdata_2024-01.parquet"])
