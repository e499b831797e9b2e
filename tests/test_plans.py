"""Plan properties the design relies on, checked on the formatted explain."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from tripyard.operators import clean as C
from tripyard.operators import gold as G
from tripyard.operators import validate as V
from tripyard.operators.quality import observe_checks
from tripyard.plans.job import _staging_checks
from tripyard.session import scratch_dir
from tripyard.sinks.warehouse import Warehouse, read_staging, write_staging
from tripyard.sources import raw_files as R
from tripyard.sources.fixtures import fixture_raw_trips

PERIODS = [(2024, 1)]


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def landed(spark):
    root = scratch_dir(spark, "plantest")
    R.land_raw_files(fixture_raw_trips(spark, TESTDATA, "events"), f"{root}/landing")
    raw = R.read_raw_trips(spark, [R.raw_file_path(f"{root}/landing", 2024, 1, R.SPARK_LAYOUT)])
    flagged = V.flag_trips(C.clean_trips(raw))
    write_staging(flagged, f"{root}/staging")
    wh = Warehouse(spark, f"{root}/wh", prefix="plantest_")
    wh.create_tables()
    wh.replace_periods("silver_clean", V.silver_layout(read_staging(spark, f"{root}/staging", PERIODS, True)), PERIODS)
    return flagged, root, wh


def test_clean_and_rules_need_no_shuffle_and_fold_month_bounds(landed, capsys):
    text = plan(landed[0], capsys)
    assert "Exchange" not in text
    assert "codegen id : 1" in text
    assert "make_date" not in text and "2024-02-01 00:00:00" in text


def test_staging_read_prunes_period_and_validity(spark, landed, capsys):
    text = plan(read_staging(spark, f"{landed[1]}/staging", PERIODS, valid=True), capsys)
    filters = re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "is_valid" in filters and "202401" in filters


def test_gold_groupings_one_exchange_pruned_columns(landed, capsys):
    text = plan(G.gold_partials(landed[2].read("silver_clean", PERIODS)), capsys)
    assert len(re.findall(r"\+- Exchange", text)) == 1
    assert "Expand" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "rate_code_id" not in schema and "store_and_fwd_flag" not in schema
    assert "202401" in re.search(r"PartitionFilters: \[(.*)\]", text).group(1)


def test_top_zones_limits_before_the_window_shuffle(landed, capsys):
    text = plan(G.top_zones(landed[2].read("silver_clean", PERIODS), 10), capsys)
    assert "WindowGroupLimit" in text
    assert re.search(r"ReadSchema: struct<pu_location_id:smallint,do_location_id:smallint>", text)


def test_valid_read_from_raw_pushes_month_bounds_to_parquet(spark, capsys):
    root = scratch_dir(spark, "pushdown")
    R.land_raw_files(fixture_raw_trips(spark, TESTDATA, "events"), root)
    raw = R.read_raw_trips(spark, [R.raw_file_path(root, 2024, 1, R.SPARK_LAYOUT)])
    valid = V.valid_trips(V.flag_trips(C.clean_trips(raw)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan(valid, capsys)).group(1)
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)" in pushed
    assert "LessThan(tpep_pickup_datetime,2024-02-01T00:00)" in pushed
    assert valid.count() == 817


def test_month_runs_join_over_the_narrowest_gaps():
    months = [(2023, 12), (2024, 1), (2024, 3), (2024, 9), (2024, 1)]
    assert V.month_runs(months) == [((2023, 12), (2024, 1)), ((2024, 3), (2024, 3)), ((2024, 9), (2024, 9))]
    assert V.month_runs(months, most=2) == [((2023, 12), (2024, 3)), ((2024, 9), (2024, 9))]
    assert V.month_runs(months, most=1) == [((2023, 12), (2024, 9))]
    assert V.month_runs([]) == []


def test_valid_read_of_several_months_pushes_their_bounds(spark, capsys):
    """Three months, one of them apart: the same rows with and without bounds,
    and none of a month that is scanned but not asked for."""
    root = scratch_dir(spark, "pushmonths")
    R.land_raw_files(fixture_raw_trips(spark, TESTDATA, "lineitem"), root)
    asked = [(1995, 11), (1995, 12), (1996, 3)]
    scanned = [*asked, (1997, 7)]
    flagged = V.flag_trips(C.clean_trips(R.read_raw_trips(spark, [R.raw_file_path(root, y, m, R.SPARK_LAYOUT) for y, m in scanned])))
    bounded = V.valid_trips(flagged, asked)
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan(bounded, capsys)).group(1)
    for bound in ("GreaterThanOrEqual(tpep_pickup_datetime,1995-11-01T00:00)", "LessThan(tpep_pickup_datetime,1996-01-01T00:00)",
                  "GreaterThanOrEqual(tpep_pickup_datetime,1996-03-01T00:00)", "LessThan(tpep_pickup_datetime,1996-04-01T00:00)"):
        assert bound in pushed
    keys = [y * 100 + m for y, m in asked]
    in_asked = (F.col("reference_year").cast("int") * 100 + F.col("reference_month")).isin(keys)
    plain = V.valid_trips(flagged).filter(in_asked)
    assert bounded.count() > 0
    assert bounded.exceptAll(plain).count() == 0 and plain.exceptAll(bounded).count() == 0
    assert V.valid_trips(flagged, []).count() == 0
    assert V.rejected_trips(flagged, asked).count() == V.rejected_trips(flagged).filter(in_asked).count()


def test_cleaning_and_rules_stay_below_the_size_that_is_compiled(spark):
    """HotSpot interprets methods of more than 8000 bytes."""
    flagged = V.flag_trips(C.clean_trips(fixture_raw_trips(spark, TESTDATA)))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = flagged._jdf.queryExecution().explainString(mode)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("layout", ["valid", "silver", "rejected"])
def test_a_filter_on_the_reason_does_not_evaluate_the_rules_again(spark, layout):
    """The rules copied into the filter were one method of more than 10,000 bytes."""
    valid, rejected = V.split_valid_rejected(V.flag_trips(C.clean_trips(fixture_raw_trips(spark, TESTDATA))))
    rows = {"valid": valid, "silver": V.silver_layout(valid), "rejected": V.rejected_layout(rejected)}[layout]
    execution = rows._jdf.queryExecution()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", execution.explainString(mode))]
    assert sizes and max(sizes) < 8000
    conditions = re.findall(r"Filter (.*)", execution.optimizedPlan().toString())
    assert conditions and not any("passenger_count#" in c for c in conditions)


def test_observed_checks_are_bits_made_by_generators(spark):
    """The metrics only read the bits; no projection of the plan holds the checks."""
    flagged = V.flag_trips(C.clean_trips(fixture_raw_trips(spark, TESTDATA)))
    _, checks = _staging_checks()
    observed, _ = observe_checks(flagged, "plan_checks", checks)
    assert observed.columns == flagged.columns
    lines = observed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    casts = [line for line in lines if "as decimal(10,2))" in line]
    assert casts and all("Generate inline" in line for line in casts)


def test_a_period_filter_spares_the_mapping_of_other_months(spark):
    """It is below the generators of all other columns."""
    march = fixture_raw_trips(spark, TESTDATA).where("reference_month = 3")
    lines = march._jdf.queryExecution().optimizedPlan().toString().splitlines()
    filtered = next(i for i, line in enumerate(lines) if "Filter" in line and "reference_month" in line)
    assert filtered > max(i for i, line in enumerate(lines) if "fare_amount" in line and "Generate" in line)
