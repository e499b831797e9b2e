import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import trip
from tripyard.operators import clean as C
from tripyard.operators import gold as G
from tripyard.operators import validate as V

T = dt.datetime


def silver_of(raw_frame, *rows):
    return V.silver_layout(V.valid_trips(V.flag_trips(C.clean_trips(raw_frame(*rows)))))


def rows_at(hour, n, **kw):
    p = T(2024, 1, 10, hour, 5)
    return [trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=12), **kw)
            for _ in range(n)]


def test_means_are_exact_half_up(raw_frame):
    # fares 1.00, 1.01 -> mean 1.005 -> 1.01 (HALF_UP of the exact decimal mean)
    silver = silver_of(raw_frame, *rows_at(9, 1, fare_amount=1.0), *rows_at(9, 1, fare_amount=1.01))
    r = G.trips_by_day(silver).collect()[0]
    assert r.avg_fare_amount == Decimal("1.01")
    assert r.total_fare_amount == Decimal("2.01")
    assert r.total_trips == 2 and r.total_passengers == 2


def test_mean_skips_null_total(raw_frame):
    silver = silver_of(raw_frame, *rows_at(9, 1, total_amount=None), *rows_at(9, 1, total_amount=10.0))
    r = G.zone_avg_fare(silver).collect()[0]
    assert r.avg_total_amount == Decimal("10.00") and r.total_trips == 2


def test_hourly_average_uses_calendar_days(raw_frame):
    silver = silver_of(raw_frame, *rows_at(7, 62))
    r = G.hourly_demand(silver).collect()[0]
    assert (r.hour_of_day, r.total_trips, r.avg_trips_per_day) == (7, 62, Decimal("2.00"))


def test_payment_labels_and_percentages(raw_frame):
    rows = rows_at(8, 2, payment_type=1.0) + rows_at(8, 1, payment_type=0.0) + rows_at(8, 3, payment_type=None)
    out = {r.payment_type: r for r in G.payment_summary(silver_of(raw_frame, *rows)).collect()}
    assert out[1].payment_type_desc == "Credit card"
    assert out[0].payment_type_desc is None
    assert out[5].payment_type_desc == "Unknown"  # null code filled with 5
    assert [out[k].pct_of_total_trips for k in (1, 0, 5)] == [Decimal("33.33"), Decimal("16.67"), Decimal("50.00")]


def test_grouping_sets_equal_per_table(raw_frame, spark):
    from tripyard.sources.fixtures import fixture_raw_trips
    from conftest import TESTDATA

    raw = fixture_raw_trips(spark, TESTDATA, "lineitem")
    silver = V.silver_layout(V.valid_trips(V.flag_trips(C.clean_trips(raw)))).checkpoint()
    tables = G.gold_tables(G.gold_partials(silver))
    for name, df in tables.items():
        single = G.gold_table(silver, name)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in single.schema]
        assert df.exceptAll(single).count() == 0 and single.exceptAll(df).count() == 0, name
    # every table accounts for every valid trip
    totals = {n: t.agg(F.sum("total_trips")).first()[0] for n, t in tables.items()}
    assert len(set(totals.values())) == 1 and totals["trips_by_day"] == silver.count()
    # percentages of a period add up to 100 within rounding
    pct = tables["payment_summary"].groupBy("reference_year", "reference_month").agg(
        F.sum("pct_of_total_trips").alias("s"), F.count(F.lit(1)).alias("n"))
    assert pct.filter(F.abs(F.col("s") - 100) > F.col("n") * 0.01).count() == 0


def test_top_zones_ranks_ties_by_zone(raw_frame):
    rows = rows_at(9, 2, PULocationID=5) + rows_at(9, 2, PULocationID=3) + rows_at(9, 1, PULocationID=9)
    top = G.top_zones(silver_of(raw_frame, *rows), 2).filter("side = 'pickup'").orderBy("rank").collect()
    assert [(r.rank, r.location_id, r.total_trips) for r in top] == [(1, 3, 2), (2, 5, 2)]


def test_documented_checks_on_hand_rows(raw_frame):
    from tripyard.operators.quality import documented_checks

    # components of the default trip: 15 + 0.5 + 0.5 + 3 + 0 + 1 + 2.5 + 0 = 22.5;
    # its total of 20 is the one mismatch
    rows = [
        trip(total_amount=22.5),
        trip(total_amount=22.505),   # rounds to 22.51: one cent off, within the 0.01 tolerance
        trip(),
        trip(total_amount=None, payment_type=None),
        trip(total_amount=22.5, payment_type=7.0),
    ]
    got = {r.check_name: r.violations for r in documented_checks(raw_frame(*rows)).collect()}
    assert got == {"total_amount_mismatch": 1, "payment_type_invalid": 2}
