"""Seeded random raw trips, dense in edge values, checked row by row against a
plain-Python statement of the cleaning and rule semantics."""

import calendar
import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

from conftest import RAW_WITH_LINEAGE, trip
from tripyard.operators import clean as C
from tripyard.operators import validate as V

EPOCH = dt.datetime(1970, 1, 1)


def half_up(x, places=2):
    if x is None or math.isnan(x) or math.isinf(x):
        return x
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def code(x):
    if x is None:
        return None
    if isinstance(x, float) and (math.isnan(x) or math.isinf(x)):
        return -1
    t = math.trunc(x)
    return t if -32768 <= t <= 32767 else -1


def fill(x, default):
    return default if x is None or (isinstance(x, float) and math.isnan(x)) else x


def secs(ts):
    """Whole epoch seconds (fraction dropped; all test times are after 1970)."""
    return int((ts.replace(microsecond=0) - EPOCH).total_seconds())


def expected(r):
    """Cleaned (passengers, distance, rate, pu, do, fare, tip, duration, speed) and reason."""
    pax, dist, rate = code(r["passenger_count"]), half_up(r["trip_distance"]), fill(code(r["RatecodeID"]), 1)
    pu, do, fare, tip = code(r["PULocationID"]), code(r["DOLocationID"]), half_up(r["fare_amount"]), fill(half_up(r["tip_amount"]), 0.0)
    p, d = r["tpep_pickup_datetime"], r["tpep_dropoff_datetime"]
    dur = None if p is None or d is None else half_up((secs(d) - secs(p)) / 60.0)
    speed = None
    # Spark orders NaN above every number, so a NaN distance counts as positive
    if dur is not None and dist is not None and dur > 0 and (math.isnan(dist) or dist > 0):
        speed = half_up(dist / (dur / 60.0))
    y, m = r["reference_year"], r["reference_month"]
    start = dt.datetime(y, m, 1)
    end = dt.datetime(y + (m == 12), m % 12 + 1, 1)

    def bad(v, lo, hi):
        return v is None or v < lo or v > hi

    if p is None:
        reason = "pickup_datetime is null"
    elif d is None:
        reason = "dropoff_datetime is null"
    elif p < start or p >= end:
        reason = "pickup_datetime out of reference period"
    elif d <= p:
        reason = "dropoff_datetime <= pickup_datetime"
    elif pax is None or pax <= 0 or pax > 8:
        reason = "invalid passenger_count"
    elif dist is None or math.isnan(dist) or dist <= 0 or dist > 500.0:
        reason = "invalid trip_distance"
    elif bad(pu, 1, 263):
        reason = "invalid pu_location_id"
    elif bad(do, 1, 263):
        reason = "invalid do_location_id"
    elif fare is None or math.isnan(fare) or fare < 0:
        reason = "invalid fare_amount"
    elif tip < 0:
        reason = "negative tip_amount"
    elif rate < 1 or rate > 6:
        reason = "invalid rate_code_id"
    else:
        reason = None
    return (pax, dist, rate, pu, do, fare, tip, dur, speed), reason


def random_trip(rng: random.Random):
    y, m = rng.choice([(2023, 12), (2024, 1), (2024, 2)])
    days = calendar.monthrange(y, m)[1]
    base = dt.datetime(y, m, 1)
    p = rng.choice([
        base, base - dt.timedelta(microseconds=1), dt.datetime(y, m, days, 23, 59, 59, 999999),
        base + dt.timedelta(days=days), base + dt.timedelta(seconds=rng.randrange(days * 86400),
                                                            microseconds=rng.choice([0, 100000, 900000])),
        None,
    ])
    d = None if rng.random() < 0.05 or p is None else p + dt.timedelta(
        seconds=rng.choice([0, 0.5, 1, 59, 61, 600, 3599, 86400 * 2]), microseconds=rng.choice([0, 300000]))
    num = lambda choices: rng.choice(choices)
    return trip(
        period=(y, m),
        tpep_pickup_datetime=p,
        tpep_dropoff_datetime=d,
        passenger_count=num([None, 0.0, 0.9, 1.0, 8.0, 8.9, 9.0, -1.0, 70000.0, float("nan"), 3.0]),
        trip_distance=num([None, 0.0, 0.004, 0.005, 1.005, 2.675, 499.995, 500.004, 500.005, 501.0,
                           float("nan"), rng.randrange(1, 40000) / 1000]),
        RatecodeID=num([None, 0.0, 1.0, 6.0, 6.9, 7.0, 99.0, float("nan"), 2.0]),
        PULocationID=num([None, 0, 1, 263, 264, 65537, rng.randrange(1, 264)]),
        DOLocationID=num([None, 0, 1, 263, 264, rng.randrange(1, 264)]),
        fare_amount=num([None, 0.0, -0.004, -0.005, -0.01, 1.005, float("nan"), rng.randrange(0, 90000) / 1000]),
        tip_amount=num([None, -0.01, -0.004, 0.0, float("nan"), 0.125, rng.randrange(0, 3000) / 1000]),
    )


def test_random_trips_match_python_semantics(spark):
    rng = random.Random(20241)
    rows = [random_trip(rng) for _ in range(3000)]
    names = [f.name for f in RAW_WITH_LINEAGE]
    # one partition keeps the input order, so rows are matched by position
    df = spark.createDataFrame(rows, RAW_WITH_LINEAGE).coalesce(1)
    out = V.flag_trips(C.clean_trips(df)).collect()
    assert len(out) == len(rows)
    mismatches = []
    for raw_tuple, r in zip(rows, out):
        raw = dict(zip(names, raw_tuple))
        want, reason = expected(raw)
        have = (r.passenger_count, r.trip_distance, r.rate_code_id, r.pu_location_id, r.do_location_id,
                r.fare_amount, r.tip_amount, r.trip_duration_minutes, r.trip_speed_mph)
        same = all(
            (a is None and b is None) or (a is not None and b is not None and (a == b or (a != a and b != b)))
            for a, b in zip(have, want)
        )
        if not same or r.rejection_reason != reason:
            mismatches.append((raw, have, want, r.rejection_reason, reason))
    assert not mismatches, mismatches[:3]


def test_gold_means_and_sums_exact_on_random_rows(spark):
    from collections import defaultdict

    from tripyard.operators import gold as G

    rng = random.Random(7)
    rows, p0 = [], dt.datetime(2024, 1, 3, 8, 0)
    for _ in range(4000):
        p = p0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 20))
        rows.append(trip(
            tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(seconds=rng.randrange(61, 5000)),
            PULocationID=rng.choice([1, 2, 3, 263]), fare_amount=rng.randrange(0, 100000) / 100,
            tip_amount=rng.choice([0.0, rng.randrange(0, 2000) / 100]),
            total_amount=rng.choice([None, rng.randrange(-500, 200000) / 100]),
        ))
    raw = spark.createDataFrame(rows, RAW_WITH_LINEAGE).repartition(13)
    silver = V.silver_layout(V.valid_trips(V.flag_trips(C.clean_trips(raw))))
    got = {r.pu_location_id: r for r in G.zone_avg_fare(silver).collect()}

    acc = defaultdict(lambda: defaultdict(list))
    names = [f.name for f in RAW_WITH_LINEAGE]
    for t in rows:
        r = dict(zip(names, t))
        for col in ("fare_amount", "total_amount"):
            if r[col] is not None:
                acc[r["PULocationID"]][col].append(Decimal(repr(r[col])).quantize(Decimal("0.01"), ROUND_HALF_UP))

    def mean(xs):
        exact = sum(xs) / Decimal(len(xs))
        return exact.quantize(Decimal("0.01"), ROUND_HALF_UP)

    for zone, cols in acc.items():
        assert got[zone].avg_fare_amount == mean(cols["fare_amount"])
        assert got[zone].avg_total_amount == mean(cols["total_amount"])
    zones = {r.pu_location_id: r for r in G.trips_by_zone(silver).collect()}
    for zone, cols in acc.items():
        assert zones[zone].total_revenue == sum(cols["total_amount"])
