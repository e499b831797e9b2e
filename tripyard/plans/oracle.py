"""Independent DuckDB SQL for every registered query.

The SQL re-derives each result from the test tables (views ``events`` and
``lineitem``) without any Spark code. Rules that keep both engines equal:

* Spark rounds a double through its shortest decimal text (1.005 -> 1.01);
  here the same is done through ``CAST(x AS VARCHAR)`` read back as a DECIMAL
  with 28 fraction digits (17 would drop the last digit of 0.034999999999999996).
* DuckDB rounds when casting to SMALLINT, Spark truncates: ``trunc`` first.
* Means are exact: HALF_UP of (sum in cents) / n with integer arithmetic.
* Money leaves both engines as DOUBLE (the nearest double to the decimal).
"""

from __future__ import annotations

from tripyard.schema import (
    LOCATION_ID_MAX,
    LOCATION_ID_MIN,
    MAX_PASSENGERS,
    MAX_TRIP_DISTANCE,
    PAYMENT_LABELS,
    RATE_CODE_MAX,
    RATE_CODE_MIN,
    REASON_DISTANCE,
    REASON_DO,
    REASON_DROPOFF_BEFORE,
    REASON_DROPOFF_NULL,
    REASON_FARE,
    REASON_OUT_OF_PERIOD,
    REASON_PASSENGERS,
    REASON_PICKUP_NULL,
    REASON_PU,
    REASON_RATE,
    REASON_TIP,
    TABLES,
)

PERIOD = "reference_year, reference_month"


def _exact_text(x: str) -> str:
    """The shortest decimal text of a double as a DECIMAL with enough fraction
    digits to keep every digit of it (a double's text can have 18+ of them)."""
    return f"TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,28))"


def _round2(x: str) -> str:
    return (
        f"CASE WHEN isnan({x}) OR isinf({x}) THEN {x} "
        f"WHEN abs({x}) >= 1e9 THEN round({x}, 2) ELSE "
        f"CAST(round({_exact_text(x)}, 2) AS DOUBLE) END"
    )


def _code(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL ELSE "
        f"coalesce(TRY_CAST(trunc({x}) AS SMALLINT), CAST(-1 AS SMALLINT)) END"
    )


def _money(x: str, t: str = "DECIMAL(10,2)") -> str:
    return (
        f"CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE "
        f"TRY_CAST(coalesce({_exact_text(x)}, CAST({x} AS DECIMAL(38,2))) AS {t}) END"
    )


def _fill(x: str, v: str) -> str:
    return f"coalesce(CASE WHEN isnan({x}) THEN NULL ELSE {x} END, {v})"


def _dbl(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _epoch_s(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


def _mean(col: str) -> str:
    """HALF_UP mean of a DECIMAL(10,2) column, as DOUBLE."""
    c = f"CAST(sum({col}) * 100 AS HUGEINT)"
    n = f"count({col})"
    return (
        f"CASE WHEN {n} = 0 THEN NULL ELSE "
        f"CAST(sign({c}) * ((2 * abs({c}) + {n}) // (2 * {n})) AS DOUBLE) / 100 END"
    )


def _total(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} = 0 THEN 0.0 ELSE "
        f"CAST((2 * CAST({part} AS HUGEINT) * 10000 + {whole}) // (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / 100 END"
    )


_BASE = {
    "events": """
  SELECT event_id AS k, user_id AS u, ts, value AS v, 2024 AS ry, 1 AS rm
  FROM events""",
    "lineitem": """
  SELECT l_orderkey * 8 + l_linenumber AS k, l_partkey AS u,
         l_shipdate + ((l_orderkey * 61 + l_partkey * 7) % 86400) * INTERVAL '1' SECOND AS ts,
         l_quantity + l_discount AS v,
         year(l_shipdate) AS ry, month(l_shipdate) AS rm
  FROM lineitem""",
}

_TIP = "CAST((k * 7) % 1000 AS DOUBLE) / 100"

_RAW = f"""
  SELECT
    CASE WHEN k % 53 = 0 THEN NULL ELSE CAST(1 + k % 2 AS INTEGER) END AS VendorID,
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 97 = 0 THEN ts - INTERVAL '40' DAY
         WHEN k % 103 = 0 THEN ts + INTERVAL '31' DAY ELSE ts END AS tpep_pickup_datetime,
    CASE WHEN k % 107 = 0 THEN NULL WHEN k % 89 = 0 THEN ts
         WHEN k % 103 = 0 THEN ts + INTERVAL '32' DAY
         ELSE ts + (61 + (u * 37 + k * 13) % 5400) * INTERVAL '1' SECOND END AS tpep_dropoff_datetime,
    CASE WHEN k % 59 = 0 THEN NULL WHEN k % 61 = 0 THEN {_dbl(0)} WHEN k % 67 = 0 THEN {_dbl(9)}
         ELSE CAST(1 + k % 6 AS DOUBLE) END AS passenger_count,
    CASE WHEN k % 71 = 0 THEN {_dbl(0)} WHEN k % 73 = 0 THEN {_dbl(501)} WHEN k % 139 = 0 THEN NULL
         ELSE CAST(((u * 7 + k * 31) % 2400) * 10 + 17 AS DOUBLE) / 1000 END AS trip_distance,
    CASE WHEN k % 79 = 0 THEN {_dbl(99)} WHEN k % 47 = 0 THEN NULL
         ELSE CAST(1 + k % 6 AS DOUBLE) END AS RatecodeID,
    CASE WHEN k % 43 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(CASE WHEN k % 83 = 0 THEN 264 ELSE 1 + (u * 11 + k) % 263 END AS INTEGER) AS PULocationID,
    CAST(CASE WHEN k % 109 = 0 THEN 0 ELSE 1 + (u * 17 + k * 3) % 263 END AS INTEGER) AS DOLocationID,
    CASE WHEN k % 41 = 0 THEN NULL WHEN k % 113 = 0 THEN {_dbl(0)}
         ELSE CAST(1 + k % 6 AS DOUBLE) END AS payment_type,
    CASE WHEN k % 127 = 0 THEN {_dbl(-1)} WHEN k % 131 = 0 THEN NULL ELSE v END AS fare_amount,
    CASE WHEN k % 31 = 0 THEN NULL ELSE CAST(k % 5 AS DOUBLE) / 2 END AS extra,
    CASE WHEN k % 29 = 0 THEN NULL ELSE {_dbl(0.5)} END AS mta_tax,
    CASE WHEN k % 137 = 0 THEN {_dbl(-0.5)} WHEN k % 37 = 0 THEN NULL ELSE {_TIP} END AS tip_amount,
    CASE WHEN k % 19 = 0 THEN {_dbl(6.94)} ELSE {_dbl(0)} END AS tolls_amount,
    CASE WHEN k % 29 = 0 THEN NULL ELSE {_dbl(1)} END AS improvement_surcharge,
    CASE WHEN k % 149 = 0 THEN NULL ELSE v + {_TIP} + 3 END AS total_amount,
    CASE WHEN k % 29 = 0 THEN NULL ELSE {_dbl(1)} END AS congestion_surcharge,
    CASE WHEN k % 23 = 0 THEN {_dbl(1.75)} ELSE CAST(NULL AS DOUBLE) END AS Airport_fee,
    printf('yellow_tripdata_%04d-%02d.parquet', ry, rm) AS source_file,
    CAST(ry AS SMALLINT) AS reference_year, CAST(rm AS SMALLINT) AS reference_month
  FROM base"""

_NORMALIZED = """
  SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
         tpep_dropoff_datetime AS dropoff_datetime, passenger_count, trip_distance,
         RatecodeID AS rate_code_id, store_and_fwd_flag, PULocationID AS pu_location_id,
         DOLocationID AS do_location_id, payment_type, fare_amount, extra, mta_tax,
         tip_amount, tolls_amount, improvement_surcharge, total_amount,
         congestion_surcharge, Airport_fee AS airport_fee,
         source_file, reference_year, reference_month
  FROM raw"""

_TYPED = f"""
  SELECT {_code('vendor_id')} AS vendor_id, pickup_datetime, dropoff_datetime,
         {_code('passenger_count')} AS passenger_count, {_round2('trip_distance')} AS trip_distance,
         {_code('rate_code_id')} AS rate_code_id, store_and_fwd_flag,
         {_code('pu_location_id')} AS pu_location_id, {_code('do_location_id')} AS do_location_id,
         {_code('payment_type')} AS payment_type, {_round2('fare_amount')} AS fare_amount,
         extra, mta_tax, {_round2('tip_amount')} AS tip_amount, tolls_amount,
         improvement_surcharge, {_round2('total_amount')} AS total_amount,
         congestion_surcharge, airport_fee, source_file, reference_year, reference_month
  FROM normalized"""

_FILLED = f"""
  SELECT coalesce(vendor_id, CAST(0 AS SMALLINT)) AS vendor_id, pickup_datetime, dropoff_datetime,
         passenger_count, trip_distance, coalesce(rate_code_id, CAST(1 AS SMALLINT)) AS rate_code_id,
         coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, pu_location_id, do_location_id,
         coalesce(payment_type, CAST(5 AS SMALLINT)) AS payment_type, fare_amount,
         {_fill('extra', '0.0')} AS extra, {_fill('mta_tax', '0.0')} AS mta_tax,
         {_fill('tip_amount', '0.0')} AS tip_amount, {_fill('tolls_amount', '0.0')} AS tolls_amount,
         {_fill('improvement_surcharge', '0.0')} AS improvement_surcharge, total_amount,
         {_fill('congestion_surcharge', '0.0')} AS congestion_surcharge,
         {_fill('airport_fee', '0.0')} AS airport_fee, source_file, reference_year, reference_month
  FROM typed"""

_DURATION = f"""
  SELECT *, {_round2(f"({_epoch_s('dropoff_datetime')} - {_epoch_s('pickup_datetime')}) / {_dbl(60)}")}
            AS trip_duration_minutes
  FROM filled"""

_DERIVED = f"""
  SELECT *, CASE WHEN trip_duration_minutes > 0 AND trip_distance > 0
                 THEN {_round2(f"trip_distance / (trip_duration_minutes / {_dbl(60)})")} END
            AS trip_speed_mph
  FROM duration"""

_TAGGED = """
  SELECT * FROM derived"""

CLEAN_COLS = (
    "vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, "
    "rate_code_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type, "
    "fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, "
    "total_amount, congestion_surcharge, airport_fee, trip_duration_minutes, "
    "trip_speed_mph, reference_year, reference_month, source_file"
)

_START = "CAST(make_date(reference_year, reference_month, 1) AS TIMESTAMP)"
_END = "CAST(make_date(reference_year, reference_month, 1) + INTERVAL '1' MONTH AS TIMESTAMP)"

_RULES = [
    (REASON_PICKUP_NULL, "pickup_datetime IS NULL"),
    (REASON_DROPOFF_NULL, "dropoff_datetime IS NULL"),
    (REASON_OUT_OF_PERIOD, f"coalesce(pickup_datetime < {_START} OR pickup_datetime >= {_END}, true)"),
    (REASON_DROPOFF_BEFORE, "dropoff_datetime <= pickup_datetime"),
    (REASON_PASSENGERS, f"passenger_count IS NULL OR passenger_count <= 0 OR passenger_count > {MAX_PASSENGERS}"),
    (REASON_DISTANCE, f"trip_distance IS NULL OR trip_distance <= 0 OR trip_distance > {_dbl(MAX_TRIP_DISTANCE)}"),
    (REASON_PU, f"pu_location_id IS NULL OR pu_location_id < {LOCATION_ID_MIN} OR pu_location_id > {LOCATION_ID_MAX}"),
    (REASON_DO, f"do_location_id IS NULL OR do_location_id < {LOCATION_ID_MIN} OR do_location_id > {LOCATION_ID_MAX}"),
    (REASON_FARE, "fare_amount IS NULL OR isnan(fare_amount) OR fare_amount < 0"),
    (REASON_TIP, "tip_amount < 0"),
    (REASON_RATE, f"rate_code_id IS NOT NULL AND (rate_code_id < {RATE_CODE_MIN} OR rate_code_id > {RATE_CODE_MAX})"),
]

_FLAGGED = f"""
  SELECT *, CASE {' '.join(f"WHEN {broken} THEN '{reason}'" for reason, broken in _RULES)}
    ELSE CAST(NULL AS VARCHAR) END AS rejection_reason
  FROM clean"""

_MONEY_COLS = [
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
    "trip_duration_minutes", "trip_speed_mph",
]
_SILVER_ORDER = [
    "source_file", "reference_year", "reference_month", "vendor_id", "pickup_datetime",
    "dropoff_datetime", "passenger_count", "trip_distance", "rate_code_id",
    "store_and_fwd_flag", "pu_location_id", "do_location_id", "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
    "trip_duration_minutes", "trip_speed_mph",
]
_SILVER = "\n  SELECT " + ",\n         ".join(
    f"{_money(c)} AS {c}" if c in _MONEY_COLS else c for c in _SILVER_ORDER
) + "\n  FROM flagged WHERE rejection_reason IS NULL"

_REJECTED = """
  SELECT source_file, reference_year, reference_month, rejection_reason,
         CAST(vendor_id AS INTEGER) AS raw_vendor_id,
         pickup_datetime AS raw_pickup_datetime, dropoff_datetime AS raw_dropoff_datetime,
         CAST(passenger_count AS DOUBLE) AS raw_passenger_count,
         trip_distance AS raw_trip_distance, CAST(rate_code_id AS DOUBLE) AS raw_rate_code_id,
         CAST(pu_location_id AS INTEGER) AS raw_pu_location_id,
         CAST(do_location_id AS INTEGER) AS raw_do_location_id,
         CAST(payment_type AS DOUBLE) AS raw_payment_type, fare_amount AS raw_fare_amount,
         tip_amount AS raw_tip_amount, total_amount AS raw_total_amount
  FROM flagged WHERE rejection_reason IS NOT NULL"""

# Chain of CTEs: name -> body. Each stage reads the previous ones.
_STAGES = [
    ("raw", _RAW),
    ("normalized", _NORMALIZED),
    ("typed", _TYPED),
    ("filled", _FILLED),
    ("duration", _DURATION),
    ("derived", _DERIVED),
    ("tagged", _TAGGED),
    ("clean", f"\n  SELECT {CLEAN_COLS} FROM tagged"),
    ("flagged", _FLAGGED),
    ("silver", _SILVER),
    ("rejected", _REJECTED),
]


def _with(source: str, upto: str) -> str:
    ctes = [("base", _BASE[source])]
    for name, body in _STAGES:
        ctes.append((name, body))
        if name == upto:
            break
    return "WITH " + ",\n".join(f"{n} AS ({b}\n)" for n, b in ctes) + "\n"


def _silver_doubles(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _MONEY_COLS else c for c in cols)


def _gold_sql(name: str) -> str:
    if name == "trips_by_day":
        return f"""SELECT {PERIOD}, CAST(pickup_datetime AS DATE) AS trip_date,
  count(*) AS total_trips, CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
  {_total('trip_distance')} AS total_distance_miles, {_total('fare_amount')} AS total_fare_amount,
  {_total('tip_amount')} AS total_tip_amount, {_total('total_amount')} AS total_revenue,
  {_mean('fare_amount')} AS avg_fare_amount, {_mean('trip_distance')} AS avg_trip_distance,
  {_mean('trip_duration_minutes')} AS avg_trip_duration_min
FROM silver GROUP BY {PERIOD}, CAST(pickup_datetime AS DATE)"""
    if name == "trips_by_zone":
        return f"""SELECT {PERIOD}, pu_location_id, count(*) AS total_trips,
  {_total('total_amount')} AS total_revenue, {_mean('fare_amount')} AS avg_fare_amount,
  {_mean('trip_distance')} AS avg_trip_distance, {_mean('tip_amount')} AS avg_tip_amount
FROM silver GROUP BY {PERIOD}, pu_location_id"""
    if name == "payment_summary":
        labels = " ".join(f"WHEN {k} THEN '{v}'" for k, v in PAYMENT_LABELS.items())
        return f"""SELECT {PERIOD}, payment_type, payment_type_desc, total_trips, total_revenue,
  total_tip_amount, avg_tip_amount,
  {_pct('total_trips', f'sum(total_trips) OVER (PARTITION BY {PERIOD})')} AS pct_of_total_trips
FROM (SELECT {PERIOD}, payment_type, CASE payment_type {labels} END AS payment_type_desc,
        count(*) AS total_trips, {_total('total_amount')} AS total_revenue,
        {_total('tip_amount')} AS total_tip_amount, {_mean('tip_amount')} AS avg_tip_amount
      FROM silver GROUP BY {PERIOD}, payment_type) g"""
    if name == "hourly_demand":
        days = "dayofmonth(last_day(make_date(reference_year, reference_month, 1)))"
        return f"""SELECT {PERIOD}, CAST(hour(pickup_datetime) AS SMALLINT) AS hour_of_day,
  count(*) AS total_trips, {_round2(f'CAST(count(*) AS DOUBLE) / {days}')} AS avg_trips_per_day,
  {_total('total_amount')} AS total_revenue, {_mean('fare_amount')} AS avg_fare_amount
FROM silver GROUP BY {PERIOD}, hour(pickup_datetime)"""
    if name == "zone_avg_fare":
        return f"""SELECT {PERIOD}, pu_location_id, count(*) AS total_trips,
  {_mean('fare_amount')} AS avg_fare_amount, {_mean('total_amount')} AS avg_total_amount,
  {_mean('tip_amount')} AS avg_tip_amount, {_mean('trip_distance')} AS avg_trip_distance,
  {_mean('trip_duration_minutes')} AS avg_duration_minutes
FROM silver GROUP BY {PERIOD}, pu_location_id"""
    raise KeyError(name)


GOLD_NAMES = ["trips_by_day", "trips_by_zone", "payment_summary", "hourly_demand", "zone_avg_fare"]



def stage_sql(key: str, source: str) -> str:
    """Oracle SQL of one registry key (without the source suffix)."""
    if key in _EXTRA_STAGE_SQL:
        return _EXTRA_STAGE_SQL[key](source)
    if key == "raw_trips":
        return _with(source, "raw") + "SELECT * FROM raw"
    if key == "normalized_trips":
        return _with(source, "normalized") + "SELECT * FROM normalized"
    if key == "typed_trips":
        return _with(source, "typed") + "SELECT * FROM typed"
    if key == "filled_trips":
        return _with(source, "filled") + "SELECT * FROM filled"
    if key == "derived_trips":
        return _with(source, "derived") + "SELECT * FROM derived"
    if key == "tagged_trips":
        return _with(source, "tagged") + "SELECT * FROM tagged"
    if key == "clean_trips":
        return _with(source, "clean") + "SELECT * FROM clean"
    if key == "flagged_trips":
        return _with(source, "flagged") + "SELECT * FROM flagged"
    if key == "broken_rules_per_trip":
        bits = " + ".join(f"CASE WHEN {broken} THEN {1 << i} ELSE 0 END" for i, (_, broken) in enumerate(_RULES))
        texts = ", ".join(f"CASE WHEN {broken} THEN '{reason}' END" for reason, broken in _RULES)
        return _with(source, "flagged") + f"SELECT *, CAST({bits} AS INTEGER) AS broken_rules, concat_ws(', ', {texts}) AS reasons FROM flagged"
    if key == "valid_trips":
        return _with(source, "flagged") + "SELECT * EXCLUDE (rejection_reason) FROM flagged WHERE rejection_reason IS NULL"
    if key == "rejected_trips":
        return _with(source, "flagged") + "SELECT * FROM flagged WHERE rejection_reason IS NOT NULL"
    if key in ("silver_clean", "period_replace"):
        return _with(source, "silver") + f"SELECT {_silver_doubles(_SILVER_ORDER)} FROM silver"
    if key == "silver_rejected":
        return _with(source, "rejected") + "SELECT * FROM rejected"
    if key == "validation_stats":
        return _with(source, "flagged") + f"""SELECT {PERIOD}, count(*) AS total,
  count(*) FILTER (WHERE rejection_reason IS NULL) AS total_valid,
  count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS total_rejected,
  {_pct('count(*) FILTER (WHERE rejection_reason IS NOT NULL)', 'count(*)')} AS pct_rejected
FROM flagged GROUP BY {PERIOD}"""
    if key == "rejection_reasons":
        return _with(source, "flagged") + f"""SELECT {PERIOD}, rejection_reason, count(*) AS "count"
FROM flagged WHERE rejection_reason IS NOT NULL GROUP BY {PERIOD}, rejection_reason"""
    if key in GOLD_NAMES:
        return _with(source, "silver") + _gold_sql(key)
    if key == "top_zones":
        return _with(source, "silver") + f"""SELECT {PERIOD}, side, CAST(rank AS INTEGER) AS rank, location_id, total_trips
FROM (SELECT *, row_number() OVER (PARTITION BY {PERIOD}, side ORDER BY total_trips DESC, location_id) AS rank
      FROM (SELECT {PERIOD}, 'pickup' AS side, pu_location_id AS location_id, count(*) AS total_trips
            FROM silver GROUP BY ALL
            UNION ALL
            SELECT {PERIOD}, 'dropoff' AS side, do_location_id AS location_id, count(*) AS total_trips
            FROM silver GROUP BY ALL) z) r
WHERE rank <= 10"""
    if key == "bronze_trips":
        return _with(source, "raw") + stage_body(key)
    raise KeyError(key)


def stage_body(key: str) -> str:
    """The last SELECT of a key, over the stages before it."""
    if key == "bronze_trips":
        return """SELECT source_file, reference_year, reference_month,
  VendorID AS vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
  trip_distance, RatecodeID AS rate_code_id, store_and_fwd_flag, PULocationID AS pu_location_id,
  DOLocationID AS do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, Airport_fee AS airport_fee
FROM raw"""
    raise KeyError(key)


def _load_counts_sql(source: str) -> str:
    gold_keys = {
        "trips_by_day": "CAST(pickup_datetime AS DATE)",
        "trips_by_zone": "pu_location_id",
        "payment_summary": "payment_type",
        "hourly_demand": "hour(pickup_datetime)",
        "zone_avg_fare": "pu_location_id",
    }
    parts = [
        f"""SELECT {PERIOD}, m.metric, m.value FROM (
  SELECT {PERIOD}, count(*) AS total,
         count(*) FILTER (WHERE rejection_reason IS NULL) AS total_valid,
         count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS total_rejected
  FROM flagged GROUP BY {PERIOD}) s,
  LATERAL (VALUES ('total', CAST(total AS DOUBLE)), ('total_valid', CAST(total_valid AS DOUBLE)),
                  ('total_rejected', CAST(total_rejected AS DOUBLE)),
                  ('pct_rejected', {_pct('total_rejected', 'total')})) m(metric, value)""",
        f"SELECT {PERIOD}, 'silver_clean_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM silver GROUP BY {PERIOD}",
        f"SELECT {PERIOD}, 'silver_rejected_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM rejected GROUP BY {PERIOD}",
    ]
    for name, key in gold_keys.items():
        parts.append(
            f"SELECT {PERIOD}, '{name}_rows' AS metric, CAST(count(DISTINCT {key}) AS DOUBLE) AS value "
            f"FROM silver GROUP BY {PERIOD}"
        )
    return _with(source, "rejected") + "\nUNION ALL\n".join(parts)


def write_sql(key: str, source: str) -> str | None:
    """Oracle SQL of the write-and-read-back keys (None: no SQL equivalent)."""
    if key == "staging_roundtrip":
        return stage_sql("flagged_trips", source)
    if key == "period_replace":
        return stage_sql("silver_clean", source)
    if key == "bronze_table":
        return stage_sql("bronze_trips", source)
    if key == "load_counts":
        return _load_counts_sql(source)
    if key == "failed_reload":
        return f"SELECT * FROM ({_load_counts_sql(source)}) t WHERE ends_with(metric, '_rows')"
    if key == "audit_times":
        tables = ", ".join(f"('{k}_rows', '{'.'.join(TABLES[k])}')" for k in TABLES)
        return (f"SELECT t.table_name, {PERIOD}, true AS filled, true AS same_run, reference_month % 2 = 1 AS reloaded "
                f"FROM ({_load_counts_sql(source)}) c JOIN (VALUES {tables}) t(metric, table_name) USING (metric)")
    if key == "stored_checks":
        return _stored_checks_sql(source)
    if key == "valid_trips_scan":
        return _with(source, "flagged") + ("SELECT * EXCLUDE (rejection_reason) FROM flagged "
                                           "WHERE rejection_reason IS NULL AND reference_month <> 6")
    if key == "raw_file_scan":
        return _with(source, "raw") + "SELECT * FROM raw"
    if key == "empty_reload":
        return _with(source, "silver") + f"SELECT {_silver_doubles(_SILVER_ORDER)} FROM silver WHERE reference_month % 2 = 1"
    if key == "file_inventory":
        return _with(source, "raw") + (
            f"SELECT DISTINCT {PERIOD}, source_file AS file_name, reference_month % 3 = 2 AS is_valid FROM raw")
    if key.startswith("loaded_"):
        return stage_sql(key.removeprefix("loaded_"), source)
    return None


def _check_row(table: str, check: str, column: str, count_expr: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
            f"CAST({count_expr} AS BIGINT) AS violations FROM {source}")


def _constraints_sql(source: str) -> str:
    from pyspark.sql.types import DecimalType, StringType

    from tripyard.schema import GOLD_KEYS, LENGTH_LIMITS, TABLE_SCHEMAS

    froms = {
        "bronze": f"({stage_body('bronze_trips')})",
        "silver_clean": "(SELECT * FROM flagged WHERE rejection_reason IS NULL)",
        "silver_rejected": "rejected",
        **{name: f"({_gold_sql(name)})" for name in GOLD_NAMES},
    }
    ctes, rows = [], []
    for key, schema in TABLE_SCHEMAS.items():
        names = [f.name for f in schema]
        numeric = {f.name for f in schema if isinstance(f.dataType, DecimalType)}
        texts = {f.name for f in schema if isinstance(f.dataType, StringType)}
        required = {f.name for f in schema if not f.nullable}
        plain = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if n in numeric else n for n in names)

        def copies(number, change):
            return f"SELECT {', '.join(change(n) for n in names)} FROM p_{key} WHERE reference_month = {number}"

        parts = [f"SELECT * FROM p_{key}", copies(1, lambda n: f"NULL AS {n}" if n in required else n)]
        if numeric:
            parts.append(copies(2, lambda n: f"1e13 AS {n}" if n in numeric else n))
        parts.append(copies(3, lambda n: n))
        if texts:
            parts.append(copies(4, lambda n: f"{n} || repeat('x', 300) AS {n}" if n in texts else n))
        if key == "hourly_demand":
            parts.append(copies(5, lambda n: "24 AS hour_of_day" if n == "hour_of_day" else n))
        ctes += [f"p_{key} AS (SELECT {plain} FROM {froms[key]} t)", f"b_{key} AS ({' UNION ALL '.join(parts)})"]
        t, b = ".".join(TABLES[key]), f"b_{key}"
        for f in schema:
            stored = _money(f.name, f"DECIMAL({f.dataType.precision},{f.dataType.scale})") if f.name in numeric else f.name
            if not f.nullable:
                rows.append(_check_row(t, "not_null", f.name, f"count(*) FILTER (WHERE {stored} IS NULL)", b))
            if f.name in numeric:
                rows.append(_check_row(t, f"numeric_{f.dataType.precision}_{f.dataType.scale}", f.name,
                                       f"count(*) FILTER (WHERE {f.name} IS NOT NULL AND {stored} IS NULL)", b))
        for c, n in LENGTH_LIMITS.get(key, {}).items():
            rows.append(_check_row(t, "max_length", c, f"count(*) FILTER (WHERE length({c}) > {n})", b))
        if key == "hourly_demand":
            rows.append(_check_row(t, "hour_0_23", "hour_of_day", "count(*) FILTER (WHERE hour_of_day NOT BETWEEN 0 AND 23)", b))
        if key in GOLD_KEYS:
            keys = ", ".join(["reference_year", "reference_month"] + GOLD_KEYS[key])
            rows.append(_check_row(t, "unique", keys.replace(", ", ","), "count(*) FILTER (WHERE n > 1)",
                                   f"(SELECT {keys}, count(*) AS n FROM {b} GROUP BY {keys}) k"))
    return _with(source, "rejected").rstrip() + ",\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(rows)


def _stored_checks_sql(source: str) -> str:
    """No stored row breaks a constraint but the gold keys of March, each twice."""
    from pyspark.sql.types import DecimalType

    from tripyard.schema import GOLD_KEYS, LENGTH_LIMITS, TABLE_SCHEMAS

    rows = []
    for key in ("silver_clean", "silver_rejected", *GOLD_NAMES):
        t = ".".join(TABLES[key])
        names = [("not_null", f.name) for f in TABLE_SCHEMAS[key] if not f.nullable]
        names += [(f"numeric_{f.dataType.precision}_{f.dataType.scale}", f.name)
                  for f in TABLE_SCHEMAS[key] if isinstance(f.dataType, DecimalType)]
        names += [("max_length", c) for c in LENGTH_LIMITS.get(key, {})]
        names += [("hour_0_23", "hour_of_day")] if key == "hourly_demand" else []
        rows += [_check_row(t, check, col, "0", "(SELECT 1) one") for check, col in names]
        if key in GOLD_KEYS:
            keys = ",".join(["reference_year", "reference_month"] + GOLD_KEYS[key])
            rows.append(_check_row(t, "unique", keys, "count(*)", f"({_gold_sql(key)}) g WHERE reference_month = 3"))
    return _with(source, "silver") + "\nUNION ALL\n".join(rows)


def _documented_sql(source: str) -> str:
    parts = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "congestion_surcharge", "airport_fee"]
    comp = " + ".join(f"coalesce({p}, CAST(0 AS DOUBLE))" for p in parts)
    return _with(source, "typed") + f"""SELECT {PERIOD}, m.check_name, m.violations, checked FROM (
  SELECT reference_year, reference_month,
         count(*) FILTER (WHERE total_amount IS NOT NULL AND {_round2(f"abs(total_amount - ({comp}))")} > 0.01) AS tm,
         count(*) FILTER (WHERE payment_type IS NULL OR payment_type NOT BETWEEN 1 AND 6) AS pi,
         count(*) AS checked
  FROM typed GROUP BY ALL) s,
  LATERAL (VALUES ('total_amount_mismatch', tm), ('payment_type_invalid', pi)) m(check_name, violations)"""


def _period_calendar_sql(source: str) -> str:
    return _with(source, "raw") + (
        "SELECT CAST(year(m) AS SMALLINT) AS reference_year, CAST(month(m) AS SMALLINT) AS reference_month, "
        "coalesce(n, 0) AS n_rows, n IS NOT NULL AS is_held, year(m) BETWEEN 1993 AND 2024 AS is_valid_period "
        "FROM (SELECT unnest(generate_series(min(make_date(reference_year, reference_month, 1)), "
        "max(make_date(reference_year, reference_month, 1)), INTERVAL 1 MONTH)) AS m FROM raw) c "
        "LEFT JOIN (SELECT make_date(reference_year, reference_month, 1) AS held, count(*) AS n FROM raw GROUP BY 1) r ON c.m = r.held")


_EXTRA_STAGE_SQL = {
    "constraint_violations": _constraints_sql, "documented_checks": _documented_sql, "period_calendar": _period_calendar_sql}
