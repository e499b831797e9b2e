"""Rule chain V1-V11, the valid/rejected split (V12-V14) and the two silver
layouts (P8, P9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripyard.functions.numeric import money
from tripyard.functions.periods import period_end, period_start
from tripyard.schema import (
    LOCATION_ID_MAX,
    LOCATION_ID_MIN,
    MAX_PASSENGERS,
    MAX_TRIP_DISTANCE,
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
    REJECTED_SOURCE_COLUMNS,
    SILVER_CLEAN_SCHEMA,
    SILVER_MONEY_COLUMNS,
)

# Month runs stated one by one in a pushed filter.
MAX_PUSHED_RUNS = 12


def rules() -> list[tuple[str, Column]]:
    """V1-V11 in order: (reason, whether a trip breaks the rule; never null).

    Deviations from a literal reading, decided once: a missing period counts
    as out of period (so a bad file name cannot let rows through), and a NaN
    fare is an invalid fare (NaN < 0 is false, and it would poison every sum).
    """
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    # Missing values take one that breaks (or keeps) the rule: comparisons of
    # values that are never null are much less generated code.
    known = lambda name, missing: F.coalesce(F.col(name), F.lit(missing))
    passengers, distance = known("passenger_count", 0), known("trip_distance", 0.0)
    pu, do = known("pu_location_id", LOCATION_ID_MIN - 1), known("do_location_id", LOCATION_ID_MIN - 1)
    fare, tip, rate = known("fare_amount", -1.0), known("tip_amount", 0.0), known("rate_code_id", RATE_CODE_MIN)
    year, month = F.col("reference_year"), F.col("reference_month")
    in_period = (pickup >= period_start(year, month)) & (pickup < period_end(year, month))
    return [
        (REASON_PICKUP_NULL, pickup.isNull()),
        (REASON_DROPOFF_NULL, dropoff.isNull()),
        (REASON_OUT_OF_PERIOD, ~F.coalesce(in_period, F.lit(False))),
        (REASON_DROPOFF_BEFORE, F.coalesce(dropoff <= pickup, F.lit(False))),
        (REASON_PASSENGERS, (passengers <= 0) | (passengers > MAX_PASSENGERS)),
        (REASON_DISTANCE, (distance <= 0) | (distance > MAX_TRIP_DISTANCE)),
        (REASON_PU, (pu < LOCATION_ID_MIN) | (pu > LOCATION_ID_MAX)),
        (REASON_DO, (do < LOCATION_ID_MIN) | (do > LOCATION_ID_MAX)),
        (REASON_FARE, F.isnan(fare) | (fare < 0)),
        (REASON_TIP, tip < 0),
        (REASON_RATE, (rate < RATE_CODE_MIN) | (rate > RATE_CODE_MAX)),
    ]


def broken_rules() -> Column:
    """All broken rules of a trip as an INT: bit i is the rule i of ``rules``."""
    mask = F.lit(0)
    for bit, (_, broken) in enumerate(rules()):
        mask = mask.bitwiseOR(F.shiftleft(broken.cast("int"), bit))
    return mask


def reasons_of(mask: Column) -> Column:
    """The reasons of all broken rules, in order of the rules."""
    return F.array_compact(F.array(*[
        F.when(mask.bitwiseAND(F.lit(1 << bit)) != 0, F.lit(reason)) for bit, (reason, _) in enumerate(rules())]))


def first_reason(mask: Column) -> Column:
    """The reason of the first broken rule (the lowest bit); null for none: the
    lowest bit of 0 is counted past the last reason."""
    reasons = F.array(*[F.lit(reason) for reason, _ in rules()])
    return F.get(reasons, F.bit_count(mask.bitwiseAND(-mask) - 1).cast("int"))


def flag_all_rules(clean: DataFrame) -> DataFrame:
    """V1-V11 with every broken rule kept: ``broken_rules`` (see there) and
    ``rejection_reason``, the first of them.

    The mask is made by a one-row generator: a filter on the reason (valid,
    rejected) then reads it. Out of a projection Catalyst would copy all rules
    with the cleaning under them into the filter, which evaluates every copy
    and is more than the 8000 bytes beyond which HotSpot does not compile a
    method. Filters on other columns still pass through to the scan.
    """
    masked = clean.select("*", F.inline(F.array(F.struct(broken_rules().alias("broken_rules")))))
    return masked.withColumn("rejection_reason", first_reason(F.col("broken_rules")))


def flag_trips(clean: DataFrame) -> DataFrame:
    """Add ``rejection_reason``."""
    return flag_all_rules(clean).drop("broken_rules")


def month_runs(periods: list[tuple[int, int]], most: int = MAX_PUSHED_RUNS) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """The requested months as (first, last) of runs without a gap, in order;
    more than ``most`` runs are joined over the narrowest gaps."""
    numbers = sorted({y * 12 + m - 1 for y, m in periods})
    runs = [[n, n] for n in numbers[:1]]
    for n in numbers[1:]:
        if n == runs[-1][1] + 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    gaps = sorted(range(1, len(runs)), key=lambda i: runs[i][0] - runs[i - 1][1], reverse=True)
    cuts = sorted(gaps[:most - 1])
    edges = zip([0, *cuts], [*cuts, len(runs)], strict=True) if runs else ()
    month = lambda n: (n // 12, n % 12 + 1)
    return [(month(runs[a][0]), month(runs[b - 1][1])) for a, b in edges]


def pickup_in_months(periods: list[tuple[int, int]]) -> Column:
    """Whether the pickup lies in one of these months (or between two of them
    where ``month_runs`` joins runs): comparisons with literals only."""
    pickup = F.col("pickup_datetime")
    inside = F.lit(False)
    for (y0, m0), (y1, m1) in month_runs(periods):
        inside = inside | (
            (pickup >= period_start(F.lit(y0), F.lit(m0))) & (pickup < period_end(F.lit(y1), F.lit(m1))))
    return inside


def split_valid_rejected(
    flagged: DataFrame, periods: list[tuple[int, int]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the reason column; rejected rows with it.
    With ``periods`` both hold these months' rows only.

    The valid filter also states what every valid row satisfies anyway (both
    times present, pickup inside its month) as plain conjuncts. Over a raw scan
    of one month its bounds are literals, so they reach the Parquet reader as
    pushed filters and row groups outside the month are skipped. In a scan of
    several months a row's month comes from its path; the bounds of ``periods``
    are literals there, too, and are pushed in the same way.
    """
    reason = F.col("rejection_reason")
    pickup = F.col("pickup_datetime")
    year, month = F.col("reference_year"), F.col("reference_month")
    implied = (
        pickup.isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (pickup >= period_start(year, month))
        & (pickup < period_end(year, month))
    )
    if periods is not None:
        keys = sorted({y * 100 + m for y, m in periods})
        flagged = flagged.filter((year.cast("int") * 100 + month).isin(keys))
        implied = implied & pickup_in_months(periods)
    valid = flagged.filter(reason.isNull() & implied).drop("rejection_reason")
    return valid, flagged.filter(reason.isNotNull())


def valid_trips(flagged: DataFrame, periods: list[tuple[int, int]] | None = None) -> DataFrame:
    return split_valid_rejected(flagged, periods)[0]


def rejected_trips(flagged: DataFrame, periods: list[tuple[int, int]] | None = None) -> DataFrame:
    return split_valid_rejected(flagged, periods)[1]


def rejected_layout(rejected: DataFrame) -> DataFrame:
    """Silver.rejected_records - lineage, reason and the *cleaned* values
    under ``raw_`` names, in the warehouse column types."""
    return rejected.select(
        "source_file", "reference_year", "reference_month", "rejection_reason",
        *[F.col(n).cast(t).alias("raw_" + n) for n, t in REJECTED_SOURCE_COLUMNS],
    )


def silver_layout(valid: DataFrame) -> DataFrame:
    """P9 + C4: silver.yellow_taxi_clean, 24 columns in table order; measures
    become NUMERIC(10,2) (values out of range become null and are counted by
    the constraint checks instead of failing the whole job)."""
    return valid.select(
        *[
            money(F.col(f.name)).alias(f.name) if f.name in SILVER_MONEY_COLUMNS
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in SILVER_CLEAN_SCHEMA
        ]
    )
