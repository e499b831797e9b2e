"""Warehouse constraints as data checks (C1-C5) and the documented checks the
rule chain does not apply (total versus its components, payment code).

Each check set is one aggregate per table (all columns in one pass); the
result is long-form: (table_name, check_name, column_name, violations).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tripyard.functions.numeric import money
from tripyard.operators.clean import add_lineage, cast_types, normalize_columns
from tripyard.schema import GOLD_KEYS, LENGTH_LIMITS, PERIOD_COLUMNS, TABLE_SCHEMAS, TABLES

# Checks in one generated mask: its code stays small enough to be compiled.
CHECKS_A_MASK = 13
CHECK_COLUMNS = ["table_name", "check_name", "column_name", "violations"]


def _long(table: str, wide: DataFrame, checks: list[tuple[str, str]]) -> DataFrame:
    """The one row of counts c0, c1, ... as one row per check."""
    entries = F.array(
        *[
            F.struct(F.lit(check).alias("check_name"), F.lit(col).alias("column_name"),
                     F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("violations"))
            for i, (check, col) in enumerate(checks)
        ]
    )
    return wide.select(F.inline(entries)).select(F.lit(table).alias("table_name"), "*")


def _numeric_name(t: DecimalType) -> str:
    return f"numeric_{t.precision}_{t.scale}"


def _lost(c: Column, dtype: DecimalType) -> Column:
    """Whether a value is null once it is stored as NUMERIC. Values within one
    of the largest whole number fit for certain; only others (and NaN, null)
    take the cast, which goes through decimal text."""
    whole = float(10 ** min(dtype.precision - dtype.scale, 15) - 1)
    return F.when(c.between(-whole, whole), F.lit(False)).otherwise(money(c, dtype).isNull())


def check_conditions(key: str, when: Column | None = None) -> list[tuple[str, str, Column]]:
    """C1, C3, C4, C5 of a warehouse table as conditions that a row breaking
    them meets, over its rows *before* they are cast to the table's types: NOT
    NULL as stored, NUMERIC(p,s) range, text length, hour range. ``when``
    limits the rows that count."""
    def counted(condition: Column) -> Column:
        return condition if when is None else when & condition

    checks = []
    for f in TABLE_SCHEMAS[key]:
        c = F.col(f.name)
        numeric = isinstance(f.dataType, DecimalType)
        lost = _lost(c, f.dataType) if numeric else c.isNull()
        if not f.nullable:
            checks.append(("not_null", f.name, counted(lost)))
        if numeric:
            checks.append((_numeric_name(f.dataType), f.name, counted(c.isNotNull() & lost)))
    for col, n in LENGTH_LIMITS.get(key, {}).items():
        checks.append(("max_length", col, counted(F.length(col) > n)))
    if key == "hourly_demand":
        checks.append(("hour_0_23", "hour_of_day", counted(~F.col("hour_of_day").between(0, 23))))
    return checks


def check_exprs(key: str, when: Column | None = None) -> list[tuple[str, str, Column]]:
    """``check_conditions`` as aggregates (all columns in one pass)."""
    return [(check, col, F.count_if(condition)) for check, col, condition in check_conditions(key, when)]


def observe_checks(df: DataFrame, name: str, checks: list[tuple[str, str, Column]]):
    """Attach checks (conditions) to ``df`` as observed metrics: they are
    computed by whatever action runs on ``df`` (e.g. its load), with no pass of
    their own. Returns (observed frame, function giving {(check, column): count}).

    Observed metrics are updated row by row outside the fused code of the plan,
    so the conditions become bits of a few INTs inside it, made by a one-row
    generator each, and only these bits are counted.
    """
    obs = Observation(name)
    masked = df
    for first in range(0, len(checks), CHECKS_A_MASK):
        mask = F.lit(0)
        for bit, (_, _, broken) in enumerate(checks[first:first + CHECKS_A_MASK]):
            mask = mask.bitwiseOR(F.when(broken, F.lit(1 << bit)).otherwise(F.lit(0)))
        masked = masked.select("*", F.inline(F.array(F.struct(mask.alias(f"_checks{first}")))))

    def bit(i: int) -> Column:
        return F.col(f"_checks{i - i % CHECKS_A_MASK}").bitwiseAND(F.lit(1 << i % CHECKS_A_MASK))

    observed = masked.observe(obs, *[F.count_if(bit(i) != 0).alias(f"c{i}") for i in range(len(checks))])

    def result() -> dict[tuple[str, str], int]:
        seen = obs.get
        return {(check, col): int(seen[f"c{i}"]) for i, (check, col, _) in enumerate(checks)}

    return observed.select(*df.columns), result


def table_name(key: str) -> str:
    return ".".join(TABLES[key])


def table_checks(key: str, rows: DataFrame) -> DataFrame:
    """All constraints of one table over its rows, in one scan: for C2 (unique)
    gold rows are first grouped by key, with their other checks counted in the
    same grouping."""
    checks = [(check, col) for check, col, _ in check_exprs(key)]
    counts = [expr.alias(f"c{i}") for i, (_, _, expr) in enumerate(check_exprs(key))]
    if key in GOLD_KEYS:
        keys = PERIOD_COLUMNS + GOLD_KEYS[key]
        per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *counts)
        counts = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(checks))]
        counts.append(F.count_if(F.col("n") > 1).alias(f"c{len(checks)}"))
        return _long(table_name(key), per_key.agg(*counts), [*checks, ("unique", ",".join(keys))])
    return _long(table_name(key), rows.agg(*counts), checks)


def stored_violations(warehouse, periods: list[tuple[int, int]] | None = None, keys: list[str] | None = None) -> DataFrame:
    """C1-C5 over what tables hold (of the given periods: those that changed;
    partitions of other periods are not read). Finds what came in beside the
    loads, such as rows appended twice."""
    return constraint_violations({key: warehouse.read(key, periods) for key in keys or TABLE_SCHEMAS})


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """The checks of several tables, from the rows to be stored in them."""
    return reduce(DataFrame.unionByName, [table_checks(key, rows) for key, rows in tables.items()])


class ConstraintViolation(ValueError):
    """Rows that a warehouse table would not take; nothing was replaced."""

    def __init__(self, found: dict[tuple[str, str, str], int]):
        self.found = {k: n for k, n in found.items() if n}
        super().__init__("; ".join(f"{t}.{c}: {n} rows break {check}" for (t, check, c), n in sorted(self.found.items())))


def require_none(found: dict[tuple[str, str, str], int]) -> None:
    if any(found.values()):
        raise ConstraintViolation(found)


def documented_checks(raw: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Checks written down but not in the rule chain, per period, counted on
    the typed trips before null defaults (so a missing payment code shows):

    * total_amount_mismatch - total differs from the sum of its components
      (fare, extra, mta tax, tip, tolls, improvement and congestion
      surcharges, airport fee; missing parts count as 0) by more than
      ``tolerance``, the difference rounded to cents first (so one cent
      is one cent, not 0.010000000000001563);
    * payment_type_invalid - payment code missing or outside 1..6.
    """
    typed = add_lineage(cast_types(normalize_columns(raw)))
    parts = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "congestion_surcharge", "airport_fee"]
    components = F.coalesce(F.col(parts[0]), F.lit(0.0))
    for p in parts[1:]:
        components = components + F.coalesce(F.col(p), F.lit(0.0))
    total = F.col("total_amount")
    pay = F.col("payment_type")
    counts = typed.groupBy(*PERIOD_COLUMNS).agg(
        F.count_if(total.isNotNull() & (F.round(F.abs(total - components), 2) > tolerance))
        .alias("total_amount_mismatch"),
        F.count_if(pay.isNull() | ~pay.between(1, 6)).alias("payment_type_invalid"),
        F.count(F.lit(1)).alias("checked"),
    )
    return counts.select(
        *PERIOD_COLUMNS,
        F.inline(F.array(
            F.struct(F.lit("total_amount_mismatch").alias("check_name"),
                     F.col("total_amount_mismatch").alias("violations")),
            F.struct(F.lit("payment_type_invalid").alias("check_name"),
                     F.col("payment_type_invalid").alias("violations")),
        )),
        "checked",
    )
