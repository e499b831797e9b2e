"""Column expressions for codes, rounding and exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripyard.schema import MONEY, UNREPRESENTABLE_CODE


def short_code(c: Column) -> Column:
    """Narrow a code to SMALLINT, truncating toward zero (8.9 -> 8).

    Null stays null (so the null default can apply); a value that is present
    but cannot be a SMALLINT (overflow, NaN) becomes -1, which every range
    rule rejects. A plain cast would throw under ANSI or wrap around without it.
    """
    return F.when(c.isNull(), F.lit(None).cast("smallint")).otherwise(
        F.coalesce(c.try_cast("smallint"), F.lit(UNREPRESENTABLE_CODE).cast("smallint"))
    )


def round2(c: Column) -> Column:
    """Two-decimal HALF_UP rounding (Spark ``round``)."""
    return F.round(c, 2)


def money(c: Column, dtype=MONEY) -> Column:
    """Cast to a fixed-point type; a value out of range (or NaN) becomes null.

    The count of such values is reported by the constraint checks.
    """
    return c.try_cast(dtype)


def rounded_mean(total: Column, n: Column, dtype=MONEY) -> Column:
    """``round(total / n, 2)`` of an exact decimal sum, HALF_UP, null when n = 0.

    Decimal division keeps about 20 fraction digits, so the result is the
    exactly rounded mean even for groups of billions of rows (``avg`` on a
    decimal rounds to 6 digits first, which can round twice).
    """
    return money(F.round(F.try_divide(total, n), 2), dtype)


def rounded_percent(part: Column, whole: Column, dtype) -> Column:
    """``round(part / whole * 100, 2)`` computed exactly, 0 when whole = 0."""
    num = (part * 100).cast("decimal(20,0)")
    pct = F.round(F.try_divide(num, whole.cast("decimal(20,0)")), 2)
    return F.coalesce(money(pct, dtype), F.lit(0).cast(dtype))
