"""Validation statistics (A6) and the rejection-reason distribution.

Both are one hash aggregate over the flagged trips, partial aggregation
map-side, so a period holding most rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.functions.numeric import rounded_percent
from tripyard.schema import PERIOD_COLUMNS


def validation_stats(flagged: DataFrame) -> DataFrame:
    """Per period: total, total_valid, total_rejected, pct_rejected (2 decimals)."""
    counts = flagged.groupBy(*PERIOD_COLUMNS).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("rejection_reason").isNull()).alias("total_valid"),
    )
    return counts.select(
        *PERIOD_COLUMNS,
        "total",
        "total_valid",
        (F.col("total") - F.col("total_valid")).alias("total_rejected"),
        rounded_percent(F.col("total") - F.col("total_valid"), F.col("total"), "decimal(5,2)")
        .cast("double")
        .alias("pct_rejected"),
    )


def rejection_reasons(flagged: DataFrame) -> DataFrame:
    """Per period and reason: rejected row count, most frequent first."""
    rejected = flagged.filter(F.col("rejection_reason").isNotNull())
    return (
        rejected.groupBy(*PERIOD_COLUMNS, "rejection_reason")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(*PERIOD_COLUMNS, F.desc("count"), "rejection_reason")
    )
