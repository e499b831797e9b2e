"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from tripyard.functions.numeric import money, rounded_mean, rounded_percent, round2, short_code
from tripyard.functions.periods import (
    days_in_month,
    file_name_from_path,
    month_from_path,
    period_end,
    period_start,
    raw_file_name,
    year_from_path,
)

__all__ = [
    "days_in_month", "file_name_from_path", "money", "month_from_path",
    "period_end", "period_start", "raw_file_name", "round2", "rounded_mean",
    "rounded_percent", "short_code", "year_from_path",
]
