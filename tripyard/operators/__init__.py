"""DataFrame -> DataFrame operators: cleaning, rules, statistics, gold, checks."""

from tripyard.operators.clean import (
    add_lineage,
    bronze_layout,
    cast_types,
    clean_trips,
    derive_fields,
    normalize_columns,
    treat_nulls,
)
from tripyard.operators.gold import (
    gold_partials,
    gold_table,
    gold_tables,
    hourly_demand,
    payment_summary,
    top_zones,
    trips_by_day,
    trips_by_zone,
    zone_avg_fare,
)
from tripyard.operators.stats import rejection_reasons, validation_stats
from tripyard.operators.validate import (
    flag_trips,
    rejected_layout,
    rejected_trips,
    silver_layout,
    split_valid_rejected,
    valid_trips,
)

__all__ = [
    "add_lineage", "bronze_layout", "cast_types", "clean_trips", "derive_fields",
    "flag_trips", "gold_partials", "gold_table", "gold_tables", "hourly_demand",
    "normalize_columns", "payment_summary", "rejected_layout", "rejected_trips",
    "rejection_reasons", "silver_layout", "split_valid_rejected", "top_zones",
    "treat_nulls", "trips_by_day", "trips_by_zone", "valid_trips", "validation_stats",
    "zone_avg_fare",
]
