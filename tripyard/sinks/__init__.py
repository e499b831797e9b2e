"""Sinks: staging Parquet and the period-partitioned warehouse tables."""

from tripyard.sinks.warehouse import Warehouse, read_staging, write_staging

__all__ = ["Warehouse", "read_staging", "write_staging"]
