"""Structured Streaming entry: load newly landed monthly files."""

from tripyard.streaming.landing import start_monthly_loads

__all__ = ["start_monthly_loads"]
