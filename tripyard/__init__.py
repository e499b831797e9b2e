"""tripyard - monthly taxi-trip cleaning, validation and summaries on Spark.

Raw monthly trip files -> cleaned and typed trips -> ordered rule chain ->
valid / rejected silver tables -> five gold summaries, for any number of
months in one plan, with table constraints run as data checks.

Entry points: ``run`` (monthly files -> warehouse), ``run_frame`` (an already
scanned raw frame), ``Warehouse`` (the partitioned tables),
``read_raw_trips`` (multi-month scan) and ``start_monthly_loads`` (load newly
landed months with Structured Streaming). Operators live in
``tripyard.operators``.
"""

__version__ = "0.1.0"

_EXPORTS = {
    "run": "tripyard.plans.job",
    "run_frame": "tripyard.plans.job",
    "Warehouse": "tripyard.sinks.warehouse",
    "read_raw_trips": "tripyard.sources.raw_files",
    "resolve_periods": "tripyard.sources.raw_files",
    "start_monthly_loads": "tripyard.streaming.landing",
}


def __getattr__(name):
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)
