"""Reference-period expressions. A period is a pair of SMALLINT columns
(reference_year, reference_month), never a driver constant, so one plan serves
one month or many."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripyard.schema import RAW_FILE_PATTERN


def period_start(year: Column, month: Column) -> Column:
    """First instant of the month, TIMESTAMP_NTZ (inclusive bound)."""
    return F.make_date(year, month, F.lit(1)).cast("timestamp_ntz")


def period_end(year: Column, month: Column) -> Column:
    """First instant of the next month, TIMESTAMP_NTZ (exclusive bound)."""
    return F.add_months(F.make_date(year, month, F.lit(1)), 1).cast("timestamp_ntz")


def days_in_month(year: Column, month: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))


def raw_file_name(year: Column, month: Column) -> Column:
    """Monthly raw file name for a period, e.g. yellow_tripdata_2024-01.parquet."""
    return F.concat(
        F.lit("yellow_tripdata_"), F.lpad(year.cast("string"), 4, "0"), F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"), F.lit(".parquet"),
    )


def file_name_from_path(path: Column) -> Column:
    """The monthly file name inside a path (the file itself, or the directory a
    Spark writer made for it); the last path component if none is found."""
    found = F.regexp_extract(path, RAW_FILE_PATTERN, 0)
    return F.when(found != "", found).otherwise(F.element_at(F.split(path, "/"), -1))


def year_from_path(path: Column) -> Column:
    return F.regexp_extract(path, RAW_FILE_PATTERN, 1).try_cast("smallint")


def month_from_path(path: Column) -> Column:
    return F.regexp_extract(path, RAW_FILE_PATTERN, 2).try_cast("smallint")
