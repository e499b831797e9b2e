"""Cleaning steps P1-P7: pure DataFrame -> DataFrame functions.

Every step is a projection; Catalyst folds the whole chain into one Project
next to the scan (one whole-stage-codegen span, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.functions.numeric import round2, short_code
from tripyard.functions.periods import file_name_from_path, month_from_path, year_from_path
from tripyard.schema import (
    CLEAN_COLUMNS,
    LINEAGE_COLUMNS,
    NULL_DEFAULTS,
    RAW_SCHEMA,
    RENAMES,
    ROUNDED_COLUMNS,
    SHORT_COLUMNS,
)


def normalize_columns(raw: DataFrame) -> DataFrame:
    """The 19 raw columns in file order, snake_case names; lineage kept."""
    keep = [c for c in (*LINEAGE_COLUMNS, "source_path") if c in raw.columns]
    return raw.select(
        *[F.col(f.name).alias(RENAMES.get(f.name, f.name)) for f in RAW_SCHEMA], *keep
    )


def cast_types(df: DataFrame) -> DataFrame:
    """Six code columns to SMALLINT (truncating), four measures rounded to 2."""
    return df.withColumns(
        {**{c: short_code(F.col(c)) for c in SHORT_COLUMNS},
         **{c: round2(F.col(c)) for c in ROUNDED_COLUMNS}}
    )


def treat_nulls(df: DataFrame) -> DataFrame:
    """Null defaults (NaN in the double columns counts as null)."""
    return df.fillna(NULL_DEFAULTS)


def derive_fields(df: DataFrame) -> DataFrame:
    """Duration in minutes from whole epoch seconds; speed from the
    rounded distance and duration, null unless both are positive."""
    seconds = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    df = df.withColumn("trip_duration_minutes", round2(seconds / 60.0))
    duration, distance = F.col("trip_duration_minutes"), F.col("trip_distance")
    return df.withColumn(
        "trip_speed_mph",
        F.when((duration > 0) & (distance > 0), round2(distance / (duration / 60.0))),
    )


def add_lineage(df: DataFrame) -> DataFrame:
    """Reference period (SMALLINT) and source file name of every row.

    Sources attach them where the file is known (constants per scanned
    month, so no per-row work); a frame that only has the path of its file
    (``source_path``) gets them parsed from that path.
    """
    if "source_path" in df.columns:
        path = F.col("source_path")
        df = df.withColumns(
            {
                "reference_year": year_from_path(path),
                "reference_month": month_from_path(path),
                "source_file": file_name_from_path(path),
            }
        ).drop("source_path")
    return df.withColumns(
        {
            "reference_year": F.col("reference_year").cast("smallint"),
            "reference_month": F.col("reference_month").cast("smallint"),
            "source_file": F.col("source_file").cast("string"),
        }
    )


def clean_trips(raw: DataFrame) -> DataFrame:
    """P1 -> P2 -> P3 -> P4/P5 -> P6 (fill after cast and round)."""
    return (
        raw.transform(normalize_columns)
        .transform(cast_types)
        .transform(treat_nulls)
        .transform(derive_fields)
        .transform(add_lineage)
        .select(*CLEAN_COLUMNS)
    )


def bronze_layout(raw: DataFrame) -> DataFrame:
    """raw.yellow_taxi: lineage plus the raw values, untouched, under the
    warehouse column names (the load time is added by the sink)."""
    bronze_names = {**RENAMES, "tpep_pickup_datetime": "tpep_pickup_datetime",
                    "tpep_dropoff_datetime": "tpep_dropoff_datetime"}
    tagged = add_lineage(raw)
    return tagged.select(
        *LINEAGE_COLUMNS,
        *[F.col(f.name).alias(bronze_names.get(f.name, f.name)) for f in RAW_SCHEMA],
    )
