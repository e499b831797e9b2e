"""Monthly raw trip files: period arguments (S4, S5), paths (S2), the file
inventory check (S3) and the explicit-schema scan of many months (S1).
"""

from __future__ import annotations

import datetime as _dt
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from tripyard.functions.periods import file_name_from_path
from tripyard.schema import (
    FIRST_YEAR,
    LINEAGE_COLUMNS,
    MIN_RAW_FILE_BYTES,
    RAW_FILE_NAME,
    RAW_FILE_PATTERN,
    RAW_SCHEMA,
    RENAMES,
    SHORT_COLUMNS,
    UNREPRESENTABLE_CODE,
)

# Where a month's raw file lives under a landing root. The flat layout is the
# published one; the second is what a Spark writer makes when the raw rows are
# landed with partitionBy on the file name (used by tests).
FLAT_LAYOUT = "{root}/" + RAW_FILE_NAME
SPARK_LAYOUT = "{root}/file=" + RAW_FILE_NAME
FOOTER_READERS = 16
FOOTER_TASKS_PER_CORE = 4
# Where Spark keeps a row's schema in a footer (fixed value of the format).
SPARK_FOOTER_KEY = b"org.apache.spark.sql.parquet.row.metadata"


def check_period(year: int, month: int, first_year: int = FIRST_YEAR, last_year: int | None = None) -> None:
    """Year in first_year..last_year (default: this year), month in 1..12."""
    last_year = _dt.date.today().year if last_year is None else last_year
    if not (first_year <= year <= last_year):
        raise ValueError(f"invalid year {year}: expected {first_year}..{last_year}")
    if not (1 <= month <= 12):
        raise ValueError(f"invalid month {month}: expected 1..12")


def month_range(start: tuple[int, int], end: tuple[int, int]) -> list[tuple[int, int]]:
    """Every (year, month) from start to end inclusive (a reprocessing range)."""
    (y, m), out = start, []
    while (y, m) <= end:
        out.append((y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def resolve_periods(
    periods=None, start=None, end=None, first_year: int = FIRST_YEAR, last_year: int | None = None
) -> list[tuple[int, int]]:
    """Explicit periods win; otherwise a start..end range. Each is checked."""
    if periods:
        out = sorted({(int(y), int(m)) for y, m in periods})
    elif start and end:
        out = month_range(tuple(start), tuple(end))
    else:
        raise ValueError("give periods, or start and end")
    for y, m in out:
        check_period(y, m, first_year, last_year)
    return out


def periods_frame(spark: SparkSession, periods: list[tuple[int, int]]) -> DataFrame:
    """The requested periods as a small DataFrame (reference_year, reference_month)."""
    return spark.createDataFrame(
        [(y, m) for y, m in periods], "reference_year smallint, reference_month smallint"
    )


def period_range_frame(spark: SparkSession, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """S5 as a DataFrame: every month from start to end inclusive, built by
    Spark (``sequence`` of month starts, exploded)."""
    months = F.explode(
        F.sequence(
            F.make_date(F.lit(start[0]), F.lit(start[1]), F.lit(1)),
            F.make_date(F.lit(end[0]), F.lit(end[1]), F.lit(1)),
            F.expr("INTERVAL 1 MONTH"),
        )
    ).alias("month_start")
    return spark.range(1).select(months).select(
        F.year("month_start").cast("smallint").alias("reference_year"),
        F.month("month_start").cast("smallint").alias("reference_month"),
    )


def period_calendar(observed: DataFrame, first_year: int = FIRST_YEAR, last_year: int | None = None) -> DataFrame:
    """S4/S5 as a relation: every month from the first to the last of ``observed``
    (reference_year, reference_month, one row or many a month), with its rows,
    whether it is held at all (a gap otherwise) and whether S4 takes its year.

    Only months reach the join: rows are counted before it. Null or impossible
    months are left out; without any month the calendar is empty."""
    last_year = _dt.date.today().year if last_year is None else last_year
    year, month = F.col("reference_year").cast("int"), F.col("reference_month").cast("int")
    counted = observed.where(month.between(1, 12) & year.isNotNull()).groupBy((year * 12 + month - 1).alias("month_no")).agg(F.count(F.lit(1)).alias("n_rows"))
    ends = counted.agg(F.min("month_no").alias("lo"), F.max("month_no").alias("hi")).where("lo IS NOT NULL")
    months = ends.select(F.explode(F.sequence("lo", "hi")).alias("month_no"))
    held_year = F.floor(F.col("month_no") / 12)
    return months.join(counted, "month_no", "left").select(
        held_year.cast("smallint").alias("reference_year"),
        (F.col("month_no") - held_year * 12 + 1).cast("smallint").alias("reference_month"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.col("n_rows").isNotNull().alias("is_held"),
        held_year.between(first_year, last_year).alias("is_valid_period"),
    )


def raw_file_path(root: str, year: int, month: int, layout: str = FLAT_LAYOUT) -> str:
    """The path of a month's raw file."""
    return layout.format(root=root.rstrip("/"), year=year, month=month)


def listed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length) of the Parquet files at exactly these paths (a file, or a
    directory of parts); paths that do not exist list nothing.

    The listing is Spark's binaryFile source over one glob per parent folder,
    with only path and length selected, so no content is read and nothing
    else below the parent is listed.
    """
    by_parent: dict[str, list[str]] = {}
    for p in paths:
        parent, _, name = p.rstrip("/").rpartition("/")
        by_parent.setdefault(parent, []).append(name)
    none = spark.createDataFrame([], "path string, length bigint")
    out = none
    for parent, names in sorted(by_parent.items()):
        # the last choice never exists: a glob, so that a missing path is no error
        glob = f"{parent}/{{{','.join(sorted(names))},none}}"
        try:
            found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(glob).select("path", "length")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out = out.unionByName(found)
    return out


def inventory_of(spark: SparkSession, months: dict[tuple[int, int], str], min_bytes: int = MIN_RAW_FILE_BYTES) -> DataFrame:
    """S3 for given paths: per month - expected path, size in MB (2 decimals)
    and whether it exists and is larger than ``min_bytes``. A month written by
    Spark as a directory of parts counts with the sum of its parts."""
    listing = (
        listed_files(spark, list(months.values()))
        .select(file_name_from_path(F.col("path")).alias("file_name"), "length")
        .groupBy("file_name")
        .agg(F.sum("length").alias("size_bytes"))
    )
    expected = spark.createDataFrame(
        [(y, m, path, RAW_FILE_NAME.format(year=y, month=m)) for (y, m), path in sorted(months.items())],
        "reference_year smallint, reference_month smallint, path string, file_name string",
    )
    size = F.coalesce(F.col("size_bytes"), F.lit(0))
    return expected.join(listing, "file_name", "left").select(
        "reference_year",
        "reference_month",
        "path",
        F.round(size / (1024 * 1024), 2).alias("size_mb"),
        (size > min_bytes).alias("is_valid"),
    )


def file_inventory(
    spark: SparkSession,
    root: str,
    periods: list[tuple[int, int]],
    min_bytes: int = MIN_RAW_FILE_BYTES,
    layout: str = FLAT_LAYOUT,
) -> DataFrame:
    """S3: the inventory of the requested periods' expected paths. Files of
    these names elsewhere below the root do not count."""
    return inventory_of(spark, {(y, m): raw_file_path(root, y, m, layout) for y, m in periods}, min_bytes)


def require_valid_files(inventory: DataFrame) -> None:
    """Stop the run when a requested month has no usable raw file (the
    inventory has one row per requested period, so it is small)."""
    bad = inventory.filter(~F.col("is_valid")).collect()
    if bad:
        listed = ", ".join(f"{r.path} ({r.size_mb} MB)" for r in bad)
        raise ValueError(f"invalid raw files: {listed}")


def period_of_path(path: str) -> tuple[str, int, int]:
    """(file name, year, month) of a monthly raw file path (S2 naming)."""
    found = re.search(RAW_FILE_PATTERN, path)
    if not found:
        raise ValueError(f"not a monthly raw file path: {path}")
    return found.group(0), int(found.group(1)), int(found.group(2))


def _raw_columns(df: DataFrame) -> list[Column]:
    """The 19 raw columns of a scan, matched case-insensitively and cast to the
    raw types; absent columns are null. A code that is present but does not
    fit its type becomes -1 (which the range rules reject), never null: null
    would take the default of a missing value. Zone-aware times are read as
    UTC wall clock, whatever the session zone."""
    present = {c.lower(): c for c in df.columns}
    out = []
    for f in RAW_SCHEMA:
        found = present.get(f.name.lower())
        if found is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        col = F.col(found)
        if isinstance(df.schema[found].dataType, TimestampType) and isinstance(f.dataType, TimestampNTZType):
            col = F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz"))
        fitted = col.try_cast(f.dataType)
        if RENAMES.get(f.name, f.name) in SHORT_COLUMNS:
            fitted = F.when(col.isNotNull() & fitted.isNull(), F.lit(UNREPRESENTABLE_CODE).cast(f.dataType)).otherwise(fitted)
        out.append(fitted.alias(f.name))
    return out


def _scan(spark: SparkSession, schema: StructType, files: list[str], months: list[str]) -> DataFrame:
    """One scan of files that share a schema. The lineage of a single month is
    constant (so month bounds reach the Parquet reader); of several months it
    is parsed from each file's path."""
    df = spark.read.schema(schema).parquet(*files)
    if len(months) == 1:
        name, year, month = period_of_path(months[0])
        name, year, month = F.lit(name), F.lit(year), F.lit(month)
    else:
        name = F.regexp_extract("_metadata.file_path", RAW_FILE_PATTERN, 0)
        year, month = (F.regexp_extract("_metadata.file_path", RAW_FILE_PATTERN, k) for k in (1, 2))
    return df.select(
        *_raw_columns(df),
        name.alias("source_file"),
        year.cast("smallint").alias("reference_year"),
        month.cast("smallint").alias("reference_month"),
    )


def _merged_schema(spark: SparkSession, files: list[str]) -> StructType | None:
    """The schema that holds all columns of these files (their footers are read
    by one Spark job), or None if a column's type differs between them."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
        return None


def footer_layouts(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, layout) of Parquet files, in one job that reads footers only: the
    paths are spread over tasks, each opens its files by itself. A layout is the
    columns' names and types and Spark's own row schema as text, so files of
    equal layout have equal schemas. A file that a task cannot open (a store
    or credentials that only Hadoop knows) has a null layout."""
    row_schema_key = SPARK_FOOTER_KEY

    # Nested, so that tasks get the code itself and need not import this package.
    def layout_of(path: str) -> str | None:
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        try:
            if path.startswith("file:"):
                store, inner = pafs.LocalFileSystem(), re.sub("^file:/+", "/", path)
            else:  # Hadoop has other names for the same store
                store, inner = pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
            with store.open_input_file(inner) as handle:
                footer = pq.read_metadata(handle)
        except (pa.ArrowException, OSError, ValueError):
            return None
        columns = (footer.schema.column(i) for i in range(footer.num_columns))
        fields = sorted(f"{c.path.lower()}:{c.physical_type}:{c.logical_type}" for c in columns)
        row_schema = (footer.metadata or {}).get(row_schema_key, b"").decode()
        return ",".join(fields) + "|" + row_schema.lower()

    def layouts(batches):
        for batch in batches:
            yield batch.assign(layout=[layout_of(path) for path in batch["path"]])

    paths = spark.createDataFrame([(f,) for f in files], "path string")
    tasks = max(1, min(len(files), spark.sparkContext.defaultParallelism * FOOTER_TASKS_PER_CORE))
    return paths.repartition(tasks).mapInPandas(layouts, "path string, layout string")


def _schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """(schema, files) groups covering ``files``: all together if their footers
    fit, else one group for each distinct layout. The layouts are found by one
    job and Spark reads one file of each, so the jobs follow the layouts, not
    the files. Files whose footers the tasks could not open are read by Spark,
    each by a small job (FOOTER_READERS at a time)."""
    found = _merged_schema(spark, files)
    if found is not None:
        return [(found, files)]
    by_layout: dict[str | None, list[str]] = {}
    for r in footer_layouts(spark, files).collect():
        by_layout.setdefault(r.layout, []).append(r.path)
    unread = by_layout.pop(None, [])
    alike = [sorted(group) for group in by_layout.values()] + [[f] for f in unread]
    with ThreadPoolExecutor(max_workers=FOOTER_READERS) as pool:
        schemas = list(pool.map(lambda group: spark.read.parquet(group[0]).schema, alike))
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for schema, group in zip(schemas, alike, strict=True):
        key = ",".join(sorted(f"{f.name.lower()}:{f.dataType.simpleString()}" for f in schema))
        groups.setdefault(key, (schema, []))[1].extend(group)
    return list(groups.values())


def read_raw_trips(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Scan many monthly files under the fixed 19-column raw schema.

    Files differ in physical types (e.g. INT64 vs DOUBLE for a count), in name
    case and in which columns exist, also between the parts of one month; one
    explicit-schema read fails on such a mix. Files whose footers fit together
    are one scan under the merged schema of their footers, so the plan grows
    with the number of distinct layouts, not of months; the scans are combined
    with unionByName, and every file split is scanned in parallel.
    """
    if not paths:
        raise ValueError("no raw files given")
    by_name = {period_of_path(p)[0]: p for p in paths}
    if len(by_name) != len(paths):
        raise ValueError("a month is given twice")
    listed = sorted((period_of_path(r.path)[0], r.path) for r in listed_files(spark, paths).select("path").collect())
    missing = sorted(set(by_name) - {name for name, _ in listed})
    if missing:
        raise ValueError(f"no raw files at {', '.join(by_name[m] for m in missing)}")
    frames = [
        _scan(spark, schema, files, sorted({period_of_path(f)[0] for f in files}))
        for schema, files in _schema_groups(spark, [f for _, f in listed])
    ]
    return reduce(DataFrame.unionByName, frames)


def land_raw_files(raw: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Write raw trips (with lineage) as monthly raw files under ``root`` in
    SPARK_LAYOUT, in one job; the files hold the 19 raw columns only. The
    rebalance hint lets AQE split a month holding most rows over many tasks."""
    (
        raw.withColumn("file", F.col("source_file"))
        .drop(*LINEAGE_COLUMNS)
        .hint("rebalance", "file")
        .write.mode(mode)
        .partitionBy("file")
        .parquet(root)
    )
