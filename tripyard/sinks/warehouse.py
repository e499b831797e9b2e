"""Sinks: staging Parquet (S6-S8), warehouse tables (S15) and all-or-nothing
period replacement (S9-S13).

Every warehouse table is a Parquet table partitioned by
(reference_year, reference_month), and each period is a pointer to a folder:

* ``prepare`` writes a load's rows in ONE job into a version folder of its own,
  beside everything that is stored, and counts them on that write (one bounded
  histogram of the periods, no second pass). Readers see nothing of it.
* ``switch`` points the periods of one or of many tables at their prepared
  folders: new periods are added, old ones moved by ``SET LOCATION``, requested
  periods without rows dropped - an empty reload empties the period, as a
  delete-then-append would. It only changes the catalog, after all rows of all
  tables have been written and checked, so whatever fails before it leaves the
  old periods in place.
* The switch is logged first (``_loads`` under the warehouse root: every
  period's new folder, as one small file, and its end as another).
  ``create_tables`` carries out a switch that was logged but not ended, so
  a driver lost in the middle leaves no mixture of old and new tables behind;
  it also points the periods of a fresh catalog at their folders.
* A period's old folder stays until ``remove_old_versions`` takes it away, so
  queries that began before a switch keep their files.

One load at a time writes to a warehouse.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tripyard.schema import PERIOD_COLUMNS, TABLE_SCHEMAS, TABLES

# Audit column of each table, filled with the load time (not compared).
AUDIT_COLUMNS = {
    "bronze": "loaded_at",
    "silver_clean": "processed_at",
    "silver_rejected": "rejected_at",
}
_GOLD_AUDIT = "refreshed_at"


def period_key(year: Column, month: Column) -> Column:
    return year.cast("int") * 100 + month.cast("int")


def in_periods(periods: list[tuple[int, int]] | None) -> Column:
    """Filter on the period columns (prunes partitions of partitioned inputs)."""
    if periods is None:
        return F.lit(True)
    keys = sorted({y * 100 + m for y, m in periods})
    return period_key(F.col("reference_year"), F.col("reference_month")).isin(keys)


def group_counts(key: Column, groups: int) -> Column:
    """Rows for each value of an integer key, as one aggregate for ``observe``:
    a histogram that has a bin for each of at most ``groups`` values. Its size
    is bounded by them, its cost a row does not depend on them."""
    return F.histogram_numeric(key.cast("double"), F.lit(max(groups, 2)))


def counts_seen(bins) -> dict[int, int]:
    """{key: rows} of an observed ``group_counts``."""
    out: dict[int, int] = {}
    for b in bins or []:
        out[round(b["x"])] = out.get(round(b["x"]), 0) + round(b["y"])
    return out


def staging_counts_exprs(periods: list[tuple[int, int]]) -> list[Column]:
    """Metrics to observe on flagged trips of these periods (see staged_counts_seen)."""
    key = period_key(F.col("reference_year"), F.col("reference_month"))
    return [group_counts(key * 2 + F.col("rejection_reason").isNull().cast("int"), 2 * len(periods)).alias("by_period")]


def staged_counts_seen(seen: dict, periods: list[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int]]:
    """(rows, valid rows) per requested month from the metrics observed on the
    staging write."""
    n = counts_seen(seen["by_period"])
    keys = {p: 2 * (p[0] * 100 + p[1]) for p in periods}
    return {p: (n.get(k, 0) + n.get(k + 1, 0), n.get(k + 1, 0)) for p, k in keys.items()}


def write_staging(flagged: DataFrame, root: str, rebalance: bool = False) -> None:
    """Cleaned and flagged trips, partitioned by period and validity, in
    one pass (the valid and rejected sets are partitions, not extra writes).
    Write each run to a fresh ``root`` so every partition in it is this run's.

    Without ``rebalance`` rows go straight to the writer: when the input is
    monthly files every task holds one month, so no shuffle is needed. With
    it, AQE rebalances by period and validity, for inputs whose tasks mix
    months: from the counted bytes of each it splits a month that holds most
    rows over many tasks, while its few rejected rows stay one file instead of
    a piece in each of these tasks. Files follow the advisory partition size.
    """
    out = flagged.withColumn("is_valid", F.col("rejection_reason").isNull())
    if rebalance:
        out = out.hint("rebalance", *PERIOD_COLUMNS, "is_valid")
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PERIOD_COLUMNS, "is_valid")
        .parquet(root)
    )


def staging_schema(flagged: DataFrame) -> StructType:
    """Schema of the staging table written from ``flagged``."""
    return StructType(flagged.schema.fields + [StructField("is_valid", BooleanType())])


def read_staging(
    spark: SparkSession, root: str, periods=None, valid: bool | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Staging read back; period and validity filters prune partitions.
    Partition columns come back as int from paths, so they are narrowed again.
    With ``schema`` (see staging_schema) a run whose months were all empty
    reads back as empty instead of failing schema inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(root).filter(in_periods(periods))
    if valid is not None:
        df = df.filter(F.col("is_valid") == F.lit(valid))
    return df.withColumns({c: F.col(c).cast("smallint") for c in PERIOD_COLUMNS})


LOG_SCHEMA = ("load_id string, logged string, started string, key string, reference_year int, "
              "reference_month int, location string")


def _utc(moment: dt.datetime) -> dt.datetime:
    """A moment with a zone; one without is UTC."""
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


@dataclass(frozen=True)
class PreparedLoad:
    """Rows written beside a table, not yet its own: their folder, and how many
    there are for each period to be replaced."""

    key: str
    version: str
    rows: dict[tuple[int, int], int]


class Warehouse:
    """The three namespaces (raw, silver, gold) of partitioned tables under
    one root folder. ``prefix`` keeps parallel warehouses apart."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self._replaceable: set[str] = set()

    def _require_dynamic_overwrite(self, table: str) -> None:
        """Refuse to load a table that lacks the dynamic-overwrite option (one
        made elsewhere, kept by IF NOT EXISTS): it isn't this warehouse's, and
        an overwrite would replace every period of it."""
        if table in self._replaceable:
            return
        props = [
            r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
            if r.col_name == "Storage Properties"
        ]
        if not any("partitionOverwriteMode=dynamic" in p for p in props):
            raise ValueError(
                f"{table} does not replace partitions dynamically; recreate it with "
                "OPTIONS ('partitionOverwriteMode' 'dynamic') before loading"
            )
        self._replaceable.add(table)

    def table(self, key: str) -> str:
        ns, name = TABLES[key]
        return f"{self.prefix}{ns}.{name}"

    def create_tables(self) -> None:
        """Namespaces and tables, created only when absent; then
        ``recover``.

        The tables carry dynamic partition overwrite as their own option (a
        writer option is not applied by insertInto, and the session setting
        belongs to the user): an INSERT OVERWRITE of a user replaces only the
        periods it writes."""
        for ns in sorted({ns for ns, _ in TABLES.values()}):
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{ns} LOCATION '{self.root}/_catalog/{ns}'"
            )
        for key, schema in TABLE_SCHEMAS.items():
            audit = AUDIT_COLUMNS.get(key, _GOLD_AUDIT)
            cols = [f"{f.name} {f.dataType.simpleString()}" for f in schema] + [f"{audit} timestamp"]
            ns, name = TABLES[key]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table(key)} ({', '.join(cols)}) "
                f"USING parquet OPTIONS ('partitionOverwriteMode' 'dynamic') "
                f"PARTITIONED BY ({', '.join(PERIOD_COLUMNS)}) "
                f"LOCATION '{self.root}/{ns}/{name}'"
            )
        self.recover()

    def read(self, key: str, periods=None) -> DataFrame:
        """A table without its audit column; the period filter prunes partitions."""
        audit = AUDIT_COLUMNS.get(key, _GOLD_AUDIT)
        return self.spark.table(self.table(key)).filter(in_periods(periods)).drop(audit)

    def files(self, key: str) -> DataFrame:
        """A table's stored files, read by path; it stays readable when the
        catalog entry is dropped. The audit column is named ``loaded_at``."""
        audit = AUDIT_COLUMNS.get(key, _GOLD_AUDIT)
        schema = self.spark.table(self.table(key)).schema
        folders: dict[str, list[str]] = {}
        for (y, m), version in sorted(self._logged().get(key, {}).items()):
            if version:
                folders.setdefault(version, []).append(f"{version}/reference_year={y}/reference_month={m}")
        parts = [
            self.spark.read.schema(schema).option("basePath", version).parquet(*own)
            for version, own in folders.items()
        ] or [self.spark.createDataFrame([], schema)]
        return reduce(DataFrame.unionByName, parts).withColumnRenamed(audit, "loaded_at")

    def drop_tables(self) -> None:
        """Take the tables and namespaces out of the catalog. The tables' files
        stay: they are not in the folders of the namespaces."""
        for ns in sorted({ns for ns, _ in TABLES.values()}):
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{ns} CASCADE")

    def replace_periods(
        self,
        key: str,
        df: DataFrame,
        periods: list[tuple[int, int]] | None = None,
        rebalance: bool = False,
        expected: dict[tuple[int, int], int] | None = None,
    ) -> dict[tuple[int, int], int]:
        """Replace the given periods of one table with ``df``'s rows
        (see ``prepare``). Returns the loaded row count per requested period;
        with ``periods=None`` the total under key (0, 0)."""
        load = self.prepare(key, df, periods, rebalance, expected)
        self.switch([load])
        return {(0, 0): sum(load.rows.values())} if periods is None else load.rows

    def prepare(
        self,
        key: str,
        df: DataFrame,
        periods: list[tuple[int, int]] | None = None,
        rebalance: bool = False,
        expected: dict[tuple[int, int], int] | None = None,
        loaded_at: dt.datetime | None = None,
    ) -> PreparedLoad:
        """Write ``df``'s rows of the given periods (None: of all its periods)
        into a fresh version folder of a table; the stored periods stay.

        ``rebalance`` is for inputs whose tasks mix months: AQE then clusters
        rows by period (splitting a dominant month) so each task writes few
        files; inputs read from period partitions need no shuffle.
        ``expected`` (rows per month known from an earlier count) must be what
        the write counts. ``loaded_at`` (UTC) fills the audit column.
        """
        table = self.table(key)
        self._require_dynamic_overwrite(table)
        schema = self.spark.table(table).schema
        audit = AUDIT_COLUMNS.get(key, _GOLD_AUDIT)
        stamp = F.current_timestamp() if loaded_at is None else F.lit(_utc(loaded_at))
        rows = df.filter(in_periods(periods)).withColumn(audit, stamp)
        rows = rows.select(*[F.col(c).cast(schema[c].dataType) for c in schema.fieldNames()])
        if rebalance:
            rows = rows.hint("rebalance", *PERIOD_COLUMNS)
        ns, name = TABLES[key]
        version = f"{self.root}/_versions/{ns}/{name}/{uuid.uuid4().hex[:12]}"
        month = period_key(F.col("reference_year"), F.col("reference_month"))
        counting = [F.count(F.lit(1)).alias("rows")]
        if periods is not None:
            counting.append(group_counts(month, len(periods)).alias("by_period"))
        obs = Observation(f"load_{key}")
        rows.observe(obs, *counting).write.partitionBy(*PERIOD_COLUMNS).parquet(version)
        seen = obs.get
        if periods is None:
            found = {}
            if seen["rows"]:
                stored = self.spark.read.schema(schema).parquet(version)
                found = {(r[0], r[1]): r[2] for r in stored.groupBy(*PERIOD_COLUMNS).count().collect()}
            if any(None in p for p in found):
                raise ValueError(f"{table}: rows without a period")
        else:
            counted = counts_seen(seen["by_period"])
            found = {(y, m): counted.get(y * 100 + m, 0) for y, m in periods}
        if sum(found.values()) != int(seen["rows"]):
            raise RuntimeError(f"{table}: the periods' rows are not the rows written")
        if expected is not None and found != {p: expected.get(p, 0) for p in found}:
            raise RuntimeError(f"{table}: loaded rows differ from the expected counts")
        return PreparedLoad(key, version, found)

    def prepared_rows(self, load: PreparedLoad) -> DataFrame:
        """The rows of a prepared load, without the audit column."""
        schema = self.spark.table(self.table(load.key)).schema
        rows = self.spark.read.schema(schema).parquet(load.version)
        return rows.drop(AUDIT_COLUMNS.get(load.key, _GOLD_AUDIT))

    def switch(self, loads: list[PreparedLoad], started: dt.datetime | None = None) -> None:
        """Point the loads' periods at their version folders, all tables in one
        logged step."""
        load_id = uuid.uuid4().hex[:12]
        started = started or dt.datetime.now(dt.timezone.utc)
        self._log(load_id, started, [
            (load.key, y, m, load.version if n else None) for load in loads for (y, m), n in load.rows.items()])
        for load in loads:
            self._point(load.key, {p: load.version if n else None for p, n in load.rows.items()})
        self._log(load_id, started, [])

    def _log(self, load_id: str, started: dt.datetime, periods: list[tuple]) -> None:
        """One file of the log: the periods of a switch, or (none) its end.
        ``logged`` orders the files."""
        now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")
        rows = [(load_id, now, started.isoformat(), *p) for p in periods] or [(load_id, now, started.isoformat(), None, None, None, None)]
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_loads")

    def _folder(self, path: str):
        """The file system of a folder under the root, and its path there."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _log_rows(self) -> DataFrame | None:
        fs, path = self._folder(f"{self.root}/_loads")
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_loads") if fs.exists(path) else None

    def _logged(self, unended_only: bool = False) -> dict[str, dict[tuple[int, int], str | None]]:
        """The folder of every period by the log (None: emptied), per table:
        its latest entry, at most one a period and table. With
        ``unended_only`` just the periods of switches that did not end."""
        log = self._log_rows()
        if log is None:
            return {}
        if unended_only:
            log = log.join(log.where("key IS NULL").select("load_id"), "load_id", "left_anti")
        latest = log.where("key IS NOT NULL").groupBy("key", *PERIOD_COLUMNS).agg(
            F.max_by(F.struct("location"), F.struct("logged", "load_id")).alias("last"))
        out: dict[str, dict[tuple[int, int], str | None]] = {}
        for r in latest.collect():
            out.setdefault(r["key"], {})[(r["reference_year"], r["reference_month"])] = r["last"]["location"]
        return out

    def _stored_periods(self, key: str) -> set[tuple[int, int]]:
        """The periods that the catalog knows of a table."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.table(key)}").collect()
        return {tuple(int(part.split("=")[1]) for part in r[0].split("/")) for r in found}

    def _point(self, key: str, versions: dict[tuple[int, int], str | None]) -> None:
        """Bring the catalog's periods of a table to these folders (None: none);
        doing it again changes nothing."""
        table, stored = self.table(key), self._stored_periods(key)
        name = lambda p: f"PARTITION (reference_year={p[0]}, reference_month={p[1]})"
        folder = lambda p: f"LOCATION '{versions[p]}/reference_year={p[0]}/reference_month={p[1]}'"
        filled = sorted(p for p, v in versions.items() if v)
        new = [f"{name(p)} {folder(p)}" for p in filled if p not in stored]
        if new:
            self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(new)}")
        for p in filled:
            if p in stored:
                self.spark.sql(f"ALTER TABLE {table} {name(p)} SET {folder(p)}")
        gone = [name(p) for p, v in sorted(versions.items()) if not v and p in stored]
        if gone:
            self.spark.sql(f"ALTER TABLE {table} DROP {', '.join(gone)}")
        self.spark.catalog.refreshTable(table)

    def recover(self) -> None:
        """Carry out switches that were logged but not ended, and give tables
        that a fresh catalog knows no periods of their logged ones."""
        unended = self._logged(unended_only=True)
        logged = None
        for key in TABLES:
            if not self._stored_periods(key):
                logged = self._logged() if logged is None else logged
                if logged.get(key):
                    self._point(key, logged[key])
            elif key in unended:
                logged = self._logged() if logged is None else logged
                self._point(key, {p: logged[key][p] for p in unended[key]})
        log = self._log_rows() if unended else None
        if log is not None:
            for r in log.groupBy("load_id").agg(F.min("started").alias("started"), F.bool_or(F.col("key").isNull()).alias("ended")).where("NOT ended").collect():
                self._log(r["load_id"], dt.datetime.fromisoformat(r["started"]), [])

    def remove_old_versions(self) -> int:
        """Delete version folders that no period points at; returns how many.
        Not while a load or a query that began before the last load runs."""
        used = {v for versions in self._logged().values() for v in versions.values() if v}
        removed = 0
        for ns, name in TABLES.values():
            fs, root = self._folder(f"{self.root}/_versions/{ns}/{name}")
            for found in fs.listStatus(root) if fs.exists(root) else []:
                if f"{self.root}/_versions/{ns}/{name}/{found.getPath().getName()}" not in used:
                    fs.delete(found.getPath(), True)
                    removed += 1
        return removed
