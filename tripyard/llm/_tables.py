"""Small helpers shared by the operators: written tables and code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripyard.session import scratch_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()
#: Spark's bound on the bytes of an Arrow batch for Python, and the one for whole texts.
BATCH_BOUND, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 21


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that the
    functions which run inside tasks can be imported there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    name = os.path.basename(_PACKAGE)
    archive = os.path.join(tempfile.mkdtemp(prefix="tripyard-code-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(_PACKAGE):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    out.write(path, os.path.join(name, os.path.relpath(path, _PACKAGE)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    Cuts lineage: a lost executor re-reads files instead of recomputing, and
    row numbers or random choices made on the way are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let texts go to Python in Arrow batches of about ``BATCH_BYTES``, from
    here on in this session, unless the session names a bound itself. Without
    one a batch is up to 64 MB (10,000 rows), which an executor holds several
    times outside its heap for each task, and keeps for later ones."""
    if spark.conf.get(BATCH_BOUND, None) is None:
        spark.conf.set(BATCH_BOUND, str(BATCH_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ids_repeat(df: DataFrame, id_col: str) -> bool:
    """Whether an id is null or held by more than one row."""
    return not df.groupBy(id_col).count().where(f"count > 1 OR `{id_col}` IS NULL").isEmpty()


def text_column(df: DataFrame, name: str):
    """A text column with null as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold_of(id_col, folds: int):
    """crc32 of the id's decimal text, modulo ``folds``; null ids give null."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(folds)


def most_frequent(counted: DataFrame, count_col: str, bound: int) -> DataFrame:
    """The rows with the largest counts, at most ``bound``: those over a
    threshold that a histogram of the counts (about eight steps for each
    doubling, so a few hundred rows) gives. No rows are sorted or gathered."""
    step = F.floor(F.log2(count_col) * 8)
    sizes = counted.where(F.col(count_col) > 0).groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, held = None, 0
    for r in sizes:
        held += r["count"]
        if held > bound:
            break
        least = r["step"]
    return counted.where((F.col(count_col) > 0) & (step >= least)) if least is not None else counted.limit(0)


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes, bit by bit."""
    byte = "CAST(strpos('0123456789ABCDEF', {x}[{i}:{i}]) - 1 AS BIGINT)"
    value = f"16 * {byte.format(x='hx', i='2 * i - 1')} + {byte.format(x='hx', i='2 * i')}"
    step = "xor(c >> 1, 3988292384 * (c & 1))"
    rounds = "xor(acc, x)"
    for _ in range(8):
        rounds = f"list_transform([{rounds}], lambda c: {step})[1]"
    return (f"list_transform([hex(encode({text}))], lambda hx: xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, "
            f"list_transform(range(1, length(hx) // 2 + 1), lambda i: {value})), lambda acc, x: {rounds})))[1]")
