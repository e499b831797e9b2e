"""New monthly files -> loaded months, with Structured Streaming.

Replaces a monthly schedule: a file-source stream lists the landing folder,
remembers in its checkpoint which files it has handed out (each file once,
across restarts), and ``foreachBatch`` loads the months those files belong
to with the same run as the batch job (staging, silver, gold; period
replacement makes a repeated month harmless). Trigger ``availableNow``
processes what has landed and stops, so it can be started by any scheduler.

Only file paths flow through the stream (the binaryFile source with
``content`` pruned); the trip rows are read by the run itself. A micro-batch
holds at most ``max_files_per_trigger`` paths, so the driver sees a bounded
list of file names per batch, never data. The names say which months changed;
what is checked and loaded is each month's whole path, so a month whose parts
arrive in several batches is complete after the last of them. A month below
the size threshold stops the stream with an error, as it stops the batch run,
and the batch is retried after a restart.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripyard.plans.job import run_frame
from tripyard.schema import MIN_RAW_FILE_BYTES, RAW_FILE_PATTERN
from tripyard.session import scratch_dir
from tripyard.sources.raw_files import inventory_of, read_raw_trips, require_valid_files


def month_roots(paths: list[str]) -> dict[tuple[int, int], str]:
    """Month -> the path naming it (a file, or the directory of its parts);
    a month found at two places is an error."""
    out = {}
    for p in paths:
        found = re.search(RAW_FILE_PATTERN, p)
        if found:
            month, root = (int(found.group(1)), int(found.group(2))), p[: found.end()]
            if out.setdefault(month, root) != root:
                raise ValueError(f"month {month} landed at {out[month]} and at {root}")
    return out


def start_monthly_loads(
    spark: SparkSession,
    landing_root: str,
    warehouse_root: str,
    work_root: str,
    checkpoint: str | None = None,
    min_file_bytes: int = MIN_RAW_FILE_BYTES,
    max_files_per_trigger: int = 64,
    available_now: bool = True,
    prefix: str = "",
) -> StreamingQuery:
    """Start the stream; returns the query (``awaitTermination`` to wait)."""
    checkpoint = checkpoint or scratch_dir(spark, "landing-stream")
    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing_root)
        .select("path")
    )

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        months = month_roots([r.path for r in batch.collect()])  # <= max_files_per_trigger rows
        if not months:
            return
        require_valid_files(inventory_of(spark, months, min_file_bytes))
        ready = sorted(months)
        raw = read_raw_trips(spark, [months[p] for p in ready])
        run_frame(spark, raw, ready, warehouse_root, f"{work_root.rstrip('/')}/batch-{batch_id}", prefix=prefix)

    writer = listing.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


__all__ = ["start_monthly_loads", "month_roots"]
