"""Session helpers: shared scratch space and the local session used by tests.

On a cluster the session is given; nothing here changes its settings. The
only folder the engine writes to on its own is under the shared checkpoint
directory the cluster names (``spark.checkpoint.dir``). Where that setting is
absent, the session's own table storage (``spark.sql.warehouse.dir``) holds
it, unless that is a folder of the machine and the session is not local: then
it is an error. No temporary folder of a machine is used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set from the warehouse
    folder only where neither the context nor the session names one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not getattr(sc, "master", "local").startswith("local") and warehouse.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share; "
                             f"{warehouse} is a folder of this machine")
        configured = f"{warehouse.rstrip('/')}/_scratch"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/tripyard/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = 8, app: str = "tripyard") -> SparkSession:
    """Local test session: AQE on, no UI, shuffle partitions sized to cores."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Cleaning and rules stay below HotSpot's limit for compiled methods
        # (tests/test_plans.py); plans that fuse more need not.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
