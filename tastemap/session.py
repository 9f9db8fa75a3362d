"""Session construction and the few driver-side guards the engine needs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"


def get_spark(master: str | None = None, app: str = "tastemap", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's own session."""
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TASTEMAP_DRIVER_MEMORY", "12g"))
        # long sessions run thousands of small jobs (one per MLP epoch): keep little job history
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "100")
        .config("spark.ui.retainedTasks", "10000")
        .config("spark.sql.ui.retainedExecutions", "50")
        .config("spark.scheduler.mode", "FAIR")  # points of a grid share the cores
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Batches of rows that go to Python workers are bounded by bytes, unless the session sets a bound itself: with
    Spark's 10,000 rows, the texts of a whole partition are one batch, in the JVM and in the worker."""
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a shared file system). Only a local-mode
    session without it gets a fresh scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        d = tempfile.mkdtemp(prefix="tastemap-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back. Cuts the
    lineage like a checkpoint, but later scans still prune columns and push filters down."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def checked_broadcast(df: DataFrame, max_rows: int, what: str = "table") -> DataFrame:
    """Broadcast ``df`` only after counting it; above ``max_rows`` leave the join to the planner."""
    n = df.count()
    if n <= max_rows:
        return F.broadcast(df)
    return df


def require_population(n_available: int, n_wanted: int, what: str) -> None:
    if n_available < n_wanted:
        raise ValueError(f"cannot draw {n_wanted} {what}: only {n_available} qualify")
