"""Session helpers: a local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(master: str | None = None, app: str = "tripwire",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests and bench (cluster jobs pass their own session)."""
    master = master or os.environ.get("TRIPWIRE_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TRIPWIRE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set (a shared file system), otherwise this
    raises; a folder of its own is made only for a local master, as in tests.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="tripwire-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core config may be read-only here
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def utc(spark: SparkSession) -> None:
    """Pin the session time zone (streaming event time is read as wall-clock UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def materialize(df, name: str = "t"):
    """Write a DataFrame once as a Parquet table in the shared checkpoint
    folder and read it back: the plan is computed once, lineage is cut (a lost
    executor re-reads files instead of recomputing), and later scans keep
    column pruning and filter pushdown."""
    import uuid
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
