"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this library relies on; cluster values come from the submitter.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Spark's setting that an execution's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Work folders handed out by ``shared_dir``.
_MADE: list[str] = []


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None, app: str = "termdex") -> SparkSession:
    """A ``local[cores]`` session for tests and the bench (never used on a cluster)."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", "16g")
        # batch throughput: the parallel collector beat G1 on the bench's build and
        # search steps (local mode runs every task in the driver JVM)
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary folder if unset and the master is ``local``."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's own settings apply
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="termdex-cp-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # a core setting may be read-only at run time
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set and Spark runs in one local JVM, a temporary folder is made
    and registered as the checkpoint dir, so later calls agree; on a cluster that raises.
    """
    base = checkpoint_base(spark)
    name = "-".join(parts) if parts else "work"
    path = os.path.join(base.rstrip("/"), f"termdex-{name}-{uuid.uuid4().hex[:12]}")
    _MADE.append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Delete the work folders that this process has made so far, and return how many there were.

    For the end of a job: a DataFrame that still reads one of them (every result that was
    built on a staged table and is not written yet) can't be run afterwards.
    """
    n = 0
    while _MADE:
        p = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n


def staged(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` once: write it to a fresh table in the shared folder and read that.

    What reads the result reads the table, so the work before it is not repeated, by a
    second reader or after a lost executor. Its shuffle files are removed once the table is
    written (where Spark has ``SHUFFLE_CLEANUP``); they would stay until the driver collects its garbage.
    """
    path = shared_dir(df.sparkSession, name)
    conf = df.sparkSession.conf
    was = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if was is None else conf.set(SHUFFLE_CLEANUP, was)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store its path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
