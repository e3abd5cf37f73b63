"""SparkSession helpers: local sessions for tests/bench and the shared
checkpoint folder (read from the session; a local scratch folder is only
chosen when the session runs in local mode and nothing is configured)."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "siftlane") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SIFTLANE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses the checkpoint dir already set on the context, else
    ``spark.checkpoint.dir`` from the configuration.  Only a local-mode
    session with neither gets a fresh scratch folder; a cluster session
    without a shared folder is an error (machine-local folders are not
    visible to other executors)."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="siftlane-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Scratch folders handed out, by application.
_SCRATCH: dict[str, list[str]] = {}


def clear_scratch(spark: SparkSession) -> int:
    """Deletes every scratch folder that this application was given, and
    returns their number.  For the end of a job: results that still read one
    of them have to be written first."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def spread(df, factor: int = 2, by: str | None = None):
    """Repartition for CPU-heavy per-row work when the input has fewer
    partitions than the cluster has cores (e.g. one large row group); a no-op
    for inputs that already come in many splits.  With ``by`` the split is a
    range partitioning on that column (outputs then keep disjoint key ranges
    per file); otherwise round-robin."""
    sc = df.sparkSession.sparkContext
    try:
        n = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - no RDD access (e.g. Spark Connect)
        return df
    cores = sc.defaultParallelism
    if n >= cores:
        return df
    return df.repartitionByRange(cores * factor, by) if by else df.repartition(cores * factor)


# Bytes of an Arrow batch that a Python worker holds, where rows are large (blocks of vectors, token matrices).
ARROW_BYTES = 8 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs that run inside hand rows to Python in batches of ARROW_BYTES at most (or of what the session has set, if that is less)."""
    was = spark.conf.get(_ARROW)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(was)
    if 0 < size <= ARROW_BYTES:
        yield
        return
    spark.conf.set(_ARROW, f"{ARROW_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(_ARROW, was)


def freeze(df, name: str = "frozen"):
    """Writes ``df`` once as Parquet into the shared checkpoint folder and
    reads it back: later actions read the written rows instead of
    recomputing the lineage, and the lineage is cut (executor loss recomputes
    nothing upstream).  Used for bounded tables that several stages read,
    e.g. an encoded query block.  (``DataFrame.checkpoint`` would compute the
    plan twice: once to count, once to write.)"""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


# Rows of a short table (at about 100 bytes each).
SHORT_ROWS = 250_000


def is_short(written) -> bool:
    """Whether a written table of narrow rows is one to broadcast, whatever Spark's limit in bytes."""
    return written.count() <= SHORT_ROWS


def short(written):
    """A written table, marked for broadcast if it is short."""
    from pyspark.sql import functions as F

    return F.broadcast(written) if is_short(written) else written
