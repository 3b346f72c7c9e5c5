"""Session helpers.

Durable state (streaming checkpoints, written tables, lineage cuts) goes under the
shared folder named by ``spark.checkpoint.dir``.  A session in one process may leave
it unset; on a cluster the library raises instead of using a machine-local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # keep generated methods JIT-compilable (HotSpot skips methods over 8000 bytecodes)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "threadsift",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests/bench; sets a checkpoint dir only where none is configured."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("THREADSIFT_DRIVER_MEMORY", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def tune_session(spark: SparkSession) -> None:
    """Runtime SQL settings the text-heavy plans rely on, applied only where the
    session still has Spark's default (a user's explicit choice is kept)."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def bounded_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Arrow batches of at most ``rows`` rows and about ``size`` bytes (one row at least), so that a batch of
    long texts stays small on both sides of the pipe; applied only where the session still has Spark's default."""
    for key, default, value in (("maxRecordsPerBatch", "10000", str(rows)), ("maxBytesPerBatch", "67108864b", f"{size}b")):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", default) == default:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when the query ends, not when the driver's garbage collection finds
    them; for jobs whose steps each end in a written table.  The session's own choice is back afterwards."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001 -- Spark Connect: no SparkContext on the client
        return False
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.  Only a session in one process (``local``, ``local[n]``) may
    leave it unset and gets a scratch folder; any other must name a folder that all its machines share."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        d = d or spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 -- Spark Connect: no SparkContext on the client
        pass
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="threadsift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001
        pass
    return d


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder under the shared checkpoint dir for one job's state."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001
            base = None
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for the cluster")
    base = base.rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
