"""Spark session settings shared by every layer.

The engine never hard-codes a master: under ``spark-submit`` the cluster
manager supplies it, and a bare ``python`` process gets Spark's default
``local[*]``.  Runtime SQL settings that change results (time zone, date
parser policy, ANSI mode) are applied to any session handed to us, so the
same code behaves identically on a driver-supplied session.
"""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that affect query results; applied to every session we touch.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only affect how the plan executes.
EXECUTION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant runtime settings to an existing session."""
    for k, v in RESULT_SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def get_spark(app: str = "marquee", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``master`` is only set when given: under ``spark-submit`` the cluster
    master comes from its configuration (setting one here would override
    it), and a plain ``python`` process gets Spark's own ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**RESULT_SETTINGS, **EXECUTION_SETTINGS}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return apply_settings(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set in a local-mode session (tests) is a private temp
    folder created and registered; on a cluster that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            d = None
    if not d:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor "
                               "shares (a machine-local temp folder would not be)")
        d = tempfile.mkdtemp(prefix="marquee-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(d)
            d = spark.sparkContext.getCheckpointDir() or d
        except Exception:  # Spark Connect: keep the folder for scratch output only
            pass
    return d.rstrip("/")


def session_key(spark: SparkSession) -> tuple:
    """Identity of a running session (application id when there is a context)."""
    try:
        return (spark.sparkContext.applicationId, id(spark))
    except Exception:
        return (None, id(spark))


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict[tuple, tuple[int, str | None]] = {}
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an action go when it ends.  Else they stay until the driver's
    garbage collector meets its plan, so that those of a run's steps add up on the disk.  May be
    nested and shared by threads; the last to leave gives the session its setting back."""
    key = session_key(spark)
    with _FREEING_LOCK:
        users, before = _FREEING.get(key) or (0, spark.conf.get(FREE_SHUFFLES, None))
        spark.conf.set(FREE_SHUFFLES, "true")
        _FREEING[key] = users + 1, before
    try:
        yield
    finally:
        with _FREEING_LOCK:
            users, before = _FREEING.pop(key)
            if users > 1:
                _FREEING[key] = users - 1, before
            elif before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    return f"{shared_dir(spark)}/marquee/{name}-{uuid.uuid4().hex[:12]}"


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path``, from file metadata only (the
    ``binaryFile`` source does not read contents when they are not selected);
    the listing runs as a Spark job, not on the driver's file system."""
    from pyspark.sql import functions as F
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
               .select("length"))
    return int(df.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def size_shuffle(spark: SparkSession, total_bytes: int,
                 bytes_per_partition: int = 256 << 20, minimum: int = 200) -> int:
    """Set ``spark.sql.shuffle.partitions`` so that a shuffle of about the input
    size gives ~``bytes_per_partition`` per reducer (AQE coalesces the small
    ones back); e.g. 100 TB -> ~400k partitions.  Returns the value set."""
    n = max(minimum, math.ceil(total_bytes / bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
