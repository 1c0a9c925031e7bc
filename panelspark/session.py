"""Session creation and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants. They are applied only when the submitter has not set them, so a cluster's
# spark-defaults / --conf always win.
DEFAULT_CONF = {
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed ones in joins and
    # switches join strategy from real sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One time zone for date parts and for literal day bounds.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "panelspark", conf: dict | None = None, master: str | None = None) -> SparkSession:
    """Return the active session or build one.

    ``master`` is normally left to ``spark-submit``; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        known = spark._jsparkSession.sessionState().conf()
    except Exception:  # Spark Connect: what was set cannot be seen, so nothing is changed
        return spark
    for key, value in DEFAULT_CONF.items():
        if not known.contains(key):
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and lineage cuts.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (it must be shared storage all
    executors see). Only when it is unset -- local tests -- a private temporary folder is made and
    registered as the checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: no SparkContext on the client
            root = None
    if not root:
        master = _master(spark)
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="panelspark-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # Spark Connect: the conf is the only handle
            spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:  # Spark Connect
        return spark.conf.get("spark.master", "")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below :func:`scratch_root` (nothing is created)."""
    return "/".join([scratch_root(spark), "panelspark", *parts, uuid.uuid4().hex])


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files below ``paths`` (file-system metadata only; nothing is read)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(hconf).getContentSummary(path).getLength()
    return int(total)


def initial_partitions(spark: SparkSession) -> int:
    """Shuffle partitions that adaptive execution starts from: what was set for it, else the shuffle partitions."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))


SIZED = "spark.panelspark.initialPartitionNum"  # what size_shuffle set last, so that each job is sized anew


def size_shuffle(spark: SparkSession, paths, bytes_per_partition: int = 256 << 20, minimum: int = 200) -> int | None:
    """Start adaptive execution from ``input size / bytes_per_partition`` shuffle partitions.

    AQE coalesces small partitions afterwards, so erring high is cheap while erring low makes every
    reducer spill. Nothing is changed when the submitter set ``spark.sql.shuffle.partitions`` or the
    initial partition number. Returns the number set, or None.
    """
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    try:
        conf = spark.sparkContext.getConf()
    except Exception:  # Spark Connect: no file-system handle on the client; leave the settings alone
        return None
    ours = spark.conf.get(SIZED, None)
    if any(conf.contains(k) for k in keys) or spark.conf.get(keys[1], None) not in (None, ours):
        return None
    n = max(minimum, -(-input_bytes(spark, paths) // bytes_per_partition))
    spark.conf.set(keys[1], str(n))
    spark.conf.set(SIZED, str(n))
    return n
