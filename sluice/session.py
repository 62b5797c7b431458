"""Session helpers: shared scratch folder and a local session for tests and bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the engine relies on for correct results.
# Last duplicate key wins when a JSON object repeats a key (as Python json.loads does);
# the keys of a small batch reach the parquet reader one by one.
REQUIRED_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}


def apply_required_conf(spark: SparkSession) -> None:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in a local-mode session (tests)
    a folder of our own is created and registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not visible to other executors and is lost
            # with its machine: tables, version folders and manifests need a
            # shared one.
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


# Byte-size suffixes accepted in Spark size settings.
_SIZE_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def byte_size(text: str) -> int:
    """A Spark size setting (``10485760b``, ``20m``, ``-1``) in bytes; negative means off."""
    t = text.strip().lower()
    digits = t.rstrip("abcdefghijklmnopqrstuvwxyz")
    unit = t[len(digits):] or "b"
    return int(digits) * _SIZE_UNITS[unit]


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast join threshold in bytes (-1 when broadcasts are off)."""
    return byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/sluice/{label}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and bench; mirrors what a cluster job would set."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark
