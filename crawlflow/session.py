"""Session settings that the plans of this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Message maps are merged with map_concat: the later value of a key wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # One write job fans out to several table/family folders. Keeping a few
    # writers open per task avoids sorting every cell by folder before the write.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; safe to call more than once."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster; `fallback` only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return root.rstrip("/")
