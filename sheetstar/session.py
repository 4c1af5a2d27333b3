"""Session settings for tests, the bench and small jobs; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sheetstar")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """Folder all executors can reach, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset (tests, local
    runs) is the caller's own folder used.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or fallback
