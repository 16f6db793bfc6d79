"""Session settings the jobs are written for. Clusters bring their own master, memory and shared folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle further down
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # beyond this size HotSpot interprets a generated method; smaller ones made per expression run compiled
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Switch on what the jobs rely on against hot keys in a session somebody else made."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", java_options: str = "",
    shared: str = "/tmp/checkpoints",
) -> SparkSession:
    """Single-machine session for tests and the benchmark; `shared` stands for the folder that a cluster shares."""
    return tuned(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stayline")
        .config("spark.driver.memory", memory)
        .config("spark.driver.extraJavaOptions", java_options)
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
