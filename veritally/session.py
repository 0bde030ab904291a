"""A session with the settings the operators are tuned for. Clusters bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Whether a join by several columns has to hash all of them, even if its rows are partitioned by some of them already.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def local_session(cpus: int = 8, app: str = "veritally") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Tokens partitioned by sequence stay put when they are joined by (sequence, position).
        .config(ALL_KEYS, "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
