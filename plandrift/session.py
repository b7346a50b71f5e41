"""Session defaults for local runs; on a cluster the submitted settings apply."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str, cpus: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JVM never compiles methods above 8000 bytes; wide aggregates run
        # faster outside whole-stage code than in an interpreted giant method.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark
