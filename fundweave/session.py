"""Session defaults. Everything here can be overridden by the cluster's own configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot works, awards and funders: split their shuffle partition instead of running it whole.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def builder(app: str = "fundweave") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in DEFAULTS.items():
        b = b.config(key, value)
    return b


def local(cores: str = "*", shuffle_partitions: int = 8, memory: str = "20g") -> SparkSession:
    spark = (
        builder()
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
