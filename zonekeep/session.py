"""Session settings that every entry point shares."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and benches; clusters bring their own."""
    conf = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": memory} | extra
    return SparkSession.builder.master(f"local[{cores}]").appName("zonekeep").config(map=conf).getOrCreate()
