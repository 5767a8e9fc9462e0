"""Continuous ingest: names that arrive as files are folded batch by batch.

The same scans, rules and folds as the batch side, driven by Structured
Streaming: each micro-batch is one import, made idempotent by its batch number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonekeep.plans.registry import Registry
from zonekeep.sources import lists


def stream_lines(spark: SparkSession, directory: str, files_at_once: int = 16) -> DataFrame:
    """seq, line of text files as they arrive in a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_at_once).text(directory)
    return lines.select(F.col("_metadata")["file_path"].alias("file"), F.make_valid_utf8("value").alias("line"))


def ingest(registry: Registry, directory: str, source_id: str, observed_at: str, checkpoint: str) -> StreamingQuery:
    """Fold plain lists that arrive in ``directory`` until there are none left."""

    def fold(batch: DataFrame, number: int) -> None:
        lines = batch.withColumn("seq", F.format_string("%s#%020d", F.col("file"), F.monotonically_increasing_id())).select("seq", "line")
        registry.import_observations(source_id, observed_at, directory, f"stream:{checkpoint}:{number}", lambda: lists.plain_list(lines, registry.rules.tlds))

    return stream_lines(registry.spark, directory).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(events: DataFrame, time: str = "ts", key: str = "event_type", late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Arrivals by tumbling window and key; works on a stream and on a table."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), key).agg(F.count("*").alias("n"))

