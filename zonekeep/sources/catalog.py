"""The source catalog: which sources exist, and which may be published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG = (
    "source_id string, name string, category string, url string, access_method string, coverage string, license string, "
    "redistribution_status string, public_export int, import_status string, notes string, last_checked_at string"
)
# What may be done with a source's names.
REDISTRIBUTION = ("allowed", "allowed_with_attribution", "permission_held", "research_only", "restricted", "unclear", "metadata_only")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of source descriptions."""
    return spark.read.schema(CATALOG).option("multiLine", True).json(path)


def sync_catalog(old: DataFrame, new: DataFrame) -> DataFrame:
    """New descriptions replace old ones; sources that are described no more stay."""
    return new.unionByName(old.join(new.select("source_id"), "source_id", "left_anti").select(*new.columns))


def public_sources(sources: DataFrame) -> DataFrame:
    return sources.filter(F.col("public_export") == 1)


def read_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """key=value lines, split at the first equals sign; a bounded settings file."""
    rows = spark.read.text(path).filter(F.contains("value", F.lit("="))).select(F.split("value", "=", 2).alias("kv")).collect()
    return {r["kv"][0]: r["kv"][1] for r in rows}
