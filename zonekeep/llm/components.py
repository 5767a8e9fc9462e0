"""Connected components of undirected edges, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekeep.store import discard, stage


def connected(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, root for every node of ``edges`` (a, b: long): the smallest node of its component.

    Each round takes the smallest root among a node and its neighbours, hooks
    roots onto smaller ones and then halves the way to the root; the number of
    rounds follows the logarithm of the longest way.
    """
    spark = edges.sparkSession
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{label}-edges")
    roots = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root"))
    roots = stage(roots, f"{label}-roots")
    while True:
        again = spark.read.schema(roots.schema).parquet(roots._staged_at)
        near = both.join(again.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        # a node's root hears of the smallest root near any of its nodes
        heard = roots.join(near, "node", "left").withColumn("low", F.least("root", F.coalesce("near", "root")))
        hooks = heard.groupBy(F.col("root").alias("node")).agg(F.min("low").alias("hook"))
        hooked = stage(heard.join(hooks, "node", "left").select("node", "root", F.least("low", F.coalesce("hook", "low")).alias("low")), f"{label}-hooked")
        above = spark.read.schema(hooked.schema).parquet(hooked._staged_at).select(F.col("node").alias("low"), F.col("low").alias("up"))
        new = stage(hooked.join(above, "low", "left").select("node", F.least("low", F.coalesce("up", "low")).alias("root"), F.col("root").alias("old")), f"{label}-roots")
        moved = new.filter("root <> old").limit(1).count()
        discard(hooked)
        discard(roots)
        roots = spark.read.parquet(new._staged_at).select("node", "root")
        roots._staged_at = new._staged_at
        if not moved:
            discard(both)
            return roots
