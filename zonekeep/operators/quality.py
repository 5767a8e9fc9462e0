"""Checks of the registry's rules, as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekeep.sources.catalog import REDISTRIBUTION

#: (table, column, table it refers to, column there)
FOREIGN_KEYS = (
    ("hostnames", "registrable_domain", "domains", "domain"),
    ("domain_sources", "domain", "domains", "domain"),
    ("domain_sources", "source_id", "sources", "source_id"),
    ("hostname_sources", "hostname", "hostnames", "hostname"),
    ("hostname_sources", "source_id", "sources", "source_id"),
    ("import_runs", "source_id", "sources", "source_id"),
)


def orphans(rows: DataFrame, column: str, parents: DataFrame, parent: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    keys = parents.select(F.col(parent).alias(column)).distinct()
    return rows.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def enum_violations(rows: DataFrame, column: str, allowed: tuple[str, ...] = REDISTRIBUTION) -> DataFrame:
    return rows.filter(F.col(column).isNull() | ~F.col(column).isin(*allowed))


def seen_out_of_order(first: str = "first_seen_at", last: str = "last_seen_at") -> Column:
    return F.col(first) > F.col(last)


def verify(tables: dict[str, DataFrame], tlds: tuple[str, ...] = ("ro",)) -> DataFrame:
    """One row of counts of violations, all zero for a sound registry, and ok."""
    suffix = F.lit(False)
    for t in tlds:
        suffix = suffix | F.endswith(F.col("domain"), F.lit(f".{t}"))
    out = tables["domains"].agg(F.count_if(~suffix).alias("invalid_suffix"), F.count_if(seen_out_of_order()).alias("invalid_seen_order"))
    missing = None
    for table, column, parent, key in FOREIGN_KEYS:
        if table in tables and parent in tables:
            one = orphans(tables[table], column, tables[parent], key).agg(F.count("*").alias("n"))
            missing = one if missing is None else missing.unionByName(one)
    out = out.crossJoin(missing.agg(F.sum("n").alias("foreign_key_errors")))
    out = out.crossJoin(orphans(tables["hostnames"], "registrable_domain", tables["domains"], "domain").agg(F.count("*").alias("orphan_hostnames")))
    out = out.crossJoin(tables["import_runs"].agg(F.count_if(F.col("status") == "running").alias("unfinished_imports")))
    sound = F.lit(True)
    for c in ("invalid_suffix", "invalid_seen_order", "foreign_key_errors", "orphan_hostnames", "unfinished_imports"):
        sound = sound & (F.col(c) == 0)
    return out.withColumn("ok", sound)
