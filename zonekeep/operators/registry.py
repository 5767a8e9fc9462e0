"""Folding observations into the registry, and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekeep.functions.hostname import RO_RULES, HostRules, add_host
from zonekeep.sources.catalog import public_sources


def normalise(observations: DataFrame, rules: HostRules = RO_RULES) -> DataFrame:
    """Adds host, domain, unicode_host, unicode_domain (null: rejected) to raw observations; what is not offered is not parsed."""
    found = add_host(observations, F.when(F.col("offered"), F.col("raw")), rules)
    return found.select("*", "n.host", "n.domain", "n.unicode_host", "n.unicode_domain").drop("n")


def run_counters(normalised: DataFrame, known_domains: DataFrame, known_hosts: DataFrame) -> DataFrame:
    """One row: rows_read, hostnames_accepted, domains_new, hostnames_new, rejected."""
    base = normalised.agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("host").isNotNull()).alias("hostnames_accepted"),
        F.count_if(F.col("short") | (F.col("offered") & F.col("host").isNull())).alias("rejected"),
    )
    new = lambda column, known, key, name: normalised.select(F.col(column).alias(key)).filter(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti").agg(F.count("*").alias(name))
    return base.crossJoin(new("domain", known_domains, "domain", "domains_new")).crossJoin(new("host", known_hosts, "hostname", "hostnames_new")).select(
        "rows_read", "hostnames_accepted", "domains_new", "hostnames_new", "rejected"
    )


def fold_names(batch: DataFrame, key: str, extra: list[str]) -> DataFrame:
    """One row a name: the first date in order of arrival, the last date by value, the first of each extra column.

    ``batch`` has the key, ``extra``, ord (order of arrival, state first), first_seen_at and last_seen_at.
    """
    firsts = [F.min_by(c, "ord").alias(c) for c in extra]
    return batch.groupBy(key).agg(*firsts, F.min_by("first_seen_at", "ord").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))


def fold_sources(batch: DataFrame, key: str, metadata: bool) -> DataFrame:
    """One row a name and source: occurrences, best rank, dates as in ``fold_names``, first metadata that is there."""
    aggs = [
        F.min_by("first_seen_at", "ord").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("occurrences").alias("occurrences"),
        F.min("best_rank").alias("best_rank"),
    ]
    if metadata:
        aggs.append(F.min_by("metadata_json", F.when(F.col("metadata_json").isNotNull(), F.col("ord"))).alias("metadata_json"))
    return batch.groupBy(key, "source_id").agg(*aggs)


def _ordered(state: DataFrame, batch: DataFrame) -> DataFrame:
    """State rows ahead of all rows of the batch."""
    first = state.withColumn("ord", F.struct(F.lit(0).alias("o"), F.lit("").alias("seq")))
    return first.unionByName(batch)


def merge_batch(state: dict[str, DataFrame], normalised: DataFrame, source_id: str, observed_at: str) -> dict[str, DataFrame]:
    """The four registry tables after a batch of normalised observations of one source.

    A name already known keeps the date and unicode form of its first import, whatever dates come later.
    """
    batch = normalised.filter(F.col("host").isNotNull()).select(
        "host", "domain", "unicode_host", "unicode_domain",
        F.struct(F.lit(1).alias("o"), F.col("seq")).alias("ord"),
        F.lit(source_id).alias("source_id"), F.lit(observed_at).alias("first_seen_at"), F.lit(observed_at).alias("last_seen_at"),
        F.lit(1).cast("long").alias("occurrences"), F.col("rank").alias("best_rank"), F.col("metadata").alias("metadata_json"),
    )
    dates = ["ord", "first_seen_at", "last_seen_at"]
    counts = ["source_id", *dates, "occurrences", "best_rank"]
    hosts = batch.withColumnsRenamed({"host": "hostname", "unicode_host": "unicode_hostname", "domain": "registrable_domain"})
    return {
        "domains": fold_names(_ordered(state["domains"], batch.select("domain", "unicode_domain", *dates)), "domain", ["unicode_domain"]),
        "hostnames": fold_names(_ordered(state["hostnames"], hosts.select("hostname", "registrable_domain", "unicode_hostname", *dates)), "hostname", ["registrable_domain", "unicode_hostname"]),
        "domain_sources": fold_sources(_ordered(state["domain_sources"], batch.select("domain", *counts, "metadata_json")), "domain", True),
        "hostname_sources": fold_sources(_ordered(state["hostname_sources"], hosts.select("hostname", *counts)), "hostname", False),
    }


def provenance(domains: DataFrame, domain_sources: DataFrame, sources: DataFrame, public_only: bool = False) -> DataFrame:
    """Each domain with the number and list of its sources; with ``public_only`` only public sources count."""
    used = (public_sources(sources) if public_only else sources).select("source_id")
    # one pass: the set of a domain's sources gives both their number and the list
    seen = domain_sources.join(used, "source_id").groupBy("domain").agg(F.array_sort(F.collect_set("source_id")).alias("s"))
    seen = seen.select("domain", F.size("s").cast("long").alias("source_count"), F.array_join("s", ",").alias("sources"))
    return domains.join(seen, "domain").select("domain", "unicode_domain", "first_seen_at", "last_seen_at", "source_count", "sources")


def plain_domains(domains: DataFrame, domain_sources: DataFrame, sources: DataFrame, public_only: bool = False) -> DataFrame:
    used = public_sources(sources) if public_only else sources
    seen = domain_sources.join(used.select("source_id"), "source_id", "left_semi").select("domain").distinct()
    return domains.select("domain").join(seen, "domain", "left_semi")


def public_domains(domain_sources: DataFrame, sources: DataFrame) -> DataFrame:
    return domain_sources.join(public_sources(sources).select("source_id"), "source_id", "left_semi").select("domain").distinct()


def only_public(rows: DataFrame, public: DataFrame) -> DataFrame:
    """Rows of domains that may be published."""
    return rows.join(public.select("domain"), "domain", "left_semi")


def stats_totals(state: dict[str, DataFrame], sources: DataFrame, runs: DataFrame) -> DataFrame:
    count = lambda df, name: df.agg(F.count("*").alias(name))
    out = count(state["domains"], "domains")
    out = out.crossJoin(public_domains(state["domain_sources"], sources).agg(F.count("*").alias("public_export_domains")))
    out = out.crossJoin(count(state["hostnames"], "hostnames")).crossJoin(count(sources, "sources_catalogued"))
    return out.crossJoin(runs.filter("status = 'completed'").agg(F.countDistinct("source_id").alias("sources_imported")))


def stats_by_source(domain_sources: DataFrame, sources: DataFrame) -> DataFrame:
    """Domains by source, most first, ties by source."""
    counts = domain_sources.groupBy("source_id").agg(F.count("*").alias("domains"))
    return counts.join(sources.select("source_id", "public_export"), "source_id").orderBy(F.desc("domains"), "source_id")
