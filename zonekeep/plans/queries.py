"""The engine's operators as queries over the driver's tables, with their SQL.

Stand-ins: pages.url are raw observations; lineitem are sightings of domains
(part) by sources (supplier) with a rank (line number) and a date; a source is
public when its nation is in region 1; events are lookups of names (user) and
types (event type) in order of time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekeep.functions import scalars
from zonekeep.functions.hostname import HostRules, add_host, add_native_host
from zonekeep.operators import dns, quality, registry
from zonekeep.sources import catalog, lists
from zonekeep.store import stage
from zonekeep.streaming import ingest

PAGE_RULES = HostRules(("com", "net", "org"), ("example.com", "example.net", "example.org"))
_LABELS = r"^(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+(?:com|net|org)$"
_URL_HOST = "regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:]*)', 1)"
_LAST3 = "array_to_string(list_slice(string_split({h}, '.'), -3, -1), '.')"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- names ----


@_query(f"SELECT page_id, h AS host, {_LAST3.format(h='h')} AS domain FROM (SELECT page_id, {_URL_HOST} AS h FROM pages)")
def normalize_url_host(spark, d):
    rows = add_native_host(_t(spark, d, "pages").select("page_id", "url"), F.col("url"), PAGE_RULES)
    return rows.select("page_id", "n.host", "n.domain")


@_query(f"SELECT {_LAST3.format(h='h')} AS domain, count(*) AS pages, count(DISTINCT h) AS hosts FROM (SELECT {_URL_HOST} AS h FROM pages) GROUP BY 1")
def registrable_domain(spark, d):
    rows = normalize_url_host(spark, d)
    return rows.groupBy("domain").agg(F.count("*").alias("pages"), F.countDistinct("host").alias("hosts"))


@_query(
    f"""SELECT doc_id, h AS host, {_LAST3.format(h="h")} AS domain FROM (
        SELECT doc_id, ltrim(rtrim(lower(split_part(a, '@', 2)), '.'), '*.') AS h
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+')) AS a FROM documents))
        WHERE regexp_full_match(h, '{_LABELS[1:-1]}') AND len(string_split(h, '.')) >= 3"""
)
def email_domain(spark, d):
    found = _t(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+"), F.lit(0))).alias("a"))
    return add_native_host(found, F.col("a"), PAGE_RULES).filter("n is not null").select("doc_id", "n.host", "n.domain")


@_query(f"SELECT page_id, array_to_string(list_reverse(string_split(h, '.')), '.') AS reversed FROM (SELECT page_id, {_URL_HOST} AS h FROM pages)")
def reverse_domain(spark, d):
    return normalize_url_host(spark, d).select("page_id", scalars.reverse_labels(F.col("host")).alias("reversed"))


@_query(f"SELECT page_id FROM (SELECT page_id, {_URL_HOST} AS h FROM pages) WHERE h LIKE '%.example.com' OR h LIKE '%.org'")
def suffix_prefilter(spark, d):
    return normalize_url_host(spark, d).filter(scalars.ends_with_tld(F.col("host"), ("example.com", "org"))).select("page_id")


@_query(
    f"""WITH raw AS (SELECT url AS raw FROM pages UNION ALL SELECT s_name FROM supplier), hosts AS (SELECT {_URL_HOST} AS h FROM pages)
    SELECT count(*) AS rows_read, count(*) FILTER (raw LIKE 'http%://%.example.%') AS hostnames_accepted, count(*) FILTER (NOT raw LIKE 'http%://%.example.%') AS rejected,
    (SELECT count(DISTINCT h) FROM hosts) AS hostnames_new, (SELECT count(DISTINCT array_to_string(list_slice(string_split(h, '.'), -3, -1), '.')) FROM hosts) AS domains_new FROM raw"""
)
def normalize_reject_counts(spark, d):
    raw = _t(spark, d, "pages").select("url").union(_t(spark, d, "supplier").select("s_name"))
    seen = raw.select(F.lit("").alias("seq"), F.col("url").alias("raw"), F.lit(None).cast("long").alias("rank"), F.lit(None).cast("string").alias("metadata"), F.lit(True).alias("offered"), F.lit(False).alias("short"))
    empty = spark.createDataFrame([], "domain string, hostname string")
    return registry.run_counters(stage(registry.normalise(seen, PAGE_RULES), "normalised"), empty, empty)


@_query("SELECT c_custkey, try_cast(trim(replace(replace(c_name, 'Customer#', ' 1,'), ',', '')) AS BIGINT) AS rank, try_cast(c_name AS BIGINT) AS bad FROM customer")
def parse_rank(spark, d):
    rows = _t(spark, d, "customer")
    return rows.select("c_custkey", scalars.parse_count(F.replace("c_name", F.lit("Customer#"), F.lit(" 1,"))).alias("rank"), scalars.parse_count(F.col("c_name")).alias("bad"))


@_query()
def idn_unicode_hosts(spark, d):
    """Words that are not ASCII as names: IDNA is beyond SQL; unit vectors hold it."""
    words = _t(spark, d, "documents").select(F.explode(F.split("text", r"\s+")).alias("w")).filter(F.octet_length("w") > F.length("w")).distinct()
    return add_host(words, F.concat("w", F.lit(".ro"))).select("w", "n.host", "n.domain", "n.unicode_host", "n.unicode_domain")


@_query(f"SELECT page_id, h AS raw, true AS offered FROM (SELECT page_id, {_URL_HOST} AS h FROM pages) WHERE h LIKE '%.example.net'")
def scan_plain_list(spark, d):
    lines = normalize_url_host(spark, d).select(F.col("page_id").cast("string").alias("seq"), F.concat(F.lit("  "), "host", F.lit(" tail")).alias("line"))
    return lists.plain_list(lines, ("example.net",)).filter("offered").select(F.col("seq").cast("long").alias("page_id"), "raw", "offered")


@_query(
    f"""SELECT page_id, h AS raw, '{{"host_count":' || page_id || '}}' AS metadata, h LIKE '%.com' AS offered, false AS short FROM (SELECT page_id, {_URL_HOST} AS h FROM pages)"""
)
def scan_graph_vertices(spark, d):
    lines = normalize_url_host(spark, d).select(F.col("page_id").cast("string").alias("seq"), F.concat_ws("\t", F.lit("7"), scalars.reverse_labels(F.col("host")), F.col("page_id").cast("string")).alias("line"))
    return lists.graph_vertices(lines, "com").select(F.col("seq").cast("long").alias("page_id"), "raw", "metadata", "offered", "short")


@_query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name END AS raw, s_suppkey AS rank, s_suppkey % 5 = 0 AS short FROM supplier"""
)
def scan_rank_csv(spark, d):
    line = F.when(F.col("s_suppkey") % 5 == 0, F.col("s_suppkey").cast("string")).otherwise(F.concat(F.col("s_suppkey").cast("string"), F.lit(',"'), "s_name", F.lit('"')))
    lines = _t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("seq"), line.alias("line"))
    return lists.rank_csv(lines).select(F.col("seq").cast("long").alias("s_suppkey"), "raw", "rank", "short")


@_query(
    f"""SELECT page_id, unnest([url, h, trim(' x@' || h)]) AS raw, unnest(['website', 'website', 'email']) AS tag FROM (SELECT page_id, url, {_URL_HOST} AS h FROM pages)"""
)
def explode_tags(spark, d):
    rows = add_native_host(_t(spark, d, "pages"), F.col("url"), PAGE_RULES).select("page_id", "url", F.col("n.host").alias("h"))
    tags = F.create_map(F.lit("website"), F.concat("url", F.lit("; "), "h"), F.lit("email"), F.concat(F.lit(" x@"), "h"), F.lit("name"), F.lit("y"))
    seen = lists.map_objects(rows.select(F.lit("node").alias("osm_type"), F.col("page_id").alias("osm_id"), tags.alias("tags")))
    return seen.select(F.get_json_object("metadata", "$.osm_id").cast("long").alias("page_id"), "raw", F.get_json_object("metadata", "$.tag").alias("tag"))


# ---- registry ----

_ORD = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_OVER = ", ".join(_ORD)
_META = "CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END"


def _sightings(spark, d) -> DataFrame:
    rows = _t(spark, d, "lineitem")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return rows.select(
        F.col("l_partkey").cast("string").alias("domain"), F.col("l_suppkey").cast("string").alias("source_id"), F.struct(*_ORD).alias("ord"), day.alias("first_seen_at"), day.alias("last_seen_at"),
        F.lit(1).cast("long").alias("occurrences"), F.col("l_linenumber").cast("long").alias("best_rank"), F.expr(_META).alias("metadata_json"), F.col("l_orderkey"),
    )


def _domains(spark, d) -> DataFrame:
    return registry.fold_names(_sightings(spark, d).withColumn("unicode_domain", F.col("domain")), "domain", ["unicode_domain"])


def _domain_sources(spark, d) -> DataFrame:
    return registry.fold_sources(_sightings(spark, d), "domain", True)


def _sources(spark, d) -> DataFrame:
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    rows = _t(spark, d, "supplier").join(nation, "s_nationkey")
    return rows.select(F.col("s_suppkey").cast("string").alias("source_id"), (F.col("n_regionkey") == 1).cast("int").alias("public_export"))


_SEEN = f"""seen AS (SELECT l_partkey::VARCHAR AS domain, l_suppkey::VARCHAR AS source_id, strftime(l_shipdate, '%Y-%m-%d') AS day, l_linenumber AS rank, {_META} AS meta, l_orderkey,
    row_number() OVER (ORDER BY {_OVER}) AS ord FROM lineitem)"""
_DOM = "dom AS (SELECT domain, domain AS unicode_domain, arg_min(day, ord) AS first_seen_at, max(day) AS last_seen_at FROM seen GROUP BY domain)"
_SRC = "src AS (SELECT s_suppkey::VARCHAR AS source_id, (n_regionkey = 1)::INT AS public_export FROM supplier JOIN nation ON n_nationkey = s_nationkey)"
_FOLD = """SELECT domain, source_id, arg_min(day, ord) AS first_seen_at, max(day) AS last_seen_at, count(*) AS occurrences, min(rank)::BIGINT AS best_rank,
    arg_min(meta, ord) FILTER (meta IS NOT NULL) AS metadata_json FROM seen GROUP BY domain, source_id"""


@_query(f"WITH {_SEEN}, {_DOM} SELECT domain, first_seen_at, last_seen_at FROM dom")
def registry_fold_domains(spark, d):
    return _domains(spark, d).select("domain", "first_seen_at", "last_seen_at")


@_query(f"WITH {_SEEN} {_FOLD}")
def registry_fold_domain_sources(spark, d):
    return _domain_sources(spark, d)


@_query(f"WITH {_SEEN.replace(f'ORDER BY {_OVER}', f'ORDER BY l_orderkey % 2, {_OVER}')} {_FOLD}")
def registry_upsert_merge(spark, d):
    """Two imports, even orders first: the second is merged into the state that the first left."""
    seen = _sightings(spark, d)
    state = registry.fold_sources(seen.filter("l_orderkey % 2 = 0"), "domain", True)
    plain = "struct<o:int,ord:struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in seen.schema["ord"].dataType.fields) + ">>"
    prior = state.withColumn("ord", F.struct(F.lit(0).alias("o"), F.lit(None).cast(seen.schema["ord"].dataType).alias("ord")).cast(plain))
    batch = seen.filter("l_orderkey % 2 = 1").drop("l_orderkey").withColumn("ord", F.struct(F.lit(1).alias("o"), F.col("ord")))
    return registry.fold_sources(prior.unionByName(batch), "domain", True)


@_query(
    """SELECT DISTINCT l_partkey::VARCHAR AS domain, l_suppkey::VARCHAR AS source_id FROM lineitem a WHERE l_orderkey % 2 = 1
    AND NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey % 2 = 0 AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)"""
)
def registry_new_keys(spark, d):
    """Keys of a batch (odd orders) that the state (even orders) does not have."""
    seen, keys = _sightings(spark, d), ["domain", "source_id"]
    return seen.filter("l_orderkey % 2 = 1").select(*keys).distinct().join(seen.filter("l_orderkey % 2 = 0").select(*keys), keys, "left_anti")


@_query(
    """SELECT user_id, arg_min(props, row_number) FILTER (event_id % 3 <> 0) AS props
    FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS row_number FROM events) GROUP BY user_id"""
)
def first_non_null_metadata(spark, d):
    rows = _t(spark, d, "events").select(
        F.col("user_id").alias("domain"), F.lit("s").alias("source_id"), F.struct("ts", "event_id").alias("ord"), F.lit("x").alias("first_seen_at"), F.lit("x").alias("last_seen_at"),
        F.lit(1).cast("long").alias("occurrences"), F.lit(None).cast("long").alias("best_rank"), F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("metadata_json"),
    )
    return registry.fold_sources(rows, "domain", True).select(F.col("domain").alias("user_id"), F.col("metadata_json").alias("props"))


_PROV = """SELECT domain, unicode_domain, first_seen_at, last_seen_at, count(DISTINCT source_id) AS source_count, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources
    FROM dom JOIN (SELECT DISTINCT domain, source_id FROM seen) USING (domain) JOIN src USING (source_id)"""


@_query(f"WITH {_SEEN}, {_DOM}, {_SRC} {_PROV} GROUP BY ALL")
def domain_export_all(spark, d):
    return registry.provenance(_domains(spark, d), _domain_sources(spark, d), _sources(spark, d))


@_query(f"WITH {_SEEN}, {_DOM}, {_SRC} {_PROV} WHERE public_export = 1 GROUP BY ALL")
def domain_export_public(spark, d):
    return registry.provenance(_domains(spark, d), _domain_sources(spark, d), _sources(spark, d), True)


@_query(f"WITH {_SEEN}, {_SRC} SELECT DISTINCT domain FROM seen JOIN src USING (source_id) WHERE public_export = 1")
def domain_export_plain(spark, d):
    return registry.plain_domains(_domains(spark, d), _domain_sources(spark, d), _sources(spark, d), True)


@_query(
    f"""WITH {_SEEN}, {_SRC} SELECT (SELECT count(DISTINCT domain) FROM seen) AS domains,
    (SELECT count(DISTINCT domain) FROM seen JOIN src USING (source_id) WHERE public_export = 1) AS public_export_domains,
    (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS hostnames, (SELECT count(*) FROM src) AS sources_catalogued,
    (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F') AS sources_imported"""
)
def stats_totals(spark, d):
    state = {"domains": _domains(spark, d), "domain_sources": _domain_sources(spark, d), "hostnames": _t(spark, d, "lineitem").select("l_orderkey").distinct()}
    runs = _t(spark, d, "orders").select(F.col("o_custkey").alias("source_id"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running").alias("status"))
    return registry.stats_totals(state, _sources(spark, d), runs)


@_query(f"WITH {_SEEN}, {_SRC} SELECT source_id, count(DISTINCT domain) AS domains, public_export FROM seen JOIN src USING (source_id) GROUP BY source_id, public_export ORDER BY domains DESC, source_id")
def stats_by_source(spark, d):
    return registry.stats_by_source(_domain_sources(spark, d), _sources(spark, d))


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def pk_duplicates(spark, d):
    return quality.duplicate_keys(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')")
def enum_violations(spark, d):
    return quality.enum_violations(_t(spark, d, "orders"), "o_orderstatus", ("F", "O")).select("o_orderkey", "o_orderstatus")


@_query(
    """SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 1) GROUP BY l_suppkey"""
)
def public_semi_join(spark, d):
    public = registry.public_domains(_sightings(spark, d), _sources(spark, d))
    rows = _t(spark, d, "lineitem").withColumn("domain", F.col("l_partkey").cast("string"))
    return registry.only_public(rows, public).groupBy("l_suppkey").agg(F.count("*").alias("n"))


@_query(
    """SELECT s_suppkey AS source_id, s_name || CASE WHEN s_acctbal > 0 THEN ' new' ELSE '' END AS name FROM supplier"""
)
def catalog_sync(spark, d):
    """New descriptions of the sources with a balance; the others stay as they were."""
    rows = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("name"), "s_acctbal")
    new = rows.filter("s_acctbal > 0").select("source_id", F.concat("name", F.lit(" new")).alias("name"))
    return catalog.sync_catalog(rows.drop("s_acctbal"), new)


@_query("SELECT doc_id, sha256(text) AS digest FROM documents")
def sha256_rows(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


# ---- lookups ----

_STATUS = "element_at(array('NOERROR', 'NXDOMAIN', 'SERVFAIL', 'TIMEOUT', 'REFUSED', 'ERROR', 'servfail'), cast(event_id % 7 as int) + 1)"
_ERROR = "element_at(array('Rate limit exceeded', 'rate limiter: deadline', 'i/o timeout', null), cast(event_id % 4 as int) + 1)"
_TYPE = "element_at(map('click', 'A', 'view', 'AAAA', 'purchase', 'MX', 'signup', 'NS'), event_type)"
_D_STATUS = "['NOERROR', 'NXDOMAIN', 'SERVFAIL', 'TIMEOUT', 'REFUSED', 'ERROR', 'servfail'][event_id % 7 + 1]"
_D_ERROR = "['Rate limit exceeded', 'rate limiter: deadline', 'i/o timeout', NULL][event_id % 4 + 1]"
_D_CLASS = f"""CASE WHEN s IN ('NOERROR', 'NXDOMAIN') THEN NULL WHEN lower(coalesce(e, '')) LIKE '%rate limit exceeded%' THEN 'local_rate_limit' WHEN lower(coalesce(e, '')) LIKE '%rate limiter%' THEN 'local_rate_limiter_deadline'
    WHEN s = 'TIMEOUT' OR lower(coalesce(e, '')) LIKE '%timeout%' THEN 'timeout' WHEN s = 'SERVFAIL' THEN 'servfail' WHEN s = 'REFUSED' THEN 'refused' ELSE 'other' END"""
_CLASSED = f"(SELECT event_id, s, {_D_CLASS} AS error_class FROM (SELECT event_id, upper({_D_STATUS}) AS s, {_D_ERROR} AS e FROM events))"
_LATEST = "(SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)"


@_query(f"SELECT user_id, event_type, event_id, ts, value, props FROM {_LATEST} WHERE rn = 1")
def consolidate_latest(spark, d):
    return dns.latest(_t(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])


def _classed(spark, d) -> DataFrame:
    rows = _t(spark, d, "events").select("event_id", scalars.clean_status(F.expr(_STATUS)).alias("status"), F.expr(_ERROR).alias("error"))
    return rows.withColumn("error_class", scalars.classify_error(F.col("status"), F.col("error")))


@_query(f"SELECT event_id, s AS status, error_class FROM {_CLASSED}")
def classify_error(spark, d):
    return _classed(spark, d).select("event_id", "status", "error_class")


@_query(f"SELECT s AS status, count(*) AS n FROM {_CLASSED} GROUP BY 1")
def status_histogram(spark, d):
    return dns.histogram(_classed(spark, d), "status", "status")


@_query(f"SELECT coalesce(error_class, 'none') AS error_class, count(*) AS n FROM {_CLASSED} GROUP BY 1")
def error_class_histogram(spark, d):
    return dns.histogram(_classed(spark, d), "error_class", "error_class")


def _result_lines(spark, d) -> DataFrame:
    """Result lines as a prober would write them: one for each pass and name, made of the last lookup of each type."""
    rows = _t(spark, d, "events").withColumn("query_type", F.coalesce(F.expr(_TYPE), F.lit("OTHER"))).withColumn("pass", F.col("event_id") % 5 + 1)
    won = dns.latest(rows.select("user_id", "query_type", "pass", "ts", "event_id", "value"), ["user_id", "query_type", "pass"], ["ts", "event_id"])
    result = F.struct(F.expr(_STATUS).alias("status"), F.expr(_ERROR).alias("error"), F.col("value").alias("duration"))
    one = won.groupBy("pass", "user_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("query_type", result.alias("r"))), lambda a, b: F.when(a["query_type"] < b["query_type"], -1).otherwise(1))).alias("results"))
    line = F.to_json(F.struct(F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit(".")).alias("name"), "results"))
    return one.select("pass", F.col("user_id").alias("line_no"), line.alias("value"))


_D_TYPE = "coalesce(map {'click': 'A', 'view': 'AAAA', 'purchase': 'MX', 'signup': 'NS'}[event_type], 'OTHER')"
_LINES = f"""lines AS (SELECT user_id, pass, query_type, {_D_STATUS} AS st, {_D_ERROR} AS err, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, query_type, pass ORDER BY ts DESC, event_id DESC) AS rn
    FROM (SELECT *, {_D_TYPE} AS query_type, event_id % 5 + 1 AS pass FROM events)) WHERE rn = 1)"""


@_query(
    f"""WITH {_LINES} SELECT domain, query_type, status, attempt_sequence, source_pass FROM (
    SELECT 'u' || user_id AS domain, query_type, upper(st) AS status, pass::INT AS attempt_sequence, 'pass' || pass AS source_pass, row_number() OVER (PARTITION BY user_id, query_type ORDER BY pass DESC) AS rn FROM lines) WHERE rn = 1"""
)
def consolidate_passes(spark, d):
    lines = _result_lines(spark, d)
    parsed = dns.parse_lines(lines, keep=("pass",)).withColumns({"source_pass": F.concat(F.lit("pass"), "pass"), "attempt_sequence": F.col("pass").cast("int")})
    return dns.query_results(dns.consolidate(dns.lookups(parsed))).select("domain", "query_type", "status", "attempt_sequence", "source_pass")


_QUEUE = "SELECT user_id AS line_no, 'U' || user_id || '.,,' || string_agg('retry-' || lower(query_type), ',' ORDER BY query_type) AS line FROM lines WHERE pass = 1 AND query_type <> 'OTHER' AND"


@_query(f"WITH {_LINES} {_QUEUE} upper(st) NOT IN ('NOERROR', 'NXDOMAIN') GROUP BY user_id")
def retry_queue_failed(spark, d):
    return dns.retry_queue(dns.parse_lines(_result_lines(spark, d).filter("pass = 1"), strict=False))


@_query(f"WITH {_LINES} {_QUEUE} upper(st) IN ('ERROR', 'SERVFAIL') GROUP BY user_id")
def retry_queue_status(spark, d):
    return dns.retry_queue(dns.parse_lines(_result_lines(spark, d).filter("pass = 1"), strict=False), (" error", "servfail"))


@_query("SELECT event_id, round(floor(value) / 8 * 1000, 3) AS ms FROM events")
def duration_ms(spark, d):
    return _t(spark, d, "events").select("event_id", scalars.to_milliseconds(F.floor("value") / 8).alias("ms"))


@_query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, 'none' AS absent FROM events")
def json_flatten(spark, d):
    rows = _t(spark, d, "events").withColumn("v", F.parse_json("props"))
    return rows.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.coalesce(F.try_variant_get("v", "$.x", "string"), F.lit("none")).alias("absent"))


@_query("SELECT count(*) AS n, count(*) FILTER (NOT json_valid(t)) AS invalid FROM (SELECT text AS t FROM documents UNION ALL SELECT props FROM events)")
def json_invalid_count(spark, d):
    lines = _t(spark, d, "documents").select(F.col("text").alias("value")).union(_t(spark, d, "events").select("props")).withColumn("line_no", F.lit(0))
    return dns.parse_lines(lines, strict=False).agg(F.count("*").alias("n"), F.count_if("invalid").alias("invalid"))


@_query(
    """SELECT u.domain, t.event_type AS query_type, EXISTS (SELECT 1 FROM events e WHERE e.user_id || '-' || (e.event_id % 5 + 1) = u.domain AND e.event_type = t.event_type) AS present
    FROM (SELECT DISTINCT user_id || '-' || (event_id % 5 + 1) AS domain FROM events) u CROSS JOIN (SELECT DISTINCT event_type FROM events) t"""
)
def completeness_cross(spark, d):
    """Which types each name has in each pass."""
    events = _t(spark, d, "events")
    types = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").collect()]  # the type list
    return dns.completeness(events.select(F.concat_ws("-", F.col("user_id").cast("string"), (F.col("event_id") % 5 + 1).cast("string")).alias("domain"), F.col("event_type").alias("query_type")), types)


@_query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def arrival_windows(spark, d):
    return ingest.arrivals(_t(spark, d, "events")).select(F.col("window.start").alias("hour"), "event_type", "n")


from zonekeep.plans import file_queries  # noqa: E402, F401  registers the queries that go through files
