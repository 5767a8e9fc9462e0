"""Queries that go through files: lists and tables are written, read by the scans, imported, consolidated, exported and checked again.

Files are made from the driver's tables in the shared folder; a stored registry
and a measured run are made once for each session and folder of tables.
"""

from __future__ import annotations

import contextlib
import io
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonekeep.functions.scalars import utc_now
from zonekeep.operators import dns, progress, quality, registry, sinks
from zonekeep.plans import dns_run
from zonekeep.plans.queries import _D_CLASS, _D_ERROR, _D_STATUS, _D_TYPE, _ERROR, _LAST3, _LINES, _STATUS, _TYPE, _URL_HOST, PAGE_RULES, _query, _result_lines, _t
from zonekeep.plans.registry import Registry
from zonekeep.sources import catalog, inputs, lists
from zonekeep.store import scratch

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_MADE: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, d: str, label: str, make) -> str:
    """The folder that ``make(folder)`` filled, made once for a session and a folder of tables."""
    key = (spark.sparkContext.applicationId, d, label)
    if key not in _MADE:
        folder = scratch(spark, label)
        make(folder)
        _MADE[key] = folder
    return _MADE[key]


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# ---- lists ----


@_query(
    """SELECT kind, (row_number() OVER (PARTITION BY kind ORDER BY url))::BIGINT AS position, url AS line FROM pages, (SELECT unnest(['plain', 'packed']) AS kind)"""
)
def text_list_formats(spark, d):
    """Sorted text exports, plain and compressed, and their lines in order of the file."""
    folder, out = scratch(spark, "text-lists"), None
    for kind, path in (("plain", f"{folder}/urls.txt"), ("packed", f"{folder}/urls.txt.gz")):
        sinks.export_lines(_t(spark, d, "pages").select(F.col("url").alias("line")), path, ["line"])
        lines = lists.text_lines(spark, path)
        one = lines.select(F.lit(kind).alias("kind"), F.row_number().over(Window.orderBy("seq")).cast("long").alias("position"), "line")
        out = one if out is None else out.unionByName(one)
    return out


@_query("SELECT c_name AS raw, c_custkey AS rank, true AS offered FROM customer")
def scan_header_csv(spark, d):
    path = f"{scratch(spark, 'header-csv')}/customers.csv"
    sinks.export_csv(_t(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_name"), path, ["c_custkey"])
    return lists.header_csv(lists.text_lines(spark, path), "c_name", "c_custkey").select("raw", "rank", "offered")


@_query("""SELECT c_name AS raw, '{"cui":"' || c_custkey || '","status":"' || c_mktsegment || '"}' AS metadata FROM customer WHERE c_custkey % 3 = 0""")
def scan_contacts(spark, d):
    folder = scratch(spark, "contacts")
    kind = F.when(F.col("c_custkey") % 3 == 0, "website").otherwise("phone")
    rows = _t(spark, d, "customer").select(F.col("c_custkey").alias("cui"), kind.alias("type"), F.col("c_name").alias("value"), F.col("c_mktsegment").alias("status"))
    rows.write.csv(f"{folder}/data/contacts", header=True)
    return lists.contacts(spark, folder).select("raw", "metadata")


def _write_catalog(spark: SparkSession, d: str, path: str) -> None:
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    rows = _t(spark, d, "supplier").join(nation, "s_nationkey").select(F.col("s_suppkey").cast("string").alias("source_id"), F.col("s_name").alias("name"), F.lit("allowed").alias("redistribution_status"), (F.col("n_regionkey") == 1).cast("int").alias("public_export"))
    sinks.export_lines(rows.agg(F.to_json(F.sort_array(F.collect_list(F.struct("*")))).alias("line")), path, ["line"])


@_query("SELECT s_suppkey::VARCHAR AS source_id, s_name AS name, (n_regionkey = 1)::INT AS public_export FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def read_source_catalog(spark, d):
    path = f"{scratch(spark, 'catalog')}/sources.json"
    _write_catalog(spark, d, path)
    return catalog.read_catalog(spark, path).select("source_id", "name", "public_export")


@_query("SELECT n_name AS key, n_nationkey || '=' || n_regionkey AS value FROM nation")
def read_settings_file(spark, d):
    path = f"{scratch(spark, 'settings')}/config.txt"
    lines = _t(spark, d, "nation").select(F.concat_ws("=", "n_name", F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")).alias("line"))
    sinks.export_lines(lines.union(_rows(spark, [("no separator",)], "line string")), path, ["line"])
    return _rows(spark, list(catalog.read_settings(spark, path).items()), "key string, value string")


# ---- the stored registry ----

_OPEN, _CLOSED = "1", "2"


def _registry(spark: SparkSession, d: str) -> Registry:
    """All pages imported by one source, twice; every second one by another; and an import that fails."""

    def make(folder: str) -> None:
        _write_catalog(spark, d, f"{folder}/sources.json")
        store = Registry(spark, f"{folder}/registry", PAGE_RULES)
        store.sync(f"{folder}/sources.json")
        pages = _t(spark, d, "pages").select("page_id", "url").union(_t(spark, d, "supplier").select(F.col("s_suppkey"), "s_name"))
        sinks.export_csv(pages, f"{folder}/all.csv", ["page_id", "url"])
        sinks.export_csv(pages.filter("page_id % 2 = 0"), f"{folder}/half.csv.gz", ["page_id", "url"])
        for day in ("2026-01-01", "2026-01-02"):
            store.import_file(_OPEN, f"{folder}/all.csv", "csv", "url", "page_id", day)
        store.import_file(_CLOSED, f"{folder}/half.csv.gz", "csv", "url", "page_id", "2026-02-03")
        with contextlib.suppress(ValueError):
            store.import_file(_CLOSED, f"{folder}/all.csv", "csv", "missing", None, "2026-03-04")

    return Registry(spark, f"{_once(spark, d, 'registry-files', make)}/registry", PAGE_RULES)


_NAMES = f"""raw AS (SELECT page_id, url AS raw FROM pages UNION ALL SELECT s_suppkey, s_name FROM supplier),
    good AS (SELECT page_id, h, {_LAST3.format(h="h")} AS domain FROM (SELECT page_id, {_URL_HOST} AS h FROM pages)),
    each AS (SELECT '1' AS source_id, '2026-01-01' AS day, * FROM good UNION ALL SELECT '2', '2026-02-03', * FROM good WHERE page_id % 2 = 0)"""


@_query(
    f"""WITH {_NAMES} SELECT 1::BIGINT AS run_id, '1' AS source_id, (SELECT count(*) FROM raw) AS rows_read, (SELECT count(*) FROM good) AS hostnames_accepted, (SELECT count(DISTINCT domain) FROM good) AS domains_new,
        (SELECT count(DISTINCT h) FROM good) AS hostnames_new, (SELECT count(*) FROM supplier) AS rejected, 'completed' AS status
    UNION ALL SELECT 2, '2', (SELECT count(*) FROM raw WHERE page_id % 2 = 0), (SELECT count(*) FROM good WHERE page_id % 2 = 0), 0, 0, (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0), 'completed'
    UNION ALL SELECT 3, '2', 0, 0, 0, 0, 0, 'failed'"""
)
def registry_import_runs(spark, d):
    """The log of runs: the second import of the same file by the same source leaves none, the failed one leaves its line only."""
    return _registry(spark, d).tables()["import_runs"].select("run_id", "source_id", "rows_read", "hostnames_accepted", "domains_new", "hostnames_new", "rejected", "status")


@_query(f"WITH {_NAMES} SELECT domain, source_id, day AS first_seen_at, day AS last_seen_at, count(*) AS occurrences, min(page_id)::BIGINT AS best_rank FROM each GROUP BY ALL")
def idempotent_reimport(spark, d):
    """The stored domains by source after the same file was imported twice."""
    return _registry(spark, d).tables()["domain_sources"].select("domain", "source_id", "first_seen_at", "last_seen_at", "occurrences", "best_rank")


@_query(f"WITH {_NAMES} SELECT h AS hostname, domain AS registrable_domain, min(day) AS first_seen_at, max(day) AS last_seen_at, count(DISTINCT source_id) AS sources FROM each GROUP BY ALL")
def registry_stored_hostnames(spark, d):
    t = _registry(spark, d).tables()
    sources = t["hostname_sources"].groupBy("hostname").agg(F.count("*").alias("sources"))
    return t["hostnames"].join(sources, "hostname").select("hostname", "registrable_domain", "first_seen_at", "last_seen_at", "sources")


@_query("SELECT unnest(['duplicate_domain_sources', 'duplicate_domains', 'duplicate_hostname_sources', 'duplicate_hostnames', 'duplicate_import_runs', 'duplicate_sources', 'foreign_key_errors', 'invalid_seen_order', 'invalid_suffix', 'ok', 'orphan_hostnames', 'unfinished_imports', 'unknown_redistribution_status', 'unreadable_tables']) AS name, unnest([0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0])::BIGINT AS n")
def registry_stored_verify(spark, d):
    return _rows(spark, [(k, int(v)) for k, v in _registry(spark, d).verify().items()], "name string, n long")


@_query(
    f"""WITH {_NAMES}, src AS (SELECT s_suppkey::VARCHAR AS source_id, n_regionkey = 1 AS public FROM supplier JOIN nation ON n_nationkey = s_nationkey)
    SELECT 'domains' AS name, count(DISTINCT domain) AS n FROM good UNION ALL SELECT 'hostnames', count(DISTINCT h) FROM good
    UNION ALL SELECT 'public_export_domains', count(DISTINCT domain) FROM each JOIN src USING (source_id) WHERE public
    UNION ALL SELECT 'sources_catalogued', count(*) FROM supplier UNION ALL SELECT 'sources_imported', 2 UNION ALL SELECT 'by_source ' || source_id, count(DISTINCT domain) FROM each GROUP BY source_id"""
)
def registry_stored_stats(spark, d):
    facts = _registry(spark, d).stats()
    rows = [(k, v) for k, v in facts.items() if k != "by_source"] + [(f"by_source {r['source_id']}", r["domains"]) for r in facts["by_source"]]
    return _rows(spark, rows, "name string, n long")


@_query(
    f"""WITH {_NAMES} SELECT (row_number() OVER (ORDER BY domain))::BIGINT AS position, domain, unicode_domain, first_seen_at, last_seen_at, source_count, sources FROM (
    SELECT domain, domain AS unicode_domain, min(day) AS first_seen_at, max(day) AS last_seen_at, count(DISTINCT source_id)::VARCHAR AS source_count, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources FROM each GROUP BY domain)"""
)
def registry_export_file(spark, d):
    """The exported CSV of all domains with their sources, read back in order of the file."""
    path = f"{scratch(spark, 'export')}/domains.csv.gz"
    _registry(spark, d).export(path)
    rows = spark.read.csv(path, header=True, escape='"').withColumn("at", F.monotonically_increasing_id())
    return rows.withColumn("position", F.row_number().over(Window.orderBy("at")).cast("long")).drop("at")


@_query(
    """WITH domains AS (SELECT 'd' || c_custkey || CASE WHEN c_custkey % 10 = 0 THEN '.com' ELSE '.ro' END AS domain, c_custkey FROM customer),
    hosts AS (SELECT o_orderkey, 'd' || (o_custkey + CASE WHEN o_orderkey % 11 = 0 THEN 100000000 ELSE 0 END) || CASE WHEN o_custkey % 10 = 0 THEN '.com' ELSE '.ro' END AS domain FROM orders),
    lost AS (SELECT count(*) AS n FROM hosts WHERE domain NOT IN (SELECT domain FROM domains))
    SELECT (SELECT count(*) FROM domains WHERE domain LIKE '%.com') AS invalid_suffix, (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0) AS invalid_seen_order,
    ((SELECT n FROM lost) + (SELECT count(*) FROM customer WHERE c_custkey % 12 NOT IN (SELECT s_suppkey FROM supplier)) + (SELECT count(*) FROM orders WHERE o_orderkey % 12 NOT IN (SELECT s_suppkey FROM supplier))
        + (SELECT count(*) FROM nation WHERE n_nationkey + 1 NOT IN (SELECT s_suppkey FROM supplier)))::BIGINT AS foreign_key_errors,
    (SELECT n FROM lost) AS orphan_hostnames, (SELECT count(*) FROM nation WHERE n_regionkey = 1) AS unfinished_imports, false AS ok"""
)
def quality_verify(spark, d):
    """All checks over a registry with violations of every kind."""
    customer, orders = _t(spark, d, "customer"), _t(spark, d, "orders")
    name = lambda number, key: F.concat(F.lit("d"), number.cast("string"), F.when(key % 10 == 0, ".com").otherwise(".ro"))
    domain = name(F.col("c_custkey"), F.col("c_custkey"))
    tables = {
        "domains": customer.select(domain.alias("domain"), F.when(F.col("c_custkey") % 7 == 0, "2025").otherwise("2024").alias("first_seen_at"), F.lit("2024-06").alias("last_seen_at")),
        "hostnames": orders.select(F.concat(F.lit("h"), "o_orderkey").alias("hostname"), name(F.col("o_custkey") + F.when(F.col("o_orderkey") % 11 == 0, 100000000).otherwise(0), F.col("o_custkey")).alias("registrable_domain")),
        "sources": _t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("source_id")),
        "domain_sources": customer.select(domain.alias("domain"), (F.col("c_custkey") % 12).cast("string").alias("source_id")),
        "hostname_sources": orders.select(F.concat(F.lit("h"), "o_orderkey").alias("hostname"), (F.col("o_orderkey") % 12).cast("string").alias("source_id")),
        "import_runs": _t(spark, d, "nation").select((F.col("n_nationkey") + 1).cast("string").alias("source_id"), F.when(F.col("n_regionkey") == 1, "running").otherwise("completed").alias("status")),
    }
    return quality.verify(tables)


@_query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def dataset_manifest(spark, d):
    """Row counts of all tables, written as a manifest and read back."""
    path = f"{scratch(spark, 'manifest')}/manifest.json"
    sinks.write_manifest(spark, path, {t: {"rows": _t(spark, d, t).count()} for t in TABLES})
    return _rows(spark, [(t, f["rows"]) for t, f in json.loads(sinks.read_text_file(spark, path)).items()], "table_name string, n long")


# ---- a measured run ----

_PASS_NAMES = "['pass1', 'pass2', 'pass3', 'pass4_local_errors', 'pass5_final_local_errors']"


def _probe_lines(spark: SparkSession, d: str) -> DataFrame:
    """pass, line_no, line: results with records in all sections, made of the last event of each name, type and pass."""
    rows = _t(spark, d, "events").withColumn("query_type", F.coalesce(F.expr(_TYPE), F.lit("OTHER"))).withColumn("pass", F.col("event_id") % 5 + 1)
    won = dns.latest(rows.select("user_id", "query_type", "pass", "ts", "event_id", "value"), ["user_id", "query_type", "pass"], ["ts", "event_id"])
    name = F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("."))
    answer = F.struct(
        name.alias("name"), F.col("query_type").alias("type"), F.lit("IN").alias("class"), (F.col("event_id") % 1000).alias("ttl"), F.concat(F.lit("10.0.0."), (F.col("event_id") % 250).cast("string")).alias("answer"),
        F.when(F.col("query_type") == "MX", F.col("event_id") % 50).alias("preference"),
    )
    zone = F.struct(F.lit("zone.").alias("name"), F.lit("SOA").alias("type"), F.lit(60).alias("ttl"), F.lit("ns1.").alias("ns"), F.col("event_id").alias("serial"), F.lit(5).alias("min_ttl"))
    data = F.struct(
        F.when(F.col("event_id") % 7 == 0, F.array(answer)).alias("answers"), F.when(F.col("event_id") % 3 == 0, F.array(zone)).alias("authorities"),
        F.array(F.struct(F.lit("EDNS0").alias("type"), F.lit(512).alias("udp"))).alias("additionals"), F.struct((F.col("event_id") % 2 == 0).alias("authoritative")).alias("flags"),
        F.concat(F.lit("r"), (F.col("event_id") % 3).cast("string")).alias("resolver"), F.lit("udp").alias("protocol"),
    )
    result = F.struct(F.expr(_STATUS).alias("status"), F.expr(_ERROR).alias("error"), (F.floor("value") / 8).alias("duration"), F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("timestamp"), data.alias("data"))
    one = won.groupBy("pass", "user_id").agg(F.map_from_entries(F.collect_list(F.struct("query_type", result.alias("r")))).alias("results"))
    return one.select("pass", F.col("user_id").alias("line_no"), F.to_json(F.struct(F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit(".")).alias("name"), "results")).alias("line"))


def _run(spark: SparkSession, d: str) -> str:
    """A measured run of five passes, consolidated."""

    def make(folder: str) -> None:
        _probe_lines(spark, d).write.partitionBy("pass").parquet(f"{folder}/lines")
        for k, (_, sub) in enumerate(dns_run.PASSES, 1):
            sinks.export_lines(spark.read.schema("line_no long, line string").parquet(f"{folder}/lines/pass={k}"), f"{folder}/run-7/{sub}/results.jsonl.gz", ["line_no"])
            sinks.write_text_file(spark, f"{folder}/run-7/{sub}/finished_at.txt", f"day {k}\n")
        sinks.write_text_file(spark, f"{folder}/run-7/started_at.txt", "day 0\n")
        sinks.write_text_file(spark, f"{folder}/run-7/config.txt", f"domains={_t(spark, d, 'events').select('user_id').distinct().count()}\ntype_count=5\nbase_logical_queries=12\nzdns_version=v=2\n")
        dns_run.consolidate_run(spark, f"{folder}/run-7", f"{folder}/out", export_dir=f"{folder}/csv")

    return _once(spark, d, "dns-run", make)


_PROBES = f"""probes AS (SELECT *, row_number() OVER (PARTITION BY user_id, query_type ORDER BY pass DESC) AS latest FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, query_type, pass ORDER BY ts DESC, event_id DESC) AS rn FROM (SELECT *, {_D_TYPE} AS query_type, event_id % 5 + 1 AS pass FROM events)) WHERE rn = 1),
    found AS (SELECT *, 'u' || user_id AS domain, {_PASS_NAMES}[pass] AS source_pass, upper({_D_STATUS}) AS s, {_D_ERROR} AS e, (event_id % 7 = 0)::INT + (event_id % 3 = 0)::INT AS n FROM probes),
    won AS (SELECT *, {_D_CLASS} AS error_class FROM found WHERE latest = 1),
    records AS (SELECT domain, query_type, 'answer' AS section, 'U' || user_id || '.' AS owner_name, query_type AS record_type, event_id % 1000 AS ttl, '10.0.0.' || event_id % 250 AS value,
            CASE WHEN query_type = 'MX' THEN event_id % 50 END AS preference, NULL::BIGINT AS serial, NULL::BIGINT AS minimum_ttl,
            '{{"answer":"10.0.0.' || event_id % 250 || '"' || CASE WHEN query_type = 'MX' THEN ',"preference":' || event_id % 50 ELSE '' END || '}}' AS rdata_json, source_pass, 0 AS position FROM won WHERE event_id % 7 = 0
        UNION ALL SELECT domain, query_type, 'authority', 'zone.', 'SOA', 60, 'ns1.', NULL, event_id, 5, '{{"min_ttl":5,"ns":"ns1.","serial":' || event_id || '}}', source_pass, (event_id % 7 = 0)::INT FROM won WHERE event_id % 3 = 0)"""


@_query(
    f"""WITH {_PROBES} SELECT domain, query_type, s AS status, 't' || event_id AS queried_at, round(floor(value) / 8 * 1000, 3) AS duration_ms, 'r' || event_id % 3 AS resolver, 'udp' AS protocol, source_pass, pass::INT AS attempt_sequence,
    error_class, (event_id % 2 = 0)::INT AS authoritative, n::INT AS record_count FROM won"""
)
def dns_run_results(spark, d):
    columns = "domain query_type status queried_at duration_ms resolver protocol source_pass attempt_sequence error_class authoritative record_count".split()
    return spark.read.parquet(f"{_run(spark, d)}/out/query_results").select(*columns)


@_query(f"WITH {_PROBES} SELECT * FROM records")
def dns_run_records(spark, d):
    """Records of all sections of the winning lookups, without the pseudo records."""
    columns = "domain query_type section owner_name record_type ttl value preference serial minimum_ttl rdata_json source_pass position".split()
    return spark.read.parquet(f"{_run(spark, d)}/out/dns_records").select(*columns)


@_query(
    f"""SELECT 'run-7' AS snapshot_id, 'day 0' AS started_at, 'day 5' AS completed_at, (SELECT count(DISTINCT user_id) FROM events) AS domain_count, 5::BIGINT AS query_type_count, 12::BIGINT AS expected_queries, 5::BIGINT AS pass_count,
    'ZDNS v=2' AS tool, '{dns_run._NOTE}' AS notes"""
)
def dns_run_snapshot(spark, d):
    return spark.read.parquet(f"{_run(spark, d)}/out/snapshots")


@_query(
    f"""WITH {_PROBES} SELECT 'statuses' AS kind, s AS key, count(*) AS n FROM won GROUP BY ALL UNION ALL SELECT 'error_classes', coalesce(error_class, 'none'), count(*) FROM won GROUP BY ALL
    UNION ALL SELECT 'record_types', record_type, count(*) FROM records GROUP BY ALL UNION ALL SELECT 'total', 'query_results', count(*) FROM won UNION ALL SELECT 'total', 'dns_records', count(*) FROM records
    UNION ALL SELECT 'total', 'domains', count(DISTINCT domain) FROM won"""
)
def dns_run_summary(spark, d):
    """The written summary of a run, one row a fact."""
    facts = json.loads(sinks.read_text_file(spark, f"{_run(spark, d)}/out/summary.json"))
    rows = [(kind, k, n) for kind in ("statuses", "error_classes", "record_types") for k, n in facts[kind].items()]
    return _rows(spark, rows + [("total", k, facts[k]) for k in ("query_results", "dns_records", "domains")], "kind string, key string, n long")


@_query(
    f"""WITH {_PROBES} SELECT source_pass, count(DISTINCT domain) AS domains, count(*) AS queries, sum(n)::BIGINT AS records,
    (SELECT string_agg(s || '=' || c, ',' ORDER BY s) FROM (SELECT s, count(*) AS c FROM found f WHERE f.source_pass = found.source_pass GROUP BY s)) AS statuses FROM found GROUP BY source_pass"""
)
def pass_report(spark, d):
    facts = json.loads(sinks.read_text_file(spark, f"{_run(spark, d)}/out/summary.json"))["passes"]
    rows = [(p["source_pass"], p["domains"], p["queries"], p["records"], ",".join(f"{k}={n}" for k, n in sorted(p["statuses"].items()))) for p in facts]
    return _rows(spark, rows, "source_pass string, domains long, queries long, records long, statuses string")


@_query(f"WITH {_PROBES} SELECT 'dns_query_results.csv.gz' AS file, count(*) AS n FROM won UNION ALL SELECT 'dns_records.csv.gz', count(*) FROM records")
def dns_run_exports(spark, d):
    """The exported tables, read back with the columns in their published order."""
    out = None
    for name, columns in (("dns_query_results", dns.QUERY_COLUMNS), ("dns_records", dns.RECORD_COLUMNS)):
        read = spark.read.csv(f"{_run(spark, d)}/csv/{name}.csv.gz", header=True, escape='"', multiLine=True)
        if read.columns != list(columns):
            raise ValueError(f"columns of {name} are {read.columns}")
        one = read.agg(F.lit(f"{name}.csv.gz").alias("file"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@_query(
    f"""WITH {_PROBES} SELECT 'domains_public.csv.gz' AS file, count(DISTINCT user_id) AS n, true AS sound FROM events WHERE user_id % 2 = 0
    UNION ALL SELECT 'dns_query_results_public.csv.gz', count(*), true FROM won WHERE user_id % 2 = 0 UNION ALL SELECT 'dns_records_public.csv.gz', count(*), true FROM records WHERE ltrim(domain, 'u')::BIGINT % 2 = 0"""
)
def dns_publish_manifest(spark, d):
    """What may be published of a run, and whether each file is still what the manifest says."""
    out = scratch(spark, "published")
    names = _t(spark, d, "events").select("user_id").distinct()
    domain = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("domain")
    tables = {
        "domains": names.select(domain, domain.alias("unicode_domain"), F.lit("2026").alias("first_seen_at"), F.lit("2026").alias("last_seen_at")),
        "domain_sources": names.select(domain, F.when(F.col("user_id") % 2 == 0, "open").otherwise("closed").alias("source_id")),
        "sources": _rows(spark, [("open", 1), ("closed", 0)], "source_id string, public_export int"),
    }
    facts = dns_run.publish(spark, tables, f"{_run(spark, d)}/out", out)
    sound = sinks.check_manifest(spark, f"{out}/manifest.json")
    return _rows(spark, [(k, facts[k]["rows"], sound[k]) for k in sound], "file string, n long, sound boolean")


@_query(
    f"""WITH {_LINES}, first AS (SELECT user_id, query_type, upper(st) AS s, upper(st) NOT IN ('NOERROR', 'NXDOMAIN') AND query_type <> 'OTHER' AS hit FROM lines WHERE pass = 1)
    SELECT 'rows' AS name, count(DISTINCT user_id) AS n FROM first UNION ALL SELECT 'invalid_json_lines', 0 UNION ALL SELECT 'domains_with_failed_types', count(DISTINCT user_id) FROM first WHERE hit
    UNION ALL SELECT 'failed_type_queries', count(*) FROM first WHERE hit UNION ALL SELECT 'status ' || s, count(*) FROM first GROUP BY s UNION ALL SELECT 'type ' || query_type, count(*) FROM first WHERE hit GROUP BY query_type"""
)
def retry_summary(spark, d):
    facts = dns.retry_summary(dns.parse_lines(_result_lines(spark, d).filter("pass = 1"), strict=False))
    rows = [(k, v) for k, v in facts.items() if isinstance(v, int)]
    rows += [(f"status {k}", n) for k, n in facts["status_counts"].items()] + [(f"type {k}", n) for k, n in facts["failed_type_counts"].items()]
    return _rows(spark, rows, "name string, n long")


@_query(f"WITH {_LINES} SELECT name, count(DISTINCT user_id) AS n FROM (SELECT user_id, unnest(['pass1', 'pass2']) AS name, unnest([true, upper(st) NOT IN ('NOERROR', 'NXDOMAIN') AND query_type <> 'OTHER']) AS asked FROM lines WHERE pass = 1) WHERE asked GROUP BY name")
def probe_passes(spark, d):
    """A prober is asked for the first pass and then for what is to be tried again, until nothing is left."""
    asked: list[tuple[str, int]] = []
    first, probe = _prober(spark, d, lambda name, queue: asked.append((name, queue.count())))
    dns_run.run_passes(spark, probe, first)
    return _rows(spark, asked, "name string, n long")


def _prober(spark: SparkSession, d: str, see) -> tuple[DataFrame, Callable[[str, DataFrame], DataFrame]]:
    """The first queue, and a prober that settles in the second pass what the events left open; ``see`` is told of every pass."""
    lines = _result_lines(spark, d).filter("pass = 1").select("line_no", "value")

    def probe(name: str, queue: DataFrame) -> DataFrame:
        see(name, queue)
        if name == "pass1":
            return lines
        final = F.concat(F.lit('{"name":"'), F.split("line", ",")[0], F.lit('","results":{"A":{"status":"NOERROR"}}}'))
        return queue.select("line_no", final.alias("value"))

    return lines.select("line_no", F.lit("").alias("line")), probe


@_query(
    f"""WITH {_LINES}, steps AS (SELECT true AS there, 'pass1' AS pass, 'running_pass1' AS state
    UNION ALL SELECT count(*) > 0, 'pass2', 'running_pass2' FROM lines WHERE pass = 1 AND upper(st) NOT IN ('NOERROR', 'NXDOMAIN') AND query_type <> 'OTHER'
    UNION ALL SELECT true, 'end', 'completed_no_failures') SELECT pass, state FROM steps WHERE there"""
)
def dns_run_states(spark, d):
    """The state that a run in the background leaves in its folder while each pass is probed, and at its end."""
    record = dns_run.RunRecord(spark, scratch(spark, "dns-state"))
    seen: list[tuple[str, str | None]] = []
    first, probe = _prober(spark, d, lambda name, queue: seen.append((name, record.state())))
    dns_run.launch(spark, probe, first, record.run_dir).result.result()
    return _rows(spark, [*seen, ("end", record.state())], "pass string, state string")


@_query("SELECT 'names.txt' AS name, sum(strlen(n_name) + 1)::BIGINT AS bytes, sha256(string_agg(n_name || chr(10), '' ORDER BY n_name)) AS sha256, 2::BIGINT AS requests FROM nation")
def fetch_inputs(spark, d):
    """A list that is fetched over a connection that breaks once, half way; its facts as the manifest of inputs states them."""
    data = "".join(r["n_name"] + "\n" for r in _t(spark, d, "nation").orderBy("n_name").collect()).encode()
    folder, asked = scratch(spark, "inputs"), []

    def opener(url: str, offset: int):
        asked.append(offset)
        return _Breaking(data[offset:], len(data) // 2) if offset == 0 else io.BytesIO(data[offset:])

    inputs.fetch(spark, [inputs.Input("names.txt", "list:names")], folder, opener, wait=0)
    facts = json.loads(sinks.read_text_file(spark, f"{folder}/inputs.json"))
    return _rows(spark, [(k, v["bytes"], v["sha256"], len(asked)) for k, v in facts.items()], "name string, bytes long, sha256 string, requests long")


class _Breaking(io.BytesIO):
    """Bytes whose reading fails after ``most``."""

    def __init__(self, data: bytes, most: int):
        super().__init__(data)
        self.most = most

    def read(self, size: int = -1) -> bytes:
        if self.tell() >= self.most:
            raise OSError("broken")
        return super().read(self.most - self.tell())


@_query("SELECT 'events' AS what, count(*) AS n FROM events UNION ALL SELECT 'documents', count(*) FROM documents")
def progress_counts(spark, d):
    """Rows counted by the write itself."""
    out = []
    for name in ("events", "documents"):
        rows, seen = progress.counted(_t(spark, d, name), name)
        rows.write.format("noop").mode("overwrite").save()
        out.append((name, progress.report(seen, name)))
    return _rows(spark, out, "what string, n long")


@_query("SELECT 25::BIGINT AS stamp_length, true AS in_utc")
def utc_stamps(spark, d):
    return spark.range(1).select(F.length(utc_now()).cast("long").alias("stamp_length"), F.endswith(utc_now(), F.lit("+00:00")).alias("in_utc"))


@_query(f"SELECT domain FROM (SELECT DISTINCT {_LAST3.format(h='h')} AS domain, page_id FROM (SELECT page_id, {_URL_HOST} AS h FROM pages)) GROUP BY domain")
def registry_export_plain_file(spark, d):
    path = f"{scratch(spark, 'export')}/domains.txt"
    _registry(spark, d).export(path, plain=True)
    return lists.text_lines(spark, path).select(F.col("line").alias("domain"))
