"""DNS lookups: reading result lines, consolidating passes, retry queues, reports.

A result line is an object of a name and a map of results by query type.  The
results stay VARIANT until a field is asked for, so that a field that is absent
and one that is JSON null can be told apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekeep.functions.scalars import FINAL_STATUSES, RETRY_TYPES, classify_error, clean_name, is_json, retry_trigger, to_milliseconds
from zonekeep.operators.sinks import _fs

LINE = "name string, results map<string,variant>"
# Packed bytes of result lines, some 17 times as many unpacked, that one task parses; above so many tasks each parses more, as a stream.
_TASK_BYTES, _MOST_TASKS = 1 << 17, 1000
# The columns of the two published tables, in order.
QUERY_COLUMNS = [
    "domain", "query_type", "status", "queried_at", "duration_ms", "resolver",
    "protocol", "source_pass", "attempt_sequence", "error_class", "authoritative", "authenticated",
    "recursion_available", "truncated", "record_count",
]
RECORD_COLUMNS = [
    "domain", "query_type", "section", "owner_name", "record_type", "ttl",
    "value", "preference", "priority", "weight", "port", "flags",
    "tag", "algorithm", "key_tag", "digest_type", "serial", "refresh",
    "retry", "expire", "minimum_ttl", "rdata_json", "source_pass",
]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no (order in the file) and value of a JSON lines file, compressed or not."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.make_valid_utf8("value").alias("value"))
    if not path.endswith(".gz"):
        return lines
    # one task reads a compressed file; the lines are dealt out before they are parsed, to tasks in proportion to the bytes:
    # left to choose, Spark puts what is small when packed into a few tasks (a union of passes reads partition k of each
    # pass in one task), and parsing is most of the work
    fs, target = _fs(spark, path)
    size = sum(s.getLen() for s in fs.globStatus(target) or [])
    return lines.repartition(min(-(-size // _TASK_BYTES) or 1, _MOST_TASKS), "line_no")


def parse_lines(lines: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """line_no, name, results, invalid (null for a null line) and ``keep`` of result lines; ``strict`` raises at a line that is no JSON."""
    valid = F.when(F.col("value").isNotNull(), is_json(F.col("value")))
    if strict:
        checked = F.when(valid, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("Invalid JSON at line "), (F.col("line_no") + 1).cast("string"))))
    else:
        checked = F.when(valid, F.col("value"))
    rows = lines.select("line_no", checked.alias("value"), (~valid).alias("invalid"), *keep)
    rows = rows.withColumn("r", F.from_json("value", LINE))
    return rows.select("line_no", F.col("r.name").alias("name"), F.col("r.results").alias("results"), "invalid", *keep)


def _get(v: str, path: str, kind: str) -> Column:
    return F.expr(f"try_variant_get({v}, '$.{path}', '{kind}')")


def _status(result: Column) -> Column:
    raw = F.try_variant_get(result, "$.status", "variant")
    return F.when(raw.isNull(), "MISSING").when(F.is_variant_null(raw), "NONE").otherwise(F.upper(F.try_variant_get(result, "$.status", "string")))


def status_of(result: str) -> Column:
    """Upper-case status; MISSING where there is none, NONE for JSON null."""
    return _status(F.col(result))


def passes_of(passes: list[tuple[str, DataFrame]]) -> DataFrame:
    """Parsed lines of passes given in order as (name, parsed lines), with source_pass and attempt_sequence."""
    if not passes:
        raise ValueError("no passes given")
    rows = [parsed.withColumn("source_pass", F.lit(name)).withColumn("attempt_sequence", F.lit(k)) for k, (name, parsed) in enumerate(passes, 1)]
    return reduce(DataFrame.unionByName, rows)


def lookups(parsed: DataFrame) -> DataFrame:
    """One row for each name and query type of each pass of parsed lines with source_pass and attempt_sequence."""
    return parsed.select(clean_name(F.col("name")).alias("domain"), "line_no", F.explode("results").alias("query_type", "result"), "source_pass", "attempt_sequence")


def reported(parsed: DataFrame) -> DataFrame:
    """``lookups`` with results as JSON, and what ``pass_report`` counts: status, record_count, and ``first`` once a line.

    A line without lookups has a row without query_type.
    """
    rows = parsed.select(clean_name(F.col("name")).alias("domain"), "line_no", F.posexplode_outer("results").alias("at", "query_type", "result"), "source_pass", "attempt_sequence")
    there = F.col("query_type").isNotNull()
    return rows.select(
        "domain", "line_no", "query_type", F.to_json("result").alias("result"), "source_pass", "attempt_sequence",
        F.when(there, status_of("result")).alias("status"), F.when(there, F.size(_records_of("result")).cast("long")).alias("record_count"),
        (F.coalesce("at", F.lit(0)) == 0).alias("first"),
    )


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: one aggregation with map-side combine, so one row a key and task is moved."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in rest])


def _in_section(section: str, rr: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), rr.alias("rr"))


def _records_of(result: str) -> Column:
    return _records(F.col(result))


def _records(result: Column) -> Column:
    """Resource records of the three sections, without the EDNS0 pseudo records."""
    parts = []
    for key, section in (("answers", "answer"), ("authorities", "authority"), ("additionals", "additional")):
        items = F.coalesce(F.try_variant_get(result, f"$.data.{key}", "array<variant>"), F.expr("cast(array() as array<variant>)"))
        parts.append(F.transform(items, partial(_in_section, section)))
    return F.filter(F.concat(*parts), lambda x: ~F.try_variant_get(x["rr"], "$.type", "string").eqNullSafe(F.lit("EDNS0")))


def winners(all_lookups: DataFrame) -> DataFrame:
    """The winning lookup of each (domain, query_type): the latest pass, within a pass the last line; results are JSON."""
    return latest(all_lookups, ["domain", "query_type"], ["attempt_sequence", "line_no"])


def opened(won: DataFrame) -> DataFrame:
    """Winning lookups with the result as VARIANT, and its records."""
    return won.withColumn("result", F.parse_json("result")).withColumn("records", _records_of("result"))


def consolidate(all_lookups: DataFrame) -> DataFrame:
    """The winning lookup of each (domain, query_type), with its result and records."""
    return opened(winners(all_lookups.withColumn("result", F.to_json("result"))))


def query_results(won: DataFrame) -> DataFrame:
    flag = lambda name: _get("result", f"data.flags.{name}", "boolean").cast("int").alias(name)
    rows = won.withColumn("status", status_of("result"))
    return rows.select(
        "domain", "query_type", "status",
        _get("result", "timestamp", "string").alias("queried_at"),
        to_milliseconds(_get("result", "duration", "double")).alias("duration_ms"),
        _get("result", "data.resolver", "string").alias("resolver"), _get("result", "data.protocol", "string").alias("protocol"),
        "source_pass", "attempt_sequence",
        classify_error(F.col("status"), _get("result", "error", "string")).alias("error_class"),
        flag("authoritative"), flag("authenticated"), flag("recursion_available"), flag("truncated"),
        F.size("records").alias("record_count"),
    )


def record_value(rr: str = "rr") -> Column:
    """The main value of a record: its answer where the key is there, else by type."""
    raw = _get(rr, "answer", "variant")
    text = lambda key: F.coalesce(_get(rr, key, "string"), F.lit(""))
    kind = _get(rr, "type", "string")
    return (
        F.when(raw.isNotNull(), F.when(F.is_variant_null(raw), "None").otherwise(_get(rr, "answer", "string")))
        .when(kind == "CAA", text("value"))
        .when(kind.isin("HTTPS", "SVCB"), text("target"))
        .when(kind == "DS", text("digest"))
        .when(kind == "DNSKEY", text("public_key"))
        .when(kind == "SOA", text("ns"))
    )


def rdata_json(rr: str = "rr") -> Column:
    """What else a record holds, as compact JSON in order of key."""
    fields = F.expr(f"map_filter(try_cast({rr} as map<string,variant>), (k, v) -> k not in ('name', 'type', 'class', 'ttl'))")
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(fields), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))), {"ignoreNullFields": "false"})


def dns_records(won: DataFrame) -> DataFrame:
    """The records of the winning lookups, with section and position for a total order."""
    rows = won.select("domain", "query_type", "source_pass", F.posexplode("records").alias("position", "r"))
    rows = rows.select("domain", "query_type", "source_pass", "position", F.col("r.section").alias("section"), F.col("r.rr").alias("rr"))
    number = lambda key, name=None: _get("rr", key, "bigint").alias(name or key)
    flags = F.when(_get("rr", "flags", "variant").isNotNull(), _get("rr", "flags", "string")).otherwise(_get("rr", "flag", "string"))
    return rows.select(
        "domain", "query_type", "section", _get("rr", "name", "string").alias("owner_name"),
        F.coalesce(_get("rr", "type", "string"), F.lit("UNKNOWN")).alias("record_type"), number("ttl"), record_value().alias("value"),
        number("preference"), number("priority"), number("weight"), number("port"), flags.alias("flags"), _get("rr", "tag", "string").alias("tag"),
        *[number(k) for k in ("algorithm", "key_tag", "digest_type", "serial", "refresh", "retry", "expire")], number("min_ttl", "minimum_ttl"),
        rdata_json().alias("rdata_json"), "source_pass", "position",
    )


def histogram(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Counts of a column's values, a null counting as ``none``."""
    return rows.groupBy(F.coalesce(F.col(column), F.lit("none")).alias(name)).agg(F.count("*").alias("n"))


def pass_report(rows: DataFrame) -> DataFrame:
    """Per pass of ``reported`` rows: lines, lookups, records and, by status, lookups; one aggregation."""
    each = rows.groupBy("source_pass", "status").agg(F.count_if("first").alias("domains"), F.count("query_type").alias("lookups"), F.sum("record_count").alias("records"))
    by_status = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("status").isNotNull(), F.struct("status", "lookups")))))
    return each.groupBy("source_pass").agg(F.sum("domains").alias("domains"), F.sum("lookups").alias("queries"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"), by_status.alias("statuses"))


def retry_queue(parsed: DataFrame, statuses: tuple[str, ...] | None = None) -> DataFrame:
    """line: ``name,,trigger,...`` for names with types to try again.

    Without ``statuses`` every status but the final ones counts.  The name stands as it came, the triggers in the order of the line.
    """
    entries = F.map_entries("results")
    wanted = (lambda s: ~s.isin(*FINAL_STATUSES)) if statuses is None else (lambda s: s.isin(*[x.strip().upper() for x in statuses]))
    chosen = F.filter(entries, lambda e: wanted(_status(e["value"])) & e["key"].isin(*RETRY_TYPES))
    rows = parsed.filter(~F.col("invalid")).select("line_no", "name", F.transform(chosen, lambda e: retry_trigger(e["key"])).alias("triggers"))
    return rows.filter(F.size("triggers") > 0).select("line_no", F.concat(F.col("name"), F.lit(",,"), F.array_join("triggers", ",")).alias("line"))


def retry_summary(parsed: DataFrame, statuses: tuple[str, ...] | None = None) -> dict:
    """Counters of a queue; bounded by the number of statuses and types."""
    total = parsed.agg(F.count("*").alias("rows"), F.count_if("invalid").alias("invalid")).first()
    each = parsed.filter(~F.col("invalid")).select(F.explode("results").alias("query_type", "result")).select("query_type", status_of("result").alias("status"))
    counts = each.groupBy("query_type", "status").count().collect()
    hit = lambda r: r["query_type"] in RETRY_TYPES and (r["status"] not in FINAL_STATUSES if statuses is None else r["status"] in [s.strip().upper() for s in statuses])
    by_status: dict[str, int] = {}
    by_type: dict[str, int] = {}
    for r in counts:
        by_status[r["status"]] = by_status.get(r["status"], 0) + r["count"]
        if hit(r):
            by_type[r["query_type"]] = by_type.get(r["query_type"], 0) + r["count"]
    return {
        "rows": total["rows"],
        "invalid_json_lines": total["invalid"],
        "domains_with_failed_types": retry_queue(parsed, statuses).count(),
        "failed_type_queries": sum(by_type.values()),
        "status_counts": dict(sorted(by_status.items())),
        "failed_type_counts": dict(sorted(by_type.items())),
    }


def completeness(results: DataFrame, types: list[str]) -> DataFrame:
    """Every domain with every type and whether the lookup is there: the types are a fixed list, so each domain is exploded, not joined."""
    have = results.groupBy("domain").agg(F.collect_set("query_type").alias("have"))
    return have.select("domain", F.explode(F.array(*[F.lit(t) for t in types])).alias("query_type"), "have").select("domain", "query_type", F.array_contains("have", F.col("query_type")).alias("present"))


def paced(lines: Iterator[str], per_second: float, clock, sleep) -> Iterator[str]:
    """Lines no faster than a rate: line i comes no earlier than i intervals after the start."""
    if per_second <= 0:
        raise ValueError("the rate must be above zero")
    start = clock()
    for i, line in enumerate(lines):
        wait = start + i / per_second - clock()
        if wait > 0:
            sleep(wait)
        yield line
