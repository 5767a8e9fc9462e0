import csv
import gzip
import hashlib
import json
import threading
import time
import zlib

import pytest
from pyspark.sql import functions as F

from zonekeep.functions import scalars
from zonekeep.operators import dns, sinks
from zonekeep.plans import dns_run


def lines(spark, records):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)], "line_no long, value string")


def result(status="NOERROR", answers=(), **more):
    return {"status": status, "timestamp": "t", "duration": 0.0123456, "data": {"resolver": "r", "protocol": "udp", "flags": {"authoritative": True}, "answers": list(answers)}} | more


@pytest.mark.parametrize(
    ("status", "error", "want"),
    [
        ("NOERROR", "timeout", None), ("NXDOMAIN", None, None), ("ERROR", "Rate limit exceeded", "local_rate_limit"), ("ERROR", "rate limiter: deadline", "local_rate_limiter_deadline"),
        ("TIMEOUT", None, "timeout"), ("ERROR", "i/o timeout", "timeout"), ("SERVFAIL", "", "servfail"), ("SERVFAIL", "timeout", "timeout"), ("REFUSED", None, "refused"), ("MISSING", None, "other"),
    ],
)
def test_classify(spark, status, error, want):
    row = spark.createDataFrame([(status, error)], "s string, e string").select(scalars.classify_error(F.col("s"), F.col("e")).alias("c")).first()
    assert row["c"] == want


def test_parse_count(spark):
    values = ["1,234", " 12 ", "12.5", "", None, "1_000", "-3", "x"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(scalars.parse_count(F.col("v"))).collect()]
    assert got == [1234, 12, None, None, None, 1000, -3, None]


def test_latest_pass_wins_with_its_records(spark):
    a = {"name": "a.ro", "type": "A", "class": "IN", "ttl": 60, "answer": "1.1.1.1"}
    first = lines(spark, [{"name": "X.RO.", "results": {"A": result("TIMEOUT", error="t"), "MX": result(answers=[{"type": "MX", "answer": "m", "preference": 5}])}}])
    second = lines(spark, [{"name": "x.ro", "results": {"A": result(answers=[a, a | {"answer": "2.2.2.2"}, {"type": "EDNS0"}, {"answer": None}])}}])
    passes = [(f"pass{i}", dns.parse_lines(p)) for i, p in enumerate((first, second), 1)]
    won = dns.consolidate(dns.lookups(dns.passes_of(passes)))
    got = {r["query_type"]: r for r in dns.query_results(won).collect()}
    assert (got["A"]["status"], got["A"]["attempt_sequence"], got["A"]["record_count"], got["A"]["error_class"]) == ("NOERROR", 2, 3, None)
    assert (got["MX"]["source_pass"], got["MX"]["duration_ms"], got["MX"]["authoritative"], got["MX"]["truncated"]) == ("pass1", 12.346, 1, None)
    records = dns.dns_records(won).orderBy("query_type", "position").collect()
    assert [(r["query_type"], r["record_type"], r["value"]) for r in records] == [("A", "A", "1.1.1.1"), ("A", "A", "2.2.2.2"), ("A", "UNKNOWN", "None"), ("MX", "MX", "m")]
    assert records[0]["ttl"] == 60 and records[0]["rdata_json"] == '{"answer":"1.1.1.1"}' and records[3]["preference"] == 5
    assert sum(r["record_count"] for r in got.values()) == len(records)


def test_record_values(spark):
    rr = [{"type": "CAA", "value": "v", "flag": 0, "tag": "issue"}, {"type": "SVCB", "target": "t"}, {"type": "DS", "digest": "d", "key_tag": 9}, {"type": "DNSKEY"}, {"type": "SOA", "ns": "n", "min_ttl": 4}, {"type": "TXT"}]
    parsed = dns.parse_lines(lines(spark, [{"name": "a.ro", "results": {"A": result(answers=rr)}}]))
    got = dns.dns_records(dns.consolidate(dns.lookups(dns.passes_of([("p", parsed)])))).orderBy("position").collect()
    assert [r["value"] for r in got] == ["v", "t", "d", "", "n", None]
    assert (got[0]["flags"], got[0]["tag"], got[2]["key_tag"], got[4]["minimum_ttl"]) == ("0", "issue", 9, 4)
    assert got[0]["rdata_json"] == '{"flag":0,"tag":"issue","value":"v"}'


def test_status_missing_and_null(spark):
    parsed = dns.parse_lines(lines(spark, [{"name": "a.ro", "results": {"A": {}, "MX": {"status": None}, "NS": {"status": "servfail"}, "ANY": {"status": "ERROR"}}}]))
    got = {r["query_type"]: r["status"] for r in dns.query_results(dns.consolidate(dns.lookups(dns.passes_of([("p", parsed)])))).collect()}
    assert got == {"A": "MISSING", "MX": "NONE", "NS": "SERVFAIL", "ANY": "ERROR"}
    assert [r["line"] for r in dns.retry_queue(parsed).collect()] == ["a.ro,,retry-a,retry-mx,retry-ns"]
    assert [r["line"] for r in dns.retry_queue(parsed, ("error", " ServFail ")).collect()] == ["a.ro,,retry-ns"]


def test_bad_lines(spark):
    rows = lines(spark, [{"name": "Foo.RO.", "results": {"A": {"status": "ERROR"}}}, "{broken", {"name": "b", "results": {}}])
    summary = dns.retry_summary(dns.parse_lines(rows, strict=False))
    assert summary == {"rows": 3, "invalid_json_lines": 1, "domains_with_failed_types": 1, "failed_type_queries": 1, "status_counts": {"ERROR": 1}, "failed_type_counts": {"A": 1}}
    assert dns.retry_queue(dns.parse_lines(rows, strict=False)).first()["line"] == "Foo.RO.,,retry-a"
    with pytest.raises(Exception, match="Invalid JSON at line 2"):
        dns.parse_lines(rows).collect()


def test_lines_are_json_as_a_whole(spark):
    good = ["1", ' "a" ', "null", "[1, 2]", '{"name":"a","results":{}}', "-1.5e3\t"]
    bad = [
        "4702 words", '"a" x', "1, 2", "1], [2", '"a"], ["b"', '"a"}, {"b"', '"a"] x', '"a"} x', '1,"b":2', '"a":1', '"a", "b"', "[1]]", "{}}", '{"name":"a","results":{}} {"name":"b"}', '{"name":"a","results":{}},', "", " ", "'a'", "nul",
    ]
    got = dns.parse_lines(lines(spark, good + bad), strict=False).orderBy("line_no").collect()
    assert [r["invalid"] for r in got] == [False] * len(good) + [True] * len(bad)
    with pytest.raises(Exception, match="Invalid JSON at line 1"):
        dns.parse_lines(lines(spark, ['{"name":"a","results":{}} {"name":"b"}'])).collect()


def test_invalid_count_of_odd_texts(spark, tmp_path):
    import duckdb

    from zonekeep.plans.queries import ORACLES, QUERIES

    tables = {"documents": ("text", ["8294846167456848 Inly", '"a"], ["b"', None, "", "12"]), "events": ("props", ['{"k": 1}', '{"k": 1} {"k": 2}', None])}
    for name, (column, values) in tables.items():
        spark.createDataFrame([(v,) for v in values], f"{column} string").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    with duckdb.connect() as c:
        for name in tables:
            c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        want = c.execute(ORACLES["json_invalid_count"]).fetchall()
    assert [tuple(r) for r in QUERIES["json_invalid_count"](spark, str(tmp_path)).collect()] == want == [(8, 4)]


def test_run_and_publish(spark, tmp_path):
    run = tmp_path / "run1"
    for i, folder in enumerate(("pass1", "pass2"), 1):
        (run / folder).mkdir(parents=True)
        with gzip.open(run / folder / "results.jsonl.gz", "wt") as f:
            f.write(json.dumps({"name": "a.ro", "results": {"A": result("NOERROR" if i == 2 else "SERVFAIL", [{"type": "A", "answer": "1"}])}}) + "\n")
            if i == 1:
                f.write(json.dumps({"name": "b.ro", "results": {"A": result("NXDOMAIN")}}) + "\n")
    (run / "config.txt").write_text("domains=2\ntype_count=1\nbase_logical_queries=2\nzdns_version=v=1\n")
    (run / "started_at.txt").write_text("s\n")
    summary = dns_run.consolidate_run(spark, str(run), str(tmp_path / "out"), export_dir=str(tmp_path / "exports"))
    assert (summary["query_results"], summary["dns_records"], summary["statuses"]) == (2, 1, {"NOERROR": 1, "NXDOMAIN": 1})
    snapshot = spark.read.parquet(str(tmp_path / "out/snapshots")).first()
    assert (snapshot["snapshot_id"], snapshot["pass_count"], snapshot["tool"]) == ("run1", 2, "ZDNS v=1")
    with gzip.open(tmp_path / "exports/dns_query_results.csv.gz", "rt") as f:
        assert f.readline().strip().split(",") == dns.QUERY_COLUMNS
    d = "first_seen_at string, last_seen_at string"
    tables = {
        "domains": spark.createDataFrame([("a.ro", "a.ro", "1", "1"), ("b.ro", "b.ro", "1", "1")], f"domain string, unicode_domain string, {d}"),
        "domain_sources": spark.createDataFrame([("a.ro", "s"), ("b.ro", "t")], "domain string, source_id string"),
        "sources": spark.createDataFrame([("s", 1), ("t", 0)], "source_id string, public_export int"),
    }
    facts = dns_run.publish(spark, tables, str(tmp_path / "out"), str(tmp_path / "public"))
    assert facts["public_domains"] == 1 and facts["dns_query_results_public.csv.gz"]["rows"] == 1
    assert json.loads((tmp_path / "public/manifest.json").read_text()) == facts


def gz(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)


def test_export_is_packed_by_all_tasks(spark, tmp_path):
    """One sorted file with one header, strung together from the parts of several tasks."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 2000, 1, 8).select(F.col("id").alias("k"), F.concat(F.lit('a "b", '), F.col("id") % 7).alias("v"))
        written = [sinks.export_csv(rows, f"{tmp_path}/t.csv.gz", ["k"]), sinks.export_csv(rows, f"{tmp_path}/t.csv", ["k"]), sinks.export_lines(rows.select("k", F.col("v").alias("line")), f"{tmp_path}/t.txt.gz", ["k"])]
        empty = sinks.export_csv(rows.filter("k < 0"), f"{tmp_path}/none.csv.gz", ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = [["k", "v"], *[[str(i), f'a "b", {i % 7}'] for i in range(2000)]]
    with gzip.open(tmp_path / "t.csv.gz", "rt") as f:
        assert list(csv.reader(f)) == want
    with open(tmp_path / "t.csv") as f:
        assert list(csv.reader(f)) == want
    with gzip.open(tmp_path / "t.txt.gz", "rt") as f:
        assert f.read().splitlines() == [r[1] for r in want[1:]]
    with gzip.open(tmp_path / "none.csv.gz", "rt") as f:
        assert f.read() == "k,v\n"
    assert (written, empty) == ([2000] * 3, 0)
    assert [r["k"] for r in spark.read.csv(f"{tmp_path}/t.csv.gz", header=True, escape='"').collect()] == [r[0] for r in want[1:]]
    packed, members = (tmp_path / "t.csv.gz").read_bytes(), 0
    while packed:
        one = zlib.decompressobj(31)
        one.decompress(packed)
        packed, members = one.unused_data, members + 1
    assert members > 4 and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["none.csv.gz", "t.csv", "t.csv.gz", "t.txt.gz"]


def test_packed_lines_are_parsed_by_many_tasks(spark, tmp_path):
    gz(tmp_path / "r.jsonl.gz", ({"name": f"{i}.ro", "results": {"A": {"id": hashlib.sha256(str(i).encode()).hexdigest()}}} for i in range(10000)))
    size = (tmp_path / "r.jsonl.gz").stat().st_size
    rows = dns.read_lines(spark, f"{tmp_path}/r.jsonl.gz")
    assert rows.rdd.getNumPartitions() == -(-size // (1 << 17)) > 2
    assert [json.loads(r["value"])["name"][:-3] for r in rows.orderBy("line_no").collect()] == [str(i) for i in range(10000)]


def test_passes_are_read_once(spark, tmp_path, monkeypatch):
    """The files of a run are gone when their lookups are staged; a line without lookups counts as a line."""
    rr = [{"type": "A", "answer": "1"}, {"type": "EDNS0"}]
    gz(tmp_path / "run/pass1/results.jsonl.gz", [{"name": "a.ro", "results": {"A": result("SERVFAIL", rr), "MX": result()}}, {"name": "b.ro", "results": {}}, {"name": "c.ro"}])
    gz(tmp_path / "run/pass2/results.jsonl.gz", [{"name": "a.ro", "results": {"A": result(answers=rr)}}])
    (tmp_path / "run/config.txt").write_text("domains=3\ntype_count=2\nbase_logical_queries=6\n")
    real = dns_run.stage

    def once(df, label):
        out = real(df, label)
        for p in (tmp_path / "run").glob("*/results.jsonl.gz"):
            p.unlink()
        return out

    monkeypatch.setattr(dns_run, "stage", once)
    summary = dns_run.consolidate_run(spark, str(tmp_path / "run"), str(tmp_path / "out"))
    assert sorted(summary["passes"], key=lambda p: p["source_pass"]) == [
        {"source_pass": "pass1", "domains": 3, "queries": 2, "records": 1, "statuses": {"NOERROR": 1, "SERVFAIL": 1}},
        {"source_pass": "pass2", "domains": 1, "queries": 1, "records": 1, "statuses": {"NOERROR": 1}},
    ]
    assert (summary["query_results"], summary["dns_records"]) == (2, 1)


def test_retry_passes(spark):
    asked = []

    def probe(name, queue):
        asked.append((name, sorted(r["line"] for r in queue.collect())))
        status = {"pass1": "SERVFAIL", "pass2": "ERROR", "pass3": "ERROR", "pass4_local_errors": "NOERROR"}[name]
        return lines(spark, [{"name": "a.ro", "results": {"A": {"status": status}}}])

    done = dns_run.run_passes(spark, probe, spark.createDataFrame([(0, "a.ro")], "line_no long, line string"))
    assert [n for n, _ in done] == ["pass1", "pass2", "pass3", "pass4_local_errors"]
    assert asked[1] == ("pass2", ["a.ro,,retry-a"])


def test_run_record(spark, tmp_path):
    first = spark.createDataFrame([(0, "a.ro")], "line_no long, line string")
    record = dns_run.RunRecord(spark, str(tmp_path))
    seen = []

    def probe(name, queue):
        seen.append(record.state())
        if name == "pass2" and len(seen) == 2:
            raise ValueError("the prober died")
        status = "SERVFAIL" if name == "pass1" else "NOERROR"
        return lines(spark, [{"name": "a.ro", "results": {"A": {"status": status}}}])

    assert record.state() is None
    with pytest.raises(ValueError, match="died"):
        dns_run.run_passes(spark, probe, first, str(tmp_path))
    assert record.state() == "failed_pass2" and not (tmp_path / "finished_at.txt").exists()
    done = dns_run.run_passes(spark, probe, first, str(tmp_path))
    assert [n for n, _ in done] == ["pass1", "pass2"] and record.state() == "completed_no_failures"
    assert seen == ["running_pass1", "running_pass2"] * 2
    assert (tmp_path / "started_at.txt").read_text() <= (tmp_path / "finished_at.txt").read_text()


def test_launch_and_interrupt(spark, tmp_path):
    first = spark.createDataFrame([(0, "a.ro")], "line_no long, line string")
    run = dns_run.launch(spark, lambda name, queue: lines(spark, [{"name": "a.ro", "results": {"A": {"status": "NOERROR"}}}]), first, str(tmp_path / "one"))
    assert [n for n, _ in run.result.result(120)] == ["pass1"]
    assert dns_run.RunRecord(spark, str(tmp_path / "one")).state() == "completed_no_failures"

    begun = threading.Event()

    def slow(name, queue):
        begun.set()

        def wait(batches):
            for batch in batches:
                time.sleep(60)
                yield batch

        return spark.range(1, numPartitions=1).select(F.col("id").alias("line_no"), F.lit("{}").alias("value")).mapInPandas(wait, "line_no long, value string")

    run = dns_run.launch(spark, slow, first, str(tmp_path / "two"))
    assert begun.wait(60)
    time.sleep(2)
    run.interrupt()
    with pytest.raises(Exception, match="(?i)cancel"):
        run.result.result(120)
    assert dns_run.RunRecord(spark, str(tmp_path / "two")).state() == "interrupted"


def test_completeness_and_pacing(spark):
    rows = spark.createDataFrame([("a", "A"), ("b", "MX")], "domain string, query_type string")
    got = {(r["domain"], r["query_type"]): r["present"] for r in dns.completeness(rows, ["A", "MX"]).collect()}
    assert got == {("a", "A"): True, ("a", "MX"): False, ("b", "A"): False, ("b", "MX"): True}
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    assert list(dns.paced(iter("abc"), 2, lambda: now[0], sleep)) == ["a", "b", "c"] and waits == [0.5, 0.5]
    with pytest.raises(ValueError, match="above zero"):
        list(dns.paced(iter("a"), 0, None, None))
