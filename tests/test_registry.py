import gzip
import hashlib
import io
import json
import time
import zipfile

import pytest

from zonekeep.cli import parser, run
from zonekeep.operators import progress
from zonekeep.plans.registry import Registry
from zonekeep.sources import inputs, lists

CATALOG = [
    {"source_id": s, "name": s, "category": "c", "url": "u", "access_method": "m", "coverage": "c", "license": None, "redistribution_status": status, "public_export": public, "import_status": "catalogued", "notes": None, "last_checked_at": "2026-01-01"}
    for s, status, public in (("open", "allowed", 1), ("closed", "restricted", 0))
]


@pytest.fixture
def registry(spark, tmp_path):
    (tmp_path / "sources.json").write_text(json.dumps(CATALOG))
    r = Registry(spark, str(tmp_path / "reg"))
    r.sync(str(tmp_path / "sources.json"))
    return r


def test_plain_counters_and_reimport(registry, tmp_path):
    (tmp_path / "a.txt").write_text("a.ro\nb.com\n\nhttps://c.ro/x\n_d.ro\n")
    got = registry.import_file("open", str(tmp_path / "a.txt"), "plain", observed_at="2026-01-01")
    assert got == {"source": "open", "rows_read": 5, "hostnames_accepted": 1, "domains_new": 1, "hostnames_new": 1, "rejected": 1}
    assert registry.import_file("open", str(tmp_path / "a.txt"), "plain", observed_at="2026-01-02")["status"] == "already_imported"
    assert registry.tables()["domain_sources"].collect()[0]["occurrences"] == 1


def test_vertices_gz(registry, tmp_path):
    with gzip.open(tmp_path / "v.txt.gz", "wt") as f:
        f.write("1\tro.a\t3\n2\tcom.b\t1\nbroken\n3\tro\t9\n4\tro.c.www\t1,200\n5\tro.d\n")
    got = registry.import_file("open", str(tmp_path / "v.txt.gz"), "domain-vertices", observed_at="2026-01-01")
    assert (got["rows_read"], got["hostnames_accepted"], got["rejected"]) == (6, 3, 2)
    meta = {r["domain"]: r["metadata_json"] for r in registry.tables()["domain_sources"].collect()}
    assert meta == {"a.ro": '{"host_count":3}', "c.ro": '{"host_count":1200}', "d.ro": '{"host_count":null}'}


def test_rank_csv_zip(registry, tmp_path):
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("top.csv", '1,a.ro\n\n2,b.com\nx\n"3",\n4,"a.ro"\n')
    got = registry.import_file("open", str(tmp_path / "r.zip"), "rank-domain-csv", observed_at="2026-01-01")
    assert (got["rows_read"], got["hostnames_accepted"], got["rejected"]) == (6, 2, 4)
    row = registry.tables()["domain_sources"].collect()[0]
    assert (row["occurrences"], row["best_rank"]) == (2, 1)


def test_two_files_in_a_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("a", "x")
        z.writestr("b", "y")
    with pytest.raises(Exception, match="one file and no other"):
        lists.text_lines(spark, str(tmp_path / "r.zip")).collect()


def test_header_csv(registry, tmp_path):
    (tmp_path / "h.csv").write_text('﻿GlobalRank,Domain\n"7,001",a.ro\n2,b.com\n')
    got = registry.import_file("open", str(tmp_path / "h.csv"), "csv", "Domain", "GlobalRank", "2026-01-01")
    assert (got["rows_read"], got["hostnames_accepted"], got["rejected"]) == (2, 1, 1)
    assert registry.tables()["domain_sources"].collect()[0]["best_rank"] == 7001
    (tmp_path / "h2.csv").write_text("x,y\n1,2\n")
    with pytest.raises(Exception, match="no column"):
        registry.import_file("open", str(tmp_path / "h2.csv"), "csv", "Domain", None, "2026-01-01")
    runs = registry.tables()["import_runs"].orderBy("run_id").collect()
    assert [r["status"] for r in runs] == ["completed", "failed"]


def test_fold_over_runs(registry, tmp_path):
    (tmp_path / "a.csv").write_text("5,a.ro\nx,www.a.ro\n")
    (tmp_path / "b.csv").write_text("3,a.ro\n")
    registry.import_file("open", str(tmp_path / "a.csv"), "rank-domain-csv", observed_at="2026-01-01")
    registry.import_file("open", str(tmp_path / "b.csv"), "rank-domain-csv", observed_at="2025-01-01")
    row = registry.tables()["domain_sources"].collect()[0]
    assert (row["first_seen_at"], row["last_seen_at"], row["occurrences"], row["best_rank"]) == ("2026-01-01", "2026-01-01", 3, 3)
    assert registry.tables()["hostnames"].count() == 2


def test_contacts_map_export_verify(registry, spark, tmp_path):
    folder = tmp_path / "repo/data/contacts"
    folder.mkdir(parents=True)
    (folder / "part-1.csv").write_text("cui,type,value,status\n1,website,https://a.ro,ok\n2,phone,b.ro,ok\n")
    got = registry.import_contacts("closed", str(tmp_path / "repo"), "2026-01-03")
    assert (got["rows_read"], got["hostnames_accepted"]) == (1, 1)
    objects = spark.createDataFrame([("node", 7, {"website": "http://b.ro; c.ro", "email": "x@d.ro", "name": "n.ro"})], "osm_type string, osm_id long, tags map<string,string>")
    registry.import_observations("open", "2026-01-04", "map", "digest", lambda: lists.map_objects(objects))
    out = registry.export(str(tmp_path / "all.csv.gz"))
    with gzip.open(tmp_path / "all.csv.gz", "rt") as f:
        lines = f.read().splitlines()
    assert lines[0] == "domain,unicode_domain,first_seen_at,last_seen_at,source_count,sources"
    assert [x.split(",")[0] for x in lines[1:]] == ["a.ro", "b.ro", "c.ro", "d.ro"] and out["bytes"] > 0
    registry.export(str(tmp_path / "public.txt"), public_only=True, plain=True)
    assert (tmp_path / "public.txt").read_text() == "b.ro\nc.ro\nd.ro\n"
    stats = registry.stats()
    assert (stats["domains"], stats["public_export_domains"], stats["sources_catalogued"], stats["sources_imported"]) == (4, 3, 2, 2)
    assert stats["by_source"][0] == {"source_id": "open", "domains": 3, "public_export": 1}
    assert registry.verify()["ok"]


def test_unknown_source(registry, tmp_path):
    (tmp_path / "a.txt").write_text("a.ro\n")
    with pytest.raises(ValueError, match="unknown source"):
        registry.import_file("nobody", str(tmp_path / "a.txt"), "plain", observed_at="2026-01-01")
    assert registry.tables()["import_runs"].count() == 0


def test_catalog_keeps_old_sources(registry, tmp_path):
    (tmp_path / "s2.json").write_text(json.dumps([CATALOG[0] | {"name": "new"}]))
    registry.sync(str(tmp_path / "s2.json"))
    assert {r["source_id"]: r["name"] for r in registry.tables()["sources"].collect()} == {"open": "new", "closed": "closed"}


def test_cli(spark, tmp_path):
    (tmp_path / "sources.json").write_text(json.dumps(CATALOG))
    (tmp_path / "a.txt").write_text("a.ro\n")
    root = str(tmp_path / "reg")
    call = lambda *a: run(parser().parse_args(["--root", root, *a]), spark)
    call("init", "--catalog", str(tmp_path / "sources.json"))
    assert call("import-file", "--source", "open", "--path", str(tmp_path / "a.txt"), "--format", "plain")["hostnames_accepted"] == 1
    assert call("stats")["domains"] == 1
    assert call("verify")["ok"]


def test_stream(registry, tmp_path):
    from zonekeep.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("a.ro\nb.ro\n")
    for extra in ("", "c.ro\n"):
        if extra:
            (tmp_path / "in/b.txt").write_text(extra)
        ingest(registry, str(tmp_path / "in"), "open", "2026-01-01", str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(r["domain"] for r in registry.tables()["domains"].collect()) == ["a.ro", "b.ro", "c.ro"]


def test_inputs(spark, tmp_path):
    data = bytes(range(256)) * 20_000
    (tmp_path / "source.bin").write_bytes(data)
    want = inputs.Input("a.bin", (tmp_path / "source.bin").as_uri(), hashlib.sha256(data).hexdigest())
    folder, offsets = str(tmp_path / "raw"), []

    class Broken(io.BytesIO):
        def read(self, n=-1):
            chunk = super().read(n)
            if offsets[-1] < 2 << 20 and self.tell() > 1 << 20:
                raise OSError("the connection broke")
            return chunk

    def flaky(url, offset):
        offsets.append(offset)
        return Broken(data[offset:])

    assert inputs.missing(spark, [want], folder) == {"a.bin": "absent"}
    facts = inputs.fetch(spark, [want], folder, flaky, wait=0)
    assert offsets == [0, 1 << 20, 2 << 20] and facts["a.bin"]["bytes"] == len(data)
    assert (tmp_path / "raw/a.bin").read_bytes() == data and inputs.missing(spark, [want], folder) == {}
    assert inputs.fetch(spark, [want], folder, lambda url, offset: 1 / 0) == facts  # nothing to fetch
    (tmp_path / "raw/a.bin").write_bytes(b"else")
    (tmp_path / "raw/.a.bin.crc").unlink(missing_ok=True)
    assert inputs.missing(spark, [want], folder) == {"a.bin": "changed"}
    assert inputs.fetch(spark, [want], folder)["a.bin"]["sha256"] == want.sha256  # through file://
    with pytest.raises(ValueError, match="expected"):
        inputs.fetch(spark, [want._replace(name="b.bin", sha256="0" * 64)], folder)
    with pytest.raises(OSError):
        inputs.fetch(spark, [inputs.Input("c.bin", (tmp_path / "none").as_uri())], folder, wait=0)
    assert not (tmp_path / "raw/b.bin").exists() and not (tmp_path / "raw/c.bin").exists()


def test_progress(spark, tmp_path):
    rows, seen = progress.counted(spark.range(1000), "r")
    rows.write.parquet(str(tmp_path / "rows"))
    assert progress.report(seen, "rows") == 1000
    listener = progress.StreamProgress()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "rows")).writeStream.format("noop").trigger(availableNow=True).start()
        stream.awaitTermination(120)
        for _ in range(100):
            if listener.rows.get(str(stream.runId)):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.rows[str(stream.runId)] == 1000
