"""The stored registry: immutable versions, one pointer, one writer.

A version is a set of folders of parquet tables.  An import writes new folders for
the tables that it changes and then moves the pointer, which names the folder of
every table, so a failed import publishes nothing but its line in the log of
runs, and readers never see half a version.  Folders that neither the new nor
the previous version names are deleted.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekeep.functions.hostname import RO_RULES, HostRules
from zonekeep.functions.scalars import utc_now
from zonekeep.operators import quality, registry, sinks
from zonekeep.sources import lists
from zonekeep.sources.catalog import CATALOG, read_catalog, sync_catalog
from zonekeep.store import stage

_DATES = "first_seen_at string, last_seen_at string"
SCHEMAS = {
    "sources": CATALOG,
    "domains": f"domain string, unicode_domain string, {_DATES}",
    "hostnames": f"hostname string, registrable_domain string, unicode_hostname string, {_DATES}",
    "domain_sources": f"domain string, source_id string, {_DATES}, occurrences bigint, best_rank bigint, metadata_json string",
    "hostname_sources": f"hostname string, source_id string, {_DATES}, occurrences bigint, best_rank bigint",
    "import_runs": "run_id bigint, source_id string, input_uri string, input_sha256 string, started_at string, finished_at string, rows_read bigint, hostnames_accepted bigint, domains_new bigint, hostnames_new bigint, rejected bigint, status string, error string",
}
KEYS = {"sources": ["source_id"], "domains": ["domain"], "hostnames": ["hostname"], "domain_sources": ["domain", "source_id"], "hostname_sources": ["hostname", "source_id"], "import_runs": ["run_id"]}


@dataclass
class Registry:
    spark: SparkSession
    root: str
    rules: HostRules = RO_RULES

    def _current(self) -> dict:
        """The number of the current version and the folders of its tables, and those of the one before."""
        return json.loads(sinks.read_text_file(self.spark, f"{self.root}/CURRENT") or '{"version": 0, "tables": {}, "before": {}}')

    def tables(self) -> dict[str, DataFrame]:
        """The current version."""
        folders = self._current()["tables"]
        read = lambda n, s: self.spark.read.schema(s).parquet(f"{self.root}/{folders[n]}") if n in folders else self.spark.createDataFrame([], s)
        return {n: read(n, s) for n, s in SCHEMAS.items()}

    def _publish(self, changed: dict[str, DataFrame]) -> None:
        now = self._current()
        v, folders = now["version"] + 1, dict(now["tables"])
        for name, rows in changed.items():
            columns = [f.split()[0] for f in SCHEMAS[name].split(", ")]
            folders[name] = f"v{v:06d}/{name}"
            rows.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{folders[name]}")
        sinks.write_text_file(self.spark, f"{self.root}/CURRENT", json.dumps({"version": v, "tables": folders, "before": now["tables"]}))
        for folder in set(now["before"].values()) - set(folders.values()) - set(now["tables"].values()):
            fs, target = sinks._fs(self.spark, f"{self.root}/{folder}")
            fs.delete(target, True)

    def sync(self, catalog_path: str) -> None:
        """Create the registry or bring its source catalog up to date."""
        now = self.tables()
        self._publish({"sources": stage(sync_catalog(now["sources"], read_catalog(self.spark, catalog_path)), "registry-sources")})

    def imported(self, source_id: str, digest: str) -> bool:
        runs = self.tables()["import_runs"]
        return not runs.filter((F.col("source_id") == source_id) & (F.col("input_sha256") == digest) & (F.col("status") == "completed")).limit(1).isEmpty()

    def import_observations(self, source_id: str, observed_at: str, uri: str, digest: str, observations) -> dict:
        """Fold the rows that ``observations()`` gives into a new version; a digest that was imported already is a no-op."""
        now = self.tables()
        if now["sources"].filter(F.col("source_id") == source_id).isEmpty():
            raise ValueError(f"unknown source {source_id!r}")
        if self.imported(source_id, digest):
            return {"source": source_id, "status": "already_imported", "sha256": digest}
        started = self.spark.range(1).select(utc_now()).first()[0]
        run_id = (now["import_runs"].agg(F.max("run_id")).first()[0] or 0) + 1

        def logged(status: str, counters: dict, error: str | None) -> DataFrame:
            finished = self.spark.range(1).select(utc_now()).first()[0]
            names = ("rows_read", "hostnames_accepted", "domains_new", "hostnames_new", "rejected")
            row = (run_id, source_id, uri, digest, started, finished, *[counters.get(k, 0) for k in names], status, error)
            return now["import_runs"].unionByName(self.spark.createDataFrame([row], SCHEMAS["import_runs"]))

        try:
            normal = stage(registry.normalise(observations(), self.rules), "registry-batch")
            counters = registry.run_counters(normal, now["domains"], now["hostnames"]).first().asDict()
            merged = registry.merge_batch(now, normal, source_id, observed_at)
            self._publish(merged | {"import_runs": logged("completed", counters, None)})
        except Exception as e:
            self._publish({"import_runs": logged("failed", {}, str(e)[:2000])})
            raise
        return {"source": source_id, **counters}

    def _file_date(self, path: str) -> str:
        """The day of a file's last change."""
        fs, target = sinks._fs(self.spark, path)
        return datetime.fromtimestamp(fs.getFileStatus(target).getModificationTime() / 1000, UTC).date().isoformat()

    def import_file(self, source_id: str, path: str, kind: str, column: str | None = None, rank_column: str | None = None, observed_at: str | None = None) -> dict:
        """kind: plain, csv, rank-domain-csv or domain-vertices."""
        observed_at = observed_at or self._file_date(path)
        tld = self.rules.tlds
        scans = {
            "plain": lambda lines: lists.plain_list(lines, tld),
            "csv": lambda lines: lists.header_csv(lines, column, rank_column),
            "rank-domain-csv": lists.rank_csv,
            "domain-vertices": lambda lines: lists.graph_vertices(lines, tld[0]),
        }
        if kind not in scans:
            raise ValueError(f"unknown format {kind!r}; one of {sorted(scans)}")
        if kind == "csv" and not column:
            raise ValueError("the csv format needs a column")
        return self.import_observations(source_id, observed_at, path, sinks.content_digest(self.spark, [path]), lambda: scans[kind](lists.text_lines(self.spark, path)))

    def import_contacts(self, source_id: str, directory: str, observed_at: str | None = None) -> dict:
        observed_at = observed_at or datetime.now(UTC).date().isoformat()
        fs, folder = sinks._fs(self.spark, f"{directory}/data/contacts")
        found = [str(s.getPath()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
        paths = sorted(p for p in found if p.rsplit("/", 1)[-1].startswith("part-") and p.endswith(".csv"))
        empty = lambda: self.spark.createDataFrame([], lists.OBSERVATION)
        return self.import_observations(source_id, observed_at, directory, sinks.content_digest(self.spark, paths), (lambda: lists.contacts(self.spark, directory)) if paths else empty)

    def import_map(self, source_id: str, path: str, observed_at: str | None = None) -> dict:
        observed_at = observed_at or self._file_date(path)
        from zonekeep.sources.osm import register

        register(self.spark)
        objects = lambda: lists.map_objects(self.spark.read.format("map_extract").load(path))
        return self.import_observations(source_id, observed_at, path, sinks.content_digest(self.spark, [path]), objects)

    def export(self, path: str, public_only: bool = False, plain: bool = False) -> dict:
        t = self.tables()
        if plain:
            rows = registry.plain_domains(t["domains"], t["domain_sources"], t["sources"], public_only)
            sinks.export_lines(rows.withColumnRenamed("domain", "line"), path, ["line"])
        else:
            sinks.export_csv(registry.provenance(t["domains"], t["domain_sources"], t["sources"], public_only), path, ["domain"])
        return {"output": path, **sinks.file_facts(self.spark, path)}

    def stats(self) -> dict:
        t = self.tables()
        totals = registry.stats_totals(t, t["sources"], t["import_runs"]).first().asDict()
        return totals | {"by_source": [r.asDict() for r in registry.stats_by_source(t["domain_sources"], t["sources"]).collect()]}  # a row a source

    @staticmethod
    def _readable(table: DataFrame) -> bool:
        """Whether every row and column of a table can be read from its files."""
        try:
            table.agg(F.sum(F.hash(*table.columns).cast("long"))).first()
        except Exception:
            return False
        return True

    def verify(self) -> dict:
        """Counts of violations by check, all zero where ``ok``."""
        t = self.tables()
        out = quality.verify(t, self.rules.tlds).first().asDict()
        for name, keys in KEYS.items():
            out[f"duplicate_{name}"] = quality.duplicate_keys(t[name], keys).count()
        out["unreadable_tables"] = sum(not self._readable(t[name]) for name in SCHEMAS)
        out["unknown_redistribution_status"] = quality.enum_violations(t["sources"], "redistribution_status").count()
        out["ok"] = all(v == 0 for k, v in out.items() if k != "ok")
        return out
