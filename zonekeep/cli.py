"""Command line: python -m zonekeep.cli --root DIR COMMAND."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession

from zonekeep.operators import dns, sinks
from zonekeep.plans import dns_run
from zonekeep.plans.registry import Registry
from zonekeep.sources import inputs


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="zonekeep")
    p.add_argument("--root", help="folder of the registry")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("init").add_argument("--catalog", required=True)
    one = sub.add_parser("import-file")
    one.add_argument("--source", required=True)
    one.add_argument("--path", required=True)
    one.add_argument("--format", required=True, choices=["plain", "csv", "rank-domain-csv", "domain-vertices"])
    for name in ("--column", "--rank-column", "--observed-at"):
        one.add_argument(name)
    for name in ("import-contacts", "import-map"):
        one = sub.add_parser(name)
        one.add_argument("--source", required=True)
        one.add_argument("--path", required=True)
        one.add_argument("--observed-at")
    one = sub.add_parser("fetch")
    one.add_argument("--inputs", required=True, help="JSON list of {name, url, sha256}")
    one.add_argument("--output", required=True)
    one = sub.add_parser("export")
    one.add_argument("--output", required=True)
    one.add_argument("--public-only", action="store_true")
    one.add_argument("--plain", action="store_true")
    sub.add_parser("stats")
    sub.add_parser("verify")
    one = sub.add_parser("consolidate")
    one.add_argument("--run-dir", required=True)
    one.add_argument("--output", required=True)
    one.add_argument("--export-dir")
    one = sub.add_parser("retry-queue")
    one.add_argument("--input", required=True)
    one.add_argument("--output", required=True)
    one.add_argument("--summary", required=True)
    one.add_argument("--statuses", help="comma-separated; every status that is not final, if not given")
    one = sub.add_parser("publish")
    one.add_argument("--dns", required=True)
    one.add_argument("--output", required=True)
    sub.add_parser("pace").add_argument("--lines-per-second", type=float, required=True)
    return p


def run(args: argparse.Namespace, spark: SparkSession | None = None) -> dict | None:
    if args.command == "pace":
        for line in dns.paced(iter(sys.stdin), args.lines_per_second, time.monotonic, time.sleep):
            sys.stdout.write(line)
            sys.stdout.flush()
        return None
    spark = spark or SparkSession.builder.appName("zonekeep").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    registry = Registry(spark, args.root) if args.root else None
    if args.command == "consolidate":
        return dns_run.consolidate_run(spark, args.run_dir, args.output, export_dir=args.export_dir)
    if args.command == "retry-queue":
        parsed = dns.parse_lines(dns.read_lines(spark, args.input), strict=False)
        statuses = tuple(args.statuses.split(",")) if args.statuses else None
        sinks.export_lines(dns.retry_queue(parsed, statuses), args.output, ["line_no"])
        summary = {"input": args.input, **dns.retry_summary(parsed, statuses)}
        sinks.write_manifest(spark, args.summary, summary)
        return summary
    if args.command == "fetch":
        wanted = json.loads(sinks.read_text_file(spark, args.inputs) or "[]")
        return inputs.fetch(spark, [inputs.Input(**w) for w in wanted], args.output)
    if registry is None:
        raise SystemExit("--root is needed")
    if args.command == "init":
        registry.sync(args.catalog)
        return {"root": args.root}
    if args.command == "import-file":
        return registry.import_file(args.source, args.path, args.format, args.column, args.rank_column, args.observed_at)
    if args.command == "import-contacts":
        return registry.import_contacts(args.source, args.path, args.observed_at)
    if args.command == "import-map":
        return registry.import_map(args.source, args.path, args.observed_at)
    if args.command == "export":
        return registry.export(args.output, args.public_only, args.plain)
    if args.command == "stats":
        return registry.stats()
    if args.command == "publish":
        return dns_run.publish(spark, registry.tables(), args.dns, args.output)
    return registry.verify()


def main(argv: list[str] | None = None) -> int:
    out = run(parser().parse_args(argv))
    if out is not None:
        print(json.dumps(out, indent=2, sort_keys=True, ensure_ascii=False))
    return 0 if out is None or out.get("ok", True) else 1


if __name__ == "__main__":
    sys.exit(main())
