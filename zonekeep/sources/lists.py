"""Scans of name lists.

Each scan gives raw observations: seq (order of arrival), raw, rank, metadata,
and offered (false: the row is counted as read but not tried) with short (the
row is counted as read and rejected).  Lines keep their file order through
(file, block, line), so that folds can tell first from last.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from io import BytesIO, TextIOWrapper

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekeep.functions.scalars import ends_with_tld, metadata_json, parse_count, reverse_labels

OBSERVATION = "seq string, raw string, rank bigint, metadata string, offered boolean, short boolean"
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """seq, line of a plain, .gz or .zip text; bad bytes become U+FFFD and a byte order mark is dropped.

    A zip archive must hold exactly one file.
    """
    if path.lower().endswith(".zip"):

        def unzip(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for name, content in zip(part["path"], part["content"], strict=True):
                    with zipfile.ZipFile(BytesIO(content)) as archive:
                        files = [n for n in archive.namelist() if not n.endswith("/")]
                        if len(files) != 1:
                            raise ValueError("an archive of names holds one file and no other")
                        with archive.open(files[0]) as raw:
                            lines: list[tuple[str, str]] = []
                            for i, line in enumerate(TextIOWrapper(raw, "utf-8", errors="replace", newline="\n")):
                                lines.append((f"{name}#{i:020d}", line.removesuffix("\n").removesuffix("\r")))
                                if len(lines) == 50_000:
                                    yield pd.DataFrame(lines, columns=["seq", "line"])
                                    lines = []
                            yield pd.DataFrame(lines, columns=["seq", "line"])

        lines = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(unzip, "seq string, line string")
    else:
        read = spark.read.text(path)
        meta = F.col("_metadata")
        seq = F.format_string("%s#%020d#%020d", meta["file_path"], meta["file_block_start"], F.monotonically_increasing_id())
        lines = read.select(seq.alias("seq"), F.make_valid_utf8("value").alias("line"))
        if path.lower().endswith(".gz"):  # one task reads such a file; the lines are dealt out before they are parsed
            lines = lines.repartition("seq")
    return lines.withColumn("line", F.ltrim("line", F.lit("﻿")))


def _observe(lines: DataFrame, raw: Column, rank: Column | None = None, metadata: Column | None = None, offered: Column | None = None, short: Column | None = None) -> DataFrame:
    short = F.lit(False) if short is None else short
    return lines.select(
        "seq",
        raw.alias("raw"),
        (F.lit(None) if rank is None else rank).cast("bigint").alias("rank"),
        (F.lit(None) if metadata is None else metadata).cast("string").alias("metadata"),
        ((F.lit(True) if offered is None else offered) & ~short).alias("offered"),
        short.alias("short"),
    )


def plain_list(lines: DataFrame, tlds: tuple[str, ...] = ("ro",)) -> DataFrame:
    """The first word of each line; names under other top-level labels are only counted."""
    word = F.element_at(F.split(F.btrim("line", F.lit(_BLANKS)), r"[\s\x1c-\x1f\x85\xa0]+"), 1)
    return _observe(lines, word, offered=ends_with_tld(word, tlds))


def graph_vertices(lines: DataFrame, tld: str = "ro") -> DataFrame:
    """Tab-separated id, reversed name and optional host count."""
    parts = F.split("line", "\t")
    name = F.get(parts, F.lit(1))
    count = parse_count(F.get(parts, F.lit(2)))
    short = F.size(parts) < 2
    return _observe(lines, reverse_labels(name), metadata=metadata_json(host_count=count), offered=F.coalesce((name == tld) | F.startswith(name, F.lit(f"{tld}.")), F.lit(False)), short=short)


def _cells(line: Column, n: int) -> Column:
    return F.from_csv(line, ", ".join(f"c{i} string" for i in range(n)), {"escape": '"', "nullValue": "\u0000", "emptyValue": ""})


def header_csv(lines: DataFrame, column: str, rank_column: str | None = None) -> DataFrame:
    """A CSV with a header line; quoted cells may not hold line breaks.  Blank lines are skipped, as no row stands there."""
    first = lines.orderBy("seq").limit(1).first()
    header = [] if first is None else [str(x) for x in lines.sparkSession.createDataFrame([(first["line"],)], "line string").select(_cells(F.col("line"), first["line"].count(",") + 1).alias("c")).first()["c"]]
    missing = [c for c in (column, rank_column) if c is not None and c not in header]
    if column in missing:
        raise ValueError(f"no column {column!r} in the header {header}")
    body = lines.filter((F.col("seq") != first["seq"]) & (F.col("line") != ""))
    cells = body.withColumn("c", _cells(F.col("line"), len(header)))
    at = lambda name: F.col("c")[f"c{header.index(name)}"]
    return _observe(cells, F.coalesce(at(column), F.lit("")), None if rank_column is None or rank_column in missing else parse_count(at(rank_column)))


def rank_csv(lines: DataFrame) -> DataFrame:
    """rank,name without a header; a row of fewer than two cells is rejected."""
    cells = lines.withColumn("c", _cells(F.col("line"), 2))
    short = F.col("c")["c1"].isNull()
    return _observe(cells, F.col("c")["c1"], parse_count(F.col("c")["c0"]), short=short)


def contacts(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of type ``website`` of the part files of a contact table, in order of file name."""
    schema = "cui string, type string, value string, status string"
    read = spark.read.csv(f"{directory}/data/contacts/part-*.csv", header=True, escape='"', multiLine=True, enforceSchema=False, schema=schema)
    seq = F.format_string("%s#%020d", F.col("_metadata")["file_name"], F.monotonically_increasing_id())
    rows = read.withColumn("seq", seq).filter(F.col("type") == "website")
    return _observe(rows, F.coalesce("value", F.lit("")), metadata=metadata_json(cui=F.col("cui"), status=F.col("status")))


# The tags of a map object that hold web and mail addresses.
MAP_TAGS = ("website", "contact:website", "url", "contact:url", "email", "contact:email")


def map_objects(objects: DataFrame) -> DataFrame:
    """Observations of map objects (osm_type, osm_id, tags): one for each item between semicolons of each address tag."""
    keys = F.array(*[F.lit(k) for k in MAP_TAGS])
    one = objects.select("osm_type", F.col("osm_id").cast("string").alias("osm_id"), "tags", F.posexplode(keys).alias("k", "tag"))
    one = one.withColumn("value", F.element_at("tags", F.col("tag"))).filter("value <> ''")
    items = one.select("osm_type", "osm_id", "tag", "k", F.posexplode(F.split("value", ";")).alias("i", "item"))
    seq = F.format_string("%s#%s#%02d#%06d", F.col("osm_type"), F.lpad("osm_id", 20, "0"), F.col("k"), F.col("i"))
    rows = items.withColumn("seq", seq)
    return _observe(rows, F.btrim("item", F.lit(_BLANKS)), metadata=metadata_json(osm_type=F.col("osm_type"), osm_id=F.col("osm_id"), tag=F.col("tag")))
