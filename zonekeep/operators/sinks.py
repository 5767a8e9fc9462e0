"""Files that leave the engine: sorted CSV and text exports, manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekeep.operators import progress


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside its place and renamed."""
    fs, target = _fs(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(beside, target)


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None where there is none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:  # only pointers, settings and manifests are read this way
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _parts(spark: SparkSession, folder: str) -> list:
    """The part files of a folder in order of their partitions."""
    fs, target = _fs(spark, folder)
    return sorted((s.getPath() for s in fs.listStatus(target) if s.getPath().getName().startswith("part-")), key=lambda p: (int(p.getName().split("-")[1]), p.getName()))


def _single_file(rows: DataFrame, write, path: str, head=None) -> int:
    """``write`` makes a folder of part files, sorted and packed by all tasks; they are strung together as the file ``path``.

    ``head`` makes a folder whose file comes first.  A gzip file may have many members, so packed parts are joined as they are.
    Returns the rows, counted as they are written.
    """
    spark = rows.sparkSession
    folder = f"{path}.{uuid.uuid4().hex}.dir"
    # counted above the sort, whose sampling of ranges reads the rows below it once more
    counted, seen = progress.counted(rows, folder)
    write(counted).save(f"{folder}/rows")
    if head:
        head(spark.createDataFrame([], rows.schema).coalesce(1)).save(f"{folder}/head")
    jvm = spark._jvm
    fs, target = _fs(spark, path)
    whole = jvm.org.apache.hadoop.fs.Path(f"{folder}/whole")
    out = fs.create(whole, True)
    for part in (_parts(spark, f"{folder}/head") if head else []) + _parts(spark, f"{folder}/rows"):
        stream = fs.open(part)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
        stream.close()
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(whole, target)
    fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    return progress.report(seen, path)


def export_csv(rows: DataFrame, path: str, order: list[str], columns: list[str] | None = None) -> int:
    """One CSV of ``columns`` (all, if not given) with a header, sorted; compressed when the name ends in .gz; nulls are empty fields.  Returns the rows."""
    packed = "gzip" if path.endswith(".gz") else "none"
    form = lambda df, header: df.write.format("csv").options(header=header, compression=packed, quote='"', escape='"', nullValue="", emptyValue="", lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return _single_file(rows.orderBy(*order).select(*(columns or rows.columns)), lambda df: form(df, False), path, lambda df: form(df, True))


def export_lines(lines: DataFrame, path: str, order: list[str]) -> int:
    """One text file of the column ``line``, sorted.  Returns the lines."""
    packed = "gzip" if path.endswith(".gz") else "none"
    return _single_file(lines.orderBy(*order).select("line"), lambda df: df.write.format("text").options(compression=packed, lineSep="\n"), path)


def content_digest(spark: SparkSession, paths: list[str]) -> str:
    """SHA-256 over the bytes of files in the given order, read as a stream by the JVM: a file of any length is never held."""
    jvm = spark._jvm
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    sink = jvm.java.security.DigestOutputStream(jvm.java.io.OutputStream.nullOutputStream(), digest)
    for path in paths:
        fs, target = _fs(spark, path)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(target), sink, 1 << 20, False)
    return bytes(digest.digest()).hex()


def file_facts(spark: SparkSession, path: str) -> dict:
    """Bytes and SHA-256 of a file."""
    fs, target = _fs(spark, path)
    return {"bytes": fs.getFileStatus(target).getLen(), "sha256": content_digest(spark, [path])}


def check_manifest(spark: SparkSession, path: str) -> dict[str, bool]:
    """For each file named in a manifest beside it, whether its bytes and digest are still as published."""
    facts = json.loads(read_text_file(spark, path) or "{}")
    folder = path.rsplit("/", 1)[0]
    return {name: file_facts(spark, f"{folder}/{name}") == {k: f[k] for k in ("bytes", "sha256")} for name, f in facts.items() if isinstance(f, dict) and "sha256" in f}


def write_manifest(spark: SparkSession, path: str, facts: dict) -> None:
    write_text_file(spark, path, json.dumps(facts, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
