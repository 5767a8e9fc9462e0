"""Input files of the registry: what is expected, what is there, and fetching what is not.

An input is a row (name, url, sha256) with a digest of null where none is known.
The list is a parameter; nothing here names an address.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterable
from typing import BinaryIO, NamedTuple
from urllib.request import Request, urlopen

from pyspark.sql import SparkSession

from zonekeep.operators import sinks

CHUNK = 1 << 20


class Input(NamedTuple):
    name: str
    url: str
    sha256: str | None = None


def open_at(url: str, offset: int) -> BinaryIO:
    """The bytes of ``url`` from ``offset`` on, whether or not the server can begin there."""
    source = urlopen(Request(url, headers={"Range": f"bytes={offset}-"} if offset else {}), timeout=60)
    left = 0 if getattr(source, "status", None) == 206 else offset
    while left > 0:
        got = len(source.read(min(CHUNK, left)))
        if not got:
            raise OSError(f"{url} is shorter than before")
        left -= got
    return source


def _copy(item: Input, out, opener: Callable[[str, int], BinaryIO], tries: int, wait: float) -> tuple[int, str]:
    """Bytes and digest of what was written to ``out``; a broken connection is taken up where it broke."""
    digest, done, failures = hashlib.sha256(), 0, 0
    while True:
        try:
            with opener(item.url, done) as source:
                while chunk := source.read(CHUNK):
                    out.write(chunk)
                    digest.update(chunk)
                    done += len(chunk)
            return done, digest.hexdigest()
        except OSError:
            failures += 1
            if failures > tries:
                raise
            time.sleep(wait)


def fetch(spark: SparkSession, inputs: Iterable[Input], folder: str, opener: Callable[[str, int], BinaryIO] = open_at, tries: int = 3, wait: float = 1.0) -> dict[str, dict]:
    """Copy the inputs that are not in ``folder`` yet, each whole or not at all, and write what is there to inputs.json.

    A file that is there is kept if its digest is the expected one, or none is expected.
    """
    facts = {}
    for item in inputs:
        path = f"{folder}/{item.name}"
        fs, target = sinks._fs(spark, path)
        there = sinks.file_facts(spark, path) if fs.exists(target) else None
        if there is None or item.sha256 not in (None, there["sha256"]):
            fs, part = sinks._fs(spark, f"{path}.part")
            out = fs.create(part, True)
            try:
                size, digest = _copy(item, out, opener, tries, wait)
            finally:
                out.close()
            if item.sha256 not in (None, digest):
                fs.delete(part, False)
                raise ValueError(f"{item.name}: the digest is {digest}, expected {item.sha256}")
            fs.delete(target, False)
            fs.rename(part, target)
            there = {"bytes": size, "sha256": digest}
        facts[item.name] = {"url": item.url, **there}
    sinks.write_manifest(spark, f"{folder}/inputs.json", facts)
    return facts


def missing(spark: SparkSession, inputs: Iterable[Input], folder: str) -> dict[str, str]:
    """The inputs that can not be imported from ``folder``, with the reason: absent or changed."""
    out = {}
    for item in inputs:
        path = f"{folder}/{item.name}"
        fs, target = sinks._fs(spark, path)
        if not fs.exists(target):
            out[item.name] = "absent"
        elif item.sha256 not in (None, sinks.file_facts(spark, path)["sha256"]):
            out[item.name] = "changed"
    return out
