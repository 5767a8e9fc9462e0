"""Document fingerprints by I-Match over randomised lexicons.

Terms are lower-cased words.  The document frequency of every term over all
documents is counted exactly, and the lexicon keeps the terms within a band of
inverse document frequency.  FAMILIES x len(DENSITIES) randomised sub-lexicons
are fixed, the same for every document: sub-lexicon (f, d) holds each lexicon
term with probability 4^-d, by a seeded hash of the term.  Under each of them
the sorted distinct terms of a text that the sub-lexicon holds are hashed; where
it holds none, the text has no hash there.  The sparse ones keep a few terms of
a long text, which outlive an edit elsewhere in it; the dense ones keep a few
terms of a short text, and change with any edit of a long one.

A fingerprint lists the whole lexicon's hash and, of each family, the hashes under
the sub-lexicons that hold 1 to FEW terms of the text (if there are none, under
the sparsest that holds any); denser ones are not listed.  Likeness of two fingerprints is the share of equal hashes
among the sub-lexicons that either lists, without those that are denser than all
that the other one lists of the family.  So it is 1 for equal texts, and near
the share of terms in common.

The band bounds the lexicon: every term in it is in band[0] of all documents at
least, so there are no more of them than the mean number of distinct terms of a
document divided by band[0], however many documents there are.

Defined results: a null text is an empty text; a text without lexicon terms is
fingerprinted by all its terms; a text without words has the fingerprint
"-", which is like itself only.  The next document is the next row in order of
doc_id (null first) and then of text, so repeated ids are allowed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from zonekeep.llm.words import LOWER_ASCII, batches, mix, text_buffer, word_hashes, word_spans
from zonekeep.store import stage

#: The band of document frequency, as shares of all documents, that the lexicon keeps.
BAND = (5e-4, 1e-1)
#: Families of sub-lexicons, and in each the powers of 1/4 with which it holds a term.
FAMILIES, DENSITIES = 28, range(9)
#: Terms of a text under a sub-lexicon up to which it is listed.
FEW = 3
_U = np.uint64
_SALTS = mix(np.arange(1, FAMILIES + 2, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def distinct_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct terms of each text, sorted."""
    data, offs = text_buffer(texts)
    data = LOWER_ASCII[data]
    starts, ends, bounds = word_spans(data, offs)
    terms = word_hashes(data, starts, ends)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((terms, text))
    text, terms = text[order], terms[order]
    fresh = np.ones(len(terms), bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (text[1:] != text[:-1])
    return text[fresh], terms[fresh]


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """term, n: the number of documents that hold each term."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for begin, end in batches(part.column(0)):  # counted by batch, then added up
                terms, n = np.unique(distinct_terms(part.column(0).slice(begin, end - begin))[1], return_counts=True)
                for a in range(0, len(terms), 65536):
                    yield pa.RecordBatch.from_arrays([pa.array(terms[a : a + 65536].view(np.int64)), pa.array(n[a : a + 65536])], names=["term", "n"])

    return docs.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND, text: str = "text") -> np.ndarray:
    """The sorted hashes of the terms in the band; see above for the bound of their number."""
    total = docs.count()
    inside = document_frequencies(docs, text).filter((F.col("n") >= F.lit(band[0] * total)) & (F.col("n") <= F.lit(max(band[1] * total, 1.0))))
    return np.sort(inside.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))


class IMatch:
    """Fingerprints under one lexicon."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms

    def _inside(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(terms), bool)
        return self.terms[np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)] == terms

    def signatures(self, texts: pa.Array) -> np.ndarray:
        """For each text and sub-lexicon 16 bits of the hash of its terms, zero where it is not listed."""
        n = len(texts)
        out = np.zeros((n, FAMILIES, len(DENSITIES)), np.uint16)
        few = np.zeros(out.shape, bool)
        for begin, end in batches(texts):
            at, terms = distinct_terms(texts.slice(begin, end - begin))
            inside = self._inside(terms)
            have = np.zeros(end - begin, bool)
            have[at[inside]] = True
            inside |= ~have[at]
            at, terms = at[inside], terms[inside]
            hashes = mix(terms ^ _SALTS[FAMILIES])
            for f in range(FAMILIES):
                # two leading zeros more of a draw: in the next sub-lexicon too, which holds a quarter
                level = (64 - np.frexp(mix(terms ^ _SALTS[f]).astype(np.float64))[1]) >> 1
                left, where = np.arange(len(terms)), at
                for d in DENSITIES:
                    if d:
                        keep = level[left] >= d
                        left, where = left[keep], where[keep]
                    if not len(left):
                        break
                    first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
                    # terms are sorted and distinct, so equal sets of terms have equal sums
                    sums = mix(np.add.reduceat(hashes[left], first) + _U(f * 16 + d))
                    out[begin + where[first], f, d] = 1 + sums % _U(65535)
                    few[begin + where[first], f, d] = np.diff(np.append(first, len(where))) <= FEW
        sparsest = (out > 0).sum(axis=2, keepdims=True) - 1  # a sub-lexicon holds a term only where the denser ones do
        listed = few | (np.arange(len(DENSITIES)) == sparsest) & ~few.any(axis=2, keepdims=True)
        listed[:, 0, 0] = True
        return np.where(listed, out, 0).astype(np.uint16).reshape(n, -1)

    @staticmethod
    def bytes_of(signatures: np.ndarray) -> list[bytes]:
        """Three bytes for each listed sub-lexicon: its number and hash."""
        numbered = (signatures | np.arange(signatures.shape[1], dtype=np.uint32) << 16).astype(">u4")
        return [row[some].view(np.uint8).reshape(-1, 4)[:, 1:].tobytes() for row, some in zip(numbered, signatures > 0, strict=True)]

    @staticmethod
    def read(fingerprint: bytes) -> np.ndarray:
        row = np.zeros(FAMILIES * len(DENSITIES), np.uint16)
        some = np.frombuffer(fingerprint, np.uint8).reshape(-1, 3).astype(np.uint16)
        row[some[:, 0]] = some[:, 1] << 8 | some[:, 2]
        return row

    @staticmethod
    def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shape = (len(a), FAMILIES, len(DENSITIES))

        def denser(x: np.ndarray) -> np.ndarray:
            """Not listed though a sparser one is."""
            listed = x.reshape(shape) > 0
            after = np.logical_or.accumulate(listed[:, :, ::-1], axis=2)[:, :, ::-1]
            return (after & ~listed).reshape(x.shape)

        counted = ((a > 0) | (b > 0)) & ~denser(a) & ~denser(b)
        n = counted.sum(axis=1)
        return np.where(n > 0, ((a == b) & counted).sum(axis=1) / np.maximum(n, 1), (~(a.any(axis=1) | b.any(axis=1))).astype(float))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, tie and the compressed text: less than half of the bytes are shuffled."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for part in parts:
        for begin, end in batches(part.column(2)):
            texts = part.column(2).slice(begin, end - begin).to_pylist()
            yield pa.RecordBatch.from_arrays([part.column(0).slice(begin, end - begin), part.column(1).slice(begin, end - begin), pa.array([squeeze(t.encode()) for t in texts], pa.binary())], names=["doc_id", "tie", "packed"])


def _unpacked(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of a batch, about ``limit`` bytes of text at a time."""
    expand = zstandard.ZstdDecompressor().decompress
    texts, size, begin = [], 0, 0
    for i, packed in enumerate(batch.column(1)):
        raw = expand(packed.as_py())
        if texts and size + len(raw) > limit:
            yield batch.column(0).slice(begin, len(texts)), texts
            texts, size, begin = [], 0, i
        texts.append(raw.decode())
        size += len(raw)
    if texts:
        yield batch.column(0).slice(begin, len(texts)), texts


_OUT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _rows(match: IMatch, ids: pa.Array, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> list[pa.Array]:
    edited = [_edited(t, f) for t, f in zip(texts, following, strict=True)]
    theirs = match.signatures(pa.array(edited, pa.large_string()))
    return [
        ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).digest() for t in edited], pa.binary()),
        pa.array(match.bytes_of(own), pa.binary()),
        pa.array(match.bytes_of(theirs), pa.binary()),
        pa.array(match.likeness(own, theirs), pa.float64()),
        pa.array(match.likeness(own, after), pa.float64()),
    ]


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for ``docs`` (doc_id, text).

    The texts are shuffled once, compressed, by ranges of doc_id; the row at the end of a
    range meets the first row of the next range that has rows in a second step.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon(docs, band))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    packed = rows.select("doc_id", "tie", "text").mapInArrow(_pack, "doc_id long, tie long, packed binary")
    ordered = packed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "packed").select("doc_id", "packed")
    schema = f"kind int, part int, edge_text string, {_OUT}"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, part = IMatch(shared.value), TaskContext.get().partitionId()
        held: tuple[pa.Array, str, np.ndarray] | None = None

        def give(kind: int, columns: list[pa.Array], edge: str | None) -> pa.RecordBatch:
            n = len(columns[0])
            return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array([edge] * n, pa.string()), *columns], names=["kind", "part", "edge_text", *_NAMES])

        def edge_row(kind: int, ids: pa.Array, text: str, own: np.ndarray) -> pa.RecordBatch:
            none = pa.array([None], pa.binary())
            return give(kind, [ids, pa.array([len(text)], pa.int64()), none, pa.array(match.bytes_of(own[None]), pa.binary()), none, pa.array([None], pa.float64()), pa.array([None], pa.float64())], text)

        for batch in parts:
            for ids, texts in _unpacked(batch):
                own = match.signatures(pa.array(texts, pa.large_string()))
                if held is None:
                    yield edge_row(2, ids.slice(0, 1), texts[0], own[0])
                    now_ids, now_texts, now_own = ids.slice(0, len(texts) - 1), texts[:-1], own[:-1]
                    following, after = texts[1:], own[1:]
                else:
                    now_ids = pa.concat_arrays([held[0], ids.slice(0, len(texts) - 1)])
                    now_texts, now_own = [held[1], *texts[:-1]], np.concatenate([held[2][None], own[:-1]])
                    following, after = texts, own
                if now_texts:
                    yield give(0, _rows(match, now_ids, now_texts, following, now_own, after), None)
                held = ids.slice(len(texts) - 1, 1), texts[-1], own[-1]
        if held is not None:
            yield edge_row(1, *held)

    found = stage(ordered.mapInArrow(run, schema), "imatch-rows")
    # the next range that has rows; only the numbers of the ranges are on the driver, the edges meet by a join
    ranges = sorted(r[0] for r in found.filter("kind = 2").select("part").collect())
    after = spark.createDataFrame(list(zip(ranges, ranges[1:] + ranges[:1], strict=True)), "part int, next_part int")
    again = spark.read.schema(found.schema).parquet(found._staged_at)
    heads = again.filter("kind = 2").select(F.col("part").alias("next_part"), F.col("edge_text").alias("next_text"), F.col("fingerprint").alias("next_own"))
    tails = found.filter("kind = 1").select("part", "doc_id", "edge_text", "fingerprint")
    edges = tails.join(after, "part").join(heads, "next_part").select("doc_id", "edge_text", "fingerprint", "next_text", "next_own")

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = IMatch(shared.value)
        for batch in parts:
            for i in range(batch.num_rows):
                ids = batch.column(0).slice(i, 1)
                text, own, following, after = (batch.column(c)[i].as_py() for c in range(1, 5))
                yield pa.RecordBatch.from_arrays(_rows(match, ids, [text], [following], match.read(own)[None], match.read(after)[None]), names=_NAMES)

    out = found.filter("kind = 0").select(*_NAMES).unionByName(edges.mapInArrow(finish, _OUT))
    shown = {c: F.when(F.octet_length(c) > 0, F.base64(c)).otherwise("-") for c in ("fingerprint", "edited_fingerprint")}
    return out.withColumns(shown | {"edited_sha256": F.lower(F.hex("edited_sha256"))})
