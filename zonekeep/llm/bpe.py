"""Byte-level BPE encoding and decoding by a pair occurrence index.

The vocabulary file is read from a path at run time (JSON with ``vocab``,
``merges`` and ``added_tokens``); nothing of it is kept here.  The distinct
pieces of a batch that are not known yet are laid out in one symbol list, an
index maps each adjacent pair that has a rank to all its positions, and the
lowest active rank is applied to all its positions at once, which changes the
lists of the pairs beside them.  Pieces stay known, with their ids, up to a
fixed number of bytes, and texts are taken in batches of a fixed number of
bytes, so memory does not follow the size of the table.

Defined results: a null text is an empty text and has no ids.  Added tokens
that stand in a text become their own id, as the vocabulary's library does.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from zonekeep.llm.words import batches

#: Fixed value: the published splitting pattern of byte-level BPE.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text whose pieces are indexed together; a longer text is a batch of its own.
BATCH_BYTES = 4_000_000
#: Bytes of pieces whose ids are kept from batch to batch; past them the next batch starts anew.
KNOWN_BYTES = 6_000_000
#: Characters from which on a text is cut piece by piece.
LONG_CHARS = 4_000_000


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte value in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class _Numbers(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


class PairIndexBPE:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_alphabet()
        value = {c: b for b, c in enumerate(letters)}
        self.byte_ids = np.array([vocab[c] for c in letters], np.int32)
        pairs = [tuple(p.split(" ")) if isinstance(p, str) else tuple(p) for p in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.new = [vocab[a + b] for a, b in pairs]
        keys = self.left << 32 | self.right
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(value[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = regex.compile("|".join(map(regex.escape, longest_first))) if self.added else None
        self.find = regex.compile(PIECES).findall
        self.find_each = regex.compile(PIECES).finditer
        self.forget()

    def pieces(self, text: str) -> list[str]:
        """The text cut into pieces; an added token is a piece of its own."""
        if not any(t in text for t in self.added):
            return self.find(text)
        out, at = [], 0
        for m in self.added_pattern.finditer(text):
            out += self.find(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.find(text[at:])

    def _each_piece(self, text: str) -> Iterator[str]:
        at = 0
        for m in self.added_pattern.finditer(text) if self.added else ():
            for piece in self.find_each(text[at : m.start()]):
                yield piece[0]
            yield m[0]
            at = m.end()
        for piece in self.find_each(text[at:]):
            yield piece[0]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given pieces, one after the other, and len(pieces) + 1 bounds."""
        raw = [p.encode() for p in pieces]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)].copy()
        n = len(symbols)
        before, after = np.arange(-1, n - 1, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32)
        filled = bounds[1:] > bounds[:-1]
        before[bounds[:-1][filled]] = -1
        after[bounds[1:][filled] - 1] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray, ranks: np.ndarray) -> None:
            there = ranks >= 0
            positions, ranks = positions[there], ranks[there]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                rank = int(ranks[a])
                if rank in index:
                    index[rank].append(positions[a:b])
                else:
                    index[rank] = [positions[a:b]]
                    heapq.heappush(active, rank)

        first = np.flatnonzero(after >= 0).astype(np.int32)
        note(first, self._rank_of(symbols[first], symbols[after[first]]))
        while active:
            rank = heapq.heappop(active)
            left, right, new = self.left[rank], self.right[rank], self.new[rank]
            lists = index.pop(rank)
            # in text order, each position once
            at = np.unique(np.concatenate(lists) if len(lists) > 1 else lists[0])
            beside = after[at]
            live = (symbols[at] == left) & (beside >= 0) & (symbols[beside] == right)  # else a neighbour has been merged meanwhile
            if not live.all():
                at, beside = at[live], beside[live]
            if left == right and len(at) > 1:
                # of pairs that overlap, every second one counts from the first on
                joined = np.concatenate([[False], at[1:] == beside[:-1]])
                where = np.arange(len(at))
                run = np.maximum.accumulate(np.where(joined, 0, where))
                keep = (where - run) % 2 == 0
                at, beside = at[keep], beside[keep]
            if not len(at):
                continue
            behind = after[beside]
            symbols[at] = new
            symbols[beside] = -1
            after[at] = behind
            more = behind >= 0
            before[behind[more]] = at[more]
            ahead = before[at]
            has = ahead >= 0
            a, b = at[more], ahead[has]
            positions = np.concatenate([a, b])
            ranks = self._rank_of(np.concatenate([symbols[a], symbols[b]]), np.concatenate([symbols[behind[more]], symbols[at[has]]]))
            note(positions, ranks)
        alive = symbols >= 0
        counts = np.concatenate([[0], np.cumsum(alive)])
        return symbols[alive], counts[bounds]

    def number(self, texts: list[str]) -> list[np.ndarray]:
        """Per text the numbers of its pieces among the known pieces; pieces that are new become known."""
        if self.known_bytes > KNOWN_BYTES:
            self.forget()
        known, before, cut = self.known, len(self.known), []
        for text in texts:
            # a very long text is cut piece by piece, so that its pieces are never held together
            pieces = self.pieces(text) if len(text) <= LONG_CHARS else self._each_piece(text)
            cut.append(np.fromiter(map(known.__getitem__, pieces), np.int32))
        fresh = list(islice(known, before, None))
        if fresh:
            self.known_bytes += sum(map(len, fresh))
            ids, bounds = self.learn([p if p not in self.added else "" for p in fresh])
            for k, piece in enumerate(fresh):
                if piece in self.added:  # an added token has its own id
                    ids = np.insert(ids, bounds[k], self.added[piece])
                    bounds[k + 1 :] += 1
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
        return cut

    def forget(self) -> None:
        self.known = _Numbers()
        self.known_bytes = 0
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.shown: list[str] = []

    def ids_of(self, cut: np.ndarray) -> np.ndarray:
        """Ids of the pieces with the given numbers, one after the other."""
        return self.ids[ragged(self.bounds[cut], self.bounds[cut + 1] - self.bounds[cut])]

    def id_texts(self) -> list[str]:
        """Of each known piece its decimal ids, joined by commas."""
        at = len(self.shown)
        flat, bounds = self.ids[self.bounds[at] :].tolist(), (self.bounds[at:] - self.bounds[at]).tolist()
        self.shown += [",".join(map(str, flat[a:b])) for a, b in pairwise(bounds)]
        return self.shown

    def encode(self, text: str) -> list[int]:
        return self.ids_of(self.number([text])[0]).tolist()

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = True, digests: bool = True, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``keep`` columns, n_tokens, and as asked ids (array of int) and digests (ids_sha256, decoded_sha256) of every whole text.

    ``decoded_sha256`` is of the text decoded again from the ids.  The
    vocabulary file must be readable at its path on every executor.
    """
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens long"
    schema += ", ids array<int>" * ids + ", ids_sha256 string, decoded_sha256 string" * digests
    names = [*keep, "n_tokens"] + ["ids"] * ids + ["ids_sha256", "decoded_sha256"] * digests

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PairIndexBPE(vocabulary)
        for part in parts:
            column = part.column(part.num_columns - 1)
            for begin, end in batches(column, batch_bytes):
                cut = bpe.number([t or "" for t in column.slice(begin, end - begin).to_pylist()])
                sizes = np.diff(bpe.bounds)
                n_tokens = np.array([sizes[c].sum() for c in cut], np.int64)
                out = [part.column(i).slice(begin, end - begin) for i in range(part.num_columns - 1)]
                out.append(pa.array(n_tokens))
                if ids:
                    offsets = np.concatenate([[0], np.cumsum(n_tokens)])
                    flat = np.empty(offsets[-1], np.int32)
                    for c, a, b in zip(cut, offsets, offsets[1:], strict=False):
                        flat[a:b] = bpe.ids_of(c)
                    out.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)))
                if digests:
                    shown = bpe.id_texts()
                    out.append(pa.array([hashlib.sha256(",".join(map(shown.__getitem__, c.tolist())).encode()).hexdigest() for c in cut], pa.string()))
                    out.append(pa.array([hashlib.sha256(bpe.decode(bpe.ids_of(c).tolist()).encode()).hexdigest() for c in cut], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(*keep, text).mapInArrow(run, schema)
