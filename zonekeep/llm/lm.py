"""Log-bilinear language model scores.

Words are counted over all training documents, in hashed ranges.  The words
that the model predicts one by one follow the corpus: as many of the most
frequent ones as GROWTH times the square root of the number of training tokens.
All rarer words are classed by how often they were seen (powers of two, as many
as the counts need) and by how they end, the unseen ones together, and have
their share of the tokens of their class.

A log-bilinear model with two context positions predicts the next word or
class, q(w) . (C1 r(w-1) + C2 r(w-2)) + b(w).  As a context, a word is itself
when it is among the CONTEXTS most frequent ones and else its count and ending.
Training is in numpy by noise-contrastive estimation: training text is dealt
into shards, whose number grows with the square root of its size like the model
itself; each runs over its text from the shared start in order of block, and
the parameters are averaged in a fixed order, round by round.

Scores are normalised: with E1 and E2 the exponentials of the two positions'
products with all words, the normalisers of all pairs of contexts are the
matrix product E1 diag(exp b) E2^T, made in batches of words by several tasks.
The probabilities of all known words and of "unseen" sum to one.  In training,
a word seen once, twice or three times stands for a word seen one time less, as
it would be seen without that place.

Texts pass Python once; then blocks of token numbers are staged.  What is
gathered from the corpus (terms, counts) is moved as arrays, one for each block
and hashed range that is not empty; the ranges grow with the square root of
the terms, so there are never more rows than terms of blocks.

Defined results: a null text is an empty text, which still has its end token;
a null doc_id is held out; without training text every token is unseen.  Runs
that cut the input into the same partitions give the same scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from zonekeep.llm.words import LOWER_ASCII, batches, text_buffer, word_hashes, word_spans
from zonekeep.store import discard, stage

#: Words that are predicted one by one, per square root of training tokens, and the least count of such a word.
GROWTH, LEAST_COUNT = 4.0, 8
#: Words that are contexts of their own at most; their pairs make the table of normalisers.
CONTEXTS = 1024
#: Dimensions, noise words of a batch, tokens of a batch, rounds and first step size.
DIMENSIONS, NOISE, BATCH, ROUNDS, STEP = 16, 128, 4096, 2, 0.1
#: Square root of the training tokens for each shard of training.
SHARD_ROOT = 400
#: Bytes of text of a block; terms of a hashed range while there are LEAST_RANGES of them.
BLOCK_BYTES, RANGE_TERMS, LEAST_RANGES = 2 << 20, 125_000, 64
#: Endings of words, and classes of count and ending, of which 0 is "unseen".
ENDINGS = 54
CLASSES = 1 + 64 * ENDINGS
#: Start of the sums of squares of AdaGrad; numbers of a piece of the parameters; words of a batch of normalisers.
EPS, PIECE, WORDS_AT_ONCE = 1e-6, 8192, 4096
_U = np.uint64
END_HASH = _U(0xE4D0F7E00)
_LOW = _U(63)
_STOPS = np.isin(np.arange(256), list(b".,!?;:"))


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 40) if raw else b"", kind)


def ending_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """0 to 53: the last letter a-z of each word before a stop (0 for another), and 27 more where it holds bytes beyond ASCII."""
    last = data[ends - 1]
    last = np.where(_STOPS[last] & (ends - starts > 1), data[np.maximum(ends - 2, 0)], last).astype(np.int64)
    beyond = np.concatenate([[0], np.cumsum(data >= 128)])
    return np.where((last >= 97) & (last <= 122), last - 96, 0) + 27 * (beyond[ends] > beyond[starts])


def class_of(count: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Class of words by count (1, 2, 3, then powers of two) and ending, which is in the low bits of a term."""
    bins = np.where(count < 4, count, np.frexp(np.maximum(count, 1).astype(np.float64))[1] + 1)
    return np.where(count > 0, 1 + (bins - 1) * ENDINGS + (terms & _LOW).astype(np.int64), 0).astype(np.int64)


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents: ids, lengths, token numbers, the block's terms and how often training documents have them."""
    schema = "block long, n_terms long, n_train long, doc_ids array<long>, held array<boolean>, lengths array<int>, tokens binary, vocab binary, counts binary"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part in parts:
            texts = part.column(2)
            for begin, end in batches(texts, BLOCK_BYTES):
                ids, held = part.column(0).slice(begin, end - begin), part.column(1).slice(begin, end - begin)
                data, offs = text_buffer(texts.slice(begin, end - begin))
                data = LOWER_ASCII[data]
                starts, ends, bounds = word_spans(data, offs)
                words = word_hashes(data, starts, ends) & ~_LOW | ending_of(data, starts, ends).astype(np.uint64)
                n = np.diff(bounds)
                every = np.insert(words, bounds[1:], END_HASH)
                vocab, tokens = np.unique(every, return_inverse=True)
                learn = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), n + 1)
                counts = np.bincount(tokens[learn], minlength=len(vocab))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([len(vocab)], pa.int64()),
                        pa.array([int(learn.sum())], pa.int64()),
                        pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                        pa.array([held.to_pylist()], pa.list_(pa.bool_())),
                        pa.array([(n + 1).tolist()], pa.list_(pa.int32())),
                        pa.array([_pack(tokens.astype(np.int32))], pa.binary()),
                        pa.array([vocab.tobytes()], pa.binary()),
                        pa.array([_pack(counts.astype(np.int32))], pa.binary()),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )
                block += 1

    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), "text").mapInArrow(run, schema)


def _gather(blocks: DataFrame, ranges: int, least: int) -> DataFrame:
    """Counts over all blocks: kind 0 a block's counts in a range, kind 1 words of ``least`` tokens or more, kind 2 tokens and types by class."""
    width = 2**64 // ranges + 1

    def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array([min(k * width, 2**64 - 1) for k in range(1, ranges)], np.uint64)
        for part in parts:
            for i in range(part.num_rows):
                block = part.column(0)[i].as_py()
                vocab = np.frombuffer(part.column(1)[i].as_py(), np.uint64)
                counts = _unpack(part.column(2)[i].as_py(), np.int32)
                at = [0, *np.searchsorted(vocab, cuts).tolist(), len(vocab)]
                full = [r for r in range(ranges) if at[r + 1] > at[r]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.int32()),
                        pa.array([block] * len(full), pa.int64()),
                        pa.array([vocab[at[r] : at[r + 1]].tobytes() for r in full], pa.binary()),
                        pa.array([_pack(counts[at[r] : at[r + 1]]) for r in full], pa.binary()),
                    ],
                    names=["r", "block", "vocab", "counts"],
                )

    cut = blocks.select("block", "vocab", "counts").mapInArrow(slices, "r int, block long, vocab binary, counts binary")
    schema = "kind int, block long, r int, payload binary, key long, total long, types long"

    def add(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        vocabs = [np.frombuffer(v.as_py(), np.uint64) for v in table.column("vocab")]
        counts = [_unpack(c.as_py(), np.int32) for c in table.column("counts")]
        terms, at = np.unique(np.concatenate(vocabs), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(terms)).astype(np.int64)
        back = np.split(total[at], np.cumsum([len(v) for v in vocabs])[:-1])
        top = np.flatnonzero(total >= least)
        cls = class_of(total, terms)
        tokens, types = np.bincount(cls, weights=total, minlength=CLASSES).astype(np.int64), np.bincount(cls, minlength=CLASSES)
        used = np.flatnonzero(types)
        n, m, k = len(vocabs), len(top), len(used)
        none = lambda x: [None] * x
        return pa.table(
            {
                "kind": pa.array([0] * n + [1] * m + [2] * k, pa.int32()),
                "block": pa.array(table.column("block").to_pylist() + none(m + k), pa.int64()),
                "r": pa.array([r] * (n + m + k), pa.int32()),
                "payload": pa.array([_pack(b) for b in back] + none(m + k), pa.binary()),
                "key": pa.array(none(n) + terms[top].view(np.int64).tolist() + used.tolist(), pa.int64()),
                "total": pa.array(none(n) + total[top].tolist() + tokens[used].tolist(), pa.int64()),
                "types": pa.array(none(n + m) + types[used].tolist(), pa.int64()),
            }
        )

    return cut.groupBy("r").applyInArrow(add, schema)


@dataclass
class Vocabulary:
    """What the model predicts: words one by one, most frequent first, and then classes of rarer words."""

    words: np.ndarray  # hashes of the words that are predicted one by one
    totals: np.ndarray  # their tokens
    tokens: np.ndarray  # tokens of each of CLASSES without those of ``words``
    n: int  # training tokens
    v: int  # distinct training tokens
    contexts: int = CONTEXTS

    def __post_init__(self) -> None:
        first = len(self.words)
        own = class_of(self.totals, self.words)
        self.classes = np.unique(np.concatenate([np.arange(1 + 3 * ENDINGS), np.flatnonzero(self.tokens), own]))
        self.place = np.full(CLASSES, -1)
        self.place[self.classes] = np.arange(len(self.classes))
        self.size = first + len(self.classes)
        # a word beyond the contexts is the class of its count and ending there
        k = min(first, self.contexts)
        self.context_of = np.concatenate([np.arange(k), k + self.place[own[k:]], k + np.arange(len(self.classes))])
        self.n_contexts = k + len(self.classes)
        self.order = np.argsort(self.words)
        self.sorted_words = self.words[self.order]
        # in training a word seen c times stands for one seen c - 1 times (c up to 3)
        self.moved = np.arange(self.size)
        self.moved[first + 1 : first + 1 + ENDINGS] = first
        self.moved[first + 1 + ENDINGS : first + 1 + 3 * ENDINGS] -= ENDINGS

    def outputs(self, terms: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What stands for each term, and the log10 of the term's share of it."""
        rare = class_of(count, terms)
        out = len(self.words) + self.place[rare]
        inner = np.where(rare > 0, np.log10(np.maximum(count, 1) / np.maximum(self.tokens[rare], 1)), 0.0)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.sorted_words, terms), len(self.words) - 1)
            short = self.sorted_words[at] == terms
            out[short] = self.order[at[short]]
            inner[short] = 0.0
        return out, inner

    def log_noise(self) -> np.ndarray:
        seen = np.zeros(self.size)
        np.add.at(seen, self.moved, np.concatenate([self.totals, self.tokens[self.classes]]).astype(float))
        return np.log((seen + 0.5) / (seen + 0.5).sum())


def _vocabulary(gathered: DataFrame, n: int, growth: float, contexts: int) -> Vocabulary:
    most = math.ceil(growth * math.sqrt(n))
    rare = gathered.filter("kind = 2").groupBy("key").agg(F.sum("total"), F.sum("types")).collect()  # CLASSES rows at most
    # the least count that no more than ``most`` words reach; there are less than sqrt(2 n) different counts
    found, least = 0, None
    for total, words in gathered.filter("kind = 1").groupBy("total").agg(F.count("*")).orderBy(F.col("total").desc()).toLocalIterator():
        if found + words > most:
            break
        found, least = found + words, total
    top = gathered.filter(F.col("kind") == 1).filter(F.lit(False) if least is None else F.col("total") >= least).select("key", "total").toPandas()  # ``most`` rows at most
    top = top.sort_values(["total", "key"], ascending=[False, True])
    words, totals = top["key"].to_numpy(np.int64).view(np.uint64), top["total"].to_numpy(np.int64)
    tokens = np.zeros(CLASSES)
    for c, total, _ in rare:
        tokens[c] = total
    np.subtract.at(tokens, class_of(totals, words), totals)
    return Vocabulary(words, totals, tokens, n, sum(types for c, _, types in rare if c), contexts)


def _classed(blocks: DataFrame, gathered: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per block what stands for its tokens, and per document what does not depend on context."""
    schema = "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, n_known array<long>, base array<double>, inner array<double>, outputs binary"
    shared = blocks.sparkSession.sparkContext.broadcast(vocabulary)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        known = shared.value
        row = {c: left.column(c)[0].as_py() for c in ("block", "doc_ids", "held", "lengths", "tokens", "vocab")}
        terms, tokens = np.frombuffer(row["vocab"], np.uint64), _unpack(row["tokens"], np.int32)
        parts = sorted(zip(right.column("r").to_pylist(), right.column("payload").to_pylist(), strict=True))
        count = np.concatenate([_unpack(p, np.int64) for _, p in parts])
        base = np.log10((count + 0.1) / (known.n + 0.1 * (known.v + 1)))
        out, inner = known.outputs(terms, count)
        begin = np.concatenate([[0], np.cumsum(row["lengths"])])[:-1]
        total = lambda x: np.add.reduceat(x[tokens], begin).tolist()
        return pa.table(
            {
                "block": pa.array([row["block"]], pa.int64()),
                "doc_ids": pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                "held": pa.array([row["held"]], pa.list_(pa.bool_())),
                "lengths": pa.array([row["lengths"]], pa.list_(pa.int32())),
                "n_known": pa.array([total((count > 0).astype(np.int64))], pa.list_(pa.int64())),
                "base": pa.array([total(base)], pa.list_(pa.float64())),
                "inner": pa.array([total(inner)], pa.list_(pa.float64())),
                "outputs": pa.array([_pack(out[tokens].astype(np.int32))], pa.binary()),
            }
        )

    left = blocks.select("block", "doc_ids", "held", "lengths", "tokens", "vocab").groupBy("block")
    right = gathered.filter("kind = 0").select("block", "r", "payload").groupBy("block")
    return left.cogroup(right).applyInArrow(join, schema)


class LogBilinear:
    """Parameters over ``n`` outputs and ``contexts`` contexts; one more context is the start of a text."""

    NAMES = ("r", "q", "c1", "c2", "b")

    def __init__(self, n: int, contexts: int, dim: int, bias: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.n, self.contexts, self.dim = n, contexts, dim
        self.r = (rng.standard_normal((contexts + 1, dim)) * 0.1).astype(np.float32)
        self.q = (rng.standard_normal((n, dim)) * 0.1).astype(np.float32)
        self.c1 = np.eye(dim, dtype=np.float32)
        self.c2 = np.eye(dim, dtype=np.float32)
        self.b = bias.astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        self.squares = {k: np.full(getattr(self, k).shape, EPS, np.float32) for k in self.NAMES}
        return self

    def _climb(self, name: str, rows: np.ndarray, gain: np.ndarray, rate: float) -> None:
        """An AdaGrad step for some rows."""
        squares = self.squares[name][rows] + gain * gain
        self.squares[name][rows] = squares
        getattr(self, name)[rows] += rate * gain / np.sqrt(squares)

    def train(self, target: np.ndarray, near: np.ndarray, far: np.ndarray, log_noise: np.ndarray, step: float, rng: np.random.Generator, batch: int = BATCH, noise: int = NOISE) -> None:
        """One pass of noise-contrastive estimation; each batch shares its noise words."""
        cumulative = np.cumsum(np.exp(log_noise.astype(np.float64)))
        shift = (log_noise + math.log(noise)).astype(np.float32)

        def added(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
            flat = (at[:, None] * self.dim + np.arange(self.dim)).ravel()
            return np.bincount(flat, weights=values.ravel(), minlength=n * self.dim).reshape(n, self.dim).astype(np.float32)

        for a in range(0, len(target), batch):
            w, n1, n2 = target[a : a + batch], near[a : a + batch], far[a : a + batch]
            m = len(w)
            other = np.minimum(np.searchsorted(cumulative, rng.random(noise) * cumulative[-1]), self.n - 1)
            rows, at = np.unique(np.concatenate([w, other]), return_inverse=True)
            q, bias = self.q[rows], self.b[rows] - shift[rows]
            r1, r2 = self.r[n1], self.r[n2]
            guess = r1 @ self.c1 + r2 @ self.c2
            qw, qo = q[at[:m]], q[at[m:]]
            good = np.einsum("ij,ij->i", guess, qw) + bias[at[:m]]
            bad = guess @ qo.T + bias[at[m:]]
            # ascent on log sigma(good) + sum log(1 - sigma(bad))
            with np.errstate(over="ignore"):  # 1 / (1 + inf) is 0
                up = 1.0 / (1.0 + np.exp(good))
                down = -1.0 / (1.0 + np.exp(-bad))
            d_guess = up[:, None] * qw + down @ qo
            near_rows, near_at = np.unique(np.concatenate([n1, n2]), return_inverse=True)
            gains = (
                ("q", rows, added(at, np.concatenate([up[:, None] * guess, down.T @ guess]), len(rows)), step),
                ("b", rows, np.bincount(at, weights=np.concatenate([up, down.sum(axis=0)]), minlength=len(rows)).astype(np.float32), step),
                ("r", near_rows, added(near_at, np.concatenate([d_guess @ self.c1.T, d_guess @ self.c2.T]), len(near_rows)), step),
                ("c1", slice(None), r1.T @ d_guess, step / 4),
                ("c2", slice(None), r2.T @ d_guess, step / 4),
            )
            for name, some, gain, rate in gains:
                self._climb(name, some, gain / m, rate)

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """What each context adds to the guess from either position."""
        return self.r @ self.c1, self.r @ self.c2

    def normalisers(self, rows: slice) -> np.ndarray:
        """Natural logarithms of the normalisers of some near contexts with all far ones, in batches of words."""
        g1, g2 = self.sides()
        g1 = g1[rows]
        cuts = [slice(a, a + WORDS_AT_ONCE) for a in range(0, self.n, WORDS_AT_ONCE)]
        m1 = np.max([(g1 @ self.q[c].T + self.b[c]).max(axis=1) for c in cuts], axis=0)
        m2 = np.max([(g2 @ self.q[c].T).max(axis=1) for c in cuts], axis=0)
        z = np.zeros((len(g1), len(g2)), np.float32)
        for c in cuts:
            z += np.exp(g1 @ self.q[c].T + self.b[c] - m1[:, None]) @ np.exp(g2 @ self.q[c].T - m2[:, None]).T
        return np.log(np.maximum(z, 1e-30)) + m1[:, None] + m2[None, :]

    def given(self, out: np.ndarray, near: np.ndarray, far: np.ndarray, z: np.ndarray) -> np.ndarray:
        """log10 probability of each output after its contexts."""
        g1, g2 = self.sides()
        each = np.empty(len(out))
        for a in range(0, len(out), 1 << 16):
            s = slice(a, a + (1 << 16))
            each[s] = np.einsum("ij,ij->i", g1[near[s]] + g2[far[s]], self.q[out[s]]) + self.b[out[s]] - z[near[s], far[s]]
        return each / math.log(10)


def contexts_of(contexts: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of the token before and the one before that, ``start`` ahead of a text."""
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    near, far = np.full(len(contexts), start), np.full(len(contexts), start)
    near[1:] = contexts[:-1]
    far[2:] = contexts[:-2]
    near[begin] = start
    far[begin] = start
    far[begin[lengths > 1] + 1] = start
    return near, far


def _learn(classed: DataFrame, known: Vocabulary, dim: int, rounds: int, step: float) -> np.ndarray:
    """The parameters after all rounds over the training text."""
    spark = classed.sparkSession
    log_noise, k = known.log_noise(), known.n_contexts
    flat = LogBilinear(known.size, k, dim, log_noise).flat()
    shards = max(1, round(math.sqrt(known.n) / SHARD_ROOT))
    dealt = classed.select("held", "lengths", "outputs", "block").repartition(shards, "block").sortWithinPartitions("block")
    for turn in range(rounds if known.n else 0):
        shared = spark.sparkContext.broadcast((flat, known, log_noise))

        def learn(parts: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            start, known, log_noise = shared.value
            own, used, first = LogBilinear(known.size, k, dim, log_noise).load(start), 0, None
            moved_context = known.context_of[known.moved]
            for part in parts:
                for i in range(part.num_rows):
                    block = part.column(3)[i].as_py()
                    first = block if first is None else first
                    out = _unpack(part.column(2)[i].as_py(), np.int32)
                    lengths = np.array(part.column(1)[i].as_py())
                    near, far = contexts_of(moved_context[out], lengths, k)
                    pick = np.repeat(~np.array(part.column(0)[i].as_py(), bool), lengths)
                    own.train(known.moved[out[pick]], near[pick], far[pick], log_noise, step * 0.5**turn, np.random.default_rng([turn, block]))
                    used += int(pick.sum())
            if used:
                new = own.flat()
                pieces = [new[a : a + PIECE] for a in range(0, len(new), PIECE)]
                for a in range(0, len(pieces), 128):
                    some = pieces[a : a + 128]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(range(a, a + len(some)), pa.int32()), pa.array([first] * len(some), pa.int64()), pa.array([float(used)] * len(some)), pa.array([_pack(x) for x in some], pa.binary())],
                        names=["piece", "shard", "used", "x"],
                    )

        def average(table: pa.Table) -> pa.Table:
            rows = sorted(zip(table.column("shard").to_pylist(), table.column("used").to_pylist(), table.column("x").to_pylist(), strict=True))
            total = sum(w * _unpack(x, np.float32).astype(np.float64) for _, w, x in rows) / sum(w for _, w, _ in rows)
            return pa.table({"piece": table.column("piece").slice(0, 1).cast(pa.int32()), "x": pa.array([_pack(total.astype(np.float32))], pa.binary())})

        learned = dealt.mapInArrow(learn, "piece int, shard long, used double, x binary").groupBy("piece").applyInArrow(average, "piece int, x binary")
        got = sorted((r["piece"], bytes(r["x"])) for r in learned.collect())  # as many numbers as the model has
        flat = np.concatenate([_unpack(x, np.float32) for _, x in got])
        shared.unpersist()
    return flat


def _normalisers(spark: SparkSession, model: LogBilinear, rows: int = 256) -> np.ndarray:
    """The table of normalisers, rows by several tasks; its size follows CONTEXTS, not the input."""
    n = model.contexts + 1
    shared = spark.sparkContext.broadcast(model)
    tasks = -(-n // rows)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in part.column(0).to_pylist():
                z = shared.value.normalisers(slice(i * rows, (i + 1) * rows)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([_pack(z)], pa.binary())], names=["i", "z"])

    got = sorted((r["i"], bytes(r["z"])) for r in spark.range(0, tasks, 1, tasks).mapInArrow(run, "i long, z binary").collect())
    return np.concatenate([_unpack(z, np.float32) for _, z in got]).reshape(n, n)


def fit(docs: DataFrame, growth: float = GROWTH, least: int = LEAST_COUNT, contexts: int = CONTEXTS, dim: int = DIMENSIONS, rounds: int = ROUNDS, step: float = STEP) -> tuple[Vocabulary, LogBilinear, np.ndarray, DataFrame]:
    """The vocabulary, the model, its normalisers, and the staged blocks of ``docs`` (doc_id, text)."""
    blocks = stage(_blocks(docs), "lm-blocks")
    terms, n = blocks.agg(F.coalesce(F.sum("n_terms"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    ranges = math.ceil(LEAST_RANGES * max(1.0, math.sqrt(terms / (LEAST_RANGES * RANGE_TERMS))))
    gathered = stage(_gather(blocks, ranges, least), "lm-counts")
    known = _vocabulary(gathered, n, growth, contexts)
    classed = stage(_classed(blocks, gathered, known), "lm-classed")
    discard(blocks)
    discard(gathered)
    model = LogBilinear(known.size, known.n_contexts, dim, known.log_noise()).load(_learn(classed, known, dim, rounds, step))
    return known, model, _normalisers(docs.sparkSession, model), classed


def score_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for ``docs`` (doc_id, text)."""
    known, model, z, classed = fit(docs, **options)
    n, start = known.n, known.n_contexts
    shared = docs.sparkSession.sparkContext.broadcast((known.context_of, model, z))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context_of, model, z = shared.value
        for part in parts:
            for i in range(part.num_rows):
                ids, held, lengths, seen, base, inner, out = (part.column(c)[i] for c in range(7))
                out = _unpack(out.as_py(), np.int32)
                lengths = np.array(lengths.as_py())
                given = np.zeros(len(lengths))
                if n:
                    near, far = contexts_of(context_of[out], lengths, start)
                    given = np.add.reduceat(model.given(out, near, far, z), np.concatenate([[0], np.cumsum(lengths)])[:-1])
                yield pa.RecordBatch.from_arrays(
                    [ids.values, held.values, pa.array(lengths, pa.int64()), seen.values, pa.array([n] * len(lengths), pa.int64()), base.values, pa.array(given + np.array(inner.as_py()))],
                    names=[x.split()[0] for x in schema.split(", ")],
                )

    return classed.select("doc_ids", "held", "lengths", "n_known", "base", "inner", "outputs").mapInArrow(score, schema)
