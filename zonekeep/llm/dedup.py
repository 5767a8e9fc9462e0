"""Near-duplicate classes by DartMinHash.

A text is the set of its shingles of five words, so that similarity is that of
sets: every weight is one, also of a shingle that repeats (``dart_signatures``
takes any weights).  For each shingle a Poisson
process of darts is drawn from its hash over (weight, rank): strips of weight
double in width, and in each strip darts come in order of rank.  Darts whose
weight lies under the shingle's weight and whose rank is under a limit fall on
the K coordinates of the signature, where the earliest dart stays.  The limit
is set so that about K log K + 2 K darts fall, however large the set, and is
doubled where a coordinate stays empty.  Two texts agree in a coordinate with
the probability of their (weighted) Jaccard similarity.

The signatures are joined by bands.  Texts with the same set are one node.
In each band bucket the members are compared with its smallest and its largest
node, never all with all, and every pair is verified by the exact Jaccard
similarity of the two shingle sets, held as 32-bit hashes of the shingles (of two
sets of n and m shingles n m / 2^32 are expected to match by chance: 2e-5 at
300, one in 200,000 of the shingles at 20,000).  A pair comes to that only if the
sizes and the slot parities of its sets allow the similarity, a bound that no similar
pair can break.  Buckets of up to three nodes are settled by that.  Nodes that stay
apart though they share a larger bucket are dealt anew: leaders drawn from the
bucket's still separate components are compared with its members for a few rounds.
What is apart then is settled exactly: over all nodes of the larger buckets that are
still apart, a prefix join finds every pair of two components that can be similar
enough, and each is verified.
Connected components of the links are the classes.

Defined results: a null text is an empty text; all texts without words are one
class; a text of fewer than five words has one shingle, all its words; rows
that repeat an id are rows of their own; equal texts are always in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekeep.llm.components import connected
from zonekeep.llm.words import batches, mix, shingle_hashes, text_buffer, word_hashes, word_spans
from zonekeep.store import discard, stage

#: Words of a shingle, and similarity of near duplicates.
WORDS, SIMILARITY = 5, 0.8
#: Bands and coordinates of a band: a pair of similarity 0.8 is missed with probability (1 - 0.8^6)^32 = 6e-5.
BANDS, ROWS = 32, 6
#: Rounds of leaders at most, before buckets that stay apart are settled by the prefix join.
ROUNDS = 5
#: Nodes of a bucket that its two leaders of the first round compare whole.
WHOLE = 3
_U = np.uint64
_STRIP, _DART = _U(0x9FB21C651E98DF25), _U(0xD6E8FEB86659FD93)


def dart_signatures(elements: np.ndarray, bounds: np.ndarray, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Signature (sets x k, uint64) of the weighted sets elements[bounds[i]:bounds[i + 1]]; zeros for an empty set.

    The upper half of a value is the dart's rank, the lower half its identity.
    """
    n = len(bounds) - 1
    size = np.diff(bounds)
    out = np.full(n * k, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), size)
    mass = size.astype(np.float64) if weights is None else np.bincount(owner, weights=weights, minlength=n)
    need = k * np.log(k) + 2 * k
    limit = np.where(mass > 0, need / np.maximum(mass, 1e-300), 0.0)
    done = mass <= 0
    low = np.zeros(n)  # darts below this rank have fallen already
    while not done.all():
        live = ~done[owner]
        _throw(elements[live], owner[live], None if weights is None else weights[live], low, limit, k, out)
        empty = (out.reshape(n, k) == np.iinfo(np.uint64).max).any(axis=1)
        done |= ~empty
        low, limit = limit.copy(), np.where(done, limit, 2 * limit)
    out = out.reshape(n, k)
    out[mass <= 0] = 0
    return out


def _throw(elements, owner, weights, low, limit, k, out) -> None:
    top = 1.0 if weights is None else float(weights.max(initial=1.0))
    strip, start = 0, 0.0
    while start < top:
        width = float(2**strip)
        reach = np.ones(len(elements), bool) if weights is None else weights > start
        seed, at = mix(elements[reach] + _U(int(_STRIP) * (strip + 1) % 2**64)), owner[reach]
        weight = None if weights is None else weights[reach]
        rank, dart = np.zeros(len(seed)), 0
        while len(seed):
            dart += 1
            draw = mix(seed + _U(int(_DART) * dart % 2**64))
            # gaps between ranks are exponential; 32 bits for the gap, the others say where the dart falls
            rank = rank - np.log(((draw >> _U(32)).astype(np.float64) + 0.5) / 2.0**32) / width
            inside = rank < limit[at]
            if not inside.all():
                seed, at, rank, draw = seed[inside], at[inside], rank[inside], draw[inside]
                weight = None if weight is None else weight[inside]
            place = mix(draw)
            fresh = rank >= low[at]
            if weight is not None:
                fresh &= start + width * ((place >> _U(40)).astype(np.float64) / 2.0**24) < weight
            slot = at * k + (place & _U(0xFFFFF)).astype(np.int64) % k
            value = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32) | draw & _U(0xFFFFFFFF)
            np.minimum.at(out, slot[fresh], value[fresh])
        start += width
        strip += 1


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band, from the identities of its darts."""
    darts = (signatures & _U(0xFFFFFFFF)).reshape(len(signatures), bands, rows)
    key = np.zeros(darts.shape[:2], np.uint64)
    for r in range(rows):
        key = mix(key * _U(0x100000001B3) + darts[:, :, r] + _U(r + 1))
    return mix(key + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _STRIP)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their bounds."""
    data, offs = text_buffer(texts)
    starts, ends, bounds = word_spans(data, offs)
    shingles, at = shingle_hashes(word_hashes(data, starts, ends), bounds, words)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    fresh = np.ones(len(shingles), bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[fresh], owner[fresh]
    return shingles, np.searchsorted(owner, np.arange(len(at)))


def _nodes(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number for each set: equal sets have equal numbers."""
    total = np.concatenate([[_U(0)], np.cumsum(mix(shingles ^ _STRIP), dtype=np.uint64)])
    return mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * _DART).view(np.int64)


def signed(docs: DataFrame, bands: int, rows: int, words: int) -> DataFrame:
    """doc_id, row_key, node, keys (array of long, one for each band) and shingles (binary, four bytes each) of every text."""
    names = ["doc_id", "row_key", "node", "keys", "shingles"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for begin, end in batches(part.column(2), 1 << 20):
                shingles, at = shingle_sets(part.column(2).slice(begin, end - begin), words)
                keys = band_keys(dart_signatures(shingles, at, bands * rows), bands, rows).view(np.int64)
                small = (shingles >> _U(32)).astype(np.uint32)
                held = [small[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                offsets = np.arange(0, (end - begin + 1) * bands, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(begin, end - begin), part.column(1).slice(begin, end - begin), pa.array(_nodes(shingles, at)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())), pa.array(held, pa.binary())],
                    names=names,
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), "text").mapInArrow(run, "doc_id long, row_key long, node long, keys array<long>, shingles binary")


def parity_bits(tokens: np.ndarray) -> bytes:
    """How often each slot is hit by ``tokens``, modulo two: at least two slots a token, in a power of two of whole bytes."""
    slots = 1 << max(6, int(2 * len(tokens) - 1).bit_length())
    hits = np.bincount(mix(tokens.astype(np.uint64)).astype(np.int64) & (slots - 1), minlength=slots)
    return np.packbits((hits & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(p: bytes, q: bytes) -> int:
    """A lower bound of the number of tokens that only one of two sets holds, from their parity bits."""
    x, y = sorted((np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)), key=len)
    # slots are numbered by the low bits, so the larger table folds onto the smaller
    folded = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ folded).sum())


def _outlined(sets: DataFrame) -> DataFrame:
    """node, size and parity of each set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held = [np.frombuffer(s.as_buffer(), np.uint32) for s in part.column(1)]
            columns = [part.column(0), pa.array([len(s) for s in held], pa.int32()), pa.array([parity_bits(s) for s in held], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "parity"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, size int, parity binary")


def _possible(pairs: DataFrame, outlines: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) without those whose sizes or parities alone show that they differ too much: their sets need not be moved."""
    side = lambda node, size, parity: outlines.select(F.col("node").alias(node), F.col("size").alias(size), F.col("parity").alias(parity))
    both = pairs.join(side("a", "n", "p"), "a").join(side("b", "m", "q"), "b").filter(f"least(n, m) >= greatest(n, m) * {similarity!r}D - 1e-6")
    share = (1 - similarity) / (1 + similarity)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            a, b, n, m, p, q = part.columns
            most = share * (n.to_numpy().astype(np.int64) + m.to_numpy()) + 1e-6
            least = np.array([least_difference(x, y) for x, y in zip(p.to_pylist(), q.to_pylist(), strict=True)], np.int64)
            keep = pa.array(least <= most)
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    return both.select("a", "b", "n", "m", "p", "q").mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; each side's sets come by a join on its node."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("t")), "b").select("a", "b", "s", "t")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = np.zeros(part.num_rows, bool)
            for i in range(part.num_rows):
                s, t = np.frombuffer(part.column(2)[i].as_buffer(), np.uint32), np.frombuffer(part.column(3)[i].as_buffer(), np.uint32)
                if min(len(s), len(t)) < similarity * max(len(s), len(t)):
                    continue
                both = np.sort(np.concatenate([s, t]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = common >= similarity * (len(s) + len(t) - common) - 1e-9
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in part.columns[:2]], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _remaining(held: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of different roots in ``held`` (node, root, shingles) that can be similar enough, by an exact prefix join.

    Shingles are ordered by how many sets hold them, those of one root only first.  Two
    sets that are similar enough have their first common shingle so early in both
    that the rest can still hold the overlap; the smaller set needs the shorter prefix.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for begin in range(0, part.num_rows, 64):
                piece = part.slice(begin, 64)
                sets = [np.unique(np.frombuffer(s, np.uint32)) for s in piece.column(1).to_pylist()]
                at = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([piece.column(0).take(at), pa.array(np.concatenate(sets).view(np.int32))], names=["node", "token"])

    exploded = lambda df, key: df.select(key, "shingles").mapInArrow(run, "node long, token int")
    # a token of one root only is never common to a pair, and where it stands among its like does not matter
    common = exploded(held, "root").groupBy(F.col("token")).agg(F.count("*").alias("n"), F.min("node").alias("x"), F.max("node").alias("y")).filter("x <> y").select("token", "n")
    placed = exploded(held, "node").join(common, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("held"))
    placed = placed.join(held.select("node", "root", (F.octet_length("shingles") / 4).cast("int").alias("size")), "node")
    placed = placed.withColumn("own", F.col("size") - F.size("held"))
    # a little below the asked similarity, as shingles of one set may share a token
    similarity -= 1e-3
    reach = F.expr(f"size - cast(ceil(size * {similarity!r}D - 1e-6) as int) + 1 - own")
    prefix = placed.select("node", "root", "size", "own", F.posexplode(F.slice("held", 1, F.greatest(reach, F.lit(0)))).alias("p", "h"))
    prefix = stage(prefix.select("node", "root", "size", (F.col("own") + F.col("p")).alias("place"), F.col("h.token").alias("token")), "dedup-prefix")
    # the root with most sets of a token is not met with itself: pairs are 0 other x main, 1 other x other, 2 main x other
    main = _rescan(prefix).groupBy("token", "root").agg(F.count("*").alias("n")).groupBy("token").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1").select("token", "main")
    prefix = stage(prefix.join(main, "token"), "dedup-meeting-prefix")
    share = 2 * similarity / (1 + similarity)
    side = lambda df, names, met: df.select("token", F.explode(met).alias("met"), *[F.col(c).alias(n) for c, n in zip(("node", "root", "size", "place"), names, strict=True)])
    small = side(prefix.filter(f"place <= size - ceil(size * {share!r}D - 1e-6)"), ("a", "a_root", "a_size", "i"), F.expr("if(root = main, array(2), array(0, 1))"))
    large = side(_rescan(prefix), ("b", "b_root", "b_size", "j"), F.expr("if(root = main, array(0), array(1, 2))"))
    fits = f"a_root <> b_root and a_size <= b_size and a_size >= b_size * {similarity!r}D - 1e-6 and least(a_size - i, b_size - j) >= (a_size + b_size) * {share / 2!r}D - 1e-6"
    pairs = small.join(large, ["token", "met"]).filter(fits)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classify(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """doc_id, row_key, root for ``docs`` (doc_id, text), a row for each row, as a staged table.

    root numbers the class, and row_key is xxhash64(doc_id, text).
    """
    used: list[DataFrame] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        used.append(stage(df, label))
        return used[-1]

    full = keep(signed(docs, bands, rows, words), "dedup-signed")
    nodes = keep(full.select("doc_id", "row_key", "node"), "dedup-nodes")
    # exact copies are one node from here on
    banded = full.groupBy("node").agg(F.first("keys").alias("keys")).select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")).filter("low <> high")
    buckets = keep(banded.join(shared.select("key", "n"), "key").select("key", "node", "n"), "dedup-buckets")
    # how many others a node meets in its buckets; the texts that a group was made from meet most
    meeting = keep(buckets.groupBy("node").agg(F.sum("n").alias("degree")), "dedup-meeting")
    sets = full.select("node", "shingles").join(meeting.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))
    sets = keep(sets, "dedup-sets")
    discard(full)
    outlines = keep(_outlined(sets), "dedup-outlines")

    tried = None
    roots = keep(meeting.select("node", "degree", F.col("node").alias("root")), "dedup-roots")
    for turn in range(ROUNDS + 1):
        # a bucket of up to three nodes is compared whole by its two leaders
        member = (buckets.filter(f"n > {WHOLE}") if turn else buckets).select("key", "node", "n").join(roots, "node")
        if turn:  # only buckets whose members are still apart
            apart = member.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
            member = keep(member.join(apart, "key", "left_semi"), "dedup-apart")
            if member.isEmpty():
                break
            member = _rescan(member)
        if turn == ROUNDS:  # all pairs that are left
            held = keep(sets.join(member.select("node", "root").distinct(), "node"), "dedup-held")
            pairs = _remaining(held, similarity)
        else:
            if turn:  # a member, and a component (few stragglers beside a large component are drawn as soon as it), by hash
                draws = [F.xxhash64("node", F.lit(turn)), F.xxhash64("root", F.lit(turn))]
            else:  # the member that meets most others, and any other; two that differ where they settle the bucket
                whole = F.col("n") <= WHOLE
                draws = [F.when(whole, F.col("node")).otherwise(-F.col("degree")), F.when(whole, F.bitwise_not("node")).otherwise(F.xxhash64("node"))]
            leaders = member.groupBy("key").agg(*[F.min_by(c, r).alias(f"{c}{j}") for j, r in enumerate(draws) for c in ("node", "root")])
            heads = F.array_distinct(F.array(*[F.struct(F.col(f"node{j}").alias("b"), F.col(f"root{j}").alias("b_root")) for j in range(len(draws))]))
            # staged, so that a bucket of many members can be split in the join
            pairs = member.join(keep(leaders, "dedup-leaders"), "key").select("node", "root", F.explode(heads).alias("h"))
            pairs = pairs.filter("root <> h.b_root").select(F.least("node", "h.b").alias("a"), F.greatest("node", "h.b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = keep(pairs, "dedup-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        near = keep(_possible(pairs, outlines, similarity), "dedup-possible")
        links = keep(_verify(near, sets, similarity), "dedup-links")
        old = _rescan(roots)
        edges = links.join(roots.drop("degree").withColumnRenamed("node", "a").withColumnRenamed("root", "x"), "a").join(old.drop("degree").withColumnRenamed("node", "b").withColumnRenamed("root", "y"), "b")
        edges = keep(edges.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "dedup-edges")
        if edges.isEmpty():
            continue
        merged = connected(edges, "dedup").select(F.col("node").alias("root"), F.col("root").alias("new"))
        roots = keep(_rescan(roots).join(merged, "root", "left").select("node", "degree", F.coalesce("new", "root").alias("root")), "dedup-roots")
    classed = nodes.join(roots.drop("degree"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    classed = stage(classed.select("doc_id", "row_key", "root"), "dedup-classed")
    for table in used:
        discard(table)
    return classed


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id for ``docs`` (doc_id, text), a row for each row; class_id is the smallest doc_id of the class."""
    classed = classify(docs, **options)
    # staged, so that both sides of the join are plain exchanges and a class of many rows can be split
    names = stage(_rescan(classed).groupBy("root").agg(F.min("doc_id").alias("class_id")), "dedup-names")
    return classed.join(names, "root").select("doc_id", "class_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one row of each class of near duplicates: that of the smallest doc_id, then of the smallest row_key."""
    classed = classify(docs, **options)
    first = F.min(F.struct("doc_id", "row_key")).alias("first")
    stay = stage(classed.groupBy("root").agg(first).select(F.col("first.row_key").alias("__row_key")), "dedup-stay")
    keyed = docs.withColumn("__row_key", F.xxhash64("doc_id", "text"))
    if not _rescan(classed).groupBy("row_key").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        # rows that repeat an id and text are one row, brought together before they are moved
        keyed = keyed.groupBy("__row_key").agg(*[F.first(c).alias(c) for c in docs.columns])
    return keyed.join(stay, "__row_key", "left_semi").select(*docs.columns)


def _rescan(staged: DataFrame) -> DataFrame:
    """A scan of its own of a staged table, for plans in which it meets itself."""
    out = staged.sparkSession.read.schema(staged.schema).parquet(staged._staged_at)
    out._staged_at = staged._staged_at
    return out
