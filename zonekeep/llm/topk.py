"""Exact top-k inner products by a dual-tree search over cover trees.

Rows are dealt into blocks by their nearest centre, of a bounded sample of
rows; a block knows its centre and covering radius.  Each query first searches
its own block, which gives it a kth score to start from; then it goes to the
blocks only whose bound can reach that score.  In a block the queries that have
come and its rows are indexed by a cover tree each, and the search descends
both trees together: a pair of nodes is pruned when its bound,

    <q, p> + |q| r_p + |p| r_q + r_q r_p,

with centres q, p and covering radii r_q, r_p, is below the worst kth score of
the queries under the query node.  Pairs of leaves are one matrix product.

The cover trees are simplified ones: a node at level i covers its points within
BASE^i of its centre, its children are at level i - 1 or lower, their centres
are more than BASE^(i-1) apart, and the first of them has the node's own centre.
A node whose points do not gather (its children would be more than twice the
root of their number) stays a leaf, so building takes n^1.5 distances at most.

Defined results: a vector that is null or holds a null or non-finite component
takes no part; vectors are compared with vectors of their own length only;
rows with the query's id are its own rows; a repeated row is a candidate for
each time it stands in the table; a null id ranks after all others on ties; a
repeated query row is answered once.  No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonekeep.store import stage

#: Rows and queries up to which a node stays a leaf, and the ratio of the radii of two levels.
LEAF, ASKED_LEAF, BASE = 32, 6, 1.3
#: Rows of a block at least and at most, queries that search a block together, and centres at most.
BLOCK_LEAST, BLOCK_MOST, GROUP, CENTRES = 512, 65_536, 16_384, 1_024
_NULL_ID = np.iinfo(np.int64).max
#: Products from here on are not exact as 64-bit floats.
_WIDE = 2.0**53


class CoverTree:
    """A node over some rows of a matrix: its centre, its level, how far its rows reach, and its children, none for a leaf."""

    __slots__ = ("centre", "centres", "children", "level", "radii", "radius", "rows")

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: int, apart: np.ndarray | None = None, leaf: int = LEAF):
        if apart is None:
            apart = _distances(points, rows, centre)
        self.rows, self.centre = rows, centre
        self.radius = float(apart.max(initial=0.0))
        self.level = math.ceil(math.log(self.radius, BASE) - 1e-9) if self.radius else None
        self.children: list[CoverTree] = []
        if len(rows) <= leaf or not self.radius:
            return
        reach, most = BASE ** (self.level - 1), 2 * math.isqrt(len(rows))
        parts, left, head = [], rows, centre
        while len(left):
            if len(parts) == most:
                return
            away = apart if head == centre else _distances(points, left, head)
            near = away <= reach
            parts.append((left[near], head, away[near]))
            left, apart = left[~near], apart[~near]
            head = int(left[0]) if len(left) else centre
        self.children = [CoverTree(points, *part, leaf) for part in parts]
        self.centres = np.array([c.centre for c in self.children])
        self.radii = np.array([c.radius for c in self.children])


def _distances(points: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
    apart = points[rows] - points[centre]
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


class _Best:
    """Running best k of a set of queries, by score and then id."""

    def __init__(self, k: int, n: int, floors: np.ndarray):
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), _NULL_ID)
        self.floors = floors

    def worst(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.scores[rows, -1], self.floors[rows]).min())

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (queries x candidates) for candidates with the given ids."""
        limit = np.maximum(self.scores[rows, -1], self.floors[rows])
        open_ = scores >= limit[:, None]
        asking = open_.any(axis=1)
        if not asking.any():
            return
        rows, scores, open_ = rows[asking], scores[asking], open_[asking]
        some = open_.any(axis=0)
        scores, ids = np.where(open_[:, some], scores[:, some], -np.inf), ids[some]
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        all_ids = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=-1)[:, : self.scores.shape[1]]
        self.scores[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(all_ids, order, axis=1)


class Search:
    """The rows of one block under a cover tree; ``scored`` counts the pairs whose score was computed."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, times: np.ndarray, k: int):
        # equal vectors are one point of the tree; of their rows only the k + 1 smallest ids can be among the best
        order = np.lexsort((ids, *points.T[::-1]))
        points, ids, times = points[order], ids[order], times[order]
        fresh = np.concatenate([[True], (points[1:] != points[:-1]).any(axis=1)])
        point_of = np.cumsum(fresh) - 1
        self.points = np.ascontiguousarray(points[fresh], dtype=np.float64)
        keep = np.arange(len(ids)) - np.flatnonzero(fresh)[point_of] <= k
        self.ids, held = np.repeat(ids[keep], np.minimum(times[keep], k)), np.repeat(point_of[keep], np.minimum(times[keep], k))
        self.first = np.searchsorted(held, np.arange(len(self.points) + 1))
        self.norms = np.sqrt((self.points * self.points).sum(axis=1))
        self.tree = CoverTree(self.points, np.arange(len(self.points)), 0)
        self.k, self.scored = k, 0

    def best(self, queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best for each query that reach its floor, -inf where there are fewer."""
        self.q = np.ascontiguousarray(queries, dtype=np.float64)
        self.q_norms, self.query_ids = np.sqrt((self.q * self.q).sum(axis=1)), query_ids
        self.found = _Best(self.k, len(self.q), floors)
        pairs = [(CoverTree(self.q, np.arange(len(self.q)), 0, leaf=ASKED_LEAF), self.tree)]
        while pairs:  # the last one pushed is the most promising
            asked, held = pairs.pop()
            if self._bound(asked, np.array([held.centre]), np.array([held.radius]))[0] < self.found.worst(asked.rows):
                continue
            if not asked.children and not held.children:
                self._score(asked, held.rows)
            elif not held.children or asked.children and asked.radius > held.radius:
                pairs += [(child, held) for child in asked.children]
            else:
                limits = self._bound(asked, held.centres, held.radii)
                least = self.found.worst(asked.rows)
                pairs += [(asked, held.children[i]) for i in np.argsort(limits, kind="stable") if limits[i] >= least]
        return self.found.scores, self.found.ids

    def _bound(self, asked: CoverTree, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
        out = self.points[centres] @ self.q[asked.centre] + self.q_norms[asked.centre] * radii + self.norms[centres] * asked.radius + asked.radius * radii
        return out + 1e-9 * (np.abs(out) + 1.0)

    def _score(self, asked: CoverTree, rows: np.ndarray) -> None:
        limits = self._bound(asked, rows, np.zeros(len(rows)))
        order = np.argsort(-limits, kind="stable")
        for a in range(0, len(order), 512):
            at = order[a : a + 512]
            at = at[limits[at] >= self.found.worst(asked.rows)]
            if not len(at):
                return
            at = rows[at]
            n = self.first[at + 1] - self.first[at]
            own = self.ids[np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            scores = np.repeat(self.q[asked.rows] @ self.points[at].T, n, axis=1)
            scores[self.query_ids[asked.rows][:, None] == own[None, :]] = -np.inf
            self.scored += len(asked.rows) * len(at)
            self.found.offer(asked.rows, scores, own)


def search_block(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, points: np.ndarray, ids: np.ndarray, times: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query row, id, score) of the k best of a block for each query that reach the query's floor."""
    if not len(queries) or not len(points):
        return []
    top = max(float(np.abs(queries).max(initial=0)), 1.0) * max(float(np.abs(points).max(initial=0)), 1.0) * max(points.shape[1], 1)
    if top >= _WIDE:
        return _search_wide(queries, query_ids, floors, points, ids, times, k)
    scores, found = Search(points, ids, times, k).best(queries, query_ids, floors)
    rows, ranks = np.nonzero(np.isfinite(scores))
    return list(zip(rows.tolist(), found[rows, ranks].tolist(), [int(s) for s in scores[rows, ranks]], strict=True))


def _search_wide(queries, query_ids, floors, points, ids, times, k):
    """Components too large for exact 64-bit floats: whole-number arithmetic, every pair of the block."""
    out, low, high = [], -(2**63), 2**63 - 1
    wide = points.astype(object)
    for row, vector in enumerate(queries.astype(object)):
        scores = [max(low, min(high, int(s))) for s in (wide @ vector if wide.shape[1] else [0] * len(wide))]
        best = sorted((-s, i) for s, i, n in zip(scores, ids.tolist(), times.tolist(), strict=True) for _ in range(min(n, k)) if i != query_ids[row] and s >= floors[row])[:k]
        out += [(row, i, -s) for s, i in best]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), np.int64)


def whole_numbers(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of each component; null where a component is null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _by_length(v: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths of the vectors of a column, and the rows of each length."""
    sizes = np.diff(np.asarray(v.offsets))
    for dim in np.unique(sizes).tolist():
        yield dim, np.flatnonzero(sizes == dim)


def _nearest(centres: dict[int, np.ndarray]):
    """Adds block (number of the nearest centre of the row's length, -1 where there is none) and away (its distance)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            v = part.column(part.schema.get_field_index("v"))
            block, away = np.full(part.num_rows, -1), np.full(part.num_rows, np.inf)
            for dim, rows in _by_length(v):
                if dim in centres:
                    own = _matrix(v.take(pa.array(rows))).astype(np.float64)
                    mid = centres[dim].astype(np.float64)
                    near = (np.einsum("ij,ij->i", mid, mid)[None, :] - 2 * own @ mid.T).argmin(axis=1)
                    block[rows] = near
                    apart = own - mid[near]
                    away[rows] = np.sqrt(np.einsum("ij,ij->i", apart, apart)) * (1 + 1e-9)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(block, pa.int64()), pa.array(away)], names=[*part.schema.names, "block", "away"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block_least: int = BLOCK_LEAST, block_most: int = BLOCK_MOST, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score of ``vectors`` (vec_id, v: array of long): each query's k best among all other rows."""
    spark = vectors.sparkSession
    distinct = vectors.filter("v is not null").groupBy("vec_id", "v").agg(F.count("*").alias("times"))
    distinct = stage(distinct.withColumn("query", F.coalesce(is_query, F.lit(False))).withColumn("dim", F.size("v")), "topk-distinct")
    n = distinct.count()
    size = max(block_least, min(block_most, n // 96))
    sample = distinct.orderBy(F.xxhash64("v", F.lit(7)), F.xxhash64("vec_id")).limit(min(CENTRES, max(1, n // size))).select("dim", "v").collect()
    centres = {dim: np.array(sorted({tuple(r["v"]) for r in sample if r["dim"] == dim}), np.int64) for dim in {r["dim"] for r in sample}}
    rows = stage(distinct.mapInArrow(_nearest(centres), f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in distinct.schema.fields)}, block long, away double"), "topk-rows")
    queries = _again(rows).filter("query").select("dim", "block", "vec_id", "v", F.xxhash64("v").alias("query_key"))
    # a block is a row for each centre; one of more rows than a task should take is dealt into parts by hash, which share centre and radius
    blocks = rows.groupBy("dim", "block").agg(F.count("*").alias("n"), F.count_if("query").alias("asked"), F.max("away").alias("radius")).collect()
    parts = spark.createDataFrame([(b["dim"], b["block"], -(-b["n"] // (2 * size))) for b in blocks], "dim int, block long, parts long")
    asking = -(-sum(b["asked"] for b in blocks) // group)  # a task takes ``group`` queries on average, whatever comes to its block
    reach = {dim: [(b["block"], b["radius"]) for b in blocks if b["dim"] == dim] for dim in {b["dim"] for b in blocks}}
    data = rows.select("dim", "block", "vec_id", "v", "times").join(F.broadcast(parts), ["dim", "block"])
    data = data.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), "parts")).drop("parts")
    keys = ["dim", "block", "part", "grp"]

    def found_in(asked: DataFrame, n_groups: int) -> DataFrame:
        """The best of each query (dim, block: where it searches, vec_id, v, query_key, floor) in that block."""
        left = asked.join(F.broadcast(parts), ["dim", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        left = left.withColumn("grp", F.pmod(F.xxhash64("query_key", "vec_id"), F.lit(n_groups)))
        right = data.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))))

        def match(asked_part: pa.Table, data_part: pa.Table) -> pa.Table:
            ids = lambda t: t.column("vec_id").fill_null(_NULL_ID).to_numpy()
            floors = asked_part.column("floor").fill_null(float("-inf")).to_numpy().astype(np.float64)
            found = search_block(_matrix(asked_part.column("v")), ids(asked_part), floors, _matrix(data_part.column("v")), ids(data_part), data_part.column("times").to_numpy(), k)
            own, key = ids(asked_part), asked_part.column("query_key").to_numpy()
            return pa.table({
                "query_id": pa.array([int(own[r]) for r, _, _ in found], pa.int64()),
                "vec_id": pa.array([None if i == _NULL_ID else i for _, i, _ in found], pa.int64()),
                "score": pa.array([s for _, _, s in found], pa.int64()),
                "query_key": pa.array([int(key[r]) for r, _, _ in found], pa.int64()),
            })

        left = left.select(*keys, "vec_id", "v", "floor", "query_key").groupBy(*keys)
        right = right.select(*keys, "vec_id", "v", "times").groupBy(*keys)
        return left.cogroup(right).applyInArrow(match, "query_id long, vec_id long, score long, query_key long")

    def routed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each other block whose bound reaches the query's kth score."""
        for part in parts:
            home, floor = part.column("block").to_numpy(), part.column("floor").fill_null(float("-inf")).to_numpy()
            for dim, at in _by_length(part.column("v")):
                own = _matrix(part.column("v").take(pa.array(at))).astype(np.float64)
                norm = np.sqrt(np.einsum("ij,ij->i", own, own))
                for block, radius in reach[dim]:
                    if block < 0:
                        goes = np.ones(len(at), bool)
                    else:
                        mid = centres[dim][block].astype(np.float64)
                        bound = own @ mid + norm * radius
                        largest = np.abs(own).max(axis=1, initial=1.0) * (np.abs(mid).max(initial=1.0) + radius) * max(dim, 1)
                        goes = (bound + 1e-9 * (np.abs(bound) + 1.0) >= floor[at]) | (largest >= _WIDE)
                    some = at[goes & (home[at] != block)]
                    if len(some):
                        out = part.take(pa.array(some))
                        yield out.set_column(out.schema.get_field_index("block"), "block", pa.array(np.full(len(some), block), pa.int64()))

    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    first = found_in(queries.withColumn("floor", F.lit(None).cast("double")), max(1, asking // max(1, len(blocks))))
    first = stage(first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank"), "topk-first")
    floors = _again(first).groupBy("query_id", "query_key").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    asked = queries.join(floors.withColumn("vec_id", F.when(F.col("query_id") != _NULL_ID, F.col("query_id"))).drop("query_id"), ["vec_id", "query_key"], "left")
    asked = asked.select("dim", "block", "vec_id", "v", "query_key", "floor")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema.fields)
    others = found_in(asked.mapInArrow(routed, schema), max(1, asking))
    ranked = first.unionByName(others).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _again(staged: DataFrame) -> DataFrame:
    """A scan of its own of a staged table, for plans in which it meets itself."""
    out = staged.sparkSession.read.schema(staged.schema).parquet(staged._staged_at)
    out._staged_at = staged._staged_at
    return out
