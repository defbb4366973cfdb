"""Exact top-k inner products by best-first search in M-trees (operator 7).

Method. Vectors become integers, floor(256 * x). With M the largest norm of a
shard and one more component sqrt(M^2 - |x|^2) (0 for the query), the Euclidean
distance falls exactly as the inner product rises, so the search is one for
nearest neighbours in a metric space. Every shard of at most ``SHARD`` vectors,
where it is read, gets an M-tree: pages of at most ``PAGE`` entries, each node
with a routing vector, its covering radius and its distance to the parent's
routing vector, each entry with its distance to its page's. A query's search
visits nodes by their least possible distance and stops when that exceeds the
k-th best found; nodes and entries whose stored distances already rule them out
by the triangle inequality are skipped without computing theirs. Scores of what
is left are integer products, compared exactly; equal scores go to the smaller
vec_id. The best k of each shard meet in a ranking per query.

Queries are sent to the shards in blocks of ``BLOCK`` vectors.

Defined cases: null vectors and vectors with a null or non-finite component
take no part. Components that a shorter vector lacks count as 0. Rows are told
apart even where vec_id repeats; a null vec_id is a candidate, after all others
of its score, and never a query. Extra columns are ignored. Scores are exact
while sums of products stay below 2 ** 63.
"""

from __future__ import annotations

import heapq
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import sequence_number
from ..session import materialize
from ._ship import ready

TOP = 5
SCALE = 256
SHARD = 16_384
PAGE = 256
FANOUT = 12
BLOCK = 4096
_LAST = np.iinfo(np.int64).max
_SLACK = 1e-6  # relative; bounds are in floating point, scores are not


class MTree:
    """An M-tree over integer vectors; nodes are held in arrays."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        x = rows.astype(np.float64)
        norm = (x * x).sum(1)
        self.top = float(norm.max(initial=0.0))
        self.x = np.column_stack([x, np.sqrt(np.maximum(self.top - norm, 0))])
        self.route: list[np.ndarray] = []  # routing vectors
        self.radius: list[float] = []
        self.up: list[float] = []  # distance to the parent's routing vector
        self.kids: list[np.ndarray] = []
        self.page: list[tuple[np.ndarray, np.ndarray] | None] = []  # entries, ascending distances to the routing vector
        rng = np.random.default_rng(5)
        if len(x):
            self._build(np.arange(len(x)), self.x.mean(0), 0.0, rng)

    def _build(self, at: np.ndarray, center: np.ndarray, up: float, rng) -> int:
        node = len(self.route)
        away = np.sqrt(((self.x[at] - center) ** 2).sum(1))
        self.route.append(center)
        self.radius.append(float(away.max()))
        self.up.append(up)
        self.kids.append(np.zeros(0, np.int64))
        self.page.append(None)
        if len(at) <= PAGE or self.radius[node] == 0:
            order = np.argsort(away)
            self.page[node] = (at[order], away[order])
            return node
        seeds = [int(rng.integers(len(at)))]  # routing vectors far from each other
        near = np.sqrt(((self.x[at] - self.x[at[seeds[0]]]) ** 2).sum(1))
        mine = np.zeros(len(at), np.int64)
        while len(seeds) < FANOUT and near.max() > 0:
            seeds.append(int(near.argmax()))
            d = np.sqrt(((self.x[at] - self.x[at[seeds[-1]]]) ** 2).sum(1))
            mine[d < near] = len(seeds) - 1
            near = np.minimum(near, d)
        kids = []
        for k, s in enumerate(seeds):
            part = at[mine == k]
            if len(part):
                route = self.x[at[s]]
                kids.append(self._build(part, route, float(np.sqrt(((route - center) ** 2).sum())), rng))
        self.kids[node] = np.array(kids, np.int64)
        return node

    def seal(self) -> "MTree":
        """Lay the rows out page by page, so that a page's are one slice. Sums
        of products below 2 ** 53 are exact in floating point, which multiplies
        faster."""
        self.route_, self.radius_, self.up_ = np.array(self.route), np.array(self.radius), np.array(self.up)
        order = [p[0] for p in self.page if p is not None]
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        head, pages = 0, []
        for p in self.page:
            pages.append(None if p is None else (head, p[1]))
            head += 0 if p is None else len(p[0])
        self.page = pages
        self.rows, self.ids = self.rows[self.order], self.ids[self.order]
        self.exact = self.top < 2.0 ** 53
        if self.exact:
            self.rows = self.rows.astype(np.float64)
        return self

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """Best k (score, row) of the rows but ``own``, best first."""
        if not len(self.rows):
            return []
        q = query.astype(np.float64)
        square = float(q @ q)
        wanted = q if self.exact and square < 2.0 ** 53 else query
        rows = self.rows if wanted is q or not self.exact else self.rows.astype(np.int64)
        q = np.append(q, 0.0)
        best: list[tuple[int, int, int]] = []  # heap of (score, -id, row): the worst first
        slack = _SLACK * np.sqrt(square + self.top + 1)

        def bound() -> float:
            if len(best) < k:
                return np.inf
            return float(np.sqrt(max(square + self.top - 2.0 * best[0][0], 0.0))) + slack

        d0 = float(np.sqrt(((self.route_[0] - q) ** 2).sum()))
        queue = [(max(d0 - self.radius_[0], 0.0), 0, d0)]
        while queue:
            least, node, d = heapq.heappop(queue)
            limit = bound()
            if least > limit:
                break
            if self.page[node] is None:
                kids = self.kids[node]
                kids = kids[np.abs(d - self.up_[kids]) - self.radius_[kids] <= limit]
                if len(kids):
                    far = np.sqrt(((self.route_[kids] - q) ** 2).sum(1))
                    low = np.maximum(far - self.radius_[kids], 0.0)
                    for low_, kid, far_ in zip(low, kids, far):
                        if low_ <= limit:
                            heapq.heappush(queue, (float(low_), int(kid), float(far_)))
                continue
            head, away = self.page[node]
            lo, hi = (0, len(away)) if limit == np.inf else np.searchsorted(away, (d - limit, d + limit))
            hi = min(hi + 1, len(away))  # an entry at the limit itself may tie
            if lo >= hi:
                continue
            score = rows[head + lo:head + hi] @ wanted
            if len(best) == k:
                at = np.flatnonzero(score >= best[0][0])
            else:
                at = np.arange(len(score))
            if len(at) > k:  # no more than the best k of a page (and the query itself), ids deciding ties
                at = at[np.lexsort((self.ids[head + lo + at], -score[at]))[:k + 1]]
            for s, i in zip(score[at].tolist(), (head + lo + at).tolist()):
                if self.order[i] == own:
                    continue
                entry = (int(s), -int(self.ids[i]), int(self.order[i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry[:2] > best[0][:2]:
                    heapq.heapreplace(best, entry)
        return [(s, i) for s, _, i in sorted(best, key=lambda e: (-e[0], -e[1]))]


def _widen(x: np.ndarray, n: int) -> np.ndarray:
    return x if x.shape[1] >= n else np.pad(x, ((0, 0), (0, n - x.shape[1])))


def _matrix(cells: list[bytes]) -> np.ndarray:
    rows = [np.frombuffer(c, np.int64) for c in cells]
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, cells = [], []
        for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not v.is_valid or v.values.null_count:
                continue
            x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
            if np.isfinite(x).all():
                ids.append(vec_id)
                cells.append(np.floor(SCALE * x).astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cells, pa.binary())], ["vec_id", "v"])


def _search(block, k: int):
    def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        uid, vec_id = (np.concatenate([p.column(c).fill_null(_LAST).to_numpy(zero_copy_only=False) for p in parts]) for c in (0, 1))
        rows = _matrix([x for p in parts for x in p.column(2).to_pylist()])
        q_uid, q_rows = block.value
        width = max(rows.shape[1], q_rows.shape[1])
        tree = MTree(_widen(rows, width), vec_id).seal()
        where = {int(u): i for i, u in enumerate(uid)}
        out: list[tuple[int, int, int]] = []
        for u, q in zip(q_uid.tolist(), _widen(q_rows, width)):
            out += [(u, i, s) for s, i in tree.search(q, where.get(u, -1), k)]
        at = [r[1] for r in out]
        ids = pa.array(vec_id[at], mask=vec_id[at] == _LAST) if at else pa.array([], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), ids,
                                           pa.array([r[2] for r in out], pa.int64())], ["query", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, SHARD):
                parts.append(batch.slice(a, SHARD))
                n += parts[-1].num_rows
                if n >= SHARD:
                    yield answer(parts)
                    parts, n = [], 0
        if parts:
            yield answer(parts)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """(vec_id, embedding) rows -> query_id, rank, vec_id, score: for each row
    with ``is_query`` (over vec_id) the k other rows of largest inner product."""
    spark = ready(vectors.sparkSession)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = materialize(vectors.mapInArrow(_integers, "vec_id long, v binary")
                       .select(F.monotonically_increasing_id().alias("uid"), "vec_id", "v"), "vectors")
    queries = sequence_number(rows.filter(is_query), ["vec_id", "uid"], "seq")
    queries = materialize(queries, "queries")
    total, out = queries.count(), None
    for a in range(0, max(total, 1), BLOCK):
        part = queries.filter((F.col("seq") >= a) & (F.col("seq") < a + BLOCK)).select("uid", "v").collect()
        block = spark.sparkContext.broadcast((np.array([r["uid"] for r in part], np.int64), _matrix([r["v"] for r in part])))
        found = rows.mapInArrow(_search(block, k), "query long, vec_id long, score long")
        if total > BLOCK:
            found = materialize(found, "found")
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = queries.select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", "rank", "vec_id", "score")
