"""Nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts with few edges between them. A small classifier learns
which parts a vector's neighbours lie in; it puts every row into its most probable part and sends a query to several. How many
is settled by the recall of sample vectors that it was not trained on. What comes back from the parts is ranked by exact cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkfold.llm.common import bounded_sample, cut, map_batches

#: Vectors on which the index is fitted, chosen by hash of their ids. Every row is indexed.
SAMPLE = 12_000
#: Rows for each part; the number of parts grows with the table until a part has no more than so many vectors of the sample.
PART_ROWS = 1500
LEAST_PARTS, PART_SAMPLE = 16, 16
#: One in so many vectors of the sample is held back from training, to settle the number of probes.
HELD_BACK = 5
NEIGHBOURS = 10
#: Recall of the held-back vectors at which the number of probed parts is settled.
TARGET = 0.96
#: Candidates and queries that meet in one task at a time; more are dealt over further tasks.
CHUNK, QUERIES = 8192, 2048
_NEAR = 1e-9


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, not all zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbour_graph(unit: np.ndarray, k: int, queries: np.ndarray | None = None) -> np.ndarray:
    """The k rows of unit nearest to each of its rows (or of those numbered in queries), itself left out."""
    own = np.arange(len(unit)) if queries is None else queries
    found = np.empty((len(own), k), np.int64)
    for at in range(0, len(own), 1024):
        rows = own[at : at + 1024]
        near = unit[rows] @ unit.T
        near[np.arange(len(rows)), rows] = -np.inf
        found[at : at + 1024] = np.argpartition(near, -k, axis=1)[:, -k:]
    return found


def _halves(unit: np.ndarray, rows: np.ndarray, parts: int, random: np.random.Generator) -> list[np.ndarray]:
    """rows in parts of like size, cut along the direction of two distant rows again and again."""
    if parts == 1:
        return [rows]
    a = unit[rows[random.integers(len(rows))]]
    b = unit[rows[np.argmin(unit[rows] @ a)]]
    order = rows[np.argsort(unit[rows] @ (a - b), kind="stable")]
    left = parts // 2
    at = len(rows) * left // parts
    return _halves(unit, order[:at], left, random) + _halves(unit, order[at:], parts - left, random)


def balanced_parts(unit: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """The part of each row: none much larger than the mean, neighbours in one part where that allows."""
    random = np.random.default_rng(seed)
    part = np.zeros(len(unit), np.int64)
    for p, rows in enumerate(_halves(unit, np.arange(len(unit)), parts, random)):
        part[rows] = p
    room = int(1.05 * len(unit) / parts) + 1
    heads = np.repeat(np.arange(len(unit)), graph.shape[1])
    tails = graph.ravel()
    ends = np.concatenate((heads, tails)), np.concatenate((tails, heads))
    for _ in range(rounds):
        votes = np.bincount(ends[0] * parts + part[ends[1]], minlength=len(unit) * parts).reshape(-1, parts)
        wish = votes.argmax(1)
        gain = votes[np.arange(len(unit)), wish] - votes[np.arange(len(unit)), part]
        moving = np.flatnonzero(gain > 0)
        moving = moving[random.random(len(moving)) < 0.5]  # two neighbours that change places would gain nothing
        sizes, moved = np.bincount(part, minlength=parts), 0
        for v in moving[np.argsort(-gain[moving], kind="stable")].tolist():
            if sizes[wish[v]] < room:
                sizes[part[v]] -= 1
                sizes[wish[v]] += 1
                part[v] = wish[v]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer from unit vectors to the probabilities of parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def scores(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, unit: np.ndarray, k: int) -> np.ndarray:
        """The k most probable parts of each row, ties to the smaller number."""
        return np.argsort(-self.scores(unit), axis=1, kind="stable")[:, :k]


def train_router(unit: np.ndarray, wanted: np.ndarray, hidden: int = 128, epochs: int = 30, seed: int = 11) -> Router:
    """wanted: for each row the share of its neighbours, and of itself, in each part."""
    random = np.random.default_rng(seed)
    dim, parts = unit.shape[1], wanted.shape[1]
    weights = [random.normal(0, np.sqrt(2 / dim), (dim, hidden)), np.zeros(hidden), random.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs) + 1e-4
        order = random.permutation(len(unit))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            x = unit[rows]
            h = np.maximum(x @ weights[0] + weights[1], 0)
            out = h @ weights[2] + weights[3]
            p = np.exp(out - out.max(1, keepdims=True))
            slope = (p / p.sum(1, keepdims=True) - wanted[rows]) / len(rows)
            back = (slope @ weights[2].T) * (h > 0)
            step += 1
            for w, g, m, v in zip(weights, (x.T @ back, back.sum(0), h.T @ slope, slope.sum(0)), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(*weights, probes=1)


def fit(unit: np.ndarray, n: int, target: float = TARGET) -> Router:
    """A router for n vectors of which unit (normed rows) is a sample. target: recall of held-back vectors; at 1 all parts are probed."""
    k = min(NEIGHBOURS, len(unit) - 1)
    if k < 1:
        return Router(np.zeros((unit.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), probes=1)
    parts = max(1, min(max(LEAST_PARTS, -(-n // PART_ROWS)), len(unit) // PART_SAMPLE))
    back = np.arange(len(unit)) % HELD_BACK == HELD_BACK - 1
    if parts == 1 or not back.any():
        return Router(np.zeros((unit.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), probes=1)
    known = unit[~back]
    k = min(k, len(known) - 1)
    graph = neighbour_graph(known, k)
    part = balanced_parts(known, graph, parts)
    votes = np.bincount(np.repeat(np.arange(len(known)), k + 1) * parts + part[np.column_stack((np.arange(len(known)), graph))].ravel(), minlength=len(known) * parts)
    router = train_router(known, votes.reshape(-1, parts) / (k + 1))
    home = router.parts(unit, 1)[:, 0]
    asked = np.flatnonzero(back)
    near = neighbour_graph(unit, min(5, k), asked)
    order = router.parts(unit[asked], parts)
    rank = np.argsort(order, axis=1)  # the place of each part in a query's order
    needed = np.take_along_axis(rank, home[near], axis=1)
    router.probes = next((m for m in range(1, parts) if (needed < m).mean() >= target and target < 1), parts)
    return router


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    target: float = TARGET,
) -> DataFrame:
    """The k nearest other rows of each row of vectors for which queries holds: query_id, rank, vec_id, score.

    score is the cosine in double precision; ties go to the smaller id. Rows with a null id or a vector that is not
    usable() or not of the usual length (the most frequent one, ties to the shorter) take no part. Rows of one id count as one
    another's own; the best of their scores holds. Fewer candidates give fewer rows. Other columns are not read.
    """
    session = vectors.sparkSession
    rows = vectors.withColumn("_asked", F.coalesce(queries, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col("_asked").alias("asked")
    )
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        return session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes[0]
    rows = rows.where(F.size("v") == dim)
    sample = bounded_sample(rows, ["id"], SAMPLE).select("id", "v").toArrow().sort_by("id")
    first = np.unique(sample["id"].to_numpy(), return_index=True)[1]
    router = fit(_normed(_matrix(sample["v"], dim)[first]), n, target)
    shared = session.sparkContext.broadcast(router)

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        unit = _normed(_matrix(batch.column(1), dim))
        parts = shared.value.parts(unit, shared.value.probes).astype(np.int32)
        return pa.record_batch([*batch.columns, pa.array(parts.tolist(), pa.list_(pa.int32()))], ["id", "v", "asked", "parts"])

    routed = cut(map_batches(rows, route, "id long, v array<double>, asked boolean, parts array<int>"))
    held = routed.select("id", "v", F.col("parts")[0].alias("part"))
    asked = routed.where("asked").select("id", "v", F.explode("parts").alias("part"))
    # a row for each part, of which there are at most SAMPLE / PART_SAMPLE
    chunks = {r[0]: -(-r[1] // CHUNK) for r in held.groupBy("part").count().collect()}
    blocks = {r[0]: -(-r[1] // QUERIES) for r in asked.groupBy("part").count().collect()}

    def pieces(counts: dict[int, int]) -> Column:
        return F.get(F.array(*[F.lit(counts.get(p, 1)) for p in range(max(counts, default=0) + 1)]), F.col("part"))

    def each(counts: dict[int, int]) -> Column:
        return F.explode(F.sequence(F.lit(0), pieces(counts) - 1))

    own = lambda counts: F.pmod(F.xxhash64("id"), pieces(counts)).cast("int")
    left = held.withColumn("chunk", own(chunks)).withColumn("block", each(blocks))
    right = asked.withColumn("block", own(blocks)).withColumn("chunk", each(chunks))

    def meet(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        return _best(candidates, queries, dim, k)

    keys = ["part", "chunk", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _normed(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _best(candidates: pa.Table, queries: pa.Table, dim: int, k: int) -> pa.Table:
    """The k best candidates of each query, its own id left out, by exact cosine."""
    names, places, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    if candidates.num_rows and queries.num_rows:
        ids, c = candidates["id"].to_numpy(), _matrix(candidates["v"], dim)
        # of candidates with one vector the k + 1 least ids are enough, one of which may be the query's own
        order = np.lexsort((ids, *c.T[::-1]))
        ids, c = ids[order], np.ascontiguousarray(c[order])
        once = np.concatenate(([True], (ids[1:] != ids[:-1]) | (c[1:] != c[:-1]).any(1)))
        ids, c = ids[once], c[once]
        new = np.concatenate(([True], (c[1:] != c[:-1]).any(1)))
        place = np.arange(len(ids)) - np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        ids, c = ids[place <= k], c[place <= k]
        unit = _normed(c)
        wanted = k * int(np.unique(ids, return_counts=True)[1].max())  # an id with several vectors counts once
        asked, q = queries["id"].to_numpy(), _matrix(queries["v"], dim)
        for at in range(0, len(asked), 256):
            own, rows = asked[at : at + 256], q[at : at + 256]
            near = _normed(rows) @ unit.T
            near[own[:, None] == ids[None, :]] = -np.inf
            least = np.partition(near, -wanted, axis=1)[:, -wanted] if len(ids) > wanted else np.full(len(own), -2.0)
            a, b = np.nonzero((near >= least[:, None] - _NEAR) & (near > -np.inf))
            exact = _cosine(rows[a], c[b])
            rank = np.lexsort((ids[b], -exact, a))
            a, b, exact = a[rank], b[rank], exact[rank]
            best = np.sort(np.unique(np.column_stack((a, ids[b])), axis=0, return_index=True)[1])
            a, b, exact = a[best], b[best], exact[best]
            first = np.searchsorted(a, a)
            keep = np.arange(len(a)) - first < k
            names.append(own[a[keep]])
            places.append(ids[b[keep]])
            scores.append(exact[keep])
    return pa.table({"query_id": np.concatenate(names), "vec_id": np.concatenate(places), "score": np.concatenate(scores)})


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    norms = np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1))
    plain = (a * b).sum(1)
    with np.errstate(all="ignore"):
        got = plain / norms
    odd = ~np.isfinite(got) | (norms < 1e-290)  # too large or too small for squares: cosine of the scaled vectors
    if odd.any():
        got[odd] = (_normed(a[odd]) * _normed(b[odd])).sum(1)
    return got
