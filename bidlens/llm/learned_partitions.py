"""Approximate nearest neighbours by learned partitions (after Dong et al. 2020).

A neighbour graph of a bounded sample is cut into PARTS balanced parts with few
edges between them; a small network learns each vector's parts (its own and its
neighbours') and puts every row of the table into its likeliest part. A query
goes to its several most probable parts, whose rows are ranked by exact
distances. How many parts are asked is measured on sample vectors held against
brute force, for TARGET recall.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidlens.llm.multi_index import squares
from bidlens.llm.shared import cut
from bidlens.llm.vectors import deal, matrix, of_usual_length, runs, sample, usable

PARTS, NEIGHBOURS, SAMPLE, HIDDEN, EPOCHS, PASSES = 32, 10, 8_000, 128, 40, 12
TARGET, SLACK, BLOCK = 0.98, 1.1, 4096


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """Each point's nearest others, row by row."""
    out = []
    for i in range(0, len(points), 500):
        far = squares(points[i : i + 500], points)
        far[np.arange(len(far)), i + np.arange(len(far))] = np.inf
        out.append(np.argpartition(far, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """Parts of nearly equal size with few edges between them: streams of the nodes, again and again.

    Each node goes to the part that holds most of its neighbours (both ways),
    less the fuller that part is; none takes more than SLACK times its share.
    """
    n = len(graph)
    rng = np.random.default_rng(seed)
    source = np.repeat(np.arange(n), graph.shape[1])
    ends = np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source])
    order = np.argsort(ends[0], kind="stable")
    near, starts = ends[1][order], np.searchsorted(ends[0][order], np.arange(n + 1))
    part, sizes, room = np.full(n, -1), np.zeros(parts, np.int64), SLACK * n / parts
    stream = breadth_first(near, starts, rng)
    for _ in range(PASSES):
        for node in stream:
            if part[node] >= 0:
                sizes[part[node]] -= 1
            held = part[near[starts[node] : starts[node + 1]]]
            gain = (np.bincount(held[held >= 0], minlength=parts) + 1e-3) * (1 - sizes / room)
            part[node] = int(np.where(sizes + 1 <= room, gain, -np.inf).argmax())
            sizes[part[node]] += 1
        stream = rng.permutation(n)
    return part


def breadth_first(near: np.ndarray, starts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The nodes in breadth-first order, so that a stream meets neighbours together."""
    n = len(starts) - 1
    seen, out = np.zeros(n, bool), []
    for root in rng.permutation(n):
        level = [] if seen[root] else [root]
        seen[root] = True
        while level:
            out += level
            following = []
            for node in level:
                for other in near[starts[node] : starts[node + 1]]:
                    if not seen[other]:
                        seen[other] = True
                        following.append(other)
            level = following
    return np.array(out)


@dataclass
class Router:
    """A network with one hidden layer from a vector to its probable parts."""

    mean: np.ndarray
    scale: float
    layers: list[np.ndarray]
    probes: int = 1

    def scores(self, points: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((points - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2


def train(points: np.ndarray, wanted: np.ndarray, seed: int = 4) -> Router:
    """Adam on the cross-entropy with each point's share of parts (n x parts)."""
    rng = np.random.default_rng(seed)
    size, parts = points.shape[1], wanted.shape[1]
    router = Router(points.mean(axis=0), float(points.std()) or 1.0, [rng.standard_normal((size, HIDDEN)) * (2 / size) ** 0.5, np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) * 0.05, np.zeros(parts)])
    inputs = (points - router.mean) / router.scale
    first, second, step = [np.zeros_like(x) for x in router.layers], [np.zeros_like(x) for x in router.layers], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(points))
        for i in range(0, len(points), 128):
            at = order[i : i + 128]
            w1, b1, w2, b2 = router.layers
            hidden = np.maximum(inputs[at] @ w1 + b1, 0)
            scores = hidden @ w2 + b2
            error = np.exp(scores - scores.max(axis=1, keepdims=True))
            error = (error / error.sum(axis=1, keepdims=True) - wanted[at]) / len(at)
            back = error @ w2.T * (hidden > 0)
            step += 1
            rate = 3e-3 * (1 - epoch / EPOCHS) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for k, grad in enumerate((inputs[at].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                router.layers[k] = router.layers[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-9)
    return router


def fit(points: np.ndarray, k: int = NEIGHBOURS, parts: int = PARTS, target: float = TARGET) -> Router:
    """The router of a sample; of a sample too small to cut, one with a single part."""
    parts = min(parts, len(points) // (4 * k))
    if parts < 2:
        return Router(np.zeros(points.shape[1]), 1.0, [np.zeros((points.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])
    graph = neighbour_graph(points, k)
    part = balanced_parts(graph, parts)
    wanted = np.zeros((len(points), parts))
    np.add.at(wanted, (np.arange(len(points)), part), 1.0)
    np.add.at(wanted, (np.repeat(np.arange(len(points)), k), part[graph].ravel()), 1.0)
    router = train(points, wanted / (k + 1))
    scores = router.scores(points)
    ranked, home = np.argsort(-scores, axis=1, kind="stable"), scores.argmax(axis=1)
    place = np.argsort(ranked, axis=1, kind="stable")  # of each part in each point's order
    needed = np.sort(np.take_along_axis(place, home[graph], axis=1).ravel())
    router.probes = int(needed[min(len(needed) - 1, int(target * len(needed)))]) + 1
    return router


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search(df: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 10, parts: int = PARTS, target: float = TARGET) -> DataFrame:
    """Each query's ``k`` nearest rows found: (query_id, rank, vec_id, score), by Euclidean distance in double precision.

    ``queries`` has the columns of ``df``. Rows of the query's own id are no
    candidates; ties go to the smaller id; with fewer candidates, all are given.
    Rows without an id, and vectors that are null, empty, zero, of another length
    than most, or hold null or non-finite components take no part on either side.
    Repeated rows count once. An empty side gives no rows. Every row is indexed; the
    index is learned from a sample of SAMPLE rows.
    """
    shaped = lambda side: side.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    base = of_usual_length(shaped(df), "v")
    points = sample(base, "id", "v", SAMPLE)
    if not len(points):
        points = np.ones((1, 1))
    router = fit(points, k, parts, target)
    size = points.shape[1]
    kind = base.schema["v"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = router.scores(matrix(batch.column(1))).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32))], names=["id", "v", "part"])

    base = cut(base.mapInArrow(index, f"id long, v {kind}, part int"), "index")
    held = np.zeros(router.layers[-1].shape[0], np.int64)
    for part, n in base.groupBy("part").count().collect():  # a row per part, of which there are PARTS at most
        held[part] = n

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.argsort(-router.scores(matrix(batch.column(1))), axis=1, kind="stable")
            # More parts than measured, if those don't hold k rows beside the query's own.
            enough = np.maximum((np.cumsum(held[order], axis=1) < k + 1).sum(axis=1) + 1, router.probes)
            routed = pa.array([row[:n].tolist() for row, n in zip(order, enough, strict=True)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, routed], names=["id", "v", "parts"])

    asks = shaped(queries).where(F.size("v") == size).dropDuplicates(["id"])
    asks = asks.mapInArrow(route, f"id long, v {kind}, parts array<int>").select("id", "v", F.explode("parts").alias("part"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, 3):
            ids, points = cell.column("id").to_numpy(), matrix(cell.column("v").combine_chunks())
            split = int((cell.column("_asks").to_numpy() == 0).sum())
            if not split:
                continue
            for i in range(split, len(ids)):
                far = np.sqrt(((points[:split] - points[i]) ** 2).sum(axis=1))
                far[ids[:split] == ids[i]] = np.inf
                best = _nearest(far, ids[:split], k)
                best = best[np.isfinite(far[best])]
                if len(best):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), ids[i])), pa.array(ids[best]), pa.array(far[best])], schema=_FOUND)

    found = deal(base, cut(asks, "asks"), ["part"], BLOCK).mapInArrow(rank, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(far: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` nearest distinct ids: all that are no farther than the k-th, in order."""
    _, first = np.unique(ids, return_index=True)
    far, ids = (far[first], ids[first])
    reach = np.partition(far, min(k, len(far)) - 1)[min(k, len(far)) - 1]
    near = np.flatnonzero(far <= reach)
    return first[near[np.lexsort((ids[near], far[near]))][:k]]
