"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves, each with a codebook of its own; a pair of
codes is a cell of the product grid. From each vector, cells are visited in the
order of how near they can come (multi-sequence traversal of the halves' sorted
distances), and what they hold is verified by exact cosines. A cell's distance
is measured to its boundary: a point nearer to code i than to the vector's own
code a lies beyond the plane between them, (|x-i|^2 - |x-a|^2) / (2 |i-a|) away.
The traversal ends when the two halves' distances exceed the radius that the
cosine allows, so no later cell can hold a link and recall is complete; for a
lower target recall it ends where that share of simulated neighbours at the
threshold, in random directions from sample vectors, has been reached.

Vectors without clusters have neighbours beyond most planes: with 64 random
dimensions and cosine 0.93, four fifths of any grid must be visited for complete
recall. The codebooks are therefore small by default (CODES); clustered vectors,
or a target recall below 1, make larger ones pay.

Equal vectors form a class and one of them is compared for all. Cells are dealt
out in blocks, and a block's links leave its task as counts and as a forest
(each vector with the smallest it is connected to there), never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.shared import components, cut
from bidlens.llm.vectors import deal, matrix, of_usual_length, runs, sample, usable

CODES, SAMPLE, ROUNDS, BLOCK = 6, 20_000, 12, 1024


def codebook(points: np.ndarray, codes: int, seed: int) -> np.ndarray:
    """Lloyd's k-means; fewer distinct points than codes are the codes themselves."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= codes:
        return distinct
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), codes, replace=False)]
    for _ in range(ROUNDS):
        nearest = squares(points, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=codes)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None] - 2 * x @ y.T, 0)


def halves(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = units.shape[1] // 2
    return units[:, :middle], units[:, middle:]


def bounds(points: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's own code, and the square of its least distance to any point of each code."""
    far = squares(points, codes)
    own = far.argmin(axis=1)
    gaps = np.sqrt(squares(codes, codes))[own]
    beyond = (far - far[np.arange(len(points)), own][:, None]) / (2 * np.where(gaps > 0, gaps, np.inf))
    return own, np.maximum(beyond, 0) ** 2


def visits(first: np.ndarray, second: np.ndarray, radius2: float) -> tuple[np.ndarray, np.ndarray]:
    """Multi-sequence traversal for one vector: pairs of codes whose squared distances sum to ``radius2`` at most, nearest first."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    # In sorted order, the pairs within reach form a staircase: for each place in one sequence, a stretch of the other.
    steps = np.searchsorted(second[b], radius2 - first[a], side="right")
    i = np.repeat(a, steps)
    j = b[np.arange(len(i)) - np.repeat(np.cumsum(steps) - steps, steps)]
    order = np.argsort(first[i] + second[j], kind="stable")
    return i[order], j[order]


def stop(units: np.ndarray, books: list[np.ndarray], cosine: float, recall: float) -> float:
    """The square of the distance at which the traversal ends."""
    if recall >= 1:
        return 2 - 2 * cosine + 1e-9
    aside = np.random.default_rng(6).standard_normal(units.shape)
    aside -= (aside * units).sum(axis=1)[:, None] * units
    near = cosine * units + (1 - cosine**2) ** 0.5 * aside / np.maximum(np.linalg.norm(aside, axis=1), 1e-12)[:, None]
    reached = np.zeros(len(units))
    for x, y, codes in zip(halves(units), halves(near), books, strict=True):
        reached += bounds(x, codes)[1][np.arange(len(x)), bounds(y, codes)[0]]
    return min(2 - 2 * cosine, float(np.quantile(reached, recall))) + 1e-9


_LINKS = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of a two-sided graph: for rows and columns, the smallest row of their component."""
    rows = np.arange(linked.shape[0])
    none = linked.shape[0]
    while True:
        columns = np.where(linked, rows[:, None], none).min(axis=0, initial=none)
        again = np.minimum(rows, np.where(linked, columns[None, :], none).min(axis=1, initial=none))
        if (again == rows).all():
            return rows, columns
        rows = again


def near_vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str | None = "label", cosine: float = 0.93, codes: int = CODES, recall: float = 1.0) -> DataFrame:
    """One row per row of ``df``: (id, n_links, component_id, kept).

    Vectors of equal labels are linked if their cosine, in double precision, is at
    least ``cosine``; ``n_links`` counts the other vectors linked directly,
    ``component_id`` is the smallest id reachable and ``kept`` says that it is the
    row's own. Null labels, and vectors that are null, empty, zero, of another
    length than most, or hold null or non-finite components link with nothing; rows
    without an id don't either, and are kept under a null component. Repeated rows
    are one vector. An empty table gives none. Other columns take no part.
    """
    name = F.col(label).cast("string") if label else F.lit("")
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"), name.alias("label"))
    full = of_usual_length(rows.where(usable(F.col("v")) & F.col("label").isNotNull() & F.col("id").isNotNull()), "v")
    full = full.select("id", "v", F.xxhash64("label").alias("group"), F.xxhash64("label", "v").alias("h1"), F.xxhash64("v", "label", F.lit(1)).alias("h2"))
    members = cut(full.select("id", "h1", "h2").distinct(), "members")
    classes = cut(members.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "classes")
    reps = full.join(classes.withColumnRenamed("rep", "id"), ["h1", "h2", "id"]).dropDuplicates(["h1", "h2"])
    reps = cut(reps.select("id", "group", "size", "v"), "vectors")

    taken = sample(reps, "id", "v", SAMPLE)
    if not len(taken):
        return rows.select(F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    taken /= np.linalg.norm(taken, axis=1)[:, None]
    books = [codebook(x, codes, k) for k, x in enumerate(halves(taken))]
    radius2 = stop(taken, books, cosine, recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = matrix(batch.column(3))
            units /= np.linalg.norm(units, axis=1)[:, None]
            (own1, first), (own2, second) = (bounds(x, c) for x, c in zip(halves(units), books, strict=True))
            own = own1 * len(books[1]) + own2
            cells = []
            for k in range(len(units)):
                i, j = visits(first[k], second[k], radius2)
                cell = i * len(books[1]) + j
                cells.append(cell[cell >= own[k]])  # a pair meets in the larger of its cells
            offsets = np.cumsum([0, *map(len, cells)])
            visited = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(cells).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32)), visited], names=[*batch.schema.names, "cell", "visits"])

    kind = reps.schema["v"].dataType.simpleString()
    placed = cut(reps.mapInArrow(place, f"id long, group long, size long, v {kind}, cell int, visits array<int>"), "placed")
    base = placed.select("group", "cell", "id", "size", F.col("cell").alias("own"), "v")
    asks = placed.select("group", F.explode("visits").alias("at"), "id", "size", F.col("cell").alias("own"), "v").withColumnRenamed("at", "cell")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, 4):
            split = int((cell.column("_asks").to_numpy() == 0).sum())
            if split in (0, len(cell)):
                continue
            ids, sizes, own = (cell.column(c).to_numpy() for c in ("id", "size", "own"))
            units = matrix(cell.column("v").combine_chunks())
            units /= np.linalg.norm(units, axis=1)[:, None]
            linked = units[split:] @ units[:split].T >= cosine
            # Within one cell, both sides hold all of it: the smaller id asks.
            linked &= (own[split:, None] != own[None, :split]) | (ids[split:, None] < ids[None, :split])
            asked, held = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            if not len(asked):
                continue
            linked = linked[np.ix_(asked, held)]
            order = np.argsort(ids[split + asked], kind="stable")
            asked, linked = asked[order], linked[order]
            rows, columns = forest(linked)
            roots = ids[split + asked]
            for at, root, count in ((split + asked, roots[rows], linked @ sizes[held]), (held, roots[columns], sizes[split + asked] @ linked)):
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(count.astype(np.int64)), pa.array(root)], schema=_LINKS)

    found = cut(deal(base, asks, ["group", "cell"], BLOCK).mapInArrow(verify, "id long, links long, root long"), "found")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per = classes.join(counts.withColumnRenamed("id", "rep"), "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    per = per.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    per = members.join(per, ["h1", "h2"]).groupBy("id").agg(F.sum("n").alias("n"), F.min("c").alias("c"))
    out = rows.select("id").join(per, "id", "left").select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "id").alias("component_id"))
    return out.select(F.col("id").alias(id), "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
