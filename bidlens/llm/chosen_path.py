"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of hashed word shingles; each has a sketch of minwise tokens
(the smallest token under each of SKETCH hash functions). Documents of equal
sets form a class, and one of them stands for it. In each of TREES independent
trees, a node picks one of the functions at random (or, now and then, two, so
that a pair at the threshold goes on in one branch on average) and documents
branch by their token under it. A node of at most LEAF documents is compared
exhaustively on the sketches, of which a byte a token is enough, and the groups
that these connect are confirmed on the full sets, side by side in one place:
groups of several trees that share documents are put together, up to GROUP
documents, so that a text is mostly sent once. Larger nodes branch on. Nodes that are
still large after DEPTH levels hold near copies: their documents are held
against a central one, and what that does not join to the rest is held against
the whole node, block by block. Links leave a task as a forest, never as all
pairs of a group.

A pair at the threshold t meets in a given tree's first level with probability
t, so of TREES trees one at least catches it with 1 - (1 - t)^TREES (0.99999
for t = 0.8 and 8 trees), before the losses of deeper levels that only large
nodes go through; sketches let such a pair pass with probability above 0.9999.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from bidlens.llm.multi_index import forest
from bidlens.llm.shared import components, cut, sieve
from bidlens.llm.vectors import deal, runs

SKETCH, TREES, STARS, LEAF, GROUP, DEPTH, BLOCK = 64, 8, 2, 32, 64, 5, 512
#: Standard deviations that an estimate of similarity may lie below the threshold.
MARGIN = 4.5
_RANDOM = np.random.default_rng(20_240_611)
_FACTORS = _RANDOM.integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 63, SKETCH, np.uint64)
_PLACES = _RANDOM.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words`` words.

    Words are what stands between ASCII white space, with A-Z lowered; fewer words
    than that make one shingle; no words, none. All of the text is read.
    """
    from xxhash import xxh3_64_intdigest

    tokens = (text or "").encode().lower().split()  # on bytes, both work on ASCII alone
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    n = len(tokens) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += _mixed(hashes[i : i + n] * _PLACES[i % 64] + np.uint64(i))
    return np.unique(_mixed(total))


def digest(tokens: np.ndarray) -> np.ndarray:
    """128 bits that tell sets apart, as two integers."""
    import hashlib

    return np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """The smallest token (upper 32 bits) under each hash function."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(tokens), 4096):
        part = tokens[i : i + 4096]
        np.minimum(least, (part[None, :] * _FACTORS[:, None] + _OFFSETS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).tobytes()


def sketches(df: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """Rows (id, n, s1, s2, sketch): the set's size, a 128-bit digest and its sketch (null for empty sets)."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for value in batch.column(1):
                tokens = shingles(value.as_py(), words)
                s1, s2 = digest(tokens).tolist()
                for column, x in zip(out, (len(tokens), s1, s2, sketch(tokens) if len(tokens) else None), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(out, list(schema)[1:], strict=True))], schema=schema)

    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, n long, s1 long, s2 long, sketch binary")


def least_agreement(percent: int) -> int:
    """How many of the sketch's tokens two sets at the threshold share at least."""
    t = percent / 100
    return int(SKETCH * t - MARGIN * (SKETCH * t * (1 - t)) ** 0.5)


def branches(rows: DataFrame, percent: int) -> DataFrame:
    """The children of nodes: one chosen function, or two with probability 100 / percent - 1, and the document's token under it."""
    chance = 100 / percent - 1
    drawn = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1_000_000)) < int(chance * 1_000_000)
    first = F.pmod(F.xxhash64("node", F.lit(11)), F.lit(SKETCH))
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit(13)), F.lit(SKETCH - 1)), F.lit(SKETCH))
    picked = F.when(drawn, F.array(first, second)).otherwise(F.array(first)).cast("array<int>")
    rows = rows.withColumn("_p", F.explode(picked))
    return rows.withColumn("node", F.xxhash64("node", "_p", F.expr("substring(sketch, 4 * _p + 1, 4)"))).drop("_p")


def trees(reps: DataFrame, percent: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Rows (node, id) of small nodes; if nodes stay large after DEPTH levels, their rows (top, node, id) and STARS trees' rows (node, id) of their tops.

    A ``top`` is the tree's first node above. Each level is one narrow table in the shared folder.
    """
    roots = reps.select("id", "sketch", F.posexplode(F.array(*[F.xxhash64(F.lit(t)) for t in range(TREES)])).alias("tree", "node"))
    rows = branches(roots, percent).select("tree", F.col("node").alias("top"), "node", "id")
    small, large, first = [], None, None
    for level in range(1, DEPTH + 1):
        rows = rows if level == 1 else cut(rows, f"level{level}")
        sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        rows = cut(rows.join(sizes, "node"), f"nodes{level}")
        first = rows if level == 1 else first
        small.append(rows.where(F.col("size") <= LEAF).select("node", "id"))
        large = rows.where(F.col("size") > LEAF)
        if large.isEmpty():
            large = None
            break
        if level < DEPTH:
            rows = branches(large.join(sieve(reps.select("id", "sketch"), large), "id"), percent).select("tree", "top", "node", "id")
    union = small[0]
    for more in small[1:]:
        union = union.union(more)
    if large is None:
        return union, None, None
    above = large.where(F.col("tree") < STARS).select(F.col("top").alias("node")).distinct()
    needed = first.join(above, "node", "left_semi").select("node", "id")
    return union, cut(large.select("top", "node", "id").distinct(), "large"), cut(needed, "tops")


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_CELLS = pa.schema([("cell", pa.int64()), ("id", pa.int64()), ("least", pa.int64())])


def short(sketch: str) -> Column:
    """The lowest byte of each of the sketch's tokens: equal tokens stay equal, one in 256 of the others looks so."""
    return F.concat(*[F.substring(sketch, 4 * i + 1, 1) for i in range(SKETCH)])


def candidates(rows: DataFrame, least: int) -> DataFrame:
    """Groups (cell, id, least) of documents in small nodes (node, id, short) that their sketches connect, compared exhaustively.

    A cell's number is the digest of its ids: the same group from several trees is
    one. ``least`` is the smallest id of the group.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []
        for node in runs(batches, 1):
            ids = node.column("id").to_numpy()
            tokens = np.frombuffer(b"".join(node.column("short").to_pylist()), np.uint8).reshape(-1, SKETCH)
            roots, _ = forest((tokens[:, None, :] == tokens[None, :, :]).sum(axis=2) >= least)
            for root in np.flatnonzero(np.bincount(roots) > 1):
                group = np.sort(ids[roots == root])
                cell = np.frombuffer(hashlib.blake2b(group.tobytes(), digest_size=8).digest(), np.int64)[0]
                out.append((np.full(len(group), cell), group, np.full(len(group), group[0])))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=_CELLS)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=_CELLS)

    rows = rows.select("node", "id", "short").repartition("node").sortWithinPartitions("node", "id")
    return rows.mapInArrow(run, "cell long, id long, least long").distinct()


def gathered(cells: DataFrame) -> DataFrame:
    """Cells (cell, id) that share documents as one, unless that would hold more than GROUP: those stay as they are."""
    joined = cut(components(cells.selectExpr("id AS a", "least AS b"), "cells"), "joined")
    sizes = joined.groupBy("component").agg(F.count("*").alias("size"))
    whole = joined.join(sizes.where(F.col("size") <= GROUP), "component").select(F.col("node").alias("id"), "component")
    cell = F.coalesce("component", "cell").alias("cell")
    return cells.join(whole, "id", "left").select(cell, "id").distinct()


def exact(asks: list[np.ndarray], base: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of ``asks`` (rows) and ``base`` (columns) have 100 * intersection >= percent * union."""
    tokens, place = np.unique(np.concatenate(base), return_inverse=True)
    starts = np.cumsum([0, *map(len, base)])[:-1]
    sizes = np.array([len(x) for x in base])
    linked = np.zeros((len(asks), len(base)), bool)
    marked = np.zeros(len(tokens), np.int64)
    for i, own in enumerate(asks):
        at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
        at = at[tokens[at] == own]
        marked[at] = 1
        common = np.add.reduceat(marked[place], starts)
        marked[at] = 0
        linked[i] = 100 * common >= percent * (len(own) + sizes - common)
    return linked


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in table.column("s").to_pylist()]


def own_set(text: str | None, s1: int, words: int) -> np.ndarray | None:
    """The text's set, if its digest begins with ``s1``: of rows that repeat an id, those of the set that stands for it."""
    tokens = shingles(text, words)
    return tokens if digest(tokens)[0] == s1 else None


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (id and more columns) with the texts (id, text); other texts are not shuffled for it."""
    return sieve(texts, wanted).join(wanted, "id")


def confirm(cells: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) within small cells (cell, id, s1), by their full sets: a forest of each cell's links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, 1):
            rows = zip(cell.column("id").to_pylist(), cell.column("text"), cell.column("s1").to_pylist(), strict=True)
            found = {id: tokens for id, text, s1 in rows if (tokens := own_set(text.as_py(), s1, words)) is not None}
            if len(found) < 2:
                continue
            ids, own = np.array(list(found), np.int64), list(found.values())
            roots, _ = forest(exact(own, own, percent))
            far = np.flatnonzero(roots != np.arange(len(ids)))
            if len(far):
                yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[roots[far]])], schema=_LINKS)

    rows = texts_of(texts, cells).select("cell", "id", "s1", "text").repartition("cell").sortWithinPartitions("cell", "id")
    return rows.mapInArrow(run, "a long, b long")


def confirm_across(base: DataFrame, asks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the two sides' documents of a node (rows node, id, component) of different components, by their full sets.

    The sides are dealt out in blocks that meet pairwise, so no task holds a whole
    node, and a block pair's links leave it as a forest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, 3):
            split = int((cell.column("_asks").to_numpy() == 0).sum())
            if split in (0, len(cell)):
                continue
            ids, component, own = cell.column("id").to_numpy(), cell.column("component").to_numpy(), _sets(cell)
            linked = exact(own[split:], own[:split], percent) & (component[split:, None] != component[None, :split])
            held = np.flatnonzero(linked.any(axis=0))
            if len(held):
                rows, columns = forest(linked[:, held])
                far = np.flatnonzero(rows != np.arange(len(rows)))
                asked = ids[split:]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([asked[far], ids[held]])), pa.array(np.concatenate([asked[rows[far]], asked[columns]]))], schema=_LINKS)

    sides = [side.select("node", "id", "component").join(sets, "id") for side in (base, asks)]
    return deal(*sides, ["node"], BLOCK).mapInArrow(run, "a long, b long")


def labelled(rows: DataFrame, joined: DataFrame) -> DataFrame:
    return rows.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))


def confirm_large(large: DataFrame, tops: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within nodes that stayed large. tops: rows (node, id) of the first levels' nodes above them, in STARS trees.

    First all documents of a first-level node are held against a central one of it,
    one that stayed with most others through all levels. What is not yet one
    component in a last-level node is then held against the whole node: every
    document outside its main component against all, so nothing is left uncompared.
    """
    centres = large.groupBy("top").agg(F.min_by("id", F.xxhash64("top", "id")).alias("id")).withColumnRenamed("top", "node")
    centres = centres.join(tops.select("node").distinct(), "node", "left_semi")
    star = confirm_across(tops.withColumn("component", F.col("id")), centres.withColumn("component", F.col("id")), sets, percent)
    links = links.union(cut(star, "star"))
    rows = cut(labelled(large.select("node", "id"), components(links)), "rest")
    counts = rows.groupBy("node", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("node").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1")
    rows = rows.join(cut(main.select("node", F.col("main.component").alias("main")), "main"), "node")
    return links.union(cut(confirm_across(rows, rows.where("component <> main"), sieve(sets, rows), percent), "more"))


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``df``: (id, n_shingles, component_id, kept).

    Documents are linked if their sets of distinct ``words``-word shingles have
    100 * intersection >= percent * union; ``component_id`` is the smallest id
    reachable by links and ``kept`` says that it is the row's own. Null and empty
    texts have empty sets and link with nothing. Rows without an id link with
    nothing either and are kept under a null component. Repeated rows are one
    document; of rows that repeat an id with other texts, one is searched for.
    An empty table gives none. Other columns take no part.
    """
    docs = cut(sketches(df, id, text, words), "sketches")
    full = docs.where("n > 0 AND id IS NOT NULL")
    # Equal sets have equal sketches, so a class brings its own along.
    classes = cut(full.groupBy("s1", "s2").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch")), "classes")
    chosen = classes.groupBy("id").agg(F.min(F.struct("s1", "s2")).alias("s"), F.count("*").alias("k"))
    repeated = cut(chosen.where("k > 1").select("id", "s"), "repeated")
    reps = classes
    if not repeated.isEmpty():
        reps = cut(classes.join(repeated, "id", "left").where("s IS NULL OR s = struct(s1, s2)").drop("s"), "reps")
    nodes, large, tops = trees(reps, percent)
    cells = cut(candidates(nodes.join(reps.select("id", short("sketch").alias("short")), "id"), least_agreement(percent)), "groups")
    texts = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    digests = reps.select("id", "s1")
    links = cut(confirm(cut(gathered(cells).join(digests, "id"), "gathered"), texts, words, percent), "links")
    if large is not None:

        @arrow_udf("binary")
        def tokens(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for batch, of in batches:
                found = (own_set(x.as_py(), s1.as_py(), words) for x, s1 in zip(batch, of, strict=True))
                yield pa.array([None if x is None else x.tobytes() for x in found], pa.binary())

        needed = cut(tops.select("id").union(large.select("id")).distinct().join(digests, "id"), "needed")
        sets = cut(texts_of(texts, needed).select("id", tokens("text", "s1").alias("s")), "sets").where("s IS NOT NULL")
        links = confirm_large(large, tops, links, sets, percent)
    joined = cut(components(links), "components")
    rep_of = classes.join(joined, classes["id"] == joined["node"], "left").select("s1", "s2", F.coalesce("component", "id").alias("component"))
    out = docs.join(rep_of, (docs["s1"] == rep_of["s1"]) & (docs["s2"] == rep_of["s2"]) & (docs["n"] > 0), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
