"""Vectors as numpy rows: validity, cells dealt out in bounded blocks, runs of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.samples import hash_part
from bidlens.llm.shared import cut


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def of_usual_length(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has the length that most have (of equally frequent ones the shorter)."""
    sizes = df.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return df.where(F.size(vector) == (sizes["n"] if sizes else 0))


def sample(df: DataFrame, id: str, vector: str, most: int) -> np.ndarray:
    """About ``most`` vectors at random by the hash of their id (all, if there are fewer), ordered by id."""
    count = df.count()
    rows = df.where(hash_part(F.col(id)) < min(1.0, most / max(1, count))).select(id, vector).toArrow()
    if not rows.num_rows:
        return np.empty((0, 0))
    order = np.argsort(rows.column(0).to_numpy(), kind="stable")
    return matrix(rows.column(1).combine_chunks())[order]


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1)


def deal(base: DataFrame, asks: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Rows of both sides, such that within a value of ``keys`` each of ``base`` meets each of ``asks`` in one cell (keys, _b, _a).

    A side is dealt over as many parts as it has ``block`` rows (by the hash of
    column id), and each part goes to all parts of the other side: a hot key is
    spread over many cells of bounded size. Column _asks tells the sides apart.
    """
    parts = lambda side, name: side.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = cut(parts(base, "_nb").join(parts(asks, "_na"), keys), "cells")
    base, asks = base.join(sizes, keys), asks.join(sizes, keys)
    own = lambda n: F.pmod(F.xxhash64("id", F.lit(17)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = base.withColumns({"_b": own("_nb"), "_asks": F.lit(0)}).withColumn("_a", every("_na"))
    asks = asks.withColumns({"_a": own("_na"), "_asks": F.lit(1)}).withColumn("_b", every("_nb"))
    keyed = [*keys, "_b", "_a"]
    rows = base.drop("_nb", "_na").unionByName(asks.drop("_nb", "_na"))
    rows = rows.select(*keyed, "_asks", *[c for c in rows.columns if c not in (*keyed, "_asks")])
    return rows.repartition(*keyed).sortWithinPartitions(*keyed, "_asks", "id")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the first ``keys`` columns (integers), from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for v in values:
            change |= v[1:] != v[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            key = tuple(v[a] for v in values)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
