"""Exact integer k-means whose distances come from dictionaries of subvectors.

Vectors are turned into integers (floor(SCALE * x)) and packed once into chunks
of up to CHUNK vectors. In a chunk each block of neighbouring dimensions is
replaced, without loss, by a code into the dictionary of the distinct subvectors
that the chunk holds there. A round computes the squared distance of every
dictionary entry to the block's part of every centroid once, and a vector's
distances are the sums of those partial distances by its codes. Blocks start one
dimension wide and are joined with their neighbour as long as the joined
dictionary stays below 1 / SHARE of the chunk's vectors, so repeated vectors and
subvectors are measured once.

Chunks never move: a round is one pass over the packed table that leaves counts
and sums of each cluster (k x length rows after Spark's partial aggregation),
the only thing that reaches the driver besides the k centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.shared import cut

SCALE, CHUNK, SHARE = 256, 4096, 4
#: Integers beyond this could make a squared distance leave 64 bits.
LARGEST = 1 << 27

PACKED = "ids array<long>, width array<int>, dictionaries binary, codes binary"


@dataclass
class Blocks:
    """Vectors as codes into one dictionary for each block of dimensions."""

    dictionaries: list[np.ndarray]  # distinct subvectors x width
    codes: np.ndarray  # blocks x vectors

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distances, centroids x vectors."""
        out = np.zeros((len(centroids), self.codes.shape[1]), np.int64)
        at = 0
        for entries, code in zip(self.dictionaries, self.codes, strict=True):
            part = centroids[:, at : at + entries.shape[1]]
            table = ((part[:, None, :] - entries[None]) ** 2).sum(axis=2)
            out += table[:, code]
            at += entries.shape[1]
        return out

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of each cluster's vectors: entries are counted by cluster, then weighed."""
        out = []
        for entries, code in zip(self.dictionaries, self.codes, strict=True):
            counts = np.bincount(cluster * len(entries) + code, minlength=k * len(entries)).reshape(k, -1)
            out.append(counts @ entries)
        return np.concatenate(out, axis=1)


def encode(rows: np.ndarray) -> Blocks:
    """The dictionaries and codes of integer vectors; they hold exactly what ``rows`` holds."""
    blocks = []
    for column in rows.T:
        entries, code = np.unique(column, return_inverse=True)
        blocks.append((entries[:, None], code))
    joining = True
    while joining and len(blocks) > 1:
        joining, merged = False, []
        for left, right in zip(blocks[::2], [*blocks[1::2], None][: len(blocks[::2])], strict=True):
            if right is None:
                merged.append(left)
                continue
            pairs, code = np.unique(left[1] * len(right[0]) + right[1], return_inverse=True)
            if len(pairs) * SHARE <= len(rows):
                a, b = np.divmod(pairs, len(right[0]))
                merged.append((np.concatenate([left[0][a], right[0][b]], axis=1), code))
                joining = True
            else:
                merged += [left, right]
        blocks = merged
    return Blocks([entries for entries, _ in blocks], np.array([code for _, code in blocks], np.int64).reshape(len(blocks), len(rows)))


def packed(ids: list, rows: np.ndarray) -> dict:
    blocks = encode(rows)
    return {
        "ids": ids, "width": [x for entries in blocks.dictionaries for x in entries.shape],
        "dictionaries": b"".join(entries.astype("<i4").tobytes() for entries in blocks.dictionaries),
        "codes": blocks.codes.astype("<u2").tobytes(),
    }


def unpacked(row: dict) -> Blocks:
    numbers, dictionaries, at = np.frombuffer(row["dictionaries"], "<i4").astype(np.int64), [], 0
    for n, width in zip(row["width"][::2], row["width"][1::2], strict=True):
        dictionaries.append(numbers[at : at + n * width].reshape(n, width))
        at += n * width
    return Blocks(dictionaries, np.frombuffer(row["codes"], "<u2").astype(np.int64).reshape(len(dictionaries), -1))


def integers(df: DataFrame, vector: str, length: int) -> DataFrame:
    """Rows whose vector has ``length`` components, none null or non-finite, with column _q: floor(SCALE * x) of each."""
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < LARGEST))
    return df.where((F.size(vector) == length) & finite).withColumn("_q", whole)


def pack(rows: DataFrame) -> DataFrame:
    """(id, _q) rows as packed chunks, where they stand: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_pylist([packed(part.column(0).to_pylist(), values)], schema)

    schema = pa.schema([("ids", pa.list_(pa.int64())), ("width", pa.list_(pa.int32())), ("dictionaries", pa.binary()), ("codes", pa.binary())])
    return rows.mapInArrow(run, PACKED)


def seeds(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors whose sha256 of "<salt>:<id>" is smallest (all, if fewer), in that order; of one id's vectors the smaller first."""
    first = rows.where("id IS NOT NULL").select(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).alias("h"), "_q").orderBy("h", "_q").limit(k)
    return np.array([r["_q"] for r in first.collect()], np.int64)


def nearest(blocks: Blocks, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, for each vector."""
    found = blocks.distances(centroids)
    cluster = found.argmin(axis=0)
    return cluster, found[cluster, np.arange(found.shape[1])]


def moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floor(sum / count) of each component; a cluster without vectors stays."""
    k, length = centroids.shape
    shipped = chunks.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, length), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                blocks = unpacked(row)
                cluster, _ = nearest(blocks, shipped.value)
                counts += np.bincount(cluster, minlength=k)
                sums += blocks.sums(cluster, k)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = chunks.drop("ids").mapInArrow(run, "cluster int, n long, sums array<long>")
    wide = F.posexplode("sums").alias("at", "value")
    total = parts.select("cluster", "n", wide).groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in total.collect():  # k x length rows, whatever the input's size
        out[r["cluster"], r["at"]] = int(r["value"]) // r["n"]
    shipped.unpersist()
    return out


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    shipped = chunks.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cluster, distance = nearest(unpacked(row), shipped.value)
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["id", "cluster", "distance"])

    return chunks.mapInArrow(run, "id long, cluster int, distance long")


def cluster(df: DataFrame, id: str = "vec_id", vector: str = "embedding", length: int = 64, k: int = 40, rounds: int = 5, salt: str = "2") -> DataFrame:
    """Clusters of all vectors of ``length`` components: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    One row for each row whose vector has exactly ``length`` components, none null
    or non-finite (the others have no row; neither have vectors with a component of
    2 ** 19 or more, whose distances leave 64 bits). Repeated rows and several
    vectors of one id each count. Rows with a null id are clustered, but start no
    centroid. With fewer than ``k`` vectors there are as many clusters as vectors;
    an empty table gives an empty result. Other columns of ``df`` are not used.
    """
    rows = integers(df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("_v")), "_v", length).select("id", "_q")
    chunks = cut(pack(rows), "chunks")
    centroids = seeds(rows, k, salt)
    if not len(centroids):  # without vectors with an id there is nothing to start from
        none = rows.where("false").selectExpr("id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
        return none.withColumnRenamed("id", id)
    for _ in range(rounds):
        centroids = moved(chunks, centroids)
    found = cut(assigned(chunks, centroids), "assigned")
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    sizes = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    named = df.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string").join(sizes, "cluster")
    total = F.broadcast(sizes.agg(F.sum("cluster_inertia").alias("inertia")))
    out = found.join(F.broadcast(named.crossJoin(total)), "cluster")  # k rows
    return out.select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(length: int = 64, k: int = 40, rounds: int = 5, salt: str = "2") -> str:
    """The same for DuckDB: one table of centroids after another, vectors against centroids component by component."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q FROM embeddings
  WHERE len(embedding) = {length} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {length})""",
        "cells AS MATERIALIZED (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS dim FROM kept)",
        f"first AS (SELECT q, row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < {k})",
        "c0 AS MATERIALIZED (SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS dim FROM first)",
    ]
    for i in range(rounds + 1):
        steps.append(f"d{i} AS (SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM cells v JOIN c{i} c USING (dim) GROUP BY ALL)")
        steps.append(f"a{i} AS MATERIALIZED (SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)")
        if i < rounds:
            steps.append(f"s{i} AS (SELECT cluster, dim, sum(x) AS s, count(*) AS n FROM a{i} JOIN cells USING (vec_id) GROUP BY ALL)")
            floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cluster, dim, CASE WHEN s IS NULL THEN c.x ELSE {floor} END AS x FROM c{i} c LEFT JOIN s{i} USING (cluster, dim))")
    return f"""WITH {', '.join(steps)},
digests AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN digests USING (cluster)"""
