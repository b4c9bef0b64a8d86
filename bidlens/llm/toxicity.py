"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the n-grams (SIZES bytes, within words and with their
ends marked) that it holds, hashed into FEATURES. Each is scaled by how much
more often toxic than other texts hold it (Wang and Manning 2012); a logistic
regression on the scaled features is fitted on a bounded sample of labelled
texts (PER_CLASS of each label) and applied to whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from bidlens.llm.samples import bounded

SIZES, FEATURES = (3, 4, 5), 1 << 18
PER_CLASS, ROUNDS, PENALTY, SMOOTH = 1_500, 120, 1e-2, 5
#: Texts whose features are weighed at once (numbered by a byte).
GROUP = 100
EDGES = ".,;:!?\"'()[]{}<>*-_/\\"


def word_features(words: list[str]) -> np.ndarray:
    """The features of all n-grams within words; a line feed marks a word's start and end."""
    data = np.frombuffer(("\n" + "\n".join(words) + "\n").encode(), np.uint8).astype(np.uint32)
    edge = data == 10
    found = []
    for n in SIZES:
        size = len(data) - n + 1
        if size < 1:
            continue
        value, inner = np.full(size, n, np.uint32), np.zeros(size, bool)
        for k in range(n):
            value = (value ^ data[k : k + size]) * np.uint32(16_777_619)  # FNV-1a
            if 0 < k < n - 1:
                inner |= edge[k : k + size]
        value = value[~inner]
        found.append((value ^ (value >> np.uint32(15))) % np.uint32(FEATURES))
    return np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)


class Reader:
    """A Python worker's view of texts as features."""

    def __init__(self):
        self.last = np.zeros(FEATURES, np.int32)

    def features(self, text: str | None) -> np.ndarray:
        """The distinct features of a whole text."""
        words = {word.strip(EDGES) for word in set((text or "").lower().split())}
        found = word_features(list(words)) if words else np.empty(0, np.int32)
        places = np.arange(len(found), dtype=np.int32)
        self.last[found] = places  # of equal features, the last place stays
        return found[self.last[found] == places]


def train(features: np.ndarray, sizes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the features and the offset. features: of all texts one after the other; sizes, toxic (0 or 1): of each text."""
    toxic = toxic.astype(np.float64)
    # Groups of texts, so that what is computed for each feature of each text stays small; the features themselves are never copied.
    groups, ends = [], np.cumsum(sizes)
    for i in range(0, len(sizes), GROUP):
        part = sizes[i : i + GROUP]
        groups.append((slice(i, i + len(part)), features[ends[i] - sizes[i] : ends[i + len(part) - 1]], np.repeat(np.arange(len(part), dtype=np.uint8), part)))
    # Smoothed by SMOOTH texts dealt to the labels by their sizes: an n-gram that few texts hold has a ratio near 1.
    held = [SMOOTH * part.mean() + sum(np.bincount(index, weights=part[at][owner], minlength=FEATURES) for at, index, owner in groups) for part in (toxic, 1 - toxic)]
    ratio = (np.log(held[0] / toxic.sum()) - np.log(held[1] / (1 - toxic).sum())).astype(np.float32)
    w, offset = np.zeros(FEATURES, np.float32), 0.0
    balance = np.where(toxic == 1, 0.5 / max(1.0, toxic.sum()), 0.5 / max(1.0, (1 - toxic).sum()))
    first, second, low, high = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        grad, slope, scaled = np.zeros(FEATURES), 0.0, w * ratio
        for at, index, owner in groups:
            score = np.bincount(owner, weights=scaled[index], minlength=at.stop - at.start) + offset
            error = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - toxic[at]) * balance[at]
            grad += np.bincount(index, weights=error[owner], minlength=FEATURES)
            slope += error.sum()
        grad = grad * ratio + PENALTY * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        low, high = 0.9 * low + 0.1 * slope, 0.999 * high + 0.001 * slope**2
        rate = 0.05 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
        w -= (rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
        offset -= rate * low / (high**0.5 + 1e-8)
    return (w * ratio).astype(np.float32), float(offset)


def fit(df: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The classifier learned from about ``per_class`` rows of label 0 and of label 1; other labels take no part.

    Without rows of both labels, every score is 0.5.
    """

    @arrow_udf("binary")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader()
        for batch in batches:
            yield pa.array([reader.features(x.as_py()).tobytes() for x in batch], pa.binary())

    rows = df.select(F.col(id).alias("key"), F.col(toxic).cast("int").alias("toxic"), F.col(text).alias("text")).where("toxic IN (0, 1) AND key IS NOT NULL")
    rows = bounded(rows, "key", "toxic", per_class).select("key", "toxic", read("text").alias("f"))
    found = rows.toArrow()
    toxic, order = found["toxic"].to_numpy(), np.lexsort((found["toxic"].to_numpy(), found["key"].to_numpy()))
    if len(set(toxic.tolist())) < 2:
        return np.zeros(FEATURES, np.float32), 0.0
    sizes = pc.binary_length(found["f"]).to_numpy().astype(np.int64)[order] // 4
    features = np.empty(int(sizes.sum()), np.int32)
    end = 0
    for i, n in zip(order.tolist(), sizes.tolist(), strict=True):
        features[end : end + n] = np.frombuffer(found["f"][i].as_buffer(), np.int32)
        end += n
    del found
    return train(features, sizes, toxic[order])


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Texts with a label. The labels are sampled first (to per_class of each), so few texts are joined."""
    one = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").join(F.broadcast(bounded(one, "doc_id", "toxic", per_class)), "doc_id")


def scored(text: Column, model: tuple[np.ndarray, float]) -> Column:
    """double from 0 to 1: how likely the text is toxic. Null and empty texts get the offset's score."""
    shipped = SparkSession.active().sparkContext.broadcast(model)  # FEATURES numbers, whatever the input

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader, (weights, offset) = Reader(), shipped.value
        for batch in batches:
            sums = np.array([weights[reader.features(x.as_py())].sum(dtype=np.float64) for x in batch]) + offset
            yield pa.array(1 / (1 + np.exp(-np.clip(sums, -50, 50))), pa.float64())

    return run(text)


def score(df: DataFrame, model: tuple[np.ndarray, float], text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with each whole text's score; a column of that name is replaced."""
    return df.withColumn(name, scored(F.col(text), model))
