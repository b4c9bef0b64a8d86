"""Language ID by a byte convolutional network.

Bytes (A-Z lowered) are embedded; filters of several widths slide over windows
of WINDOW bytes, each keeps its largest value in the window, and a softmax over
those gives the window's languages. A text's languages are the mean over all its
windows, by their bytes. The network is trained in numpy on windows of a bounded
sample of labelled texts (PER_LANGUAGE a language, WINDOWS windows of each at
most); it is applied to whole texts, in batches of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from bidlens.llm.samples import bounded
from bidlens.llm.shared import unused

WINDOW, BATCH = 256, 128
WIDTHS, FILTERS, EMBEDDED = (2, 3, 4), 16, 8
PER_LANGUAGE, WINDOWS, EPOCHS, STEPS = 1_200, 3, 8, 400
UNKNOWN = "und"


def windows(text: str) -> np.ndarray:
    """All of a text's bytes in rows of WINDOW, the last one filled with zeros."""
    data = np.frombuffer(text.encode().lower(), np.uint8)
    rows = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    rows.reshape(-1)[: len(data)] = data
    return rows


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDED; the filling byte 0 is no letter and has zeros
    filters: np.ndarray  # (widest * EMBEDDED) x all filters; narrower ones end in zeros
    bias: np.ndarray
    weights: np.ndarray  # all filters x languages
    offset: np.ndarray

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """For each place of each window, the embedded bytes under the widest filter."""
        x = self.embedding[rows]
        n, size = x.shape[0], WINDOW - max(WIDTHS) + 1
        step = x.strides
        view = np.lib.stride_tricks.as_strided(x, (n, size, max(WIDTHS) * EMBEDDED), (step[0], step[1], step[2]))
        return np.ascontiguousarray(view)

    def pooled(self, columns: np.ndarray) -> np.ndarray:
        n, size, width = columns.shape
        return (columns.reshape(-1, width) @ self.filters).reshape(n, size, -1)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(rows), BATCH):
            top = self.pooled(self.columns(rows[i : i + BATCH])).max(axis=1) + self.bias
            scores = np.maximum(top, 0) @ self.weights + self.offset
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            out.append(scores / scores.sum(axis=1, keepdims=True))
        return np.concatenate(out)


def train(rows: np.ndarray, labels: list[str], seed: int = 5) -> Network:
    """Adam on the cross-entropy of windows (n x WINDOW bytes), languages weighed alike. Deterministic for a given input."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    widest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest * EMBEDDED, total), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[: width * EMBEDDED, k * FILTERS : (k + 1) * FILTERS] = 1
    normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    net = Network(languages, normal(256, EMBEDDED) * 0.5, normal(widest * EMBEDDED, total) * 0.25 * mask, np.zeros(total, np.float32), normal(total, len(languages)) * 0.1, np.zeros(len(languages), np.float32))
    net.embedding[0] = 0
    weight = (len(y) / len(languages) / np.bincount(y, minlength=len(languages)))[y].astype(np.float32)
    names = ("embedding", "filters", "bias", "weights", "offset")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    epochs = max(EPOCHS, -(-STEPS // -(-len(rows) // BATCH)))  # few windows are seen more often
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            at = order[i : i + BATCH]
            data, columns = rows[at], net.columns(rows[at])
            values = net.pooled(columns)
            best = values.argmax(axis=1)  # n x filters
            raw = np.take_along_axis(values, best[:, None, :], axis=1)[:, 0] + net.bias
            hidden = np.maximum(raw, 0)
            scores = hidden @ net.weights + net.offset
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            error = scores / scores.sum(axis=1, keepdims=True)
            error[np.arange(len(at)), y[at]] -= 1
            error *= weight[at][:, None] / len(at)
            back = (error @ net.weights.T) * (raw > 0)
            taken = columns[np.arange(len(at))[:, None], best]  # n x filters x inputs: only the largest places learn
            inner = (back[:, :, None] * net.filters.T[None]).reshape(len(at), total, widest, EMBEDDED)
            embedding = np.zeros_like(net.embedding)
            for k in range(widest):
                np.add.at(embedding, np.take_along_axis(data, best + k, axis=1), inner[:, :, k])
            embedding[0] = 0
            grads = {"embedding": embedding, "filters": np.einsum("nf,nfi->if", back, taken) * mask, "bias": back.sum(axis=0), "weights": hidden.T @ error, "offset": error.sum(axis=0)}
            step += 1
            rate = 0.01 * (1 - epoch / epochs) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                setattr(net, k, (getattr(net, k) - rate * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(np.float32))
    return net


def fit(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Network | None:
    """A network trained on about ``per_language`` texts of each language of ``df``; None if no row has a language and letters.

    Of a text, WINDOWS windows at most are learned from: evenly spaced ones.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for key, name, value in batch.itertuples(index=False):
                if any(map(str.isalpha, value)):
                    rows = windows(value)
                    rows = rows[:-1] if len(rows) > 1 else rows  # a full window says more than a filled one
                    at = np.unique(np.linspace(0, len(rows) - 1, WINDOWS).round().astype(int))
                    out += [(key, name, int(i), rows[i].tobytes()) for i in at]
            yield pd.DataFrame(out, columns=["key", "lang", "at", "bytes"])

    chosen = bounded(df.select(F.col(id).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL AND key IS NOT NULL"), "key", "lang", per_language)
    rows = chosen.select("key", "lang", "text").mapInPandas(run, "key long, lang string, at int, bytes binary").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["lang", "key", "at", "bytes"], kind="stable")
    return train(np.frombuffer(b"".join(rows["bytes"]), np.uint8).reshape(-1, WINDOW), rows["lang"].tolist())


def predicted(text: Column, net: Network | None) -> Column:
    """struct<lang string, score double>: the likeliest language of all of the text and its probability.

    A null text, one without letters, and every text if there was nothing to learn
    from, is UNKNOWN with a score of 0. Ties go to the first language by name.
    """

    @arrow_udf("struct<lang string, score double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for item in batch:
                value = item.as_py()
                if net is None or value is None or not any(map(str.isalpha, value)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                rows = windows(value)
                sizes = np.full(len(rows), float(WINDOW))
                sizes[-1] = (rows[-1] != 0).sum() or 1
                mean = sizes @ net.probabilities(rows) / sizes.sum()
                names.append(net.languages[int(mean.argmax())])
                scores.append(float(min(1.0, mean.max())))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    return run(text)


def identify(df: DataFrame, net: Network | None, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its probability; columns of those names are replaced."""
    rest = [c for c in df.columns if c.lower() not in (lang.lower(), score.lower())]
    both = unused(df, "_predicted")
    out = df.select(*rest, predicted(F.col(text), net).alias(both))
    return out.select(*rest, F.col(both).getField("lang").alias(lang), F.col(both).getField("score").alias(score))
