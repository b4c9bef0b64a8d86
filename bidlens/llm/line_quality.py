"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line speaks through binned figures of its
characters and words and those of the lines before and after it (``Lines``); the
chain adds what follows what. It is fitted on a bounded sample of labelled texts
(PER_CLASS of each label, of very long ones PIECES stretches of STRETCH lines),
whose label all their lines bear. A text's score is the mean of its lines'
marginal probability to be good, by forward-backward over all lines and weighted
by their lengths.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from bidlens.llm.samples import bounded

PER_CLASS, PIECES, STRETCH = 1_500, 4, 50
ROUNDS, PENALTY = 150, 1e-3
#: Upper ends of the bins of a share; one more holds what lies above.
SHARES = np.array([0.0, 0.01, 0.03, 0.08, 0.2, 0.4, 0.7, 0.99])
BINS = len(SHARES) + 1
#: Figures of a line, each BINS wide; the last one is a pair of them.
FIGURES = ("length", "letters", "upper", "digits", "marks", "symbols", "word_length", "distinct", "marked_words", "lone_symbols", "endings", "again")
OWN = BINS * len(FIGURES) + BINS * BINS
#: Own, previous and next line's bins, the text's two ends and one that always holds.
FEATURES, ACTIVE = 3 * OWN + 3, 3 * (len(FIGURES) + 1) + 1

LETTER, UPPER, DIGIT, SPACE, MARK, SYMBOL = 1, 2, 4, 8, 16, 32
_MARKS = ".,;:!?'\"()-’“”«»¿¡"


def _kind(c: str) -> int:
    if c.isalpha():
        return LETTER | (UPPER if c.isupper() else 0)
    return DIGIT if c.isdigit() else SPACE if c.isspace() else MARK if c in _MARKS else SYMBOL


KINDS = np.array([_kind(chr(i)) for i in range(0x3000)], np.uint8)


def kinds(text: str) -> np.ndarray:
    """What each character is; beyond the table all count as letters."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(points < len(KINDS), KINDS[np.minimum(points, len(KINDS) - 1)], LETTER).astype(np.uint8)


def figures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x figures from 0 to 1, characters of each line)."""
    lines = text.split("\n")
    kind = kinds(text + "\n")
    sizes = np.array([len(x) for x in lines], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    count = lambda hit: np.add.reduceat(hit, starts, dtype=np.int64)
    chars = np.maximum(sizes, 1)
    letters = count((kind & LETTER) > 0)
    odd = (kind & (MARK | SYMBOL)) > 0
    space = (kind & SPACE) > 0
    before, after = np.concatenate([[True], space[:-1]]), np.concatenate([space[1:], [True]])
    twice = np.concatenate([[False], odd[:-1]])
    words = np.maximum(count(~space & before), 1)
    seen = Counter(lines)
    out = np.stack([
        np.minimum(1, np.log2(1 + sizes) / 14), letters / chars, count((kind & UPPER) > 0) / np.maximum(letters, 1), count((kind & DIGIT) > 0) / chars,
        count((kind & MARK) > 0) / chars, count((kind & SYMBOL) > 0) / chars, np.minimum(1, (sizes - count(space) + 1) / words / 20),
        np.array([len(set(x.split())) for x in lines]) / words, count(odd & twice & after) / words, count(odd & before & after) / words,
        count(odd & after & ~twice & ~before) / words, np.array([1 - 1 / seen[x] for x in lines]),
    ], axis=1)
    return out, sizes


class Lines:
    """A text's lines as numbers of the features that hold (lines x ACTIVE) and their lengths."""

    def __init__(self, text: str | None):
        values, self.sizes = figures(text or "")
        bins = np.searchsorted(SHARES, values, side="left")
        own = np.concatenate([bins + BINS * np.arange(len(FIGURES)), (BINS * len(FIGURES) + bins[:, :1] * BINS + bins[:, FIGURES.index("distinct")][:, None])], axis=1)
        none = np.full((1, own.shape[1]), -1)
        before, after = np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none])
        ends = np.array([3 * OWN, 3 * OWN + 1])
        before = np.where(before < 0, ends[0], before + OWN)
        after = np.where(after < 0, ends[1], after + 2 * OWN)
        always = np.full((len(own), 1), 3 * OWN + 2)
        self.features = np.concatenate([own, before, after, always], axis=1).astype(np.int16)


def stretches(n: int) -> list[tuple[int, int]]:
    """The lines learned from: all, or of longer texts PIECES stretches of STRETCH lines, evenly spaced from first to last."""
    if n <= PIECES * STRETCH:
        return [(0, n)]
    return [(int(a), int(a) + STRETCH) for a in np.linspace(0, n - STRETCH, PIECES).round()]


@dataclass
class Chain:
    """Weights of the features for state good (bad has none), and of each pair of neighbouring states [before, after]."""

    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """P(good) of every line of one text, from the lines' scores; states' messages are kept as log-odds, so nothing underflows."""
        (bb, bg), (gb, gg) = self.pairs.tolist()

        def passed(x: float, to_bad: float, to_good: float, from_bad: float, from_good: float) -> float:
            # log of (e^x e^from_good->good + e^bad->good) over the same towards bad
            up, down = x + from_good, x + from_bad
            good = max(up, to_good) + math.log1p(math.exp(-abs(up - to_good)))
            bad = max(down, to_bad) + math.log1p(math.exp(-abs(down - to_bad)))
            return good - bad

        ahead, message = [], 0.0
        values = scores.tolist()
        for s in values:
            ahead.append(message + s)
            message = passed(ahead[-1], bb, bg, gb, gg)
        back, message = [0.0] * len(values), 0.0
        for i in range(len(values) - 1, -1, -1):
            back[i] = message
            message = passed(message + values[i], bb, gb, bg, gg)
        return 1 / (1 + np.exp(-np.clip(np.array(ahead) + np.array(back), -500, 500)))

    def quality(self, text: str | None) -> float:
        """Mean of the lines' P(good), weighted by their characters; of a text without characters, its one or more empty lines' mean."""
        lines = Lines(text)
        good = self.marginals(self.weights[lines.features].sum(axis=1))
        sizes = lines.sizes if lines.sizes.any() else np.ones(len(good))
        return float(min(1.0, max(0.0, good @ sizes / sizes.sum())))


def train(sequences: list[np.ndarray], good: np.ndarray) -> Chain:
    """Adam on the conditional log-likelihood of the lines' labels, labels weighed alike. Deterministic for a given input.

    sequences: lines x ACTIVE each; good: 0 or 1 for each.
    """
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    sizes = np.array([len(sequences[i]) for i in order])
    y = good[order].astype(np.float64)
    features = np.concatenate([sequences[i] for i in order]).astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    weight = np.where(y == 1, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum())) / sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # Line t of all sequences that have one: they are the first ones, as the longest stand first.
    live = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(int(sizes[0]))]
    params = np.zeros(FEATURES + 4)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, ROUNDS + 1):
        w, pairs = params[:FEATURES], params[FEATURES:].reshape(2, 2)
        scores = w[features].sum(axis=1)
        emission = np.stack([np.zeros(len(scores)), scores], axis=1)
        ahead, back = emission.copy(), np.zeros_like(emission)
        for t in range(1, len(live)):
            at = starts[: live[t]] + t
            ahead[at] += np.logaddexp.reduce(ahead[at - 1][:, :, None] + pairs[None], axis=1)
        total = np.logaddexp.reduce(ahead[starts + sizes - 1], axis=1)
        grad_pairs = np.zeros((2, 2))
        for t in range(len(live) - 1, 0, -1):
            at = starts[: live[t]] + t
            after = (emission[at] + back[at])[:, None, :] + pairs[None]
            back[at - 1] = np.logaddexp.reduce(after, axis=2)
            both = np.exp(ahead[at - 1][:, :, None] + after - total[: live[t], None, None])
            grad_pairs += np.einsum("n,nij->ij", weight[: live[t]], both)
        grad_pairs[0, 0] -= (weight * (sizes - 1))[y == 0].sum()
        grad_pairs[1, 1] -= (weight * (sizes - 1))[y == 1].sum()
        error = (np.exp(ahead[:, 1] + back[:, 1] - total[owner]) - y[owner]) * weight[owner]
        grad = np.concatenate([np.bincount(features.ravel(), weights=np.repeat(error, features.shape[1]), minlength=FEATURES), grad_pairs.ravel()])
        grad += PENALTY * params
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        params = params - 0.05 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Chain(params[:FEATURES].astype(np.float32), params[FEATURES:].reshape(2, 2))


def labelled(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """(key, text, good) of a bounded sample of labelled rows: the labels are sampled first, so few texts are joined.

    Of several labels of an id the larger counts, of several texts the smallest; labels other than 0 and 1 take no part.
    """
    one = labels.select(F.col(id).cast("long").alias("key"), F.col(quality).cast("int").alias("good")).where("good IN (0, 1) AND key IS NOT NULL")
    one = bounded(one.groupBy("key").agg(F.max("good").alias("good")), "key", "good", per_class)
    found = docs.select(F.col(id).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(one), "key")
    return found.groupBy("key", "good").agg(F.min("text").alias("text"))


def fit(rows: DataFrame) -> Chain | None:
    """The chain learned from (key, text, good); None without rows of both labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, good, text in zip(batch["key"].to_pylist(), batch["good"].to_pylist(), batch["text"], strict=True):
                lines = Lines(text.as_py()).features
                parts = stretches(len(lines))
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * len(parts), pa.int64()), pa.array([good] * len(parts), pa.int32()), pa.array([a for a, _ in parts], pa.int32()),
                    pa.array([lines[a:b].tobytes() for a, b in parts], pa.binary()),
                ], ["key", "good", "at", "lines"])

    found = rows.select("key", "good", "text").mapInArrow(run, "key long, good int, at int, lines binary").toArrow()
    found = found.sort_by([("key", "ascending"), ("at", "ascending")])
    good = found["good"].to_numpy()
    if len(set(good.tolist())) < 2:
        return None
    return train([np.frombuffer(x.as_py(), np.int16).reshape(-1, ACTIVE) for x in found["lines"]], good)


def scored(text: Column, chain: Chain | None) -> Column:
    """double from 0 to 1: the quality of the whole text; 0.5 for all if there is no chain. A null text is an empty one."""
    shipped = SparkSession.active().sparkContext.broadcast(chain)  # FEATURES numbers, whatever the input

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([0.5 if shipped.value is None else shipped.value.quality(x.as_py()) for x in batch], pa.float64())

    return run(text)


def score(df: DataFrame, chain: Chain | None, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with each whole text's quality; a column of that name is replaced. Repeated rows score alike, an empty table stays empty."""
    return df.withColumn(name, scored(F.col(text), chain))
