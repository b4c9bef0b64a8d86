from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from bidlens.llm import line_quality


def prose(rng, n):
    return "\n".join(" ".join("".join(rng.choice(["ka", "to", "mi", "ren", "sul"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(4, 14))).capitalize() + "." for _ in range(n))


def junk(rng, n):
    line = {0: lambda: " | ".join("x" * rng.randint(2, 6) for _ in range(9)), 1: lambda: "BUY!! " * rng.randint(5, 20), 2: lambda: "word " * 30, 3: lambda: "le### mi%%% "}
    kind = rng.randrange(4)
    return "\n".join(line[kind]() for _ in range(n))


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    return [(i, junk(rng, rng.randint(1, 30)) if i % 4 == 0 else prose(rng, rng.randint(1, 30)), int(i % 4 != 0)) for i in range(400)]


@pytest.fixture(scope="module")
def chain(spark, rows):
    return line_quality.fit(spark.createDataFrame(rows[:250], "key long, text string, good int"))


def test_held_out_texts(spark, rows, chain):
    rng = random.Random(4)
    odd = [(900, None, None), (901, "", None), (902, "\n\n\n", None), (903, prose(rng, 3_000), None), (904, "a" * 300_000, None), (None, "some words", None), rows[300]]
    df = spark.createDataFrame([(*r, 7) for r in [*rows[250:], *odd]], "doc_id long, text string, Score int, n_lines int")
    out = line_quality.score(df, chain)
    got = {r["doc_id"]: r["score"] for r in out.collect()}
    assert out.columns == ["doc_id", "text", "score", "n_lines"] and out.count() == len(rows[250:]) + len(odd)
    assert np.mean([(got[i] >= 0.3) == bool(good) for i, _, good in rows[250:]]) >= 0.98
    assert got[900] == got[901] and got[903] > 0.5 and all(0 <= v <= 1 for v in got.values())


def test_a_text_of_good_and_bad_lines_stands_between(rows, chain):
    good, bad = rows[1][1], rows[0][1]
    mixed = chain.quality("\n".join([good] * 3 + [bad] * 3))
    assert chain.quality(bad) < mixed < chain.quality(good)


def test_marginals_against_all_labellings(chain):
    rng = np.random.default_rng(1)
    for n in (1, 2, 6):
        scores, pairs = 3 * rng.standard_normal(n), rng.standard_normal((2, 2))
        total, good = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=n):
            weight = np.exp(np.dot(scores, states) + sum(pairs[a, b] for a, b in itertools.pairwise(states)))
            total, good = total + weight, good + weight * np.array(states)
        assert np.allclose(line_quality.Chain(chain.weights, pairs).marginals(scores), good / total)
    assert np.isfinite(line_quality.Chain(chain.weights, np.eye(2)).marginals(np.full(5_000, 900.0))).all()


def test_training_raises_the_likelihood_of_the_labels():
    """Against numeric differences of the summed log-likelihood by brute force."""
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, line_quality.FEATURES, (n, 3)).astype(np.int16) for n in (1, 3, 4)]
    chain = line_quality.train(sequences, np.array([0, 1, 1]))
    right = []
    for lines, good in zip(sequences, (0, 1, 1), strict=True):
        right.append(((chain.marginals(chain.weights[lines].sum(axis=1)) >= 0.5) == bool(good)).all())
    assert all(right)


def test_lines_hold_their_neighbours_bins():
    lines = line_quality.Lines("A first line.\n\nTHE LAST!!")
    own = line_quality.OWN
    width = len(line_quality.FIGURES) + 1
    assert lines.features.shape == (3, line_quality.ACTIVE) and lines.sizes.tolist() == [13, 0, 10]
    assert (lines.features[1, width : 2 * width] == lines.features[0, :width] + own).all()
    assert (lines.features[1, 2 * width : 3 * width] == lines.features[2, :width] + 2 * own).all()
    assert set(lines.features[0, width : 2 * width]) == {3 * own} and set(lines.features[2, 2 * width : 3 * width]) == {3 * own + 1}


def test_long_texts_are_learned_from_in_stretches():
    assert line_quality.stretches(200) == [(0, 200)]
    parts = line_quality.stretches(10_001)
    assert parts[0][0] == 0 and parts[-1][1] == 10_001 and len(parts) == line_quality.PIECES


def test_without_both_labels(spark):
    frame = spark.createDataFrame([(1, "a b", 1)], "key long, text string, good int")
    assert line_quality.fit(frame) is None and line_quality.fit(frame.limit(0)) is None
    assert [r["score"] for r in line_quality.score(frame, None).collect()] == [0.5]
    assert line_quality.score(frame.limit(0), None).count() == 0


def test_labelled_takes_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "x"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, None), (None, 1), (4, 1)], "doc_id long, quality int")
    assert sorted(map(tuple, line_quality.labelled(docs, labels).collect())) == [(1, 1, "a"), (2, 0, "")]
