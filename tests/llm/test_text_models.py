from __future__ import annotations

import random

import numpy as np

from bidlens.llm import language, toxicity
from bidlens.llm.samples import bounded

SYLLABLES = {"en": ("the", "th", "ing", "on", "er"), "de": ("sch", "ein", "ung", "ü", "ich"), "fr": ("eau", "é", "oi", "que", "ch")}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_on_held_out_texts(spark, docs):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.randint(5, 150)), lang, "s") for i, lang in enumerate(["en", "de", "fr"] * 60)]
    frame = docs(*rows)
    net = language.fit(frame.where("doc_id < 120"))
    odd = docs((500, None, None, None), (501, "", None, None), (502, "12 34 -- !!", None, None), (503, text(rng, "de", 30_000), None, None), (503, "x", None, None))
    out = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"], r["size"]) for r in language.identify(frame.where("doc_id >= 120").union(odd), net).collect()}
    right = [out[r[0], r[1]][0] == r[2] for r in rows[120:]]
    assert np.mean(right) >= 0.95
    assert all(v[0] == "und" and v[1] == 0 for k, v in out.items() if k[0] in (500, 501, 502))
    assert next(v for k, v in out.items() if k[0] == 503 and len(k[1]) > 9)[0] == "de"
    assert all(0 <= v[1] <= 1 and v[2] == "x" for v in out.values())


def test_language_without_labels(docs):
    frame = docs((1, "some words", None, "s"))
    assert language.fit(frame) is None and language.fit(frame.limit(0)) is None
    assert [r["lang_pred"] for r in language.identify(frame, None).collect()] == ["und"]


def test_windows_hold_every_byte():
    for size in (0, 1, 255, 256, 257, 5_000):
        rows = language.windows("a" * size)
        assert (rows != 0).sum() == size and rows.shape[1] == language.WINDOW


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        words = text(rng, "en", rng.randint(5, 200)).split()
        if i % 5 == 0:
            words[rng.randrange(len(words))] = rng.choice(["Nastyone!", "vilething", "NASTYONES", "vilest"])
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.where("doc_id < 450"))
    odd = spark.createDataFrame([(900, None, None), (901, "", None), (902, "vilething " + "the " * 40_000, 1)], "doc_id long, text string, toxic int")
    out = {r["doc_id"]: r["score"] for r in toxicity.score(frame.where("doc_id >= 450").union(odd), model).collect()}
    assert np.mean([(out[i] >= 0.5) == bool(t) for i, _, t in rows[450:]]) >= 0.97
    assert out[900] == out[901] < 0.5 and 0 <= out[902] <= 1


def test_toxicity_without_both_labels(spark):
    frame = spark.createDataFrame([(1, "a b", 0)], "doc_id long, text string, toxic int")
    assert [r["score"] for r in toxicity.score(frame, toxicity.fit(frame)).collect()] == [0.5]


def test_bounded_sample(spark):
    frame = spark.createDataFrame([(i, "a" if i % 100 else "b") for i in range(20_000)], "id long, label string")
    counts = {r["label"]: r["count"] for r in bounded(frame, "id", "label", 500).groupBy("label").count().collect()}
    assert counts["b"] == 200 and 400 < counts["a"] < 600
