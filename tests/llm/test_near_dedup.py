from __future__ import annotations

import random

import pytest

from bidlens.llm import chosen_path
from bidlens.llm.shared import components, sieve


def brute(rows, words, percent):
    """Components over ids by all pairs of full shingle sets."""
    sets = {}
    for doc, text in rows:
        tokens = (text or "").encode().lower().split()
        width = min(words, len(tokens))
        sets[doc] = {tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1)} if tokens else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def corpus(rng, groups, size, edits):
    words = [f"w{i}" for i in range(3_000)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize(("words", "percent", "edits"), [(3, 85, 4), (5, 80, 3)])
def test_groups_against_brute_force(spark, words, percent, edits):
    rng = random.Random(words)
    rows = corpus(rng, 40, 4, edits) + [(1000 + i, t) for i, t in enumerate(["", None, "one", "one two", "ONE\ttwo", "one two three four five"])]
    out = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=words, percent=percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect()}
    assert got == brute(rows, words, percent)


def test_a_group_that_stays_large(spark):
    """More near copies than a node takes, some of which are only near each other."""
    rng = random.Random(9)
    rows = corpus(rng, 1, 150, 3) + [(1000 + d, t) for d, t in corpus(random.Random(10), 5, 3, 2)]
    out = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect()}
    assert got == brute(rows, 3, 85)


def test_odd_rows(spark, docs):
    text = " ".join(f"t{i}" for i in range(50_000))
    rows = [(3, text, "en", "s"), (2, text + " end", "en", "s"), (None, text, "en", "s"), (7, "same here", None, None), (7, "same here", None, None), (9, None, "en", "s")]
    out = chosen_path.near_duplicates(docs(*rows))
    got = sorted(out.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got] == [(2, 2, True), (3, 2, False), (7, 7, True), (7, 7, True), (9, 9, True), (None, None, True)]
    assert chosen_path.near_duplicates(docs(*rows).limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(0, rng.randint(1, 60)) for _ in range(50)]
    pairs = chain + star + [(200, 201), (201, 200), (300, 300)]
    root = {x: x for p in pairs for x in p}
    for _ in range(len(root)):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k != 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shuffled(spark):
    """Bytes that the session's stages have written for shuffles so far."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
    none = gateway.jvm.java.util.ArrayList()
    stages = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_without_candidates_are_not_shuffled(spark, tmp_path):
    rng = random.Random(12)
    rows = [(d, " ".join(f"{rng.getrandbits(64):x}" for _ in range(600))) for d in range(300)]
    rows += [(1000 + d, t + " end") for d, t in rows[:5]]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to be broadcast
    try:
        before = shuffled(spark)
        got = {r["doc_id"]: r["component_id"] for r in chosen_path.near_duplicates(spark.read.parquet(path), words=3, percent=85).collect()}
        moved = shuffled(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {d: d % 1000 for d, _ in rows}
    assert 0 < moved < sum(len(t) for _, t in rows) / 4


def test_sieve_keeps_all_keys(spark):
    rows, keys = spark.range(20_000), spark.range(0, 20_000, 40)
    passed = {r["id"] for r in sieve(rows, keys).collect()}
    assert passed >= set(range(0, 20_000, 40)) and len(passed) < 600
    assert sieve(rows, keys.limit(0)).count() == 0


def test_groups_of_several_trees_are_one(spark):
    """Cells that share documents are one up to GROUP documents; a larger chain stays in its cells."""
    chain = [(1000 + k, 2 * k + i, 2 * k) for k in range(60) for i in range(3)]
    cells = spark.createDataFrame([(7, 501, 501), (7, 502, 501), (8, 502, 502), (8, 503, 502), *chain], "cell long, id long, least long")
    got = {(r["cell"], r["id"]) for r in chosen_path.gathered(cells).collect()}
    assert got == {(501, 501), (501, 502), (501, 503)} | {(c, d) for c, d, _ in chain}


def test_an_id_repeated_without_text(spark):
    text = " ".join(f"t{i}" for i in range(200))
    rows = [(1, text), (2, text + " end"), (2, None), (2, "")]
    out = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    assert got == [(1, 198, 1), (2, 0, 2), (2, 0, 2), (2, 199, 1)]
