from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from bidlens.llm import runs


def brute_force(words):
    """All runs, by comparing every word with the one a period further on, and the words that stay."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    listed = sorted(((s, size, q) for (s, size), q in found.items()), key=lambda r: (r[0], r[2]))
    gone = {k for s, size, q in listed for k in range(s + q, s + size)}
    return listed, " ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(rng, n, kinds):
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    if words and rng.random() < 0.7:
        a, p = rng.randrange(n), 1 + n // rng.randint(3, 30)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_every_shift_brings_both_positions_into_the_cover():
    for a in range(runs.MODULUS):
        for b in range(runs.MODULUS):
            d = runs.SHIFT[a, b]
            assert 0 <= d < runs.MODULUS and {(a + d) % runs.MODULUS, (b + d) % runs.MODULUS} <= set(runs.COVER)


@pytest.mark.parametrize("kinds", [1, 2, 3, 40])
def test_extensions_against_comparison(kinds):
    rng = np.random.default_rng(kinds)
    words = rng.integers(0, kinds, 500).astype(np.int32)
    words[200:400] = words[:200]
    ext = runs.Extensions(words)
    a, b = rng.integers(0, 500, (2, 3000))
    a, b = a[a != b], b[a != b]
    want = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        k = 0
        while max(x, y) + k < 500 and words[x + k] == words[y + k]:
            k += 1
        want.append(k)
    assert ext.lce(a, b).tolist() == want


def test_runs_against_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        texts = [repetitive(rng, rng.choice([0, 1, 5, 6, 7, 30, 150, 500]), rng.choice([1, 2, 3, 12])) for _ in range(rng.randint(1, 6))]
        texts += texts[:1]
        for words, got in zip(texts, runs.analysed([" ".join(t).encode() for t in texts]), strict=True):
            listed, collapsed = brute_force(words)
            assert [tuple(r.values()) for r in got["runs"]] == listed
            assert (got["n_words"], got["collapsed"]) == (len(words), collapsed)


def test_grids_in_pieces_find_the_same(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(repetitive(rng, 400, 2)).encode() for _ in range(5)]
    whole = runs.analysed(texts)
    monkeypatch.setattr(runs, "POINTS", 50)
    assert runs.analysed(texts) == whole


def contract(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    listed, collapsed = brute_force(words)
    best = min(listed, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if listed else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(listed), *best, milli, sha("".join(f"{s},{size},{q}\n" for s, size, q in listed)), sha(collapsed)


def test_query_rows_against_brute_force(spark, docs):
    rng = random.Random(7)
    rows = [(i, " ".join(repetitive(rng, rng.choice([0, 3, 9, 60, 200]), rng.choice([1, 3, 500]))), "en", "s") for i in range(400)]
    odd = [(900, None, None, None), (901, "", None, None), (902, " \t\x0b\x0c\r\n", None, None), (903, "a b a b \x1c x\x85y " * 6, None, None),
           (904, "é ü " * 20_000, None, None), (None, "b " * 30, None, None), rows[3]]
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)
    got = sorted(((r["doc_id"] is None, r["doc_id"], *r[1:]) for r in runs.digests(docs(*rows, *odd)).collect()), key=str)
    want = sorted(((r[0] is None, r[0], *contract(r[0], r[1])) for r in [*rows, *[o for o in odd if o[0] != 904]]), key=str)
    long = [g for g in got if g[1] == 904]
    assert [g for g in got if g[1] != 904] == want
    assert long[0][2] >= 1 and long[0][4] <= 40_000


def test_columns_are_replaced_and_others_kept(spark):
    df = spark.createDataFrame([(1, "a " * 8, "mine", 5)], "id int, text string, Runs string, _repeated int")
    out = runs.with_runs(df)
    assert out.columns == ["id", "text", "_repeated", "n_words", "runs", "collapsed"]
    row = out.first()
    assert (row["_repeated"], row["n_words"], row["collapsed"]) == (5, 8, "a") and [tuple(r) for r in row["runs"]] == [(0, 8, 1)]
    assert runs.with_runs(df.limit(0)).count() == 0
