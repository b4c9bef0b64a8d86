from __future__ import annotations

import numpy as np
import pytest

from bidlens.llm import learned_partitions, multi_index


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    points = np.concatenate([centres[rng.integers(0, 12, 900)] + 0.25 * rng.standard_normal((900, 16)), np.repeat(centres[:1], 60, 0), centres[1] + 0.02 * rng.standard_normal((40, 16))])
    rows = [(i, [float(x) for x in np.float32(p)], int(i % 3), "x") for i, p in enumerate(points)]
    odd = [(2000, None, 1, "x"), (2001, [0.0] * 16, 1, "x"), (2002, [float("nan")] + [1.0] * 15, 1, "x"), (2003, [None] + [1.0] * 15, 1, "x"), (2004, [1.0] * 3, 1, "x"), (2005, [], 1, "x"), (2006, rows[0][1], None, "x"), (None, rows[0][1], 0, "x"), rows[3]]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, size string"), rows


def test_links_against_brute_force(table):
    df, rows = table
    points = np.array([r[1] for r in rows])
    units = points / np.linalg.norm(points, axis=1)[:, None]
    labels = np.array([r[2] for r in rows])
    linked = (units @ units.T >= 0.93) & (labels[:, None] == labels[None])
    np.fill_diagonal(linked, False)
    root = np.arange(len(rows))
    while True:
        again = np.minimum(root, np.where(linked, root[None], len(rows)).min(axis=1, initial=len(rows)))
        if (again == root).all():
            break
        root = again
    got = {}
    for r in multi_index.near_vectors(df).collect():
        got[r["vec_id"]] = (r["n_links"], r["component_id"], r["kept"])
    assert {i: got[i] for i in range(len(rows))} == {i: (int(linked[i].sum()), int(root[i]), int(root[i]) == i) for i in range(len(rows))}
    assert all(got[i] == (0, i, True) for i in range(2000, 2007)) and got[None] == (0, None, True)
    assert multi_index.near_vectors(df.limit(0)).count() == 0


def test_traversal_visits_all_cells_within_reach_nearest_first():
    rng = np.random.default_rng(2)
    a, b = rng.random(9), rng.random(7)
    i, j = multi_index.visits(a, b, 0.8)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(x, y) for x in range(9) for y in range(7) if a[x] + b[y] <= 0.8}
    assert (np.diff(a[i] + b[j]) >= 0).all()


def test_bounds_are_never_above_the_distance():
    rng = np.random.default_rng(3)
    points, codes = rng.standard_normal((300, 6)), rng.standard_normal((9, 6))
    own, least = multi_index.bounds(points, codes)
    assert (least[:, own] <= multi_index.squares(points, points) + 1e-9).all()


def test_search_recall_and_order(table):
    df, rows = table
    out = learned_partitions.search(df, df.where("vec_id % 100 = 0"))
    found = {}
    for r in out.collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    points = {i: np.array(v) for i, v, *_ in rows} | {2006: np.array(rows[0][1])}  # a label is not needed here
    hits = total = 0
    for q in range(0, len(rows), 100):
        far = {i: float(np.sqrt(((v - points[q]) ** 2).sum())) for i, v in points.items()}
        want = sorted((far[i], i) for i in far if i != q)[:10]
        got = [found[q][k] for k in range(1, 11)]
        assert got == sorted(got) and all(abs(s - far[i]) < 1e-12 for s, i in got)
        hits, total = hits + len({i for _, i in want} & {i for _, i in got}), total + 10
    assert hits / total >= 0.9 and set(found) == set(range(0, len(rows), 100))


def test_search_of_few_rows(table, spark):
    df, _ = table
    few = df.where("vec_id IN (0, 1, 2, 2001)")
    assert [(r["query_id"], r["rank"]) for r in learned_partitions.search(few, few.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1), (0, 2)]
    assert learned_partitions.search(df.limit(0), df.limit(0)).count() == 0


def test_parts_are_balanced():
    rng = np.random.default_rng(5)
    points = rng.standard_normal((8, 4))[rng.integers(0, 8, 800)] * 4 + rng.standard_normal((800, 4))
    graph = learned_partitions.neighbour_graph(points, 5)
    part = learned_partitions.balanced_parts(graph, 8)
    assert np.bincount(part, minlength=8).max() <= 1.1 * 100 + 1
    assert (part[graph] == part[:, None]).mean() > 0.6
