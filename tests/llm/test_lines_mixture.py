from __future__ import annotations

import duckdb
import pytest

from bidlens.llm import lines, mixture

LINE = "This line stands in many documents and is long enough."


def test_lines_cases(spark, docs):
    rows = [(i, f" {LINE.upper() if i % 2 else LINE}\t\nown {i}\n", "en", "s") for i in range(6)]
    rows += [(10, None, None, None), (11, "", "en", "s"), (None, f"{LINE}\nx", "en", "s"), (5, rows[5][1], "en", "s"), (12, LINE[:39], "en", "s")]
    out = lines.drop_repeated_lines(docs(*rows))
    got = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_dropped"], r["kept"], r["size"]) for r in out.collect()}
    assert got[0, rows[0][1]] == (3, 1, "own 0\n", "x")
    assert got[5, rows[5][1]] == (3, 0, rows[5][1], "x")  # the largest id keeps it
    assert got[10, None] == (1, 0, "", "x") and got[11, ""] == (1, 0, "", "x")
    assert got[None, f"{LINE}\nx"][1] == 0 and out.count() == len(rows)
    assert lines.drop_repeated_lines(docs(*rows).limit(0)).count() == 0


def test_same_id_with_other_texts(spark, docs):
    rows = [(i, LINE, "en", "s") for i in range(5)] + [(0, f"a\n{LINE}\nb", "en", "s")]
    got = sorted(r["kept"] for r in lines.drop_repeated_lines(docs(*rows)).where("doc_id = 0").collect())
    assert got == ["", "a\nb"]


def test_lines_against_sql(spark, docs):
    rows = [(i, "\n".join(f"{'common' if j % 3 else 'rare'} line number {i % (j + 1)} with a good many words in it" for j in range(9)), "en", "s") for i in range(60)]
    frame = docs(*rows)
    documents = frame.toPandas()  # noqa: F841
    assert sorted(map(tuple, lines.digests(frame).collect())) == sorted(duckdb.sql(lines.SQL).fetchall())


@pytest.mark.parametrize("sources", [["a", "b", None], ["x"] * 20 + ["y"], ["only"]])
def test_mixture_against_sql(spark, docs, sources):
    rows = [(i, " ".join(["w"] * (i * 7 % 40)), "en", sources[i % len(sources)]) for i in range(400)] + [(1000, None, "en", "a"), (1001, "", None, None)]
    frame = docs(*rows)
    documents = frame.toPandas().astype({"source": object})  # noqa: F841
    documents["source"] = documents["source"].where(documents["source"].notna(), None)
    got = sorted(map(tuple, mixture.taken(frame).collect()))
    assert got == sorted(duckdb.sql(mixture.SQL).fetchall())
    taken = {}
    for _, size, source_size, target, words in got:
        assert words <= 3 * size and target <= 3 * source_size + 1e-6
        taken[source_size, target] = taken.get((source_size, target), 0) + words
    for (_, target), words in taken.items():
        assert abs(words - target) <= 40


def test_the_mix_repeats_rows(spark, docs):
    rows = [(i, "a b c", "en", "s" if i else None) for i in range(30)]
    frame = docs(*rows)
    plan = {r["id"]: r["copies"] for r in mixture.plan(frame).collect()}
    counts = {r["doc_id"]: r["n"] for r in mixture.mix(frame).drop("n").groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    assert counts == {k: v for k, v in plan.items() if v}
    assert mixture.mix(frame.limit(0)).count() == 0 and mixture.mix(frame).columns == frame.columns
