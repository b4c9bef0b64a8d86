from __future__ import annotations

import random

import __spark_entry__
import corpus_pipeline

NAMES = ["language_id", "line_dedup", "near_dedup", "mixing", "byte_bpe"]


def test_stages(spark, tmp_path):
    """Each stage on what the one before kept, held against plain Python."""
    rng = random.Random(6)
    words = [f"w{rng.choice('aeiou')}{i}" for i in range(900)]
    long = "This shared line is long enough to be counted everywhere."
    rows = []
    for i in range(120):
        body = " ".join(rng.choice(words) for _ in range(80))
        rows.append((i, f"{body}\n{long}" if i % 10 == 0 else body, "en", f"s{i % 3}" if i % 7 else None))
    rows += [(200 + i, rows[i][1] + " end", "en", "s1") for i in range(5)] + [(300, None, None, None), (301, "12 !", "en", "s0"), (302, "", "en", "s0")]
    table = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != NAMES[-1]:
            assert docs.columns == table.columns
    assert {r["doc_id"] for r in seen["language_id"]} == {r[0] for r in rows} - {300, 301, 302}
    holders = sorted({r["doc_id"] for r in seen["language_id"] if r["text"].endswith(long)})
    assert len(holders) >= 5 and [r["doc_id"] for r in seen["line_dedup"] if long in r["text"].split("\n")] == [holders[-1]]
    assert {r["doc_id"] for r in seen["near_dedup"]} == {r["doc_id"] for r in seen["line_dedup"]} - {200, 201, 202, 203, 204}
    assert {r["doc_id"] for r in seen["mixing"]} <= {r["doc_id"] for r in seen["near_dedup"]}
    texts = {r["doc_id"]: r["text"] for r in seen["mixing"]}
    from bidlens.llm.queries import tokenizer

    encode = __import__("tiktoken").Encoding("own", pat_str=tokenizer(spark).pattern, mergeable_ranks=tokenizer(spark).ranks.value, special_tokens={}).encode_ordinary
    assert len(seen["byte_bpe"]) == len(seen["mixing"]) and all(r["ids"] == encode(texts[r["doc_id"]]) for r in seen["byte_bpe"])


def test_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in __spark_entry__.queries()
    assert {"op6_line_dedup", "op7_mixture", "op8_chat"} <= set(__spark_entry__.oracle_sql())
