from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from bidlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def ours(ranks):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    return lambda text: np.frombuffer(encoder.encode(text), np.int32).tolist()


@pytest.fixture(scope="module")
def theirs(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_every_kind_of_character(ours, theirs):
    for point in [*range(0x3100), *range(0x3100, 0x110000, 97)]:
        if not 0xD800 <= point < 0xE000:
            text = f"a{chr(point)}b {chr(point)} "
            assert ours(text) == theirs(text), hex(point)


def test_random_texts(ours, theirs):
    rng = random.Random(4)
    for alphabet in ("aab  \n\t1é'sA漢😀", "ab", " \n", "th e an"):
        for _ in range(400):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))
            assert ours(text) == theirs(text), text


def test_long_pieces(ours, theirs):
    for text in ("a" * 100_000, "ab" * 20_000, " " * 5_000, "\n" * 5_000):
        assert ours(text) == theirs(text)


def test_compatibility_is_what_merging_gives(ranks):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng, tokens = random.Random(2), [t for t, r in ranks.items() if t.decode("latin-1") in encoder.automaton]
    for _ in range(20_000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        assert encoder.compatible(ranks[a], ranks[b]) == (bpe.merged(a + b, ranks) == [a, b])


def test_columns(spark, ranks, theirs):
    texts = [None, "", "Hello  world\n", "x" * 70_000, "Hello  world\n"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    tokenizer = bpe.Tokenizer(spark, ranks, public_tokenizers.PATTERN)
    out = bpe.decode(bpe.encode(df, tokenizer), tokenizer).orderBy("doc_id").collect()
    assert [r["ids"] for r in out] == [theirs(t or "") for t in texts]
    assert [bytes(r["decoded"]) for r in out] == [(t or "").encode() for t in texts]
    once = bpe.round_trip(df, tokenizer).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["ids"], r["decoded"]) for r in once] == [(r["doc_id"], r["ids"], r["decoded"]) for r in out]
    assert bpe.digests(df.limit(0), tokenizer).count() == 0
