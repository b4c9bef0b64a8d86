"""Byte-level BPE encoding and decoding over whole texts, with the ranks of a public vocabulary.

Method: tokens, read as Latin-1 strings of their bytes, form an Aho-Corasick
automaton. A piece of text is covered from the left by the longest token at each
place; a token may follow another only if the two are what the merges make of
their joined bytes (a memoised test). Where no token fits, the walk steps back
and marks the place as closed, so each place is closed once at most and the work
is linear in the piece. A sequence whose neighbours are all compatible is the
one that merging by rank yields.

Null texts are encoded as empty ones; repeated rows are encoded alike; other
columns are kept as they are, and a column that already has the output's name
is replaced. Decoding unknown ids or null elements raises an error; null ids
decode to no bytes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from bidlens.llm.shared import Memory, unused

#: Unicode's White_Space property, which is what ``\s`` stands for in the tokenizers' patterns.
WHITE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Entries that a Python worker remembers: words with what adjoins them, pieces, pairs of tokens.
CHUNKS, PIECES, PAIRS = 200_000, 250_000, 200_000
#: Rows handled at once, so that a batch's texts, ids and bytes aren't all held.
ROWS = 500


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file (its size is the vocabulary's, whatever the input)."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """The plain merge loop: join the adjacent pair of lowest rank, leftmost first, until ``until`` parts are left.

    Only used on single tokens (of bounded length) and in tests.
    """
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > until:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
        if rank == 1 << 62:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Crossing(Exception):
    """White space meets white space at a chunk's edge, so the text can't be read chunk by chunk."""


class Encoder:
    """One vocabulary in a Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        spaced = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.split = regex.compile(spaced).findall
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            # A token that its own merges do not make can only be a whole piece.
            if len(token) < 3 or merged(token, ranks) == [token]:
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[bytes, bool], list[tuple[bytes, float]]] = {}
        self.pieces = Memory(lambda piece: array("i", self.encode_piece(piece.encode())).tobytes(), PIECES)
        self.chunks = Memory(self.encode_chunk, CHUNKS)

    def edge(self, token: bytes, right: bool) -> list[tuple[bytes, float]]:
        """What stands at the token's right (or left) edge while it is merged, each with the rank of the merge that ends it."""
        known = self.edges.get((token, right))
        if known is None:
            known = [(token, float("inf"))]
            if len(token) > 1:
                inner = merged(token, self.ranks, until=2)[1 if right else 0]
                known = [*self.edge(inner, right)[:-1], (inner, self.ranks[token]), *known]
            self.edges[token, right] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives the two tokens.

        Merges happen in the order of ranks, since a token's parts have lower ranks
        than the token. While both are built, the parts that meet must not merge
        with each other before one of them is merged further on its own side; of
        two equal pairs, the left one is merged first.
        """
        known = self.fits.get((left, right))
        if known is None:
            ours, theirs = self.edge(self.bytes_of[left], True), self.edge(self.bytes_of[right], False)
            i, j, known = 0, 0, True
            while known and (i < len(ours) and j < len(theirs)):
                (a, ends_a), (b, ends_b) = ours[i], theirs[j]
                across = self.ranks.get(a + b)
                known = across is None or across >= ends_a or across > ends_b
                i, j = (i + 1, j) if ends_a <= ends_b else (i, j + 1)
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def next_shorter(self, token: int) -> int | None:
        """The longest usable token that is a proper prefix of ``token``."""
        if token not in self.shorter:
            text = self.bytes_of[token].decode("latin-1")
            found = next((n for n in range(len(text) - 1, 0, -1) if text[:n] in self.automaton), 0)
            self.shorter[token] = self.automaton.get(text[:found]) if found else None
        return self.shorter[token]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, lengths, fits = len(piece), self.lengths, self.fits
        text, matches = piece.decode("latin-1"), self.automaton.iter_long
        ahead = matches(text)  # the longest token at each place, one after the other
        open_at = bytearray(b"\1") * (size + 1)
        tokens: list[int] = []
        last, place, token = None, 0, next(ahead)[1]
        while True:
            shortened = False
            while token is not None:
                end = place + lengths[token]
                if open_at[end]:
                    if last is None:
                        break
                    fit = fits.get((last, token))
                    if self.compatible(last, token) if fit is None else fit:
                        break
                token, shortened = self.next_shorter(token), True
            if token is None:  # nothing fits here after the last token: close the place and shorten that token
                open_at[place] = 0
                token = tokens.pop()
                last = tokens[-1] if tokens else None
                place -= lengths[token]
                ahead = None
                continue
            tokens.append(token)
            if end == size:
                return tokens
            last, place = token, end
            if shortened or ahead is None:
                ahead = matches(text, place)
            token = next(ahead)[1]

    def encode_pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode_chunk(self, chunk: str) -> bytes:
        """" " + chunk, for a chunk without a space that starts and ends with no other white space."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Crossing
        return self.encode_pieces(" " + chunk)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as 32-bit integers.

        Where single spaces stand between words, each space and word make pieces of
        their own, whatever stands around them, and a word's ids are remembered.
        """
        first, *chunks = text.split(" ")
        try:
            if first[-1:].isspace():
                raise Crossing
            return self.encode_pieces(first) + b"".join(map(self.chunks.__getitem__, chunks))
        except Crossing:
            return self.encode_pieces(text)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(ranks, pattern: str, key: str) -> Encoder:
    """The worker's encoder; a Python worker that Spark uses again keeps it."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks.value, pattern)
    return _ENCODERS[key]


def _slices(batch: pa.Array) -> Iterator[pa.Array]:
    return (batch.slice(i, ROWS) for i in range(0, len(batch), ROWS))


class Tokenizer:
    """Columns of token ids and of decoded bytes. The vocabulary (its file's size) is broadcast."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str):
        self.ranks = spark.sparkContext.broadcast(ranks)
        self.pattern = pattern
        self.key = f"{spark.sparkContext.applicationId}-{self.ranks._jbroadcast.id() if self.ranks._jbroadcast else id(ranks)}"

    def ids(self, text: Column) -> Column:
        """array<int>: the text's token ids, in order."""
        ranks, pattern, key = self.ranks, self.pattern, self.key

        @arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = _encoder(ranks, pattern, key)
            for batch in batches:
                for rows in _slices(batch):
                    found = [encoder.encode(x.as_py() or "") for x in rows]
                    ends = np.cumsum([0, *(len(x) // 4 for x in found)])
                    yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))

        return encode(text)

    def decoded(self, ids: Column) -> Column:
        """binary: the bytes that the ids stand for."""
        ranks = self.ranks

        @arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            token = {rank: token for token, rank in ranks.value.items()}.__getitem__
            for batch in batches:
                for rows in _slices(batch):
                    yield pa.array([b"".join(map(token, x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else ())) for x in rows], pa.binary())

        return decode(ids)

    def coded(self, text: Column) -> Column:
        """struct<ids array<int>, decoded binary>: the text's ids and the bytes that these ids decode to, in one pass of one worker."""
        ranks, pattern, key = self.ranks, self.pattern, self.key

        @arrow_udf("struct<ids array<int>, decoded binary>")
        def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = _encoder(ranks, pattern, key)
            token = encoder.bytes_of.__getitem__
            for batch in batches:
                for rows in _slices(batch):
                    found = [np.frombuffer(encoder.encode(x.as_py() or ""), np.int32) for x in rows]
                    ends = np.cumsum([0, *map(len, found)])
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                    yield pa.StructArray.from_arrays([ids, pa.array([b"".join(map(token, x.tolist())) for x in found], pa.binary())], names=["ids", "decoded"])

        return code(text)


def encode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of column ``text``."""
    return df.withColumn(ids, tokenizer.ids(F.col(text)))


def decode(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes of column ``ids``."""
    return df.withColumn(decoded, tokenizer.decoded(F.col(ids)))


def round_trip(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the token ids of column ``text`` and the bytes that they decode to: ``decode(encode(df))`` with one vocabulary a worker."""
    rest = [c for c in df.columns if c.lower() not in (ids.lower(), decoded.lower())]
    both = unused(df, "_coded")
    out = df.select(*rest, tokenizer.coded(F.col(text)).alias(both))
    return out.select(*rest, F.col(both).getField("ids").alias(ids), F.col(both).getField("decoded").alias(decoded))


def digests(df: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Per document: number of ids and the digests of ids and of the bytes they decode to."""
    df = round_trip(df.select("doc_id", "text"), tokenizer)
    return df.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
