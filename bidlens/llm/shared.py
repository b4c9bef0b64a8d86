"""Helpers of this folder: written tables in the shared folder, components, text bytes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.session import new_folder

#: ASCII white space, as the contracts name it: space and tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: no lineage, only the columns that are used.

    Unlike a cached or locally checkpointed table, it outlives any executor.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of the map that ``sieve`` broadcasts: at most 262,144 words of 64, whatever the table's size.
SIEVE = 1 << 24


def sieve(rows: DataFrame, keys: DataFrame, column: str = "id") -> DataFrame:
    """Rows of ``rows`` whose ``column`` may be among those of ``keys``: none that is gets lost, a few others pass.

    What passes is joined exactly afterwards; the rest, mostly wide rows that no
    one asks for, is not shuffled for it. The map of hashed keys has a fixed
    number of bits; the fuller it is, the more rows pass.
    """
    place = F.pmod(F.xxhash64(column), F.lit(SIEVE))
    word, bit = F.shiftright(place, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("_bit")
    known = keys.select(word, bit).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    marked = rows.select("*", word, bit).join(F.broadcast(known), "_word")
    return marked.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*rows.columns)


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name = f"_{name}{uuid.uuid4().hex[:4]}"
    return name


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words between ASCII white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(column: Column, modulus: int) -> Column:
    """crc32 of an id's decimal text modulo ``modulus``; null ids count as remainder -1."""
    return F.coalesce(F.crc32(column.cast("string")) % modulus, F.lit(-1))


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """Connected components of undirected ``links`` (a long, b long): rows (node, component), the smallest node of each.

    Alternating rounds of large-star and small-star (Kiveris et al. 2014): every
    node hands the smallest neighbour it knows to its larger, then to its smaller
    neighbours, until all links point at a component's smallest node. Minima are
    partial aggregates, so a hub that a third of all links touch shrinks before
    the shuffle, and the joins on it may be split. Each round is written to the
    shared folder. Nodes without links have no row.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = cut(pairs.distinct(), name)
    before = None
    while True:
        # Large-star: both directions; larger neighbours are tied to the smallest one.
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct(), name)
        # Small-star: a node's smaller neighbours, and itself, are tied to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        pairs = cut(small.where("a <> b").distinct(), name)
        state = pairs.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h"), F.count_distinct("a").alias("d")).first()
        if state == before and state["n"] == state["d"] or state["n"] == 0:
            break
        before = state
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))


class Memory(dict):
    """What ``make`` gives for a short string, as bytes; of ``limit`` entries, those used lately stay."""

    def __init__(self, make: Callable[[str], bytes], limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit // 2:
                self.older = self.copy()
                self.clear()
            self[key] = value
        return value
