"""Periodic runs of words: maximal stretches that repeat a shorter one, in whole texts.

Texts are handled in batches: the words of many texts become one array of
numbers with a separator of its own after each text, so that no match crosses a
text's end.

* Longest common extensions (``Extensions``): only suffixes at positions of a
  difference cover (COVER modulo MODULUS) are sorted, by blocks of MODULUS words
  and prefix doubling over the positions of one residue. For any two positions
  there is a shift below MODULUS that brings both into the cover; up to it words
  are compared directly, from there the answer is a range minimum over the
  sorted samples' common prefixes (sparse table).
* Runs (``find``): a run of period p and at least ``least(p)`` words holds
  least(p) - p words in a row that equal the word p further on, so it covers a
  point of the grid 0, g, 2g, ... of that spacing g. For every period the points
  of its grid are extended both ways; the grids of all periods together have
  n / 3 * log n points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from bidlens.llm.shared import unused

#: A perfect difference set: every remainder modulo MODULUS is the difference of two members.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Words of a batch of texts (a longer text is a batch of its own) and grid points handled at once.
WORDS, POINTS = 300_000, 1 << 20
EXPONENT, SHORTEST = 4, 6

_TYPE = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"


def _shifts() -> np.ndarray:
    """shift[a, b]: the least d with (a + d) and (b + d) both in the cover, modulo MODULUS."""
    out = np.full((MODULUS, MODULUS), -1, np.int64)
    for d in reversed(range(MODULUS)):
        at = [(c - d) % MODULUS for c in COVER]
        out[np.ix_(at, at)] = d
    return out


SHIFT = _shifts()


class Extensions:
    """Longest common extensions in an array of numbers. All pairs asked for must differ within the array."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        # Past the end stand numbers that occur once each, so that no comparison runs over it.
        top = int(words.max(initial=-1)) + 1
        self.words = np.concatenate([words, np.arange(top, top + 2 * MODULUS)]).astype(np.int32)
        self.place = np.full(n + MODULUS, -1, np.int32)
        sampled = [np.arange(c, n, MODULUS) for c in COVER]
        positions = np.concatenate(sampled)
        self._sort(positions, [len(x) for x in sampled])

    def _sort(self, positions: np.ndarray, sizes: list[int]) -> None:
        m = len(positions)
        blocks = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.words, MODULUS)[positions].astype(">i4"))
        rank, distinct = _ranks(blocks.view(np.dtype((np.void, 4 * MODULUS))).ravel())
        del blocks
        # Sample i's successor, MODULUS words on, is sample i + 1 of the same residue.
        last = np.repeat(np.cumsum(sizes), sizes)
        levels, step = [rank], 1
        while distinct < m:
            after = np.arange(m) + step
            inside = after < last
            following = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
            rank, distinct = _ranks(rank.astype(np.int64) * (m + 1) + following)
            levels.append(rank)
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.place[positions] = rank
        common = self._adjacent(positions, last, order, levels)
        self.table = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            below = self.table[-1]
            self.table.append(np.minimum(below[:-width], below[width:]))
            width *= 2

    def _adjacent(self, positions: np.ndarray, last: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of neighbours in the sorted order, from the levels of prefix doubling."""
        a, b = order[:-1].copy(), order[1:].copy()
        ends = last[np.stack([a, b])] if len(a) else np.empty((2, 0), np.int64)
        blocks = np.zeros(len(a), np.int64)
        open_ = np.ones(len(a), bool)
        for level in range(len(levels) - 1, -1, -1):
            rank = levels[level]
            x, y = np.minimum(a, len(rank) - 1), np.minimum(b, len(rank) - 1)
            same = open_ & (rank[x] == rank[y])
            step = 1 << level
            blocks += same * step
            a, b = a + same * step, b + same * step
            open_ &= (a < ends[0]) & (b < ends[1])  # beyond the last sample words are compared
        at, other = positions[order[:-1]] + blocks * MODULUS, positions[order[1:]] + blocks * MODULUS
        return blocks * MODULUS + self._compared(at, other, np.full(len(at), MODULUS))

    def _compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from a and b on, ``most`` of them at the most."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        for k in range(MODULUS):
            live = live[self.words[a[live] + k] == self.words[b[live] + k]]
            if not len(live):
                break
            out[live] += 1
            live = live[most[live] > k + 1]
        return out

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on (a <> b)."""
        shift = SHIFT[a % MODULUS, b % MODULUS]
        out = self._compared(a, b, shift)
        more = np.flatnonzero((out == shift) & (np.maximum(a, b) + shift < self.n))
        if len(more):
            x, y = self.place[a[more] + shift[more]], self.place[b[more] + shift[more]]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                at = level == k
                row = self.table[k]
                out[more[at]] += np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of the keys, and how many are distinct."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    dense = np.cumsum(new) - 1
    rank = np.empty(len(keys), np.int32)
    rank[order] = dense
    return rank, int(dense[-1]) + 1 if len(keys) else 0


def least(period: np.ndarray) -> np.ndarray:
    """The fewest words of a run of this period."""
    return np.maximum(SHORTEST, EXPONENT * period)


def grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(point, period) of all grids of all texts, at most about POINTS at once (or one text's period)."""
    longest = sizes // EXPONENT
    longest[sizes < SHORTEST] = 0
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    spacing = least(period) - period
    points = -(-(sizes[text] - period) // spacing)
    done, at = np.cumsum(points), 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + POINTS, side="right")))
        n = points[at:end]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[text[at:end]], n) + step * np.repeat(spacing[at:end], n), np.repeat(period[at:end], n)
        at = end


def find(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs, as rows (start in ``words``, length, period), by start and period.

    words: numbers of the words of all texts, one separator after each, which
    occurs once; starts, sizes: where each text stands.
    """
    ahead = back = None
    found = []
    for point, period in grid(starts, sizes):
        same = words[point] == words[point + period]
        point, period = point[same], period[same]
        if not len(point):
            continue
        if ahead is None:
            ahead, back = Extensions(words), Extensions(words[::-1])
        after = ahead.lce(point, point + period)
        # Mirrored, the words up to a point begin at n - 1 - point; the point itself counts once.
        before = back.lce(len(words) - 1 - point, len(words) - 1 - point - period) - 1
        # Of the grid points within one stretch the first alone reports it.
        hit = (after + before + period >= least(period)) & (before < least(period) - period)
        found.append(np.stack([point - before, after + before + period, period], axis=1)[hit])
    rows = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    # A stretch found by a multiple of its period is the same stretch: the smallest period stays.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def analysed(texts: list[bytes]) -> list[dict]:
    """Runs and collapsed text of each of a batch of texts."""
    split = [text.split() for text in texts]  # bytes split at ASCII white space alone
    codes: dict[bytes, int] = {}
    sizes = np.array([len(x) for x in split], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    words = np.empty(int(sizes.sum()) + len(split), np.int32)
    for start, part in zip(starts.tolist(), split, strict=True):
        words[start : start + len(part)] = [codes.setdefault(w, len(codes)) for w in part]
    words[starts + sizes] = np.arange(len(codes), len(codes) + len(split))
    runs = find(words, starts, sizes)
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(split) + 1))
    out = []
    for i, part in enumerate(split):
        mine = runs[bounds[i] : bounds[i + 1]] - np.array([starts[i], 0, 0])
        if len(mine):
            change = np.zeros(len(part) + 1, np.int64)
            np.add.at(change, mine[:, 0] + mine[:, 2], 1)
            np.add.at(change, mine[:, 0] + mine[:, 1], -1)
            part = [part[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]
        out.append({"n_words": int(sizes[i]), "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()], "collapsed": b" ".join(part).decode()})
    return out


def _batches(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > 5 * WORDS:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def repeated(text: Column) -> Column:
    """struct<n_words, runs array<struct<start, length, period>>, collapsed> of a whole text.

    Words are what stands between ASCII white space. A run is a stretch of words
    with smallest period q and at least max(SHORTEST, EXPONENT * q) words that
    cannot be extended; runs are ordered by start, then period. ``collapsed`` has
    the words outside runs and the first q words of each run (those that no other
    run drops), joined by one space. A null text is an empty one: no words, no runs.
    """
    result = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])

    @arrow_udf(_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for part in _batches(x.as_py() or b"" for x in batch):
                out += analysed(part)
            yield pa.array(out, result)

    return run(text.cast("binary"))


def with_runs(df: DataFrame, text: str = "text", n_words: str = "n_words", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``df`` with the number of words, the runs and the collapsed text of each row; columns of those names are replaced.

    Each row stands for itself: repeated rows have equal results, an empty table gives an empty one.
    """
    names = {"n_words": n_words, "runs": runs, "collapsed": collapsed}
    rest = [c for c in df.columns if c.lower() not in {x.lower() for x in names.values()}]
    both = unused(df, "_repeated")
    out = df.select(*rest, repeated(F.col(text)).alias(both))
    return out.select(*rest, *[F.col(both).getField(k).alias(v) for k, v in names.items()])


def planted(id: Column, text: Column) -> Column:
    """The text whose words the contract of the query repeats: for every tenth hash of an id, from word a on with period p.

    Other texts, and those of a null id, stay as they are.
    """
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(id.cast("string"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    cycles = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), cycles), " ")).otherwise(text)


def digests(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, n_runs, the longest run (start, length, period, exponent_milli) and the digests of runs and collapsed text."""
    out = with_runs(df.select(F.col(id).alias("id"), planted(F.col(id), F.col(text)).alias("text")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    length = -best["less"]
    return out.select(
        F.col("id").alias(id), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), length.alias("length"),
        best["period"].alias("period"), F.floor(1000 * length / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
