"""Matching a whole table of terms against text in one regex pass.

A term matches where neither neighbour is a letter or digit; its hyphens may be
written as hyphen, space or nothing. One look-ahead alternation, longest
spelling first, reads the longest term that starts at every word. A shorter
term that starts at the same word is contained in that spelling, so a literal
map from spelling to term numbers gives every term that occurs. The text is
scanned once, whatever the number of terms.

The text has to be cleaned and lower-cased.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlens.functions import as_column, literal
from bidlens.functions.text import escape


def spellings(term: str) -> list[str]:
    pieces = term.lower().split("-")
    return [
        pieces[0] + "".join(gap + piece for gap, piece in zip(gaps, pieces[1:]))
        for gaps in product(("-", " ", ""), repeat=len(pieces) - 1)
    ]


def alternation(literals: list[str]) -> str:
    """Regex alternation, longest first; what several literals begin with is written once.

    Where they begin with many characters, a look at the next one leaves a few branches to try.
    """
    heads = _by_head(set(literals) - {""})
    few = [heads[i:i + _BRANCHES] for i in range(0, len(heads), _BRANCHES)]
    if len(few) < 2:
        return "|".join(tree for _, tree in heads)
    return "|".join(f"(?=[{''.join(escape(h) for h, _ in some)}])(?:{'|'.join(tree for _, tree in some)})" for some in few)


#: First characters that are told apart one by one.
_BRANCHES = 6


def _by_head(literals: set[str]) -> list[tuple[str, str]]:
    """The first characters, each with the regex of the literals that begin with it."""
    by_head: dict[str, set[str]] = {}
    for text in literals:
        by_head.setdefault(text[0], set()).add(text[1:])
    return [(head, escape(head) + _tree(tails)) for head, tails in sorted(by_head.items())]


def _tree(tails: set[str]) -> str:
    """Regex of what may follow, longest first."""
    branches = [tree for _, tree in _by_head(tails - {""})]
    if not branches:
        return ""
    if "" in tails:
        return f"(?:{'|'.join(branches)})?"
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def word(body: str) -> str:
    return f"(?<![a-z0-9])(?:{body})(?![a-z0-9])"


def spaced(text: Column | str) -> Column:
    """The text behind a space, so that a character stands before every word of it (see ``begins``)."""
    return F.concat(F.lit(" "), as_column(text))


def begins(body: str) -> str:
    """``body`` behind a character that is no letter or digit, for ``spaced`` texts: that is told faster than a look back at every place."""
    return f"[^a-z0-9]{body}(?![a-z0-9])"


@dataclass(frozen=True)
class TermTable:
    """An ordered list of terms; a term's number is its place in the list."""

    terms: tuple[str, ...]
    pattern: str = field(init=False)
    contained: dict[str, list[int]] = field(init=False)

    def __post_init__(self) -> None:
        texts = [s for t in self.terms for s in spellings(t)]
        object.__setattr__(
            self, "pattern", f"[^a-z0-9](?=({alternation(texts)})(?![a-z0-9]))"
        )
        matchers = [
            re.compile(word("|".join(re.escape(s) for s in spellings(t)))) for t in self.terms
        ]
        object.__setattr__(
            self,
            "contained",
            {s: [i for i, m in enumerate(matchers) if m.search(s)] for s in texts},
        )

    def numbers(self, text: Column | str) -> Column:
        """Numbers of the terms that occur, ascending."""
        # A map is searched entry by entry, so there is one for each first character.
        heads = sorted({s[0] for s in self.contained})
        lookup = literal({h: {s: n for s, n in self.contained.items() if s[0] == h} for h in heads}, "map<string,map<string,array<int>>>")
        found = F.array_distinct(
            F.regexp_extract_all(spaced(text), F.lit(self.pattern), F.lit(1))
        )
        # sort_array compares natively; array_sort calls a comparator for every pair.
        return F.sort_array(
            F.array_distinct(F.flatten(F.transform(found, lambda s: F.element_at(F.element_at(lookup, F.left(s, F.lit(1))), s))))
        )

    def occurs(self, text: Column | str) -> Column:
        """Does any of the terms occur?"""
        texts = [s for t in self.terms for s in spellings(t)]
        return spaced(text).rlike(begins(f"(?:{alternation(texts)})"))

    def names(self, numbers: Column) -> Column:
        terms = literal(self.terms, "array<string>")
        return F.transform(numbers, lambda i: F.get(terms, i))
