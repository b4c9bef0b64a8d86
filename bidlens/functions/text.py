"""Text normalisation. Everything compared or matched goes through here first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlens.functions import as_column, let

# Characters NFKC leaves alone: ASCII, accented Latin-1 letters, the usual
# dashes, quotes and bullet, the rupee sign. Text made of these skips NFKC.
_MAY_CHANGE = "[^\\x00-\\x7F\\u00C0-\\u00FF\\u2010\\u2012-\\u2016\\u2018-\\u2023\\u20B9]"
_WS = "\\s\\x1C-\\x1F"
# Printable ASCII with single spaces needs no work but at its ends. A word at a time and without steps back.
_PLAIN = "\\A(?: ?+[\\x21-\\x7E]++)*+ ?\\z"
# A whitespace run that is not already one plain space.
_RUN = f"(?U)(?:[{_WS}&&[^ ]][{_WS}]*| [{_WS}]+)"
_NOT_WORD = f"(?U)[^\\p{{L}}\\p{{N}}_]+"
# The last two for text of one-byte characters.
_ASCII_RUN = "[\\t-\\r\\x1C-\\x1F][\\t-\\r\\x1C-\\x20]*+| [\\t-\\r\\x1C-\\x20]++"
_ASCII_NOT_WORD = "\\W++"


def nfkc(col: Column | str) -> Column:
    """NFKC in the JVM, through the ICU library that Spark ships."""
    def composed(c: Column) -> Column:
        done = F.java_method(
            F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True)
        )
        return F.when(c.rlike(_MAY_CHANGE), done).otherwise(c)

    return composed(as_column(col))


def clean(col: Column | str, normalise: bool = True) -> Column:
    """Unicode-normalise, drop zero-width spaces, collapse whitespace, trim.

    Null gives ''. ``normalise=False`` is for text that is NFKC already.
    """

    def tidy(c: Column) -> Column:
        worked = F.regexp_replace(F.translate(c, "\u00a0\u200b", " "), _RUN, " ")
        return F.trim(F.when(c.rlike(_PLAIN), c).otherwise(worked))

    c = F.coalesce(as_column(col), F.lit(""))
    if not normalise:
        return let(c, tidy)
    # Text of one-byte characters is NFKC already and holds no spaces but ASCII's.
    plain = let(c, lambda c: F.when(c.rlike(_PLAIN), F.trim(c)).when(one_byte(c), F.trim(F.regexp_replace(c, _ASCII_RUN, " "))))
    # NFKC stays outside the lambda: Spark pulls such calls out of grouping keys.
    return F.coalesce(plain, let(nfkc(c), tidy))


def one_byte(text: Column) -> Column:
    """Is every character of the text ASCII? Told by its length, without reading it as text."""
    return F.octet_length(text) == F.length(text)


def normalize_key(col: Column | str, normalise: bool = True) -> Column:
    """Lower-case form without punctuation, for comparing labels."""
    def key(c: Column) -> Column:
        low = F.lower(c)
        return F.trim(F.when(one_byte(c), F.regexp_replace(low, _ASCII_NOT_WORD, " ")).otherwise(F.regexp_replace(low, _NOT_WORD, " ")))

    return let(clean(col, normalise), key)


def strip_label(col: Column | str, label: str) -> Column:
    """Drop one leading ``label:`` (or ``label -``)."""
    return F.trim(
        F.regexp_replace(as_column(col), f"(?iU)^\\s*{escape(label)}\\s*[:\\-\u2013]\\s*", "")
    )


def truncate(col: Column | str, limit: int) -> Column:
    return let(
        as_column(col),
        lambda c: F.when(F.length(c) <= limit, c).otherwise(
            F.concat(F.rtrim(F.substring(c, 1, limit - 1)), F.lit("\u2026"))
        ),
    )


def snippet(text: Column | str, start: Column, width: int = 240) -> Column:
    """A quote around the 0-based position ``start``, with ellipses where cut."""
    t, half = as_column(text), width // 2

    def quote(at: Column) -> Column:
        lo = F.greatest(F.lit(0), at - half)
        hi = F.least(F.length(t), at + half)
        return F.concat(
            F.when(lo > 0, "\u2026").otherwise(""),
            clean(F.substring(t, lo + 1, hi - lo), normalise=False),
            F.when(hi < F.length(t), "\u2026").otherwise(""),
        )

    return let(start, quote)


def escape(literal: str) -> str:
    """Quote a literal for use inside a regex."""
    return "".join(ch if ch.isalnum() or ch in " _" else "\\" + ch for ch in literal)


def find(text: Column | str, pattern: str, group: int = 0) -> Column:
    """First match (or one of its groups); null where nothing matches."""
    # nullif alone would look for it twice where it stands in a branch.
    return let(F.regexp_extract(as_column(text), pattern, group), lambda m: F.nullif(m, F.lit("")))


def blank_to(*cols: Column | str) -> Column:
    """The first value that is neither null nor ''; '' if there is none."""
    return F.coalesce(*[F.nullif(as_column(c), F.lit("")) for c in cols], F.lit(""))
