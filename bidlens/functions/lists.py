"""Order-keeping helpers for array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlens.functions import as_column, let, literal


def strings(values: list[str]) -> Column:
    """Literal ARRAY<STRING>, also when empty."""
    return literal(list(values), "array<string>")


def distinct_ci(arr: Column | str) -> Column:
    """Case-insensitive distinct that keeps the first spelling; drops blanks."""
    a = F.filter(F.transform(as_column(arr), lambda x: F.trim(x)), lambda x: x != "")

    def firsts(a: Column) -> Column:
        low = F.transform(a, lambda x: F.lower(x))
        return let(
            low,
            lambda keys: F.transform(
                F.array_distinct(keys), lambda k: F.get(a, F.array_position(keys, k).cast("int") - 1)
            ),
        )

    return let(a, firsts)


def present(*items: Column) -> Column:
    """The given STRING columns as an array, nulls left out."""
    return F.array_compact(F.array(*items)) if items else strings([])


def add_distinct(arr: Column | str, more: Column) -> Column:
    """Append what is not there yet."""
    return F.array_distinct(F.concat(as_column(arr), more))


def take(arr: Column | str, n: int) -> Column:
    return F.slice(as_column(arr), 1, n)
