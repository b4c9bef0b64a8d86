"""Column functions: text, dates, money, term matching, identity, wording."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def literal(value: object, ddl: str) -> Column:
    """A whole list or map as one foldable expression; the optimizer makes it a constant."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
