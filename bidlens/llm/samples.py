"""Bounded samples of labelled rows, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Part of an id's hash in [0, 1).
SCALE = 1 << 53


def hash_part(id: Column) -> Column:
    return F.shiftright(F.xxhash64(id.cast("string"), F.lit(5)), 11).cast("long") / F.lit(float(SCALE)) + F.when(F.xxhash64(id.cast("string"), F.lit(5)) < 0, 1.0).otherwise(0.0)


def bounded(rows: DataFrame, id: str, label: str, per_class: int, max_classes: int = 200) -> DataFrame:
    """About ``per_class`` rows of each label (all, if it has fewer), chosen by the hash of their id.

    Rows come by a threshold on the hash, label by label, so nothing is sorted and
    a label that most rows bear is no harder than another. Of more than
    ``max_classes`` labels the most frequent are kept. Null labels take no part.
    The result's size is bounded by per_class * max_classes, whatever the input's.
    """
    rows = rows.where(F.col(label).isNotNull())
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(max_classes).collect()
    if not counts:
        return rows.limit(0)
    rate = F.create_map(*[F.lit(x) for row in counts for x in (row[0], per_class / row[1])])
    return rows.where(hash_part(F.col(id)) < F.coalesce(F.element_at(rate, F.col(label)), F.lit(0.0)))
