"""Folds over short dense arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surviving(values: Column, most_drop: float = 0.25) -> Column:
    """An array with null where a value fell by over most_drop from a surviving value right before it.

    The comparison sees what was nulled before, so the value after a nulled one is kept as it is; a plain
    lag() would test it.
    """
    empty = F.expr("CAST(array() AS array<double>)")

    def step(out: Column, x: Column) -> Column:
        before = F.get(out, F.size(out) - 1)
        fell = x.isNotNull() & before.isNotNull() & (before > 0) & ((before - x) / before > most_drop)
        return F.concat(out, F.array(F.when(F.coalesce(fell, F.lit(False)), F.lit(None).cast("double")).otherwise(x)))

    return F.aggregate(values.cast("array<double>"), empty, step)


def last_present(values: Column) -> Column:
    """The last value that is not null, or null."""
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(-1))
