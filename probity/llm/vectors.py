"""Blocks of vectors: many vectors of one length packed into a row of bytes, for array operations in tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """True for vectors that are not null and hold no null or non-finite component."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad, F.lit(False))
