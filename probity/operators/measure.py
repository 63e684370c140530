"""The two shapes every scanning check compiles to.

``RowRule``  a row predicate; counted with ``count_if`` in the fused pass.
``Measure``  named aggregate expressions plus a function that turns the
             aggregated one-row values into the result fields.

Both are plain Column expressions, so any number of checks on one table fuse
into one ``agg`` (one scan, one tiny shuffle of partial aggregates).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class RowRule:
    """``missing``: the row is not judged (a null input).
    ``bad``: a judged row breaks the rule (null counts as not bad).
    ``all_rows``: judge every row, missing or not (not-null / null checks)."""

    missing: Column
    bad: Column
    all_rows: bool = False

    def to_measure(self) -> "Measure":
        bad = self.bad if self.all_rows else (~self.missing & self.bad)
        aggs = {
            "n": F.count(F.lit(1)),
            "miss": F.count_if(self.missing),
            "bad": F.count_if(bad),
        }
        all_rows = self.all_rows

        def result(g):
            judged = g("n") if all_rows else g("n") - g("miss")
            return {
                "element_count": g("n"),
                "missing_count": g("miss"),
                "unexpected_count": g("bad"),
                "judged": judged,
            }

        return Measure(aggs, result)


@dataclass
class Measure:
    aggs: dict[str, Column]
    result: Callable[[Callable[[str], Column]], dict[str, Column]]
    extra: dict = field(default_factory=dict)


def between(obs: Column, lo, hi, strict_min: bool = False, strict_max: bool = False) -> Column:
    """``lo <= obs <= hi`` with optional bounds; null observation fails."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((obs > F.lit(lo)) if strict_min else (obs >= F.lit(lo)))
    if hi is not None:
        cond = cond & ((obs < F.lit(hi)) if strict_max else (obs <= F.lit(hi)))
    return F.coalesce(cond & obs.isNotNull(), F.lit(False))


def any_null(cols: list[Column]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | c.isNull()
    return out


def all_null(cols: list[Column]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & c.isNull()
    return out
