"""Contract SQL in other dialects, rewritten to Spark SQL.

Contracts carry MySQL / DuckDB style SQL.  Spark accepts most of it; the one
function the contracts use that Spark lacks is ``quantile(x, q)``, rewritten
to the exact discrete quantile ``percentile_disc(q) WITHIN GROUP (ORDER BY x)``.
"""

from __future__ import annotations

import re

_QUANTILE = re.compile(r"\bquantile(?:_disc)?\s*\(\s*([^,()]+?)\s*,\s*([0-9.]+)\s*\)", re.IGNORECASE)


def to_spark_sql(sql: str) -> str:
    sql = sql.strip().rstrip(";")
    return _QUANTILE.sub(lambda m: f"percentile_disc({m.group(2)}) WITHIN GROUP (ORDER BY {m.group(1)})", sql)


_ONE_QUANTILE = re.compile(r"^select\s+quantile(?:_disc)?\s*\(\s*([^,()]+?)\s*,\s*([0-9.]+)\s*\)(?:\s+(?:as\s+)?\w+)?\s+from\s+(.+)$", re.IGNORECASE | re.DOTALL)


def quantile_query(sql: str) -> tuple[str, float, str] | None:
    """(expression, share, the rest after FROM) of a query that is one quantile of all its rows, else None."""
    m = _ONE_QUANTILE.match(sql.strip().rstrip(";"))
    if m is None or re.search(r"\b(group\s+by|having|union|intersect|except|limit|order\s+by)\b", m[3], re.IGNORECASE):
        return None
    return m[1], float(m[2]), m[3]
