"""Contract projections: PII masking (C27) and retention split."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mask_columns(df: DataFrame, columns: list[str], method: str = "sha256") -> DataFrame:
    """Replace PII columns by their SHA-256 hex digest (``method='sha256'``) or by
    Spark's character mask (``method='mask'``: letters -> X/x, digits -> n)."""
    cols = set(columns)

    def masked(c):
        if method == "mask":
            return F.mask(F.col(c).cast("string"))
        return F.sha2(F.col(c).cast("string"), 256)

    return df.select(*[(masked(c).alias(c) if c in cols else F.col(c)) for c in df.columns])


# Names of calendar units, as months or days.
_MONTHS = {"y": 12, "year": 12, "years": 12, "mo": 1, "month": 1, "months": 1}
_DAYS = {"d": 1, "day": 1, "days": 1, "w": 7, "week": 7, "weeks": 7}


def parse_period(text) -> tuple[int, int] | None:
    """``7 years``, ``6 months``, ``2 weeks``, ``90d``, or ISO ``P1Y6M``, ``P90D`` -> (months, days); None if it is none of them."""
    said = str(text or "").strip()
    iso = re.fullmatch(r"P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?", said, re.IGNORECASE)
    if iso and any(iso.groups()):
        y, m, w, d = (int(x or 0) for x in iso.groups())
        return 12 * y + m, 7 * w + d
    m = re.fullmatch(r"(\d+)\s*([A-Za-z]+)", said)
    unit = m[2].lower() if m else ""
    if unit in _MONTHS:
        return int(m[1]) * _MONTHS[unit], 0
    return (0, int(m[1]) * _DAYS[unit]) if unit in _DAYS else None


def retention_split(df: DataFrame, ts: str, as_of: str, years: int = 0, months: int = 0, days: int = 0) -> DataFrame:
    """Rows older than the retention period at ``as_of`` and rows kept, one pass."""
    dt = df.schema[ts].dataType.simpleString()
    cutoff = (F.lit(as_of).cast("timestamp_ntz") - F.make_ym_interval(F.lit(years), F.lit(months)) - F.make_dt_interval(F.lit(days))).cast(dt)
    return df.agg(
        F.count_if(F.col(ts) < cutoff).cast("long").alias("expired_rows"),
        F.count_if(F.col(ts) >= cutoff).cast("long").alias("kept_rows"),
    )


def retention_counts(tables: dict[str, DataFrame], contract, as_of: str | None) -> DataFrame | None:
    """The contract's own retention period over the table of its timestamp field: expired and kept rows at ``as_of``,
    status OK; or one row with status SKIPPED and the reason why they could not be counted.  None for a contract
    without a retention period."""
    if not contract.retention:
        return None
    levels = contract.raw.get("servicelevels") or contract.raw.get("serviceLevel") or contract.raw.get("serviceLevels") or {}
    retention, freshness = (levels.get(k) if isinstance(levels.get(k), dict) else {} for k in ("retention", "freshness"))
    table, _, column = str(retention.get("timestampField") or freshness.get("timestampField") or "").partition(".")
    period = parse_period(contract.retention)
    reason = (
        f"no calendar period: {contract.retention}" if period is None
        else "no as_of" if as_of is None
        else "no timestamp field" if not table
        else f"no such field: {table}.{column}" if table not in tables or column not in tables[table].columns
        else None
    )
    if reason:
        spark = next(iter(tables.values())).sparkSession
        ddl = "table_name string, column_name string, expired_rows long, kept_rows long, status string, reason string"
        return spark.createDataFrame([(table or None, column or None, None, None, "SKIPPED", reason)], ddl)
    counted = retention_split(tables[table], column, as_of, months=period[0], days=period[1])
    return counted.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "expired_rows", "kept_rows", F.lit("OK").alias("status"), F.lit(None).cast("string").alias("reason"))


def mask_contract_pii(tables: dict[str, DataFrame], contract, method: str = "sha256") -> dict[str, DataFrame]:
    """Every table with the PII fields its contract declares (``security.piiFields``
    or a field's ``pii`` flag) masked; a lazy projection, no extra pass."""
    out = {}
    for name, df in tables.items():
        cols = [c for c in contract.pii.get(name, []) if c in df.columns]
        out[name] = mask_columns(df, cols, method) if cols else df
    return out
