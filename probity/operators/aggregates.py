"""Column-aggregate checks (max, mean, quantiles, row counts ...) for the fused pass.

Exact medians / quantiles are resolved beforehand by radix selection
(``operators.quantiles``); pass ``exact=False`` to use ``percentile_approx`` (a
fixed-size sketch in the fused pass).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.checks import Check
from probity.operators.measure import Measure, between


def _quantile(c: Column, q: float, chk: Check) -> Column:
    return F.percentile_approx(c, F.lit(float(q)), int(chk.p("accuracy", 10000)))


def rank_requests(chk: Check) -> list[tuple[str, object]]:
    """Exact order statistics a check needs, resolved before the fused pass by
    ``quantiles.select_ranks`` (bounded memory at any scale)."""
    from probity.operators import quantiles as Q

    if not chk.p("exact", True):
        return []
    if chk.kind == "column_median_to_be_between":
        return [(chk.column, *Q.MEDIAN)]
    if chk.kind == "column_quantile_values_to_be_between":
        qr = chk.p("quantile_ranges") or {}
        qs = qr.get("quantiles", chk.p("quantiles"))
        return [(chk.column, *Q.disc(float(q))) for q in qs]
    return []


def _bounded(agg_fn):
    """observed = agg(column); success = observed within [min_value, max_value]."""

    def build(chk: Check, df: DataFrame, tables, prepared=None) -> Measure:
        c = df[chk.column]
        numeric = isinstance(df.schema[chk.column].dataType, T.NumericType)
        # non-numeric columns (dates, timestamps, strings) compare in their own type;
        # observed_value is reported for numeric columns only
        aggs = {"n": F.count(F.lit(1)), "miss": F.count_if(c.isNull())}
        if prepared is None:
            aggs["obs"] = _exact_sum(c, df.schema[chk.column].dataType) if agg_fn is _sum else agg_fn(c, chk)

        def result(g):
            obs = g("obs") if prepared is None else F.lit(prepared).cast("double")
            return {
                "element_count": g("n"),
                "missing_count": g("miss"),
                "observed_value": obs.cast("double") if numeric else None,
                "success": between(
                    obs, chk.p("min_value"), chk.p("max_value"), chk.p("strict_min", False), chk.p("strict_max", False)
                ),
            }

        return Measure(aggs, result)

    return build


def _sum(c, chk):
    return F.sum(c)


def _exact_sum(c: Column, dtype: T.DataType) -> Column:
    """Integers add up as decimals: no overflow ends the suite."""
    return F.sum(c.cast("decimal(38,0)") if isinstance(dtype, T.IntegralType) else c)


def _median(c, chk):
    # exact medians are resolved beforehand (rank_requests); this is the sketch path
    return F.percentile_approx(c, F.lit(0.5), int(chk.p("accuracy", 10000)))


def _proportion_non_null(chk, df, tables, prepared=None):
    c = df[chk.column]
    aggs = {"n": F.count(F.lit(1)), "miss": F.count_if(c.isNull())}

    def result(g):
        obs = F.try_divide((g("n") - g("miss")).cast("double"), g("n"))
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "observed_value": obs,
            "success": between(obs, chk.p("min_value"), chk.p("max_value")),
        }

    return Measure(aggs, result)


def _quantiles(chk, df, tables, prepared=None):
    """Each quantile must fall in its range; unexpected_count = quantiles outside."""
    c = df[chk.column]
    qr = chk.p("quantile_ranges") or {}
    qs = qr.get("quantiles", chk.p("quantiles"))
    ranges = qr.get("value_ranges", chk.p("value_ranges"))
    aggs = {"n": F.count(F.lit(1)), "miss": F.count_if(c.isNull())}
    if prepared is None:
        for i, q in enumerate(qs):
            aggs[f"q{i}"] = _quantile(c, q, chk).cast("double")

    def result(g):
        def qv(i):
            return g(f"q{i}") if prepared is None else F.lit(prepared[i]).cast("double")

        bad = F.lit(0)
        for i, (lo, hi) in enumerate(ranges):
            bad = bad + F.when(between(qv(i), lo, hi), 0).otherwise(1)
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "unexpected_count": bad.cast("long"),
            "unexpected_percent": (F.lit(100.0) * bad / F.lit(len(ranges))),
            "success": bad == 0,
        }

    return Measure(aggs, result)


def _row_count(equal: bool):
    def build(chk, df, tables, prepared=None):
        aggs = {"n": F.count(F.lit(1))}

        def result(g):
            obs = g("n").cast("double")
            ok = (g("n") == F.lit(int(chk.p("value")))) if equal else between(obs, chk.p("min_value"), chk.p("max_value"))
            return {"element_count": g("n"), "missing_count": F.lit(0).cast("long"), "observed_value": obs, "success": ok}

        return Measure(aggs, result)

    return build


def _row_count_other(chk, df, tables, prepared=None):
    other = tables[chk.p("other_table_name") or chk.p("other_table")]
    other_n = other.select(F.count(F.lit(1))).scalar()
    aggs = {"n": F.count(F.lit(1))}

    def result(g):
        return {
            "element_count": g("n"),
            "missing_count": F.lit(0).cast("long"),
            "observed_value": g("n").cast("double"),
            "unexpected_count": F.abs(g("n") - other_n).cast("long"),
            "success": g("n") == other_n,
        }

    return Measure(aggs, result)


def _freshness(chk, df, tables, prepared=None):
    """``as_of - max(ts) <= threshold``; observed = whole minutes since the newest row,
    unexpected = rows older than the cut-off (the row variant)."""
    c = df[chk.column]
    as_of = F.lit(chk.p("as_of")).cast(df.schema[chk.column].dataType.simpleString())
    secs = int(chk.p("threshold_seconds"))
    cutoff = as_of - F.make_dt_interval(secs=F.lit(secs))
    aggs = {
        "n": F.count(F.lit(1)),
        "miss": F.count_if(c.isNull()),
        "mx": F.max(c),
        "stale": F.count_if(c < cutoff),
    }

    def result(g):
        minutes = F.timestamp_diff("MINUTE", g("mx"), as_of)
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "unexpected_count": g("stale"),
            "observed_value": minutes.cast("double"),
            "success": F.coalesce(g("mx") >= cutoff, F.lit(False)),
        }

    return Measure(aggs, result)


def _approx_distinct(proportion: bool):
    """``approx=True``: distinct non-null values from ``approx_count_distinct``
    (HyperLogLog++, relative error ``rsd``, default 0.01): fixed-size buffers,
    fused with the other checks, no shuffle of the values."""

    def build(chk, df, tables, prepared=None):
        c = df[chk.column]
        aggs = {
            "n": F.count(F.lit(1)),
            "miss": F.count_if(c.isNull()),
            "ndv": F.approx_count_distinct(c, float(chk.p("rsd", 0.01))),
        }

        def result(g):
            obs = F.try_divide(g("ndv").cast("double"), g("n") - g("miss")) if proportion else g("ndv").cast("double")
            return {
                "element_count": g("n"),
                "missing_count": g("miss"),
                "observed_value": obs,
                "success": between(obs, chk.p("min_value"), chk.p("max_value")),
            }

        return Measure(aggs, result)

    return build


def _kl_bins(chk, df, tables, prepared=None):
    """KL divergence against a binned (numeric) partition: ``partition_object =
    {"bins": [b0, ..., bk], "weights": [w1, ..., wk]}``; bins are half-open
    ``[b_i, b_i+1)`` except the last, which is closed.  Observed shares come
    from one ``count_if`` per bin in the fused pass; mass outside the bins (or
    in a bin of weight 0) makes the divergence infinite."""
    import math

    c = df[chk.column]
    part = chk.p("partition_object") or {}
    bins, weights = list(part["bins"]), [float(w) for w in part["weights"]]
    aggs = {"n": F.count(F.lit(1)), "miss": F.count_if(c.isNull())}
    for i in range(len(weights)):
        lo, hi = F.lit(bins[i]), F.lit(bins[i + 1])
        last = i == len(weights) - 1
        aggs[f"b{i}"] = F.count_if((c >= lo) & ((c <= hi) if last else (c < hi)))

    def result(g):
        nn = (g("n") - g("miss")).cast("double")
        kl = F.lit(0.0)
        inside = F.lit(0)
        infinite = F.lit(False)
        for i, w in enumerate(weights):
            b = g(f"b{i}").cast("double")
            inside = inside + g(f"b{i}")
            if w > 0:
                kl = kl + F.when(b > 0, (b / nn) * F.log((b / nn) / F.lit(w))).otherwise(F.lit(0.0))
            else:
                infinite = infinite | (b > 0)
        infinite = infinite | (inside < (g("n") - g("miss")))
        kl = F.when(nn == 0, F.lit(None)).when(infinite, F.lit(math.inf)).otherwise(kl)
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "observed_value": kl,
            "success": F.coalesce(kl < F.lit(float(chk.p("threshold"))), F.lit(False)),
        }

    return Measure(aggs, result)


AGG_RULES = {
    "column_kl_divergence_to_be_less_than": _kl_bins,
    "column_unique_value_count_to_be_between": _approx_distinct(proportion=False),
    "column_proportion_of_unique_values_to_be_between": _approx_distinct(proportion=True),
    "column_max_to_be_between": _bounded(lambda c, k: F.max(c)),
    "column_min_to_be_between": _bounded(lambda c, k: F.min(c)),
    "column_mean_to_be_between": _bounded(lambda c, k: F.avg(c)),
    "column_median_to_be_between": _bounded(_median),
    "column_stdev_to_be_between": _bounded(lambda c, k: F.stddev_samp(c)),
    "column_sum_to_be_between": _bounded(_sum),
    "column_proportion_of_non_null_values_to_be_between": _proportion_non_null,
    "column_quantile_values_to_be_between": _quantiles,
    "table_row_count_to_be_between": _row_count(equal=False),
    "table_row_count_to_equal": _row_count(equal=True),
    "table_row_count_to_equal_other_table": _row_count_other,
    "freshness": _freshness,
}
