"""Registered queries (one per SURVEY §2 ID) and their DuckDB oracle SQL.

Every query reads the given tables (or columns Spark derives from them) in
full.  Fixture nulls / broken values are derived from the key with the same
CASE expression in both engines (the tables themselves hold no nulls).
Doubles are rounded to 6 places in both engines for the comparison only.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.checks import RESULT_COLUMNS, Check
from probity.contract import text_rule
from probity.plans.compile import validate
from probity.sources.tables import read_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Result columns with doubles rounded for cross-engine comparison."""
    return df.select(
        *[
            (F.round(F.col(c), 6) + F.lit(0.0)).alias(c) if c in ("unexpected_percent", "observed_value") else F.col(c)
            for c in RESULT_COLUMNS
        ]
    )


def register(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    QUERIES[name] = fn
    if sql is not None:
        ORACLE[name] = sql


# ------------------------------------------------------------------ derivations
# Spark and SQL forms of the same derived columns.


def _ev_v(df):
    return df.withColumn("v", F.when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(F.col("value")))


EV_V = "(SELECT *, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS v FROM events)"


def _cust_sentinel(df):
    return df.withColumn(
        "seg",
        F.when(F.col("c_custkey") % 7 == 0, F.lit(""))
        .when(F.col("c_custkey") % 11 == 0, F.lit("N/A"))
        .otherwise(F.col("c_mktsegment")),
    )


CUST_SENT = (
    "(SELECT *, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'N/A' "
    "ELSE c_mktsegment END AS seg FROM customer)"
)


def _date_text(df):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return df.withColumn(
        "dtxt",
        F.when(k % 10 == 0, F.lit("not a date"))
        .when(k % 3 == 0, F.date_format(d, "dd.MM.yyyy"))
        .when(k % 3 == 1, F.date_format(d, "yyyy/MM/dd"))
        .otherwise(F.date_format(d, "yyyy-MM-dd")),
    )


DATE_TXT = (
    "(SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN 'not a date' "
    "WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d.%m.%Y') "
    "WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y/%m/%d') "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dtxt FROM orders)"
)


def _month_text(df):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return df.withColumn(
        "mtxt", F.when(k % 10 == 0, F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, "yyyy/MM"))
    )


MONTH_TXT = (
    "(SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%Y-%m') "
    "ELSE strftime(o_orderdate, '%Y/%m') END AS mtxt FROM orders)"
)


def _props_cut(df):
    return df.withColumn(
        "pj",
        F.when(F.col("event_id") % 13 == 0, F.expr("substr(props, 2)"))
        .when(F.col("event_id") % 11 == 0, F.lit('{"k": "x"}'))
        .otherwise(F.col("props")),
    )


PROPS_CUT = (
    "(SELECT *, CASE WHEN event_id % 13 = 0 THEN substr(props, 2) "
    "WHEN event_id % 11 = 0 THEN '{\"k\": \"x\"}' ELSE props END AS pj FROM events)"
)


def _li_orders(t):
    li, o = t["lineitem"], t["orders"]
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")


LI_ORDERS = "(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


# ------------------------------------------------------------------ builders


def one(table: str, checks, derive=None, extra=(), build=None):
    """Query running ``checks`` (a Check or list) on ``table``.

    ``extra``: other tables to read (parents, joined tables); ``build(tables)``
    replaces ``table`` by a DataFrame Spark derives from them (e.g. a join);
    ``derive(df)`` adds derived columns."""
    checks = checks if isinstance(checks, (list, tuple)) else [checks]

    def q(spark: SparkSession, sf: str) -> DataFrame:
        t = read_tables(spark, sf, list(dict.fromkeys([table, *extra])))
        if build is not None:
            t[table] = build(t)
        if derive is not None:
            t[table] = derive(t[table])
        return tidy(validate(t, checks, spark=spark))

    return q


def final_sql(cid, element, missing, unexpected, pct, success, observed, src) -> str:
    return (
        f"SELECT '{cid}' AS check_id, CAST({element} AS BIGINT) AS element_count, "
        f"CAST({missing} AS BIGINT) AS missing_count, CAST({unexpected} AS BIGINT) AS unexpected_count, "
        f"round(CAST({pct} AS DOUBLE), 6) + 0.0 AS unexpected_percent, CAST({success} AS BOOLEAN) AS success, "
        f"round(CAST({observed} AS DOUBLE), 6) + 0.0 AS observed_value FROM {src}"
    )


def row_sql(cid, src, bad, missing="FALSE", all_rows=False, mostly=1.0, mblt=None, unit=None) -> str:
    """Row-level check: counts over ``src``; ``bad`` judged only where not ``missing``."""
    bad_expr = f"({bad})" if all_rows else f"(NOT ({missing}) AND ({bad}))"
    judged = "n" if all_rows else "(n - miss)"
    if mblt is not None:
        success = (
            f"(CASE WHEN n > 0 THEN 100.0 * bad / n ELSE 0.0 END) < {float(mblt)!r}" if unit == "percent" else f"bad < {float(mblt)!r}"
        )
    else:
        success = f"CASE WHEN {judged} = 0 THEN TRUE ELSE CAST({judged} - bad AS DOUBLE) / {judged} >= {float(mostly)!r} END"
    inner = (
        f"(SELECT count(*) AS n, count_if({missing}) AS miss, count_if({bad_expr}) AS bad FROM {src} AS t) AS s"
    )
    return final_sql(
        cid, "n", "miss", "bad", f"CASE WHEN {judged} > 0 THEN 100.0 * bad / {judged} ELSE 0.0 END", success, "NULL", inner
    )


def agg_sql(cid, src, col, obs, lo=None, hi=None, strict_min=False, strict_max=False, missing=None) -> str:
    conds = []
    if lo is not None:
        conds.append(f"obs {'>' if strict_min else '>='} {lo!r}")
    if hi is not None:
        conds.append(f"obs {'<' if strict_max else '<='} {hi!r}")
    cond = " AND ".join(conds) if conds else "TRUE"
    miss = missing or f"{col} IS NULL"
    inner = f"(SELECT count(*) AS n, count_if({miss}) AS miss, CAST({obs} AS DOUBLE) AS obs FROM {src} AS t) AS s"
    return final_sql(cid, "n", "miss", "NULL", "NULL", f"coalesce(obs IS NOT NULL AND {cond}, FALSE)", "obs", inner)


def union_sql(*parts: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def _in(values) -> str:
    return ", ".join(repr(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'" for v in values)


# ================================================================== E01-E56

EVENT_TYPES = ["view", "signup", "error", "click", "purchase"]


def _reg_expectations():
    # E01 distinct values within a set (purchase left out -> 1 offending value)
    s = ["view", "signup", "error", "click"]
    c = Check("events", "column_distinct_values_to_be_in_set", "event_type", {"value_set": s})
    g = "(SELECT event_type AS k, count(*) AS c FROM events GROUP BY 1) AS g"
    register(
        "E01",
        one("events", c),
        final_sql(c.check_id, "sum(c)", "coalesce(sum(c) FILTER (WHERE k IS NULL), 0)",
                  f"count(*) FILTER (WHERE k IS NOT NULL AND k NOT IN ({_in(s)}))", "NULL",
                  f"count(*) FILTER (WHERE k IS NOT NULL AND k NOT IN ({_in(s)})) = 0", "count(k)", g),
    )
    # E02 distinct values contain a set (one member absent)
    s2 = ["AUTOMOBILE", "BUILDING", "MACHINERY", "AEROSPACE"]
    c = Check("customer", "column_distinct_values_to_contain_set", "c_mktsegment", {"value_set": s2})
    g = "(SELECT c_mktsegment AS k, count(*) AS c FROM customer GROUP BY 1) AS g"
    absent = f"({len(s2)} - count(*) FILTER (WHERE k IN ({_in(s2)})))"
    register("E02", one("customer", c),
             final_sql(c.check_id, "sum(c)", "coalesce(sum(c) FILTER (WHERE k IS NULL), 0)", absent, "NULL",
                       f"{absent} = 0", "count(k)", g))
    # E02b a required member that does not fit the column is absent
    c = Check("customer", "column_distinct_values_to_contain_set", "c_nationkey", {"value_set": ["1", "2", "x"]}, check_id="customer:c_nationkey:unfit")
    g = "(SELECT c_nationkey AS k, count(*) AS c FROM customer GROUP BY 1) AS g"
    absent = "(3 - count(*) FILTER (WHERE k IN (1, 2)))"
    register("E02b", one("customer", c),
             final_sql(c.check_id, "sum(c)", "coalesce(sum(c) FILTER (WHERE k IS NULL), 0)", absent, "NULL",
                       f"{absent} = 0", "count(k)", g))
    # E03 distinct values equal a set
    s3 = ["F", "O", "P"]
    c = Check("orders", "column_distinct_values_to_equal_set", "o_orderstatus", {"value_set": s3})
    g = "(SELECT o_orderstatus AS k, count(*) AS c FROM orders GROUP BY 1) AS g"
    bad = (f"(count(*) FILTER (WHERE k IS NOT NULL AND k NOT IN ({_in(s3)})) + "
           f"{len(s3)} - count(*) FILTER (WHERE k IN ({_in(s3)})))")
    register("E03", one("orders", c),
             final_sql(c.check_id, "sum(c)", "coalesce(sum(c) FILTER (WHERE k IS NULL), 0)", bad, "NULL", f"{bad} = 0",
                       "count(k)", g))
    # E04 KL divergence of event_type against a uniform partition
    c = Check("events", "column_kl_divergence_to_be_less_than", "event_type",
              {"partition_object": {"values": EVENT_TYPES, "weights": [0.2] * 5}, "threshold": 0.01})
    kl = ("WITH g AS (SELECT event_type AS k, count(*) AS c FROM events GROUP BY 1), t AS (SELECT sum(c) AS tot FROM g) "
          + final_sql(c.check_id, "n", "0", "NULL", "NULL", "kl < 0.01", "kl",
                      "(SELECT tot AS n, sum(c * ln(c / tot / 0.2)) / tot AS kl FROM g, t GROUP BY tot) AS s"))
    register("E04", one("events", c), kl)
    # E04b KL divergence of a numeric column against binned weights (fused pass)
    bins, w = [0, 50, 100, 200, 500], [0.4, 0.3, 0.2, 0.1]
    c = Check("events", "column_kl_divergence_to_be_less_than", "value",
              {"partition_object": {"bins": bins, "weights": w}, "threshold": 0.5}, check_id="events:value:kl_bins")
    cnts = ", ".join(
        f"count_if(value >= {bins[i]} AND value {'<=' if i == len(w) - 1 else '<'} {bins[i + 1]}) AS b{i}" for i in range(len(w)))
    terms = " + ".join(f"CASE WHEN b{i} > 0 THEN (b{i} / nn) * ln((b{i} / nn) / {w[i]}) ELSE 0.0 END" for i in range(len(w)))
    inner = (f"(SELECT n, miss, CAST(n - miss AS DOUBLE) AS nn, {', '.join(f'b{i}' for i in range(len(w)))} FROM "
             f"(SELECT count(*) AS n, count_if(value IS NULL) AS miss, {cnts} FROM events)) AS s")
    kl = f"(CASE WHEN {' + '.join(f'b{i}' for i in range(len(w)))} < n - miss THEN 'inf'::DOUBLE ELSE {terms} END)"
    register("E04b", one("events", c), final_sql(c.check_id, "n", "miss", "NULL", "NULL", f"coalesce({kl} < 0.5, FALSE)", kl, inner))
    # E05-E08, E16, E17 column aggregates
    for eid, kind, table, col, agg, lo, hi in [
        ("E05", "column_max_to_be_between", "orders", "o_totalprice", "max", 400000.0, 500000.0),
        ("E06", "column_mean_to_be_between", "lineitem", "l_quantity", "avg", 20.0, 30.0),
        ("E07", "column_median_to_be_between", "orders", "o_totalprice", "median", 0.0, 200000.0),
        ("E08", "column_min_to_be_between", "lineitem", "l_quantity", "min", 1.0, None),
        ("E16", "column_stdev_to_be_between", "customer", "c_acctbal", "stddev_samp", 3000.0, 3500.0),
        ("E17", "column_sum_to_be_between", "lineitem", "l_quantity", "sum", None, 1500000.0),
    ]:
        c = Check(table, kind, col, {"min_value": lo, "max_value": hi})
        register(eid, one(table, c), agg_sql(c.check_id, table, col, f"{agg}({col})", lo, hi))
    # E09 most common value in set
    c = Check("part", "column_most_common_value_to_be_in_set", "p_type", {"value_set": ["MEDIUM", "LARGE"]})
    g = "(SELECT p_type AS k, count(*) AS c FROM part GROUP BY 1) AS g"
    register("E09", one("part", c),
             final_sql(c.check_id, "sum(c)", "coalesce(sum(c) FILTER (WHERE k IS NULL), 0)", "NULL", "NULL",
                       "coalesce(max(c) FILTER (WHERE k NOT IN ('MEDIUM', 'LARGE')) < max(c), TRUE)", "max(c)", g))
    # E10 pair A > B
    c = Check("lineitem", "column_pair_values_a_to_be_greater_than_b", ("l_extendedprice", "l_quantity"))
    register("E10", one("lineitem", c),
             row_sql(c.check_id, "lineitem", "NOT (l_extendedprice > l_quantity)", "l_extendedprice IS NULL OR l_quantity IS NULL"))
    # E11 pair equal
    c = Check("documents", "column_pair_values_to_be_equal", ("n_chars", "text_len"))
    register("E11", one("documents", c, derive=lambda d: d.withColumn("text_len", F.char_length("text").cast("long"))),
             row_sql(c.check_id, "(SELECT *, length(text) AS text_len FROM documents)", "NOT (n_chars = text_len)",
                     "n_chars IS NULL OR text_len IS NULL"))
    # E12 pair in set
    c = Check("lineitem", "column_pair_values_to_be_in_set", ("l_returnflag", "l_linestatus"),
              {"value_pairs_set": [["R", "F"], ["N", "O"]]})
    register("E12", one("lineitem", c),
             row_sql(c.check_id, "lineitem",
                     "NOT ((l_returnflag = 'R' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))",
                     "l_returnflag IS NULL OR l_linestatus IS NULL"))
    # E13 proportion non-null
    c = Check("events", "column_proportion_of_non_null_values_to_be_between", "v", {"min_value": 0.95})
    register("E13", one("events", c, derive=_ev_v), agg_sql(c.check_id, EV_V, "v", "count(v) * 1.0 / count(*)", 0.95))
    # E14 proportion unique
    c = Check("lineitem", "column_proportion_of_unique_values_to_be_between", "l_partkey", {"min_value": 0.01, "max_value": 0.5})
    register("E14", one("lineitem", c),
             agg_sql(c.check_id, "lineitem", "l_partkey", "count(DISTINCT l_partkey) * 1.0 / count(l_partkey)", 0.01, 0.5))
    # E15 quantiles
    c = Check("events", "column_quantile_values_to_be_between", "value",
              {"quantile_ranges": {"quantiles": [0.25, 0.5, 0.75], "value_ranges": [[10, 20], [30, 40], [50, 60]]}})
    qs = ("(SELECT count(*) AS n, count_if(value IS NULL) AS miss, quantile_disc(value, 0.25) AS q0, "
          "quantile_disc(value, 0.5) AS q1, quantile_disc(value, 0.75) AS q2 FROM events) AS s")
    bad = ("((CASE WHEN q0 BETWEEN 10 AND 20 THEN 0 ELSE 1 END) + (CASE WHEN q1 BETWEEN 30 AND 40 THEN 0 ELSE 1 END)"
           " + (CASE WHEN q2 BETWEEN 50 AND 60 THEN 0 ELSE 1 END))")
    register("E15", one("events", c), final_sql(c.check_id, "n", "miss", bad, f"100.0 * {bad} / 3", f"{bad} = 0", "NULL", qs))
    # E18 column exists (schema fact; oracle from information_schema)
    c1 = Check("orders", "column_to_exist", "o_orderkey")
    c2 = Check("orders", "column_to_exist", "o_comment")
    register("E18", one("orders", [c1, c2]), union_sql(*[
        final_sql(c.check_id, "NULL", "NULL", "NULL", "NULL",
                  f"(SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders' AND column_name = '{c.column}') = 1",
                  "NULL", "(SELECT 1)") for c in (c1, c2)]))
    # E19 unique value count
    c = Check("lineitem", "column_unique_value_count_to_be_between", "l_suppkey", {"min_value": 50, "max_value": 100})
    register("E19", one("lineitem", c), agg_sql(c.check_id, "lineitem", "l_suppkey", "count(DISTINCT l_suppkey)", 50, 100))
    # E20, E21 lengths
    c = Check("part", "column_value_lengths_to_be_between", "p_name", {"min_value": 5, "max_value": 9})
    register("E20", one("part", c), row_sql(c.check_id, "part", "NOT (length(p_name) BETWEEN 5 AND 9)", "p_name IS NULL"))
    c = Check("customer", "column_value_lengths_to_equal", "c_name", {"value": 18})
    register("E21", one("customer", c), row_sql(c.check_id, "customer", "length(c_name) <> 18", "c_name IS NULL"))
    # E22 z-scores
    c = Check("orders", "column_value_z_scores_to_be_less_than", "o_totalprice", {"threshold": 1.5, "double_sided": True})
    src = ("(SELECT o.*, (o_totalprice - m) / s AS z FROM orders o, "
           "(SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders))")
    register("E22", one("orders", c), row_sql(c.check_id, src, "NOT coalesce(abs(z) < 1.5, TRUE)", "o_totalprice IS NULL"))
    # E23 values between
    c = Check("lineitem", "column_values_to_be_between", "l_discount", {"min_value": 0, "max_value": 0.07})
    register("E23", one("lineitem", c), row_sql(c.check_id, "lineitem", "NOT (l_discount >= 0 AND l_discount <= 0.07)", "l_discount IS NULL"))
    # E24 parseable dates in a stated format list
    c = Check("orders", "column_values_to_be_dateutil_parseable", "dtxt", {"formats": ["%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y"]})
    register("E24", one("orders", c, derive=_date_text),
             row_sql(c.check_id, DATE_TXT,
                     "coalesce(try_strptime(dtxt, '%Y-%m-%d'), try_strptime(dtxt, '%Y/%m/%d'), try_strptime(dtxt, '%d.%m.%Y')) IS NULL",
                     "dtxt IS NULL"))
    # E25, E28 ordered (strict by default; ties broken by the checked column)
    c = Check("events", "column_values_to_be_decreasing", "v", {"order_by": "ts"}, check_id="events:v:decreasing_by_ts")
    register("E25", one("events", c, derive=_ev_v), _ordered_sql(c.check_id, EV_V, "v", "ts", increasing=False))
    c1 = Check("events", "column_values_to_be_increasing", "ts", {"order_by": "event_id"}, check_id="events:ts:increasing_by_event_id")
    c2 = Check("events", "column_values_to_be_increasing", "event_id", {"order_by": "ts"}, check_id="events:event_id:increasing_by_ts")
    c3 = Check("events", "column_values_to_be_increasing", "value", {"order_by": "ts"}, check_id="events:value:increasing_by_ts")
    c4 = Check("events", "column_values_to_be_increasing", "ts", {"order_by": "ts", "partition_by": ["user_id"], "tie_breaker": "event_id",
                                                                  "strictly": False}, check_id="events:ts:increasing_per_user")
    register("E28", one("events", [c1, c2, c3, c4]), union_sql(
        _ordered_sql(c1.check_id, "events", "ts", "event_id"),
        _ordered_sql(c2.check_id, "events", "event_id", "ts"),
        _ordered_sql(c3.check_id, "events", "value", "ts"),
        _ordered_sql(c4.check_id, "events", "ts", "ts", partition="user_id", tie="event_id", strictly=False),
    ))
    # E26 in set, E39 not in set
    c = Check("events", "column_values_to_be_in_set", "event_type", {"value_set": ["view", "signup", "click", "purchase"]})
    register("E26", one("events", c),
             row_sql(c.check_id, "events", "event_type NOT IN ('view', 'signup', 'click', 'purchase')", "event_type IS NULL"))
    # E26b a long value set (1500 members)
    c = Check("events", "column_values_to_be_in_set", "user_id", {"value_set": list(range(0, 3000, 2))},
              check_id="events:user_id:domain_long")
    register("E26b", one("events", c),
             row_sql(c.check_id, "events", "user_id NOT IN (SELECT range AS v FROM range(0, 3000, 2))", "user_id IS NULL"))
    # E26c integers above 2^53 are compared exactly
    big = 1 << 53
    c = Check("orders", "column_values_to_be_in_set", "big", {"value_set": [str(big + i) for i in range(1, 400, 2)]}, check_id="orders:big:exact")
    register("E26c", one("orders", c, derive=lambda df: df.withColumn("big", F.col("o_orderkey").cast("long") + F.lit(big))),
             row_sql(c.check_id, f"(SELECT *, o_orderkey::BIGINT + {big} AS big FROM orders)",
                     f"big NOT IN (SELECT {big} + range FROM range(1, 400, 2))", "big IS NULL"))
    # E26d a long set whose members ignore case
    c = Check("events", "column_values_to_be_in_set", "et", {"value_set": ["View", "SIGNUP", "click"] + [f"Other {i}" for i in range(1500)],
                                                           "case_insensitive": True}, check_id="events:et:domain_folded")
    mixed = "CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END"
    register("E26d", one("events", c, derive=lambda df: df.withColumn("et", F.expr(mixed))),
             row_sql(c.check_id, f"(SELECT *, {mixed} AS et FROM events)", "lower(et) NOT IN ('view', 'signup', 'click')", "et IS NULL"))
    c = Check("events", "column_values_to_not_be_in_set", "event_type", {"value_set": ["error"]})
    register("E39", one("events", c), row_sql(c.check_id, "events", "event_type IN ('error')", "event_type IS NULL"))
    # E27 type list, E31 of type (schema facts)
    c1 = Check("events", "column_values_to_be_in_type_list", "value", {"type_list": ["double", "decimal"]})
    c2 = Check("events", "column_values_to_be_in_type_list", "props", {"type_list": ["integer", "number"]})
    register("E27", one("events", [c1, c2]), union_sql(*[
        final_sql(c.check_id, "NULL", "NULL", "NULL", "NULL",
                  f"(SELECT count(*) FROM information_schema.columns WHERE table_name = 'events' AND column_name = '{c.column}' "
                  f"AND data_type IN ({_in(dt)})) = 1", "NULL", "(SELECT 1)")
        for c, dt in ((c1, ["DOUBLE", "FLOAT"]), (c2, ["TINYINT", "SMALLINT", "INTEGER", "BIGINT", "DOUBLE", "FLOAT"]))]))
    lt = {"l_orderkey": "integer", "l_partkey": "integer", "l_suppkey": "integer", "l_linenumber": "integer",
          "l_quantity": "number", "l_extendedprice": "number", "l_discount": "number", "l_tax": "number",
          "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp"}
    type_checks = [Check("lineitem", "column_values_to_be_of_type", col, {"type_": t}) for col, t in lt.items()]
    register("E31", one("lineitem", type_checks), _types_sql(type_checks))
    # E29 JSON parseable
    c = Check("events", "column_values_to_be_json_parseable", "pj")
    register("E29", one("events", c, derive=_props_cut), row_sql(c.check_id, PROPS_CUT, "NOT json_valid(pj)", "pj IS NULL"))
    # E30 null
    c = Check("events", "column_values_to_be_null", "v", mostly=0.05)
    register("E30", one("events", c, derive=_ev_v), row_sql(c.check_id, EV_V, "v IS NOT NULL", "v IS NULL", all_rows=True, mostly=0.05))
    # E32 unique
    c1 = Check("lineitem", "column_values_to_be_unique", "l_orderkey")
    c2 = Check("orders", "column_values_to_be_unique", "o_orderkey")
    register("E32", one("lineitem", [c1], extra=()), _unique_sql(c1.check_id, "lineitem", ["l_orderkey"], "any"))
    register("E32b", one("orders", [c2]), _unique_sql(c2.check_id, "orders", ["o_orderkey"], "any"))
    # E33 JSON schema
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}}
    c = Check("events", "column_values_to_match_json_schema", "pj", {"json_schema": schema})
    register("E33", one("events", c, derive=_props_cut),
             row_sql(c.check_id, PROPS_CUT,
                     "NOT (CASE WHEN json_valid(pj) THEN coalesce(json_type(pj) = 'OBJECT' AND json_type(pj, '$.k') IN ('UBIGINT', 'BIGINT'), FALSE) ELSE FALSE END)",
                     "pj IS NULL"))
    # E34, E35, E41, E42 LIKE
    c = Check("part", "column_values_to_match_like_pattern", "p_name", {"like_pattern": "%widget"})
    register("E34", one("part", c), row_sql(c.check_id, "part", "NOT (p_name LIKE '%widget')", "p_name IS NULL"))
    c = Check("part", "column_values_to_match_like_pattern_list", "p_name", {"like_pattern_list": ["%widget", "%bolt"], "match_on": "any"})
    register("E35", one("part", c), row_sql(c.check_id, "part", "NOT (p_name LIKE '%widget' OR p_name LIKE '%bolt')", "p_name IS NULL"))
    c = Check("part", "column_values_to_not_match_like_pattern", "p_name", {"like_pattern": "red%"})
    register("E41", one("part", c), row_sql(c.check_id, "part", "p_name LIKE 'red%'", "p_name IS NULL"))
    c = Check("part", "column_values_to_not_match_like_pattern_list", "p_name", {"like_pattern_list": ["red%", "%gear"]})
    register("E42", one("part", c), row_sql(c.check_id, "part", "p_name LIKE 'red%' OR p_name LIKE '%gear'", "p_name IS NULL"))
    # E36, E37, E43, E44 regex
    c = Check("part", "column_values_to_match_regex", "p_brand", {"regex": "^Brand#[0-9]$"})
    register("E36", one("part", c), row_sql(c.check_id, "part", "NOT regexp_matches(p_brand, '^Brand#[0-9]$')", "p_brand IS NULL"))
    c = Check("pages", "column_values_to_match_regex_list", "url", {"regex_list": ["^https://", "[.]org/"], "match_on": "all"})
    register("E37", one("pages", c),
             row_sql(c.check_id, "pages", "NOT (regexp_matches(url, '^https://') AND regexp_matches(url, '[.]org/'))", "url IS NULL"))
    email = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
    c = Check("documents", "column_values_to_not_match_regex", "text", {"regex": email})
    register("E43", one("documents", c), row_sql(c.check_id, "documents", f"regexp_matches(text, '{email}')", "text IS NULL"))
    phone = "[+][0-9]{1,3}[ -][0-9]{3}"
    c = Check("documents", "column_values_to_not_match_regex_list", "text", {"regex_list": [email, phone]})
    register("E44", one("documents", c),
             row_sql(c.check_id, "documents", f"regexp_matches(text, '{email}') OR regexp_matches(text, '{phone}')", "text IS NULL"))
    # E38 strftime format
    c = Check("orders", "column_values_to_match_strftime_format", "mtxt", {"strftime_format": "%Y/%m"})
    register("E38", one("orders", c, derive=_month_text),
             row_sql(c.check_id, MONTH_TXT, "NOT coalesce(strftime(try_strptime(mtxt, '%Y/%m'), '%Y/%m') = mtxt, FALSE)", "mtxt IS NULL"))
    # E40 not null (derived nulls)
    c = Check("events", "column_values_to_not_be_null", "v")
    register("E40", one("events", c, derive=_ev_v), row_sql(c.check_id, EV_V, "v IS NULL", "v IS NULL", all_rows=True))
    # E45 compound unique, E47 multicolumn unique
    c = Check("lineitem", "compound_columns_to_be_unique", ("l_orderkey", "l_linenumber"))
    register("E45", one("lineitem", c), _unique_sql(c.check_id, "lineitem", ["l_orderkey", "l_linenumber"], "all"))
    c = Check("conversations", "multicolumn_values_to_be_unique", ("conv_id", "turn"))
    register("E47", one("conversations", c), _unique_sql(c.check_id, "conversations", ["conv_id", "turn"], "any"))
    # E46 multicolumn sum
    c = Check("lineitem", "multicolumn_sum_to_equal", ("l_linenumber", "l_suppkey"), {"sum_total": 100})
    register("E46", one("lineitem", c),
             row_sql(c.check_id, "lineitem", "l_linenumber + l_suppkey <> 100", "l_linenumber IS NULL OR l_suppkey IS NULL"))
    # E46b, E17b integers that overflow a bigint when added
    near = 9223372036854775000
    wide = lambda df: df.withColumn("big", F.lit(near) + F.col("o_orderkey") % 100)
    c1 = Check("orders", "multicolumn_sum_to_equal", ("big", "o_orderkey"), {"sum_total": 100}, check_id="orders:big:sum")
    c2 = Check("orders", "column_values_to_not_be_null", "o_orderkey", check_id="orders:big:others")
    register("E46b", one("orders", [c1, c2], derive=wide),
             union_sql(row_sql(c1.check_id, "orders", "TRUE", "o_orderkey IS NULL"),
                       row_sql(c2.check_id, "orders", "o_orderkey IS NULL", "o_orderkey IS NULL", all_rows=True)))
    # E48 query comparison
    c = Check("orders", "query_results_to_match_comparison", (),
              {"base_query": "SELECT o_orderkey FROM orders", "comparison_query": "SELECT DISTINCT l_orderkey FROM lineitem"})
    diff = ("(SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders EXCEPT ALL SELECT DISTINCT l_orderkey FROM lineitem)) + "
            "(SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem EXCEPT ALL SELECT o_orderkey FROM orders)) AS d) AS s")
    register("E48", one("orders", c, extra=("lineitem",)), final_sql(c.check_id, "NULL", "NULL", "d", "NULL", "d = 0", "d", diff))
    # E48b comparisons by digests: equal, a few rows apart, all rows apart
    same = "SELECT l_orderkey, l_linenumber, l_partkey, l_comment_like FROM (SELECT *, concat(l_returnflag, l_linestatus) AS l_comment_like FROM lineitem)"
    sides = {
        "equal": (same, same),
        "nearly": (same, f"{same} WHERE l_orderkey % 500 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'new' FROM lineitem WHERE l_orderkey % 500 = 0"),
        "repeats": (same, f"{same} UNION ALL SELECT * FROM ({same}) AS again WHERE l_linenumber = 7"),
        "apart": ("SELECT l_partkey FROM lineitem", "SELECT o_orderkey FROM orders"),
    }
    cs = [Check("lineitem", "query_results_to_match_comparison", (), {"base_query": a, "comparison_query": b, "digests": True}, check_id=f"digests:{k}")
          for k, (a, b) in sides.items()]
    register("E48b", one("lineitem", cs, extra=("orders",)), union_sql(*[
        final_sql(c.check_id, "NULL", "NULL", "d", "NULL", "d = 0", "d",
                  f"(SELECT (SELECT count(*) FROM (({a}) EXCEPT ALL ({b}))) + (SELECT count(*) FROM (({b}) EXCEPT ALL ({a}))) AS d) AS s")
        for c, (a, b) in zip(cs, sides.values())]))
    # E49 unique within record
    c = Check("lineitem", "select_column_values_to_be_unique_within_record", ("l_partkey", "l_suppkey", "l_orderkey"))
    register("E49", one("lineitem", c),
             row_sql(c.check_id, "lineitem",
                     "l_partkey = l_suppkey OR l_partkey = l_orderkey OR l_suppkey = l_orderkey",
                     "l_partkey IS NULL AND l_suppkey IS NULL AND l_orderkey IS NULL"))
    # E50-E53 table schema facts
    n_cols = "(SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders')"
    c = Check("orders", "table_column_count_to_be_between", (), {"min_value": 5, "max_value": 10})
    register("E50", one("orders", c), final_sql(c.check_id, "NULL", "NULL", "NULL", "NULL", f"{n_cols} BETWEEN 5 AND 10", n_cols, "(SELECT 1)"))
    c = Check("orders", "table_column_count_to_equal", (), {"value": 6})
    register("E51", one("orders", c), final_sql(c.check_id, "NULL", "NULL", "NULL", "NULL", f"{n_cols} = 6", n_cols, "(SELECT 1)"))
    want = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate"]
    c = Check("orders", "table_columns_to_match_ordered_list", (), {"column_list": want})
    pos = " UNION ALL ".join(f"SELECT {i + 1} AS p, '{w}' AS w" for i, w in enumerate(want))
    mism = (f"(SELECT count(*) FROM (SELECT column_name, ordinal_position AS p FROM information_schema.columns "
            f"WHERE table_name = 'orders') a FULL JOIN ({pos}) b USING (p) WHERE a.column_name IS DISTINCT FROM b.w)")
    register("E52", one("orders", c), final_sql(c.check_id, "NULL", "NULL", mism, "NULL", f"{mism} = 0", "NULL", "(SELECT 1)"))
    sset = ["o_orderkey", "o_custkey", "o_totalprice", "o_shippriority"]
    c = Check("orders", "table_columns_to_match_set", (), {"column_set": sset, "exact_match": False})
    miss = (f"(SELECT count(*) FROM (SELECT unnest([{_in(sset)}]) AS w) WHERE w NOT IN "
            f"(SELECT column_name FROM information_schema.columns WHERE table_name = 'orders'))")
    register("E53", one("orders", c), final_sql(c.check_id, "NULL", "NULL", miss, "NULL", f"{miss} = 0", "NULL", "(SELECT 1)"))
    # E54, E55, E56 row counts
    c = Check("orders", "table_row_count_to_be_between", (), {"min_value": 1000, "max_value": 100000})
    register("E54", one("orders", c),
             final_sql(c.check_id, "n", "0", "NULL", "NULL", "n BETWEEN 1000 AND 100000", "n", "(SELECT count(*) AS n FROM orders)"))
    c = Check("orders", "table_row_count_to_equal", (), {"value": 15000})
    register("E55", one("orders", c),
             final_sql(c.check_id, "n", "0", "NULL", "NULL", "n = 15000", "n", "(SELECT count(*) AS n FROM orders)"))
    c = Check("documents", "table_row_count_to_equal_other_table", (), {"other_table_name": "labels"})
    register("E56", one("documents", c, extra=("labels",)),
             final_sql(c.check_id, "n", "0", "abs(n - m)", "NULL", "n = m", "n",
                       "(SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM labels) AS m)"))


def _ordered_sql(cid, src, col, order, increasing=True, partition=None, tie=None, strictly=True):
    tie = tie or col
    tie_dir = "ASC NULLS FIRST" if increasing else "DESC NULLS LAST"
    if increasing:
        ok = f"{col} > prev" if strictly else f"{col} >= prev"
    else:
        ok = f"{col} < prev" if strictly else f"{col} <= prev"
    part = f"PARTITION BY skip, {partition} " if partition else "PARTITION BY skip "
    inner = (
        f"(SELECT count(*) AS n, count_if(skip) AS miss, count_if(NOT skip AND prev IS NOT NULL AND NOT ({ok})) AS bad "
        f"FROM (SELECT *, lag({col}) OVER ({part}ORDER BY {order}, {tie} {tie_dir}) AS prev "
        f"FROM (SELECT *, ({col} IS NULL OR {order} IS NULL) AS skip FROM {src} AS t0) AS t1) AS t2) AS s"
    )
    return final_sql(cid, "n", "miss", "bad", "CASE WHEN n - miss > 0 THEN 100.0 * bad / (n - miss) ELSE 0.0 END",
                     "CASE WHEN n - miss = 0 THEN TRUE ELSE CAST(n - miss - bad AS DOUBLE) / (n - miss) >= 1.0 END", "NULL", inner)


def _unique_sql(cid, table, cols, null_mode):
    keys = ", ".join(cols)
    nul = (" OR " if null_mode == "any" else " AND ").join(f"{c} IS NULL" for c in cols)
    g = f"(SELECT {keys}, count(*) AS c FROM {table} GROUP BY ALL) AS g"
    inner = (f"(SELECT sum(c) AS n, coalesce(sum(c) FILTER (WHERE {nul}), 0) AS miss, "
             f"coalesce(sum(c) FILTER (WHERE NOT ({nul}) AND c > 1), 0) AS bad FROM {g}) AS s")
    return final_sql(cid, "n", "miss", "bad", "CASE WHEN n - miss > 0 THEN 100.0 * bad / (n - miss) ELSE 0.0 END",
                     "CASE WHEN n - miss = 0 THEN TRUE ELSE CAST(n - miss - bad AS DOUBLE) / (n - miss) >= 1.0 END", "NULL", inner)


# logical family -> DuckDB information_schema data types
_DUCK_FAMILY = {
    "integer": ["TINYINT", "SMALLINT", "INTEGER", "BIGINT"],
    "number": ["TINYINT", "SMALLINT", "INTEGER", "BIGINT", "DOUBLE", "FLOAT", "DECIMAL"],
    "string": ["VARCHAR"],
    "timestamp": ["TIMESTAMP", "TIMESTAMP WITH TIME ZONE"],
}


def _types_sql(checks):
    parts = []
    for c in checks:
        tbl = c.table
        fam = _DUCK_FAMILY[c.p("type_")]
        ok = (f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{tbl}' AND column_name = '{c.column}' "
              f"AND (data_type IN ({_in(fam)}) OR data_type LIKE 'DECIMAL%' AND 'DECIMAL' IN ({_in(fam)}))) = 1")
        parts.append(final_sql(c.check_id, "NULL", "NULL", "NULL", "NULL", ok, "NULL", "(SELECT 1)"))
    return union_sql(*parts)


_reg_expectations()


# ================================================================== C01-C28


def _text(table, col, sentence, tables=("orders", "lineitem", "customer", "events", "region", "nation", "part")):
    chk, reason = text_rule(table, col, sentence, list(tables), {"customer": ["c_custkey"], "region": ["r_regionkey"],
                                                               "orders": ["o_orderkey"]})
    if chk is None:
        raise ValueError(reason)
    return chk


def _reg_contract_rules():
    # C1 required -> not null
    c = Check("events", "column_values_to_not_be_null", "v", check_id="events:v:required")
    register("C01", one("events", c, derive=_ev_v), row_sql(c.check_id, EV_V, "v IS NULL", "v IS NULL", all_rows=True))
    # C2 unique (fails on l_orderkey, passes on o_orderkey)
    c1 = Check("lineitem", "column_values_to_be_unique", "l_orderkey", check_id="lineitem:l_orderkey:field_unique")
    c2 = Check("orders", "column_values_to_be_unique", "o_orderkey", check_id="orders:o_orderkey:field_unique")
    register("C02", one("lineitem", [c1, c2], extra=("orders",)),
             union_sql(_unique_sql(c1.check_id, "lineitem", ["l_orderkey"], "any"), _unique_sql(c2.check_id, "orders", ["o_orderkey"], "any")))
    # C3 primary key: every part not null and the tuple unique
    from probity.contract import load_contract

    pk_contract = {"models": {"lineitem": {"primaryKey": ["l_orderkey", "l_linenumber"], "fields": {}}}}
    pk_checks = load_contract(pk_contract).checks
    register("C03", one("lineitem", pk_checks), union_sql(
        row_sql("lineitem:l_orderkey:pk_not_null", "lineitem", "l_orderkey IS NULL", "l_orderkey IS NULL", all_rows=True),
        row_sql("lineitem:l_linenumber:pk_not_null", "lineitem", "l_linenumber IS NULL", "l_linenumber IS NULL", all_rows=True),
        _unique_sql("lineitem:l_orderkey+l_linenumber:primary_key", "lineitem", ["l_orderkey", "l_linenumber"], "all"),
    ))
    # C4 declared logical types (schema facts)
    decl = {"o_orderkey": "integer", "o_custkey": "integer", "o_orderstatus": "string", "o_totalprice": "number",
            "o_orderdate": "timestamp", "o_orderpriority": "integer"}
    tc = [Check("orders", "column_values_to_be_of_type", col, {"type_": t}, check_id=f"orders:{col}:contract_type")
          for col, t in decl.items()]
    register("C04", one("orders", tc), _types_sql(tc))
    # C5 maxLength
    c = Check("documents", "column_value_lengths_to_be_between", "text", {"max_value": 1000}, check_id="documents:text:max_length")
    register("C05", one("documents", c), row_sql(c.check_id, "documents", "NOT (length(text) <= 1000)", "text IS NULL"))
    # C6 minimum / maximum
    c = Check("lineitem", "column_values_to_be_between", "l_discount", {"min_value": 0, "max_value": 0.07},
              check_id="lineitem:l_discount:contract_range")
    register("C06", one("lineitem", c), row_sql(c.check_id, "lineitem", "NOT (l_discount >= 0 AND l_discount <= 0.07)", "l_discount IS NULL"))
    # C7 enum; the second contract declares strings on an integer column
    c1 = Check("orders", "column_values_to_be_in_set", "o_orderstatus", {"value_set": ["F", "O"]}, check_id="orders:o_orderstatus:enum")
    c2 = Check("part", "column_values_to_be_in_set", "p_size", {"value_set": ["1", "2", "3", "4", "5", "x"]}, check_id="part:p_size:enum")
    register("C07", one("orders", [c1, c2], extra=("part",)), union_sql(
        row_sql(c1.check_id, "orders", "o_orderstatus NOT IN ('F', 'O')", "o_orderstatus IS NULL"),
        row_sql(c2.check_id, "part", "p_size NOT IN (1, 2, 3, 4, 5)", "p_size IS NULL"),
    ))
    # C8 pattern
    c = Check("part", "column_values_to_match_regex", "p_brand", {"regex": "^Brand#\\d{1}$"}, check_id="part:p_brand:pattern")
    register("C08", one("part", c), row_sql(c.check_id, "part", "NOT regexp_matches(p_brand, '^Brand#\\d{1}$')", "p_brand IS NULL"))
    # C9 accepted_values
    segs = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
    c = Check("customer", "column_values_to_be_in_set", "c_mktsegment", {"value_set": segs}, check_id="customer:c_mktsegment:accepted_values")
    register("C09", one("customer", c), row_sql(c.check_id, "customer", f"c_mktsegment NOT IN ({_in(segs)})", "c_mktsegment IS NULL"))
    # C10 regex on month text
    c = Check("orders", "column_values_to_match_regex", "mtxt", {"regex": "^\\d{4}/\\d{2}$"}, check_id="orders:mtxt:rule_regex")
    register("C10", one("orders", c, derive=_month_text),
             row_sql(c.check_id, MONTH_TXT, "NOT regexp_matches(mtxt, '^\\d{4}/\\d{2}$')", "mtxt IS NULL"))
    # C11 rule unique
    c = Check("customer", "column_values_to_be_unique", "c_name", check_id="customer:c_name:rule_unique")
    register("C11", one("customer", c), _unique_sql(c.check_id, "customer", ["c_name"], "any"))
    # C12 referential integrity (lineitem -> orders holds; documents -> labels has orphans)
    f1 = Check("lineitem", "foreign_key", "l_orderkey", {"parent_table": "orders", "parent_columns": ["o_orderkey"]})
    f2 = Check("documents", "foreign_key", "doc_id", {"parent_table": "labels", "parent_columns": ["doc_id"]})
    register("C12", one("lineitem", [f1, f2], extra=("orders", "documents", "labels")), union_sql(
        _fk_sql(f1.check_id, "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _fk_sql(f2.check_id, "documents", "doc_id", "labels", "doc_id"),
    ))
    # C13 references t.c (nation -> region)
    f = Check("nation", "foreign_key", "n_regionkey", {"parent_table": "region", "parent_columns": ["r_regionkey"]})
    register("C13", one("nation", f, extra=("region",)), _fk_sql(f.check_id, "nation", "n_regionkey", "region", "r_regionkey"))
    # C14 custom row expression
    expr = "l_extendedprice * (1 - l_discount) * (1 + l_tax) <= 100000"
    c = Check("lineitem", "row_condition", (), {"expression": expr}, check_id="lineitem::custom")
    register("C14", one("lineitem", c), row_sql(c.check_id, "lineitem", f"NOT coalesce({expr}, TRUE)"))
    # C14b a divisor of zero: no verdict for the row, and the suite goes on
    c1 = Check("lineitem", "row_condition", (), {"expression": "l_extendedprice / (l_linenumber - 3) > 0"}, check_id="lineitem::divides")
    c2 = Check("lineitem", "column_values_to_not_be_null", "l_tax", check_id="lineitem::others")
    register("C14b", one("lineitem", [c1, c2]),
             union_sql(row_sql(c1.check_id, "lineitem", "NOT (l_extendedprice / nullif(l_linenumber - 3, 0) > 0)", "l_linenumber = 3"),
                       row_sql(c2.check_id, "lineitem", "l_tax IS NULL", "l_tax IS NULL", all_rows=True)))
    # C15 invalidValues count < 1
    c = Check("events", "column_values_to_be_in_set", "event_type", {"value_set": ["view", "signup", "click", "purchase"]},
              must_be_less_than=1, check_id="events:event_type:invalid_values")
    register("C15", one("events", c),
             row_sql(c.check_id, "events", "event_type NOT IN ('view', 'signup', 'click', 'purchase')", "event_type IS NULL", mblt=1))
    # C16 nullValues percent < 10
    c = Check("events", "column_values_to_not_be_null", "v", must_be_less_than=10, unit="percent", check_id="events:v:null_values")
    register("C16", one("events", c, derive=_ev_v),
             row_sql(c.check_id, EV_V, "v IS NULL", "v IS NULL", all_rows=True, mblt=10, unit="percent"))
    # C17 missingValues (null or sentinel) percent < 5
    cond = "NOT (`seg` IS NULL OR trim(CAST(`seg` AS STRING)) IN ('', 'N/A', 'n/a'))"
    c = Check("customer", "row_condition", (), {"expression": cond}, must_be_less_than=5, unit="percent",
              check_id="customer:seg:missing_values")
    register("C17", one("customer", c, derive=_cust_sentinel),
             row_sql(c.check_id, CUST_SENT, "seg IS NULL OR trim(seg) IN ('', 'N/A', 'n/a')", mblt=5, unit="percent"))
    # C18 scalar SQL (quantile rewritten to percentile_disc)
    c = Check("events", "sql_scalar", "value", {"query": "SELECT quantile(value, 0.95) AS p95 FROM events"},
              must_be_less_than=300, check_id="events:value:sql")
    register("C18", one("events", c),
             final_sql(c.check_id, "NULL", "NULL", "NULL", "NULL", "coalesce(v < 300.0, FALSE)", "v",
                       "(SELECT quantile_disc(value, 0.95) AS v FROM events) AS s"))
    # C18b many rows are no scalar: no verdict
    c = Check("orders", "sql_scalar", "o_orderkey", {"query": "SELECT o_orderkey FROM orders"}, must_be_less_than=5, check_id="orders:o_orderkey:many")
    register("C18b", one("orders", c),
             final_sql(c.check_id, "NULL", "NULL", "NULL", "NULL", "CASE WHEN n = 1 THEN v < 5.0 END", "CASE WHEN n = 1 THEN v END",
                       "(SELECT count(*) AS n, max(o_orderkey) AS v FROM orders) AS s"))
    # C19 text: fixed prefix + digits
    c = _text("customer", "c_name", 'Must follow format "Customer#<id>" where <id> are numerics.')
    register("C19", one("customer", c), row_sql(c.check_id, "customer", "NOT regexp_matches(c_name, '^Customer#\\d+$')", "c_name IS NULL"))
    # C20 text: column order, after the lineitem-orders join
    c = _text("lineitem", "l_shipdate", "l_shipdate must be later than or equal to o_orderdate.")
    register("C20", one("lineitem", c, extra=("orders",), build=_li_orders),
             row_sql(c.check_id, LI_ORDERS, "NOT (l_shipdate >= o_orderdate)", "l_shipdate IS NULL OR o_orderdate IS NULL"))
    # C21 text: conditional presence
    c = _text("events", "v", "v must be present when event_type = purchase.")
    register("C21", one("events", c, derive=_ev_v),
             row_sql(c.check_id, EV_V, "coalesce(event_type = 'purchase', FALSE) AND v IS NULL", "v IS NULL", all_rows=True))
    # C22 text: must exist in table
    c = _text("events", "user_id", "user_id must exist in customer.")
    register("C22", one("events", c, extra=("customer",)), _fk_sql(c.check_id, "events", "user_id", "customer", "c_custkey"))
    # C23 text: must not be null
    c = _text("orders", "o_orderdate", "o_orderdate must not be null.")
    register("C23", one("orders", c), row_sql(c.check_id, "orders", "o_orderdate IS NULL", "o_orderdate IS NULL", all_rows=True))
    # C24 text: share in range
    c = _text("orders", "o_totalprice", "60% of o_totalprice must be less than 300000.")
    register("C24", one("orders", c),
             row_sql(c.check_id, "orders", "NOT (o_totalprice < 300000.0)", "o_totalprice IS NULL", mostly=0.6))
    # A share of good rows above, of bad rows below, as a contract's quality entry writes it
    for name, said, sql in (("C24b", ">59.5%", "CAST(n - miss - bad AS DOUBLE) / (n - miss) > 0.595"), ("C24c", "<5%", "1.0 - CAST(n - miss - bad AS DOUBLE) / (n - miss) < 0.05")):
        c = Check("orders", "column_values_to_be_between", "o_totalprice", {"max_value": 300000.0, "share": said}, check_id=f"orders:o_totalprice:{name}")
        register(name, one("orders", c), final_sql(
            c.check_id, "n", "miss", "bad", "CASE WHEN n - miss > 0 THEN 100.0 * bad / (n - miss) ELSE 0.0 END", f"CASE WHEN n = miss THEN TRUE ELSE {sql} END", "NULL",
            "(SELECT count(*) AS n, count_if(o_totalprice IS NULL) AS miss, count_if(o_totalprice > 300000.0) AS bad FROM orders) AS s"))
    # C25 text: suffix
    c = _text("part", "p_name", "p_name must end with widget.")
    register("C25", one("part", c), row_sql(c.check_id, "part", "NOT (p_name LIKE '%widget')", "p_name IS NULL"))
    # C26 freshness (as_of fixed)
    c = Check("events", "freshness", "ts", {"as_of": "2024-01-31 00:00:00", "threshold_seconds": 25 * 3600})
    register("C26", one("events", c), final_sql(
        c.check_id, "n", "miss", "stale", "NULL", "coalesce(mx >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 25 HOUR, FALSE)",
        "date_sub('minute', mx, TIMESTAMP '2024-01-31 00:00:00')",
        "(SELECT count(*) AS n, count_if(ts IS NULL) AS miss, max(ts) AS mx, "
        "count_if(ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 25 HOUR) AS stale FROM events) AS s"))
    # T5: every unit of a duration, as contracts write freshness limits
    register("C26b", _durations, _durations_sql())
    # C27 PII masking projection
    register("C27", _masked_customers,
             "SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, c_mktsegment FROM customer")
    # C28 retention split
    register("C28b", _retention_periods, _retention_periods_sql())
    register("C28", _retention_counts,
             "SELECT CAST(count_if(o_orderdate < TIMESTAMP '2006-01-01 00:00:00' - INTERVAL 7 YEAR) AS BIGINT) AS expired_rows, "
             "CAST(count_if(o_orderdate >= TIMESTAMP '2006-01-01 00:00:00' - INTERVAL 7 YEAR) AS BIGINT) AS kept_rows FROM orders")


def _fk_sql(cid, child, fk, parent, pk):
    inner = (
        f"(SELECT count(*) AS n, count_if({fk} IS NULL) AS miss, "
        f"count_if({fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)) AS bad, "
        f"count(DISTINCT {fk}) FILTER (WHERE {fk} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)) AS bad_keys "
        f"FROM {child}) AS s"
    )
    return final_sql(cid, "n", "miss", "bad", "CASE WHEN n - miss > 0 THEN 100.0 * bad / (n - miss) ELSE 0.0 END",
                     "CASE WHEN n - miss = 0 THEN TRUE ELSE CAST(n - miss - bad AS DOUBLE) / (n - miss) >= 1.0 END", "bad_keys", inner)


DURATIONS = {"45d": "45 DAY", "3w": "21 DAY", "36h": "36 HOUR", "90m": "90 MINUTE", "30s": "30 SECOND"}


def _durations(spark, sf):
    from probity.functions.thresholds import parse_duration

    t = read_tables(spark, sf, ["events"])
    chks = [Check("events", "freshness", "ts", {"as_of": "2024-02-14 00:00:00", "threshold_seconds": parse_duration(d)}, check_id=f"events:ts:{d}") for d in DURATIONS]
    return tidy(validate(t, chks, spark=spark))


def _durations_sql() -> str:
    at = "TIMESTAMP '2024-02-14 00:00:00'"
    return union_sql(*(final_sql(
        f"events:ts:{d}", "n", "miss", "stale", "NULL", f"coalesce(mx >= {at} - INTERVAL {span}, FALSE)", f"date_sub('minute', mx, {at})",
        f"(SELECT count(*) AS n, count_if(ts IS NULL) AS miss, max(ts) AS mx, count_if(ts < {at} - INTERVAL {span}) AS stale FROM events) AS s") for d, span in DURATIONS.items()))


def _retention_periods(spark, sf):
    from probity.functions.masking import parse_period, retention_split

    t = read_tables(spark, sf, ["orders"])["orders"]
    out = None
    for said in RETENTIONS:
        months, days = parse_period(said)
        one_ = retention_split(t, "o_orderdate", "2000-01-31 00:00:00", months=months, days=days).select(F.lit(said).alias("period"), "*")
        out = one_ if out is None else out.unionByName(one_)
    return out


RETENTIONS = {"6 months": "6 MONTH", "90d": "90 DAY", "10 weeks": "70 DAY", "P1Y6M": "18 MONTH", "3 years": "3 YEAR"}


def _retention_periods_sql() -> str:
    at = "TIMESTAMP '2000-01-31 00:00:00'"
    return " UNION ALL ".join(
        f"SELECT '{said}' AS period, count_if(o_orderdate < {at} - INTERVAL {span})::BIGINT AS expired_rows, count_if(o_orderdate >= {at} - INTERVAL {span})::BIGINT AS kept_rows FROM orders" for said, span in RETENTIONS.items())


def _masked_customers(spark, sf):
    from probity.functions.masking import mask_columns

    t = read_tables(spark, sf, ["customer"])["customer"]
    return mask_columns(t, ["c_name"]).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def _retention_counts(spark, sf):
    from probity.functions.masking import retention_split

    t = read_tables(spark, sf, ["orders"])["orders"]
    return retention_split(t, "o_orderdate", as_of="2006-01-01 00:00:00", years=7)


_reg_contract_rules()


# ================================================================== P1-P9

PROFILE_COLS = ["table_name", "column_name", "data_type", "row_count", "null_count", "null_rate", "distinct_count",
                "distinct_ratio", "dup_rate", "p01", "p99", "min_value", "max_value", "tail_ratio", "oov_rate"]
_DOUBLES = {"null_rate", "distinct_ratio", "dup_rate", "p01", "p99", "min_value", "max_value", "tail_ratio", "oov_rate"}


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[
        (F.round(F.col(f.name), 6) + F.lit(0.0)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


def profile_sql(table: str, cols: list[tuple[str, str, bool]], src: str | None = None, vocab: dict | None = None,
                keep: list[str] | None = None) -> str:
    """DuckDB profile: one row per column; p01 / p99 by the reference's rank rule on the sorted list."""
    src = src or table
    vocab = vocab or {}
    parts = []
    for c, spark_type, numeric in cols:
        if numeric:
            q = (f"list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL))"
                 f"[greatest(0, CAST(floor(count({c}) * 0.01) AS BIGINT) - 1) + 1]")
            q99 = (f"list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL))"
                   f"[least(count({c}) - 1, CAST(floor(count({c}) * 0.99) AS BIGINT)) + 1]")
            mn, mx = f"min({c})", f"max({c})"
        else:
            q = q99 = mn = mx = "NULL"
        oov = (f"count_if({c} IS NOT NULL AND {c} NOT IN ({_in(vocab[c])})) * 1.0 / count({c})" if c in vocab else "NULL")
        inner = (f"SELECT count(*) AS n, count({c}) AS nn, count(DISTINCT {c}) AS d, CAST({q} AS DOUBLE) AS p01, "
                 f"CAST({q99} AS DOUBLE) AS p99, CAST({mn} AS DOUBLE) AS mn, CAST({mx} AS DOUBLE) AS mx, "
                 f"CAST({oov} AS DOUBLE) AS oov FROM {src} AS t")
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{spark_type}' AS data_type, n AS row_count, "
            f"n - nn AS null_count, (n - nn) * 1.0 / n AS null_rate, d AS distinct_count, d * 1.0 / n AS distinct_ratio, "
            f"1.0 - d * 1.0 / nn AS dup_rate, p01, p99, mn AS min_value, mx AS max_value, "
            f"CASE WHEN p99 <> 0 THEN mx / p99 END AS tail_ratio, oov AS oov_rate FROM ({inner}) AS s"
        )
    cols_out = keep or PROFILE_COLS
    sel = ", ".join((f"round({k}, 6) + 0.0 AS {k}" if k in _DOUBLES else k) for k in cols_out)
    return f"SELECT {sel} FROM (" + "\nUNION ALL\n".join(parts) + ")"


def _profile_q(table, columns, keep, derive=None, vocab=None, exact=True):
    def q(spark, sf):
        from probity.operators.profile import profile

        df = read_tables(spark, sf, [table])[table]
        if derive is not None:
            df = derive(df)
        return round_doubles(profile(df, table, columns, exact=exact, vocabularies=vocab, stats=set(keep)).select(*keep))

    return q


ORDERS_COLS = [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False),
               ("o_totalprice", "double", True), ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False)]


def _reg_profile():
    # P1 the whole profile of a table (row count and every column statistic)
    register("P01", _profile_q("orders", None, PROFILE_COLS), profile_sql("orders", ORDERS_COLS))
    keep = ["table_name", "column_name", "row_count", "null_count", "null_rate"]
    register("P02", _profile_q("events", ["v"], keep, derive=_ev_v), profile_sql("events", [("v", "double", True)], EV_V, keep=keep))
    keep = ["table_name", "column_name", "row_count", "distinct_count", "distinct_ratio"]
    register("P03", _profile_q("lineitem", ["l_partkey"], keep), profile_sql("lineitem", [("l_partkey", "bigint", True)], keep=keep))
    keep = ["table_name", "column_name", "p01", "p99"]
    register("P04", _profile_q("events", ["value", "user_id"], keep),
             profile_sql("events", [("value", "double", True), ("user_id", "bigint", True)], keep=keep))
    # P5 schema view: declared (contract) against observed (Parquet) types
    declared = {"lineitem": {"l_orderkey": "integer", "l_partkey": "integer", "l_quantity": "integer", "l_discount": "number",
                             "l_shipdate": "date", "l_comment": "string", "l_returnflag": "string"}}
    register("P05", _schema_view_q(declared), _schema_view_sql(declared))
    keep = ["table_name", "column_name", "distinct_count", "dup_rate"]
    register("P06", _profile_q("lineitem", ["l_orderkey"], keep), profile_sql("lineitem", [("l_orderkey", "bigint", True)], keep=keep))
    keep = ["table_name", "column_name", "oov_rate"]
    voc = {"event_type": ["view", "click", "purchase"]}
    register("P07", _profile_q("events", ["event_type"], keep, vocab=voc),
             profile_sql("events", [("event_type", "string", False)], vocab=voc, keep=keep))
    register("P08", _freshness_q,
             "SELECT CAST(date_sub('minute', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS BIGINT) AS freshness_minutes FROM events")
    keep = ["table_name", "column_name", "min_value", "max_value", "p99", "tail_ratio"]
    register("P09", _profile_q("orders", ["o_totalprice"], keep), profile_sql("orders", [("o_totalprice", "double", True)], keep=keep))


def _freshness_q(spark, sf):
    from probity.operators.profile import freshness_minutes

    return freshness_minutes(read_tables(spark, sf, ["events"])["events"], "ts", "2024-02-01 00:00:00")


def _schema_view_q(declared):
    def q(spark, sf):
        from probity.operators.schema import schema_view

        return schema_view(spark, declared, read_tables(spark, sf, list(declared)))

    return q


def _schema_view_sql(declared):
    fam = {"integer": "('TINYINT','SMALLINT','INTEGER','BIGINT')", "number": "('TINYINT','SMALLINT','INTEGER','BIGINT','DOUBLE','FLOAT')",
           "string": "('VARCHAR')", "date": "('DATE')", "timestamp": "('TIMESTAMP')"}
    spark_name = ("CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
                  "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT' THEN 'float' "
                  "WHEN 'INTEGER[]' THEN 'array<int>' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END")
    parts = []
    for t, cols in declared.items():
        decl = " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{ty}' AS declared_type, {fam[ty]} AS fam_dummy" .replace(
            f", {fam[ty]} AS fam_dummy", "") for c, ty in cols.items())
        ok = " ".join(f"WHEN d.column_name = '{c}' THEN o.data_type IN {fam[ty]}" for c, ty in cols.items())
        parts.append(
            f"SELECT '{t}' AS \"table\", coalesce(d.column_name, o.column_name) AS \"column\", "
            f"CAST(o.ordinal_position - 1 AS INTEGER) AS position, d.declared_type, "
            f"CASE WHEN o.column_name IS NULL THEN NULL ELSE {spark_name.replace('data_type', 'o.data_type')} END AS observed_type, "
            f"CASE WHEN o.column_name IS NULL THEN 'missing' WHEN d.column_name IS NULL THEN 'extra' "
            f"WHEN (CASE {ok} END) THEN 'match' ELSE 'type_differs' END AS status "
            f"FROM ({decl}) AS d FULL JOIN (SELECT column_name, data_type, ordinal_position FROM information_schema.columns "
            f"WHERE table_name = '{t}') AS o ON d.column_name = o.column_name"
        )
    return union_sql(*parts)


_reg_profile()


# ================================================================== S1-S12

ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]


def _ts_text(df, cols):
    return df.select(*[(F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(c) if c in cols else F.col(c)) for c in df.columns])


def _ts_sql(c):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


ORDERS_SEL = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_ts_sql('o_orderdate')}, o_orderpriority"
EVENTS_SEL = f"event_id, {_ts_sql('ts')}, user_id, event_type, value, props"


def _reg_sources():
    from probity.sources import tables as S

    register("S01", lambda spark, sf: S.table_counts(read_tables(spark, sf, ALL_TABLES)),
             union_sql(*[f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES]))
    register("S02", lambda spark, sf: _ts_text(S.first_n(read_tables(spark, sf, ["orders"])["orders"], "o_orderkey", 100), ["o_orderdate"]),
             f"SELECT {ORDERS_SEL} FROM orders ORDER BY o_orderkey LIMIT 100")
    register("S03", lambda spark, sf: _ts_text(S.hash_mod_sample(read_tables(spark, sf, ["orders"])["orders"], "o_orderkey", 100, 0, n=None),
                                               ["o_orderdate"]),
             f"SELECT {ORDERS_SEL} FROM orders WHERE o_orderkey % 100 = 0")
    register("S04", lambda spark, sf: _ts_text(S.time_window(read_tables(spark, sf, ["events"])["events"], "ts",
                                                             "2024-01-08 00:00:00", "2024-01-15 00:00:00"), ["ts"]),
             f"SELECT {EVENTS_SEL} FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'")
    want = {"p_brand": "int", "p_size": "int", "p_retailprice": "decimal(10,2)", "p_type": "string"}
    register("S05", lambda spark, sf: S.conform_report(read_tables(spark, sf, ["part"])["part"], want),
             union_sql(*[f"SELECT '{c}' AS column, '{t}' AS wanted_type, count({c}) AS non_null, "
                         f"CAST(count_if({c} IS NOT NULL AND TRY_CAST({c} AS {t.replace('int', 'INTEGER').replace('string', 'VARCHAR')}) IS NULL) "
                         f"AS BIGINT) AS failures FROM part" for c, t in want.items()]))
    register("S06", _sample_roundtrip, f"SELECT {ORDERS_SEL} FROM orders")
    register("S07", _profile_roundtrip, profile_sql("part", [("p_partkey", "bigint", True), ("p_name", "string", False),
                                                              ("p_brand", "string", False), ("p_type", "string", False),
                                                              ("p_size", "int", True), ("p_retailprice", "double", True)]))
    sv = {"part": {"p_partkey": "integer", "p_size": "string", "p_container": "string"}}
    register("S08", _schema_roundtrip(sv), _schema_view_sql(sv))
    register("S09", _report_roundtrip, _v2_sql())
    register("S10", _failing_roundtrip, _v3_sql(""))
    c = Check("customer", "column_values_to_not_be_null", "seg", check_id="customer:seg:normalized_not_null")

    def s11(spark, sf):
        t = read_tables(spark, sf, ["customer"])
        t["customer"] = S.normalize_missing(_cust_sentinel(t["customer"]), ["seg"])
        return tidy(validate(t, [c], spark=spark))

    register("S11", s11, row_sql(c.check_id, f"(SELECT CASE WHEN trim(seg) IN ('', 'N/A', 'n/a') THEN NULL ELSE seg END AS seg FROM {CUST_SENT})",
                                 "seg IS NULL", "seg IS NULL", all_rows=True))
    register("S12", _replay_q, _replay_sql())


def _sample_roundtrip(spark, sf):
    from probity.sources import sinks, tables as S

    base = sinks.scratch(spark, "artifacts")
    sinks.write_sample(read_tables(spark, sf, ["orders"])["orders"], base, "tpch", "orders", "r1")
    return _ts_text(S.replay(spark, base, "tpch", "orders", "r1"), ["o_orderdate"])


def _profile_roundtrip(spark, sf):
    from probity.operators.profile import PROFILE_DDL, profile
    from probity.sources import sinks

    path = sinks.scratch(spark, "profiles")
    sinks.write_json(profile(read_tables(spark, sf, ["part"])["part"], "part"), path)
    return round_doubles(sinks.read_json(spark, path, PROFILE_DDL))


def _schema_roundtrip(declared):
    def q(spark, sf):
        from probity.operators.schema import SCHEMA_VIEW_DDL, schema_view
        from probity.sources import sinks

        path = sinks.scratch(spark, "metadata")
        sinks.write_json(schema_view(spark, declared, read_tables(spark, sf, list(declared))), path)
        return sinks.read_json(spark, path, SCHEMA_VIEW_DDL)

    return q


def _report_roundtrip(spark, sf):
    from probity.checks import RESULT_DDL
    from probity.sources import sinks

    path = sinks.scratch(spark, "sandbox")
    sinks.write_json(_v2(spark, sf), path)
    return sinks.read_json(spark, path, RESULT_DDL)


def _failing_roundtrip(spark, sf):
    from probity.sources import sinks

    path = sinks.scratch(spark, "failing_examples")
    df = _v3(spark, sf, n=None)
    sinks.write_failing_csv(df, path)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return sinks.read_csv(spark, path, ddl)


REPLAY_CHECKS = [
    Check("orders", "column_values_to_be_unique", "o_orderkey"),
    Check("orders", "column_values_to_be_in_set", "o_orderstatus", {"value_set": ["F", "O"]}),
    Check("orders", "column_mean_to_be_between", "o_totalprice", {"min_value": 0, "max_value": 300000}),
]


STATISTICS = {
    "orders": {"o_orderdate": [0.01, 0.5, 0.99], "o_orderpriority": [0.25, 0.75], "o_totalprice": [0.0, 0.5, 1.0], "o_orderkey": [0.9]},
    "part": {"p_name": [0.1, 0.5, 0.9], "p_retailprice": [0.33], "p_size": [0.5]},
    "documents": {"text": [0.01, 0.5, 0.99], "source": [0.5], "lang": [0.3, 0.9]},
    "events": {"ts": [0.5, 0.95], "props": [0.5]},
}


def _statistics(spark, sf):
    from probity.operators.quantiles import order_statistics

    t = read_tables(spark, sf, list(STATISTICS))
    out = None
    for name, shares in STATISTICS.items():
        one = order_statistics(t[name], shares).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _statistics_sql() -> str:
    parts = []
    for t, shares in STATISTICS.items():
        for c, ps in shares.items():
            shown = {"o_orderdate": "strftime(v, '%Y-%m-%d %H:%M:%S.%f')", "ts": "strftime(v, '%Y-%m-%d %H:%M:%S.%f')"}.get(c, "CAST(v AS VARCHAR)")
            parts += [f"SELECT '{t}' AS table_name, '{c}' AS column_name, {p}::DOUBLE AS share, n AS non_null, {shown} AS value FROM "
                      f"(SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS k, count(*) OVER () AS n FROM {t} WHERE {c} IS NOT NULL) "
                      f"WHERE k = greatest(1, ceil({p}::DOUBLE * n - 1e-9))" for p in ps]
    return " UNION ALL ".join(parts)


def _replay_q(spark, sf):
    from probity.sources import sinks, tables as S

    base = sinks.scratch(spark, "artifacts")
    sinks.write_sample(read_tables(spark, sf, ["orders"])["orders"], base, "tpch", "orders", "r7")
    replayed = S.replay(spark, base, "tpch", "orders", "r7")
    return tidy(validate({"orders": replayed}, REPLAY_CHECKS, spark=spark))


def _replay_sql():
    src = "orders"
    return union_sql(
        _unique_sql(REPLAY_CHECKS[0].check_id, src, ["o_orderkey"], "any"),
        row_sql(REPLAY_CHECKS[1].check_id, src, "o_orderstatus NOT IN ('F', 'O')", "o_orderstatus IS NULL"),
        agg_sql(REPLAY_CHECKS[2].check_id, src, "o_totalprice", "avg(o_totalprice)", 0, 300000),
    )



# ================================================================== V1-V7

V2_CHECKS = [
    Check("lineitem", "column_values_to_not_be_null", "l_orderkey"),
    Check("lineitem", "column_values_to_be_between", "l_discount", {"min_value": 0, "max_value": 0.07}),
    Check("lineitem", "column_values_to_be_in_set", "l_returnflag", {"value_set": ["A", "N", "R"]}),
    Check("lineitem", "column_values_to_be_unique", "l_orderkey"),
    Check("lineitem", "compound_columns_to_be_unique", ("l_orderkey", "l_linenumber")),
    Check("lineitem", "foreign_key", "l_orderkey", {"parent_table": "orders", "parent_columns": ["o_orderkey"]}),
    Check("lineitem", "column_sum_to_be_between", "l_quantity", {"min_value": 0}),
    Check("lineitem", "column_values_to_match_regex", "l_linestatus", {"regex": "^[FO]$"}),
    Check("lineitem", "column_pair_values_a_to_be_greater_than_b", ("l_extendedprice", "l_quantity")),
    Check("lineitem", "column_mean_to_be_between", "l_tax", {"min_value": 0, "max_value": 0.05}),
]


def _v2(spark, sf):
    return tidy(validate(read_tables(spark, sf, ["lineitem", "orders"]), V2_CHECKS, spark=spark))


def _v2_sql():
    c = V2_CHECKS
    return union_sql(
        row_sql(c[0].check_id, "lineitem", "l_orderkey IS NULL", "l_orderkey IS NULL", all_rows=True),
        row_sql(c[1].check_id, "lineitem", "NOT (l_discount >= 0 AND l_discount <= 0.07)", "l_discount IS NULL"),
        row_sql(c[2].check_id, "lineitem", "l_returnflag NOT IN ('A', 'N', 'R')", "l_returnflag IS NULL"),
        _unique_sql(c[3].check_id, "lineitem", ["l_orderkey"], "any"),
        _unique_sql(c[4].check_id, "lineitem", ["l_orderkey", "l_linenumber"], "all"),
        _fk_sql(c[5].check_id, "lineitem", "l_orderkey", "orders", "o_orderkey"),
        agg_sql(c[6].check_id, "lineitem", "l_quantity", "sum(l_quantity)", 0),
        row_sql(c[7].check_id, "lineitem", "NOT regexp_matches(l_linestatus, '^[FO]$')", "l_linestatus IS NULL"),
        row_sql(c[8].check_id, "lineitem", "NOT (l_extendedprice > l_quantity)", "l_extendedprice IS NULL OR l_quantity IS NULL"),
        agg_sql(c[9].check_id, "lineitem", "l_tax", "avg(l_tax)", 0, 0.05),
    )


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus", "l_shipdate"]
LI_DOUBLES = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
V3_CHECKS = [
    Check("lineitem", "column_values_to_be_between", "l_discount", {"min_value": 0, "max_value": 0.07}),
    Check("lineitem", "column_values_to_be_in_set", "l_returnflag", {"value_set": ["A", "N"]}),
]


def _v3(spark, sf, n=5):
    from probity.plans.report import failing_rows

    li = read_tables(spark, sf, ["lineitem"])["lineitem"]
    return round_doubles(_ts_text(failing_rows(li, V3_CHECKS, order_by=LI_COLS, n=n), ["l_shipdate"]))


def _v3_sql(limit=" LIMIT 5"):
    sel = ", ".join(_ts_sql(c) if c == "l_shipdate" else (f"round({c}, 6) + 0.0 AS {c}" if c in LI_DOUBLES else c) for c in LI_COLS)
    order = ", ".join(LI_COLS)
    preds = ["NOT (l_discount >= 0 AND l_discount <= 0.07)", "l_returnflag NOT IN ('A', 'N')"]
    return union_sql(*[f"SELECT '{c.check_id}' AS check_id, {sel} FROM (SELECT * FROM lineitem WHERE {p} ORDER BY {order}{limit})"
                       for c, p in zip(V3_CHECKS, preds)])


V1_CHECKS = [
    Check("batch", "column_values_to_not_be_null", "c_custkey"),
    Check("batch", "column_values_to_not_be_null", "s_suppkey"),
    Check("batch", "column_values_to_be_unique", "c_name"),
    Check("batch", "column_values_to_be_between", "c_acctbal", {"min_value": -1000, "max_value": 10000}),
]


def _v1(spark, sf):
    from probity.plans.report import combine_batch

    batch = combine_batch(read_tables(spark, sf, ["customer", "supplier"]))
    return tidy(validate({"batch": batch}, V1_CHECKS, spark=spark))


def _v1_sql():
    src = "(SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier)"
    c = V1_CHECKS
    return union_sql(
        row_sql(c[0].check_id, src, "c_custkey IS NULL", "c_custkey IS NULL", all_rows=True),
        row_sql(c[1].check_id, src, "s_suppkey IS NULL", "s_suppkey IS NULL", all_rows=True),
        _unique_sql(c[2].check_id, src, ["c_name"], "any"),
        row_sql(c[3].check_id, src, "NOT (c_acctbal >= -1000 AND c_acctbal <= 10000)", "c_acctbal IS NULL"),
    )


def _v4(spark, sf):
    from probity.plans.report import summary

    return summary(validate(read_tables(spark, sf, ["lineitem", "orders"]), V2_CHECKS, spark=spark), V2_CHECKS)


def _v4_sql():
    meta = " UNION ALL ".join(f"SELECT '{c.check_id}' AS check_id, '{c.table}' AS table_name, '{c.kind}' AS kind" for c in V2_CHECKS)
    return (f"WITH r AS ({_v2_sql()}), m AS ({meta}) SELECT table_name, kind, count(*) AS checks, "
            f"CAST(count_if(success) AS BIGINT) AS passed, CAST(count_if(NOT coalesce(success, FALSE)) AS BIGINT) AS failed "
            f"FROM r JOIN m USING (check_id) GROUP BY ROLLUP (table_name, kind)")


V5_CONTRACT = {
    "models": {
        "orders": {
            "primaryKey": ["o_orderkey"],
            "fields": {
                "o_orderkey": {"type": "integer", "required": True},
                "o_custkey": {"type": "integer", "references": "users.user_id"},
                "o_orderstatus": {"type": "string", "enum": ["F", "O"]},
                "o_totalprice": {"type": "number", "quality": [
                    {"type": "text", "description": "60% of o_totalprice must be less than 300000."}]},
                "o_comment": {"type": "string", "required": True},
            },
        },
        "lineitem": {
            "fields": {
                "l_orderkey": {"type": "integer", "references": "orders.o_orderkey"},
                "l_linestatus": {"type": "string", "quality": [{"type": "text", "description": "Line status looks plausible."}]},
            },
            "quality": [{"rule": "custom", "expression": "l_tax <= l_discount + 0.08", "description": "tax bound"}],
        },
    }
}


def _v5(spark, sf):
    from probity.contract import load_contract
    from probity.plans.report import contract_evaluation

    contract = load_contract(V5_CONTRACT)
    tables = read_tables(spark, sf, contract.tables)
    results = validate(tables, contract.checks, spark=spark)
    return contract_evaluation(spark, contract, results, tables)


def _v5_sql():
    def st(rule_id, table, source, result_sql, kind="row"):
        reason = ("printf('%d unexpected of %d rows', unexpected_count, element_count)" if kind == "row"
                  else "'schema check'")
        return (f"SELECT '{rule_id}' AS rule_id, '{table}' AS table_name, '{source}' AS source, "
                f"CASE WHEN success THEN 'PASS' ELSE 'FAIL' END AS status, {reason} AS reason FROM ({result_sql})")

    def lit(rule_id, table, source, status, reason):
        return (f"SELECT '{rule_id}' AS rule_id, '{table}' AS table_name, '{source}' AS source, "
                f"'{status}' AS status, '{reason}' AS reason")

    def typ(table, col, fam):
        return (f"SELECT (SELECT count(*) FROM information_schema.columns WHERE table_name = '{table}' AND column_name = '{col}' "
                f"AND data_type IN ({_in(_DUCK_FAMILY[fam])})) = 1 AS success")

    return union_sql(
        st("orders:o_orderkey:pk_not_null", "orders", "primaryKey",
           row_sql("x", "orders", "o_orderkey IS NULL", "o_orderkey IS NULL", all_rows=True)),
        st("orders:o_orderkey:primary_key", "orders", "primaryKey", _unique_sql("x", "orders", ["o_orderkey"], "any")),
        st("orders:o_orderkey:not_null", "orders", "field.required",
           row_sql("x", "orders", "o_orderkey IS NULL", "o_orderkey IS NULL", all_rows=True)),
        st("orders:o_orderkey:column_values_to_be_of_type", "orders", "field.type", typ("orders", "o_orderkey", "integer"), "m"),
        st("orders:o_custkey:column_values_to_be_of_type", "orders", "field.type", typ("orders", "o_custkey", "integer"), "m"),
        lit("orders:o_custkey:foreign_key", "orders", "field.references", "SKIPPED", "parent table users is not in the contract"),
        st("orders:o_orderstatus:domain", "orders", "field.enum",
           row_sql("x", "orders", "o_orderstatus NOT IN ('F', 'O')", "o_orderstatus IS NULL")),
        st("orders:o_orderstatus:column_values_to_be_of_type", "orders", "field.type", typ("orders", "o_orderstatus", "string"), "m"),
        st("orders:o_totalprice:column_values_to_be_of_type", "orders", "field.type", typ("orders", "o_totalprice", "number"), "m"),
        st("orders:o_totalprice:share", "orders", "quality.text",
           row_sql("x", "orders", "NOT (o_totalprice < 300000.0)", "o_totalprice IS NULL", mostly=0.6)),
        lit("orders:o_comment:not_null", "orders", "field.required", "ERROR", "table or column absent"),
        lit("orders:o_comment:column_values_to_be_of_type", "orders", "field.type", "ERROR", "table or column absent"),
        st("lineitem:l_orderkey:column_values_to_be_of_type", "lineitem", "field.type", typ("lineitem", "l_orderkey", "integer"), "m"),
        st("lineitem:l_orderkey:foreign_key", "lineitem", "field.references", _fk_sql("x", "lineitem", "l_orderkey", "orders", "o_orderkey")),
        st("lineitem:l_linestatus:column_values_to_be_of_type", "lineitem", "field.type", typ("lineitem", "l_linestatus", "string"), "m"),
        lit("lineitem:l_linestatus:text", "lineitem", "quality.text", "SKIPPED", "text rule not understood"),
        st("lineitem::custom", "lineitem", "model.custom", row_sql("x", "lineitem", "NOT coalesce(l_tax <= l_discount + 0.08, TRUE)")),
    )


V6_OLD = [
    Check("events", "column_values_to_be_in_set", "event_type", {"value_set": EVENT_TYPES}),
    Check("events", "column_values_to_not_be_null", "v"),
    Check("events", "column_values_to_be_between", "value", {"min_value": 0, "max_value": 500}),
]
V6_NEW = [
    Check("events", "column_values_to_be_in_set", "event_type", {"value_set": ["view", "signup", "click", "purchase"]}),
    Check("events", "column_values_to_be_between", "value", {"min_value": 0, "max_value": 300}),
    Check("events", "column_values_to_be_unique", "event_id"),
]


def _v6(spark, sf):
    from probity.plans.report import rows_flipped, suite_change

    t = read_tables(spark, sf, ["events"])
    t["events"] = _ev_v(t["events"])
    return suite_change(validate(t, V6_OLD, spark=spark), validate(t, V6_NEW, spark=spark),
                        rows_flipped(t, V6_OLD, V6_NEW))


V6_BROKEN = [Check("events", "row_condition", (), {"expression": "nowhere > 1"}, check_id=V6_OLD[0].check_id), V6_OLD[1], V6_NEW[2]]


def _v6_states(spark, sf):
    from probity.plans.report import suite_change

    t = read_tables(spark, sf, ["events"])
    t["events"] = _ev_v(t["events"])
    old, new = validate(t, V6_OLD, spark=spark), validate(t, V6_BROKEN, spark=spark)
    return suite_change(old, new).select("check_id", "change", "old_unexpected", "old_success")


def _v6_states_sql() -> str:
    a, b, c = (x.check_id for x in V6_OLD)
    bad = (f"event_type NOT IN ({_in(EVENT_TYPES)})", "v IS NULL", "NOT (value >= 0 AND value <= 500)")
    rows = union_sql(*(f"SELECT '{i}' AS check_id, '{s}' AS change, count_if(coalesce({w}, FALSE))::BIGINT AS old_unexpected, count_if(coalesce({w}, FALSE)) = 0 AS old_success FROM {EV_V}"
                       for i, s, w in zip((a, b, c), ("error", "unchanged", "removed"), bad)))
    return f"{rows} UNION ALL SELECT '{V6_NEW[2].check_id}', 'added', NULL, NULL"


def _v6_sql():
    old = union_sql(
        row_sql(V6_OLD[0].check_id, EV_V, f"event_type NOT IN ({_in(EVENT_TYPES)})", "event_type IS NULL"),
        row_sql(V6_OLD[1].check_id, EV_V, "v IS NULL", "v IS NULL", all_rows=True),
        row_sql(V6_OLD[2].check_id, EV_V, "NOT (value >= 0 AND value <= 500)", "value IS NULL"),
    )
    new = union_sql(
        row_sql(V6_NEW[0].check_id, EV_V, "event_type NOT IN ('view', 'signup', 'click', 'purchase')", "event_type IS NULL"),
        row_sql(V6_NEW[1].check_id, EV_V, "NOT (value >= 0 AND value <= 300)", "value IS NULL"),
        _unique_sql(V6_NEW[2].check_id, "events", ["event_id"], "any"),
    )
    et_old = f"coalesce(event_type IS NOT NULL AND event_type NOT IN ({_in(EVENT_TYPES)}), FALSE)"
    et_new = "coalesce(event_type IS NOT NULL AND event_type NOT IN ('view', 'signup', 'click', 'purchase'), FALSE)"
    v_old = "coalesce(value IS NOT NULL AND NOT (value >= 0 AND value <= 500), FALSE)"
    v_new = "coalesce(value IS NOT NULL AND NOT (value >= 0 AND value <= 300), FALSE)"
    flipped = (f"SELECT '{V6_NEW[0].check_id}' AS check_id, CAST(count_if({et_old} <> {et_new}) AS BIGINT) AS rows_flipped "
               f"FROM {EV_V} UNION ALL SELECT '{V6_NEW[1].check_id}', CAST(count_if({v_old} <> {v_new}) AS BIGINT) FROM {EV_V}")
    return (
        f"WITH o AS ({old}), n AS ({new}), f AS ({flipped}) SELECT coalesce(o.check_id, n.check_id) AS check_id, "
        "CASE WHEN o.success IS NULL AND n.success IS NOT NULL THEN 'added' "
        "WHEN n.success IS NULL AND o.success IS NOT NULL THEN 'removed' "
        "WHEN n.unexpected_count > o.unexpected_count THEN 'tightened' "
        "WHEN n.unexpected_count < o.unexpected_count THEN 'loosened' ELSE 'unchanged' END AS change, "
        "o.unexpected_count AS old_unexpected, n.unexpected_count AS new_unexpected, o.success AS old_success, "
        "n.success AS new_success, coalesce(o.success <> n.success, FALSE) AS verdict_flip, f.rows_flipped "
        "FROM o FULL JOIN n ON o.check_id = n.check_id LEFT JOIN f ON f.check_id = coalesce(o.check_id, n.check_id)"
    )


V6_KEYS_OLD = [
    Check("lineitem", "foreign_key", "l_partkey", {"parent_table": "part", "parent_columns": ["p_partkey"]}, check_id="parts"),
    Check("orders", "column_values_to_be_unique", "o_custkey", check_id="one_order"),
]
V6_KEYS_NEW = [
    Check("lineitem", "foreign_key", "l_partkey", {"parent_table": "supplier", "parent_columns": ["s_suppkey"]}, check_id="parts"),
    Check("orders", "multicolumn_values_to_be_unique", ("o_custkey", "o_orderstatus"), check_id="one_order"),
]


def _v6_keys(spark, sf):
    from probity.plans.report import rows_flipped

    return rows_flipped(read_tables(spark, sf, ["lineitem", "part", "supplier", "orders"]), V6_KEYS_OLD, V6_KEYS_NEW)


_V6_KEYS_SQL = """
SELECT 'parts' AS check_id, count(*) FILTER (WHERE (l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL))
  <> (l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL))) AS rows_flipped FROM lineitem
UNION ALL SELECT 'one_order', count(*) FILTER (WHERE (o_custkey IS NOT NULL AND a > 1) <> (o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL AND b > 1))
FROM (SELECT o_custkey, o_orderstatus, count(*) OVER (PARTITION BY o_custkey) AS a, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS b FROM orders)
"""


def _split_reads(spark, sf):
    """Conditions of parallel reads, judged on whole tables: how many of them each row meets."""
    from probity.sources.tables import split_predicates

    parts = []
    for table, keys, spread in (("lineitem", ["l_orderkey", "l_linenumber"], None), ("events", ["event_type"], ["event_id"]), ("orders", ["o_orderdate"], None)):
        df = read_tables(spark, sf, [table])[table]
        drawn = df.where(F.pmod(F.xxhash64(*df.columns), F.greatest(F.lit(1), df.select(F.floor(F.count(F.lit(1)) / 2000)).scalar())) == 0)
        sample = [tuple(r) for r in drawn.select(*keys).orderBy(*keys).collect()]
        met = F.lit(0)
        for p in split_predicates(keys, sample, 8, spread):
            met = met + F.coalesce(F.expr(p), F.lit(False)).cast("int")
        parts.append(df.select(F.lit(table).alias("table_name"), met.alias("conditions_met")).groupBy("table_name", "conditions_met").agg(F.count(F.lit(1)).alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _v7(spark, sf):
    from probity.operators.profile import profile
    from probity.plans.report import suggest_checks

    from probity.operators.discovery import foreign_keys

    t = read_tables(spark, sf, KEY_TABLES)
    return round_doubles(suggest_checks({"orders": t["orders"]}, profile(t["orders"], "orders"), references=foreign_keys(t), as_of=V7_AS_OF))


def _v7_reasons(spark, sf):
    from probity.operators.profile import profile
    from probity.plans.report import not_suggested

    t = read_tables(spark, sf, ["orders"])
    return round_doubles(not_suggested(profile(t["orders"], "orders"), max_domain=4))


def _v7_reasons_sql():
    text = "data_type = 'string'"
    return (
        f"WITH p AS ({profile_sql('orders', ORDERS_COLS)}), k AS ("
        "SELECT table_name, column_name, 'column_values_to_not_be_null' AS kind, CASE WHEN row_count = 0 THEN 'empty table' WHEN null_count > 0 THEN 'nulls' END AS reason, null_rate AS observed FROM p "
        "UNION ALL SELECT table_name, column_name, 'column_values_to_be_unique', CASE WHEN row_count = 0 THEN 'empty table' WHEN distinct_ratio <> 1 THEN 'repeats or nulls' END, distinct_ratio FROM p "
        "UNION ALL SELECT table_name, column_name, 'column_values_to_be_between', CASE WHEN row_count = 0 THEN 'empty table' WHEN p01 IS NULL THEN 'no order statistics' END, NULL FROM p "
        f"UNION ALL SELECT table_name, column_name, 'column_values_to_be_in_set', CASE WHEN row_count = 0 THEN 'empty table' WHEN NOT ({text}) THEN 'not a text' "
        f"WHEN distinct_count = 0 THEN 'no values' WHEN distinct_count > 4 THEN 'more than 4 values' END, CASE WHEN {text} THEN distinct_count END FROM p) "
        "SELECT table_name, column_name, kind, reason, round(observed, 6) AS observed FROM k WHERE reason IS NOT NULL"
    )


V7_AS_OF = "2024-06-30 00:00:00"
KEY_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
#: Columns of ``KEY_TABLES`` that references are looked for in: integers, texts.
KEY_COLUMNS = {
    "region": (["r_regionkey"], ["r_name"]),
    "nation": (["n_nationkey", "n_regionkey"], ["n_name"]),
    "customer": (["c_custkey", "c_nationkey"], ["c_name", "c_mktsegment"]),
    "supplier": (["s_suppkey", "s_nationkey"], ["s_name"]),
    "part": (["p_partkey", "p_size"], ["p_name", "p_brand", "p_type"]),
    "orders": (["o_orderkey", "o_custkey"], ["o_orderstatus", "o_orderpriority"]),
    "lineitem": (["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], ["l_returnflag", "l_linestatus"]),
    "events": (["event_id", "user_id"], ["event_type", "props"]),
}


def _keys_sql() -> str:
    vals, counts = [], []
    for t, groups in KEY_COLUMNS.items():
        for fam, cs in zip("it", groups):
            for c in cs:
                vals.append(f"SELECT DISTINCT '{fam}' AS fam, '{t}' AS t, '{c}' AS c, CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL")
                counts.append(f"SELECT '{t}' AS t, '{c}' AS c, count(*) AS n, count({c}) AS present FROM {t}")
    return (
        f"vals AS ({' UNION ALL '.join(vals)}), counts AS ({' UNION ALL '.join(counts)}), "
        "own AS (SELECT t, c, count(*) AS n FROM vals GROUP BY t, c), "
        "both_ AS (SELECT a.t AS child_table, a.c AS child_column, b.t AS parent_table, b.c AS parent_column, count(*) AS shared FROM vals a JOIN vals b USING (fam, v) WHERE a.t <> b.t GROUP BY ALL), "
        "fk AS (SELECT b.child_table, b.child_column, b.parent_table, b.parent_column, shared / p.n AS coverage FROM both_ b "
        "JOIN own o ON o.t = child_table AND o.c = child_column AND o.n = shared JOIN own p ON p.t = parent_table AND p.c = parent_column "
        "JOIN counts k ON k.t = parent_table AND k.c = parent_column AND k.n = k.present AND k.n = p.n "
        "JOIN counts m ON m.t = child_table AND m.c = child_column AND m.present > o.n WHERE shared / p.n >= 0.5 "
        "QUALIFY row_number() OVER (PARTITION BY b.child_table, b.child_column ORDER BY shared / p.n DESC, b.parent_table, b.parent_column) = 1)"
    )


def _references(spark, sf):
    from probity.operators.discovery import foreign_keys

    return round_doubles(foreign_keys(read_tables(spark, sf, KEY_TABLES)))


def _candidate_keys(spark, sf):
    from probity.operators.discovery import candidate_keys

    t = read_tables(spark, sf, ["conversations", "lineitem", "nation"])
    found = [(name, ",".join(k)) for name, cols in CANDIDATES.items() for k in candidate_keys(t[name], cols, max_size=2)]
    return spark.createDataFrame(found, "table_name string, key_columns string")


CANDIDATES = {
    "conversations": ["conv_id", "turn", "role"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
}


def _candidate_keys_sql() -> str:
    parts = []
    for t, cs in CANDIDATES.items():
        whole = lambda c: f"(SELECT count(*) > 0 AND count(*) = count(DISTINCT {c}) FROM {t})"  # noqa: E731, B023
        parts += [f"SELECT '{t}' AS table_name, '{c}' AS key_columns WHERE {whole(c)}" for c in cs]
        for i, a in enumerate(cs):
            for b in cs[i + 1:]:
                parts.append(f"SELECT '{t}', '{a},{b}' WHERE NOT {whole(a)} AND NOT {whole(b)} AND {whole(f'({a}, {b})')}")
    return " UNION ALL ".join(parts)


TEXT_COPIES = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


def _inferred(spark, sf):
    from probity.operators.discovery import infer_types
    from probity.sources import tables as S

    t = read_tables(spark, sf, list(TEXT_COPIES))
    out = None
    for name in TEXT_COPIES:
        one = infer_types(S.all_strings(t[name])).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _inferred_sql() -> str:
    from probity.operators.discovery import INTEGER_FORM, NUMBER_FORM, TIME_FORM

    parts = []
    for t, cs in TEXT_COPIES.items():
        for c in cs:
            x = f"CAST({c} AS VARCHAR)"
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS \"column\", count({c}) AS non_null, count_if(regexp_matches({x}, '{INTEGER_FORM}') AND TRY_CAST({x} AS BIGINT) IS NOT NULL)::BIGINT AS n_int, "
                f"count_if(regexp_matches({x}, '{NUMBER_FORM}') AND TRY_CAST({x} AS DOUBLE) IS NOT NULL)::BIGINT AS n_number, "
                f"count_if(regexp_matches({x}, '{TIME_FORM}') AND TRY_CAST({x} AS TIMESTAMP) IS NOT NULL)::BIGINT AS n_time FROM {t}"
            )
    kind = "CASE WHEN non_null = 0 THEN 'void' WHEN n_int = non_null THEN 'bigint' WHEN n_number = non_null THEN 'double' WHEN n_time = non_null THEN 'timestamp' ELSE 'string' END"
    return f"SELECT *, {kind} AS inferred_type FROM ({' UNION ALL '.join(parts)})"


def _v7_sql():
    prof = profile_sql("orders", ORDERS_COLS)
    parts = [
        "SELECT table_name, column_name, 'column_values_to_not_be_null' AS kind, NULL::DOUBLE AS min_value, "
        "NULL::DOUBLE AS max_value, NULL::VARCHAR AS value_set FROM p WHERE row_count > 0 AND null_count = 0",
        "SELECT table_name, column_name, 'column_values_to_be_unique', NULL, NULL, NULL FROM p WHERE row_count > 0 AND distinct_ratio = 1.0",
        "SELECT table_name, column_name, 'column_values_to_be_between', p01, p99, NULL FROM p WHERE p01 IS NOT NULL",
    ]
    for c, st, _ in ORDERS_COLS:
        if st == "string":
            parts.append(
                f"SELECT table_name, column_name, 'column_values_to_be_in_set', NULL, NULL, "
                f"(SELECT to_json(list_sort(list(DISTINCT {c})))::VARCHAR FROM orders) FROM p "
                f"WHERE column_name = '{c}' AND distinct_count BETWEEN 1 AND 20"
            )
    parts.append("SELECT child_table, child_column, 'foreign_key', NULL, NULL, '{\"parent_table\": \"' || parent_table || '\", \"parent_columns\": [\"' || parent_column || '\"]}' FROM fk WHERE child_table = 'orders'")
    parts.append(f"SELECT 'orders', 'o_orderdate', 'freshness', NULL, CAST(trunc(epoch(TIMESTAMP '{V7_AS_OF}' - max(o_orderdate)) / 60) AS DOUBLE), '{{\"as_of\": \"{V7_AS_OF}\"}}' FROM orders")
    return f"WITH p AS ({prof}), {_keys_sql()} " + " UNION ALL ".join(parts)


V3_KEY_CHECKS = [Check("lineitem", "compound_columns_to_be_unique", ("l_orderkey", "l_linenumber"))]
V3_FK_CHECKS = [Check("documents", "foreign_key", "doc_id", {"parent_table": "labels", "parent_columns": ["doc_id"]})]


def _v3_keys(spark, sf):
    from probity.plans.report import failing_rows

    li = read_tables(spark, sf, ["lineitem"])["lineitem"]
    return round_doubles(_ts_text(failing_rows(li, V3_KEY_CHECKS, order_by=LI_COLS, n=5), ["l_shipdate"]))


def _v3_keys_sql():
    sel = ", ".join(_ts_sql(c) if c == "l_shipdate" else (f"round({c}, 6) + 0.0 AS {c}" if c in LI_DOUBLES else c) for c in LI_COLS)
    order = ", ".join(LI_COLS)
    return (f"SELECT '{V3_KEY_CHECKS[0].check_id}' AS check_id, {sel} FROM (SELECT * FROM lineitem WHERE (l_orderkey, l_linenumber) IN "
            f"(SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY ALL HAVING count(*) > 1) ORDER BY {order} LIMIT 5)")


def _v3_fk(spark, sf):
    from probity.plans.report import failing_rows

    t = read_tables(spark, sf, ["documents", "labels"])
    return failing_rows(t["documents"], V3_FK_CHECKS, order_by=["doc_id"], n=5, tables=t)


def _v3_fk_sql():
    return (f"SELECT '{V3_FK_CHECKS[0].check_id}' AS check_id, * FROM (SELECT * FROM documents WHERE doc_id NOT IN "
            f"(SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) ORDER BY doc_id LIMIT 5)")


V3_ORDER_CHECKS = [Check("events", "column_values_to_be_increasing", "value", {"order_by": "ts"}, check_id="events:value:increasing_by_ts")]


def _v3_order(spark, sf):
    from probity.plans.report import failing_rows

    ev = read_tables(spark, sf, ["events"])["events"]
    return round_doubles(_ts_text(failing_rows(ev, V3_ORDER_CHECKS, order_by=["ts", "value", "event_id"], n=5), ["ts"]))


def _v3_order_sql():
    return (f"SELECT '{V3_ORDER_CHECKS[0].check_id}' AS check_id, event_id, {_ts_sql('ts')}, user_id, event_type, "
            f"round(value, 6) + 0.0 AS value, props FROM (SELECT * FROM (SELECT *, lag(value) OVER (ORDER BY ts, value) AS prev "
            f"FROM events WHERE value IS NOT NULL AND ts IS NOT NULL) WHERE prev IS NOT NULL AND NOT (value > prev) "
            f"ORDER BY ts, value, event_id LIMIT 5)")


V3_ALL_CHECKS = [
    Check("customer", "column_values_to_be_unique", "seg", {"trim": True, "case_insensitive": True}, check_id="customer:seg:unique"),
    Check("customer", "foreign_key", "seg", {"trim": True, "case_insensitive": True, "parent_table": "known", "parent_columns": ["c_mktsegment"]},
          check_id="customer:seg:known"),
]
SEG = ("CASE WHEN c_custkey % 3 = 0 THEN concat(lower(c_mktsegment), '  ') WHEN c_custkey % 3 = 1 THEN concat(' ', c_mktsegment) "
       "ELSE concat(c_mktsegment, '-', CAST(c_custkey AS VARCHAR(20))) END")


def _v3_all(spark, sf):
    from probity.plans.report import failing_rows

    cust = read_tables(spark, sf, ["customer"])["customer"]
    known = cust.where("c_mktsegment <> 'BUILDING'").select("c_mktsegment")
    df = cust.select("c_custkey", F.expr(SEG).alias("seg"))
    return failing_rows(df, V3_ALL_CHECKS, tables={"customer": df, "known": known})


def _v3_all_sql():
    src = f"(SELECT c_custkey, {SEG} AS seg FROM customer)"
    return union_sql(
        f"SELECT '{V3_ALL_CHECKS[0].check_id}' AS check_id, * FROM {src} WHERE lower(trim(seg)) IN "
        f"(SELECT lower(trim(seg)) FROM {src} GROUP BY 1 HAVING count(*) > 1)",
        f"SELECT '{V3_ALL_CHECKS[1].check_id}' AS check_id, * FROM {src} WHERE lower(trim(seg)) NOT IN "
        "(SELECT lower(c_mktsegment) FROM customer WHERE c_mktsegment <> 'BUILDING')",
    )


GROWN_CHECKS = [
    Check("lineitem", "column_values_to_be_between", "l_discount", {"max_value": 0.07}, mostly=0.7),
    Check("lineitem", "column_values_to_be_in_set", "l_returnflag", {"value_set": ["A", "N"]}),
    Check("lineitem", "column_max_to_be_between", "l_quantity", {"min_value": 10, "max_value": 50}),
    Check("lineitem", "column_min_to_be_between", "l_quantity", {"min_value": 2}),
    Check("lineitem", "column_mean_to_be_between", "l_extendedprice", {"min_value": 1000, "max_value": 100000}),
    Check("lineitem", "column_sum_to_be_between", "l_linenumber", {"min_value": 1}),
    Check("lineitem", "table_row_count_to_be_between", (), {"min_value": 10}),
]


def _grown(spark, sf):
    """Two thirds of lineitem validated, the rest appended, validated again: only the new files are scanned."""
    from probity.plans.states import validate_grown
    from probity.sources import sinks

    base = sinks.scratch(spark, "grown")
    li = read_tables(spark, sf, ["lineitem"])["lineitem"]
    for part in ("l_orderkey % 3 <> 0", "l_orderkey % 3 = 0"):
        li.where(part).write.mode("append").parquet(f"{base}/table")
        out = validate_grown(spark, f"{base}/table", f"{base}/states", GROWN_CHECKS)
        out.count()
    return tidy(out)


def _grown_sql() -> str:
    c = GROWN_CHECKS
    return union_sql(
        row_sql(c[0].check_id, "lineitem", "l_discount > 0.07", "l_discount IS NULL", mostly=0.7),
        row_sql(c[1].check_id, "lineitem", "l_returnflag NOT IN ('A', 'N')", "l_returnflag IS NULL"),
        agg_sql(c[2].check_id, "lineitem", "l_quantity", "max(l_quantity)", 10, 50),
        agg_sql(c[3].check_id, "lineitem", "l_quantity", "min(l_quantity)", 2),
        agg_sql(c[4].check_id, "lineitem", "l_extendedprice", "avg(l_extendedprice)", 1000, 100000),
        agg_sql(c[5].check_id, "lineitem", "l_linenumber", "sum(l_linenumber)", 1),
        final_sql(c[6].check_id, "n", "0", "NULL", "NULL", "n >= 10", "n", "(SELECT count(*) AS n FROM lineitem)"),
    )


V3_MASK_RULES = [
    ("quantity", "column_values_to_be_between", "l_quantity", {"min_value": 5, "max_value": 45}, "NOT (l_quantity >= 5 AND l_quantity <= 45)"),
    ("discount", "column_values_to_be_between", "l_discount", {"max_value": 0.07}, "l_discount > 0.07"),
    ("tax", "column_values_to_be_between", "l_tax", {"max_value": 0.05}, "l_tax > 0.05"),
    ("flag", "column_values_to_be_in_set", "l_returnflag", {"value_set": ["A", "N"]}, "l_returnflag NOT IN ('A', 'N')"),
    ("status", "column_values_to_not_be_in_set", "l_linestatus", {"value_set": ["F"]}, "l_linestatus IN ('F')"),
    ("line", "column_values_to_be_between", "l_linenumber", {"max_value": 5}, "l_linenumber > 5"),
    ("flag_regex", "column_values_to_match_regex", "l_returnflag", {"regex": "^[AR]$"}, "NOT regexp_matches(l_returnflag, '^[AR]$')"),
    ("flag_length", "column_value_lengths_to_equal", "l_returnflag", {"value": 2}, "length(l_returnflag) <> 2"),
    ("custom", "row_condition", "l_extendedprice", {"expression": "l_extendedprice > 2000 * l_quantity / 2"}, "NOT (l_extendedprice > 2000 * l_quantity / 2)"),
    ("null", "column_values_to_be_null", "l_suppkey", {}, "l_suppkey IS NOT NULL AND l_suppkey % 2 >= 0"),
]
V3_MASK = [Check("lineitem", kind, col, dict(params), check_id=f"mask:{name}") for name, kind, col, params, _ in V3_MASK_RULES]


def _v3_mask(spark, sf):
    from probity.plans.report import broken_mask

    li = read_tables(spark, sf, ["lineitem"])["lineitem"]
    return broken_mask(li, V3_MASK).groupBy("broken").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("l_orderkey").alias("n_orders"), F.sum(F.col("l_linenumber").cast("long")).alias("lines"))


def _v3_mask_sql():
    bits = " || ".join(f"CASE WHEN {bad} THEN '1' ELSE '0' END" for *_, bad in V3_MASK_RULES)
    return (f"SELECT broken, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, sum(l_linenumber)::BIGINT AS lines "
            f"FROM (SELECT *, {bits} AS broken FROM lineitem) WHERE contains(broken, '1') GROUP BY broken")


V6_LONG = [Check("events", "column_values_to_be_in_set", "user_id", {"value_set": list(range(0, n, k))}) for n, k in ((4000, 2), (6000, 3))]


def _v6_long(spark, sf):
    from probity.plans.report import rows_flipped, suite_change

    t = read_tables(spark, sf, ["events"])
    old, new = V6_LONG[:1], V6_LONG[1:]
    return suite_change(validate(t, old, spark=spark), validate(t, new, spark=spark), rows_flipped(t, old, new))


def _v6_long_sql():
    bad = [f"(user_id < 0 OR user_id >= {n} OR user_id % {k} <> 0)" for n, k in ((4000, 2), (6000, 3))]
    o, n = (row_sql(V6_LONG[0].check_id, "events", b, "user_id IS NULL") for b in bad)
    return (
        f"WITH o AS ({o}), n AS ({n}) SELECT o.check_id, CASE WHEN n.unexpected_count > o.unexpected_count THEN 'tightened' "
        "WHEN n.unexpected_count < o.unexpected_count THEN 'loosened' ELSE 'unchanged' END AS change, "
        "o.unexpected_count AS old_unexpected, n.unexpected_count AS new_unexpected, o.success AS old_success, n.success AS new_success, "
        f"o.success <> n.success AS verdict_flip, (SELECT count_if({bad[0]} <> {bad[1]}) FROM events)::BIGINT AS rows_flipped "
        "FROM o JOIN n USING (check_id)"
    )


def _reg_reports():
    register("V03e", _v3_all, _v3_all_sql())
    register("V06b", _v6_long, _v6_long_sql())
    register("V01", _v1, _v1_sql())
    register("V02", _v2, _v2_sql())
    register("V03", _v3, _v3_sql())
    register("V03b", _v3_keys, _v3_keys_sql())
    register("V03c", _v3_fk, _v3_fk_sql())
    register("V03d", _v3_order, _v3_order_sql())
    register("V04", _v4, _v4_sql())
    register("V05", _v5, _v5_sql())
    register("V06", _v6, _v6_sql())
    register("V06c", _v6_states, _v6_states_sql())
    register("V06d", _v6_keys, _V6_KEYS_SQL)
    register("S01b", _split_reads, union_sql(*[f"SELECT '{t}' AS table_name, 1 AS conditions_met, count(*) AS row_count FROM {t}" for t in ("lineitem", "events", "orders")]))
    register("V07", _v7, _v7_sql())
    register("V07d", _v7_reasons, _v7_reasons_sql())
    register("V07b", _references, f"WITH {_keys_sql()} SELECT child_table, child_column, parent_table, parent_column, round(coverage, 6) AS coverage FROM fk")
    register("V07c", _candidate_keys, _candidate_keys_sql())
    register("S05b", _inferred, _inferred_sql())
    register("S12b", _grown, _grown_sql())
    register("E15b", _statistics, _statistics_sql())
    register("V03f", _v3_mask, _v3_mask_sql())


_reg_sources()
_reg_reports()


def _with_rows(name: str, table: str, column: str) -> None:
    """Schema facts read no rows: their suites also hold a check of the rows, in one result."""
    facts, sql = QUERIES[name], ORACLE[name]
    chk = Check(table, "column_values_to_not_be_null", column, check_id=f"{table}:{column}:{name}:rows")

    def both(spark, sf):
        return facts(spark, sf).unionByName(tidy(validate(read_tables(spark, sf, [table]), [chk], spark=spark)))

    register(name, both, union_sql(sql, row_sql(chk.check_id, table, f"{column} IS NULL", f"{column} IS NULL", all_rows=True)))


def _text_orders(df):
    """A text copy of orders, as a CSV source gives it, with a day that not every February has."""
    day = F.concat(F.lit("2001-02-"), F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, "0"))
    return df.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("o_rank"), day.alias("o_day"))


_TEXT_ORDERS = "(SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority, o_orderpriority[1] AS o_rank, day(o_orderdate) AS d FROM orders)"


def _with_values(name: str, table: str, checks: list[Check], derive, *parts: str) -> None:
    """Type checks are facts of a typed table's schema and tests of a text table's values: both, in one result."""
    facts, sql, values = QUERIES[name], ORACLE[name], one(table, checks, derive=derive)
    register(name, lambda spark, sf: facts(spark, sf).unionByName(values(spark, sf)), union_sql(sql, *parts))


def _reg_value_types():
    from probity.contract import load_contract

    cut = lambda df: df.withColumn("two", F.substring("props", 7, 2))
    c = Check("events", "column_values_to_be_in_type_list", "two", {"type_list": ["INT(11) unsigned", "date"], "value_test": True}, check_id="events:two:values")
    _with_values("E27", "events", [c], cut, row_sql(c.check_id, "events", "NOT regexp_full_match(props[7:8], '[0-9]+')", "props IS NULL"))
    cs = [Check("orders", "column_values_to_be_of_type", col, {"type_": t, "value_test": True}, check_id=f"orders:{col}:values") for col, t in (("o_day", "date"), ("o_rank", "mediumint"))]
    _with_values("E31", "orders", cs, _text_orders, row_sql(cs[0].check_id, _TEXT_ORDERS, "d > 28", "d IS NULL"),
                 row_sql(cs[1].check_id, _TEXT_ORDERS, "NOT regexp_full_match(o_rank, '[0-9]+')", "o_rank IS NULL"))
    fields = {"o_orderkey": {"type": "integer"}, "o_orderpriority": {"type": "integer"}, "o_day": {"type": "date"}}
    rules = load_contract({"models": {"orders": {"fields": fields}}}, text_values=True).checks
    _with_values("C04", "orders", rules, _text_orders, row_sql(rules[0].check_id, _TEXT_ORDERS, "FALSE", "o_orderkey IS NULL"),
                 row_sql(rules[1].check_id, _TEXT_ORDERS, "NOT regexp_full_match(o_orderpriority, '[0-9]+')", "o_orderpriority IS NULL"),
                 row_sql(rules[2].check_id, _TEXT_ORDERS, "d > 28", "d IS NULL"))


_reg_value_types()


for _name, _table, _column in (
    ("E18", "orders", "o_orderkey"), ("E50", "orders", "o_custkey"), ("E51", "orders", "o_orderstatus"),
    ("E52", "orders", "o_orderdate"), ("E53", "orders", "o_totalprice"),
):
    _with_rows(_name, _table, _column)
