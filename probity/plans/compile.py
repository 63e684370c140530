"""Compile a suite of checks into as few Spark passes as possible.

Per table:

* **A** (row predicates and column aggregates): ONE ``df.agg(...)`` holding
  every check (split in blocks of at most ``MAX_AGGS`` aggregate expressions to
  stay inside whole-stage codegen).  Identical aggregates (``count(1)``,
  ``count_if(c IS NULL)``) are de-duplicated by Catalyst.  The one-row output is melted to one row per
  check with ``explode(array(struct...))``.
* **G** (uniqueness, distinct sets, KL, most-common): one ``groupBy(key)``
  per distinct column tuple, shared by all checks on that tuple, then one
  aggregate over the (small) groups table.
* **J** foreign keys / query comparison, **O** ordered
  checks: one plan each (a foreign key reuses the G pass's shuffle of its key).
* **M** schema facts: computed on the driver from ``df.schema``.

Everything is lazy; the union of all parts is the result DataFrame.
"""

from __future__ import annotations

from collections import OrderedDict
from contextlib import contextmanager
from typing import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.checks import RESULT_COLUMNS, RESULT_DDL, Check
from probity.operators.aggregates import AGG_RULES, rank_requests
from probity.operators.keys import (
    DISTINCT_ONLY, GROUP_RULES, bag_difference_by_digest, bag_difference_count, foreign_key_counts, groups_of, is_whole, key_of, word_groups_of,
)
from probity.operators.measure import Measure
from probity.operators.ordered import ordered_counts
from probity.operators.rowlevel import ROW_RULES, with_verdicts
from probity.operators.schema import evaluate_schema_check

_TYPES = {
    "check_id": "string",
    "element_count": "bigint",
    "missing_count": "bigint",
    "unexpected_count": "bigint",
    "unexpected_percent": "double",
    "success": "boolean",
    "observed_value": "double",
}


def finish(chk: Check, fields: dict[str, Column]) -> Column:
    """Complete the result fields of one check and pack them in a struct."""
    f = dict(fields)
    bad = f.get("unexpected_count")
    judged = f.pop("judged", None)
    if judged is not None:
        f.setdefault(
            "unexpected_percent",
            F.when(judged > 0, F.lit(100.0) * bad / judged).otherwise(F.lit(0.0)),
        )
        if chk.must_be_less_than is not None:
            t = F.lit(float(chk.must_be_less_than))
            if chk.unit == "percent":
                share = F.when(f["element_count"] > 0, F.lit(100.0) * bad / f["element_count"]).otherwise(F.lit(0.0))
                f.setdefault("success", share < t)
            else:
                f.setdefault("success", bad < t)
        elif chk.p("share"):
            # T1 ">95%": share of good rows strictly above; T2 "<5%": share of bad rows strictly below
            from probity.functions.thresholds import parse_share

            side, v = parse_share(chk.p("share"))
            good = (judged - bad).cast("double") / judged
            cond = (good > F.lit(v)) if side == "good_above" else ((F.lit(1.0) - good) < F.lit(v))
            f.setdefault("success", F.when(judged == 0, F.lit(True)).otherwise(cond))
        else:
            # success ratio good / judged >= mostly (exact at the boundary; empty passes)
            ratio = (judged - bad).cast("double") / judged
            f.setdefault("success", F.when(judged == 0, F.lit(True)).otherwise(ratio >= F.lit(float(chk.mostly))))
    elif chk.must_be_less_than is not None and "observed_value" in f and "success" not in f:
        f["success"] = F.coalesce(f["observed_value"] < F.lit(float(chk.must_be_less_than)), F.lit(False))
    f["check_id"] = F.lit(chk.check_id)
    cols = [
        (f[name] if name in f and f[name] is not None else F.lit(None)).cast(_TYPES[name]).alias(name)
        for name in RESULT_COLUMNS
    ]
    return F.struct(*cols)


def _melt(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _measure_of(chk: Check, df: DataFrame, tables: dict[str, DataFrame], prepared=None) -> Measure:
    if chk.kind in ROW_RULES:
        return ROW_RULES[chk.kind](chk, df).to_measure()
    if chk.kind in AGG_RULES:
        return AGG_RULES[chk.kind](chk, df, tables, prepared=prepared)
    raise ValueError(f"{chk.kind} is not a fused-pass check")


def _prepare_ranks(df: DataFrame, checks: list[Check]) -> dict[str, object]:
    """Exact medians / quantiles of all checks, resolved together by bounded selection."""
    from probity.operators import quantiles as Q

    wants, owner = [], []
    for chk in checks:
        for w in rank_requests(chk):
            wants.append(w)
            owner.append(chk)
    if not wants:
        return {}
    got = Q.select_ranks(df, wants)
    out: dict[str, list] = {}
    for chk, (n, vals) in zip(owner, got):
        out.setdefault(chk.check_id, []).append(vals)
    prepared = {}
    for chk in checks:
        if chk.check_id not in out:
            continue
        lists = out[chk.check_id]
        if chk.kind == "column_median_to_be_between":
            prepared[chk.check_id] = Q.median_of(lists[0])
        else:
            prepared[chk.check_id] = [v[0] if v else None for v in lists]
    return prepared


# Aggregate expressions per fused aggregate (before Catalyst's de-duplication of
# the shared ones).  Past ~100 distinct aggregate fields Spark drops whole-stage
# codegen for the aggregate (measured: 120 range checks in one operator ran 6x
# slower than three operators of 40); one more scan per block is cheaper.
MAX_AGGS = 150


def _fused(df: DataFrame, checks: list[Check], tables: dict[str, DataFrame], prepared: dict) -> DataFrame:
    blocks: list[tuple[list[Column], list[Column]]] = [([], [])]
    df = with_verdicts(df, checks)
    for i, chk in enumerate(checks):
        if prepared.get(chk.check_id) is _UNRESOLVED:
            raise ValueError(f"{chk.check_id}: order statistics could not be computed")
        m = _measure_of(chk, df, tables, prepared.get(chk.check_id, None) if chk.check_id in prepared else None)
        if blocks[-1][0] and len(blocks[-1][0]) + len(m.aggs) > MAX_AGGS:
            blocks.append(([], []))
        aggs, structs = blocks[-1]
        names = {}
        for name, expr in m.aggs.items():
            alias = f"a{i}_{name}"
            names[name] = alias
            aggs.append(expr.alias(alias))
        structs.append(finish(chk, m.result(lambda n, _names=names: F.col(_names[n]))))
    parts = [_melt(df.agg(*aggs), structs) for aggs, structs in blocks if aggs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fused_pass(
    df: DataFrame, checks: list[Check], tables: dict[str, DataFrame], errors: list | None = None, prepared: dict | None = None
) -> DataFrame:
    """All A checks of one table in one aggregate.

    Plans are analysed when built, so a check that cannot be planned (a custom
    expression naming an unknown column, a wrong type) is found here: the
    suite is then re-planned without it and the check is reported in
    ``errors`` instead of failing the whole suite."""
    if prepared is None:
        prepared = _prepare_ranks(df, checks)
    try:
        return _fused(df, checks, tables, prepared)
    except (AnalysisException, ValueError, TypeError, KeyError):
        if errors is None:
            raise
    good = []
    for chk in checks:
        try:
            _fused(df, [chk], tables, prepared)
            good.append(chk)
        except (AnalysisException, ValueError, TypeError, KeyError):
            errors.append(chk)
    return _fused(df, good, tables, prepared) if good else None


def group_pass(df: DataFrame, key: tuple[str, ...], checks: list[Check]) -> DataFrame:
    """All G checks on one column tuple (and normalisation) share one groupBy; where only the number of
    distinct whole numbers is asked for, it groups bits of 64-bit words and not values."""
    from probity.functions.predicates import normalized

    probe = checks[0]
    if probe.p("trim") or probe.p("case_insensitive"):
        df = df.select(*[(normalized(F.col(c), probe).alias(c) if c in key else F.col(c)) for c in df.columns])
    counted = all(c.kind in DISTINCT_ONLY for c in checks) and is_whole(df.schema[key[0]].dataType)
    groups = word_groups_of(df, key[0]) if counted else groups_of(df, key)
    aggs, structs = [], []
    for i, chk in enumerate(checks):
        m = GROUP_RULES[chk.kind](chk, groups, df)
        names = {}
        for name, expr in m.aggs.items():
            alias = f"g{i}_{name}"
            names[name] = alias
            aggs.append(expr.alias(alias))
        structs.append(finish(chk, m.result(lambda n, _names=names: F.col(_names[n]))))
    return _melt(groups.agg(*aggs), structs)


def _foreign_key(chk: Check, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    from probity.functions.predicates import normalized

    parent = tables[chk.p("parent_table")]
    fk, pk = list(chk.columns), list(chk.p("parent_columns"))
    if chk.p("trim") or chk.p("case_insensitive"):
        df = df.select(*[normalized(F.col(c), chk).alias(c) for c in fk])
        parent = parent.select(*[normalized(F.col(c), chk).alias(c) for c in pk])
    counts = foreign_key_counts(df, fk, parent, pk)
    fields = {
        "element_count": F.col("n"),
        "missing_count": F.col("miss"),
        "unexpected_count": F.col("bad"),
        "judged": F.col("n") - F.col("miss"),
        "observed_value": F.col("bad_keys").cast("double"),
    }
    return _melt(counts, [finish(chk, fields)])


def _query_compare(chk: Check, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    spark = df.sparkSession
    with table_views(spark, tables):
        a = spark.sql(chk.p("base_query"))
        b = spark.sql(chk.p("comparison_query"))
    # digests=True: for results that are mostly equal, rows are shuffled only where digests of buckets differ
    counts = bag_difference_by_digest(a, b) if chk.p("digests") else bag_difference_count(a, b)
    bad = F.col("a_only") + F.col("b_only")
    fields = {
        "element_count": F.lit(None),
        "missing_count": F.lit(None),
        "unexpected_count": bad,
        "observed_value": bad.cast("double"),
        "success": bad == 0,
    }
    return _melt(counts, [finish(chk, fields)])


def _sql_scalar(chk: Check, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Contract ``type: sql``: a scalar query compared with ``must_be_less_than``.

    A query that is one quantile goes through the bounded selection of
    ``quantiles.select_ranks`` instead of a whole-column percentile."""
    from probity.functions.sqltext import quantile_query, to_spark_sql
    from probity.operators import quantiles as Q

    spark = df.sparkSession
    parts = quantile_query(chk.p("query"))
    with table_views(spark, tables):
        if parts is not None:
            expr, share, rest = parts
            column = spark.sql(f"SELECT CAST({expr} AS DOUBLE) AS v FROM {rest}")
        else:
            q = spark.sql(to_spark_sql(chk.p("query")))
    if parts is not None:
        _, found = Q.select_ranks(column, [("v", *Q.disc(share))])[0]
        q = spark.range(1).select(F.lit(float(found[0]) if found and found[0] is not None else None).cast("double").alias("v"))
    if len(q.columns) != 1:
        raise ValueError(f"{chk.check_id}: the query must return one column")
    val = q.select(F.col(f"`{q.columns[0]}`").cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v"))
    one = F.col("n") == 1
    from probity.operators.measure import between

    if chk.must_be_less_than is None:
        ok = between(F.col("v"), chk.p("min_value"), chk.p("max_value"))
    else:
        ok = F.coalesce(F.col("v") < F.lit(float(chk.must_be_less_than)), F.lit(False))
    # more or fewer rows than one: not a scalar, so no verdict
    fields = {"observed_value": F.when(one, F.col("v")), "success": F.when(one, ok)}
    return _melt(val, [finish(chk, fields)])


def _ordered(chk: Check, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    counts = ordered_counts(df, chk)
    fields = {
        "element_count": F.col("n"),
        "missing_count": F.col("miss"),
        "unexpected_count": F.col("bad"),
        "judged": F.col("n") - F.col("miss"),
    }
    return _melt(counts, [finish(chk, fields)])


_JOIN = {
    "foreign_key": _foreign_key,
    "query_results_to_match_comparison": _query_compare,
    "sql_scalar": _sql_scalar,
}


@contextmanager
def table_views(spark: SparkSession, tables: dict[str, DataFrame]):
    """The tables under their names while SQL is analysed; temporary views of the session come back afterwards."""
    before = {}
    for name, t in tables.items():
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
            before[name] = spark.table(name)
        t.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in tables:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _needed_columns(chk: Check) -> list[str]:
    cols = list(chk.columns)
    for key in ("order_by", "tie_breaker"):
        if chk.p(key):
            cols.append(chk.p(key))
    cols += list(chk.p("partition_by") or [])
    return cols


def _absent_row(chk: Check, reason: str) -> tuple:
    """Table or column absent: success false with null counts.  A check that
    could not be planned (``reason='error'``) has success null (unknown)."""
    return (chk.check_id, None, None, None, None, None if reason == "error" else False, None)


def _prepare_all(tables: dict[str, DataFrame], by_table: dict[str, list[Check]]):
    """Start the exact-quantile jobs of every table in the background; returns
    ``(pool, {table: future})`` (the pool is shut down by the caller)."""
    from concurrent.futures import ThreadPoolExecutor

    todo = {
        t: [c for c in chks if c.pass_kind == "A" and rank_requests(c)
            and all(col in tables[t].columns for col in c.columns)]
        for t, chks in by_table.items() if t in tables
    }
    todo = {t: cs for t, cs in todo.items() if cs}
    if not todo:
        return None, {}

    def prep(t):
        try:
            return _prepare_ranks(tables[t], todo[t])
        except (AnalysisException, ValueError, TypeError):
            # e.g. a quantile of a column that has no order: these checks become errors
            return {c.check_id: _UNRESOLVED for c in todo[t]}

    pool = ThreadPoolExecutor(max_workers=min(8, len(todo)))
    return pool, {t: pool.submit(prep, t) for t in todo}


_UNRESOLVED = object()


def validate(
    tables: dict[str, DataFrame], checks: Iterable[Check], block: int = 200, spark: SparkSession | None = None
) -> DataFrame:
    """Evaluate ``checks`` over ``tables``; one result row per check (``RESULT_COLUMNS``)."""
    checks = list(checks)
    seen = set()
    for c in checks:
        if c.check_id in seen:
            raise ValueError(f"duplicate check_id {c.check_id}; give explicit ids")
        seen.add(c.check_id)
    if spark is None:
        spark = next(iter(tables.values())).sparkSession
    parts: list[DataFrame] = []
    literal: list[tuple] = []
    by_table: "OrderedDict[str, list[Check]]" = OrderedDict()
    for c in checks:
        by_table.setdefault(c.table, []).append(c)

    # exact quantiles need a few eager scalar jobs per table: they run in the
    # background (tables side by side) while the other passes are planned
    pool, prepared_of = _prepare_all(tables, by_table)
    fused_of: "OrderedDict[str, list[Check]]" = OrderedDict()

    for table, chks in by_table.items():
        df = tables.get(table)
        if df is None:
            literal += [_absent_row(c, "table") for c in chks]
            continue
        fused, grouped, singles = [], OrderedDict(), []
        for c in chks:
            if c.pass_kind != "M" and any(col not in df.columns for col in _needed_columns(c)):
                literal.append(_absent_row(c, "column"))
            elif c.pass_kind == "M":
                r = evaluate_schema_check(c, df)
                literal.append(tuple(r[k] for k in RESULT_COLUMNS))
            elif c.pass_kind == "A":
                fused.append(c)
            elif c.pass_kind == "G":
                grouped.setdefault((key_of(c), bool(c.p("trim")), bool(c.p("case_insensitive"))), []).append(c)
            else:
                singles.append(c)
        errors: list[Check] = []
        fused_of[table] = fused
        for (key, _, _), gchks in grouped.items():
            try:
                parts.append(group_pass(df, key, gchks))
            except (AnalysisException, ValueError, TypeError, KeyError):  # a key that cannot be grouped
                errors.extend(gchks)
        for c in singles:
            try:
                parts.append(_ordered(c, df, tables) if c.pass_kind == "O" else _JOIN[c.kind](c, df, tables))
            except (AnalysisException, ValueError, TypeError, KeyError):
                errors.append(c)
        literal += [_absent_row(c, "error") for c in errors]

    for table, fused in fused_of.items():
        df, errors = tables[table], []
        prepared = prepared_of[table].result() if table in prepared_of else {}
        for i in range(0, len(fused), block):
            part = fused_pass(df, fused[i : i + block], tables, errors, prepared)
            if part is not None:
                parts.append(part)
        literal += [_absent_row(c, "error") for c in errors]
    if pool is not None:
        pool.shutdown()

    if literal:
        parts.append(spark.createDataFrame(literal, RESULT_DDL))
    if not parts:
        return spark.createDataFrame([], RESULT_DDL)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_tables(spark: SparkSession, base: str, checks: Iterable[Check], fmt: str = "parquet") -> DataFrame:
    """Read every table the checks (and their foreign keys) name from ``base/<table>.<fmt>``."""
    from probity.sources.tables import read_tables

    checks = list(checks)
    names = set()
    for c in checks:
        names.add(c.table)
        for key in ("parent_table", "other_table_name", "other_table"):
            if c.p(key):
                names.add(c.p(key))
    return validate(read_tables(spark, base, sorted(names), fmt=fmt), checks, spark=spark)


def explain_suite(tables: dict[str, DataFrame], checks: Iterable[Check], mode: str = "formatted") -> str:
    """The physical plan of the compiled suite as text (``DataFrame.explain``):
    one place to see the scans with their pushed filters and pruned schemas,
    the exchanges, and which passes the checks were fused into."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        validate(tables, checks).explain(mode=mode)
    return buf.getvalue()
