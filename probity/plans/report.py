"""Validation reports (V1-V7): combined batch, failing rows, roll-up, contract
evaluation, suite-change impact and check suggestion.

All inputs that reach the driver are bounded by the number of checks or of
columns (check metadata, one result row per check, one profile row per
column); data rows never do.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.checks import Check
from probity.operators.rowlevel import ROW_RULES, with_verdicts

# ----------------------------------------------------------------- V1


def combine_batch(tables: dict[str, DataFrame]) -> DataFrame:
    """V1: the reference validates all samples concatenated into one wide frame.

    ``unionByName(allowMissingColumns=True)``; a column whose type differs
    between tables is cast to string in all of them first (string with int
    would otherwise coerce to BIGINT and fail under ANSI)."""
    seen: dict[str, T.DataType] = {}
    conflict: set[str] = set()
    for df in tables.values():
        for f in df.schema.fields:
            if f.name in seen and seen[f.name] != f.dataType:
                conflict.add(f.name)
            seen.setdefault(f.name, f.dataType)
    parts = [
        df.select(*[(F.col(c).cast("string").alias(c) if c in conflict else F.col(c)) for c in df.columns])
        for df in tables.values()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# ----------------------------------------------------------------- V3


def violation_predicate(chk: Check, df: DataFrame) -> Column | None:
    """The row predicate of a row-level check (None for other kinds)."""
    if chk.kind not in ROW_RULES:
        return None
    rule = ROW_RULES[chk.kind](chk, df)
    return F.coalesce(rule.bad if rule.all_rows else (~rule.missing & rule.bad), F.lit(False))


def violating_rows(chk: Check, df: DataFrame, tables: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """All rows that break ``chk`` (lazy), or None when the kind has no row-level culprits.

    Row checks: a filter.  Uniqueness: a left-semi join with the duplicated keys
    (pre-aggregated ``groupBy(key).count() > 1``).  Foreign key: a left-anti join
    with the parent's distinct keys.  Both joins are equi-joins on the key."""
    if chk.pass_kind == "A" and chk.kind in ROW_RULES:
        judged = with_verdicts(df, [chk])
        return judged.where(violation_predicate(chk, judged)).select(*[F.col(f"`{c}`") for c in df.columns])
    cols = list(chk.columns)
    if chk.pass_kind == "O":
        from probity.operators.ordered import ordered_violations

        return ordered_violations(df, chk)
    from probity.functions.predicates import normalized

    # the check's own keys: trimmed and compared under its collation, as in the counts
    mine = [normalized(df[c], chk) for c in cols]
    if chk.kind in ("column_values_to_be_unique", "compound_columns_to_be_unique", "multicolumn_values_to_be_unique"):
        judged = ~_all_null(mine) if chk.kind == "compound_columns_to_be_unique" else ~_any_null(mine)
        keyed = df.where(judged).select(*[k.alias(f"__k{i}") for i, k in enumerate(mine)])
        names = keyed.columns
        dups = keyed.groupBy(*names).count().where(F.col("count") > 1).select(*names)
        return df.where(judged).join(dups, on=[k.eqNullSafe(dups[n]) for k, n in zip(mine, names)], how="left_semi")
    if chk.kind == "foreign_key" and tables is not None:
        parent = tables[chk.p("parent_table")]
        pk = list(chk.p("parent_columns"))
        keys = parent.select(*[normalized(parent[p], chk).alias(f"__p{i}") for i, p in enumerate(pk)]).distinct()
        cond = [k == keys[f"__p{i}"] for i, k in enumerate(mine)]
        return df.where(~_any_null(mine)).join(keys, on=cond, how="left_anti")
    return None


def _any_null(cols):
    out = F.lit(False)
    for c in cols:
        out = out | c.isNull()
    return out


def _all_null(cols):
    out = F.lit(True)
    for c in cols:
        out = out & c.isNull()
    return out


MASK_COLUMN = "broken"


def broken_mask(df: DataFrame, checks: list[Check], column: str = MASK_COLUMN) -> DataFrame:
    """V3 in one scan: each row that breaks a row-level check of ``checks``, once, with a mask of ``1`` (broken) and ``0``
    in the order of the checks.

    No shuffle, whatever the number of checks.  ``column`` must be no column of ``df`` (``ValueError``), as must a check
    that has no row predicate (uniqueness, references, orders, aggregates)."""
    if column in df.columns:
        raise ValueError(f"the table has a column {column}; name the mask otherwise")
    if not checks:
        return df.withColumn(column, F.lit("")).limit(0)
    judged = with_verdicts(df, checks)
    bits = []
    for chk in checks:
        bad = violation_predicate(chk, judged) if chk.pass_kind == "A" else None
        if bad is None:
            raise ValueError(f"{chk.check_id}: {chk.kind} has no row predicate")
        bits.append(F.when(bad, F.lit("1")).otherwise(F.lit("0")))
    own = [F.col(_quoted(c)) for c in df.columns]
    return judged.select(*own, F.concat(*bits).alias(column)).where(F.contains(F.col(_quoted(column)), F.lit("1")))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _exploded(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_id, row) of all broken row-level checks, from the one scan of ``broken_mask``."""
    mask = "__broken"
    while mask in df.columns:
        mask += "_"
    ids = F.array(*[F.lit(c.check_id) for c in checks])
    broken = F.filter(ids, lambda _, i: F.substring(F.col(mask), i + F.lit(1), F.lit(1)) == F.lit("1"))
    return broken_mask(df, checks, mask).select(F.explode(broken).alias("check_id"), *[F.col(_quoted(c)) for c in df.columns])


def failing_rows(
    df: DataFrame, checks: list[Check], order_by: list[str] | None = None, n: int | None = None, only: set[str] | None = None,
    tables: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """V3: all failing rows of each check (row checks, uniqueness and foreign
    keys; see ``violating_rows``), as many as its ``unexpected_count``, or with
    ``n`` a named top-n view: the first ``n`` by ``order_by``.

    All rows of the row checks come from one scan (``broken_mask``).  The view is one filter + top-k per check (``TakeOrderedAndProject``: each task keeps
    its own n best rows, so a check failing on a third of the table still
    moves only n rows per task).  A row failing two checks appears twice,
    as in the reference.  ``only``: restrict to these check ids (the failed
    ones)."""
    parts = []
    wanted = [c for c in checks if only is None or c.check_id in only]
    by_row = [c for c in wanted if c.pass_kind == "A" and c.kind in ROW_RULES]
    if n is None and by_row:
        parts.append(_exploded(df, by_row))
        wanted = [c for c in wanted if c not in by_row]
    for chk in wanted:
        rows = violating_rows(chk, df, tables)
        if rows is None:
            continue
        top = rows if n is None else rows.orderBy(*(order_by or df.columns)).limit(n)
        parts.append(top.select(F.lit(chk.check_id).alias("check_id"), *df.columns))
    if not parts:
        return df.sparkSession.createDataFrame([], T.StructType([T.StructField("check_id", T.StringType())] + df.schema.fields))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failed_check_ids(results: DataFrame) -> set[str]:
    """One row per check, so collecting the ids is bounded by the suite size."""
    return {r["check_id"] for r in results.where(~F.coalesce(F.col("success"), F.lit(False))).select("check_id").collect()}


# ----------------------------------------------------------------- V4

CHECK_META_DDL = "check_id STRING, table_name STRING, kind STRING, columns STRING"


def check_meta(spark: SparkSession, checks: list[Check]) -> DataFrame:
    return spark.createDataFrame(
        [(c.check_id, c.table, c.kind, ",".join(c.columns)) for c in checks], CHECK_META_DDL
    )


def summary(results: DataFrame, checks: list[Check]) -> DataFrame:
    """V4: checks passed / failed per table and kind, with ``rollup`` totals.

    The metadata side has one row per check (a proven bound), so it is
    broadcast."""
    meta = F.broadcast(check_meta(results.sparkSession, checks))
    j = results.join(meta, "check_id", "inner")
    return (
        j.rollup("table_name", "kind")
        .agg(
            F.count(F.lit(1)).alias("checks"),
            F.count_if(F.col("success")).alias("passed"),
            F.count_if(~F.coalesce(F.col("success"), F.lit(False))).alias("failed"),
        )
    )


def with_overall(rolled: DataFrame) -> DataFrame:
    """The roll-up with its verdicts: ``success`` per row; the row without table and kind is the run's."""
    return rolled.withColumn("success", F.col("failed") == 0)


# ----------------------------------------------------------------- V5

RULE_DDL = "rule_id STRING, table_name STRING, source STRING, description STRING, skip_reason STRING"


def contract_evaluation(spark: SparkSession, contract, results: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """V5: one row per contract rule: status PASS / FAIL / SKIPPED / ERROR and a reason
    built from the observed numbers.  ERROR = the rule names a table or column
    the data does not have (known from the schemas, no scan)."""
    def absent_of(r):
        if r.check is None:
            return False
        df = tables.get(r.check.table)
        if df is None:
            return True
        return any(c not in df.columns for c in r.check.columns)

    rules = spark.createDataFrame(
        [(r.rule_id, r.table, r.source, r.description, r.skip_reason, absent_of(r)) for r in contract.rules],
        RULE_DDL + ", absent BOOLEAN",
    )
    # one result row per rule: a proven bound, so the results side is broadcast
    j = rules.join(F.broadcast(results.withColumnRenamed("check_id", "rule_id")), "rule_id", "left")
    absent = F.col("absent")
    status = (
        F.when(F.col("skip_reason").isNotNull(), F.lit("SKIPPED"))
        .when(absent | F.col("success").isNull(), F.lit("ERROR"))
        .when(F.col("success"), F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
    )
    reason = (
        F.when(F.col("skip_reason").isNotNull(), F.col("skip_reason"))
        .when(absent, F.lit("table or column absent"))
        .when(F.col("success").isNull(), F.lit("check could not be evaluated"))
        .when(
            F.col("unexpected_count").isNotNull() & F.col("element_count").isNotNull(),
            F.format_string("%d unexpected of %d rows", F.col("unexpected_count"), F.col("element_count")),
        )
        .when(F.col("observed_value").isNotNull(), F.format_string("observed %.6f", F.col("observed_value")))
        .otherwise(F.lit("schema check"))
    )
    return j.select("rule_id", "table_name", "source", status.alias("status"), reason.alias("reason"))


# ----------------------------------------------------------------- V6


def _key_flips(old: Check, new: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of a uniqueness or foreign-key check that exactly one version calls bad.

    One groupBy on both versions' keys with its counts (map-side combined: a hot key is one row per task); each version
    then judges those groups: by the sum of the counts of its own key, or by an equi-join with its parent's
    distinct keys.  Keys are compared as each version compares them (trimmed, without case)."""
    from probity.functions.predicates import normalized

    df = tables[new.table]
    keys = {"o": old, "n": new}
    cols = {v: [f"__{v}{i}" for i in range(len(chk.columns))] for v, chk in keys.items()}
    mine = [normalized(F.col(_quoted(c)), chk).alias(name) for v, chk in keys.items() for c, name in zip(chk.columns, cols[v])]
    groups = df.select(*mine).groupBy(*cols["o"], *cols["n"]).agg(F.count(F.lit(1)).alias("__rows"))
    for v, chk in keys.items():
        own = [F.col(c) for c in cols[v]]
        theirs = [f"__t{v}{i}" for i in range(len(own))]
        if chk.kind == "foreign_key":
            parent = tables[chk.p("parent_table")]
            held = parent.select(*[normalized(F.col(_quoted(c)), chk).alias(t) for c, t in zip(chk.p("parent_columns"), theirs)]).distinct()
            held = held.withColumn(f"__found{v}", F.lit(True))
            on = [a == F.col(t) for a, t in zip(own, theirs)]
            bad = ~_any_null(own) & F.col(f"__found{v}").isNull()
        else:
            held = groups.groupBy(*[a.alias(t) for a, t in zip(own, theirs)]).agg(F.sum("__rows").alias(f"__found{v}"))
            on = [a.eqNullSafe(F.col(t)) for a, t in zip(own, theirs)]
            missing = _all_null(own) if chk.kind == "compound_columns_to_be_unique" else _any_null(own)
            bad = ~missing & (F.col(f"__found{v}") > 1)
        groups = groups.join(held, on, "left").withColumn(f"__bad{v}", bad).drop(*theirs, f"__found{v}")
    flips = F.coalesce(F.sum(F.when(F.col("__bado") != F.col("__badn"), F.col("__rows"))), F.lit(0)).cast("long")
    return groups.agg(flips.alias("rows_flipped")).select(F.lit(new.check_id).alias("check_id"), "rows_flipped")


def _keys_exist(chk: Check, tables: dict[str, DataFrame]) -> bool:
    wanted = {chk.table: chk.columns} if chk.kind != "foreign_key" else {chk.table: chk.columns, chk.p("parent_table"): chk.p("parent_columns")}
    if chk.kind == "foreign_key" and chk.p("parent_table") == chk.table:
        wanted = {chk.table: [*chk.columns, *chk.p("parent_columns")]}
    return all(t in tables and set(cols) <= set(tables[t].columns) for t, cols in wanted.items())


#: Kinds whose bad rows follow from the counts of a key or from a parent's keys.
KEY_RULES = {"column_values_to_be_unique", "compound_columns_to_be_unique", "multicolumn_values_to_be_unique", "foreign_key"}


def rows_flipped(tables: dict[str, DataFrame], old_checks: list[Check], new_checks: list[Check]) -> DataFrame:
    """Per check present in both suites: data rows judged bad by exactly one of the two versions.

    Row-level checks: one aggregate per table evaluates both predicates of every such check (a single scan).
    Uniqueness and foreign keys: ``_key_flips``, one check at a time; a version that names a table or column that the
    data lacks has no count."""
    old_by = {c.check_id: c for c in old_checks}
    pairs: dict[str, list[tuple[Check, Check]]] = {}
    for c in new_checks:
        o = old_by.get(c.check_id)
        if o is not None and o.table == c.table and o.pass_kind == "A" and c.pass_kind == "A" \
                and o.kind in ROW_RULES and c.kind in ROW_RULES:
            pairs.setdefault(c.table, []).append((o, c))
    parts = []
    for c in new_checks:
        o = old_by.get(c.check_id)
        if o is not None and o.table == c.table and {o.kind, c.kind} <= KEY_RULES and all(_keys_exist(x, tables) for x in (o, c)):
            parts.append(_key_flips(o, c, tables))
    for table, ps in pairs.items():
        df = tables[table]
        both = [c for pair in ps for c in pair]
        if any(c.kind == "row_condition" for c in both):
            # old and new version of an expression share an id: each gets its own verdict column
            olds = [replace(o, check_id=f"old:{o.check_id}") for o, _ in ps]
            df = with_verdicts(with_verdicts(df, olds), [c for _, c in ps])
            ps = [(o, c) for o, (_, c) in zip(olds, ps)]
        aggs = [F.count_if(violation_predicate(o, df) != violation_predicate(n, df)).alias(f"f{i}") for i, (o, n) in enumerate(ps)]
        row = df.agg(*aggs)
        parts.append(row.select(F.explode(F.array(*[
            F.struct(F.lit(n.check_id).alias("check_id"), F.col(f"f{i}").alias("rows_flipped")) for i, (o, n) in enumerate(ps)
        ])).alias("x")).select("x.*"))
    if not parts:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "check_id STRING, rows_flipped BIGINT")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suite_change(old: DataFrame, new: DataFrame, flipped: DataFrame | None = None) -> DataFrame:
    """V6: evaluate old and new suite on the data; full outer join on check_id.

    change: added / removed (the check is in one suite only) / error (it is
    in both and could not be evaluated in one or both) / tightened (more
    unexpected rows) / loosened (fewer) / unchanged; ``verdict_flip`` marks a changed success;
    ``rows_flipped`` (from ``rows_flipped``) counts the data rows whose verdict
    differs between the versions (row-level checks in both suites).  All
    inputs have one row per check, so the joins are small."""
    o = old.select("check_id", F.col("unexpected_count").alias("old_unexpected"), F.col("success").alias("old_success"), F.lit(True).alias("_old"))
    n = new.select("check_id", F.col("unexpected_count").alias("new_unexpected"), F.col("success").alias("new_success"), F.lit(True).alias("_new"))
    j = o.join(n, "check_id", "full_outer")
    if flipped is not None:
        j = j.join(flipped, "check_id", "left")
    else:
        j = j.withColumn("rows_flipped", F.lit(None).cast("long"))
    change = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("removed"))
        .when(F.col("old_success").isNull() | F.col("new_success").isNull(), F.lit("error"))
        .when(F.col("new_unexpected") > F.col("old_unexpected"), F.lit("tightened"))
        .when(F.col("new_unexpected") < F.col("old_unexpected"), F.lit("loosened"))
        .otherwise(F.lit("unchanged"))
    )
    flip = F.coalesce(F.col("old_success") != F.col("new_success"), F.lit(False))
    return j.select("check_id", change.alias("change"), "old_unexpected", "new_unexpected", "old_success", "new_success",
                    flip.alias("verdict_flip"), "rows_flipped")


# ----------------------------------------------------------------- V7

SUGGEST_DDL = "table_name STRING, column_name STRING, kind STRING, min_value DOUBLE, max_value DOUBLE, value_set STRING"


def suggest_checks(
    tables: dict[str, DataFrame], profile: DataFrame, max_domain: int = 20, references: DataFrame | None = None, as_of: str | None = None
) -> DataFrame:
    """V7: deterministic suggestions from the profile.

    ``references`` (``operators.discovery.foreign_keys``) adds a foreign_key per proposed reference of a profiled column;
    with ``as_of`` each timestamp column gets a freshness limit, the minutes its newest value is old then.

    null_rate = 0 -> not_null; distinct_ratio = 1 -> unique; integer/float
    column -> range [p01, p99]; string column with at most ``max_domain``
    distinct values -> domain (the values come from a distinct over that
    column, bounded by ``max_domain``)."""
    spark = profile.sparkSession
    prof = profile.collect()  # one row per column
    rows, domains = [], []
    for r in prof:
        t, c = r["table_name"], r["column_name"]
        if r["row_count"] and r["null_count"] == 0:
            rows.append((t, c, "column_values_to_not_be_null", None, None, None))
        if r["row_count"] and r["distinct_ratio"] == 1.0:
            rows.append((t, c, "column_values_to_be_unique", None, None, None))
        if r["p01"] is not None:
            rows.append((t, c, "column_values_to_be_between", r["p01"], r["p99"], None))
        if r["data_type"] == "string" and r["distinct_count"] is not None and 0 < r["distinct_count"] <= max_domain:
            domains.append((t, c))
    if references is not None:
        seen = {(r["table_name"], r["column_name"]) for r in prof}
        for r in references.collect():  # at most one row per column
            if (r["child_table"], r["child_column"]) in seen:
                said = json.dumps({"parent_table": r["parent_table"], "parent_columns": [r["parent_column"]]})
                rows.append((r["child_table"], r["child_column"], "foreign_key", None, None, said))
    if as_of is not None:
        for t in sorted({r["table_name"] for r in prof}):
            stamps = [f for f in tables[t].schema.fields if f.dataType.simpleString().startswith("timestamp")]
            if not stamps:
                continue
            ages = [F.timestamp_diff("MINUTE", F.max(f.name), F.lit(as_of).cast(f.dataType)).alias(f"a{i}") for i, f in enumerate(stamps)]
            for f, age in zip(stamps, tables[t].agg(*ages).first()):
                if age is not None:
                    rows.append((t, f.name, "freshness", None, float(age), json.dumps({"as_of": as_of})))
    if domains:
        # the value lists of all low-cardinality columns in one job; the profile has
        # counted at most max_domain values in each, and no list is cut
        parts = [
            tables[t].select(F.col(c).alias("v")).where(F.col("v").isNotNull()).distinct()
            .agg(F.to_json(F.array_sort(F.collect_list("v"))).alias("s"))
            .select(F.lit(t).alias("t"), F.lit(c).alias("c"), "s")
            for t, c in domains
        ]
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        for d in u.collect():
            rows.append((d["t"], d["c"], "column_values_to_be_in_set", None, None, d["s"]))
    return spark.createDataFrame(rows, SUGGEST_DDL)


def not_suggested(profile: DataFrame, max_domain: int = 20) -> DataFrame:
    """V7: what ``suggest_checks`` does not propose for a profiled column and why, one row per column and kind.

    table_name, column_name, kind, reason (empty table / nulls / repeats / no order statistics / too many values, with ``max_domain`` / not a text) and
    observed: the null rate, the distinct ratio or the number of values that decided, null where none did."""
    empty = F.col("row_count") == 0

    def kind(name: str, *reasons: tuple[Column, str], observed: Column) -> Column:
        why = F.when(empty, F.lit("empty table"))
        for cond, text in reasons:
            why = why.when(cond, F.lit(text))
        return F.struct(F.lit(name).alias("kind"), why.alias("reason"), F.when(~empty, observed).cast("double").alias("observed"))

    distinct = F.col("distinct_count")
    kinds = F.array(
        kind("column_values_to_not_be_null", (F.col("null_count") > 0, "nulls"), observed=F.col("null_rate")),
        kind("column_values_to_be_unique", (F.col("distinct_ratio").isNull(), "not counted"), (F.col("distinct_ratio") != 1.0, "repeats or nulls"), observed=F.col("distinct_ratio")),
        kind("column_values_to_be_between", (F.col("p01").isNull(), "no order statistics"), observed=F.lit(None)),
        kind(
            "column_values_to_be_in_set", (F.col("data_type") != "string", "not a text"), (distinct.isNull(), "not counted"), (distinct == 0, "no values"),
            (distinct > max_domain, f"more than {max_domain} values"), observed=F.when(F.col("data_type") == "string", distinct),
        ),
    )
    out = profile.select("table_name", "column_name", F.explode(kinds).alias("k")).select("table_name", "column_name", "k.*")
    return out.where(F.col("reason").isNotNull())


def suggestions_to_checks(suggestions: DataFrame) -> list[Check]:
    out = []
    for r in suggestions.collect():  # bounded: a few rows per column
        params = {}
        if r["kind"] == "column_values_to_be_between":
            params = {"min_value": r["min_value"], "max_value": r["max_value"]}
        elif r["kind"] == "column_values_to_be_in_set":
            params = {"value_set": json.loads(r["value_set"])}
        elif r["kind"] == "foreign_key":
            params = json.loads(r["value_set"])
        elif r["kind"] == "freshness":
            # whole minutes: the newest value may be up to a minute older
            params = {**json.loads(r["value_set"]), "threshold_seconds": int(r["max_value"]) * 60 + 59}
        out.append(Check(r["table_name"], r["kind"], (r["column_name"],), params))
    return out
