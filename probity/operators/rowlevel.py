"""Row-level ("map") checks: one boolean predicate per row, counted in the fused pass."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.checks import Check
from probity.functions import predicates as P
from probity.operators.measure import RowRule, all_null, any_null


def _col(df: DataFrame, name: str) -> Column:
    return df[name]


def _bound(v, dtype):
    """A bound in the column's own type where exactness matters: decimal columns
    (money) compare with decimal literals, not through doubles."""
    if v is None or not isinstance(dtype, T.DecimalType):
        return v
    return P.coerce_values([v], dtype)[0]


def _between(c: Column, chk: Check, dtype=None) -> Column:
    lo, hi = _bound(chk.p("min_value"), dtype), _bound(chk.p("max_value"), dtype)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((c > F.lit(lo)) if chk.p("strict_min", False) else (c >= F.lit(lo)))
    if hi is not None:
        ok = ok & ((c < F.lit(hi)) if chk.p("strict_max", False) else (c <= F.lit(hi)))
    return ok


def _in_set(c: Column, chk: Check, df: DataFrame) -> Column:
    return P.is_member(c, P.members(chk.p("value_set") or [], df.schema[chk.column].dataType, chk)[0], chk)


def _single(fn):
    """Wrap a predicate builder ``fn(c, chk, df) -> ok`` for a single-column check."""

    def build(chk: Check, df: DataFrame) -> RowRule:
        c = _col(df, chk.column)
        return RowRule(missing=c.isNull(), bad=~fn(c, chk, df))

    return build


def _not_null(chk, df):
    c = _col(df, chk.column)
    return RowRule(missing=c.isNull(), bad=c.isNull(), all_rows=True)


def _null(chk, df):
    c = _col(df, chk.column)
    return RowRule(missing=c.isNull(), bad=c.isNotNull(), all_rows=True)


def _pair(fn):
    def build(chk: Check, df: DataFrame) -> RowRule:
        a, b = _col(df, chk.columns[0]), _col(df, chk.columns[1])
        return RowRule(missing=any_null([a, b]), bad=~fn(a, b, chk, df))

    return build


def _pair_in_set(a, b, chk, df):
    ta, tb = df.schema[chk.columns[0]].dataType, df.schema[chk.columns[1]].dataType
    pairs = []
    for x, y in chk.p("value_pairs_set") or []:
        cx, cy = P.coerce_values([x], ta), P.coerce_values([y], tb)
        if cx and cy:
            pairs.append((cx[0], cy[0]))
    if not pairs:
        return F.lit(False)
    # struct IN (literal structs): Catalyst makes long lists a hash InSet
    return F.struct(a.alias("a"), b.alias("b")).isin(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, y in pairs])


def _multicolumn_sum(chk, df):
    cols = [_col(df, c) for c in chk.columns]
    # integers add up as decimals: no row can overflow and end the suite
    cols_ = [c.cast("decimal(38,0)") if isinstance(df.schema[n].dataType, T.IntegralType) else c for c, n in zip(cols, chk.columns)]
    total = cols_[0]
    for c in cols_[1:]:
        total = F.try_add(total, c)
    tol = chk.p("tolerance", 0) or 0
    target = F.lit(chk.p("sum_total"))
    ok = (total == target) if not tol else (F.abs(total - target) <= F.lit(tol))
    return RowRule(missing=any_null(cols), bad=~F.coalesce(ok, F.lit(False)))


def _unique_within_record(chk, df):
    cols = [_col(df, c) for c in chk.columns]
    arr = F.array_compact(F.array(*cols))
    return RowRule(missing=all_null(cols), bad=F.size(F.array_distinct(arr)) != F.size(arr))


def _z_scores(chk, df):
    c = _col(df, chk.column)
    # One scalar subquery (mean and sample stddev in one pass) evaluated before
    # the fused pass and inlined as a literal struct: no join, no second scan.
    stats = df.select(F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias("st")).scalar()
    z = F.try_divide(c - stats.getField("m"), stats.getField("s"))
    t = float(chk.p("threshold"))
    ok = (F.abs(z) < F.lit(t)) if chk.p("double_sided", True) else (z < F.lit(t))
    return RowRule(missing=c.isNull(), bad=~F.coalesce(ok, F.lit(True)))


# logical family -> Spark type used for the value-level cast test
_CAST_OF = {
    "integer": "bigint", "int": "bigint", "long": "bigint", "bigint": "bigint",
    "number": "double", "numeric": "double", "double": "double", "float": "double", "decimal": "decimal(38,10)",
    "boolean": "boolean", "bool": "boolean", "date": "date", "timestamp": "timestamp_ntz", "datetime": "timestamp_ntz",
    "string": "string", "text": "string", "varchar": "string",
}


def _cast_target(wanted: str) -> str:
    """The Spark type that a text is read as for a logical, database or Spark type name."""
    from probity.operators.schema import database_family

    name = wanted.strip().lower()
    target = name if re.fullmatch(r"decimal\(\d+(,\s*\d+)?\)", name) else _CAST_OF.get(database_family(name))
    if target is None:
        raise ValueError(f"no text can be tested for the type {wanted}")
    return target


def _value_type(chk, df):
    """E27 / E31 / C4 on text: a non-null value that does not convert (``try_cast``)
    to the wanted type (any of the list) is unexpected.  A type that no text converts to is an error of the check."""
    c = _col(df, chk.column)
    wanted = [chk.p("type_")] if chk.kind == "column_values_to_be_of_type" else list(chk.p("type_list"))
    ok = F.lit(False)
    for w in wanted:
        target = _cast_target(str(w))
        ok = ok | c.cast("string").try_cast(target).isNotNull()
    return RowRule(missing=c.isNull(), bad=~ok)


def verdict_column(chk: Check) -> str:
    return f"__verdict_{chk.check_id}"


def with_verdicts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``df`` with the verdict of each custom expression as a column.

    The expressions are planned with ANSI mode off, so that a row whose
    expression cannot be computed (division by zero, overflow, a failed cast)
    has a null verdict instead of ending the suite; every other expression of
    the suite keeps the session's mode."""
    custom = {c.check_id: c for c in checks if c.kind == "row_condition"}
    if not custom:
        return df
    conf, key = df.sparkSession.conf, "spark.sql.ansi.enabled"
    mode = conf.get(key)
    conf.set(key, "false")
    try:
        out = df.withColumns({verdict_column(c): F.expr(c.p("expression")).cast("boolean") for c in custom.values()})
        out.schema  # analysed while the mode holds
        return out
    finally:
        conf.set(key, mode)


def _row_condition(chk, df):
    """Contract ``custom`` rule: a SQL boolean per row; a row without a verdict is missing, not a violation."""
    cond = df[verdict_column(chk)] if verdict_column(chk) in df.columns else F.expr(chk.p("expression"))
    return RowRule(missing=cond.isNull(), bad=~F.coalesce(cond, F.lit(True)))


def _conditional_not_null(chk, df):
    """``column`` must be present when ``condition`` holds (a SQL boolean)."""
    c = _col(df, chk.column)
    cond = F.coalesce(F.expr(chk.p("condition")), F.lit(False))
    return RowRule(missing=c.isNull(), bad=cond & c.isNull(), all_rows=True)


ROW_RULES = {
    "column_values_to_not_be_null": _not_null,
    "column_values_to_be_null": _null,
    "column_values_to_be_between": _single(lambda c, k, d: _between(c, k, d.schema[k.column].dataType)),
    "column_value_lengths_to_be_between": _single(lambda c, k, d: _between(F.char_length(c), k)),
    "column_value_lengths_to_equal": _single(lambda c, k, d: F.char_length(c) == F.lit(int(k.p("value")))),
    "column_values_to_be_in_set": _single(_in_set),
    "column_values_to_not_be_in_set": _single(lambda c, k, d: ~_in_set(c, k, d)),
    "column_values_to_match_regex": _single(lambda c, k, d: c.rlike(k.p("regex"))),
    "column_values_to_not_match_regex": _single(lambda c, k, d: ~c.rlike(k.p("regex"))),
    "column_values_to_match_regex_list": _single(
        lambda c, k, d: (P.rlike_all if k.p("match_on", "any") == "all" else P.rlike_any)(c, k.p("regex_list"))
    ),
    "column_values_to_not_match_regex_list": _single(lambda c, k, d: ~P.rlike_any(c, k.p("regex_list"))),
    "column_values_to_match_like_pattern": _single(lambda c, k, d: c.like(k.p("like_pattern"))),
    "column_values_to_not_match_like_pattern": _single(lambda c, k, d: ~c.like(k.p("like_pattern"))),
    "column_values_to_match_like_pattern_list": _single(
        lambda c, k, d: (P.like_all if k.p("match_on", "any") == "all" else P.like_any)(c, k.p("like_pattern_list"))
    ),
    "column_values_to_not_match_like_pattern_list": _single(
        lambda c, k, d: ~P.like_any(c, k.p("like_pattern_list"))
    ),
    "column_values_to_match_strftime_format": _single(
        lambda c, k, d: P.matches_strftime(c, k.p("strftime_format"))
    ),
    "column_values_to_be_dateutil_parseable": _single(lambda c, k, d: P.parseable_any(c, k.p("formats"))),
    "column_values_to_be_json_parseable": _single(lambda c, k, d: P.json_whole_value(c)),
    "column_values_to_match_json_schema": _single(lambda c, k, d: P.matches_json_schema(c, k.p("json_schema"))),
    "column_pair_values_a_to_be_greater_than_b": _pair(
        lambda a, b, k, d: (a >= b) if k.p("or_equal", False) else (a > b)
    ),
    "column_pair_values_to_be_equal": _pair(lambda a, b, k, d: a == b),
    "column_pair_values_to_be_in_set": _pair(_pair_in_set),
    "multicolumn_sum_to_equal": _multicolumn_sum,
    "select_column_values_to_be_unique_within_record": _unique_within_record,
    "column_value_z_scores_to_be_less_than": _z_scores,
    "row_condition": _row_condition,
    "column_values_to_be_of_type": _value_type,
    "column_values_to_be_in_type_list": _value_type,
    "conditional_not_null": _conditional_not_null,
}
