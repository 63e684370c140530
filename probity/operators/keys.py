"""Checks that need the value -> count table of a key ("G"), and key joins ("J").

All uniqueness / distinct-set checks on the same column tuple share ONE
``groupBy(key).count()``: map-side partial aggregation collapses hot keys
before the shuffle (a key holding a third of the rows becomes one row per
map task), and every check then reads the much smaller groups table in one
more aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.checks import Check
from probity.functions import predicates as P
from probity.operators.measure import Measure, all_null, any_null, between

CNT = "__cnt"


def key_of(chk: Check) -> tuple[str, ...]:
    return tuple(chk.columns)


def groups_of(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """value -> count, nulls included as their own group."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(CNT))


BITS = "__bits"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def is_whole(dtype: T.DataType) -> bool:
    """Types whose distinct values are counted as bits of 64-bit words."""
    return isinstance(dtype, _WHOLE)


def word_and_bit(c: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """A whole number (a date: its day) as the number of its 64-bit word and the word with its one bit set."""
    v = F.unix_date(c).cast("long") if isinstance(dtype, T.DateType) else c.cast("long")
    # not F.shiftleft: its number of bits must be a literal
    return F.shiftright(v, 6), F.call_function("shiftleft", F.lit(1).cast("long"), v.bitwiseAND(F.lit(63)).cast("int"))


def word_groups_of(df: DataFrame, col: str) -> DataFrame:
    """word -> its values as bits, and their rows; nulls included as their own group.

    Up to 64 neighbouring values are one row of the shuffle and one entry of a task's hash map; a value without
    neighbours costs eight bytes more than in ``groups_of``.  ``bit_or`` keeps a long, so both sides of the exchange
    stay in whole-stage codegen."""
    word, bit = word_and_bit(F.col(col), df.schema[col].dataType)
    return df.select(word.alias(col), bit.alias(BITS)).groupBy(col).agg(F.count(F.lit(1)).alias(CNT), F.bit_or(BITS).alias(BITS))


def _sum_if(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(CNT))), F.lit(0)).cast("long")


def _unique(missing_of):
    def build(chk: Check, groups: DataFrame, df: DataFrame) -> Measure:
        keys = [groups[c] for c in chk.columns]
        miss = missing_of(keys)
        aggs = {
            "n": _sum_if(F.lit(True)),
            "miss": _sum_if(miss),
            "bad": _sum_if(~miss & (F.col(CNT) > 1)),
        }

        def result(g):
            return {
                "element_count": g("n"),
                "missing_count": g("miss"),
                "unexpected_count": g("bad"),
                "judged": g("n") - g("miss"),
            }

        return Measure(aggs, result)

    return build


def _distinct_stats(chk, groups, df):
    k = groups[chk.column]
    return {
        "n": _sum_if(F.lit(True)),
        "miss": _sum_if(k.isNull()),
        "ndv": F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("long") if BITS in groups.columns else F.count(k),
    }


def _proportion_unique(chk, groups, df):
    aggs = _distinct_stats(chk, groups, df)

    def result(g):
        obs = F.try_divide(g("ndv").cast("double"), g("n") - g("miss"))
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "observed_value": obs,
            "success": between(obs, chk.p("min_value"), chk.p("max_value")),
        }

    return Measure(aggs, result)


def _unique_count(chk, groups, df):
    aggs = _distinct_stats(chk, groups, df)

    def result(g):
        obs = g("ndv").cast("double")
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "observed_value": obs,
            "success": between(obs, chk.p("min_value"), chk.p("max_value")),
        }

    return Measure(aggs, result)


def _distinct_set(mode: str):
    """mode 'in': distinct values within the set; 'contain': the set within the
    distinct values; 'equal': both.  unexpected_count = offending distinct values."""

    def build(chk, groups, df):
        k = groups[chk.column]
        vals, unfit = P.members(chk.p("value_set") or [], df.schema[chk.column].dataType, chk)
        nset = len(vals) + unfit  # a member that does not fit the column is absent from it
        inset = P.is_member(k, vals, chk)
        aggs = dict(_distinct_stats(chk, groups, df))
        aggs["outside"] = F.count_if(k.isNotNull() & ~inset)
        aggs["present"] = F.count_if(k.isNotNull() & inset)

        def result(g):
            absent = F.lit(nset) - g("present")
            bad = {"in": g("outside"), "contain": absent, "equal": g("outside") + absent}[mode]
            return {
                "element_count": g("n"),
                "missing_count": g("miss"),
                "unexpected_count": bad.cast("long"),
                "observed_value": g("ndv").cast("double"),
                "success": bad == 0,
            }

        return Measure(aggs, result)

    return build


def _most_common_in_set(chk, groups, df):
    """All values tied for the top count must be in the set (``ties_okay``: one suffices)."""
    k = groups[chk.column]
    vals, _ = P.members(chk.p("value_set") or [], df.schema[chk.column].dataType, chk)
    inset = P.is_member(k, vals, chk)
    aggs = dict(_distinct_stats(chk, groups, df))
    aggs["top"] = F.max(F.when(k.isNotNull(), F.col(CNT)))
    aggs["top_out"] = F.max(F.when(k.isNotNull() & ~inset, F.col(CNT)))
    aggs["top_in"] = F.max(F.when(k.isNotNull() & inset, F.col(CNT)))

    def result(g):
        if chk.p("ties_okay", False):
            ok = F.coalesce(g("top_in") >= g("top"), F.lit(False))
        else:
            ok = g("top").isNotNull() & F.coalesce(g("top_out") < g("top"), F.lit(True))
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "observed_value": g("top").cast("double"),
            "success": ok,
        }

    return Measure(aggs, result)


def _kl_divergence(chk, groups, df):
    """KL(p || q) = sum p ln(p/q), p = observed shares of non-null values,
    q = ``partition_object`` weights.  An observed value with no weight gives
    +inf (fail); weights of unseen values add 0.  One pass over the groups:
    KL = (sum c ln c - sum c ln q) / n - ln n."""
    part = chk.p("partition_object") or {}
    values, weights = part.get("values", []), part.get("weights", [])
    k = groups[chk.column]
    dtype = df.schema[chk.column].dataType
    pairs = [(P.coerce_values([v], dtype), w) for v, w in zip(values, weights)]
    qmap = F.create_map(*[x for v, w in pairs if v for x in (F.lit(v[0]), F.lit(float(w)))])
    q = F.try_element_at(qmap, k)
    c = F.col(CNT).cast("double")
    aggs = dict(_distinct_stats(chk, groups, df))
    aggs["clnc"] = F.sum(F.when(k.isNotNull(), c * F.log(c)))
    aggs["clnq"] = F.sum(F.when(k.isNotNull() & (q > 0), c * F.log(q)))
    aggs["noq"] = F.count_if(k.isNotNull() & (q.isNull() | (q <= 0)))

    def result(g):
        nn = (g("n") - g("miss")).cast("double")
        kl = (g("clnc") - g("clnq")) / nn - F.log(nn)
        kl = F.when(g("noq") > 0, F.lit(math.inf)).otherwise(kl)
        return {
            "element_count": g("n"),
            "missing_count": g("miss"),
            "observed_value": kl,
            "success": F.coalesce(kl < F.lit(float(chk.p("threshold"))), F.lit(False)),
        }

    return Measure(aggs, result)


GROUP_RULES = {
    "column_values_to_be_unique": _unique(lambda ks: any_null(ks)),
    "compound_columns_to_be_unique": _unique(all_null),
    "multicolumn_values_to_be_unique": _unique(any_null),
    "column_proportion_of_unique_values_to_be_between": _proportion_unique,
    "column_unique_value_count_to_be_between": _unique_count,
    "column_distinct_values_to_be_in_set": _distinct_set("in"),
    "column_distinct_values_to_contain_set": _distinct_set("contain"),
    "column_distinct_values_to_equal_set": _distinct_set("equal"),
    "column_most_common_value_to_be_in_set": _most_common_in_set,
    "column_kl_divergence_to_be_less_than": _kl_divergence,
}

#: Kinds that need how many values there are, not which.
DISTINCT_ONLY = {"column_proportion_of_unique_values_to_be_between", "column_unique_value_count_to_be_between"}


# ---------------------------------------------------------------- joins ("J")


def foreign_key_counts(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """One row: element, missing (any fk part null), orphan rows, orphan keys.

    One scan of each side.  The child is pre-aggregated to (fk, count) --
    map-side partial aggregation collapses hot keys, so the shuffle moves at
    most one row per key per task -- and the parent is reduced to its distinct
    keys (likewise).  A left outer equi-join of the two (both already
    partitioned by the key, so no further exchange; never the null-aware
    ``NOT IN``) marks the keys without a parent.  Spark broadcasts the parent
    keys only when their measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time)."""
    # built exactly like the shared value -> count table of the G pass, so a
    # uniqueness check on the same key reuses this shuffle (ReusedExchange)
    groups = groups_of(child, tuple(fk))
    keys = (
        parent.select(*[parent[c].alias(a) for c, a in zip(pk, fk)])
        .where(~any_null([F.col(a) for a in fk]))
        .distinct()
        .withColumn("__present", F.lit(True))
    )
    marked = groups.join(keys, on=list(fk), how="left")
    has_null = any_null([F.col(a) for a in fk])
    orphan = ~has_null & F.col("__present").isNull()
    return marked.agg(
        _sum_if(F.lit(True)).alias("n"),
        _sum_if(has_null).alias("miss"),
        _sum_if(orphan).alias("bad"),
        F.count_if(orphan).alias("bad_keys"),
    )


def bag_difference_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """|A - B| + |B - A| as bags, in one shuffle: +1/-1 tags summed per row value.

    Equivalent to ``a.exceptAll(b).count() + b.exceptAll(a).count()`` without
    replicating rows.  Columns are matched by position, as in SQL set ops."""
    cols = [f"__c{i}" for i in range(len(a.columns))]
    ta = a.toDF(*cols).withColumn("__s", F.lit(1))
    tb = b.toDF(*cols).withColumn("__s", F.lit(-1))
    per = ta.unionByName(tb).groupBy(*cols).agg(F.sum("__s").alias("__d"))
    return per.agg(
        F.coalesce(F.sum(F.when(F.col("__d") > 0, F.col("__d"))), F.lit(0)).cast("long").alias("a_only"),
        F.coalesce(F.sum(F.when(F.col("__d") < 0, -F.col("__d"))), F.lit(0)).cast("long").alias("b_only"),
    )


BUCKETS = 4096  # digests of a comparison; also the most rows that its broadcast holds


def bag_difference_by_digest(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bag_difference_count`` for relations that are mostly equal: digests of hash buckets first, rows only of unequal buckets.

    A bucket's digest is the signed sum of its rows' tags and of two hashes of each row (+ for A, - for B), so it is
    zero where both sides hold the same bag; only rows of the other buckets are shuffled and compared as rows.  Both
    relations are read twice; a pass shuffles at most ``buckets`` rows a task.  Rows that are equal but hash apart
    (collations) make buckets unequal, never a count wrong; two different bags pass as equal only if both
    128 bits of sums agree.  Maps have no hash: such relations take the one shuffle of all rows."""
    if any("map<" in f.dataType.simpleString() for f in a.schema.fields + b.schema.fields):
        return bag_difference_count(a, b)
    cols = [f"__c{i}" for i in range(len(a.columns))]
    both = a.toDF(*cols).withColumn("__s", F.lit(1)).unionByName(b.toDF(*cols).withColumn("__s", F.lit(-1)))
    row = [F.col(c) for c in cols]
    h1, h2 = F.xxhash64(*row), F.xxhash64(F.lit(7919), *row)
    digested = both.select("__s", F.pmod(h1, F.lit(buckets)).alias("__b"), h1.cast("decimal(20,0)").alias("__h1"), h2.cast("decimal(20,0)").alias("__h2"))
    signed = [F.sum(F.col(h) * F.col("__s")).alias(h) for h in ("__h1", "__h2")]
    unequal = (
        digested.groupBy("__b").agg(F.sum("__s").alias("__n"), *signed)
        .where((F.col("__n") != 0) | (F.col("__h1") != 0) | (F.col("__h2") != 0)).select("__b")
    )
    rest = both.withColumn("__b", F.pmod(h1, F.lit(buckets))).join(F.broadcast(unequal), "__b", "left_semi")
    return bag_difference_count(rest.where("__s = 1").select(*cols), rest.where("__s = -1").select(*cols))
