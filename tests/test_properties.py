"""Property tests on random small frames with nulls and duplicates."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from probity import Check, validate
from probity.operators import quantiles as Q

values = st.lists(st.one_of(st.none(), st.integers(min_value=-5, max_value=5)), min_size=0, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values)
def test_counts_add_up_and_compound_equals_unique(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x INT")
    checks = [
        Check("t", "column_values_to_be_between", "x", {"min_value": -2, "max_value": 3}, check_id="b"),
        Check("t", "column_values_to_be_in_set", "x", {"value_set": [0, 1, 2]}, check_id="s"),
        Check("t", "column_values_to_be_unique", "x", check_id="u"),
        Check("t", "compound_columns_to_be_unique", ("x",), check_id="cu"),
    ]
    r = {row["check_id"]: row for row in validate({"t": df}, checks).collect()}
    nn = [x for x in xs if x is not None]
    good_b = sum(1 for x in nn if -2 <= x <= 3)
    assert r["b"]["unexpected_count"] + good_b + r["b"]["missing_count"] == r["b"]["element_count"] == len(xs)
    assert r["s"]["unexpected_count"] == sum(1 for x in nn if x not in (0, 1, 2))
    dup = sum(c for c in (nn.count(v) for v in set(nn)) if c > 1)
    assert r["u"]["unexpected_count"] == r["cu"]["unexpected_count"] == dup
    assert r["b"]["success"] == (r["b"]["unexpected_count"] == 0)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 9))), min_size=0, max_size=40),
       st.booleans(), st.booleans())
def test_ordered_matches_brute_force(spark, rows, increasing, strictly):
    df = spark.createDataFrame(rows, "o INT, v INT")
    kind = "column_values_to_be_increasing" if increasing else "column_values_to_be_decreasing"
    c = Check("t", kind, "v", {"order_by": "o", "strictly": strictly, "buckets": 3})
    got = validate({"t": df}, [c]).collect()[0]
    judged = [(o, v) for o, v in rows if v is not None]
    # global order: order column, then the value itself as tie breaker (asc / desc)
    judged.sort(key=lambda r: (r[0], r[1] if increasing else -r[1]))
    vs = [v for _, v in judged]

    def ok(a, b):
        if increasing:
            return b > a if strictly else b >= a
        return b < a if strictly else b <= a

    assert got["unexpected_count"] == sum(1 for a, b in zip(vs, vs[1:]) if not ok(a, b))
    assert got["missing_count"] == len(rows) - len(judged)


@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=60), st.floats(0.0, 1.0))
def test_exact_quantile_is_sorted_element(spark, xs, p):
    df = spark.createDataFrame([(float(x),) for x in xs], "x DOUBLE")
    (n, (v,)), = Q.select_ranks(df, [("x", *Q.disc(p))])
    s = sorted(float(x) for x in xs)
    assert n == len(xs) and v == s[min(len(s), max(1, math.ceil(p * len(s) - 1e-9))) - 1]
