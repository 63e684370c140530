"""Check semantics on small hand-made frames: nulls, empty table, NaN,
duplicates, ``mostly`` boundary, missing column, thresholds."""

import math

import pytest
from pyspark.sql import functions as F

from probity import Check, validate


def _run(spark, rows, ddl, checks, extra=None):
    df = spark.createDataFrame(rows, ddl)
    tables = {"t": df, **(extra or {})}
    out = {r["check_id"]: r.asDict() for r in validate(tables, checks).collect()}
    return out


def test_not_null_counts_all_rows(spark):
    r = _run(spark, [(1,), (None,), (3,), (None,)], "x INT", [Check("t", "column_values_to_not_be_null", "x")])
    (v,) = r.values()
    assert (v["element_count"], v["missing_count"], v["unexpected_count"]) == (4, 2, 2)
    assert v["unexpected_percent"] == 50.0 and v["success"] is False


def test_row_checks_ignore_nulls_and_identity(spark):
    rows = [(1,), (5,), (None,), (10,), (None,)]
    r = _run(spark, rows, "x INT", [Check("t", "column_values_to_be_between", "x", {"min_value": 0, "max_value": 6})])
    (v,) = r.values()
    assert v["missing_count"] == 2 and v["unexpected_count"] == 1
    # unexpected + good + missing = element
    assert v["unexpected_count"] + (3 - 1) + v["missing_count"] == v["element_count"]
    assert abs(v["unexpected_percent"] - 100 / 3) < 1e-9


def test_mostly_boundary(spark):
    rows = [(i,) for i in range(10)]
    ok = Check("t", "column_values_to_be_between", "x", {"max_value": 8}, mostly=0.9, check_id="a")
    bad = Check("t", "column_values_to_be_between", "x", {"max_value": 7}, mostly=0.9, check_id="b")
    r = _run(spark, rows, "x INT", [ok, bad])
    assert r["a"]["success"] is True and r["b"]["success"] is False


def test_empty_table_passes_row_checks(spark):
    r = _run(spark, [], "x INT", [Check("t", "column_values_to_be_in_set", "x", {"value_set": [1]}),
                                  Check("t", "column_mean_to_be_between", "x", {"min_value": 0})])
    assert r["t:x:domain"]["success"] is True and r["t:x:domain"]["element_count"] == 0
    # an aggregate over an empty column cannot be verified
    assert r["t:x:column_mean_to_be_between"]["success"] is False


def test_missing_column_fails_without_abort(spark):
    r = _run(spark, [(1,)], "x INT", [Check("t", "column_values_to_not_be_null", "nope"),
                                      Check("t", "column_values_to_not_be_null", "x")])
    assert r["t:nope:not_null"]["success"] is False and r["t:nope:not_null"]["element_count"] is None
    assert r["t:x:not_null"]["success"] is True


def test_unique_counts_all_rows_of_duplicated_values(spark):
    rows = [(1,), (1,), (2,), (3,), (3,), (3,), (None,), (None,)]
    r = _run(spark, rows, "x INT", [Check("t", "column_values_to_be_unique", "x")])
    assert r["t:x:unique"]["unexpected_count"] == 5 and r["t:x:unique"]["missing_count"] == 2


def test_compound_vs_multicolumn_null_handling(spark):
    rows = [(1, None), (1, None), (None, None), (None, None), (2, 3)]
    r = _run(spark, rows, "a INT, b INT", [Check("t", "compound_columns_to_be_unique", ("a", "b")),
                                           Check("t", "multicolumn_values_to_be_unique", ("a", "b"))])
    assert r["t:a+b:compound_columns_to_be_unique"]["unexpected_count"] == 2  # (1,null) twice
    assert r["t:a+b:multicolumn_values_to_be_unique"]["unexpected_count"] == 0


def test_compound_on_one_column_equals_unique(spark):
    rows = [(1,), (1,), (2,), (None,)]
    r = _run(spark, rows, "x INT", [Check("t", "compound_columns_to_be_unique", ("x",)),
                                    Check("t", "column_values_to_be_unique", "x")])
    assert r["t:x:compound_columns_to_be_unique"]["unexpected_count"] == r["t:x:unique"]["unexpected_count"] == 2


def test_nan_is_a_value_not_a_null(spark):
    rows = [(1.0,), (float("nan"),), (None,)]
    r = _run(spark, rows, "x DOUBLE", [Check("t", "column_values_to_not_be_null", "x")])
    assert r["t:x:not_null"]["unexpected_count"] == 1


def test_enum_strings_on_integer_column(spark):
    rows = [(1,), (2,), (7,)]
    r = _run(spark, rows, "x INT", [Check("t", "column_values_to_be_in_set", "x", {"value_set": ["1", "2", "x"]})])
    assert r["t:x:domain"]["unexpected_count"] == 1


def test_threshold_count_and_percent(spark):
    rows = [("a",), ("b",), ("z",), (None,)]
    c1 = Check("t", "column_values_to_be_in_set", "x", {"value_set": ["a", "b"]}, must_be_less_than=1, check_id="c1")
    c2 = Check("t", "column_values_to_not_be_null", "x", must_be_less_than=30, unit="percent", check_id="c2")
    r = _run(spark, rows, "x STRING", [c1, c2])
    assert r["c1"]["success"] is False  # 1 invalid, must be < 1
    assert r["c2"]["success"] is True  # 25% null < 30


def test_foreign_key_with_orphans_and_nulls(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id INT")
    rows = [(1,), (2,), (3,), (3,), (None,)]
    c = Check("t", "foreign_key", "fk", {"parent_table": "p", "parent_columns": ["id"]})
    r = _run(spark, rows, "fk INT", [c], extra={"p": parent})
    v = r["t:fk:foreign_key"]
    assert (v["unexpected_count"], v["missing_count"], v["observed_value"]) == (2, 1, 1.0)


def test_ordered_checks_across_buckets_and_groups(spark):
    # values decrease once inside group g=1 and once across a bucket seam
    rows = [(i, i, 1) for i in range(50)] + [(50, 10, 1)] + [(i, i, 2) for i in range(60, 120)]
    df = spark.createDataFrame(rows, "o INT, v INT, g INT")
    c1 = Check("t", "column_values_to_be_increasing", "v", {"order_by": "o", "buckets": 7}, check_id="glob")
    c2 = Check("t", "column_values_to_be_increasing", "v", {"order_by": "o", "partition_by": ["g"], "buckets": 5}, check_id="grp")
    out = {r["check_id"]: r for r in validate({"t": df}, [c1, c2]).collect()}
    # global: 50->10 breaks, 10 -> 60 fine: 1
    assert out["glob"]["unexpected_count"] == 1
    assert out["grp"]["unexpected_count"] == 1
    # brute force
    vs = [v for _, v, _ in sorted(rows)]
    assert sum(1 for a, b in zip(vs, vs[1:]) if not b > a) == 1


def test_json_checks(spark):
    rows = [('{"k": 1}',), ('"k": 1}',), ('{"k": 1} x',), ('{"k": "s"}',), ("[1, 2]",)]
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}}
    r = _run(spark, rows, "j STRING", [Check("t", "column_values_to_be_json_parseable", "j"),
                                       Check("t", "column_values_to_match_json_schema", "j", {"json_schema": schema})])
    assert r["t:j:column_values_to_be_json_parseable"]["unexpected_count"] == 2
    assert r["t:j:column_values_to_match_json_schema"]["unexpected_count"] == 4


def test_strftime_and_dateutil(spark):
    rows = [("2024/01",), ("2024-01",), ("2024/1",), ("x",)]
    r = _run(spark, rows, "s STRING", [Check("t", "column_values_to_match_strftime_format", "s", {"strftime_format": "%Y/%m"}),
                                       Check("t", "column_values_to_be_dateutil_parseable", "s", {"formats": ["%Y/%m", "%Y-%m"]})])
    assert r["t:s:column_values_to_match_strftime_format"]["unexpected_count"] == 3
    assert r["t:s:column_values_to_be_dateutil_parseable"]["unexpected_count"] <= 2


def test_z_scores_and_other_table_count(spark):
    rows = [(float(i),) for i in range(10)] + [(100.0,)]
    other = spark.createDataFrame([(1,)] * 11, "a INT")
    r = _run(spark, rows, "x DOUBLE", [Check("t", "column_value_z_scores_to_be_less_than", "x", {"threshold": 2.0}),
                                       Check("t", "table_row_count_to_equal_other_table", (), {"other_table_name": "o"})],
             extra={"o": other})
    assert r["t:x:column_value_z_scores_to_be_less_than"]["unexpected_count"] == 1
    assert r["t::table_row_count_to_equal_other_table"]["success"] is True


def test_exact_quantiles_match_brute_force(spark):
    import random

    from probity.operators import quantiles as Q

    rnd = random.Random(7)
    vals = [rnd.choice([1.5, 2.5]) if rnd.random() < 0.34 else rnd.random() * 1000 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x DOUBLE")
    s = sorted(vals)
    ps = [0.01, 0.25, 0.5, 0.9, 1.0]
    got = Q.select_ranks(df, [("x", *Q.disc(p)) for p in ps])
    for p, (_, v) in zip(ps, got):
        assert v[0] == s[max(1, math.ceil(p * len(s))) - 1]
    med = Q.median_of(Q.select_ranks(df, [("x", *Q.MEDIAN)])[0][1])
    assert med == pytest.approx((s[1499] + s[1500]) / 2)
    (n, (p01, p99)), = Q.select_ranks(df, [("x", *Q.PROFILE)])
    assert (p01, p99) == (s[max(0, int(n * 0.01) - 1)], s[min(n - 1, int(n * 0.99))])


def test_duplicate_check_ids_rejected(spark):
    df = spark.createDataFrame([(1,)], "x INT")
    with pytest.raises(ValueError):
        validate({"t": df}, [Check("t", "column_values_to_not_be_null", "x"), Check("t", "column_values_to_not_be_null", "x")])


def test_kind_name_forms():
    from probity.checks import normalize_kind

    assert normalize_kind("ExpectColumnValuesToNotBeNull") == "column_values_to_not_be_null"
    assert normalize_kind("expect_column_pair_values_a_to_be_greater_than_b") == "column_pair_values_a_to_be_greater_than_b"
    assert normalize_kind("ExpectColumnKLDivergenceToBeLessThan") == "column_kl_divergence_to_be_less_than"
    assert normalize_kind("ExpectColumnValueZScoresToBeLessThan") == "column_value_z_scores_to_be_less_than"
    from probity.checks import KINDS

    assert len(KINDS) == 56 and len(set(KINDS)) == 56


def test_ordered_hot_run_split_over_buckets(spark):
    # a third of the rows share one order value and one value: they form one
    # run of equal keys that must still be counted exactly (brute force)
    import random

    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 50)) for i in range(600)] + [(300, 7)] * 300
    df = spark.createDataFrame(rows, "o INT, v INT")
    for strictly in (True, False):
        c = Check("t", "column_values_to_be_increasing", "v", {"order_by": "o", "strictly": strictly, "buckets": 9})
        got = validate({"t": df}, [c]).collect()[0]["unexpected_count"]
        s = sorted(rows)
        want = sum(1 for (a, b) in zip(s, s[1:]) if not (b[1] > a[1] if strictly else b[1] >= a[1]))
        assert got == want


def test_share_thresholds(spark):
    rows = [(i,) for i in range(20)]  # 19 good of 20 for max 18 -> 95% good, 5% bad
    a = Check("t", "column_values_to_be_between", "x", {"max_value": 18, "share": ">95%"}, check_id="a")
    b = Check("t", "column_values_to_be_between", "x", {"max_value": 18, "share": "<5%"}, check_id="b")
    c = Check("t", "column_values_to_be_between", "x", {"max_value": 18, "share": ">90%"}, check_id="c")
    r = _run(spark, rows, "x INT", [a, b, c])
    assert (r["a"]["success"], r["b"]["success"], r["c"]["success"]) == (False, False, True)


def test_value_level_type_test_on_text(spark):
    rows = [("12",), ("x",), ("3.5",), (None,), ("2024-01-01",)]
    c1 = Check("t", "column_values_to_be_of_type", "s", {"type_": "integer", "value_test": True}, check_id="i")
    c2 = Check("t", "column_values_to_be_in_type_list", "s", {"type_list": ["integer", "date"], "value_test": True}, check_id="l")
    c3 = Check("t", "column_values_to_be_of_type", "s", {"type_": "string"}, check_id="m")
    r = _run(spark, rows, "s STRING", [c1, c2, c3])
    assert r["i"]["unexpected_count"] == 3 and r["i"]["missing_count"] == 1
    assert r["l"]["unexpected_count"] == 2
    assert r["m"]["success"] is True and r["m"]["element_count"] is None


def test_failing_rows_for_keys(spark):
    from probity.plans.report import failing_rows

    df = spark.createDataFrame([(1, 10), (1, 11), (2, 99), (3, None), (4, 20)], "id INT, fk INT")
    parent = spark.createDataFrame([(10,), (11,), (20,)], "pk INT")
    checks = [Check("t", "column_values_to_be_unique", "id"),
              Check("t", "foreign_key", "fk", {"parent_table": "p", "parent_columns": ["pk"]})]
    rows = failing_rows(df, checks, order_by=["id", "fk"], n=5, tables={"t": df, "p": parent}).collect()
    got = sorted((r["check_id"], r["id"], r["fk"]) for r in rows)
    assert got == [("t:fk:foreign_key", 2, 99), ("t:id:unique", 1, 10), ("t:id:unique", 1, 11)]


def test_stored_suite_entries(spark):
    suite = {"name": "t.0.1", "expectations": [
        {"type": "expect_table_columns_to_match_ordered_list", "kwargs": {"column_list": ["a", "b"]}, "meta": {}},
        {"type": "expect_column_values_to_be_of_type", "kwargs": {"column": "a", "type_": "integer"}, "meta": {}},
        {"type": "expect_column_values_to_be_unique", "kwargs": {"column": "b"}, "meta": {"check_id": "t:b:unique"}},
        {"type": "expect_column_pair_values_a_to_be_greater_than_b", "kwargs": {"column_A": "a", "column_B": "b", "mostly": 0.5}},
    ]}
    checks = [Check.from_dict("t", e) for e in suite["expectations"]]
    r = _run(spark, [(1, 0), (2, 0), (3, 5)], "a INT, b INT", checks)
    assert r["t::table_columns_to_match_ordered_list"]["success"] is True
    assert r["t:a:column_values_to_be_of_type"]["success"] is True
    assert r["t:b:unique"]["unexpected_count"] == 2
    assert r["t:a+b:column_pair_values_a_to_be_greater_than_b"]["success"] is True  # 2 of 3 >= 0.5


def test_case_insensitive_and_trim(spark):
    rows = [("Normal",), ("normal",), ("HIGH\t",), ("low",)]
    parent = spark.createDataFrame([("normal",), ("high",), ("Low",)], "name STRING")
    cs = [
        Check("t", "column_values_to_be_in_set", "p", {"value_set": ["normal", "high", "low"]}, check_id="cs"),
        Check("t", "column_values_to_be_in_set", "p", {"value_set": ["normal", "high", "low"], "case_insensitive": True,
                                                       "trim": True}, check_id="ci"),
        Check("t", "column_values_to_be_unique", "p", {"case_insensitive": True}, check_id="u"),
        Check("t", "foreign_key", "p", {"parent_table": "par", "parent_columns": ["name"], "case_insensitive": True,
                                        "trim": True}, check_id="fk"),
    ]
    r = _run(spark, rows, "p STRING", cs, extra={"par": parent})
    assert r["cs"]["unexpected_count"] == 2
    assert r["ci"]["unexpected_count"] == 0
    assert r["u"]["unexpected_count"] == 2
    assert r["fk"]["unexpected_count"] == 0


def test_exact_quantiles_multi_round_refinement(spark, monkeypatch):
    import random

    from probity.operators import quantiles as Q

    rnd = random.Random(11)
    vals = [rnd.random() for _ in range(2000)] + [0.25] * 1000  # a hot value: a third of the rows
    df = spark.createDataFrame([(v,) for v in vals], "x DOUBLE")
    s = sorted(vals)
    # short digits force several rounds and the exit at a range of one value
    monkeypatch.setattr(Q, "BITS", 6)
    ps = (0.01, 0.1, 0.2, 0.5, 0.97, 1.0)
    got = Q.select_ranks(df, [("x", *Q.disc(p)) for p in ps])
    assert [v[0] for _, v in got] == [s[max(1, math.ceil(p * len(s))) - 1] for p in ps]
    med = Q.median_of(Q.select_ranks(df, [("x", *Q.MEDIAN)])[0][1])
    assert med == pytest.approx((s[1499] + s[1500]) / 2)


def test_unplannable_check_is_isolated(spark):
    from probity.plans.report import contract_evaluation

    df = spark.createDataFrame([(1,), (2,)], "x INT")
    good = Check("t", "column_values_to_be_between", "x", {"max_value": 1}, check_id="good")
    bad = Check("t", "row_condition", (), {"expression": "no_such_column > 1"}, check_id="bad")
    out = {r["check_id"]: r for r in validate({"t": df}, [good, bad]).collect()}
    assert out["good"]["unexpected_count"] == 1 and out["bad"]["success"] is None


def test_approx_distinct_counts(spark):
    rows = [(i % 997,) for i in range(20000)]
    exact = Check("t", "column_unique_value_count_to_be_between", "x", {"min_value": 990, "max_value": 1000}, check_id="e")
    approx = Check("t", "column_unique_value_count_to_be_between", "x", {"min_value": 950, "max_value": 1050, "approx": True},
                   check_id="a")
    prop = Check("t", "column_proportion_of_unique_values_to_be_between", "x", {"max_value": 0.1, "approx": True}, check_id="p")
    assert approx.pass_kind == "A" and exact.pass_kind == "G"
    r = _run(spark, rows, "x INT", [exact, approx, prop])
    assert r["e"]["observed_value"] == 997.0 and r["e"]["success"]
    assert abs(r["a"]["observed_value"] - 997) < 997 * 0.05 and r["a"]["success"]
    assert r["p"]["success"]


def test_kl_divergence_bins(spark):
    rows = [(0.5,)] * 30 + [(1.5,)] * 70 + [(None,)] * 5
    q = {"bins": [0, 1, 2], "weights": [0.5, 0.5]}
    c = Check("t", "column_kl_divergence_to_be_less_than", "x", {"partition_object": q, "threshold": 0.1}, check_id="k")
    out = {"k": Check("t", "column_kl_divergence_to_be_less_than", "x", {"partition_object": {"bins": [0, 1], "weights": [1.0]},
                                                                       "threshold": 0.1}, check_id="o")}
    assert c.pass_kind == "A"
    r = _run(spark, rows, "x DOUBLE", [c, out["k"]])
    want = 0.3 * math.log(0.3 / 0.5) + 0.7 * math.log(0.7 / 0.5)
    assert r["k"]["observed_value"] == pytest.approx(want) and r["k"]["success"] is True
    assert r["o"]["observed_value"] == math.inf and r["o"]["success"] is False


def test_unorderable_quantile_is_an_error_not_a_failure(spark):
    df = spark.createDataFrame([({"a": 1},), ({"b": 2},)], "m MAP<STRING, INT>")
    bad = Check("t", "column_median_to_be_between", "m", {"min_value": 0}, check_id="med")
    ok = Check("t", "table_row_count_to_equal", (), {"value": 2}, check_id="rows")
    out = {r["check_id"]: r for r in validate({"t": df}, [bad, ok]).collect()}
    assert out["med"]["success"] is None and out["rows"]["success"] is True


def test_decimal_bounds_are_exact(spark):
    import decimal

    rows = [(decimal.Decimal("0.10"),), (decimal.Decimal("0.30"),), (decimal.Decimal("0.31"),)]
    c = Check("t", "column_values_to_be_between", "amt", {"min_value": 0.1, "max_value": 0.3}, check_id="d")
    r = _run(spark, rows, "amt DECIMAL(10,2)", [c])
    assert r["d"]["unexpected_count"] == 1


def test_value_sets_of_any_size_behave_alike(spark):
    from probity.plans.report import failing_rows, rows_flipped

    df = spark.createDataFrame([("red",), ("Green ",), ("BLUE",), ("grey",), (None,)], "c STRING")
    for size in (3, 1000, 1001, 50_000):
        members = ["Red", "green", "blue"] + [f"other {i}" for i in range(size - 3)]
        params = {"value_set": members, "trim": True, "case_insensitive": True}
        c1 = Check("t", "column_values_to_be_in_set", "c", params, check_id="in")
        c2 = Check("t", "column_values_to_not_be_in_set", "c", params, check_id="out")
        r = {x["check_id"]: (x["element_count"], x["missing_count"], x["unexpected_count"], x["success"]) for x in validate({"t": df}, [c1, c2]).collect()}
        assert r == {"in": (5, 1, 1, False), "out": (5, 1, 3, False)}
        assert [x["c"] for x in failing_rows(df, [c1]).collect()] == ["grey"]
        none = Check("t", "column_values_to_be_in_set", "c", {"value_set": ["grey"]}, check_id="in")
        assert rows_flipped({"t": df}, [none], [c1]).collect()[0]["rows_flipped"] == 4


def test_members_are_exact(spark):
    big = 2**53
    df = spark.createDataFrame([(big,), (None,)], "x BIGINT")
    assert not validate({"t": df}, [Check("t", "column_values_to_be_in_set", "x", {"value_set": [str(big + 1)]})]).collect()[0]["success"]
    ints = spark.createDataFrame([(1,), (2,)], "x INT")
    kinds = ("column_distinct_values_to_contain_set", "column_distinct_values_to_equal_set", "column_distinct_values_to_be_in_set")
    got = {k: validate({"t": ints}, [Check("t", k, "x", {"value_set": ["1", "2", "x", 2**40]})]).collect()[0] for k in kinds}
    assert [got[k]["success"] for k in kinds] == [False, False, True] and got[kinds[0]]["unexpected_count"] == 2
    text = spark.createDataFrame([("a",), ("B",)], "x STRING")
    folded = Check("t", kinds[0], "x", {"value_set": ["A", "a", "b"], "case_insensitive": True})
    assert validate({"t": text}, [folded]).collect()[0]["success"]
    flags = spark.createDataFrame([(False,)], "x BOOLEAN")
    assert not validate({"t": flags}, [Check("t", "column_values_to_be_in_set", "x", {"value_set": ["x"]})]).collect()[0]["success"]


def test_failing_rows_are_those_counted(spark):
    from probity.plans.report import failing_rows

    df = spark.createDataFrame([("a ",), ("A",), ("b",), ("a",), (None,), ("C",)], "k STRING")
    parent = spark.createDataFrame([("A",), ("c",)], "p STRING")
    params = {"trim": True, "case_insensitive": True}
    checks = [Check("t", "column_values_to_be_unique", "k", params, check_id="u"),
              Check("t", "foreign_key", "k", {**params, "parent_table": "p", "parent_columns": ["p"]}, check_id="f")]
    tables = {"t": df, "p": parent}
    counted = {r["check_id"]: r["unexpected_count"] for r in validate(tables, checks).collect()}
    rows = [r["check_id"] for r in failing_rows(df, checks, tables=tables).collect()]
    assert counted == {"u": 3, "f": 1} and {i: rows.count(i) for i in counted} == counted


def test_one_bad_row_does_not_end_the_suite(spark):
    df = spark.createDataFrame([(1, 0, 2**63 - 1), (4, 2, 2**63 - 1), (-4, 2, 5)], "a INT, b INT, big BIGINT")
    checks = [Check("t", "row_condition", (), {"expression": "a / b > 0"}, check_id="ratio"),
              Check("t", "multicolumn_sum_to_equal", ("big", "a"), {"sum_total": 1}, check_id="sum"),
              Check("t", "column_sum_to_be_between", "big", {"min_value": 0}, check_id="total"),
              Check("t", "column_values_to_not_be_null", "a", check_id="other"),
              Check("t", "sql_scalar", "a", {"query": "SELECT a FROM t"}, must_be_less_than=9, check_id="many")]
    r = {x["check_id"]: x for x in validate({"t": df}, checks).collect()}
    assert (r["ratio"]["missing_count"], r["ratio"]["unexpected_count"]) == (1, 1)
    assert r["sum"]["unexpected_count"] == 2 and r["total"]["success"] and r["other"]["success"]
    assert r["many"]["success"] is None and r["many"]["observed_value"] is None


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    import pytest

    from probity.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(conf=conf))


def test_failing_rows_for_large_sets(spark):
    from probity.plans.report import failing_rows

    df = spark.createDataFrame([(i,) for i in range(3000)], "x INT")
    c = Check("t", "column_values_to_be_in_set", "x", {"value_set": list(range(1, 5000, 2))})
    rows = failing_rows(df, [c], order_by=["x"], n=3).collect()
    assert [r["x"] for r in rows] == [0, 2, 4]


def _disc_reference(df, col, p):
    from pyspark.sql import functions as F

    return df.agg(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {col})")).first()[0]


def test_exact_quantiles_short_digits(spark, monkeypatch):
    import random

    from probity.operators import quantiles as Q

    rnd = random.Random(5)
    df = spark.createDataFrame([(rnd.random() * 100,) for _ in range(3000)], "x DOUBLE")
    monkeypatch.setattr(Q, "BITS", 6)
    for p in (0.05, 0.5, 0.93):
        (_, (v,)), = Q.select_ranks(df, [("x", *Q.disc(p))])
        assert v == _disc_reference(df, "x", p)


def test_exact_quantiles_special_values(spark, monkeypatch):
    import datetime as dt
    import random

    from probity.operators import quantiles as Q

    monkeypatch.setattr(Q, "BITS", 6)
    rnd = random.Random(9)
    xs = [rnd.random() for _ in range(500)] + [float("nan")] * 40 + [float("inf")] * 30 + [float("-inf")] * 20 + [None] * 5
    ks = [rnd.randint(-10**15, 10**15) for _ in range(595)]
    df = spark.createDataFrame(list(zip(xs, ks)), "x DOUBLE, t BIGINT")
    for p in (0.01, 0.03, 0.5, 0.9, 0.95, 1.0):
        (_, (v,)), = Q.select_ranks(df, [("x", *Q.disc(p))])
        want = _disc_reference(df, "x", p)
        assert (math.isnan(v) and math.isnan(want)) or v == want, (p, v, want)
        (_, (w,)), = Q.select_ranks(df, [("t", *Q.disc(p))])
        assert w == _disc_reference(df, "t", p)


def test_rows_flipped_between_suite_versions(spark):
    from probity.plans.report import rows_flipped, suite_change

    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "x INT")
    old = [Check("t", "column_values_to_be_between", "x", {"max_value": 6}, check_id="r"),
           Check("t", "column_values_to_not_be_null", "x", check_id="nn")]
    new = [Check("t", "column_values_to_be_between", "x", {"min_value": 2, "max_value": 9}, check_id="r"),
           Check("t", "column_values_to_be_unique", "x", check_id="u")]
    t = {"t": df}
    out = {r["check_id"]: r for r in suite_change(validate(t, old), validate(t, new), rows_flipped(t, old, new)).collect()}
    # old bad: {9}; new bad: {1}: two rows flip, the count of bad rows does not change
    assert out["r"]["rows_flipped"] == 2 and out["r"]["change"] == "unchanged"
    assert out["nn"]["change"] == "removed" and out["u"]["change"] == "added" and out["u"]["rows_flipped"] is None


def test_map_keys_group_in_spark4(spark):
    df = spark.createDataFrame([({"a": 1},), ({"a": 1},)], "m MAP<STRING, INT>")
    out = {r["check_id"]: r for r in validate({"t": df}, [Check("t", "column_values_to_be_unique", "m"),
                                                         Check("t", "column_values_to_not_be_null", "m")]).collect()}
    assert out["t:m:unique"]["unexpected_count"] == 2 and out["t:m:not_null"]["success"] is True


def test_exact_quantiles_longs_beyond_double_precision(spark, monkeypatch):
    import random

    from probity.operators import quantiles as Q

    monkeypatch.setattr(Q, "BITS", 6)
    rnd = random.Random(2)
    base = 2 ** 60
    ks = [base + rnd.randint(0, 300) for _ in range(600)] + [rnd.randint(0, 10 ** 6) for _ in range(200)]
    df = spark.createDataFrame([(k,) for k in ks], "k BIGINT")
    for p in (0.1, 0.3, 0.5, 0.77, 0.99):
        (_, (v,)), = Q.select_ranks(df, [("k", *Q.disc(p))])
        assert v == sorted(ks)[math.ceil(p * len(ks) - 1e-9) - 1] and float(v) == _disc_reference(df, "k", p), p


def test_order_statistics_of_every_type(spark, monkeypatch):
    """Doubles at the ends of their range, decimals, dates, timestamps of both kinds and texts against a sorted list."""
    import datetime as dt
    import random
    from decimal import Decimal

    from probity.operators import quantiles as Q

    monkeypatch.setattr(Q, "BITS", 5)
    rnd = random.Random(4)
    n = 240
    edge = [5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, 0.0, 1.0,
            math.nextafter(1.0, 0), math.nextafter(2.0, 0), 2.0, math.nextafter(8.0, 0), 8.0, math.nextafter(2.0 ** 1000, 0)]
    doubles = edge + [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300) for _ in range(n - len(edge))]
    stem = "the same beginning of every text, longer than one image \u00e9\U0001f600 "
    texts = ["", "a", "a\0", "ab", "b" * 7, "b" * 8, "\u00e9"] + ["z" * 500] * 80 + [stem + str(rnd.randint(0, 50)) for _ in range(n - 87)]
    longs = [2 ** 63 - 1, -2 ** 63] + [rnd.randint(-2 ** 63, 2 ** 63 - 1) for _ in range(n - 2)]
    wide = [Decimal(rnd.randint(-10 ** 33, 10 ** 33)).scaleb(-4) for _ in range(n // 2)] + [Decimal(rnd.randint(-99999, 99999)).scaleb(-4) for _ in range(n // 2)]
    narrow = [Decimal(rnd.randint(-10 ** 11, 10 ** 11)).scaleb(-2) for _ in range(n)]
    days = [dt.date(1969, 12, 1) + dt.timedelta(days=rnd.randint(0, 90)) for _ in range(n)]
    times = [dt.datetime(1969, 12, 31) + dt.timedelta(microseconds=rnd.randint(0, 10 ** 12)) for _ in range(n)]
    columns = {"d": doubles, "t": texts, "l": longs, "w": wide, "m": narrow, "day": days, "ts": times, "ntz": times}
    ddl = "d DOUBLE, t STRING, l BIGINT, w DECIMAL(36,4), m DECIMAL(12,2), day DATE, ts TIMESTAMP, ntz TIMESTAMP_NTZ"
    df = spark.createDataFrame([*zip(*columns.values()), (None,) * len(columns)], ddl)
    ps = [0.0, 0.05, 0.31, 0.5, 0.66, 1.0]
    got = Q.select_ranks(df, [(c, *Q.disc(p)) for c in columns for p in ps])
    wants = [(c, p, sorted(vs, key=lambda v: v.encode() if isinstance(v, str) else v)[max(1, math.ceil(p * n - 1e-9)) - 1])
             for c, vs in columns.items() for p in ps]
    assert [(c, p, v[0]) for (c, p, _), (_, v) in zip(wants, got)] == wants
    assert all(count == n for count, _ in got)
    empty = Q.order_statistics(df.where("l = 0 AND l = 1"), {"t": [0.5], "d": [0.5]}).collect()
    assert [(r["non_null"], r["value"]) for r in empty] == [(0, None), (0, None)]
    with pytest.raises(ValueError):
        Q.select_ranks(spark.createDataFrame([([1],)], "a ARRAY<INT>"), [("a", *Q.disc(0.5))])


def test_sketch_only_median_and_quantiles(spark):
    rows = [(float(i),) for i in range(1, 1001)]
    med = Check("t", "column_median_to_be_between", "x", {"min_value": 490, "max_value": 510, "exact": False}, check_id="m")
    qs = Check("t", "column_quantile_values_to_be_between", "x",
               {"quantile_ranges": {"quantiles": [0.1, 0.9], "value_ranges": [[90, 110], [890, 910]]}, "exact": False},
               check_id="q")
    r = _run(spark, rows, "x DOUBLE", [med, qs])
    assert r["m"]["success"] and abs(r["m"]["observed_value"] - 500.5) < 2
    assert r["q"]["success"] and r["q"]["unexpected_count"] == 0


def test_failing_rows_for_ordered_checks(spark):
    from probity.plans.report import failing_rows

    rows = [(i, i, 1) for i in range(50)] + [(50, 10, 1)] + [(i, i, 2) for i in range(60, 120)] + [(130, 5, 2)]
    df = spark.createDataFrame(rows, "o INT, v INT, g INT")
    c1 = Check("t", "column_values_to_be_increasing", "v", {"order_by": "o", "buckets": 7}, check_id="glob")
    c2 = Check("t", "column_values_to_be_increasing", "v", {"order_by": "o", "partition_by": ["g"], "buckets": 5}, check_id="grp")
    got = sorted((r["check_id"], r["o"], r["v"]) for r in failing_rows(df, [c1, c2], order_by=["o"], n=10).collect())
    assert got == [("glob", 50, 10), ("glob", 130, 5), ("grp", 50, 10), ("grp", 130, 5)]


def test_ordered_violations_match_counts(spark):
    import random

    from probity.operators.ordered import ordered_violations

    rnd = random.Random(4)
    rows = [(rnd.randint(0, 40), rnd.randint(0, 9), rnd.randint(0, 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "o INT, v INT, g INT")
    for params in ({"order_by": "o", "buckets": 6}, {"order_by": "o", "partition_by": ["g"], "buckets": 4, "strictly": False}):
        c = Check("t", "column_values_to_be_decreasing", "v", params, check_id="c")
        n = validate({"t": df}, [c]).collect()[0]["unexpected_count"]
        assert ordered_violations(df, c).count() == n


def test_ordered_folds_nan_nulls_and_groups(spark):
    nan = float("nan")
    rows = [(i, None if i % 5 == 4 else (nan if i >= 38 else float(i % 19)), None if i % 3 == 0 else "g%d" % (i % 3)) for i in range(40)] + [(None, 1.0, "g1")]
    df = spark.createDataFrame(rows, "o long, v double, g string").repartition(3)

    def breaks(strictly, grouped):
        key = lambda x: (x != x, x)  # noqa: E731  NaN is above all numbers
        n = 0
        for g in {r[2] for r in rows} if grouped else {0}:
            seq = [r[1] for r in sorted((r for r in rows if r[0] is not None and r[1] is not None and (not grouped or r[2] == g)), key=lambda r: r[0])]
            n += sum(not ((key(b) > key(a) if b == b or a == a else False) or (not strictly and (a == b or (a != a and b != b)))) for a, b in zip(seq, seq[1:]))
        return n

    for strictly in (True, False):
        for grouped in (True, False):
            c = Check("t", "column_values_to_be_increasing", "v", {"order_by": "o", "strictly": strictly, "buckets": 6, **({"partition_by": ["g"]} if grouped else {})}, check_id="c")
            r = validate({"t": df}, [c], spark=spark).first()
            assert (r["element_count"], r["missing_count"], r["unexpected_count"]) == (41, 9, breaks(strictly, grouped)), (strictly, grouped)


def test_broken_mask_is_one_scan(spark, tmp_path):
    """Ten row checks: one scan and no exchange; the rows of failing_rows are those of a filter per check."""
    from probity.plans.report import broken_mask, failing_rows, violating_rows

    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(i, None if i % 7 == 0 else f"v{i % 5}", float(i % 11)) for i in range(200)] + [(None, None, None)] * 2,
                          "id INT, `na me` STRING, x DOUBLE").write.parquet(path)
    df = spark.read.parquet(path)
    checks = [Check("t", "column_values_to_be_between", "id", {"max_value": 20 * i}, check_id=f"id{i}") for i in range(1, 7)]
    checks += [Check("t", "column_values_to_not_be_null", "na me"), Check("t", "column_values_to_be_in_set", "na me", {"value_set": ["v1", "v2"]}),
               Check("t", "column_values_to_be_in_set", "id", {"value_set": list(range(0, 900, 3))}, check_id="long"),
               Check("t", "row_condition", "x", {"expression": "10 / x > 2"}, check_id="custom")]
    marked = broken_mask(df, checks)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert all(len(r["broken"]) == 10 and "1" in r["broken"] for r in marked.collect())
    got = sorted(map(str, failing_rows(df, checks).collect()))
    want = sorted(str(type(r)(**{"check_id": c.check_id, **r.asDict()})) for c in checks for r in violating_rows(c, df).collect())
    assert got == want and len(got) > 500
    assert broken_mask(df, []).count() == 0 and broken_mask(df.limit(0), checks).count() == 0
    with pytest.raises(ValueError):
        broken_mask(df, [Check("t", "column_values_to_be_unique", "id")])
    with pytest.raises(ValueError):
        broken_mask(df.withColumnRenamed("x", "broken"), checks[:1])


def test_comparison_by_digests(spark, tmp_path):
    """Equal to the one-shuffle comparison; only rows of unequal buckets reach the row comparison; views come back."""
    from probity.operators.keys import bag_difference_by_digest, bag_difference_count

    a = spark.createDataFrame([(i % 50, None if i % 9 == 0 else f"v{i % 13}", float(i % 4)) for i in range(3000)] + [(None, None, None)] * 2, "k INT, s STRING, x DOUBLE")
    cases = [a, a.limit(0), a.where("k <> 3"), a.unionAll(a.where("k = 7")), a.selectExpr("CAST(k AS BIGINT)", "s", "x"),
             a.selectExpr("k", "s", "CASE WHEN x = 0 THEN -0.0D ELSE x END")]
    for b in cases:
        for n in (1, 7, 4096):
            assert bag_difference_by_digest(a, b, n).first() == bag_difference_count(a, b).first()
    maps = spark.createDataFrame([({"a": 1},), ({"b": 2},)], "m MAP<STRING, INT>")
    assert tuple(bag_difference_by_digest(maps, maps.limit(1)).first()) == (1, 0)
    spark.range(3).createOrReplaceTempView("t")
    chk = Check("t", "query_results_to_match_comparison", (), {"base_query": "SELECT k FROM t", "comparison_query": "SELECT k FROM u", "digests": True})
    r = validate({"t": a, "u": a.where("k <> 3")}, [chk]).first()
    # 60 rows with k = 3 and the two with a null k
    assert r["unexpected_count"] == 62 and spark.table("t").columns == ["id"] and not spark.catalog.tableExists("u")
    spark.catalog.dropTempView("t")


def test_grown_tables_scan_new_files_only(spark, tmp_path):
    """Equal to a plain run after each step: more files, a changed check, a replaced and a removed file, an empty table."""
    import glob
    import os

    from probity.plans.states import part_states, validate_grown

    path, states = str(tmp_path / "t"), str(tmp_path / "states")
    checks = [Check("t", "column_values_to_be_between", "a b", {"max_value": 20}), Check("t", "column_values_to_not_be_null", "s"),
              Check("t", "column_max_to_be_between", "x", {"max_value": 1e9}), Check("t", "column_mean_to_be_between", "x", {"min_value": 0}),
              Check("t", "column_proportion_of_non_null_values_to_be_between", "s", {"min_value": 0.5}),
              Check("t", "row_condition", "x", {"expression": "10 / x > 2"}, check_id="custom"), Check("t", "table_row_count_to_equal", (), {"value": 90})]

    def add(lo, hi, mode="append"):
        rows = [(i, None if i % 4 == 0 else f"v{i}", float(i % 11)) for i in range(lo, hi)]
        spark.createDataFrame(rows, "`a b` INT, s STRING, x DOUBLE").coalesce(1).write.mode(mode).parquet(path)

    def same(suite):
        got = sorted(map(str, validate_grown(spark, path, states, suite).collect()))
        want = sorted(map(str, validate({"t": spark.read.parquet(path)}, suite).collect()))
        assert got == want
        return spark.read.parquet(states)

    add(0, 0, "overwrite")
    assert len(validate_grown(spark, path, states, checks).collect()) == len(checks)
    add(0, 60)
    first = same(checks).count()
    assert same(checks).count() == first  # nothing new: nothing stored
    add(60, 90)
    assert same(checks).count() == 2 * first
    changed = [Check("t", "column_values_to_be_between", "a b", {"max_value": 40}), *checks[1:]]
    assert same(changed).count() == 2 * first + 2 * 3  # three aggregates of the one changed check in two files
    os.remove(sorted(glob.glob(path + "/*.parquet"), key=os.path.getsize)[-1])
    spark.catalog.refreshByPath(path)
    same(changed)
    with pytest.raises(ValueError):
        part_states(spark.read.parquet(path), [Check("t", "column_values_to_be_unique", "s")], _lit("p"))


def _lit(v):
    from pyspark.sql import functions as F

    return F.lit(v)


def test_rows_flipped_of_keys(spark):
    from probity.plans.report import rows_flipped

    df = spark.createDataFrame([("a", 1), ("A", 1), ("b", 2), ("b", 2), (None, 2), ("c", None), (" c", None)], "k string, v int")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    other = spark.createDataFrame([("c",), ("A",)], "p string")
    t = {"t": df, "p": parent, "q": other, "e": df.limit(0)}
    unique = lambda kind, cols, **kw: Check(kw.pop("table", "t"), kind, cols, kw, check_id="x")
    flips = lambda o, n: [r["rows_flipped"] for r in rows_flipped(t, [o], [n]).collect()]
    plain = unique("column_values_to_be_unique", "k")
    assert flips(plain, plain) == [0]
    assert flips(plain, unique("column_values_to_be_unique", "k", case_insensitive=True)) == [2]
    assert flips(plain, unique("column_values_to_be_unique", "k", trim=True)) == [2]
    # v: 1, 1, 2, 2, 2 repeat; of k only b, b
    assert flips(plain, unique("column_values_to_be_unique", "v")) == [3]
    assert flips(unique("multicolumn_values_to_be_unique", ("k", "v")), unique("compound_columns_to_be_unique", ("k", "v"))) == [0]
    fk = lambda parent, **kw: Check("t", "foreign_key", "k", {"parent_table": parent, "parent_columns": ["p"], **kw}, check_id="x")
    # orphans: A, c, " c" of p; a, b, b, " c" of q
    assert flips(fk("p"), fk("q")) == [5]
    assert flips(fk("p"), fk("p", case_insensitive=True)) == [1]
    assert flips(fk("p"), fk("nowhere")) == []
    assert rows_flipped(t, [unique("column_values_to_be_unique", "k", table="e")], [unique("column_values_to_be_unique", "v", table="e")]).collect()[0]["rows_flipped"] == 0


def test_distinct_counts_by_words(spark):
    """Whole numbers and dates are counted as bits: edges of words and types, nulls, hot values, empty tables."""
    import datetime

    from probity.operators.profile import profile
    from probity.plans.compile import validate as run

    edge = [-(2**63), 2**63 - 1, -1, 0, 63, 64, -64, -65, 1, 1, 1, None]
    small = [-128, 127, 0, 1, 1, None, None, 5, 6, 7, 8, 9]
    days = [datetime.date(1969, 12, 31), datetime.date(1970, 1, 1), datetime.date(1, 1, 1), datetime.date(9999, 12, 31)] * 3
    rows = [(a, b, c, None, f"t{i % 5}") for i, (a, b, c) in enumerate(zip(edge, small, days))]
    df = spark.createDataFrame(rows, "a bigint, b tinyint, c date, d int, e string")
    got = {r["column_name"]: (r["distinct_count"], r["distinct_ratio"]) for r in profile(df, "t").collect()}
    assert got == {c: (n, n / 12) for c, n in {"a": len(set(edge) - {None}), "b": len(set(small) - {None}), "c": 4, "d": 0, "e": 5}.items()}
    assert {r["distinct_count"] for r in profile(df.limit(0), "t").collect()} == {0}
    checks = [Check("t", kind, c, {"min_value": 0, "max_value": 100}) for kind in ("column_unique_value_count_to_be_between", "column_proportion_of_unique_values_to_be_between") for c in "abcd"]
    seen = {r["check_id"]: r for r in run({"t": df}, checks).collect()}
    for chk in checks:
        r, column = seen[chk.check_id], [row["abcd".index(chk.column)] for row in rows]
        values = [v for v in column if v is not None]
        assert (r["element_count"], r["missing_count"]) == (12, 12 - len(values))
        share = "proportion" in chk.kind
        want = (len(set(values)) / len(values) if values else None) if share else len(set(values))
        assert r["observed_value"] == (want if want is None else pytest.approx(want)), chk.check_id
    none = run({"t": df.limit(0)}, checks[:1]).collect()[0]
    assert (none["element_count"], none["observed_value"]) == (0, 0.0)
    # a key that is asked for its values too keeps its values
    both = [checks[0], Check("t", "column_values_to_be_unique", "a")]
    assert {r["observed_value"] for r in run({"t": df}, both).collect()} >= {9.0}


def test_conditions_of_parallel_reads(spark):
    """Each row meets exactly one condition, whatever the key; ranges are even, a hot value is cut by its hash."""
    import datetime
    import decimal

    from pyspark.sql import functions as F

    from probity.sources.tables import hash_predicates, split_predicates

    rows = [(i % 50 if i % 11 else None, f"it's {i % 7}" if i % 13 else None, "hot" if i % 3 else f"k{i}", i, decimal.Decimal(i) / 4,
             datetime.date(2000, 1, 1) + datetime.timedelta(days=i % 90), datetime.datetime(2000, 1, 1, 0, 0, i % 60, i), "back\\slash" if i % 2 else "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, h string, i int, d decimal(20,4), day date, ts timestamp_ntz, s string").cache()

    def sizes(predicates):
        met = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
        one = df.agg(*[F.sum(m).alias(f"n{j}") for j, m in enumerate(met)], F.count_if(sum(met, F.lit(0)) != 1).alias("wrong")).first()
        assert one["wrong"] == 0
        return [one[f"n{j}"] for j in range(len(met))]

    for keys in (["a", "b"], ["a"], ["i"], ["d"], ["day"], ["ts", "i"], ["s"], ["b", "a", "i"]):
        sample = [tuple(r) for r in df.select(*keys).dropna().orderBy(*keys).collect()]
        assert len(sizes(split_predicates(keys, sample, 6))) <= 7
    even = sizes(split_predicates(["i"], [(i,) for i in range(3000)], 6))
    assert even == [500] * 6 + [0]
    hot = [tuple(r) for r in df.select("h").orderBy("h").collect()]
    assert max(sizes(split_predicates(["h"], hot, 6))) == 2000
    assert max(sizes(split_predicates(["h"], hot, 6, ["i"]))) < 700
    # a sample that knows nothing, or something else, loses no row either
    sizes(split_predicates(["a", "b"], [], 6))
    sizes(split_predicates(["a"], [(10**6,), (10**7,)], 3))
    assert sum(sizes(hash_predicates(["b", "i"], 5))) == 3000


def test_value_types_of_texts(spark):
    df = spark.createDataFrame([("1", "2001-02-28", "1.5"), ("x", "2001-02-29", "nan?"), (None, None, None), ("-7", "", "2")], "a string, d string, n string")
    of = lambda col, t: Check("t", "column_values_to_be_of_type", col, {"type_": t, "value_test": True}, check_id=f"{col}:{t}")
    got = {r["check_id"]: r for r in validate({"t": df}, [of("a", "int unsigned"), of("d", "date"), of("n", "decimal(5,2)"), of("n", "integer"), of("a", "varchar(3)"), of("a", "array")]).collect()}
    assert {k: r["unexpected_count"] for k, r in got.items()} == {"a:int unsigned": 1, "d:date": 2, "n:decimal(5,2)": 1, "n:integer": 2, "a:varchar(3)": 0, "a:array": None}
    assert all(r["missing_count"] == 1 for k, r in got.items() if k != "a:array") and got["a:array"]["success"] is None


def test_reasons_for_what_is_not_proposed(spark):
    from probity.operators.profile import profile
    from probity.plans.report import not_suggested

    df = spark.createDataFrame([(i, f"v{i % 5}", None if i % 2 else 1.5) for i in range(20)], "k int, s string, x double")
    why = lambda p, **kw: {(r["column_name"], r["kind"].removeprefix("column_values_to_")): (r["reason"], r["observed"]) for r in not_suggested(p, **kw).collect()}
    got = why(profile(df, "t"), max_domain=4)
    assert got == {
        ("k", "be_in_set"): ("not a text", None), ("s", "be_unique"): ("repeats or nulls", 0.25), ("s", "be_between"): ("no order statistics", None),
        ("s", "be_in_set"): ("more than 4 values", 5.0), ("x", "not_be_null"): ("nulls", 0.5), ("x", "be_unique"): ("repeats or nulls", 0.05), ("x", "be_in_set"): ("not a text", None),
    }
    assert ("s", "be_in_set") not in why(profile(df, "t"), max_domain=5)
    assert set(why(profile(df.limit(0), "t")).values()) == {("empty table", None)}
