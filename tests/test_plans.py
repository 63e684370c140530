"""Physical-plan properties the design relies on, read from ``explain``."""

import contextlib
import io
import re

from probity import Check
from probity.plans.compile import _foreign_key, _ordered, fused_pass, group_pass
from probity.sources.tables import read_tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def scans(p: str) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", p, re.M))


def test_fused_pass_one_scan_pruned_pushed_one_exchange(spark):
    t = read_tables(spark, SF, ["lineitem"])
    li = t["lineitem"].where("l_shipdate >= '1996-01-01'")
    checks = [
        Check("lineitem", "column_values_to_be_between", "l_discount", {"min_value": 0, "max_value": 0.07}),
        Check("lineitem", "column_values_to_be_in_set", "l_returnflag", {"value_set": ["A", "N", "R"]}),
        Check("lineitem", "column_mean_to_be_between", "l_quantity", {"min_value": 0}),
        Check("lineitem", "column_values_to_match_regex", "l_linestatus", {"regex": "^[FO]$"}),
    ]
    p = plan(fused_pass(li, checks, t))
    assert scans(p) == 1
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert set(x.split(":")[0] for x in schema.split(",")) == {"l_discount", "l_returnflag", "l_quantity", "l_linestatus", "l_shipdate"}
    assert "GreaterThanOrEqual(l_shipdate" in p  # filter reaches the scan
    assert "PythonUDF" not in p and "BatchEvalPython" not in p


def test_group_pass_partial_aggregation_before_shuffle(spark):
    t = read_tables(spark, SF, ["lineitem"])
    checks = [Check("lineitem", "column_values_to_be_unique", "l_orderkey"),
              Check("lineitem", "column_unique_value_count_to_be_between", "l_orderkey", {"min_value": 1})]
    p = plan(group_pass(t["lineitem"], ("l_orderkey",), checks))
    assert scans(p) == 1
    assert "partial_count" in p  # map-side combine before the key shuffle
    assert "ReadSchema: struct<l_orderkey:bigint>" in p


def test_foreign_key_plan(spark):
    t = read_tables(spark, SF, ["lineitem", "orders"])
    c = Check("lineitem", "foreign_key", "l_orderkey", {"parent_table": "orders", "parent_columns": ["o_orderkey"]})
    p = plan(_foreign_key(c, t["lineitem"], t))
    assert scans(p) == 2  # each side read once
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "LeftOuter" in p
    assert "ReadSchema: struct<l_orderkey:bigint>" in p and "ReadSchema: struct<o_orderkey:bigint>" in p


def test_ordered_plan_has_no_global_sort_of_rows(spark):
    t = read_tables(spark, SF, ["events"])
    c = Check("events", "column_values_to_be_increasing", "value", {"order_by": "ts"})
    p = plan(_ordered(c, t["events"], t))
    assert "rangepartitioning" in p
    # rows are folded inside their range partitions; only the per-bucket table is gathered
    assert p.index("MapInArrow") < p.index("SinglePartition") and "Window" in p[p.index("SinglePartition"):]


def test_replay_prunes_partitions(spark, tmp_path):
    from probity.sources import sinks
    from probity.sources.tables import first_n, replay

    t = read_tables(spark, SF, ["orders"])
    base = str(tmp_path)
    for run in ("r1", "r2"):
        sinks.write_sample(first_n(t["orders"], "o_orderkey", 10), base, "tpch", "orders", run)
    df = replay(spark, base, "tpch", "orders", "r2")
    p = plan(df)
    assert "PartitionFilters: [" in p and "run_id" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() == 10


def test_unique_and_foreign_key_share_the_key_shuffle(spark):
    from probity import validate

    t = read_tables(spark, SF, ["lineitem", "orders"])
    cs = [Check("lineitem", "column_values_to_be_unique", "l_orderkey"),
          Check("lineitem", "foreign_key", "l_orderkey", {"parent_table": "orders", "parent_columns": ["o_orderkey"]})]
    r = validate(t, cs)
    r.collect()  # after execution, explain shows AQE's final plan
    assert "ReusedExchange" in plan(r)


def test_explain_suite(spark):
    from probity import explain_suite

    t = read_tables(spark, SF, ["lineitem"])
    text = explain_suite(t, [Check("lineitem", "column_values_to_not_be_null", "l_orderkey"),
                             Check("lineitem", "column_values_to_be_unique", "l_suppkey")])
    assert "ReadSchema: struct<l_orderkey:bigint>" in text and "ReadSchema: struct<l_suppkey:bigint>" in text


def test_ordered_check_reads_and_exchanges_once(spark):
    t = read_tables(spark, SF, ["events"])
    c = Check("events", "column_values_to_be_decreasing", "value", {"order_by": "ts"})
    p = plan(_ordered(c, t["events"], t))
    assert len(re.findall(r"^Arguments: rangepartitioning", p, re.M)) == 1 and "hashpartitioning" not in p and scans(p) == 1
