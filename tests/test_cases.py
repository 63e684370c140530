"""Case-study shapes (FIXTURES §B) on made-up values: zero dates, sentinels,
non-ASCII lengths, all-null column, empty table, n = 100 quantiles, extra
column, decimal tolerance, negative balance."""

import datetime as dt
import decimal

from probity import Check, validate
from probity.operators.profile import profile
from probity.operators.schema import schema_view
from probity.sources.tables import normalize_missing, parse_zero_dates


def test_zero_dates_and_sentinels(spark):
    df = spark.createDataFrame([("2019-05-01 10:00:00", "N/A"), ("0000-00-00 00:00:00", ""), ("2050-01-01 00:00:00", "ok")],
                               "d STRING, s STRING")
    out = normalize_missing(parse_zero_dates(df, ["d"]), ["s"]).collect()
    assert out[1]["d"] is None and out[0]["d"] == dt.datetime(2019, 5, 1, 10)
    assert [r["s"] for r in out] == [None, None, "ok"]


def test_non_ascii_lengths_are_characters(spark):
    df = spark.createDataFrame([("مرحبا بالعالم",), ("abc",)], "t STRING")
    r = validate({"t": df}, [Check("t", "column_value_lengths_to_be_between", "t", {"max_value": 13})]).collect()[0]
    assert r["unexpected_count"] == 0  # 13 characters, 25 bytes


def test_profile_all_null_empty_and_n100(spark):
    df = spark.createDataFrame([(i, None, float(i)) for i in range(1, 101)], "id INT, empty_col INT, v DOUBLE")
    p = {r["column_name"]: r for r in profile(df, "t").collect()}
    assert p["empty_col"]["null_rate"] == 1.0 and p["empty_col"]["p01"] is None
    assert (p["v"]["p01"], p["v"]["p99"]) == (1.0, 100.0)  # at n = 100 p99 is the maximum
    empty = spark.createDataFrame([], "id INT")
    e = profile(empty, "e").collect()[0]
    assert e["row_count"] == 0 and e["null_rate"] is None and e["distinct_ratio"] is None


def test_extra_and_missing_columns_in_schema_view(spark):
    df = spark.createDataFrame([(1, "x", dt.datetime(2020, 1, 1))], "id BIGINT, note STRING, created_at TIMESTAMP_NTZ")
    v = {r["column"]: r["status"] for r in
         schema_view(spark, {"beds": {"id": "integer", "note": "integer", "stop": "timestamp"}}, {"beds": df}).collect()}
    assert v == {"id": "match", "note": "type_differs", "stop": "missing", "created_at": "extra"}


def test_decimal_tolerance(spark):
    D = decimal.Decimal
    df = spark.createDataFrame([(D("2.50"), D("2.49"), -5), (D("2.50"), D("2.51"), 3)], "weighed DECIMAL(10,2), packed DECIMAL(10,2), boxes INT")
    cs = [Check("t", "row_condition", (), {"expression": "packed <= weighed"}, check_id="tol"),
          Check("t", "row_condition", (), {"expression": "boxes > 0"}, check_id="pos")]
    r = {x["check_id"]: x for x in validate({"t": df}, cs).collect()}
    assert r["tol"]["unexpected_count"] == 1 and r["pos"]["unexpected_count"] == 1


def test_profile_map_column(spark):
    df = spark.createDataFrame([({"a": 1}, 1), ({"b": 2}, 2)], "m MAP<STRING, INT>, x INT")
    p = {r["column_name"]: r for r in profile(df, "t").collect()}
    assert p["m"]["distinct_count"] == 2 and p["x"]["distinct_count"] == 2


def test_combined_batch_with_conflicting_types(spark):
    from probity.plans.report import combine_batch

    a = spark.createDataFrame([(1, "x")], "id INT, creationdate STRING")
    b = spark.createDataFrame([(2, dt.date(2020, 1, 1), 5)], "id INT, creationdate DATE, extra INT")
    batch = combine_batch({"a": a, "b": b})
    assert dict(batch.dtypes)["creationdate"] == "string" and batch.count() == 2
    r = {x["check_id"]: x for x in validate({"batch": batch}, [Check("batch", "column_values_to_not_be_null", "extra")]).collect()}
    assert r["batch:extra:not_null"]["unexpected_count"] == 1  # fails for the wrong reason, as the reference's wide batch


def test_validate_tables_reads_parents(spark):
    from probity.plans.compile import validate_tables

    cs = [Check("lineitem", "foreign_key", "l_orderkey", {"parent_table": "orders", "parent_columns": ["o_orderkey"]}),
          Check("documents", "table_row_count_to_equal_other_table", (), {"other_table_name": "labels"})]
    r = {x["check_id"]: x for x in validate_tables(spark, "/root/testdata/sf0.001", cs).collect()}
    assert r["lineitem:l_orderkey:foreign_key"]["success"] is True
    assert r["documents::table_row_count_to_equal_other_table"]["success"] is False
