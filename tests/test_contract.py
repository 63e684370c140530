"""Contract dialects, text rules, thresholds and contract evaluation on an invented garden."""

import datetime as dt

import pytest

from probity import Check, load_contract, validate
from probity.functions.thresholds import mostly_of, parse_duration, parse_share
from probity.functions.sqltext import to_spark_sql

DIALECT_FIELD = """
dataContractSpecification: 1.2.1
servers: {mysql: {host: localhost}}
models:
  bed:
    type: table
    fields:
      bed_id: {type: integer, required: true, unique: true, primaryKey: true}
      cover:
        type: string
        quality:
          - type: library
            metric: invalidValues
            arguments: {validValues: [glass, film, open]}
            mustBeLessThan: 2
      yield_g:
        type: integer
        quality:
          - type: library
            metric: nullValues
            unit: percent
            mustBeLessThan: 30
          - type: sql
            query: SELECT quantile(yield_g, 0.8) AS q FROM bed
            mustBeLessThan: 700
      sown_on: {type: timestamp}
      picked_on:
        type: timestamp
        quality:
          - type: text
            description: picked_on must be later than or equal to sown_on.
      tag:
        type: string
        physicalType: varchar(9)
        quality:
          - type: text
            description: Must follow format "Bed#<id>" where <id> are numerics.
servicelevels:
  freshness: {threshold: 3d, timestampField: bed.sown_on}
"""

DIALECT_MODEL = {
    "dataContractSpecification": "1.0.0",
    "models": {
        "families": {"primaryKey": "code", "fields": {"code": {"type": "integer"}}},
        "crops": {
            "primaryKey": ["crop"],
            "fields": {"crop": {"type": "integer", "minimum": 10}, "title": {"type": "string", "maxLength": 12}},
            "quality": [
                {"rule": "unique", "field": "title"},
                {"rule": "custom", "expression": "sown >= picked"},
                {"rule": "regex", "field": "label", "pattern": "^[A-Z]{2}[0-9]$"},
                {"rule": "referential_integrity", "field": "family", "references": "families.code"},
                {"rule": "accepted_values", "field": "season", "values": ["spring", "autumn", "winter"]},
            ],
        },
        "visits": {"fields": [{"name": "keeper", "type": "integer", "references": "keepers.keeper"},
                              {"name": "state", "type": "integer"},
                              {"name": "left_on", "type": "date",
                               "quality": [{"type": "text", "description": "left_on must be present when state = 7 (gone)."}]},
                              {"name": "family", "type": "integer",
                               "quality": [{"type": "text", "description": "family must exist in families."}]}]},
    },
    "serviceLevel": {"freshness": {"maxLatency": "36h"}, "retention": {"period": "2 years"}},
    "security": {"piiFields": [{"model": "crops", "fields": ["title"]}]},
}


def test_thresholds():
    assert parse_duration("25h") == 90000 and parse_duration("30s") == 30 and parse_duration("7d") == 604800
    assert parse_share(">95%") == ("good_above", 0.95)
    assert abs(mostly_of("<5%") - 0.95) < 1e-12


def test_quantile_rewrite():
    q = to_spark_sql("SELECT quantile(acct, 0.95) AS p FROM t;")
    assert q == "SELECT percentile_disc(0.95) WITHIN GROUP (ORDER BY acct) AS p FROM t"


def test_field_dialect_and_evaluation(spark):
    c = load_contract(DIALECT_FIELD, as_of="2031-06-10 00:00:00")
    kinds = {r.rule_id: (r.check.kind if r.check else None) for r in c.rules}
    assert kinds["bed:tag:column_values_to_match_regex"] == "column_values_to_match_regex"
    assert "bed:picked_on+sown_on:order" in kinds
    assert kinds["bed:yield_g:sql"] == "sql_scalar"
    assert kinds["bed:sown_on:freshness"] == "freshness"
    day = dt.datetime(2031, 6, 8, 6)
    rows = [(1, "glass", 350, day, day + dt.timedelta(days=1), "Bed#4"), (2, "straw", None, day, day - dt.timedelta(days=2), "Bed#x"),
            (3, "mulch", 900, day, None, "Bed#10"), (4, "open", None, day, None, None)]
    df = spark.createDataFrame(rows, "bed_id INT, cover STRING, yield_g INT, sown_on TIMESTAMP_NTZ, picked_on TIMESTAMP_NTZ, tag STRING")
    out = {r["check_id"]: r for r in validate({"bed": df}, c.checks).collect()}
    assert out["bed:tag:column_values_to_match_regex"]["unexpected_count"] == 1
    assert out["bed:cover:invalid_values"]["success"] is False
    assert out["bed:picked_on+sown_on:order"]["unexpected_count"] == 1
    assert out["bed:yield_g:sql"]["observed_value"] == 900.0 and out["bed:yield_g:sql"]["success"] is False
    assert out["bed:yield_g:null_values"]["success"] is False  # half are null
    assert out["bed:sown_on:freshness"]["success"] is True
    assert out["bed:tag:column_value_lengths_to_be_between"]["success"] is True


def test_model_dialect_rules_and_skips(spark):
    from probity.plans.report import contract_evaluation

    c = load_contract(DIALECT_MODEL)
    by = {r.rule_id: r for r in c.rules}
    assert by["visits:keeper:foreign_key"].skip_reason == "parent table keepers is not in the contract"
    assert by["contract:freshness"].skip_reason == "no timestampField declared"
    assert by["visits:family:exists_in"].check.p("parent_table") == "families"
    assert by["visits:left_on:present_when"].check.kind == "conditional_not_null"
    assert c.pii == {"crops": ["title"]} and c.primary_keys["families"] == ["code"]
    crops = spark.createDataFrame(
        [(11, "kale", "spring", "KA1", 30, 12, 1), (12, "leek", "Spring", "leek", 5, 9, 8), (9, "kale", "winter", "KA2", 7, 7, 1)],
        "crop INT, title STRING, season STRING, label STRING, sown INT, picked INT, family INT")
    families = spark.createDataFrame([(1,), (2,)], "code INT")
    visits = spark.createDataFrame([(1, 7, None, 1), (2, 7, dt.date(2031, 5, 5), 9), (3, 4, None, 2)],
                                   "keeper INT, state INT, left_on DATE, family INT")
    tables = {"crops": crops, "families": families, "visits": visits}
    res = validate(tables, c.checks)
    ev = {r["rule_id"]: r for r in contract_evaluation(spark, c, res, tables).collect()}
    assert ev["crops:crop:range"]["status"] == "FAIL"
    assert ev["crops:season:domain"]["status"] == "FAIL"
    assert ev["crops:label:column_values_to_match_regex"]["status"] == "FAIL"
    assert ev["crops:title:rule_unique"]["status"] == "FAIL"
    assert ev["crops::custom"]["status"] == "FAIL"
    assert ev["visits:left_on:present_when"]["status"] == "FAIL"
    assert ev["visits:keeper:foreign_key"]["status"] == "SKIPPED"


def test_run_contract_and_replay(spark, tmp_path):
    from __spark_entry__ import FLAGSHIP_CONTRACT
    from probity.plans.run import run_contract

    out = str(tmp_path / "out")
    first = run_contract(spark, FLAGSHIP_CONTRACT, "/root/testdata/sf0.001", out, "tpch", run_id="r1", keep_sample=100)
    ev = {r["rule_id"]: r["status"] for r in first["evaluation"].collect()}
    assert ev["lineitem:l_discount:range"] == "FAIL" and ev["orders:o_orderkey:unique"] == "PASS"
    assert first["failing:lineitem"].count() > 0
    assert first["profile"].count() == 11 + 6
    # replay validates the stored 100-row samples; replaying twice gives the same results
    # (results are files under the run's folder: collect before the next replay rewrites them)
    again = run_contract(spark, FLAGSHIP_CONTRACT, "/root/testdata/sf0.001", out, "tpch", run_id="r1", replay_run=True)
    a = sorted(tuple(r) for r in again["results"].collect())
    again2 = run_contract(spark, FLAGSHIP_CONTRACT, "/root/testdata/sf0.001", out, "tpch", run_id="r1", replay_run=True)
    b = sorted(tuple(r) for r in again2["results"].collect())
    assert a == b and all(r[1] in (None, 100) for r in a if r[0].startswith("lineitem:") and "foreign" not in r[0])


def test_list_dialect_and_errors(spark):
    import pytest

    doc = {"schema": [{"name": "acct", "properties": [
        {"name": "id", "type": "integer", "required": True, "unique": True},
        {"name": "status", "type": "string", "quality": [
            {"metric": "missingValues", "arguments": {"missingValues": [None, "", "N/A", "n/a"]}, "mustBeLessThan": 5,
             "unit": "percent", "description": "few missing"}]},
        {"name": "name", "type": "string", "quality": [{"type": "text", "description": "name must end with Inc."}]},
    ]}]}
    c = load_contract(doc)
    assert c.tables == ["acct"]
    df = spark.createDataFrame([(1, "ok", "A Inc."), (2, "N/A", "B Ltd"), (3, " ", "C Inc."), (4, "x", None)],
                               "id INT, status STRING, name STRING")
    out = {r["check_id"]: r for r in validate({"acct": df}, c.checks).collect()}
    assert out["acct:status:missing_values"]["unexpected_count"] == 2 and out["acct:status:missing_values"]["success"] is False
    assert out["acct:name:ends_with"]["unexpected_count"] == 1
    assert out["acct:id:unique"]["success"] is True
    with pytest.raises(ValueError):
        load_contract({"models": {}})
    with pytest.raises(ValueError):
        load_contract({"models": "x"})


def test_contract_sources(spark):
    from probity.sources.tables import jdbc_url, read_contract_tables

    c = load_contract(DIALECT_MODEL)
    assert jdbc_url({"type": "mysql", "host": "db", "port": 3306, "database": "garden"}) == "jdbc:mysql://db:3306/garden"
    t = read_contract_tables(spark, load_contract({"models": {"orders": {}, "lineitem": {}}}), base="/root/testdata/sf0.001")
    assert set(t) == {"orders", "lineitem"} and t["orders"].count() == 1500
    assert c.tables == ["families", "crops", "visits"]


def test_command_line(spark, tmp_path, capsys):
    import json

    import yaml

    from __spark_entry__ import FLAGSHIP_CONTRACT
    from probity.__main__ import main

    path = tmp_path / "c.yaml"
    path.write_text(yaml.safe_dump(FLAGSHIP_CONTRACT))
    rc = main(["run", "--contract", str(path), "--source", "/root/testdata/sf0.001", "--out", str(tmp_path / "o"),
               "--dataset", "tpch", "--run-id", "r9"])
    line = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 1 and line["statuses"]["FAIL"] > 0 and line["statuses"]["PASS"] > 0


def test_parse_strings_as_datetimes(spark):
    df = spark.createDataFrame([(1, "2024-01-02 00:00:00"), (2, "2024-01-01 00:00:00"), (3, "x")], "o INT, s STRING")
    c = Check("t", "column_values_to_be_increasing", "s", {"order_by": "o", "parse_strings_as_datetimes": True})
    r = validate({"t": df}, [c]).collect()[0]
    assert r["unexpected_count"] == 1 and r["missing_count"] == 1


def test_load_concatenated_suites(spark):
    from probity.contract import load_suites

    text = """
    {"name": "acct.0.1", "expectations": [
      {"type": "expect_table_columns_to_match_ordered_list", "kwargs": {"column_list": ["id", "name"]}, "meta": {}},
      {"type": "expect_column_values_to_be_of_type", "kwargs": {"column": "id", "type_": "integer"}, "meta": {}},
      {"type": "expect_column_values_to_be_unique", "kwargs": {"column": "name"}, "meta": {}}]}
    {"name": "plan.0.1", "expectations": [
      {"type": "expect_column_values_to_be_unique", "kwargs": {"column": "pid"}, "meta": {}}]}
    """
    checks = load_suites(text)
    assert [c.table for c in checks] == ["acct", "acct", "acct", "plan"]
    acct = spark.createDataFrame([(1, "a"), (2, "a")], "id INT, name STRING")
    plan = spark.createDataFrame([(1,), (2,)], "pid BIGINT")
    out = {r["check_id"]: r["success"] for r in validate({"acct": acct, "plan": plan}, checks).collect()}
    assert out == {"acct::table_columns_to_match_ordered_list": True, "acct:id:column_values_to_be_of_type": True,
                   "acct:name:unique": False, "plan:pid:unique": True}


def test_pii_masked_in_failing_rows(spark, tmp_path):
    from probity.plans.run import run_contract

    doc = {"models": {"customer": {"primaryKey": ["c_custkey"], "fields": {
        "c_custkey": {"type": "integer"},
        "c_name": {"type": "string", "pii": True, "pattern": "^Customer#00000000[0-4]$"}}}}}
    out = run_contract(spark, doc, "/root/testdata/sf0.001", str(tmp_path), "tpch", run_id="m1", mask_pii=True)
    rows = out["failing:customer"].collect()
    assert rows and all(len(r["c_name"]) == 64 and not r["c_name"].startswith("Customer#") for r in rows)


def test_more_text_rules(spark):
    from probity.contract import text_rule

    def k(sentence):
        chk, reason = text_rule("t", "x", sentence, ["t"], {})
        return (chk.kind, chk.params) if chk else reason

    assert k("x must be unique.")[0] == "column_values_to_be_unique"
    assert k("x must be between 1 and 5.") == ("column_values_to_be_between", {"min_value": 1.0, "max_value": 5.0})
    assert k("amount must be greater than 0.") == ("column_values_to_be_between", {"min_value": 0.0, "strict_min": True})
    assert k("x must be one of 'a', 'b' or 'c'.") == ("column_values_to_be_in_set", {"value_set": ["a", "b", "c"]})
    assert k("x must match pattern ^[A-Z]{3}$")[1] == {"regex": "^[A-Z]{3}$"}
    assert k("x must not be empty.")[0] == "row_condition"
    assert k("x should look fine.") == "text rule not understood"
    df = spark.createDataFrame([("ABC",), (" ",), ("abcd",), (None,)], "x STRING")
    checks = [text_rule("t", "x", s, ["t"], {})[0] for s in ("x must match pattern ^[A-Z]{3}$", "x must not be empty.")]
    out = {r["check_id"]: r["unexpected_count"] for r in validate({"t": df}, checks).collect()}
    assert out == {"t:x:text_regex": 2, "t:x:text_not_empty": 1}


def test_replay_equals_first_run_on_samples(spark, tmp_path):
    from __spark_entry__ import FLAGSHIP_CONTRACT
    from probity.plans.run import run_contract

    out = str(tmp_path / "o")
    first = run_contract(spark, FLAGSHIP_CONTRACT, "/root/testdata/sf0.001", out, "tpch", run_id="s1", keep_sample=200,
                         validate_sample=True, with_profile=False)
    a = sorted(tuple(r) for r in first["results"].collect())
    again = run_contract(spark, FLAGSHIP_CONTRACT, "/root/testdata/sf0.001", out, "tpch", run_id="s1", replay_run=True,
                         with_profile=False)
    assert a == sorted(tuple(r) for r in again["results"].collect())


def test_thresholds_of_a_contract(spark):
    quality = [{"type": "library", "metric": "nullValues", "threshold": t} for t in (">70%", "<20%")]
    c = load_contract({"models": {"bed": {"fields": {"tag": {"type": "string", "quality": quality}}}}})
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "tag STRING")
    assert [r["success"] for r in validate({"bed": df}, c.checks).orderBy("check_id").collect() if "null_values" in r["check_id"]] == [True, False]


def test_run_with_suite_suggestions_and_retention(spark, tmp_path):
    from probity.contract import dump_suites, load_suites
    from probity.plans.run import run_contract

    doc = {"models": {"orders": {"fields": {"o_orderkey": {"type": "integer", "unique": True}, "o_orderstatus": {"type": "string", "enum": ["F", "O"]}}},
                      "nowhere": {"fields": {"x": {"type": "integer", "required": True}}}},
           "servicelevels": {"freshness": {"threshold": "9999d", "timestampField": "orders.o_orderdate"}, "retention": {"period": "3 years"}}}
    c = load_contract(doc, as_of="2000-01-01 00:00:00")
    old = load_suites(dump_suites([k for k in c.checks if k.table == "orders" and k.kind != "freshness"]))
    assert [(k.kind, k.columns, k.check_id) for k in old] == [(k.kind, k.columns, k.check_id) for k in c.checks if k.table == "orders" and k.kind != "freshness"]
    out = run_contract(spark, c, "/root/testdata/sf0.001", str(tmp_path), "garden", run_id="r", suite=old, suggest=True, as_of="2000-01-01 00:00:00")
    assert {r["change"] for r in out["suite_change"].collect() if r["check_id"] in {k.check_id for k in old}} == {"unchanged"}
    assert out["proposals"].count() > 0
    overall = [r for r in out["summary"].collect() if r.asDict().get("table_name") is None]
    assert len(overall) == 1 and overall[0]["success"] is False
    kept = out["retention"].collect()[0]
    assert kept["expired_rows"] + kept["kept_rows"] == 1500 and kept["table_name"] == "orders"


def test_a_contract_reads_its_database_by_ranges(monkeypatch):
    from types import SimpleNamespace

    from probity.sources import tables

    calls = []
    monkeypatch.setattr(tables, "read_jdbc_partitioned", lambda *a: calls.append(a[1:]) or "split")
    monkeypatch.setattr(tables, "read_jdbc", lambda *a: calls.append(a[1:]) or "whole")
    contract = SimpleNamespace(raw={"servers": {"mysql": {"host": "h", "port": 1, "database": "garden", "username": "u"}}},
                               tables=["beds", "notes"], primary_keys={"beds": ["bed_id"]})
    assert tables.read_contract_tables(None, contract, num_partitions=6) == {"beds": "split", "notes": "whole"}
    assert calls == [("jdbc:mysql://h:1/garden", "beds", "bed_id", 6, {"user": "u"}), ("jdbc:mysql://h:1/garden", "notes", {"user": "u"})]
    monkeypatch.setattr(tables, "read_jdbc_split", lambda *a: calls.append(a[1:]) or "ranges")
    contract.primary_keys["notes"] = ["bed_id", "day"]
    assert tables.read_contract_tables(None, contract, num_partitions=6)["notes"] == "ranges"
    assert calls[-1] == ("jdbc:mysql://h:1/garden", "notes", ["bed_id", "day"], 6, {"user": "u"})


@pytest.mark.parametrize("said,want", [("7 years", (84, 0)), ("6 months", (6, 0)), ("2 weeks", (0, 14)), ("90d", (0, 90)), ("P1Y6M", (18, 0)), ("P2W", (0, 14)), ("P", None), ("soon", None), (None, None), ("3 fortnights", None)])
def test_periods(said, want):
    from probity.functions.masking import parse_period

    assert parse_period(said) == want


def test_retention_that_cannot_be_counted_says_why(spark):
    from types import SimpleNamespace

    from probity.functions.masking import retention_counts

    t = {"t": spark.sql("SELECT timestamp '2020-01-01 00:00:00' AS ts UNION ALL SELECT timestamp '2024-01-01 00:00:00'")}
    c = lambda period, field="t.ts": SimpleNamespace(retention=period, raw={"servicelevels": {"retention": {"timestampField": field}}})
    said = lambda *a: retention_counts(t, *a).first().asDict()
    assert said(c("18 months"), "2024-06-01 00:00:00")["expired_rows"] == 1
    assert said(c("soon"), "2024-06-01")["reason"] == "no calendar period: soon"
    assert said(c("1 year"), None)["status"] == "SKIPPED"
    assert said(c("1 year", "t.gone"), "2024-06-01")["reason"] == "no such field: t.gone"
    assert retention_counts(t, c(None), "2024-06-01") is None


@pytest.mark.parametrize("wanted,held,other", [("int unsigned", "int", "string"), ("INT(11) UNSIGNED", "bigint", "double"), ("mediumtext", "string", "int"), ("varbinary(45)", "binary", "string"), ("tinyint(1)", "boolean", "string"), ("tinyint(1)", "tinyint", "string"), ("varchar(20) character set utf8", "string", "int"), ("double precision", "double", "int"), ("decimal(10,2)", "decimal(10,2)", "decimal(12,2)")])
def test_type_names_of_databases(wanted, held, other):
    from pyspark.sql.types import _parse_datatype_string

    from probity.operators.schema import type_matches

    dt = lambda s: _parse_datatype_string(f"x {s}").fields[0].dataType
    assert type_matches(dt(held), wanted) and not type_matches(dt(other), wanted)
