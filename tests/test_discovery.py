"""Keys, references and types proposed by the data, against brute force on small frames."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from probity.operators import discovery as D
from probity.plans.report import suggest_checks, suggestions_to_checks


def tables(spark, seed):
    rnd = random.Random(seed)
    a = [(i, rnd.choice([None, "x", "y", "long " * 30]), rnd.choice([None, 1, 2, 3])) for i in range(rnd.randint(0, 12))]
    b = [(rnd.randint(0, 6), rnd.choice(["x", "y", "long " * 30]), None) for _ in range(rnd.randint(1, 30))]
    return {"a": spark.createDataFrame(a, "id int, t string, n long"), "b": spark.createDataFrame(b, "ref long, t string, none int")}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bits", [62, 2])
def test_inclusions(spark, seed, bits, monkeypatch):
    monkeypatch.setattr(D, "MASK_BITS", bits)
    ts = tables(spark, seed)
    values = {}
    for t, df in ts.items():
        for c in df.columns:
            values[t, c] = ("t" if c == "t" else "i", {r[0] for r in df.select(c).collect() if r[0] is not None})
    want = {(*x, *y, len(values[x][1]), len(values[y][1]), len(values[x][1])) for x, y in itertools.permutations(values, 2) if values[x][0] == values[y][0] and values[x][1] and values[x][1] <= values[y][1]}
    assert {tuple(r) for r in D.inclusions(ts).collect()} == want


def test_foreign_keys_and_suggested_checks(spark):
    parent = spark.range(10).select(F.col("id").alias("k"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("seen"))
    child = spark.range(3000).select((F.col("id") % 8).alias("ref"), F.when(F.col("id") % 3 > 0, F.lit(5)).alias("hot"), F.col("id").alias("own"))
    ts = {"parent": parent, "child": child}
    assert [tuple(r) for r in D.foreign_keys(ts).collect()] == [("child", "ref", "parent", "k", 0.8)]
    assert ("parent", "k", "child", "own") not in {tuple(r)[:4] for r in D.foreign_keys(ts, 0).collect()}
    assert ("parent", "k", "child", "own") in {tuple(r)[:4] for r in D.foreign_keys(ts, 0, one_to_one=True).collect()}
    from probity.operators.profile import profile

    prof = profile(child, "child").unionByName(profile(parent, "parent"))
    found = suggest_checks(ts, prof, references=D.foreign_keys(ts), as_of="2024-01-02 00:00:30")
    by_kind = {(r["table_name"], r["kind"]): r for r in found.collect()}
    assert json.loads(by_kind["child", "foreign_key"]["value_set"]) == {"parent_table": "parent", "parent_columns": ["k"]}
    assert by_kind["parent", "freshness"]["max_value"] == 1440
    from probity.plans.compile import validate

    checks = [c for c in suggestions_to_checks(found) if c.kind in ("foreign_key", "freshness")]
    assert {r["check_id"]: r["success"] for r in validate(ts, checks, spark=spark).collect()} == {c.check_id: True for c in checks}


def brute_keys(rows, columns, max_size):
    found = []
    for size in range(1, max_size + 1):
        for c in itertools.combinations(columns, size):
            at = [columns.index(x) for x in c]
            part = [tuple(r[i] for i in at) for r in rows]
            if rows and not any(set(k) <= set(c) for k in found) and len(set(part)) == len(rows) and not any(x is None for p in part for x in p):
                found.append(c)
    return found


@pytest.mark.parametrize("seed", range(5))
def test_candidate_keys(spark, seed):
    rnd = random.Random(seed)
    columns = ["a", "b", "c", "d"]
    rows = list({(rnd.randint(0, 5), rnd.randint(0, 5), rnd.randint(0, 3), rnd.choice([None, 1, 2]) if seed % 2 else 7) for _ in range(40)})
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    assert D.candidate_keys(df, columns, 3) == brute_keys(rows, columns, 3)
    assert D.candidate_keys(df.limit(0), columns) == []


def test_infer_types(spark):
    rows = [("1", "1.5", "2024-01-01", "x", None, "1", ""), ("-7", "2e3", "2024-01-01 10:00:00.5", "2", None, "9" * 19, "5"), (None, ".5", None, None, None, "2024-01-01", None)]
    df = spark.createDataFrame(rows, "i string, n string, t string, s string, v string, mixed string, blank string")
    kinds = {r["column"]: r["inferred_type"] for r in D.infer_types(df).collect()}
    assert kinds == {"i": "bigint", "n": "double", "t": "timestamp", "s": "string", "v": "void", "mixed": "string", "blank": "string"}
    out = D.conform_inferred(df)
    assert dict(out.dtypes) == {"i": "bigint", "n": "double", "t": "timestamp", "s": "string", "v": "string", "mixed": "string", "blank": "string"}
    assert [r["i"] for r in out.collect()] == [1, -7, None]
    # counts of the parts of a table add up
    whole = D.infer_types(df).drop("inferred_type")
    halves = D.infer_types(df.limit(1)).unionByName(D.infer_types(df.subtract(df.limit(1)))).groupBy("column").agg(*(F.sum(c).alias(c) for c in ("non_null", "n_int", "n_number", "n_time")))
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in halves.collect()}
    assert {r["column"]: r["inferred_type"] for r in D.with_type(halves).collect()} == kinds
