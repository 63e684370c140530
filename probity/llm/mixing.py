"""Mixing sources to target weights by weighted fair queueing. DataFrame operations only.

Every source gets a share of a total budget of words by its weight. Its documents, shuffled by a hash, queue behind
each other, pass after pass; a copy's virtual finish time is the number of its source's words up to it, over the
source's target. All copies are range-sorted by finish time and cut where the budget is spent.

A hot source costs nothing extra: its running sums are taken in ``SLICES`` hash slices, whose totals are added up first.

Defined results: a null text has no words; a null source is a source of its own, after all others; empty documents
take no words; rows that are equal in doc_id, source and text share one decision; an empty table gives an empty
table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.llm.common import cut, partitions, row_key, row_key_sql, running, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
SEED = "mix"
#: Hex digits of the hash that name a slice of a source: 4096 slices.
SLICE_DIGITS = 3


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size) -> and target: the budget shared by weight, none above ``passes`` times its source, the
    excess shared anew by weight until none is above."""
    ranked = running(
        sources.withColumns({"_null": F.col("source").isNull().cast("int"), "_one": F.lit(1).cast("long")}),
        ["_null", "source"],
        {"_rank": "_one"},
    )
    weight = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = cut(ranked.select("source", "source_size", weight.alias("_w"), (F.lit(float(passes)) * F.col("source_size")).alias("_cap")))
    first = src.agg(F.sum("source_size").alias("n"), F.sum("_w").alias("w")).first()
    budget, rest, w, capped = share * (first["n"] or 0), share * (first["n"] or 0), first["w"] or 1.0, -1
    while True:
        full = F.col("_cap") < F.lit(rest) * F.col("_w") / F.lit(w)
        r = src.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)).alias("c"),
            F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0.0)).alias("w"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if r["n"] == capped or not r["w"]:
            break
        rest, w, capped = budget - r["c"], r["w"], r["n"]
    return src.select("source", "source_size", F.when(full, F.col("_cap")).otherwise(F.lit(rest) * F.col("_w") / F.lit(w)).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, row_key."""
    spark = docs.sparkSession
    narrow = cut(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), row_key(F.col("doc_id"), F.col("source"), F.col("text"), seed).alias("row_key")
        ).withColumn("_slice", F.substring("row_key", 1, SLICE_DIGITS))
    )
    slices = cut(narrow.groupBy("source", "_slice").agg(F.sum("size").alias("_n")))
    goal = targets(slices.groupBy("source").agg(F.sum("_n").alias("source_size")), weights, share, passes)
    before = F.sum("_n").over(Window.partitionBy("source").orderBy("_slice")) - F.col("_n")
    place = slices.withColumn("_before", before).alias("a").join(goal.alias("b"), F.expr("a.source <=> b.source"))
    place = place.selectExpr("a.source AS _source", "a._slice AS _place", "_before", "source_size", "target")
    queued = narrow.join(place, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_place")))
    done = F.sum("size").over(Window.partitionBy("source", "_slice").orderBy("row_key")) + F.col("_before")
    queued = cut(queued.withColumn("_done", done).select("doc_id", "source", "size", "row_key", "source_size", "target", "_done"))

    def finish(n):
        return F.when(F.col("target") > 0, (F.lit(n) * F.col("source_size") + F.col("_done")).cast("double") / F.col("target")).otherwise(F.lit(0.0))

    copies = queued.select("size", "row_key", F.explode(F.array(*(finish(n) for n in range(passes)))).alias("_finish"))
    ordered = cut(copies.repartitionByRange(partitions(spark), "_finish", "row_key").withColumn("_part", F.spark_partition_id()))
    budget = share * (queued.agg(F.sum("size")).first()[0] or 0)
    spent, edge = 0, None
    for p, n in sorted(ordered.groupBy("_part").agg(F.sum("size")).collect()):  # a total for each partition
        if spent + n > budget:
            edge = p
            break
        spent += n
    key = F.struct("_finish", "row_key")
    if edge is None:
        taken = F.lit(passes)
    else:
        run = F.sum("size").over(Window.partitionBy("_part").orderBy("_finish", "row_key"))
        inside = ordered.filter(F.col("_part") == edge).withColumn("_run", run).filter(F.col("_run") <= budget - spent)
        last = inside.agg(F.max(key).alias("k")).first()["k"] or ordered.filter(F.col("_part") < edge).agg(F.max(key).alias("k")).first()["k"]
        if last is None:
            taken = F.lit(0)
        else:
            at, name = F.lit(last["_finish"]), F.lit(last["row_key"])
            taken = sum(((finish(n) < at) | ((finish(n) == at) & (F.col("row_key") <= name))).cast("int") for n in range(passes))
    out = queued.withColumn("copies", taken.cast("int"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "row_key")


def mixed(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: each document as often as the queue takes it, with the columns of ``docs``."""
    seed = params.get("seed", SEED)
    plan = mix(docs, **params).filter("copies > 0").groupBy("row_key").agg(F.max("copies").alias("n"))
    plan = cut(plan.withColumnRenamed("row_key", "_key"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), row_key(F.col("doc_id"), F.col("source"), F.col("text"), seed).alias("_mine"))
    both = rows.join(plan, F.col("_mine") == F.col("_key")).select("_row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_copy"))
    return both.select("_row.*")


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, {row_key_sql(SEED)} AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
      2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS b FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
      sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM w),
f AS (SELECT *, cap < (b - c) * w / ws AS capped FROM o),
g AS (SELECT *, coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS cc, sum(CASE WHEN NOT capped THEN w END) OVER () AS cw FROM f),
t AS (SELECT source, source_size, b, CASE WHEN capped THEN cap ELSE (b - cc) * w / cw END AS target FROM g),
q AS (SELECT d.*, t.source_size, t.target, t.b, sum(size) OVER (PARTITION BY d.source ORDER BY k) AS done FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT q.*, n, CASE WHEN target > 0 THEN (n * source_size + done)::DOUBLE / target ELSE 0 END AS finish FROM q, (VALUES (0), (1)) v(n)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, k) <= b AS taken_in FROM e)
SELECT doc_id, size, source_size, target::DOUBLE AS target, (size * sum(taken_in::INT))::BIGINT AS taken, sum(taken_in::INT)::INT AS copies
FROM r GROUP BY doc_id, size, source_size, target, k
"""
