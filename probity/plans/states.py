"""Re-validation of grown tables: a stored state per file, merged with the state of new files only.

A check whose aggregates add up over any parts of a table (row checks, row counts,
non-null shares, min, max, sum and mean of numeric columns) needs no second look at
rows that were counted before.  ``validate_grown`` keeps one small row per file,
check and aggregate; a run scans only files that it has no state of (by path,
time and size: a file that was replaced counts as new), appends theirs, and merges the states of the
files that the table has now, so files that were removed no longer count.  States are
named by a digest of the check: a changed check is computed for all files, the others are not.

Sums, minima and maxima are kept as doubles, so integers beyond 2^53 compare as doubles here.
An empty table gives the same results as ``validate`` gives on one.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from probity.checks import Check
from probity.operators.aggregates import AGG_RULES
from probity.operators.rowlevel import ROW_RULES, with_verdicts
from probity.plans.compile import MAX_AGGS, _melt, finish

STATE_DDL = "part STRING, check_key STRING, name STRING, n BIGINT, v DOUBLE"

#: How the observed value of a column aggregate merges.
OBSERVED = {
    "column_max_to_be_between": F.max,
    "column_min_to_be_between": F.min,
    "column_sum_to_be_between": F.sum,
    "column_mean_to_be_between": F.sum,  # of the values: divided by their number at the end
}
COUNTED = {"table_row_count_to_be_between", "table_row_count_to_equal", "column_proportion_of_non_null_values_to_be_between"}


def mergeable(chk: Check) -> bool:
    """Whether the check's aggregates add up over parts (z-scores depend on all rows at once)."""
    return (chk.kind in ROW_RULES and chk.kind != "column_value_z_scores_to_be_less_than") or chk.kind in OBSERVED or chk.kind in COUNTED


def check_key(chk: Check) -> str:
    """Equal for equal checks only: kind, columns and parameters (thresholds apply to the merged state)."""
    text = json.dumps([chk.kind, list(chk.columns), chk.params], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def _measure(chk: Check, df: DataFrame):
    if chk.kind in ROW_RULES:
        return ROW_RULES[chk.kind](chk, df).to_measure()
    return AGG_RULES[chk.kind](chk, df, {})


def _aggregates(chk: Check, df: DataFrame) -> dict[str, Column]:
    aggs = dict(_measure(chk, df).aggs)
    if chk.kind in OBSERVED:
        if not isinstance(df.schema[chk.column].dataType, T.NumericType):
            raise ValueError(f"{chk.check_id}: {chk.column} is not numeric; its state is not kept")
        aggs["obs"] = OBSERVED[chk.kind](df[chk.column].cast("double"))
    return aggs


def part_states(df: DataFrame, checks: list[Check], part: Column) -> DataFrame:
    """(part, check_key, name, n or v): one pass and one small group per part, in blocks of ``MAX_AGGS`` aggregates."""
    odd = [c.check_id for c in checks if not mergeable(c)]
    if odd:
        raise ValueError(f"states of these checks do not add up over parts: {odd}")
    name = "__part"
    while name in df.columns:
        name += "_"
    # a part's name is a fact of the file, so it is read before other columns are derived
    judged = with_verdicts(df.withColumn(name, part), checks)
    wanted = [(check_key(c), agg, how) for c in {check_key(c): c for c in checks}.values() for agg, how in _aggregates(c, judged).items()]
    out = df.sparkSession.createDataFrame([], STATE_DDL)
    for at in range(0, len(wanted), MAX_AGGS):
        block = wanted[at : at + MAX_AGGS]
        per = judged.groupBy(F.col(name)).agg(*[how.alias(f"a{i}") for i, (_, _, how) in enumerate(block)])
        states = [
            F.struct(F.lit(key).alias("check_key"), F.lit(agg).alias("name"),
                     (F.lit(None).cast("long") if agg == "obs" else F.col(f"a{i}").cast("long")).alias("n"),
                     (F.col(f"a{i}").cast("double") if agg == "obs" else F.lit(None).cast("double")).alias("v"))
            for i, (key, agg, _) in enumerate(block)
        ]
        out = out.unionByName(per.select(F.col(name).alias("part"), F.explode(F.array(*states)).alias("s")).select("part", "s.*"))
    return out


def merged_results(states: DataFrame, checks: list[Check], like: DataFrame) -> DataFrame:
    """One result row per check, as ``validate`` gives on all parts together (``like``: a frame of the table's schema).

    A state that was stored twice counts once.  What is collected into the one row is as long as the suite."""
    once = states.groupBy("part", "check_key", "name").agg(F.max("n").alias("n"), F.max("v").alias("v"))
    merged = once.groupBy("check_key", "name").agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("v").alias("total"))
    entry = F.struct(F.concat_ws("/", "check_key", "name").alias("k"), F.struct("n", "lo", "hi", "total").alias("s"))
    one = merged.agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    judged = with_verdicts(like, checks)
    structs = []
    for chk in checks:
        held = {F.max: "hi", F.min: "lo", F.sum: "total"}.get(OBSERVED.get(chk.kind))

        def got(name, chk=chk, held=held):
            state = F.col("m")[f"{check_key(chk)}/{name}"]
            if name != "obs":
                return F.coalesce(state["n"], F.lit(0).cast("long"))
            if chk.kind == "column_mean_to_be_between":
                return F.try_divide(state["total"], got("n") - got("miss"))
            return state[held]

        structs.append(finish(chk, dict(_measure(chk, judged).result(got))))
    return _melt(one, structs)


def _file() -> Column:
    fields = ("file_path", "file_modification_time", "file_size")
    return F.concat_ws("|", *[F.col(f"_metadata.{f}").cast("string") for f in fields])


def _stored(spark: SparkSession, state_path: str) -> DataFrame:
    try:
        return spark.read.schema(STATE_DDL).parquet(state_path)
    except AnalysisException:  # no state yet
        return spark.createDataFrame([], STATE_DDL)


def validate_grown(spark: SparkSession, table_path: str, state_path: str, checks: list[Check]) -> DataFrame:
    """Results of ``checks`` over all files of ``table_path``, scanning only files without a state under ``state_path``.

    What the driver sees is one name per file, as Spark's own file listing holds."""
    table = spark.read.parquet(table_path)
    now = table.select(_file().alias("part"), F.col("_metadata.file_path").alias("path")).distinct()
    keys = sorted({check_key(c) for c in checks})
    known = (
        _stored(spark, state_path).where(F.col("check_key").isin(keys)).groupBy("part", "check_key").count()
        .join(F.broadcast(spark.createDataFrame([(k,) for k in keys], "check_key STRING")), "check_key", "right")
        .groupBy("part").agg(F.collect_set("check_key").alias("have")) if keys else None
    )
    missing: dict[tuple, list[str]] = {}  # check keys a file lacks -> its paths
    have = now if known is None else now.join(known, "part", "left")
    for row in have.collect():
        lacks = tuple(k for k in keys if k not in (row["have"] or ()))
        if lacks:
            missing.setdefault(lacks, []).append(row["path"])
    for lacks, paths in missing.items():
        new = table.where(F.col("_metadata.file_path").isin(paths))
        part_states(new, [c for c in checks if check_key(c) in lacks], _file()).write.mode("append").parquet(state_path)
    states = _stored(spark, state_path).join(now.select("part"), "part", "left_semi")
    return merged_results(states, checks, table)
