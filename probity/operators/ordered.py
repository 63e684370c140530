"""Order-dependent checks: values increasing / decreasing along an order column.

A global ``Window.orderBy`` would pull the whole table into one task.  Instead:

1. ``repartitionByRange`` on (partition_by..., order_by, tie_breaker, value,
   row id): Spark samples the composite key, so buckets are balanced even
   when one order value (or one partition_by group, or one fully identical
   row) holds a third of the rows -- the trailing keys spread it over several
   buckets.  Rows equal up to the row id are interchangeable, so the row id
   changes no count (and a recomputed task may number them differently);
2. sort inside the range partitions and fold each into a run summary -- rows,
   rows not judged, breaks, first and last judged row -- batch by batch (Arrow),
   so there is no second exchange and no other read of the table; a pair counts
   only when both rows belong to the same ``partition_by`` group;
3. two summaries merge: add the counts, and judge the last row of one against
   the first of the next -- a ``lag`` over the table with one row per bucket.

Ties in the order column are broken by ``tie_breaker`` (default: the checked
column itself, ascending for increasing and descending for decreasing, i.e.
a tie is never a violation unless the values themselves are equal under
``strictly``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.checks import Check

# the fold travels with its code: executors need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _holds(cur: pa.Array, prev: pa.Array, increasing: bool, strictly: bool) -> pa.Array:
    """Whether each value may follow the one before it; NaN is equal to itself and above all numbers."""
    hi, lo = (cur, prev) if increasing else (prev, cur)
    above, same = pc.greater(hi, lo), pc.equal(hi, lo)
    if pa.types.is_floating(cur.type):
        above = pc.or_(above, pc.and_(pc.is_nan(hi), pc.invert(pc.is_nan(lo))))
        same = pc.or_(same, pc.and_(pc.is_nan(hi), pc.is_nan(lo)))
    return above if strictly else pc.or_(above, same)


def _run_summary(increasing: bool, strictly: bool):
    """Folds a sorted partition (judged, group, value) into one row."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = miss = breaks = 0
        first = last = None
        for b in batches:
            n += b.num_rows
            judged = b.filter(b.column("__ok"))
            miss += b.num_rows - judged.num_rows
            if not judged.num_rows:
                continue
            g, v = judged.column("__g"), judged.column("__v")
            if last is None:
                first = (g[:1], v[:1])
            else:
                g, v = pa.concat_arrays([last[0], g]), pa.concat_arrays([last[1], v])
            if len(v) > 1:
                inside = pc.equal(g[1:], g[:-1])
                breaks += pc.sum(pc.and_(inside, pc.invert(_holds(v[1:], v[:-1], increasing, strictly)))).as_py() or 0
            last = (g[-1:], v[-1:])
        if n:
            none = (pa.nulls(1, pa.string()), None)
            ends = [*(first or none), *(last or none)]
            counts = [pa.array([x], pa.int64()) for x in (n, miss, breaks)]
            ends = [x if x is not None else pa.nulls(1, b.schema.field("__v").type) for x in ends]
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), *counts, *ends], ["b", "n", "miss", "inner", "first_g", "first_v", "last_g", "last_v"])

    return fold


def ordered_counts(df: DataFrame, chk: Check, buckets: int | None = None) -> DataFrame:
    """One row (n, miss, bad) for an increasing / decreasing check."""
    col = chk.column
    order = chk.p("order_by")
    if not order:
        raise ValueError(f"{chk.check_id}: order_by is required (no row order exists in Spark)")
    parts = list(chk.p("partition_by") or [])
    increasing = chk.kind == "column_values_to_be_increasing"
    strictly = bool(chk.p("strictly", True))
    tie = chk.p("tie_breaker") or col
    spark = df.sparkSession
    n_buckets = buckets or int(chk.p("buckets") or spark.conf.get("spark.sql.shuffle.partitions"))

    v, o, t = "__v", "__o", "__t"
    pcols = [f"__p{i}" for i in range(len(parts))]
    value = F.col(col)
    if chk.p("parse_strings_as_datetimes"):
        # text timestamps compared as timestamps; an unparseable value counts as missing
        value = F.try_to_timestamp(value.cast("string"))
    base = df.select(
        value.alias(v), F.col(order).alias(o), F.col(tie).alias(t), *[F.col(p).alias(a) for p, a in zip(parts, pcols)]
    )
    # groups are compared as JSON, which tells null from every text
    base = base.withColumns({
        "__ok": F.col(v).isNotNull() & F.col(o).isNotNull(),
        "__g": F.to_json(F.struct(*pcols)) if pcols else F.lit(""),
        "__rid": F.monotonically_increasing_id(),
    })
    tie_sort = F.col(t).asc_nulls_first() if increasing else F.col(t).desc_nulls_last()
    val_sort = F.col(v).asc_nulls_first() if increasing else F.col(v).desc_nulls_last()
    # Rows equal in (partition, order, tie breaker, value) are interchangeable,
    # so a row-unique last key changes no count; it lets the range partitioner
    # split a run of such rows (a hot key, or the rows not judged) over several buckets.
    sort_keys = [F.col("__ok"), *[F.col(p) for p in pcols], F.col(o), tie_sort, val_sort, F.col("__rid")]
    ranged = base.repartitionByRange(n_buckets, *sort_keys).sortWithinPartitions(*sort_keys)
    kind = base.schema[v].dataType.simpleString()
    ddl = f"b int, n long, miss long, inner long, first_g string, first_v {kind}, last_g string, last_v {kind}"
    runs = ranged.select("__ok", "__g", v).mapInArrow(_run_summary(increasing, strictly), ddl)

    # Seams: the first row of a bucket against the last row of the previous
    # bucket that has judged rows (a window over the small bucket table).
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("last_g").isNotNull(), F.struct("last_g", "last_v")), ignorenulls=True).over(before)
    seams = runs.withColumn("__pl", last)
    cur, prev = F.col("first_v"), F.col("__pl.last_v")
    if increasing:
        ok = (cur > prev) if strictly else (cur >= prev)
    else:
        ok = (cur < prev) if strictly else (cur <= prev)
    seam = F.coalesce((F.col("first_g") == F.col("__pl.last_g")) & ~ok, F.lit(False))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return seams.agg(total("n").alias("n"), total("miss").alias("miss"), (total("inner") + F.count_if(seam)).cast("long").alias("bad"))


def ordered_violations(df: DataFrame, chk: Check, buckets: int | None = None) -> DataFrame:
    """The rows that break an increasing / decreasing check (each breaking row is
    the later row of its pair), with the table's own columns.  Same pipeline as
    ``ordered_counts``: range buckets, ``lag`` inside a bucket, and the seams
    from a table with one row per bucket."""
    col, order = chk.column, chk.p("order_by")
    if not order:
        raise ValueError(f"{chk.check_id}: order_by is required (no row order exists in Spark)")
    parts = list(chk.p("partition_by") or [])
    increasing = chk.kind == "column_values_to_be_increasing"
    strictly = bool(chk.p("strictly", True))
    tie = chk.p("tie_breaker") or col
    n_buckets = buckets or int(chk.p("buckets") or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(col)
    if chk.p("parse_strings_as_datetimes"):
        value = F.try_to_timestamp(value.cast("string"))
    v, o, t = "__v", "__o", "__t"
    pcols = [f"__p{i}" for i in range(len(parts))]
    base = df.select(value.alias(v), F.col(order).alias(o), F.col(tie).alias(t),
                     *[F.col(p).alias(a) for p, a in zip(parts, pcols)], F.struct(*df.columns).alias("__row"))
    judged = base.where(F.col(v).isNotNull() & F.col(o).isNotNull()).withColumn("__rid", F.monotonically_increasing_id())
    tie_sort = F.col(t).asc_nulls_first() if increasing else F.col(t).desc_nulls_last()
    val_sort = F.col(v).asc_nulls_first() if increasing else F.col(v).desc_nulls_last()
    sort_keys = [F.col(p) for p in pcols] + [F.col(o), tie_sort, val_sort, F.col("__rid")]

    def breaks(cur, prev):
        if increasing:
            ok = (cur > prev) if strictly else (cur >= prev)
        else:
            ok = (cur < prev) if strictly else (cur <= prev)
        return prev.isNotNull() & ~ok

    ranged = judged.repartitionByRange(n_buckets, *sort_keys).withColumn("__b", F.spark_partition_id())
    w = Window.partitionBy("__b").orderBy(*sort_keys)
    same = F.lit(True)
    for p in pcols:
        same = same & F.col(p).eqNullSafe(F.lag(p).over(w))
    marked = ranged.select("__b", *pcols, v, "__row", F.lag(v).over(w).alias("__prev"), same.alias("__same"),
                           (F.row_number().over(w) == 1).alias("__first"), F.lead(o).over(w).isNull().alias("__last"))
    inner = marked.where(F.col("__same") & breaks(F.col(v), F.col("__prev"))).select("__row")
    key = F.struct(*[F.col(p).alias(p) for p in pcols], F.col(v).alias(v))
    ends = marked.where(F.col("__first") | F.col("__last")).groupBy("__b").agg(
        F.max(F.when(F.col("__first"), F.struct(key.alias("k"), F.col("__row").alias("r")))).alias("first"),
        F.max(F.when(F.col("__last"), key)).alias("last"),
    )
    seams = ends.withColumn("__pl", F.lag("last").over(Window.orderBy("__b")))
    same_group = F.lit(True)
    for p in pcols:
        same_group = same_group & F.col(f"first.k.{p}").eqNullSafe(F.col(f"__pl.{p}"))
    seam_rows = seams.where(F.col("__pl").isNotNull() & same_group & breaks(F.col(f"first.k.{v}"), F.col(f"__pl.{v}")))
    return inner.unionByName(seam_rows.select(F.col("first.r").alias("__row"))).select("__row.*")
