"""Table profile (P1-P4, P6-P9): one long row per column.

Passes over the table, all aggregates (nothing unbounded reaches the driver;
only one value per column does):

1. one fused aggregate: row count, per column non-null count, min / max of
   numeric columns, and -- with ``exact=False`` -- HyperLogLog distinct
   counts (``approx_count_distinct``);
2. exact distinct counts (``exact=True``): whole numbers and dates (all types
   together) as bits of 64-bit words, so up to 64 neighbouring values are one row
   of the shuffle; other columns by type.  At most 16 columns
   share one pass -- ``explode`` of (column index, word or value), ``groupBy`` on the
   pair with map-side combining, then a count per column; all passes run in
   one union;
3. p01 / p99 of integer and floating columns, with the reference's rank
   rule: on the ``n`` sorted non-null values, 0-based ``i01 = max(0,
   floor(n*0.01) - 1)`` and ``i99 = min(n-1, floor(n*0.99))``, the value is an
   element (no interpolation).  Exact values come from the radix selection of
   ``operators.quantiles``; with ``exact=False`` it is ``percentile_approx`` alone.

``null_rate`` = nulls / rows and ``distinct_ratio`` = distinct non-null /
rows (all rows, as the reference divides); both are null on an empty table.
``dup_rate`` = 1 - distinct / non-null; ``oov_rate`` (with a vocabulary) =
non-null values outside it / non-null; ``tail_ratio`` = max / p99.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions.predicates import coerce_members, in_set
from probity.operators.keys import is_whole, word_and_bit

BLOCK = 25  # columns per first-pass aggregate: up to 6 aggregates each stays within codegen limits
TYPE_GROUP = 16  # columns per distinct-count pass (rows are expanded this many times at most)

PROFILE_DDL = (
    "table_name STRING, column_name STRING, data_type STRING, row_count BIGINT, null_count BIGINT, "
    "null_rate DOUBLE, distinct_count BIGINT, distinct_ratio DOUBLE, dup_rate DOUBLE, "
    "p01 DOUBLE, p99 DOUBLE, min_value DOUBLE, max_value DOUBLE, tail_ratio DOUBLE, oov_rate DOUBLE"
)


def _quantile_numeric(dt: T.DataType) -> bool:
    """Integer and floating columns only (decimals, dates, strings have no p01/p99)."""
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType))


def rank_indices(n: int) -> tuple[int, int]:
    """0-based indices of p01 and p99 among ``n`` sorted values."""
    return max(0, int(n * 0.01) - 1), min(n - 1, int(n * 0.99))


def profile(
    df: DataFrame,
    table: str,
    columns: list[str] | None = None,
    exact: bool = True,
    vocabularies: dict[str, list] | None = None,
    accuracy: int = 10000,
    stats: set[str] | None = None,
) -> DataFrame:
    """``stats``: the wanted columns of ``PROFILE_DDL``.  Only their passes run; what no pass has counted is null."""
    spark = df.sparkSession
    wants = lambda *names: stats is None or not stats.isdisjoint(names)
    distinct, ranks = wants("distinct_count", "distinct_ratio", "dup_rate"), wants("p01", "p99", "tail_ratio")
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in cols if _quantile_numeric(types[c])]
    vocab = vocabularies or {}

    # ---- pass 2 (exact distinct counts) depends on nothing: it starts at once and
    # runs side by side with pass 1 and the quantile passes
    from concurrent.futures import ThreadPoolExecutor

    pool = ThreadPoolExecutor(max_workers=1)
    f_ndv = pool.submit(_exact_distincts, df, cols, types) if exact and distinct else None

    # ---- pass 1 (blocks of BLOCK columns keep each aggregate operator small)
    first: dict = {}
    for b0 in range(0, max(1, len(cols)), BLOCK):
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i in range(b0, min(len(cols), b0 + BLOCK)):
            c = cols[i]
            aggs.append(F.count(F.col(c)).alias(f"nn{i}"))
            if not exact and distinct:
                aggs.append(F.approx_count_distinct(F.col(c)).alias(f"nd{i}"))
            if c in vocab:
                aggs.append(F.count_if(F.col(c).isNotNull() & ~in_set(F.col(c), coerce_members(vocab[c], types[c])[0])).alias(f"oov{i}"))
            if c in numeric and (ranks or wants("min_value", "max_value")):
                aggs.append(F.min(F.col(c)).cast("double").alias(f"mn{i}"))
                aggs.append(F.max(F.col(c)).cast("double").alias(f"mx{i}"))
        first.update(df.agg(*aggs).first().asDict())
    n = first["__n"]

    # ---- pass 3 (needs the counts and ranges of pass 1)
    def quantiles() -> dict[str, float]:
        q: dict[str, float] = {}
        quant_cols = [(i, c) for i, c in enumerate(cols) if c in numeric and first[f"nn{i}"]]
        if exact:
            from probity.operators.quantiles import PROFILE, select_ranks

            known = {c: first[f"nn{i}"] for i, c in quant_cols}
            got = select_ranks(df, [(c, *PROFILE) for _, c in quant_cols], n_known=known)
            for (i, _), (_, vals) in zip(quant_cols, got):
                q[f"a{i}"], q[f"b{i}"] = (float(v) if v is not None else None for v in vals)
        elif quant_cols:
            qaggs = []
            for i, c in quant_cols:
                nn = first[f"nn{i}"]
                lo, hi = rank_indices(nn)
                qaggs.append(F.percentile_approx(F.col(c), F.lit((lo + 0.5) / nn), accuracy).cast("double").alias(f"a{i}"))
                qaggs.append(F.percentile_approx(F.col(c), F.lit((hi + 0.5) / nn), accuracy).cast("double").alias(f"b{i}"))
            q = df.agg(*qaggs).first().asDict()
        return q

    q = quantiles() if ranks else {}
    ndv = f_ndv.result() if f_ndv is not None else {i: first.get(f"nd{i}") for i in range(len(cols))}
    pool.shutdown()

    rows = []
    for i, c in enumerate(cols):
        nn = first[f"nn{i}"]
        nulls = n - nn
        d = ndv.get(i)
        p01, p99 = q.get(f"a{i}"), q.get(f"b{i}")
        mx = first.get(f"mx{i}")
        oov = first.get(f"oov{i}")
        rows.append(
            (
                table,
                c,
                types[c].simpleString(),
                n,
                nulls,
                (nulls / n) if n else None,
                d,
                (d / n) if (n and d is not None) else None,
                (1.0 - d / nn) if (nn and d is not None) else None,
                p01,
                p99,
                first.get(f"mn{i}"),
                mx,
                (mx / p99) if (mx is not None and p99 not in (None, 0.0) and not math.isnan(p99)) else None,
                (oov / nn) if (oov is not None and nn) else None,
            )
        )
    return spark.createDataFrame(rows, PROFILE_DDL)


#: Bytes of a text or binary that stands for itself in a distinct count.
SHORT = 40


def _named(c: Column, dtype: T.DataType) -> Column:
    """A value, or for long texts and binaries a name of it: equal for equal values only."""
    if not isinstance(dtype, (T.StringType, T.BinaryType)):
        return c
    raw = c.cast("binary")
    return F.when(F.octet_length(c) <= SHORT, F.concat(F.lit(b"v"), raw)).otherwise(F.concat(F.lit(b"h"), F.unhex(F.md5(raw))))


def _exact_distincts(df: DataFrame, cols: list[str], types: dict) -> dict[int, int]:
    """Distinct non-null values per column.  Columns of one type share a pass:
    (column index, value) pairs from one explode, one groupBy on the pair
    (map-side combined), then a count per column.  Same shuffle volume as one
    groupBy per column, far fewer scans and stages; values keep their own type
    (float normalisation).  Long texts and binaries are told apart by their
    MD5 (128 bits), so that they are not shuffled whole."""
    groups: dict[str, list[tuple[int, str]]] = {}
    for i, c in enumerate(cols):
        groups.setdefault("" if is_whole(types[c]) else types[c].simpleString(), []).append((i, c))
    parts = []
    for kind, members in groups.items():
        for g0 in range(0, len(members), TYPE_GROUP):
            chunk = members[g0 : g0 + TYPE_GROUP]
            if not kind:
                bits = []
                for i, c in chunk:
                    word, bit = word_and_bit(F.col(c), types[c])
                    bits.append(F.struct(F.lit(i).alias("i"), word.alias("v"), bit.alias("b")))
                words = df.select(F.explode(F.array(*bits)).alias("e")).select("e.*").where(F.col("v").isNotNull())
                parts.append(words.groupBy("i", "v").agg(F.bit_or("b").alias("b")).groupBy("i").agg(F.sum(F.bit_count("b")).cast("long").alias("d")))
                continue
            pairs = df.select(F.explode(F.array(*[
                F.struct(F.lit(i).alias("i"), _named(F.col(c), types[c]).alias("v")) for i, c in chunk
            ])).alias("e")).select("e.i", "e.v").where(F.col("v").isNotNull())
            parts.append(pairs.groupBy("i", "v").agg(F.count(F.lit(1)).alias("_")).groupBy("i").agg(F.count(F.lit(1)).alias("d")))
    if not parts:
        return {}
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return {i: 0 for i in range(len(cols))} | {r["i"]: r["d"] for r in u.collect()}


def profile_tables(tables: dict[str, DataFrame], exact: bool = True, threads: int = 8) -> DataFrame:
    """Profile every table of a contract.  The per-table passes are independent
    Spark jobs, submitted from a small thread pool so the scheduler runs them
    side by side (each job's result is one small row)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(tables)))) as pool:
        parts = list(pool.map(lambda kv: profile(kv[1], kv[0], exact=exact), tables.items()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness_minutes(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    """Whole minutes from the newest ``ts`` to ``as_of`` (a parameter, never now())."""
    dt = df.schema[ts].dataType.simpleString()
    return df.agg(F.timestamp_diff("MINUTE", F.max(ts), F.lit(as_of).cast(dt)).cast("long").alias("freshness_minutes"))

