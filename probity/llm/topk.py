"""Exact top-k inner products by distributed histogram selection.

Vectors become integers, floor(scale * x). Every query is scored against every vector, block against block, in each of
a few passes. A pass counts the scores of each query in bins; summed over the corpus, the counts tell which bin holds
its k-th best score, and the next pass divides that bin, until a bin is one score wide. The last pass keeps the scores
above the k-th, and of those equal to it the smallest ids.

A task hands on only the bins down to its own k-th best score (the k-th best of all cannot lie lower), so at most k
counts a query, and in the last pass at most k scores a query. Queries meet the corpus block by block: the queries are
a stated set, joined against all rows in blocks, in the cells of a grid whose sides follow the numbers of queries and
vectors. Nothing but these numbers passes through the driver.

Defined results: vectors that are null or hold null or non-finite components take no part; a query and a vector of
different lengths are not scored; an empty vector scores 0 with others; rows with one id are separate vectors, and a
query is scored against every row but its own (rows are told apart by ``row``, not by id); a null id takes no part; ties go to the smaller id; an
empty table gives an empty table; other columns, of any name, are not looked at. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probity.llm.common import cut, partitions
from probity.llm.vectors import usable

K = 5
SCALE = 256
BINS = 512
#: Vectors of a block.
QUERY_BLOCK, BLOCK = 512, 2048
#: Products of this size or less are summed exactly as doubles.
EXACT = 2.0**53


def whole(v: Column, scale: int) -> Column:
    return F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))


def _packed(rows: DataFrame, size: int, extra: list[str]) -> DataFrame:
    """(id, dim, ints, extra) -> blocks (dim, n, ids, ints, extra; bytes), within partitions."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(dim: int, rows: list[tuple]) -> pa.RecordBatch:
            ids = np.array([r[0] for r in rows], np.int64).tobytes()
            ints = np.array([r[1] for r in rows], np.float64).tobytes()
            rest = [[np.array([r[2 + i] for r in rows], np.int64).tobytes()] for i in range(len(extra))]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([len(rows)], pa.int32()), *(pa.array(x, pa.binary()) for x in ([ids], [ints], *rest))], ["dim", "n", "ids", "ints", *extra])

        held: dict[int, list[tuple]] = {}
        for b in batches:
            for row in zip(b.column("id").to_pylist(), b.column("ints"), *(b.column(c).to_pylist() for c in extra), strict=True):
                v = row[1].values.to_numpy()
                mine = held.setdefault(len(v), [])
                mine.append((row[0], v, *row[2:]))
                if len(mine) == size:
                    yield flush(len(v), held.pop(len(v)))
        for dim, mine in held.items():
            yield flush(dim, mine)

    return rows.mapInArrow(each, "dim int, n int, ids binary, ints binary, " + ", ".join(f"{c} binary" for c in extra) if extra else "dim int, n int, ids binary, ints binary")


def _scores(q: dict, c: dict) -> np.ndarray:
    """Scores of a block of queries (rows) and a block of vectors, as long; the query's own row far below all."""
    x, y = (np.frombuffer(z["ints"]).reshape(z["n"], z["dim"]) for z in (q, c))
    most = np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, x.shape[1])
    s = (x @ y.T).astype(np.int64) if most < EXACT else x.astype(np.int64) @ y.astype(np.int64).T
    s[np.frombuffer(q["own"], np.int64)[:, None] == np.frombuffer(c["own"], np.int64)[None]] = np.iinfo(np.int64).min
    return s


def grid(queries: int, vectors: int, cells: int) -> tuple[int, int]:
    """(rows, columns) of about ``cells`` cells: queries are dealt into rows and copied to every column, vectors the other way,
    so ``columns * queries + rows * vectors`` are shuffled; it is least at these sides."""
    rows = min(cells, max(1, round((cells * queries / max(1, vectors)) ** 0.5)))
    return rows, max(1, cells // rows)


def _pairs(queries: DataFrame, corpus: DataFrame, sides: tuple[int, int]) -> DataFrame:
    """Every block of queries with every block of vectors of the same length, once: a block of queries stands in one row of
    the grid and a block of vectors in one column."""
    rows, columns = sides
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(*(F.col(c).alias(f"q_{c}") for c in queries.columns), F.pmod(F.xxhash64("numbers"), F.lit(rows)).alias("q_row"), all_of(columns).alias("q_group"))
    c = corpus.withColumn("group", F.pmod("group", F.lit(columns))).withColumn("row", all_of(rows) if rows > 1 else F.lit(0))
    return c.join(q, (F.col("dim") == F.col("q_dim")) & (F.col("group") == F.col("q_group")) & (F.col("row") == F.col("q_row")))


def _blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[dict, dict]]:
    for row in batch.to_pylist():
        yield {k[2:]: v for k, v in row.items() if k.startswith("q_")}, {k: v for k, v in row.items() if not k.startswith("q_")}


def _count(pairs: DataFrame, k: int, bins: int) -> DataFrame:
    """query, bin, n: for each query and block of vectors the counts of its bins from the top down to the k-th score."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, c in _blocks_of(batch):
                s = _scores(q, c)
                lo, width = (np.frombuffer(q[x], np.int64)[:, None] for x in ("lo", "width"))
                at = np.where(s < lo, -1, np.minimum((s - lo) // width, bins))  # the bin ``bins``: above the range
                # the k best bins of each query in this block, counted
                top = np.sort(np.partition(at, max(0, at.shape[1] - k), axis=1)[:, -k:], axis=1)
                floor = top[:, 0]
                row, col = np.nonzero((at >= np.maximum(floor, 0)[:, None]))
                key, n = np.unique(row * (bins + 1) + at[row, col], return_counts=True)
                ids = np.frombuffer(q["numbers"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[key // (bins + 1)]), pa.array(key % (bins + 1)), pa.array(n.astype(np.int64))], ["number", "bin", "n"])

    return pairs.mapInArrow(each, "number long, bin long, n long").groupBy("number", "bin").agg(F.sum("n").alias("n"))


def _kept(pairs: DataFrame, k: int) -> DataFrame:
    """number, query_id, vec_id, score: of each query and block of vectors the k best, of those that reach its edge."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, c in _blocks_of(batch):
                s = _scores(q, c)
                row, col = np.nonzero(s >= np.frombuffer(q["lo"], np.int64)[:, None])
                own = s[row, col] > np.iinfo(np.int64).min
                row, col = row[own], col[own]
                ids = np.frombuffer(c["ids"], np.int64)[col]
                order = np.lexsort((ids, -s[row, col], row))
                row, col, ids = row[order], col[order], ids[order]
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, int)
                place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
                row, col, ids = row[place < k], col[place < k], ids[place < k]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(q["numbers"], np.int64)[row]), pa.array(np.frombuffer(q["ids"], np.int64)[row]), pa.array(ids), pa.array(s[row, col])], ["number", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(each, "number long, query_id long, vec_id long, score long")


def search(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, bins: int = BINS, sides: tuple[int, int] | None = None) -> DataFrame:
    """``sides``: rows and columns of the grid of blocks, by default ``grid`` of the numbers of rows. ``vectors`` and ``queries`` (id, vector, row: a number that names each vector's row, null for a query that is no row
    of ``vectors``) -> query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    n = partitions(spark)

    def whole_rows(df: DataFrame) -> DataFrame:
        fit = df.filter(F.col("id").isNotNull() & usable(F.col("vector")))
        return fit.select(F.col("id").cast("long").alias("id"), whole(F.col("vector"), scale).alias("ints"), F.coalesce("row", F.lit(-1)).cast("long").alias("own"))

    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    asked = whole_rows(queries).withColumns({"number": F.monotonically_increasing_id(), "dim": F.size("ints"), "norm": norm(F.col("ints"))})
    asked = cut(asked.repartition(n))
    ready = whole_rows(vectors)
    corpus = cut(_packed(ready.repartition(n, F.xxhash64("own")), BLOCK, ["own"]).withColumn("group", F.spark_partition_id()))
    sides = sides or grid(asked.count(), corpus.agg(F.sum("n")).first()[0] or 0, n)
    longest = ready.groupBy(F.size("ints").alias("_dim")).agg(F.max(norm(F.col("ints"))).alias("_norm"))
    # no score is outside the product of the norms
    reach = (F.ceil(F.col("norm") * F.col("_norm")) + 1).cast("long")
    edges = asked.join(longest, F.col("dim") == F.col("_dim")).select("number", (-reach).alias("lo"), F.ceil((2 * reach + 1) / bins).alias("width"))
    edges = cut(edges)
    while True:
        now = asked.join(edges.withColumnRenamed("number", "_n"), F.col("number") == F.col("_n"))
        blocks = cut(_packed(now.select("id", "ints", "own", F.col("number").alias("numbers"), "lo", "width"), QUERY_BLOCK, ["own", "numbers", "lo", "width"]))
        if not edges.filter("width > 0").limit(1).count():
            break
        counts = _count(_pairs(blocks, corpus, sides), k, bins)
        # a query's bins are few: at most k from each block that reach the best bins
        total = counts.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False).alias("b"))
        zero = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).cast("long").alias("bin"))
        done = F.aggregate("b", zero, lambda a, x: F.when(a["seen"] >= k, a).otherwise(F.struct((a["seen"] + x["n"]).alias("seen"), x["bin"].alias("bin"))))
        found = total.select(F.col("number").alias("_n"), done["bin"].alias("_bin"))
        joined = edges.join(found, F.col("number") == F.col("_n"), "left")
        # fewer than k scores in all: the edge stays at the lowest bin that has any
        low = F.col("lo") + F.coalesce("_bin", F.lit(0)) * F.col("width")
        edges = cut(joined.select("number", low.alias("lo"), F.when(F.col("width") <= 1, 0).otherwise(F.ceil(F.col("width") / bins)).cast("long").alias("width")))
    return _ranked(_kept(_pairs(blocks, corpus, sides), k), k)


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    out = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    rows = cut(embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.monotonically_increasing_id().alias("row")))
    return search(rows, rows.filter("id % 50 = 0"))


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q, v c
  WHERE q.vec_id % 50 = 0 AND q.own <> c.own AND len(q.e) = len(c.e) AND c.vec_id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
