"""Labelled rows for the classifiers: which are learned from, and a bounded sample of them by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One document in so many is held out.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for documents that no classifier learns from; a null doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def sample(rows: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """About ``most`` rows (all, if fewer) chosen by a hash of doc_id, so at any size the same share of each kind."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 31)) < F.lit(int(most / n * (1 << 31))))


def one_each(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each ``key``, the one with the least digest of its text: a repeated id is not more rows to learn from."""
    every = F.struct(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_digest"), *rows.columns)
    return rows.groupBy(F.col(key).alias("_each")).agg(F.min(every).alias("_row")).select("_row.*").drop("_digest")


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, y (0 or 1): the documents to learn from; of contradicting labels the majority, 1 if even."""
    known = labels.filter(F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("y"))
