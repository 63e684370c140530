"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.session import checkpoint_dir

#: Words are maximal runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the session has set, or else the one that ``checkpoint_dir`` finds for it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        checkpoint_dir(spark)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut: written to the shared folder, so a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, source: Column, text: Column, seed: str = "") -> Column:
    """A 128-bit name of a row, null apart from empty; equal for fully equal rows only. Spelt alike in Spark and DuckDB SQL."""

    def part(c: Column, tag: str) -> Column:
        return F.coalesce(F.concat(F.lit(tag), c.cast("string")), F.lit("-"))

    return F.md5(F.concat_ws("|", F.lit(seed), part(doc_id, "d"), part(source, "s"), F.coalesce(F.md5(text.cast("binary")), F.lit("-"))))


def row_key_sql(seed: str = "") -> str:
    return (
        f"md5(concat_ws('|', '{seed}', coalesce('d' || cast(doc_id AS varchar), '-'), "
        "coalesce('s' || source, '-'), coalesce(md5(text), '-')))"
    )


def running(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Adds, for each ``sums`` item (new column: summed column), its sum over the rows before and up to this one in
    ``order``, ties included. Rows are range-partitioned; only one total per partition passes through the driver."""
    from pyspark.sql import Window

    spark = df.sparkSession
    parts = cut(df.repartitionByRange(partitions(spark), *order).withColumn("_part", F.spark_partition_id()))
    totals = {r["_part"]: r for r in parts.groupBy("_part").agg(*(F.sum(c).alias(f"_{k}") for k, c in sums.items())).collect()}
    before, offsets = dict.fromkeys(sums, 0), []
    for p in sorted(totals):
        offsets.append((p, *(before[k] for k in sums)))
        for k in sums:
            before[k] += totals[p][f"_{k}"] or 0
    kinds = ", ".join(["_part int", *(f"_{k}_before bigint" for k in sums)])
    offset = spark.createDataFrame(offsets, kinds)
    w = Window.partitionBy("_part").orderBy(*order)
    out = parts.join(F.broadcast(offset), "_part").withColumns({k: F.sum(c).over(w) + F.col(f"_{k}_before") for k, c in sums.items()})
    return out.drop("_part", *(f"_{k}_before" for k in sums))
