"""Sinks (S6-S10): samples, profiles, schema views, reports and failing rows.

Outputs go under one base path (on a cluster: a shared folder, e.g. the one
named by ``spark.checkpoint.dir``), with the reference's sub-datasets:
``samples/``, ``profiles/``, ``metadata/``, ``sandbox/``, ``failing_examples/``.
Writes are Spark jobs (one file set per task), never a driver-side dump.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from probity.session import checkpoint_dir
from probity.sources.tables import all_strings


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "probity-out", uuid.uuid4().hex, name)


def write_sample(df: DataFrame, base: str, dataset: str, table: str, run_id: str) -> str:
    """Parquet partitioned by dataset / table / run_id (one path per table, as
    schemas differ).  On a failed write every column is retried as text."""
    path = os.path.join(base, "samples", table)
    tagged = df.select("*", F.lit(dataset).alias("dataset"), F.lit(table).alias("table"), F.lit(run_id).alias("run_id"))
    # dynamic partition overwrite: a re-run of the same run_id replaces only its own
    # partition (idempotent after a failed or repeated job), other runs stay
    writer = lambda d: (
        d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "table", "run_id").parquet(path)
    )
    try:
        writer(tagged)
    except (PySparkException, Py4JJavaError):
        writer(all_strings(df).select("*", F.lit(dataset).alias("dataset"), F.lit(table).alias("table"),
                                      F.lit(run_id).alias("run_id")))
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines (profiles, schema views, reports)."""
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).json(path)


def write_failing_csv(df: DataFrame, path: str) -> str:
    """Failing rows as CSV with a header; nested values as JSON text."""
    flat = df.select(
        *[
            (F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name))
            for f in df.schema.fields
        ]
    )
    flat.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.option("header", True).schema(ddl).csv(path)
