"""Sources: contract-scoped scans, sampling, type conforming, replay.

Every function returns a lazy DataFrame; filters and projections are plain
Column expressions, so Catalyst pushes them into the Parquet scan
(``PushedFilters`` / pruned ``ReadSchema``) or into a JDBC query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions.predicates import sentinel_to_null


def table_path(base: str, name: str, fmt: str = "parquet") -> str:
    return os.path.join(base, f"{name}.{fmt}")


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(table_path(base, name, fmt))


def read_tables(spark: SparkSession, base: str, names: Iterable[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """``{table: DataFrame}`` for the tables a contract names."""
    return {n: read_table(spark, base, n, fmt) for n in names}


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict[str, str] | None = None, **partitioning) -> DataFrame:
    """S1 for a database: same call shape; pass ``column/lowerBound/upperBound/numPartitions``
    to split the read over executors."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in {**(props or {}), **partitioning}.items():
        r = r.option(k, str(v))
    return r.load()


def jdbc_url(server: dict) -> str:
    """``servers.<name>`` block of a contract (type, host, port, database) -> JDBC URL."""
    typ = str(server.get("type", "mysql")).lower()
    port = f":{server['port']}" if server.get("port") else ""
    return f"jdbc:{typ}://{server.get('host', 'localhost')}{port}/{server.get('database', '')}"


def read_jdbc_partitioned(
    spark: SparkSession, url: str, table: str, key: str, num_partitions: int, props: dict[str, str] | None = None
) -> DataFrame:
    """A table read by ``num_partitions`` parallel range queries on a numeric key.
    The key's bounds come from one pushed-down ``MIN/MAX`` query (one row)."""
    bounds = (
        spark.read.format("jdbc").option("url", url)
        .option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}")
        .options(**(props or {})).load().first()
    )
    if bounds is None or bounds["lo"] is None:
        return read_jdbc(spark, url, table, props)
    return read_jdbc(spark, url, table, props, partitionColumn=key, lowerBound=bounds["lo"],
                     upperBound=bounds["hi"], numPartitions=num_partitions)


def _literal(value) -> str | None:
    """A key value as text of a query; None for values that dialects spell apart (a backslash in a text, bytes, NaN)."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value) if math.isfinite(value) else None
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'" if value.tzinfo is None else None
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str) and "\\" not in value and "\0" not in value:
        return "'" + value.replace("'", "''") + "'"
    return None


#: Remainder of a hash of columns, never null, in the spelling of a database.
HASH_SQL = {
    "mysql": "MOD(CRC32(CONCAT_WS('|', {columns})), {n})",
    "postgresql": "MOD(ABS(CAST(hashtext(CONCAT_WS('|', {columns})) AS BIGINT)), {n})",
}
RANDOM_SQL = {"mysql": "RAND()", "postgresql": "RANDOM()"}


def hash_predicates(columns: list[str], n: int, hash_sql: str = HASH_SQL["mysql"]) -> list[str]:
    """``n`` conditions of which each row meets exactly one, for keys whose order says nothing."""
    part = hash_sql.format(columns=", ".join(columns), n=n)
    return [f"{part} = {i}" for i in range(n)]


def split_predicates(keys: list[str], sample: list[tuple], n: int, spread: list[str] | None = None, hash_sql: str = HASH_SQL["mysql"]) -> list[str]:
    """About ``n`` conditions of which each row of a table meets exactly one, for a read by parallel queries.

    ``sample``: key values of some rows (one tuple a row, repeats included) in the order of the database that will
    judge the conditions: an equi-depth histogram.  A key may have several columns, of any type.  A key value that
    holds the share of several ranges is a range of its own, cut by a hash of the columns ``spread`` (whole, if there are
    none).  Rows with a null in the key are the last condition.  Values that dialects spell apart are no bounds, so
    ranges may be fewer; whatever the sample, no row is lost or read twice."""
    null = " OR ".join(f"{k} IS NULL" for k in keys)
    bounds: list[tuple[str, ...]] = []
    weight: dict[tuple[str, ...], int] = {}
    for i in range(1, n):
        at = sample[len(sample) * i // n] if sample else ()
        bound = tuple(_literal(v) for v in at)
        if bound and None not in bound:
            weight[bound] = weight.get(bound, 0) + 1
            if weight[bound] == 1:
                bounds.append(bound)

    def reaches(bound):  # the key stands at the bound or after it
        steps = []
        for i, (k, b) in enumerate(zip(keys, bound)):
            before = [f"{a} = {x}" for a, x in zip(keys[:i], bound[:i])]
            steps.append(" AND ".join([*before, f"{k} {'>=' if i == len(keys) - 1 else '>'} {b}"]))
        return "(" + " OR ".join(f"({s})" for s in steps) + ")"

    whole = [f"{k} IS NOT NULL" for k in keys]
    out = []
    for low, high in zip([None, *bounds], [*bounds, None]):
        inside = [*whole, *([reaches(low)] if low else []), *([f"NOT {reaches(high)}"] if high else [])]
        if low is None or weight[low] == 1:
            out.append(" AND ".join(inside))
            continue
        same = "(" + " AND ".join(f"{k} = {b}" for k, b in zip(keys, low)) + ")"
        parts = hash_predicates(spread, weight[low], hash_sql) if spread else [None]
        out += [" AND ".join([*inside, same, *([p] if p else [])]) for p in parts]
        out.append(" AND ".join([*inside, f"NOT {same}"]))
    return [*out, null]


#: Rows of the key sample for each wanted range; the sample is all that the driver holds.
SAMPLED = 200


def read_jdbc_split(
    spark: SparkSession, url: str, table: str, keys: list[str], num_partitions: int, props: dict[str, str] | None = None, spread: list[str] | None = None,
) -> DataFrame:
    """A table read by parallel queries on a key of any columns and distribution (``split_predicates``).

    Two pushed-down queries before the read: the number of rows, and about ``SAMPLED * num_partitions`` keys drawn at random,
    in the database's own order."""
    dialect = url.split(":")[1] if url.startswith("jdbc:") else "mysql"
    ask = lambda query: spark.read.format("jdbc").option("url", url).option("query", query).options(**(props or {})).load()
    rows = int(ask(f"SELECT COUNT(*) AS n FROM {table}").first()["n"])
    listed = ", ".join(keys)
    share = min(1.0, SAMPLED * num_partitions / max(rows, 1))
    filled = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    # ranked by the database, as its collation judges the ranges later
    drawn = ask(
        f"SELECT {listed}, ROW_NUMBER() OVER (ORDER BY {listed}) AS probity_rank FROM {table} "
        f"WHERE {filled} AND {RANDOM_SQL.get(dialect, 'RAND()')} < {share!r}"
    )
    ranked = [tuple(r)[:-1] for r in sorted(drawn.collect(), key=lambda r: r["probity_rank"])]
    predicates = split_predicates(keys, ranked, num_partitions, spread, HASH_SQL.get(dialect, HASH_SQL["mysql"]))
    return spark.read.jdbc(url, table, predicates=predicates, properties=props or {})


def read_contract_tables(
    spark: SparkSession, contract, base: str | None = None, fmt: str = "parquet", server: str = "mysql",
    num_partitions: int | None = None,
) -> dict[str, DataFrame]:
    """The contract's tables, from files under ``base`` or, without ``base``,
    from the database named in ``servers.<server>`` (split on the primary key when ``num_partitions``
    is given: ranges between the bounds of one column, a sampled histogram of several)."""
    if base is not None:
        return read_tables(spark, base, contract.tables, fmt)
    srv = (contract.raw.get("servers") or {})[server]
    url = jdbc_url(srv)
    props = {k: str(v) for k, v in (("user", srv.get("username")), ("password", srv.get("password"))) if v is not None}
    out = {}
    for t in contract.tables:
        pk = contract.primary_keys.get(t) or []
        if num_partitions and len(pk) == 1:
            out[t] = read_jdbc_partitioned(spark, url, t, pk[0], num_partitions, props)
        elif num_partitions and pk:
            out[t] = read_jdbc_split(spark, url, t, pk, num_partitions, props)
        else:
            out[t] = read_jdbc(spark, url, t, props)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """S1 fixture: one row per table with its row count (each count is a
    metadata-only or single-column scan)."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_n(df: DataFrame, key: str | list[str], n: int = 100) -> DataFrame:
    """Deterministic first-N sample, top-k by key (``TakeOrderedAndProject``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def hash_mod_sample(df: DataFrame, key: str, modulus: int = 100, remainder: int = 0, n: int | None = None) -> DataFrame:
    """S3: rows whose key falls in one residue class; integer keys use ``pmod(key, m)``,
    other keys ``pmod(xxhash64(key), m)``.  ``n`` caps the sample (the reference's
    LIMIT); ``n=None`` keeps the whole class."""
    dt = df.schema[key].dataType
    integral = isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    h = F.col(key) if integral else F.xxhash64(F.col(key))
    out = df.where(F.pmod(h, F.lit(modulus)) == remainder)
    return out.orderBy(key).limit(n) if n else out


def time_window(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """Rows with ``lo <= ts < hi``, pushed to the scan as a range filter."""
    c = F.col(ts)
    dt = df.schema[ts].dataType.simpleString()
    return df.where((c >= F.lit(lo).cast(dt)) & (c < F.lit(hi).cast(dt)))


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to the wanted types with ``try_cast`` (a failure becomes null)."""
    return df.select(
        *[(F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)) for c in df.columns]
    )


def conform_report(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """S5 report: per column, values present that do not convert to the wanted type.
    All columns in one aggregate pass."""
    aggs = []
    for c, t in types.items():
        aggs.append(F.count(F.col(c)).alias(f"n_{c}"))
        aggs.append(F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"f_{c}"))
    row = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("wanted_type"),
            F.col(f"n_{c}").alias("non_null"), F.col(f"f_{c}").alias("failures"),
        )
        for c, t in types.items()
    ]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def all_strings(df: DataFrame) -> DataFrame:
    """S5/S6 fallback: every column as text, nulls kept (arrays/structs as JSON)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            out.append(F.to_json(c).alias(f.name))
        else:
            out.append(c.cast("string").alias(f.name))
    return df.select(*out)


# The missing-value sentinels a contract example declares.
DEFAULT_SENTINELS = ["", "N/A", "n/a"]


def normalize_missing(df: DataFrame, columns: Iterable[str], sentinels: Iterable = DEFAULT_SENTINELS) -> DataFrame:
    """Sentinel texts become null; zero dates (``0000-00-00``) become null through
    ``try_to_timestamp`` when a column is declared as a timestamp."""
    cols = set(columns)
    return df.select(*[(sentinel_to_null(F.col(c), sentinels).alias(c) if c in cols else F.col(c)) for c in df.columns])


def parse_zero_dates(df: DataFrame, columns: Iterable[str], fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    cols = set(columns)
    return df.select(*[(F.try_to_timestamp(F.col(c), F.lit(fmt)).alias(c) if c in cols else F.col(c)) for c in df.columns])


def replay(spark: SparkSession, base: str, dataset: str, table: str, run_id: str) -> DataFrame:
    """Read back the stored sample of one run; ``dataset/table/run_id`` are
    partition columns, so the filter prunes directories."""
    df = spark.read.parquet(os.path.join(base, "samples", table))
    out = df.where((F.col("dataset") == dataset) & (F.col("run_id") == run_id))
    return out.drop("dataset", "table", "run_id")
