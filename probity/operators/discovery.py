"""What the data itself says about keys, references and types.

* :func:`inclusions` / :func:`foreign_keys`: all pairs of columns at once. Every value is shuffled once with the set of
  columns that hold it (a bit mask, merged map-side, so a hot value is one row per task); the masks are counted, and a
  column is included in another if every value of the first is counted with both. The work does not grow with the number
  of pairs.
* :func:`candidate_keys`: minimal unique column combinations, level by level. A combination is looked at only if no part
  of it is a key and the product of its columns' distinct counts reaches the number of rows; a sketch of each (one scan
  for a level) leaves few to be verified by an exact grouping.
* :func:`infer_types`: the narrowest type of each text column from counts that any split of the rows adds up to.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK_BITS = 62
#: Longer texts are compared by their SHA-256.
LONG_TEXT = 64
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _family(dt: T.DataType) -> str | None:
    """Columns of one family can refer to each other."""
    if isinstance(dt, INTEGERS):
        return "int"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "text"
    return "date" if isinstance(dt, T.DateType) else None


def _image(c: Column, family: str) -> Column:
    if family == "int":
        return c.cast("long").cast("string")
    if family == "date":
        return c.cast("string")
    return F.when(F.length(c) <= LONG_TEXT, F.concat(F.lit("t"), c)).otherwise(F.concat(F.lit("h"), F.sha2(c.cast("binary"), 256)))


def _columns(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    return [(t, f.name, fam) for t, df in tables.items() for f in df.schema.fields if (fam := _family(f.dataType))]


def inclusions(tables: dict[str, DataFrame]) -> DataFrame:
    """child_table, child_column, parent_table, parent_column, child_values, parent_values, shared: the pairs of different
    columns of one family where each non-null value of the child is a value of the parent. Columns without values are in
    no pair."""
    cols = _columns(tables)
    n_masks = max(1, -(-len(cols) // MASK_BITS))
    parts = []
    for t, df in tables.items():
        mine = [(i, c, fam) for i, (table, c, fam) in enumerate(cols) if table == t]
        if mine:
            held = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(fam).alias("family"), _image(F.col(f"`{c}`"), fam).alias("value")) for i, c, fam in mine))
            parts.append(df.select(F.explode(held).alias("x")).select("x.*").where(F.col("value").isNotNull()))
    spark = next(iter(tables.values())).sparkSession
    empty = spark.createDataFrame([], "i int, family string, value string")
    rows = empty
    for p in parts:
        rows = rows.unionByName(p)
    names = [f"m{k}" for k in range(n_masks)]
    bit = F.expr(f"shiftleft(1L, i % {MASK_BITS})")
    masks = [F.bit_or(F.when(F.floor(F.col("i") / MASK_BITS) == k, bit).otherwise(F.lit(0).cast("long"))).alias(m) for k, m in enumerate(names)]
    # one row for each set of columns that is some value's
    sets = rows.groupBy("family", "value").agg(*masks).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    members = F.filter(F.sequence(F.lit(0), F.lit(max(0, len(cols) - 1))), lambda j: _bit(j, names) == 1)
    pairs = sets.select("n", members.alias("all")).select("n", F.explode("all").alias("a"), "all").select("n", "a", F.explode("all").alias("b"))
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("shared"))
    own = counts.where("a = b").select(F.col("a").alias("_i"), F.col("shared").alias("_values"))
    named = spark.createDataFrame([(i, t, c) for i, (t, c, _) in enumerate(cols)], "_k int, _t string, _c string")
    side = lambda p: own.join(F.broadcast(named), F.col("_i") == F.col("_k")).select(F.col("_i").alias(f"_{p}"), F.col("_t").alias(f"{p}_table"), F.col("_c").alias(f"{p}_column"), F.col("_values").alias(f"{p}_values"))
    out = counts.where("a <> b").join(side("child"), F.col("a") == F.col("_child")).join(side("parent"), F.col("b") == F.col("_parent"))
    return out.where(F.col("shared") == F.col("child_values")).select("child_table", "child_column", "parent_table", "parent_column", "child_values", "parent_values", "shared")


def _bit(j: Column, names: list[str]) -> Column:
    out = F.lit(0).cast("long")
    for k, m in enumerate(names):
        bit = F.call_function("shiftright", F.col(m), F.pmod(j, F.lit(MASK_BITS)).cast("int")).bitwiseAND(F.lit(1).cast("long"))
        out = F.when(F.floor(j / MASK_BITS) == k, bit).otherwise(out)
    return out


def column_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table, column, rows, present: one fused aggregate per table."""
    parts = []
    for t, df in tables.items():
        cs = [c for table, c, _ in _columns({t: df})]
        one = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(cs)))
        parts.append(one.select(F.explode(F.array(*(F.struct(F.lit(t).alias("table"), F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("present")) for i, c in enumerate(cs)))).alias("x")).select("x.*") if cs else None)
    parts = [p for p in parts if p is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def foreign_keys(tables: dict[str, DataFrame], min_coverage: float = 0.5, one_to_one: bool = False) -> DataFrame:
    """child_table, child_column, parent_table, parent_column, coverage: for each column the reference that the data
    proposes. A parent is a unique column without nulls in another table that holds all values of the child; a child that
    is unique itself takes part only with ``one_to_one``. ``coverage`` is the share of the parent's values that the
    child has; the highest is proposed (ties to the smaller names), if it reaches ``min_coverage``."""
    found = inclusions(tables)
    counts = column_counts(tables)
    keys = counts.where("rows = present AND rows > 0").select(F.col("table").alias("parent_table"), F.col("column").alias("parent_column"), F.col("rows").alias("_rows"))
    out = found.where("child_table <> parent_table").join(keys, ["parent_table", "parent_column"]).where("parent_values = _rows")
    if not one_to_one:
        unique = counts.where("rows > 0").select(F.col("table").alias("child_table"), F.col("column").alias("child_column"), F.col("present").alias("_present"))
        out = out.join(unique, ["child_table", "child_column"]).where("child_values < _present")
    out = out.withColumn("coverage", F.col("shared") / F.col("parent_values")).where(F.col("coverage") >= min_coverage)
    best = out.groupBy("child_table", "child_column").agg(F.min(F.struct((-F.col("coverage")).alias("_c"), "parent_table", "parent_column", "coverage")).alias("_b"))
    return best.select("child_table", "child_column", "_b.parent_table", "_b.parent_column", "_b.coverage")


def candidate_keys(df: DataFrame, columns: list[str] | None = None, max_size: int = 3, rsd: float = 0.02) -> list[tuple[str, ...]]:
    """The minimal sets of at most ``max_size`` columns that are never null and tell all rows apart, in order of size and
    of the columns in the table. Floating columns, arrays, maps and structs are left out unless ``columns`` names them."""
    plain = lambda dt: not isinstance(dt, (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType))
    names = columns or [f.name for f in df.schema.fields if plain(f.dataType)]
    if not names:
        return []
    first = df.agg(F.count(F.lit(1)).alias("n"), *(F.count(F.col(f"`{c}`")).alias(f"p{i}") for i, c in enumerate(names)), *(F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(f"d{i}") for i, c in enumerate(names))).first()
    rows = first["n"]
    if not rows:
        return []
    names = [(c, first[f"d{i}"]) for i, c in enumerate(names) if first[f"p{i}"] == rows]
    distinct, found = dict(names), []
    # a sketch is off by more than five of its standard errors about once in a million
    sure = 1 - 5 * rsd
    for size in range(1, max_size + 1):
        level = [c for c in combinations([c for c, _ in names], size) if not any(set(k) <= set(c) for k in found)]
        bound = lambda c: _product(distinct[x] / sure for x in c)
        level = [c for c in level if bound(c) >= rows]
        if size > 1 and level:
            sketch = df.agg(*(F.approx_count_distinct(F.struct(*(F.col(f"`{x}`") for x in c)), rsd).alias(f"s{i}") for i, c in enumerate(level))).first()
            level = [c for i, c in enumerate(level) if sketch[f"s{i}"] >= sure * rows]
        else:
            level = [c for c in level if distinct[c[0]] >= sure * rows]
        for c in level:
            again = df.groupBy(*(F.col(f"`{x}`") for x in c)).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            if again.limit(1).count() == 0:
                found.append(c)
    return found


def _product(xs) -> float:
    out = 1.0
    for x in xs:
        out *= x
    return out


#: Text forms of the inferred types, from the narrowest to the widest; a type holds all that the narrower ones hold.
INTEGER_FORM = r"^[+-]?[0-9]{1,19}$"
NUMBER_FORM = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
TIME_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"


def infer_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, non_null, n_int, n_number, n_time, inferred_type: the narrowest of bigint, double and timestamp that all
    non-null texts of a column convert to, else string; void if there are none. One aggregate; its counts of two parts of
    a table add up to those of the whole."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    aggs = []
    for i, c in enumerate(names):
        x = F.col(f"`{c}`")
        aggs += [
            F.count(x).alias(f"a{i}"),
            F.count_if(x.rlike(INTEGER_FORM) & x.try_cast("bigint").isNotNull()).alias(f"b{i}"),
            F.count_if(x.rlike(NUMBER_FORM) & x.try_cast("double").isNotNull()).alias(f"c{i}"),
            F.count_if(x.rlike(TIME_FORM) & x.try_cast("timestamp").isNotNull()).alias(f"d{i}"),
        ]
    one = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias("non_null"), F.col(f"b{i}").alias("n_int"), F.col(f"c{i}").alias("n_number"), F.col(f"d{i}").alias("n_time")) for i, c in enumerate(names)))
    return with_type(df.agg(*aggs).select(F.explode(one).alias("x")).select("x.*"))


def with_type(counts: DataFrame) -> DataFrame:
    n = F.col("non_null")
    kind = F.when(n == 0, "void").when(F.col("n_int") == n, "bigint").when(F.col("n_number") == n, "double").when(F.col("n_time") == n, "timestamp").otherwise("string")
    return counts.withColumn("inferred_type", kind)


def conform_inferred(df: DataFrame) -> DataFrame:
    """The table with every text column in its inferred type; a column that is not all of one type stays text."""
    types = {r["column"]: r["inferred_type"] for r in infer_types(df).collect()}  # one row per column
    return df.select(*(F.col(f"`{c}`").cast(types[c]).alias(c) if types.get(c, "string") not in ("string", "void") else F.col(f"`{c}`") for c in df.columns))
