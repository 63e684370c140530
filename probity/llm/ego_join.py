"""Embedding near-duplicates by epsilon grid order.

Unit vectors link at a cosine of at least ``t``, that is within eps = sqrt(2 - 2t) of each other. They are turned onto
their principal axes (turning keeps all distances), a grid of cells eps wide is laid over the ``LEAD`` leading axes,
and the vectors of a label are sorted by cell. The sequence is cut into intervals: partitions of the sort, chunks of
blocks, blocks. Pairs of intervals are joined recursively, from the long to the short ones: a pair whose boxes are more
than eps apart is dropped with all that is inside, the others go on as the pairs of their parts. What is left are pairs
of blocks, compared whole by matrix products.

Equal vectors are one node with a weight, so a frequent vector costs as much as a rare one. A pair of blocks hands on
one count per vector and a spanning forest of its links, never all pairs. A hot label is many intervals.

Defined results: vectors that are null, zero or empty, hold null or non-finite components, or have a null label link
with nothing; vectors of different lengths do not link; rows with one vec_id are separate vectors and count as linked
if their vectors are equal; a component's id is its smallest vec_id that is not null; an empty table gives an empty
table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.llm.common import cut, partitions
from probity.llm.components import components, unite
from probity.llm.vectors import usable

COSINE = 0.93
LEAD = 6
BLOCK = 512
#: Blocks of a chunk.
CHUNK = 16
#: Added to eps for rounding.
SLACK = 1e-9


def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def axes(vectors: DataFrame, lead: int = LEAD) -> dict[int, np.ndarray]:
    """The leading principal axes of the vectors (dim, unit) of each length, from all of them. Tasks add up moments;
    their sums are grouped in Spark, and the driver gets one matrix for each length."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            flat, at = b.column("unit").flatten().to_numpy(), np.append(0, np.cumsum(dims))
            for d in np.unique(dims):
                x = np.array([flat[at[i] : at[i + 1]] for i in np.flatnonzero(dims == d)])
                x = np.hstack([x, np.ones((len(x), 1))])
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d, np.int32)), pa.array(np.arange(s.size, dtype=np.int32)), pa.array(s.ravel())], ["dim", "at", "x"])

    rows = vectors.select("dim", "unit").mapInArrow(each, "dim int, at int, x double").groupBy("dim", "at").agg(F.sum("x").alias("x")).toPandas()
    out = {}
    for d, part in rows.groupby("dim"):
        m = np.zeros((d + 1) ** 2)
        m[part["at"]] = part["x"]
        m = m.reshape(d + 1, d + 1)
        mean = m[-1, :-1] / m[-1, -1]
        _, vectors_ = np.linalg.eigh(m[:-1, :-1] / m[-1, -1] - np.outer(mean, mean))
        out[int(d)] = vectors_[:, ::-1][:, :lead].copy()
    return out


def _sequence(nodes: DataFrame, turned: dict[int, np.ndarray], eps: float, block: int, lead: int) -> DataFrame:
    """Blocks of the sorted vectors: part, chunk, block, label, dim, nodes, weights, units (bytes), lo0.., hi0..."""
    label = nodes.schema["label"].dataType
    names = [f"c{i}" for i in range(lead)]

    def project(x: np.ndarray) -> np.ndarray:
        p = x @ turned[x.shape[1]]
        return np.hstack([p, np.zeros((len(p), lead - p.shape[1]))])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = [project(np.asarray(v.values)[None])[0] for v in b.column("unit")]
            c = np.floor(np.array(p).reshape(-1, lead) / eps).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c[:, i]) for i in range(lead))], [*b.schema.names, *names])

    base = "node long, label {}, dim int, unit array<double>, weight long".format(label.simpleString())
    placed = nodes.select("node", "label", "dim", "unit", "weight").mapInArrow(cells, base + "".join(f", {c} long" for c in names))
    order = ["label", "dim", *names, "node"]
    sorted_ = placed.repartitionByRange(partitions(nodes.sparkSession), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def flush(label, dim, rows) -> pa.RecordBatch:
            nonlocal made
            x = np.array([r[1] for r in rows])
            p = project(x)
            made += 1
            values = [
                part, (part << 32) + (made - 1) // CHUNK, (part << 32) + made - 1, label, dim,
                np.array([r[0] for r in rows], np.int64).tobytes(), np.array([r[2] for r in rows], np.int64).tobytes(), x.tobytes(), *p.min(axis=0), *p.max(axis=0),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        held: list[tuple] = []
        now = schema = None
        for b in batches:
            if schema is None:
                fields = [("part", pa.int32()), ("chunk", pa.int64()), ("block", pa.int64()), ("label", b.schema.field("label").type), ("dim", pa.int32()), *((c, pa.binary()) for c in ("nodes", "weights", "units"))]
                schema = pa.schema([*fields, *((f"{e}{i}", pa.float64()) for e in ("lo", "hi") for i in range(lead))])
            for node, lab, dim, unit, weight in zip(b.column("node").to_pylist(), b.column("label").to_pylist(), b.column("dim").to_pylist(), b.column("unit"), b.column("weight").to_pylist(), strict=True):
                if now != (lab, dim) or len(held) == block:
                    if held:
                        yield flush(*now, held)
                    now, held = (lab, dim), []
                held.append((node, np.asarray(unit.values), weight))
        if held:
            yield flush(*now, held)

    edges = "".join(f", {e}{i} double" for e in ("lo", "hi") for i in range(lead))
    return sorted_.mapInArrow(pack, f"part int, chunk long, block long, label {label.simpleString()}, dim int, nodes binary, weights binary, units binary" + edges)


def _near(eps: float, lead: int) -> Column:
    """Whether the boxes of intervals a and b are within eps of each other."""
    gap = lambda i: F.greatest(F.lit(0.0), F.col(f"b.lo{i}") - F.col(f"a.hi{i}"), F.col(f"a.lo{i}") - F.col(f"b.hi{i}"))
    return sum((gap(i) * gap(i) for i in range(lead)), F.lit(0.0)) <= eps * eps


def block_pairs(blocks: DataFrame, eps: float, lead: int = LEAD) -> DataFrame:
    """(a, b), a <= b: the pairs of blocks of one label and length that may hold links."""
    edge = [f"{e}{i}" for e in ("lo", "hi") for i in range(lead)]
    whole = [(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in edge]
    # boxes without vectors: a few numbers for each block
    meta = cut(blocks.select("part", "chunk", "block", "label", "dim", *edge))
    kind = ["label", "dim"]
    # a partition may hold several labels: an interval is a partition's part of one label
    tops = meta.groupBy(*kind, F.col("part").alias("id")).agg(*whole)
    chunks = meta.groupBy(*kind, F.col("part").alias("up"), F.col("chunk").alias("id")).agg(*whole)
    leaves = meta.select(*kind, F.col("chunk").alias("up"), F.col("block").alias("id"), *edge)
    # along the leading axis only intervals whose cells overlap or touch can meet
    cell = lambda c: F.floor(F.col(c) / eps)
    left = tops.withColumn("_cell", F.explode(F.sequence(cell("lo0") - 1, cell("hi0") + 1)))
    right = tops.withColumn("_cell", F.explode(F.sequence(cell("lo0"), cell("hi0"))))
    met = left.alias("a").join(right.alias("b"), [*kind, "_cell"]).filter((F.col("a.id") <= F.col("b.id")) & _near(eps, lead))
    pairs = met.select(*kind, F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id")).distinct()
    for level in (chunks, leaves):
        p = pairs.alias("p")
        mine = lambda s: (F.col("p.label") == F.col(f"{s}.label")) & (F.col("p.dim") == F.col(f"{s}.dim")) & (F.col(f"p.{s}_id") == F.col(f"{s}.up"))  # noqa: E731, B023
        met = p.join(level.alias("a"), mine("a")).join(level.alias("b"), mine("b"))
        met = met.filter((F.col("a.id") <= F.col("b.id")) & _near(eps, lead))
        pairs = met.select(F.col("p.label").alias("label"), F.col("p.dim").alias("dim"), F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))
    return pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))


def _compared(pairs: DataFrame, blocks: DataFrame, t: float) -> DataFrame:
    """u, v, n: for v = -1 the weight n of what u links with in a pair of blocks; else an edge of a spanning forest."""
    body = ["dim", "nodes", "weights", "units"]
    side = lambda s: blocks.select(F.col("block").alias(f"{s}_block"), *(F.col(c).alias(f"{s}_{c}") for c in body))
    rows = pairs.join(side("a"), F.col("a") == F.col("a_block")).join(side("b"), F.col("b") == F.col("b_block")).drop("a_block", "b_block", "b_dim")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                x, y = (np.frombuffer(r[f"{s}_units"]).reshape(-1, r["a_dim"]) for s in "ab")
                un, uw, vn, vw = (np.frombuffer(r[f"{s}_{c}"], np.int64) for s in "ab" for c in ("nodes", "weights"))
                hit = x @ y.T >= t
                same = r["a"] == r["b"]
                if same:
                    np.fill_diagonal(hit, False)
                p, q = np.nonzero(hit)
                if not len(p):
                    continue
                counts = [(un, hit @ vw)] + ([] if same else [(vn, uw @ hit)])
                root = unite(np.arange(len(un) + (0 if same else len(vn))), p, q + (0 if same else len(un)))
                names = un if same else np.append(un, vn)
                moved = np.flatnonzero(root != np.arange(len(root)))
                u, n = np.concatenate([c[0] for c in counts]), np.concatenate([c[1] for c in counts])
                out = [np.append(u[n > 0], names[moved]), np.append(np.full((n > 0).sum(), -1), names[root[moved]]), np.append(n[n > 0], np.zeros(len(moved), np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in out], ["u", "v", "n"])

    return rows.mapInArrow(each, "u long, v long, n long")


def classes(embeddings: DataFrame, cosine: float = COSINE, lead: int = LEAD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    spark = embeddings.sparkSession
    n, eps = partitions(spark), float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    vectors = embeddings.select("vec_id", "embedding", "label")
    norm = F.when(usable(F.col("embedding")), _norm(F.col("embedding")))
    rows = vectors.withColumn("_fit", F.coalesce(F.col("label").isNotNull() & (norm > 0) & (norm < float("inf")), F.lit(False)))
    fit = rows.filter("_fit").groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("rep"))
    nodes = cut(fit.withColumn("node", F.monotonically_increasing_id()))
    # as a lambda's argument the norm is computed once for a vector, not once for each component
    unit = F.get(F.transform(F.array(_norm(F.col("embedding"))), lambda n: F.transform("embedding", lambda x: x.cast("double") / n)), F.lit(0))
    units = nodes.select("node", "label", "weight", F.size("embedding").alias("dim"), unit.alias("unit"))
    blocks = cut(_sequence(units, axes(units, lead), eps, block, lead))
    found = cut(_compared(block_pairs(blocks, eps, lead), blocks, cosine))
    links = found.filter("v = -1").groupBy("u").agg(F.sum("n").alias("_links"))
    joined = components(found.filter("v >= 0").select(F.col("u").alias("a"), F.col("v").alias("b")))
    known = nodes.join(links, F.col("node") == F.col("u"), "left").drop("u").withColumnRenamed("node", "_node")
    known = known.join(joined, F.col("_node") == F.col("node"), "left")
    known = cut(known.select("label", "embedding", "weight", "rep", F.coalesce("_links", F.lit(0)).alias("_links"), F.coalesce("component", "_node").alias("_class")))
    least = known.groupBy("_class").agg(F.min("rep").alias("component_id")).withColumnRenamed("_class", "_of").repartition(n)
    known = known.join(least, F.col("_class") == F.col("_of")).select(F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), (F.col("_links") + F.col("weight") - 1).alias("n_links"), "component_id")
    # dealt out anew, so that the join can be split where a label or class is hot
    known = known.repartition(n)
    mine = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    linked = rows.filter("_fit").join(known, mine).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT _fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def digest(embeddings: DataFrame) -> DataFrame:
    return classes(embeddings).select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"), "kept")


ORACLE = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
f AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.r AS a, b.r AS b, b.vec_id FROM f a JOIN f b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.93),
c AS (SELECT r, vec_id AS m FROM v UNION SELECT l.b, c.m FROM c JOIN l ON l.a = c.r),
m AS (SELECT r, min(m) AS component_id FROM c GROUP BY r),
n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN m USING (r) LEFT JOIN n USING (r)
"""
