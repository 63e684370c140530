"""SimHash near-duplicates by BK-trees.

Every text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints meet in shards: the 64 bits are cut
into six blocks, and of two fingerprints within four bits at least two blocks agree, so a shard for each pair of block
values misses no link. The members of a shard form a BK-tree, children keyed by their integer Hamming distance to the
parent, and each member follows only the edges within the radius. The trees are built and walked level by level, many
shards at once, as arrays.

Trees meet their queries by a shuffle, not by a broadcast: the trees of all shards grow with the corpus. A shard of
more than ``SHARD`` members is split into parts, every part's tree meeting every part's queries in a cell of its own,
so that no task holds more than two parts of a shard and no pair is missed. A cell hands on a spanning forest of its
links, never all pairs; copies count as one fingerprint throughout.

Defined results: a null or empty text, or one of white space, has fingerprint 0 and links like any other; a null
doc_id keeps its row, and a component's id is its smallest doc_id that is not null (null if none); rows with one
doc_id are separate documents; an empty table gives an empty table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.common import cut, partitions, row_key
from probity.llm.components import components, unite

SHINGLE = 4
BITS = 4
SEED = 42
#: Members of a shard, or of a part of a larger shard, that one tree holds.
SHARD = 4096
#: Steps (query, tree node) that are walked at once.
STEPS = 2_000_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text as an unsigned 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()  # of bytes: A-Z and the six ASCII white-space characters only
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    k = min(shingle, len(words))
    ones, n = np.zeros(64, np.int64), len(words) - k + 1
    for i in range(0, n, 1 << 16):
        part = [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts[i : min(n, i + (1 << 16))], starts[i + k :], strict=False)]
        hashes = np.array(part, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(each, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _blocks(bits: int) -> tuple[list[tuple[int, int]], int]:
    """(shift, width) of bits + 2 blocks; two of them agree if at most ``bits`` bits differ."""
    n = bits + 2
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)], n


def _forest(tree: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of the fingerprints, one for each group (sorted): the groups' roots, and the edges' keys (65 * parent +
    distance, sorted) and children."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    root = np.repeat(first, np.diff(np.r_[first, len(group)]))
    active = np.setdiff1d(np.arange(len(tree)), first, assume_unique=True)
    at, keys, children = root[active], [], []
    while len(active):
        key = at * 65 + np.bitwise_count(tree[active] ^ tree[at])
        unique, index, back = np.unique(key, return_index=True, return_inverse=True)
        keys.append(unique)
        children.append(active[index])
        at, stay = active[index][back], np.ones(len(active), bool)
        stay[index] = False
        active, at = active[stay], at[stay]
    keys, children = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *children])
    order = np.argsort(keys, kind="stable")
    return first, keys[order], children[order]


def _walk(tree, keys, children, queries, roots, bits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query index, tree index) of all pairs within ``bits``."""
    q, node = np.arange(len(queries)), roots
    while len(q):
        d = np.bitwise_count(queries[q] ^ tree[node]).astype(np.int64)
        near = d <= bits
        yield q[near], node[near]
        lo = np.searchsorted(keys, node * 65 + np.maximum(d - bits, 0))
        hi = np.searchsorted(keys, node * 65 + np.minimum(d + bits, 64), side="right")
        n = hi - lo
        q = np.repeat(q, n)
        node = children[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]


def links(fp: np.ndarray, group: np.ndarray, in_tree: np.ndarray, in_query: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (index, index) of the links in every group; ``group`` is sorted."""
    t, q = np.flatnonzero(in_tree), np.flatnonzero(in_query)
    ids, size = np.unique(group[t], return_counts=True)
    place = np.searchsorted(ids, group[q])
    known = (place < len(ids)) & (ids[np.minimum(place, max(len(ids) - 1, 0))] == group[q]) if len(ids) else np.zeros(len(q), bool)
    q, place = q[known], place[known]
    first, keys, children = _forest(fp[t], group[t])
    parent = np.arange(len(fp))
    cost = np.cumsum(size[place]) if len(q) else np.zeros(0, np.int64)
    at = 0
    while at < len(q):  # queries whose trees have STEPS nodes in all
        to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + STEPS, side="right")))
        for a, b in _walk(fp[t], keys, children, fp[q[at:to]], first[place[at:to]], bits):
            parent = unite(parent, q[at:to][a], t[b])
        at = to
    moved = np.flatnonzero(parent != np.arange(len(fp)))
    return moved, parent[moved]


def near(prints: DataFrame, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (a, b) that connect all that link, and none that don't."""
    blocks, _ = _blocks(bits)
    value = lambda s, w: F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1))
    pairs = list(combinations(range(len(blocks)), 2))
    keys = [F.lit(i << 40).bitwiseOR(F.shiftleft(value(*blocks[x]), 20)).bitwiseOR(value(*blocks[y])) for i, (x, y) in enumerate(pairs)]
    members = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = cut(members.groupBy("key").count().filter(F.col("count") > shard).select(F.col("key").alias("_key"), F.ceil(F.col("count") / shard).alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = members.join(large, F.col("key") == F.col("_key"), "left").withColumn("_part", F.pmod(F.xxhash64("fp"), parts))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    lo, hi = F.least("_part", "_other"), F.greatest("_part", "_other")
    # a part is the tree in its cells with later parts, and the queries in its cells with earlier ones
    dealt = dealt.select("key", (lo * F.lit(1 << 31) + hi).alias("cell"), "fp", (F.col("_part") <= F.col("_other")).alias("tree"), (F.col("_part") >= F.col("_other")).alias("query"))
    dealt = dealt.repartition(partitions(prints.sparkSession), "key", "cell").sortWithinPartitions("key", "cell", "fp")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, cell, fp, tree, query = rows
            group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
            a, b = links(fp.view(np.uint64), group, tree, query, bits)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            key, cell = held[:2]
            last = np.flatnonzero((key != key[-1]) | (cell != cell[-1]))
            if len(last):  # the last group may go on in the next batch
                yield edges([c[: last[-1] + 1] for c in held])
                held = [c[last[-1] + 1 :] for c in held]
        if held is not None:
            yield edges(held)

    return dealt.mapInArrow(join, "a long, b long")


def classes(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, fp, component_id."""
    prints = cut(fingerprints(docs, shingle))
    # dealt out anew before it is cut: joined by fp below, very frequent fingerprints can then be split over tasks
    unique = prints.groupBy("fp").agg(F.min("doc_id").alias("_doc"))
    unique = cut(unique.repartition(partitions(docs.sparkSession)))
    found = cut(components(near(unique.select("fp"), bits, shard)))
    linked = unique.join(found, F.col("fp") == F.col("node"), "left")
    linked = cut(linked.select("fp", "_doc", F.coalesce("component", "fp").alias("_class")).repartition(partitions(docs.sparkSession)))
    smallest = linked.groupBy("_class").agg(F.min("_doc").alias("component_id"))
    smallest = cut(smallest.withColumnRenamed("_class", "_named").repartition(partitions(docs.sparkSession)))
    named = linked.join(smallest, F.col("_class") == F.col("_named")).select(F.col("fp").alias("_fp"), "component_id")
    named = cut(named.repartition(partitions(docs.sparkSession)))
    return prints.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The document with the smallest doc_id of every class, with the columns of ``docs``; of rows that share that
    doc_id, one, and of rows that share the text too, the one whose other columns come first as texts (in column order,
    nulls last). A class without any doc_id keeps the row of its smallest fingerprint."""
    key = row_key(F.col("doc_id"), F.lit(""), F.col("text"))
    names = classes(docs.select(F.struct("doc_id", key.alias("key")).alias("doc_id"), "text"), shingle, bits)
    # the smallest struct (doc_id, key) has a null doc_id first, so nulls are put last
    keep = names.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id.doc_id").isNull(), F.col("doc_id"))).alias("k"))
    keep = cut(keep.select(F.col("k.doc_id.key").alias("_key")).distinct())
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), key.alias("_mine"))
    kept = rows.join(keep, F.col("_mine") == F.col("_key"), "left_semi")
    # rows that are equal in doc_id and text are one class: one of them stays; many copies become one row a task before they are shuffled
    others = [F.col(f"_row.`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    tie = F.array(*(F.struct(c.isNull().alias("none"), c.cast("string").alias("value")) for c in others)) if others else F.lit(0)
    return kept.groupBy("_mine").agg(F.min_by("_row", tie).alias("_row")).select("_row.*")


def digest(docs: DataFrame) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return classes(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")
