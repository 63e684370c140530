"""Vector code compression: product codebooks fitted over anchors-hierarchy metric trees.

Vectors become integers, floor(scale * x), and are cut into equal consecutive parts. For every part position a task
builds, over each block of vectors, a tree of balls by the anchors hierarchy: about sqrt(n) anchors, each new one the
point farthest from its anchor and taking over the points that are nearer to it, then middle-out: anchors are merged
pairwise into a root, and anchors with many points are divided in the same way. Every ball caches the sum and the count
of its parts. The trees are written once and serve all rounds.

In a round a ball inherits the codebook entries that may be nearest to one of its points. Those that are too far from its
centre, for its radius, are left out; when one entry is left, the ball is wholly owned and its cached sum and count go to
that entry at once. Only points in balls that stay shared down to the leaves are compared one by one. Sums are grouped
over the corpus in Spark; the driver sees the codebooks (parts * entries * components, for each length of vector) only.

Arithmetic is exact: parts are integers, the balls only decide what need not be compared, and do so with a margin.

Defined results: rows whose vector is null or holds null or non-finite components are left out; vectors of each length
have codebooks of their own; a vector whose length is no positive multiple of the number of parts has null for code,
error and codebooks; rows with one vec_id are separate vectors, equal ids in the order of their integers, null ids last;
with fewer vectors than entries, all are entries; an empty table gives an empty table; other columns, of any name, are
not looked at. Squared distances must fit a double exactly (below 2**53).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.llm.common import cut
from probity.llm.vectors import usable

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Vectors of a block; points of a leaf, at most, unless they are all equal.
BLOCK, LEAF = 4096, 96
#: Sums by label are broadcast up to so many labels (about 2 MB), else joined by a shuffle.
LABELS = 50_000
#: Share by which distances of balls may be wrong.
SLACK = 1e-9


def _anchors(x: np.ndarray) -> np.ndarray:
    """The anchor (0, 1, ...) that owns each point."""
    owner, pivots = np.zeros(len(x), np.int64), [x[0]]
    far = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(pivots) < np.ceil(np.sqrt(len(x))):
        at = int(far.argmax())
        if far[at] == 0:
            break
        new = x[at]
        apart = np.sqrt(((np.array(pivots) - new) ** 2).sum(axis=1))
        # a point nearer to its anchor than half the way between the anchors stays there
        open_ = np.flatnonzero(2 * far > apart[owner])
        d = np.sqrt(((x[open_] - new) ** 2).sum(axis=1))
        taken = d < far[open_]
        owner[open_[taken]], far[open_[taken]] = len(pivots), d[taken]
        pivots.append(new)
    return owner


class Tree:
    """Balls over points. ``order`` lists the points so that each ball's are consecutive, from ``start`` to ``end``."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.leaf = x.astype(np.float64), leaf
        self.centre, self.radius, self.sum, self.count, self.kids, self.own = [], [], [], [], [], []
        root = self._build(np.arange(len(x)))
        order, start, end, todo, at = [], np.zeros(len(self.count), np.int64), np.zeros(len(self.count), np.int64), [(root, False)], 0
        while todo:
            node, done = todo.pop()
            if done:
                end[node] = at
            elif self.kids[node] is None:
                start[node], at = at, at + len(self.own[node])
                end[node] = at
                order.append(self.own[node])
            else:
                start[node] = at
                todo += [(node, True), (self.kids[node][1], False), (self.kids[node][0], False)]
        self.root, self.order, self.start, self.end = root, np.concatenate(order), start, end

    def _ball(self, points: np.ndarray | None, kids: tuple[int, int] | None) -> int:
        if kids is None:
            total, n = self.x[points].sum(axis=0), len(points)
            centre = total / n
            radius = np.sqrt(((self.x[points] - centre) ** 2).sum(axis=1).max())
        else:
            a, b = kids
            total, n = self.sum[a] + self.sum[b], self.count[a] + self.count[b]
            centre = total / n
            radius = max(np.sqrt(((self.centre[k] - centre) ** 2).sum()) + self.radius[k] for k in kids)
        for kept, value in ((self.centre, centre), (self.radius, radius), (self.sum, total), (self.count, n), (self.kids, kids), (self.own, points)):
            kept.append(value)
        return len(self.count) - 1

    def _build(self, points: np.ndarray) -> int:
        if len(points) <= self.leaf:
            return self._ball(points, None)
        owner = _anchors(self.x[points])
        groups = [points[owner == a] for a in range(int(owner.max()) + 1)]
        if len(groups) == 1:
            return self._ball(points, None)
        balls = [self._build(g) for g in groups if len(g)]
        # the pair whose common ball is smallest is merged next
        k = len(balls)
        c, r = np.array([self.centre[b] for b in balls]), np.array([self.radius[b] for b in balls])
        apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)) + r[:, None] + r[None]
        np.fill_diagonal(apart, np.inf)
        for _ in range(k - 1):
            i, j = divmod(int(apart.argmin()), k)
            balls[i] = self._ball(None, (balls[i], balls[j]))
            c[i], r[i] = self.centre[balls[i]], self.radius[balls[i]]
            apart[j], apart[:, j] = np.inf, np.inf
            near = np.sqrt(((c - c[i]) ** 2).sum(axis=1)) + r + r[i]
            live = np.isfinite(apart[i])
            live[i] = False
            apart[i] = apart[:, i] = np.where(live, near, np.inf)
        return balls[i]

    def packed(self) -> bytes:
        kids = np.array([k or (-1, -1) for k in self.kids], np.float64)
        nodes = np.column_stack([kids, self.start, self.end, self.radius, np.array(self.count, np.float64), np.array(self.sum)])
        return np.array([len(nodes), self.root], np.int64).tobytes() + self.order.astype(np.int32).tobytes() + nodes.tobytes()


def _owned(x: np.ndarray, packed: bytes, book: np.ndarray, each_point: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and counts by entry, and (if asked for) the entry of each point, ties to the lower index."""
    n, d = x.shape
    n_nodes, root = np.frombuffer(packed, np.int64, 2)
    order = np.frombuffer(packed, np.int32, n, 16)
    nodes = np.frombuffer(packed, np.float64, offset=16 + 4 * n).reshape(n_nodes, 6 + d)
    sums, counts, code = np.zeros((len(book), d), np.int64), np.zeros(len(book), np.int64), np.zeros(n, np.int64)
    level, mask = np.array([root]), np.ones((1, len(book)), bool)
    shared: list[tuple[np.ndarray, np.ndarray]] = []
    while len(level):
        node = nodes[level]
        away = np.sqrt(np.maximum(0, (((node[:, 6:] / node[:, 5:6])[:, None] - book[None]) ** 2).sum(axis=2)))
        away[~mask] = np.inf
        reach = away.min(axis=1) + 2 * node[:, 4]
        mask = mask & (away <= (reach + SLACK * (1 + reach))[:, None])
        alone = mask.sum(axis=1) == 1
        entry = mask.argmax(axis=1)
        np.add.at(sums, entry[alone], node[alone, 6:].astype(np.int64))
        np.add.at(counts, entry[alone], node[alone, 5].astype(np.int64))
        if each_point:
            for (a, b), e in zip(node[alone, 2:4].astype(int), entry[alone], strict=True):
                code[order[a:b]] = e
        leaf = node[:, 0] < 0
        for at in np.flatnonzero(leaf & ~alone):
            a, b = node[at, 2:4].astype(int)
            points, some = order[a:b], np.flatnonzero(mask[at])
            y = x[points]
            best = some[(((y[:, None] - book[some][None]) ** 2).sum(axis=2)).argmin(axis=1)]
            shared.append((points, best))
        on = ~leaf & ~alone
        level, mask = nodes[level[on], :2].astype(np.int64).ravel(), np.repeat(mask[on], 2, axis=0)
    for points, best in shared:
        np.add.at(sums, best, x[points].astype(np.int64))
        np.add.at(counts, best, 1)
        code[points] = best
    return sums, counts, code


def _blocks(rows: DataFrame, parts: int, block: int, leaf: int) -> DataFrame:
    """(vec_id, label, ints) -> dim, n, ids, labels, ints (packed), trees (one for each part): one row per block."""
    label = rows.schema["label"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def flush(dim: int, ids: list, labels: list, ints: list) -> pa.RecordBatch:
            x = np.array(ints).reshape(len(ids), dim)
            fits = dim > 0 and dim % parts == 0
            trees = [Tree(x[:, i : i + dim // parts], leaf).packed() for i in range(0, dim, dim // parts)] if fits else None
            columns = [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(kind)), pa.array([x.tobytes()], pa.binary()), pa.array([trees], pa.list_(pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["dim", "n", "ids", "labels", "ints", "trees"])

        held: dict[int, tuple[list, list, list]] = {}
        for b in batches:
            kind = b.schema.field("label").type
            for vec_id, lab, ints in zip(b.column("vec_id").to_pylist(), b.column("label").to_pylist(), b.column("ints"), strict=True):
                v = ints.values.to_numpy(zero_copy_only=False)
                mine = held.setdefault(len(v), ([], [], []))
                for kept, value in zip(mine, (vec_id, lab, v), strict=True):
                    kept.append(value)
                if len(mine[0]) == block:
                    yield flush(len(v), *held.pop(len(v)))
        for dim, mine in held.items():
            yield flush(dim, *mine)

    return rows.mapInArrow(each, f"dim int, n int, ids array<long>, labels array<{label}>, ints binary, trees array<binary>")


def _first_books(rows: DataFrame, parts: int, entries: int) -> dict[int, np.ndarray]:
    """For each length the codebooks (part, entry, component): the parts of the smallest ids."""
    fit = rows.withColumn("dim", F.size("ints")).filter((F.col("dim") > 0) & (F.col("dim") % parts == 0))
    w = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "ints")
    least = fit.select("dim", "vec_id", "ints").withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= entries)
    books: dict[int, list] = {}
    for r in least.orderBy("dim", "_at").select("dim", "ints").collect():  # at most ``entries`` rows a length
        books.setdefault(r["dim"], []).append(r["ints"])
    return {d: np.array(v, np.float64).reshape(len(v), parts, d // parts).transpose(1, 0, 2).copy() for d, v in books.items()}


def _next_books(blocks: DataFrame, books: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for row in b.to_pylist():
                book = books[row["dim"]]
                x = np.frombuffer(row["ints"]).reshape(row["n"], len(book), -1)
                for p, tree in enumerate(row["trees"]):
                    sums, counts, _ = _owned(x[:, p], tree, book[p], False)
                    total.setdefault(row["dim"], np.zeros((*book.shape[:2], book.shape[2] + 1), np.int64))[p] += np.column_stack([sums, counts])
        for dim, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(t.size, dim, np.int32)), pa.array(np.arange(t.size, dtype=np.int32)), pa.array(t.ravel())], ["dim", "at", "x"])

    sums = blocks.select("dim", "n", "ints", "trees").filter("trees IS NOT NULL").mapInArrow(each, "dim int, at int, x long").groupBy("dim", "at").agg(F.sum("x").alias("x"))
    out = {d: b.copy() for d, b in books.items()}
    flat = {d: np.zeros((*b.shape[:2], b.shape[2] + 1), np.int64) for d, b in books.items()}
    for r in sums.collect():  # parts * entries * (components + 1) numbers a length
        flat[r["dim"]].reshape(-1)[r["at"]] = r["x"]
    for d, t in flat.items():
        used = t[..., -1] > 0
        out[d][used] = t[used][:, :-1] // t[used][:, -1:]
    return out


def fit(rows: DataFrame, blocks: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    books = _first_books(rows, parts, entries)
    for _ in range(rounds if books else 0):
        books = _next_books(blocks, books)
    return books


def encoded(blocks: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, label, code (array of entries by part), error, codebooks_sha256: one row per vector."""
    label = blocks.schema["labels"].dataType.elementType.simpleString()
    shas = {d: hashlib.sha256(",".join(str(int(c)) for c in b.ravel()).encode()).hexdigest() for d, b in books.items()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, row in enumerate(b.select(["dim", "n", "ids", "ints", "trees"]).to_pylist()):
                n, labels = row["n"], b.column("labels")[i].values
                ids = pa.array(row["ids"], pa.int64())
                if row["trees"] is None:
                    rest = [pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
                else:
                    book = books[row["dim"]]
                    x = np.frombuffer(row["ints"]).reshape(n, len(book), -1)
                    codes = np.column_stack([_owned(x[:, p], t, book[p], True)[2] for p, t in enumerate(row["trees"])])
                    error = sum(((x[:, p] - book[p][codes[:, p]]) ** 2).sum(axis=1) for p in range(len(book)))
                    flat = pa.array(codes.astype(np.int32).ravel())
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, len(book), dtype=np.int32)), flat)
                    rest = [lists, pa.array(error.astype(np.int64)), pa.array([shas[row["dim"]]] * n)]
                yield pa.RecordBatch.from_arrays([ids, labels, *rest], ["vec_id", "label", "code", "error", "codebooks_sha256"])

    return blocks.mapInArrow(each, f"vec_id long, label {label}, code array<int>, error long, codebooks_sha256 string")


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK, leaf: int = LEAF, labels: int = LABELS) -> DataFrame:
    """vec_id, code (array of entries), error, label_error, codebooks_sha256: one row per usable vector."""
    ints = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    rows = embeddings.filter(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", ints.alias("ints"))
    blocks = cut(_blocks(rows, parts, block, leaf))
    out = cut(encoded(blocks, fit(rows, blocks, parts, entries, rounds)))
    sums = cut(out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"))
    few = sums.count() <= labels
    return out.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def digest(embeddings: DataFrame) -> DataFrame:
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return compressed(embeddings).select("vec_id", code.alias("code"), "error", "label_error", "codebooks_sha256")


def _sql_assigned(book: str) -> str:
    away = "list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c)"
    return f"SELECT r, j, any_value(x) AS x, min({{'d': {away}, 'e': e}}) AS s FROM p JOIN {book} USING (j) GROUP BY r, j"


def _sql_next(assigned: str, book: str) -> str:
    return f"""SELECT j, e, coalesce(n.c, b.c) AS c FROM {book} b LEFT JOIN (SELECT j, e, list(m ORDER BY i) AS c FROM
    (SELECT j, s.e AS e, i, floor(sum(x[i]) / count(*)) AS m FROM (SELECT j, s, x, unnest(range(1, len(x) + 1)) AS i FROM {assigned}) GROUP BY j, s.e, i) GROUP BY j, e) n USING (j, e)"""


ORACLE = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT r, j, e[j * (len(e) // {PARTS}) + 1:(j + 1) * (len(e) // {PARTS})] AS x FROM (SELECT r, e, unnest(range(0, {PARTS})) AS j FROM v)),
b0 AS (SELECT j, q.nth AS e, x AS c FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, e) - 1 AS nth FROM v QUALIFY nth < {ENTRIES}) q USING (r)),
a0 AS ({_sql_assigned("b0")}), b1 AS ({_sql_next("a0", "b0")}),
a1 AS ({_sql_assigned("b1")}), b2 AS ({_sql_next("a1", "b1")}),
a2 AS ({_sql_assigned("b2")}),
books AS (SELECT sha256(string_agg(c::BIGINT, ',' ORDER BY j, e, i)) AS codebooks_sha256 FROM (SELECT j, e, unnest(c) AS c, unnest(range(0, len(c))) AS i FROM b2)),
o AS (SELECT r, string_agg(printf('%02x', s.e), '' ORDER BY j) AS code, sum(s.d)::BIGINT AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN o USING (r), books
"""
