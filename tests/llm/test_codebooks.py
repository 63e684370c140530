"""Vector compression against a plain version; trees against points."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from probity.llm import codebooks

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, sha) of each usable row; vectors of one length."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    d = len(kept[0][1]) // parts
    x = np.array([k[1] for k in kept], np.int64).reshape(len(kept), parts, d)
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [x[first, p] for p in range(parts)]

    def near(p):
        away = ((x[:, p, None] - books[p][None]) ** 2).sum(axis=2)
        return away.argmin(axis=1), away.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            code, _ = near(p)
            books[p] = np.array([x[code == e, p].sum(axis=0) // (code == e).sum() if (code == e).any() else books[p][e] for e in range(len(first))])
    codes, errors = zip(*map(near, range(parts)), strict=True)
    error = sum(errors)
    by_label = {}
    for (_, _, lab), e in zip(kept, error, strict=True):
        by_label[lab] = by_label.get(lab, 0) + int(e)
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((k[0], "".join(f"{c[i]:02x}" for c in codes), int(error[i]), by_label[k[2]], sha) for i, k in enumerate(kept)), key=str)


def rows_of(n, dim=32, seed=0, spread=0.3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, spread, (7, dim))
    return [(i, (centres[i % 7] + rnd.normal(0, 0.05, dim)).astype(np.float32).tolist(), [None, 0, 1, 2][i % 4]) for i in range(n)]


def digest(df):
    return sorted((tuple(r) for r in codebooks.digest(df).collect()), key=str)


def test_against_plain(spark):
    rows = rows_of(600)
    rows += [(7, rows[3][1], 5), (None, rows[9][1], None), (None, rows[8][1], 1), (1000, None, 1), (1001, [None] * 32, 1), (1002, [float("nan")] * 32, 1), (1003, [float("inf")] * 32, None)]
    rows += [(2000 + i, rows[0][1], 1) for i in range(300)]  # a third are one vector
    assert digest(spark.createDataFrame(rows, ROWS).repartition(4)) == plain(rows)


@pytest.mark.parametrize("n", [1, 5, 64, 65])
def test_few_vectors(spark, n):
    rows = rows_of(n, dim=16, spread=3.0)
    assert digest(spark.createDataFrame(rows, ROWS)) == plain(rows)


def test_small_blocks_and_leaves_change_nothing(spark):
    rows = rows_of(500, seed=2)
    df = spark.createDataFrame(rows, ROWS)
    code = lambda **k: sorted((r["vec_id"], tuple(r["code"]), r["error"], r["label_error"]) for r in codebooks.compressed(df, **k).collect())
    assert code() == code(block=37, leaf=3) == code(labels=0)


def test_odd_lengths_empty_and_clashing_columns(spark):
    rows = rows_of(80, dim=16) + [(500, [0.5] * 10, 1), (501, [], 1)]
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("z") for c in ("dim", "ints", "code", "error", "n", "_label", "at")})
    got = {r["vec_id"]: r for r in codebooks.digest(df).collect()}
    assert len(got) == 82 and all(got[i]["code"] is None and got[i]["error"] is None and got[i]["label_error"] is not None for i in (500, 501))
    assert sorted((tuple(r) for i, r in got.items() if i < 500), key=str) == plain(rows[:80])
    both = rows_of(40, dim=16) + [(i + 100, v, lab) for i, v, lab in rows_of(50, dim=32)]
    shas = {r["codebooks_sha256"] for r in codebooks.digest(spark.createDataFrame(both, ROWS)).collect()}
    assert shas == {plain(rows_of(40, dim=16))[0][4], plain(rows_of(50, dim=32))[0][4]}
    assert codebooks.digest(spark.createDataFrame([], ROWS)).collect() == []


@pytest.mark.parametrize("kind", ["clusters", "line", "equal", "grid"])
def test_trees(kind):
    rnd = np.random.default_rng(3)
    x = {
        "clusters": rnd.normal(0, 1, (900, 4)) + rnd.integers(0, 5, (900, 1)) * 300,
        "line": np.arange(500)[:, None] * np.array([[1, 2, 0, 0]]),
        "equal": np.ones((400, 4)),
        "grid": rnd.integers(0, 2, (700, 4)),
    }[kind]
    x = np.floor(x).astype(np.float64)
    tree = codebooks.Tree(x, leaf=10)
    assert sorted(tree.order) == list(range(len(x)))
    for i in range(len(tree.count)):
        mine = x[tree.order[tree.start[i] : tree.end[i]]]
        assert len(mine) == tree.count[i] and (mine.sum(axis=0) == tree.sum[i]).all()
        assert np.sqrt(((mine - tree.centre[i]) ** 2).sum(axis=1)).max() <= tree.radius[i] * (1 + 1e-12) + 1e-12
    book = np.vstack([x[rnd.choice(len(x), 20)], x[:1], x[:1]])  # equal entries: ties
    sums, counts, code = codebooks._owned(x, tree.packed(), book, True)
    want = ((x[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (code == want).all() and (counts == np.bincount(want, minlength=len(book))).all()
    assert (sums == np.array([x[want == e].sum(axis=0) for e in range(len(book))])).all()
