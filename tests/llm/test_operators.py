"""Each operator against a plain version of itself, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import html
import random
import re
import signal
import zlib
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from probity.llm import bpe, ego_join, html_blocks, mixing, quality, secret_scan, simhash, substrings, topk, toxicity
from probity.llm.common import read

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Other columns whose names the operators also use inside.
CLASH = "size int, score double, _row string, _key string, _toxicity int, _text string, fp long, id long, key int, node long, y int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Small frames: three partitions show every exchange, and more only take time."""
    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, was)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, white, long and repeated texts, repeated rows, a null doc_id, and clashing columns."""
    rnd = random.Random(5)
    vocabulary = ["w%d" % i for i in range(400)]
    base = " ".join(rnd.choice(vocabulary) for _ in range(300))
    texts = [None, "", " \t\n ", "one", "one", base, base, base + " more", "Token = 'abcdef12' é AKIA" + "Q" * 16, "x " * 30_000, base.upper(), "a" * 5000]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))) for _ in range(30)]
    rows = [(i, t, None if i % 7 == 3 else "en", [None, "", "a", "b"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base, "en", "a", 3), (None, None, None, None, None)]
    extra = (1, 0.5, "r", "k", 2, "t", 3, 4, 5, 6, 1)
    return spark.createDataFrame([r + extra for r in rows], f"{DOC}, {CLASH}").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# --- mixing


def plain_mix(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(len(words(r["text"])) for r in rows if r["source"] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    full, total = set(), 1.5 * sum(size.values())
    while True:
        rest, w = total - sum(2 * size[s] for s in full), sum(weight[s] for s in sources if s not in full)
        target = {s: 2.0 * size[s] if s in full else rest * weight[s] / w for s in sources}
        over = {s for s in sources if s not in full and target[s] > 2 * size[s]}
        if not over:
            return size, target
        full |= over


def test_mixing(spark, odd, none):
    rows = [r.asDict() for r in odd.collect()]
    size, target = plain_mix(rows)
    got = mixing.mix(odd).collect()
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == sorted(len(words(r["text"])) for r in rows)
    assert sorted(map(tuple, mixing.mix(odd.repartition(5)).collect()), key=str) == sorted(map(tuple, got), key=str)  # reruns agree
    taken = {s: 0 for s in size}
    by_id = {r["doc_id"]: r["source"] for r in rows if r["doc_id"] is not None}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        if r["doc_id"] is not None:
            s = by_id[r["doc_id"]]
            assert r["source_size"] == size[s] and r["target"] == pytest.approx(target[s])
            taken[s] += r["taken"]
    assert sum(r["taken"] for r in got) <= 1.5 * sum(size.values())
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixing_comes_near(spark):
    docs = read(spark, SF, "documents")
    size, target = plain_mix([r.asDict() for r in docs.select("source", "text").collect()])
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    for s in size:
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= 1.5 * max(r["size"] for r in mine)


# --- toxicity


def test_toxicity(spark, odd, none):
    rnd = random.Random(1)
    plain = ["al%d" % i for i in range(200)]
    rows, marks = [], []
    for i in range(600):
        sentences = [" ".join(rnd.choice(plain) for _ in range(8)) for _ in range(rnd.randint(2, 12))]
        if bad := i % 6 == 0:
            sentences[rnd.randrange(len(sentences))] += " " + rnd.choice(["grobfoo", "grobbar", "nastling"])
        rows.append((i, ". ".join(sentences) + ".", "en", "s", 1))
        marks.append((i, 1, int(bad)))
    docs, labels = spark.createDataFrame(rows, DOC), labels_of(spark, marks)
    got = {r["doc_id"]: r for r in toxicity.scores(docs, labels).collect()}
    for (i, text, *_), (_, _, bad) in zip(rows, marks, strict=True):
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5)
        assert r["predicted"] == bad
        if bad:  # the offending sentence is found
            found = [text[s["start"] : s["end"]] for s in r["offending"]]
            assert any("grob" in f or "nastling" in f for f in found)
    model = toxicity.train(docs, labels)
    kept = toxicity.clean(odd, model)
    assert kept.columns == odd.columns and sorted(kept.collect(), key=str) == sorted(odd.collect(), key=str)
    # neither text outside the labels nor labels of held-out documents move a score
    swapped = labels_of(spark, [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marks])
    again = {r["doc_id"]: r["score"] for r in toxicity.scores(docs, swapped).collect()}
    assert all(again[i] == pytest.approx(got[i]["score"], abs=1e-9) for i in got)
    assert toxicity.scores(none, labels_of(spark, [])).count() == 0
    assert {r["score"] for r in toxicity.scores(odd, labels_of(spark, [])).collect()} == {0.0}


def test_noisy_or_of_a_document():
    model = toxicity.Model({"bad": 3.0}, -4.0)
    score, offending = model.score("all is well. this is bad bad. fine")
    p = [1 / (1 + np.exp(4.0)), 1 / (1 + np.exp(-2.0)), 1 / (1 + np.exp(4.0))]
    assert score == pytest.approx(1 - np.prod([1 - x for x in p])) and [(a, b) for a, b, _ in offending] == [(12, 29)]


# --- SimHash


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    k = min(4, len(w))
    h = [xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def test_simhash(spark, odd, none):
    rows = odd.select("doc_id", "text").collect()
    fp = [plain_fingerprint(r["text"]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4]
    root = groups(len(rows), links)
    least = {}
    for r, g in zip(rows, root, strict=True):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, 1 << 60), r["doc_id"])
    want = sorted((str(r["doc_id"]), f"{f:016x}", str(least.get(g))) for r, f, g in zip(rows, fp, root, strict=True))
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash.digest(odd).collect())
    assert got == want
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.digest(none).count() == 0 and simhash.deduplicated(none).count() == 0


@pytest.mark.parametrize("shard", [4096, 7])
def test_shards_of_any_size_miss_no_link(spark, shard):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    fp = [int(x) for x in seeds]
    for s in seeds[:12]:  # dense groups: few bits flipped, again and again
        x = int(s)
        for _ in range(25):
            for b in rng.choice(63, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            fp.append(x)
    fp = sorted(set(fp))
    df = spark.createDataFrame([(x,) for x in fp], "fp long")
    edges = simhash.near(df, shard=shard).collect()
    at = {x: i for i, x in enumerate(fp)}
    want = groups(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4])
    assert groups(len(fp), [(at[e["a"]], at[e["b"]]) for e in edges]) == want


@contextmanager
def ends_within(seconds):
    def stop(*_):
        raise TimeoutError

    was = signal.signal(signal.SIGALRM, stop)
    signal.alarm(seconds)
    try:
        yield
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, was)


def test_unite_of_one_component():
    """All parents end at the root 0, whatever the order in which the links came."""
    with ends_within(20):
        assert simhash.unite(np.array([0, 0, 1]), np.array([1]), np.array([2])).tolist() == [0, 0, 0]
        for n in (3, 4, 9, 64):
            for seed in range(20):
                order = np.random.default_rng(seed).permutation(n)
                assert not simhash.unite(np.arange(n), order[1:], order[:-1]).any()
        fp = np.array([0, 0b1111, 0b11111111, 0b111111111111], np.uint64)
        every = np.ones(4, bool)
        assert simhash.links(fp, np.zeros(4, np.int64), every, every)[1].tolist() == [0, 0, 0]


# --- embeddings

VEC = "vec_id long, embedding array<float>, label int, unit string, node long"


def vectors(rng, n=160, dim=6):
    rows = []
    for i in range(n):
        v = rng.normal(size=dim)
        if i % 3 == 0 and rows:
            v = np.array(rows[rng.integers(0, len(rows))][1]) + rng.normal(size=dim) * 0.15
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3)), "u", 1))
    hot = rows[0][1]
    rows += [(n + k, hot, rows[0][2], "u", 1) for k in range(40)]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1, "u", 1), (501, [0.0] * dim, 1, "u", 1), (502, [nan] * dim, 1, "u", 1), (550, [inf] * dim, 1, "u", 1), (504, [None] * dim, 1, "u", 1), (505, hot, None, "u", 1), (506, [1.0] * 3, 1, "u", 1), (507, [], 1, "u", 1), rows[1], (None, hot, rows[0][2], "u", 1)]
    return rows


def fine(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [512, 5])
def test_embedding_links(spark, block):
    rows = vectors(np.random.default_rng(7))
    df = spark.createDataFrame(rows, VEC).repartition(3)

    def linked(a, b):
        if a[2] is None or a[2] != b[2] or not (fine(a[1]) and fine(b[1])) or len(a[1]) != len(b[1]) or not any(a[1]) or not any(b[1]):
            return False
        x, y = (np.array(r[1], float) for r in (a, b))
        return x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93

    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if linked(rows[i], rows[j])]
    degree = np.bincount([k for p in pairs for k in p], minlength=len(rows))
    root = groups(len(rows), pairs)
    least = {}
    for r, g in zip(rows, root, strict=True):
        if r[0] is not None:
            least[g] = min(least.get(g, 1 << 60), r[0])
    want = sorted((str(r[0]), int(d), str(least.get(g)), r[0] is not None and r[0] == least.get(g)) for r, d, g in zip(rows, degree, root, strict=True))
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in ego_join.classes(df, block=block).collect())
    assert got == want
    assert ego_join.classes(spark.createDataFrame([], VEC)).count() == 0


@pytest.mark.parametrize("angles", [(0, 40, 20), (0, 20, 40), (20, 0, 40)])
def test_a_label_of_three_chained_vectors(spark, angles):
    """A ~ B ~ C, but not A ~ C: one component, its middle with two links."""
    rows = [(i, [float(np.cos(np.deg2rad(a))), float(np.sin(np.deg2rad(a))), 0.0], 1, "u", 1) for i, a in enumerate(angles)]
    with ends_within(120):
        got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in ego_join.classes(spark.createDataFrame(rows, VEC)).collect())
    assert got == [(i, 2 if a == 20 else 1, 0) for i, a in enumerate(angles)]


def test_block_pairs(spark):
    """Two clusters far apart on the leading axes: no pair of their blocks is compared."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        v = rng.normal(size=8) * 0.01
        v[0 if i % 2 else 1] += 1.0
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], 1, 8, 1))
    units = spark.createDataFrame([(i, l, w, d, v) for i, v, l, d, w in rows], "node long, label int, weight long, dim int, unit array<double>")
    eps = float(np.sqrt(0.14))
    blocks = ego_join._sequence(units, ego_join.axes(units), eps, 50, ego_join.LEAD).cache()
    n, pairs = blocks.count(), ego_join.block_pairs(blocks, eps).count()
    blocks.unpersist()
    assert n >= 8 and pairs < n * (n + 1) / 2 * 0.7


def test_topk(spark):
    rows = vectors(np.random.default_rng(9))
    # rows with a query's id are candidates too, its own row is not
    mine = next(r for r in rows if r[0] == 50 and fine(r[1]))
    rows += [mine, mine, (50, [-x for x in mine[1]], *mine[2:])]
    df = spark.createDataFrame(rows, VEC).repartition(3)
    ok = [(r[0], [int(np.floor(256 * float(np.float32(x)))) for x in r[1]]) for r in rows if r[0] is not None and fine(r[1])]
    want = []
    for own, (q, v) in enumerate(ok):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for at, (i, w) in enumerate(ok) if at != own and len(w) == len(v))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    got = sorted(tuple(r) for r in topk.digest(df).select("query_id", "rank", "vec_id", "score").collect())
    assert got == sorted(want)
    assert topk.digest(spark.createDataFrame([], VEC)).count() == 0
    ids = df.selectExpr("vec_id AS id", "embedding AS vector", "monotonically_increasing_id() AS row").checkpoint()
    for sides in ((3, 2), (1, 7)):
        again = topk.search(ids, ids.filter("id % 50 = 0"), sides=sides)
        assert sorted(tuple(r) for r in again.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)


def test_grid():
    """The sides shuffle no more than any others of about as many cells, and never fewer than one cell."""
    for queries, vectors, cells in ((20, 1000, 8), (2_000_000, 100_000_000, 2000), (0, 0, 4), (5, 5, 9), (100, 1, 4), (1, 10**9, 211)):
        rows, columns = topk.grid(queries, vectors, cells)
        assert 1 <= rows * columns <= cells
        least = min(cells / r * queries + r * vectors for r in range(1, cells + 1))
        assert columns * queries + rows * vectors <= 1.3 * least + 1


# --- secrets


def plain_spans(text):
    text, out = text or "", []
    assign = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for k, pattern in enumerate((rf"""{assign}["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "(AKIA[A-Z0-9]+)", "([0-9a-f]+)")):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[1]) >= (6, 20, 24)[k]]
    return sorted(out)


def test_secrets(spark, odd, none):
    live, example = "Zq9" + "aB3xY7" * 6, "Ex4" + "mP1eK9" * 6
    texts = ["é password=hunter22 and\npasswd : 'short'", "token:token:abcdefgh", 'API_KEY = "abc.def-ghi" secret=ab', "AKIA" + "A" * 15, "xAKIA" + "B7" * 8 + "tail", "0123456789abcdef" * 2, "deadbeef" * 2, "secret==abcdef", live, "see " + example, live + " " + live]
    rows = [(100 + i, t, "en", "s%d" % (i % 2), 1) for i, t in enumerate(texts)] + [(200 + i, "see %d " % i + example, "en", "t%d" % i, 1) for i in range(4)]
    docs = spark.createDataFrame(rows, DOC).unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    got = secret_scan.digest(docs).collect()
    text = {r["doc_id"]: r["text"] for r in docs.filter("doc_id is not null").collect()}
    names = ("assign", "access", "hex")
    for r in got:
        if r["doc_id"] is None:
            continue
        base = plain_spans(text[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]
        told = [f"{names[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r["spans"].split(",")) | {""}
        # few owners: live; many: an example
        assert ("token:" in r["spans"]) == (live in (text[r["doc_id"]] or ""))
    assert len(got) == docs.count()
    out = {r["doc_id"]: r for r in secret_scan.redacted(docs).collect() if r["doc_id"] is not None}
    assert out[108]["text"] == "[SECRET]" and out[110]["text"] == "[SECRET] [SECRET]" and out[200]["text"] == "see 0 " + example
    assert out[100]["text"] == "é [SECRET] and\npasswd : 'short'" and out[100]["n_chars"] == len(out[100]["text"]) and out[106]["text"] == "deadbeef" * 2
    same = secret_scan.redacted(odd)
    assert same.columns == odd.columns and same.count() == odd.count()
    assert secret_scan.digest(none).count() == 0 and secret_scan.redacted(none).count() == 0


def test_both_counts_decide(spark):
    """Copies of one text count once; many repositories of two owners are enough."""
    key = lambda c: "sk_live_" + c * 20
    rows = [(i, "the same text " + key("a"), "en", "o%d" % i, 1) for i in range(5)]  # one text of five owners: live
    rows += [(100 + i, "text %d %s" % (i, key("b")), "en", "o%d" % (i % 2), 1) for i in range(40)]  # many texts of two owners: an example
    rows += [(200 + i, "text %d %s" % (i, key("c")), "en", "o1", 1) for i in range(40)]  # many texts of one owner: live
    rows += [(300 + i, "text %d %s" % (i, key("d")), "en", "o%d" % i, 1) for i in range(3)]  # three of three: an example
    rows += [(400 + i, "text %d %s" % (i, key("e")), "en", "o%d" % i, 1) for i in range(2)]  # two of two: live
    docs = spark.createDataFrame(rows, DOC)
    live = {r["doc_id"] // 100: r["n_live"] for r in secret_scan.digest(docs).collect()}
    assert live == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}
    masked = {r["doc_id"]: secret_scan.MASK in r["text"] for r in secret_scan.redacted(docs).collect()}
    assert all(masked[d] == (d // 100 in (0, 2, 4)) for d in masked)


def test_many_matches_in_one_text(spark):
    """Linear in the matches of a text."""
    text = " ".join(("é token = 'Zq%06dxY'" % i if i % 4 == 0 else "%032x" % i) for i in range(32_000))
    docs = spark.createDataFrame([(1, text, "en", "a", len(text)), (2, "none", "en", "a", 4)], DOC)
    with ends_within(60):
        got = {r["doc_id"]: r for r in secret_scan.digest(docs).collect()}
    assert got[1]["n_assign"] == 8000 and got[1]["n_hex"] == 24_000 and got[2]["spans"] == ""
    base = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in plain_spans(text)]
    assert got[1]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
    with ends_within(60):
        out = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}
    assert out == {1: " ".join("é [SECRET]'" if i % 4 == 0 else "[SECRET]" for i in range(32_000)), 2: "none"}


# --- substrings


def plain_removed(rows, window=20):
    seen, out = {}, []
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        for s in range(len(w) - window + 1):
            seen.setdefault(tuple(w[s : s + window]), (d, s))
    for d, w in docs:
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] != (d, s):
                gone[s : s + window] = True
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((str(d), len(w), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def removed(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.digest(df).collect())


def test_substrings(spark, odd, none):
    rng = np.random.default_rng(2)
    base = ["w%d" % i for i in rng.integers(0, 200, 1500)]
    rows = []
    for d in range(50):  # passages, periods and runs
        k, n = rng.integers(0, 1400), rng.integers(0, 120)
        w = base[k : k + n] + ["a"] * int(rng.integers(0, 45)) + "p q r".split() * int(rng.integers(0, 15)) + base[max(0, k - 40) : k - 15]
        rows.append((int(d * 7 % 53), "  ".join(w)))
    rows += [(60, "the same line again and again\n" * 30), (61, "b " * 19), (62, "b " * 20), (63, "b " * 21), (64, "é" * 300 + " " + " ".join(base[:30]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert removed(df) == plain_removed(rows)
    assert removed(odd) == plain_removed([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert substrings.digest(none).count() == 0
    texts = {r["doc_id"]: r["text"] for r in substrings.deduplicated(df).collect()}
    assert hashlib.sha256(texts[60].encode()).hexdigest() == next(r[3] for r in plain_removed(rows) if r[0] == "60")


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id_are_told_apart_by_more_than_32_bits(spark, doc_id):
    stock, other = (" ".join(f"{c}{i}" for i in range(25)) for c in "so")
    rows = [(doc_id, stock + " end"), (doc_id, "w3247 x " + stock), (doc_id, "w95850 x " + other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert df.selectExpr("hash(text) AS h").distinct().count() == 2  # the last two share it
    got = removed(df)
    assert got == plain_removed(rows) and sorted(r[2] for r in got) == [0, 0, 25]


def test_equal_windows_share_a_symbol():
    rng = np.random.default_rng(4)
    stock = [b"%d" % i for i in rng.integers(0, 50, 400)]
    texts = []
    for _ in range(30):
        k = rng.integers(0, 350)
        texts.append(b" ".join([b"x%d" % i for i in rng.integers(0, 9, rng.integers(0, 30))] + stock[k : k + rng.integers(0, 50)] + [b"y"] * int(rng.integers(0, 40))))
    w, of = substrings.words_of(texts)
    assert len(w) == sum(len(t.split()) for t in texts) and len(set(w.tolist())) == len({x for t in texts for x in t.split()})
    s, named = substrings.segments(w, of), {}
    covered = 0
    for symbol, start, count in zip(*s, strict=True):
        for at in range(start, start + count):
            assert named.setdefault(w[at : at + 20].tobytes(), symbol) == symbol
            covered += 1
    assert covered == sum(max(0, len(t.split()) - 19) for t in texts)


# --- BPE


def test_bpe(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_file())
    library.no_truncation()
    library.no_padding()
    rnd = random.Random(8)
    letters = "aabcdeéÉüßΣσςİ'’stremvdl 0123½²  \t\n\x1c\x85\xa0　.,!?$%#~漢字かなनमस्ते😀👍́̀‍"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    texts += ["a" * k for k in range(40)] + ["ab" * k for k in range(20)] + ["x<|endoftext|>Y <|startoftext|>", "<|endoftext|", "it's we'LL"]
    rows = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC).unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((str(r["doc_id"]), len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted((str(r[0]), *r[1:]) for r in bpe.digest(docs).collect()) == sorted(want)
    out = bpe.decoded(bpe.encoded(odd))
    assert out.columns == [*odd.columns, "ids", "decoded"]
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in out.collect())
    assert bpe.digest(none).count() == 0


def test_bpe_guesses_are_verified():
    e = bpe.Encoder(bpe.vocabulary_file())
    rnd = random.Random(3)
    units = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    exact = list(map(list, e.exact(units)))
    guesses = [e.greedy(u) for u in units]
    assert list(map(list, e.pieces(units))) == exact
    assert 0 < sum(g == x for g, x in zip(guesses, exact, strict=True)) < len(units)


# --- quality


def test_quality(spark, odd, none):
    got = {r["doc_id"]: r for r in quality.scores(read(spark, SF.replace("0.001", "0.01"), "documents"), read(spark, SF.replace("0.001", "0.01"), "labels")).collect()}
    marks = {r["doc_id"]: r["quality"] for r in read(spark, SF.replace("0.001", "0.01"), "labels").collect()}
    held = [(got[d]["predicted"], y) for d, y in marks.items() if d in got and got[d]["held_out"]]
    assert sum(p == y for p, y in held) / len(held) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    some = labels_of(spark, [(i, i % 2, 0) for i in range(40)])
    assert quality.scores(odd, some).count() == odd.count()
    assert quality.scores(none, labels_of(spark, [])).count() == 0
    assert {r["score"] for r in quality.scores(odd, labels_of(spark, [])).collect()} == {0.5}


# --- pages


def test_pages_of_the_fixture(spark):
    def plain(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<br>", " ", x).replace("<b>", "")).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        return "\n\n".join(x for x in parts if x)

    pages = read(spark, SF, "pages")
    got = {r["page_id"]: r for r in html_blocks.extracted(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == plain(r["html"]) and got[r["page_id"]]["n_chars"] == len(plain(r["html"])) and got[r["page_id"]]["url"] == r["url"]


LONG = "The cat of the house is in the garden and it was on the mat with an owl. " * 4


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<article><p>a &lt; b &amp;amp; 1 < 2 <a href='x>y'>z</a><script>1<2</p></script> q<!-- x <p> --> r</article>", "a < b &amp; 1 < 2 z q r"),
        ("<nav><ul><li>Menu<article><h1>T</h1><p>x</p><div class=comments>no</div></article>", "T\n\nx"),
        ("<article><p>x</p><section id='comments'><article><p>reader</p></article></section></article><footer>f</footer>", "x"),
        ("<article><p>one&nbsp; two\n three<br>four<p>five</article><aside>side</aside><form>mail</form>", "one two three four\n\nfive"),
        (f"<header>Site</header><h2>Heading</h2><p>{LONG}<p>Short.<p>{LONG}<div class='cookie-notice'>{LONG}</div><footer>f</footer>", f"Heading\n\n{LONG.strip()}\n\nShort.\n\n{LONG.strip()}"),
        (f"<p>{LONG}</p><ul><li><a href=a>all of the news is here</a></li></ul><!-- open <p>{LONG}", LONG.strip()),
        ("<style>p{}", ""),
    ],
)
def test_block_rules(page, text):
    assert html_blocks.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        # good by itself, though outside the article
        (f"<div><p>{LONG}</p><p>Share</p></div><article><p>{LONG}</p></article>", f"{LONG.strip()}\n\n{LONG.strip()}"),
        # between boilerplate on both sides, and so settled by the second pass
        (f"<article><p>{LONG}</p><nav>m</nav><p>Go on</p><nav>m</nav><p>{LONG}</p></article>", f"{LONG.strip()}\n\n{LONG.strip()}"),
        # a block that is all link stays between text, a list of links after it does not
        (f"<article><p>{LONG}</p><p><a href=a>{LONG}</a></p><p>{LONG}</p><ul><li><a href=b>b</a></li></ul></article>", "\n\n".join([LONG.strip()] * 3)),
        (f"<article><h1><a href=a>Title</a></h1><p>{LONG}</p></article>", f"Title\n\n{LONG.strip()}"),
    ],
)
def test_both_passes_on_marked_pages(page, text):
    assert html_blocks.main_text(page) == text


def test_pages_without_their_article_tags(spark):
    """The rules alone find nearly all of the article, and nothing else."""
    whole = kept = 0
    for r in read(spark, SF, "pages").collect():
        want = html_blocks.main_text(r["html"]).split("\n\n")
        got = html_blocks.main_text(re.sub("</?article>", "", r["html"])).split("\n\n")
        assert set(got) <= {*want, ""}
        whole += sum(map(len, want))
        kept += sum(len(x) for x in want if x in got)
    assert kept >= 0.95 * whole


def test_prose_and_languages_without_an_article():
    prose = "Most free software licenses guarantee your freedom to share and change all versions of a program, and make sure it remains available to every user. " * 2
    names = "Smith, Jones, Taylor, Brown, Williams, Wilson, Johnson, Davies, Robinson, Wright, Thompson, Evans, Walker, White, Roberts, Green. " * 2
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, heille on annettu järki ja omatunto. " * 3
    page = "<nav>Menu</nav><p>{}</p><div><a href=a>News today</a></div><p>{}</p><p>{}</p><footer>f</footer>"
    assert html_blocks.main_text(page.format(prose, prose, names)) == f"{prose.strip()}\n\n{prose.strip()}"
    assert html_blocks.main_text(page.format(finnish, finnish, "Lyhyt.")) == f"{finnish.strip()}\n\n{finnish.strip()}\n\nLyhyt."


def test_tags_end_outside_their_quotes():
    inside = "<b>x</b>" * 30 + "</article><nav>"
    assert html_blocks.main_text(f"<article><p data-html='{inside}' title=\"{inside}\">Hello</p><p>there</p></article>") == "Hello\n\nthere"
    assert html_blocks.main_text('<article><p title="open>text</p><p class=it\'s>more</p></article>') == "text\n\nmore"


def test_pages_empty_table(spark):
    kinds = "page_id long, url string, html string, text string, n_chars string"
    assert html_blocks.extracted(spark.createDataFrame([], kinds)).count() == 0
    rows = [(1, None, None, "t", "n"), (None, "u", "<article>x</article>", "t", "n"), (1, None, None, "t", "n")]
    got = sorted((str(r["page_id"]), str(r["url"]), r["text"], r["n_chars"]) for r in html_blocks.extracted(spark.createDataFrame(rows, kinds)).collect())
    assert got == [("1", "None", "", 0), ("1", "None", "", 0), ("None", "u", "x", 1)]


LOREM = "This is the story of what they did when the night was over and of how it came to be that we had to go there with them. " * 3


@pytest.mark.parametrize("page", [
    "<div class='page with-sidebar'><nav>Home</nav><p>{0}</p><p>{0}</p></div>",
    "<div class='page with-sidebar'><article><p>{0}</p><p>{0}</p></article><aside>See also</aside></div>",
    "<article><div class='social-work'><p>{0}</p><p>{0}</p></div></article>",
    "<article><p>{0}</p><section id='share-prices'><p>{0}</p></section></article>",
    "<div class='sidebar'><p>{0}</p><p>{0}</p></div>",
])
def test_names_are_a_prior(page):
    assert html_blocks.main_text(page.format(LOREM)) == f"{LOREM.strip()}\n\n{LOREM.strip()}"


def test_names_that_hold():
    page = "<article><p>{0}</p><p>{0}</p></article><div class='{1}'><p>{0}</p></div>"
    for name in ("sidebar", "related", "comments", "reader-comments", "comment-list", "cookie-notice"):
        assert html_blocks.main_text(page.format(LOREM, name)) == f"{LOREM.strip()}\n\n{LOREM.strip()}", name
    inside = "<article><p>{0}</p><div class='newsletter-box'>Subscribe to our letter and have it sent to you.</div><p>{0}</p></article>"
    assert html_blocks.main_text(inside.format(LOREM)) == f"{LOREM.strip()}\n\n{LOREM.strip()}"


def test_pages_of_short_lines():
    assert html_blocks.main_text("<html><body><p>First line.</p><p>Second line.</p></body></html>") == "First line.\n\nSecond line."
    assert html_blocks.main_text("<nav><a href='/'>Home</a></nav><p>One line.</p><footer>2020</footer>") == "One line."
    assert html_blocks.main_text("<nav><a href='/'>Home</a></nav><footer>2020</footer>") == ""


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "x" + "</section>" * 5_000, "<section><article>" + "<div>" * 20_000 + "x" + "</section>" * 5_000, "<div>" * 40_000 + "x" + "</div>" * 40_000, "<div class='my-ad'>" * 20_000 + "x" + "</p>" * 5_000])
def test_broken_markup_is_linear(page):
    with ends_within(5):
        assert html_blocks.main_text(page) == "x"


# --- learning on bounded rows, plain versions of both fits


def test_a_repeated_id_is_one_row_of_the_fit(spark):
    """20,000 rows of one labelled id: what is learned from stays bounded."""
    from probity.llm.labelled import one_each

    docs = spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(9).cast("long").alias("n_chars"))
    docs = docs.unionByName(spark.range(100, 400).select(F.col("id").alias("doc_id"), F.concat(F.lit("other words "), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(9).cast("long").alias("n_chars")))
    assert one_each(docs).count() == 301
    least = min(hashlib.md5(f"text {i}".encode()).hexdigest() for i in range(20_000))
    assert [hashlib.md5(r["text"].encode()).hexdigest() for r in one_each(docs.filter("doc_id = 3")).collect()] == [least]
    labels = labels_of(spark, [(3, 1, 1)] + [(i, i % 2, i % 2) for i in range(100, 400)])
    assert toxicity.scores(docs, labels, most=20).count() == quality.scores(docs, labels, most=20).count() == 20_300


def test_cotraining_against_a_plain_version(spark):
    """The same rounds on whole arrays in memory."""
    rnd = np.random.default_rng(4)
    wide, narrow = quality.SHAPES + quality.WORDS + 5, quality.LANGS + quality.SOURCES + 11
    y = np.arange(90) % 2
    signal = lambda n, lab: (rnd.normal(0, 1, (len(lab), n)) * 0.4 + np.where(lab, 1, -1)[:, None] * (np.arange(n) < 6)).astype(np.float32)
    a, b, truth = signal(wide, y), signal(narrow, y), rnd.integers(0, 2, 500)
    pa_, pb_ = signal(wide, truth), signal(narrow, truth)
    rows = [(i, pa_[i].tobytes(), pb_[i].tobytes()) for i in range(500)]
    pool = quality.Pool(spark.createDataFrame([(i, bytearray(u), bytearray(v)) for i, u, v in rows], "digest long, a binary, b binary").repartition(3))
    got = quality.cotrain(a.astype(float), b.astype(float), y, pool, rounds=3, share=0.1, named=10_000)
    xs, ys, pools, free = [a.astype(float), b.astype(float)], [y.astype(float)] * 2, [pa_.astype(float), pb_.astype(float)], np.ones(500, bool)
    for _ in range(3):
        ws = [quality.logistic(xs[k], ys[k]) for k in (0, 1)]
        handed = []
        for k in (0, 1):
            for label in (0, 1):
                p = 1 / (1 + np.exp(-np.clip(pools[k] @ ws[k][:-1] + ws[k][-1], -30, 30)))
                p = p if label else 1 - p
                bins = np.minimum(np.floor((p - quality.SURE) / (1 - quality.SURE) * quality.BINS), quality.BINS - 1)
                bins[~free] = -1
                wanted = int(0.1 * (y == label).mean() * 500)
                edges = [t for t in range(quality.BINS) if (bins >= t).sum() <= wanted]
                low = min(edges[0] if edges else quality.BINS, bins.max()) if (bins >= 0).any() else quality.BINS
                handed.append((1 - k, np.flatnonzero(bins >= low), label))
        for to, at, label in handed:
            xs[to], ys[to] = np.vstack([xs[to], pools[to][at]]), np.append(ys[to], np.full(len(at), float(label)))
            free[at] = False
    want = [quality.logistic(xs[k], ys[k]) for k in (0, 1)]
    assert (~free).sum() > 20
    for g, w in zip(got, want, strict=True):
        assert np.allclose(g, w, atol=1e-6)


def test_noisy_or_against_a_plain_gradient():
    """The fit's loss at its end is near the best of a plain search from several starts."""
    rnd = np.random.default_rng(2)
    size, y, doc, sent, feat, empty = 6, [], [], [], [], []
    for d in range(120):
        bags = [sorted(set(rnd.integers(0, size, rnd.integers(1, 4)).tolist())) for _ in range(rnd.integers(1, 5))]
        y.append(float(any(0 in bag for bag in bags)) if rnd.random() < 0.95 else float(rnd.integers(0, 2)))
        empty.append(float(rnd.integers(0, 2)))
        for bag in bags:
            doc.append(d)
            sent += [len(doc) - 1] * len(bag)
            feat += bag
    y, doc, empty, sent, feat = np.array(y), np.array(doc), np.array(empty), np.array(sent), np.array(feat)
    weight = np.ones(len(y))

    def loss(w, bias):
        a = np.array([sum(w[f] for f in feat[sent == s]) + bias for s in range(len(doc))])
        total = 0.0
        for d in range(len(y)):
            calm = sum(np.log1p(np.exp(a[s])) for s in np.flatnonzero(doc == d)) + empty[d] * np.log1p(np.exp(bias))
            total += -np.log(max(1e-300, -np.expm1(-calm))) if y[d] else calm
        return total / len(y)

    w, bias = toxicity.fit(y, doc, empty, sent, feat, size, weight, steps=600)
    here = loss(w, bias)
    for i in range(size):
        for step in (-0.3, 0.3):
            v = w.copy()
            v[i] += step
            assert loss(v, bias) > here - 1e-3
    assert loss(w, bias + 0.3) > here - 1e-3 and loss(w, bias - 0.3) > here - 1e-3 and w[0] > max(w[1:]) + 1


# --- components


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_components_in_rounds_and_at_once(spark, few):
    from probity.llm.components import components

    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    met = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(3), few).collect()
    assert {r["node"]: r["component"] for r in got} == {x: root[x] for x in met} and len(got) == len(met)
    assert components(spark.createDataFrame([(1, 1)], "a long, b long"), few).collect() == []


def test_simhash_keeps_a_defined_row_of_equal_ones(spark):
    """Rows that share doc_id and text: the one whose other columns come first, however the rows are dealt; types of any kind."""
    rows = [(7, "a b c d e f g", s, {"k": i % 3}, bytes([i % 5]), i % 4 or None) for i, s in enumerate(["x", None, "b", "c", "b"] * 60)]
    rows += [(9, "a b c d e f g", "a", {}, b"", 1), (8, "quite another text of some words here", None, None, None, None)]
    kind = "doc_id long, text string, source string, `_row` map<string, int>, `_mine` binary, `_n` int"
    seen = set()
    for parts in (1, 5):
        df = spark.createDataFrame(rows[::-1] if parts == 1 else rows, kind).repartition(parts)
        out = simhash.deduplicated(df)
        assert out.columns == df.columns
        seen.add(tuple(sorted(map(str, out.collect()))))
    assert len(seen) == 1
    first, second = sorted(out.collect(), key=lambda r: r["doc_id"])
    want = min((r for r in rows if r[0] == 7 and r[2] == "b"), key=lambda r: (f"{{k -> {r[3]['k']}}}", r[4], r[5] is None, str(r[5])))
    assert tuple(first) == want and tuple(second) == rows[-1]
