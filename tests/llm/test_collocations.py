"""Phrase mining against a plain version, with hashes that collide and chunks of a few words."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from probity.llm import collocations as mining

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain(docs, threshold):
    """{(lang, phrase): (a, l, r, n, score)}"""
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in (1, 2, 3, 4):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    out = {}
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    for (lang, p), a in cands.items():
        cut = lambda k: (int(Fraction(2_000_000 * a, f[lang, p[:k]] + f[lang, p[k:]])), k)  # noqa: E731, B023
        score, k = min(map(cut, range(1, len(p))))
        held = any(x == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (x, q), b in cands.items())
        if not held:
            out[lang, " ".join(p)] = (a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)
    return out


def texts(seed, n, vocabulary):
    rnd = random.Random(seed)
    ws = ["w%d" % i for i in range(vocabulary)] + ["New", "YORK", "é", "x y", "a\x0bb", "tab\tbed"]
    marks = [" "] * 12 + [", ", ".", "\n", "  ", "\t", "! ", "\r\n"]
    phrase = "New York City hall"
    rows = []
    for i in range(n):
        t = "".join(rnd.choice(ws) + rnd.choice(marks) for _ in range(rnd.randint(0, 80)))
        if rnd.random() < 0.4:
            t += " " + phrase
        rows.append((i, t, rnd.choice(["en", "de", None, "und"]), "s", len(t)))
    return rows + [(None, None, None, None, None), (1, "", "en", "s", 0), rows[0], rows[0]]


def found(df, threshold, **sizes):
    return {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in mining.collocations(df, threshold, **sizes).collect()}


@pytest.mark.parametrize("sizes", [{}, {"chunk": 50, "mass": 500}, {"chunk": 30, "mass": 2000, "spare": -20}])
def test_against_plain(spark, sizes):
    docs = texts(4, 60, 12)
    got = found(spark.createDataFrame(docs, DOC).repartition(2), 5, **sizes)
    assert got and got == plain(docs, 5)


def test_a_text_longer_than_a_chunk(spark):
    docs = [(1, "a b c " * 500 + ". " + "d e. " * 300, "en", "s", 1), (2, "a b c", "en", "s", 1)]
    assert found(spark.createDataFrame(docs, DOC), 30, chunk=100, mass=1000) == plain(docs, 30)


def test_hot_phrase_and_empty(spark):
    hot = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("the very same words").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    # every shorter phrase is inside the longest
    assert found(hot, 30) == {("en", "the very same words"): (9000, 9000, 9000, 36000, 1_000_000)}
    assert mining.digest(spark.createDataFrame([], DOC)).collect() == []


def test_ranks_and_clashing_columns(spark):
    docs = texts(9, 80, 3)
    df = spark.createDataFrame(docs, DOC).withColumns({c: F.lit("z") for c in ("chunk", "codes", "phrase", "a", "l", "r", "n", "score", "words")})
    rows = mining.digest(df, top=3).collect()
    want = plain(docs, 30)
    for lang in {k[0] for k in want}:
        best = sorted(((-v[4], -v[0], p.encode()), p) for (x, p), v in want.items() if x == lang)[:3]
        assert [r["phrase"] for r in sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["rank"])] == [p for _, p in best]


def test_scores_beyond_64_bits(spark):
    a = 1 << 50
    row = spark.createDataFrame([(a, a, a + 1)], "a long, l long, r long")
    got = row.select(F.expr("cast(2000000 as decimal(18, 0)) * cast(a as decimal(19, 0)) div cast(l + r as decimal(19, 0))")).first()[0]
    assert got == 2_000_000 * a // (2 * a + 1)


def test_every_frequent_key_survives():
    rnd = np.random.default_rng(1)
    keys = np.minimum(rnd.zipf(1.3, 40_000), 5000).astype(np.uint64)
    for _ in range(3):
        rnd.shuffle(keys)
        threshold = 30
        s = mining.Summary(len(keys) // threshold + 1)
        for part in np.array_split(keys, 50):
            s.add(*np.unique(part, return_counts=True))
            s.settle()
        assert len(s.survivors()) <= s.capacity
        u, n = np.unique(keys, return_counts=True)
        assert set(u[n >= threshold]) <= set(s.survivors())


def test_bundles_round_trip():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 47, 1000).astype(np.uint64))
    counts = np.arange(len(keys)) * 1000
    back = mining._unbundle(len(keys), mining._bundle(keys, counts))
    assert (back[0] == keys).all() and (back[1] == counts).all()
