"""The pipeline stage by stage against plain versions, and the registered queries without SQL."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from probity.llm import bpe, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Queries that SQL does not express, and the tests that hold them against brute force.
WITHOUT_SQL = {
    "op2_toxicity": ("test_operators.py", "test_noisy_or_against_a_plain_gradient"),
    "op3_simhash": ("test_operators.py", "test_simhash"),
    "op8_bpe": ("test_operators.py", "test_bpe"),
    "op9_quality": ("test_operators.py", "test_cotraining_against_a_plain_version"),
    "op10_html": ("test_operators.py", "test_names_are_a_prior"),
    "pipeline": ("test_pipeline.py", "test_stages_against_plain_versions"),
}


def test_queries_without_sql_have_tests():
    mine = {n for n in E.queries() if n == "pipeline" or n.startswith("op")}
    assert mine - set(E.oracle_sql()) == set(WITHOUT_SQL)
    for file, test in WITHOUT_SQL.values():
        with open(os.path.join(os.path.dirname(__file__), file)) as f:
            assert f"def {test}" in f.read(), test


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with toxic documents, copies, secrets, nulls, repeated rows and clashing columns."""
    rnd = random.Random(11)
    words = ["w%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(240):
        toxic = i % 6 == 0
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(20, 60))) + "."
        if toxic:
            text += " You are a horrid vile stinker."
        if i % 10 == 3:
            text += " password = 'hunter%05d'" % i
        rows.append((i, text, "en", "s%d" % (i % 3), len(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(500 + i, rows[1][1], "en", "s1", 1) for i in range(5)]  # exact copies
    rows += [(600, rows[2][1] + " once more", "en", None, 1), (700, None, None, None, None), (701, "", "en", "s0", 0), (702, "one", "en", "s0", 3)]
    rows += [rows[7], rows[7], (None, "no id at all here", "en", "s2", 5)]
    out = str(tmp_path_factory.mktemp("corpus"))
    clash = {c: F.lit("z") for c in ("_row", "_key", "size", "score", "fp", "row_key", "_toxicity")}
    spark.createDataFrame(rows, DOC).withColumns(clash).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    if not shingles:
        return 0
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_stages_against_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in docs.collect()]
        stage(spark, docs, folder).write.mode("overwrite").parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
        seen[name] = (before, [r.asDict() for r in docs.collect()])
        assert docs.columns == columns or name == "bpe"
    key = lambda r: tuple(str(v) for v in r.values())

    before, after = seen["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert sorted(map(key, after)) == sorted(key(r) for r in before if model.score(r["text"])[0] < 0.5)
    bad = {r["doc_id"] for r in before if r["text"] and "stinker" in r["text"]}
    assert bad and not bad & {r["doc_id"] for r in after} and len(after) == len(before) - sum(r["doc_id"] in bad for r in before)

    before, after = seen["simhash"]
    prints = [plain_fingerprint(r["text"]) for r in before]
    group = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    kept = {prints[i] for i in range(len(before))}
    assert len(after) == len(set(group)) and all(key(r) in set(map(key, before)) for r in after)
    of = {key(r): group[i] for i, r in enumerate(before)}
    assert len({of[key(r)] for r in after}) == len(after) and kept

    before, after = seen["secrets"]
    assert len(after) == len(before)
    new = {r["doc_id"]: r["text"] for r in after}
    for r in before:
        if r["text"] and "password" in r["text"]:
            assert new[r["doc_id"]] == re.sub(r"password = 'hunter\d+", "[SECRET]", r["text"])
        elif r["doc_id"] is not None:
            assert new[r["doc_id"]] == r["text"]

    before, after = seen["mixing"]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    total = sum(map(size, before))
    copies = {}
    for r in after:
        copies[key(r)] = copies.get(key(r), 0) + 1
    assert set(copies) <= set(map(key, before)) and max(copies.values()) <= 2
    sources = {r["source"] for r in before}
    ranked = sorted(s for s in sources if s is not None) + ([None] if None in sources else [])
    own = {s: sum(size(r) for r in before if r["source"] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(ranked)}
    target, full = {}, set()
    while True:
        rest, w = 1.5 * total - sum(2 * own[s] for s in full), sum(weight[s] for s in sources - full)
        target = {s: 2.0 * own[s] if s in full else rest * weight[s] / w for s in sources}
        more = {s for s in sources - full if target[s] > 2 * own[s]}
        if not more or not sources - full - more:
            break
        full |= more
    longest = max(map(size, before))
    for s in sources:
        took = sum(size(r) for r in after if r["source"] == s)
        assert abs(took - min(target[s], 2.0 * own[s])) <= 2 * longest + 2, s

    before, after = seen["bpe"]
    coder = tokenizers.Tokenizer.from_file(bpe.path() if hasattr(bpe, "path") else _vocabulary())
    coder.no_truncation()
    coder.no_padding()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in before:
        ids = coder.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((str(r["doc_id"]), len(ids), sha(" ".join(map(str, ids))), sha(coder.decode(ids, skip_special_tokens=False))))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after) == sorted(want)
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, (tuple(r.asDict().values()) for r in again))) == sorted(str(tuple(r.values())) for r in after)


def _vocabulary():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
