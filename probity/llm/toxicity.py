"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score of its words and word beginnings; a document's
score is the noisy-or of its sentences', 1 - prod(1 - p). Only documents have labels: the gradient of the document's
likelihood reaches the sentences through the noisy-or, so the model learns which sentences make a document toxic, and
scoring names them.

Learned from a sample of at most about ``TRAIN`` labelled documents (a bound, so the model fits the driver at any size)
with the ``VOCABULARY`` features that tell the labels apart best, counted in Spark. Scoring covers every whole text.

Defined results: a null or empty text is one sentence without words; without labels of both kinds every score is the
share of label 1 (0 without labels); rows with one doc_id are separate documents; an empty table gives an empty table;
other columns of any name stay as they are in ``flagged`` and ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.common import cut
from probity.llm.labelled import held_out, labelled, one_each, sample

TRAIN = 8000
VOCABULARY = 4096
MIN_DOCUMENTS = 3
#: Least z value of a feature's log odds between the labels.
LEAST_Z = 2.5
STEPS = 500
#: Letters of a word that count as its beginning.
STEM = 5
#: Words whose weight a task remembers.
KNOWN = 500_000
SENTENCE = re.compile(r"[.!?\n]+")
TOKEN = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences that hold anything but white space; one, empty, if there are none."""
    at, out = 0, []
    for m in SENTENCE.finditer(text):
        out.append((at, m.end()))
        at = m.end()
    out.append((at, len(text)))
    return [(a, b) for a, b in out if text[a:b].strip()] or [(0, 0)]


def features(word: str) -> list[str]:
    return [word, word[:STEM] + "*"] if len(word) >= STEM else [word]


def _counts(train: DataFrame) -> DataFrame:
    """feature, pos, neg: documents of either label that hold it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: dict[str, list[int]] = {}
            for text, y in zip(b.column("text"), b.column("y"), strict=True):
                for f in {f for w in set(TOKEN.findall((text.as_py() or "").lower())) for f in features(w)}:
                    n.setdefault(f, [0, 0])[y.as_py()] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), *(pa.array([c[i] for c in n.values()], pa.int64()) for i in (1, 0))], ["feature", "pos", "neg"])

    some = train.mapInArrow(each, "feature string, pos long, neg long")
    return some.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _bags(train: DataFrame, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the sample: labels; the document of each sentence; sentences without features by document; and of each
    (sentence, feature) the two indices."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text"):
                text = (text.as_py() or "").lower()
                bags, empty = [], 0
                for a, z in sentences(text):
                    bag = sorted({i for w in TOKEN.findall(text[a:z]) for f in features(w) if (i := index.get(f)) is not None})
                    empty += not bag
                    bags += [bag] if bag else []
                out.append((bags, empty))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([x[0] for x in out], pa.list_(pa.list_(pa.int32()))), pa.array([x[1] for x in out], pa.int64())], ["doc_id", "y", "bags", "empty"])

    rows = train.mapInArrow(each, f"doc_id {train.schema['doc_id'].dataType.simpleString()}, y int, bags array<array<int>>, empty long").toArrow()
    rows = rows.sort_by("doc_id")
    y, empty = rows["y"].to_numpy().astype(float), rows["empty"].to_numpy().astype(float)
    doc, sent, feat, n = [], [], [], 0
    for d, bags in enumerate(rows["bags"].to_pylist()):
        for bag in bags:
            doc.append(d)
            sent.append(np.full(len(bag), n))
            feat.append(np.array(bag))
            n += 1
    join = lambda x: np.concatenate([np.zeros(0, int), *x])
    return y, np.array(doc, int), empty, join(sent), join(feat)


def fit(y, doc, empty, sent, feat, size: int, weight: np.ndarray, steps: int = STEPS, rate: float = 0.1, ridge: float = 1e-6) -> tuple[np.ndarray, float]:
    """Feature weights and bias by Adam on the noisy-or likelihood of the documents."""
    w = np.append(np.zeros(size), -3.0)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        a = np.bincount(sent, w[feat], len(doc)) + w[-1]
        calm = np.logaddexp(0, a)  # -log(1 - p) of a sentence
        total = np.bincount(doc, calm, len(y)) + empty * np.logaddexp(0, w[-1])
        g = weight * np.where(y > 0, -1 / np.maximum(np.expm1(np.minimum(total, 500)), 1e-12), 1.0)
        by = g[doc] / (1 + np.exp(-a))
        grad = np.append(np.bincount(feat, by[sent], size) + ridge * weight.sum() * w[:-1], by.sum() + (g * empty).sum() / (1 + np.exp(-w[-1]))) / weight.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


class Model:
    """Weights of words and word beginnings, and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.known = weights, bias, {}

    def word(self, w: str) -> float:
        if len(self.known) > KNOWN:
            self.known.clear()
        self.known[w] = x = sum(self.weights.get(f, 0.0) for f in features(w))
        return x

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and (start, end, score) of its offending sentences: those of at least one half."""
        text = text or ""
        low = text.lower()
        if len(low) != len(text):  # a letter whose small form is longer: places must hold
            low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        spans, known, total, bad = sentences(text), self.known, 0.0, []
        sums = np.array([sum(known[w] if w in known else self.word(w) for w in TOKEN.findall(low, a, b)) for a, b in spans]) + self.bias
        total = float(np.logaddexp(0, sums).sum())
        for i in np.flatnonzero(sums >= 0):
            bad.append((*spans[i], float(1 / (1 + np.exp(-sums[i])))))
        return float(-np.expm1(-total)), bad


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", most: int = TRAIN, vocabulary: int = VOCABULARY) -> Model:
    known = cut(labelled(labels, column))
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        share = 1.0 - 1e-9 if shares.get(1) else 0.0
        return Model({}, float(np.log(share / (1 - share))) if share else -1000.0)
    # half of the sample of either label, so that a rare one is seen; the weights below restore their shares
    some = [sample(known.filter(F.col("y") == y), most // 2) for y in (0, 1)]
    chosen = cut(some[0].unionByName(some[1]).withColumnRenamed("doc_id", "_id"))
    text = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "y")
    text = cut(one_each(text))
    n = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count("*").alias("n")).collect()}
    gap = F.log((F.col("pos") + 0.5) / (n[1] + 1.0)) - F.log((F.col("neg") + 0.5) / (n[0] + 1.0))
    z = F.abs(gap) / F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    best = _counts(text).filter(F.col("pos") + F.col("neg") >= MIN_DOCUMENTS).select("feature", z.alias("z")).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(vocabulary).collect()
    index = {r["feature"]: i for i, r in enumerate(best)}
    y, doc, empty, sent, feat = _bags(text, index)
    if not len(y):
        return Model({}, -1000.0)
    weight = np.where(y > 0, shares[1] / max(1, (y > 0).sum()), shares[0] / max(1, (y <= 0).sum()))
    w, bias = fit(y, doc, empty, sent, feat, len(index), weight)
    return Model({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4}, bias)


def flagged(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a struct column ``_toxicity``: score, and offending (start, end, score; code points)."""

    @F.pandas_udf("struct<score:double,offending:array<struct<start:int,end:int,score:double>>>")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            rows = [model.score(t) for t in texts]
            yield pd.DataFrame({"score": [r[0] for r in rows], "offending": [[{"start": a, "end": b, "score": s} for a, b, s in r[1]] for r in rows]})

    return docs.withColumn("_toxicity", judge(F.col("text")))


def scores(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """doc_id, held_out, score, predicted, offending."""
    out = flagged(docs.select("doc_id", "text"), train(docs, labels, **params))
    score = F.col("_toxicity.score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.col("_toxicity.offending").alias("offending"))


def clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents that score less than ``limit``, with the columns of ``docs``."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text")
    return flagged(rows, model).filter(F.col("_toxicity.score") < limit).select("_row.*")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """And where the offending sentences are: start:end, comma-joined, in code points, end exclusive."""
    spans = F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scores(docs, labels).select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"), spans.alias("offending"))
