"""Quality by co-training of two views.

One classifier sees only a page's text (its words, their shapes, how they repeat), the other only its metadata
(language, source, length, line layout, kinds of characters). In each round either one names the unlabelled documents
it is surest of, and they join the other one's training rows under that label. At the end each view is calibrated on
labelled rows that neither has seen, a logistic blend of the two calibrated views is fitted there, and all documents
are scored.

Features of all documents are computed once, in Spark. In every round all documents that are neither held out nor in the
labelled samples are scored there; histograms of the scores over all of them give the threshold above which a view is
surest. The fits use at most about ``LABELLED`` labelled rows, as many again for calibration, and of the documents above
the thresholds ``NAMED`` for each view and round, chosen by a hash (documented bounds of the fit, which so stays on the
driver at any size). A repeated doc_id is one row of the fit. Scoring covers every whole text.

Defined results: a null or empty text has no words and no lines; null language or source is a value of its own; a null
n_chars is counted from the text; without labels of both kinds every score is the share of label 1 (one half without
labels); rows with one doc_id are separate documents; an empty table gives an empty table; other columns, of any name,
are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.llm.common import cut
from probity.llm.labelled import FOLDS, held_out, labelled, sample

LABELLED = 4000
ROUNDS = 4
#: Of the unlabelled documents, those that either classifier is surest of in a round, and how many of them the fit sees.
SHARE = 0.1
NAMED = 400
#: Bins of the histograms of scores from SURE to 1.
BINS = 1000
#: Least probability of a label that is handed over.
SURE = 0.9
RIDGE = 1e-3
SHAPES, WORDS = 96, 160
LANGS, SOURCES = 8, 32
#: Words whose place a task remembers.
KNOWN = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_SAME = re.compile(r"(.)\1+")


class Views:
    """The two feature vectors of a document."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def place(self, word: str) -> tuple[int, int]:
        """The hash places of a word's shape and of its letters."""
        if len(self.known) > KNOWN:
            self.known.clear()
        shape = _LETTERS.sub(lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "a", _DIGITS.sub("0", word))
        self.known[word] = at = (crc32(_SAME.sub(r"\1", shape).encode()) % SHAPES, crc32(word.lower().encode()) % WORDS)
        return at

    def content(self, text: str) -> np.ndarray:
        words = text.split()
        counts, n = Counter(words), max(1, len(words))
        v = np.zeros(SHAPES + WORDS + 5)
        known = self.known
        for w, c in counts.items():
            s, x = known[w] if w in known else self.place(w)
            v[s] += c
            v[SHAPES + x] += c
        v[: SHAPES + WORDS] = np.sqrt(v[: SHAPES + WORDS] / n)
        again = sum(map(eq, words, words[1:])) / n
        v[-5:] = [len(counts) / n, again, max(counts.values(), default=0) / n, min(20.0, sum(map(len, words)) / n) / 10, np.log1p(len(words)) / 10]
        return v

    def metadata(self, text: str, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
        raw = text.encode("utf-8", "replace")
        kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        lines, size = [x for x in text.split("\n") if x.strip()], max(1, len(raw))
        v = np.zeros(LANGS + SOURCES + 11)
        v[crc32((lang or "").encode()) % LANGS] = 1
        v[LANGS + crc32((source or "").encode()) % SOURCES] = 1
        upper, lower, digit = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
        space = kinds[9:14].sum() + kinds[32]
        plain = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
        v[-11:] = [
            np.log1p(n_chars if n_chars is not None else len(text)) / 10,
            np.log1p(len(lines)) / 5,
            np.log1p(len(text) / max(1, len(lines))) / 5,
            1 - len(set(lines)) / max(1, len(lines)),
            upper / max(1, upper + lower),
            digit / size,
            np.sqrt(plain / size),
            space / size,
            kinds[128:].sum() / size,
            np.sqrt((kinds[124] + kinds[9]) / size),  # table bars and tabs
            np.log1p(text.count("://")),
        ]
        return v


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 30) -> np.ndarray:
    """Weights and bias (last) by Newton's method; ``y`` may be shares."""
    x = np.hstack([x, np.ones((len(x), 1))])
    keep = ridge * len(x) * np.eye(x.shape[1])
    keep[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + keep @ w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + keep, grad)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _sure(x: np.ndarray, w: np.ndarray, label: int) -> np.ndarray:
    """The bin of each row's probability of ``label``; below 0 if it is less than SURE."""
    p = 1 / (1 + np.exp(-logit(x, w)))
    return np.minimum(np.floor(((p if label else 1 - p) - SURE) / (1 - SURE) * BINS), BINS - 1).astype(np.int64)


def threshold(counts: np.ndarray, wanted: int) -> int:
    """The lowest bin from which on at most ``wanted`` rows lie; the highest that has rows, if that alone has more."""
    above = np.cumsum(counts[::-1])[::-1]
    few = np.flatnonzero(above <= wanted)
    first = int(few[0]) if len(few) else len(counts)
    some = np.flatnonzero(counts)
    return min(first, int(some[-1])) if len(some) else len(counts)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.array([np.frombuffer(v, np.float32) for v in column.to_pylist()], np.float64).reshape(-1, width)


class Pool:
    """The unlabelled rows (digest, a, b) of a table of features, scored by Spark in every round."""

    def __init__(self, rows: DataFrame):
        self.rows, self.widths = rows, (SHAPES + WORDS + 5, LANGS + SOURCES + 11)
        self.size = rows.count()

    def _free(self, taken: np.ndarray):
        widths = self.widths

        def each(b: pa.RecordBatch) -> tuple[pa.RecordBatch, list[np.ndarray]]:
            b = b.filter(pa.array(~np.isin(b.column("digest").to_numpy(), taken)))
            return b, [_matrix(b.column(c), w) for c, w in zip("ab", widths, strict=True)]

        return each

    def counts(self, ws: list[np.ndarray], taken: np.ndarray) -> np.ndarray:
        """(view, label, bin): how many rows."""
        free = self._free(taken)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros((2, 2, BINS), np.int64)
            for b in batches:
                _, xs = free(b)
                for k in (0, 1):
                    for label in (0, 1):
                        at = _sure(xs[k], ws[k], label)
                        n[k, label] += np.bincount(at[at >= 0], minlength=BINS)
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n.ravel())), pa.array(n.ravel()[n.ravel() > 0])], ["at", "n"])

        out = np.zeros(4 * BINS, np.int64)
        for r in self.rows.mapInArrow(each, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            out[r["at"]] = r["n"]
        return out.reshape(2, 2, BINS)

    def named(self, ws: list[np.ndarray], taken: np.ndarray, bins: np.ndarray, most: np.ndarray, turn: int) -> list[dict]:
        """Of the rows at or above ``bins`` (view, label) at most ``most``, those with the least hash of this turn."""
        free = self._free(taken)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                b, xs = free(b)
                for k in (0, 1):
                    for label in (0, 1):
                        at = np.flatnonzero(_sure(xs[k], ws[k], label) >= bins[k, label])
                        if len(at):
                            some = b.take(pa.array(at))
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), 2 * k + label, np.int32)), *some.columns], ["who", *some.schema.names])

        found = self.rows.mapInArrow(each, "who int, digest long, a binary, b binary")
        order = Window.partitionBy("who").orderBy(F.xxhash64(F.lit(turn), "digest"), "digest", "a", "b")
        limit = F.element_at(F.array(*(F.lit(int(x)) for x in most.ravel())), F.col("who") + 1)
        # every task hands on at most ``most`` rows of each kind
        return found.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= int(most.max())).filter(F.col("_at") <= limit).drop("_at").toArrow().to_pylist()


def cotrain(a: np.ndarray, b: np.ndarray, y: np.ndarray, pool: Pool, rounds: int = ROUNDS, share: float = SHARE, named: int = NAMED) -> tuple[np.ndarray, np.ndarray]:
    """The weights of the two views' classifiers after ``rounds`` of handing sure labels to each other."""
    xs, ys = [a, b], [y.astype(float)] * 2
    taken, prior = np.zeros(0, np.int64), y.mean()
    parts = np.array([1 - prior, prior])
    most = np.maximum(1, (named * np.vstack([parts, parts])).astype(int))
    ws = [logistic(xs[k], ys[k]) for k in (0, 1)]
    for turn in range(rounds if pool.size else 0):
        counts = pool.counts(ws, taken)
        if not counts.any():
            break
        bins = np.array([[threshold(counts[k, label], int(share * parts[label] * pool.size)) for label in (0, 1)] for k in (0, 1)])
        rows = sorted(pool.named(ws, taken, bins, most, turn), key=lambda r: (r["who"], r["digest"], r["a"], r["b"]))
        for r in rows:
            to = 1 - r["who"] // 2  # to the other view
            xs[to] = np.vstack([xs[to], np.frombuffer(r["ab"[to]], np.float32).astype(float)])
            ys[to] = np.append(ys[to], float(r["who"] % 2))
        taken = np.append(taken, [r["digest"] for r in rows])
        ws = [logistic(xs[k], ys[k]) for k in (0, 1)]
    return ws[0], ws[1]


class Model:
    def __init__(self, content: np.ndarray, metadata: np.ndarray, scales: list[np.ndarray], blend: np.ndarray):
        self.content, self.metadata, self.scales, self.blend = content, metadata, scales, blend

    def scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The blended score and the calibrated scores of the two views."""
        one = logit(logit(a, self.content)[:, None], self.scales[0])
        two = logit(logit(b, self.metadata)[:, None], self.scales[1])
        both = logit(np.column_stack([one, two]), self.blend)
        return tuple(1 / (1 + np.exp(-z)) for z in (both, one, two))


def _features(rows: DataFrame) -> DataFrame:
    """doc_id, kind, digest (64 bits of the row) and the two feature vectors (float32) of each row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views = Views()
        for b in batches:
            texts, rest = [t.as_py() or "" for t in b.column("text")], [b.column(c).to_pylist() for c in ("lang", "source", "n_chars")]
            x = [views.content(t) for t in texts], [views.metadata(t, *m) for t, *m in zip(texts, *rest, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("kind"), b.column("digest"), *(pa.array([f.astype(np.float32).tobytes() for f in v], pa.binary()) for v in x)], ["doc_id", "kind", "digest", "a", "b"])

    return rows.mapInArrow(each, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, kind int, digest long, a binary, b binary")


#: Kinds of rows: learned from (its label), calibrated on (2 and its label), unlabelled, held out.
FREE, HELD_OUT = 4, 5


def prepared(docs: DataFrame, labels: DataFrame, column: str = "quality", most: int = LABELLED) -> tuple[DataFrame, float | None]:
    """The features of all documents, each with its kind, and the share of label 1."""
    known = cut(labelled(labels, column).withColumn("_check", F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 1))
    share = known.agg(F.avg("y")).first()[0]
    some = sample(known.filter("NOT _check"), most).unionByName(sample(known.filter("_check"), most))
    chosen = cut(some.select(F.col("doc_id").alias("_id"), (F.col("y") + F.when(F.col("_check"), 2).otherwise(0)).alias("_kind")))
    mine = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    kind = F.coalesce("_kind", F.when(held_out(F.col("doc_id")), HELD_OUT).otherwise(FREE)).cast("int")
    marked = mine.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left").withColumns({"kind": kind, "digest": F.xxhash64("doc_id", "text", "lang", "source", "n_chars")})
    return cut(_features(marked.drop("_id", "_kind"))), share


def train(features: DataFrame, share: float | None, **rounds) -> Model:
    none = Model(np.zeros(SHAPES + WORDS + 6), np.zeros(LANGS + SOURCES + 12), [np.zeros(2), np.zeros(2)], np.array([0, 0, 0.0 if share is None else 30.0 * (2 * share - 1)]))
    if share in (None, 0.0, 1.0):
        return none
    # one row of each labelled document, so at most as many as were chosen
    each = features.filter(F.col("kind") < FREE).groupBy("doc_id").agg(F.min(F.struct("digest", "kind", "a", "b")).alias("_r")).select("doc_id", "_r.*")
    table = each.toArrow().sort_by("doc_id")
    kind = table["kind"].to_numpy()
    pool = Pool(features.filter(F.col("kind") == FREE).select("digest", "a", "b"))
    a, b = (_matrix(table[c], w) for c, w in zip("ab", pool.widths, strict=True))
    learn, check = kind < 2, (kind == 2) | (kind == 3)
    if len({*kind[learn]}) < 2 or len({*kind[check]}) < 2:
        return none
    wa, wb = cotrain(a[learn], b[learn], kind[learn], pool, **rounds)
    y = (kind[check] - 2).astype(float)
    raw = [logit(a[check], wa), logit(b[check], wb)]
    scales = [logistic(z[:, None], y) for z in raw]
    calm = np.column_stack([logit(z[:, None], s) for z, s in zip(raw, scales, strict=True)])
    return Model(wa, wb, scales, logistic(calm, y))


def scores(docs: DataFrame, labels: DataFrame, column: str = "quality", most: int = LABELLED, **rounds) -> DataFrame:
    """doc_id, held_out, score, predicted, content_score, metadata_score of every document."""
    features, share = prepared(docs, labels, column, most)
    model, widths = train(features, share, **rounds), (SHAPES + WORDS + 5, LANGS + SOURCES + 11)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = model.scores(*(_matrix(b.column(c), w) for c, w in zip("ab", widths, strict=True)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(z) for z in out)], ["doc_id", "score", "content_score", "metadata_score"])

    out = features.select("doc_id", "a", "b").mapInArrow(each, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, content_score double, metadata_score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "content_score", "metadata_score")
