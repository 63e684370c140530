"""Substring deduplication by recompression.

A window is ``WINDOW`` consecutive words. A word goes if a window over it repeats one that starts earlier.

Recompression parses every text the same way wherever the same words stand. In each round a coin, tossed by a symbol's
name, sends it left or right, and a left symbol followed by a right one becomes a pair. A pair's name is a hash of its
parts' names, so a name is global: all tasks give it to equal words without asking each other. Runs of one symbol are
named too, by symbol and length. Every symbol knows its context, the words that decide that it is there; equal words
have equal symbols wherever the context is inside them.

Each window is filed under the highest symbol whose context it holds (of several, the least name), by the symbol's
name and the words of the context. Equal windows so share a symbol, and neighbouring windows that share one form a segment. One row per segment is shuffled, about one for
every six words, instead of one per window. Segments equal to an earlier one are settled at once. Only where a symbol
stands in different segments are windows compared one by one, by 128-bit hashes of their words.

Frequent symbols: a task hands on each segment, and each window, once for a batch of documents, whatever it holds of
it, so that a passage in a third of all documents costs a row a batch and not a row a document.

Defined results: a null or empty text has no words; fewer words than a window are all kept; a null doc_id sorts first;
rows with one doc_id are one document for the order (equal starts are not earlier) and have a result each; an empty
table gives an empty table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 20
ROUNDS = 4
#: Bytes of text that are parsed at once; a longer text is parsed alone.
CHUNK = 1 << 21
#: Bytes of a word that are hashed with others' at once; the rest of a longer word is hashed by itself.
WORD_BYTES = 48
NO_ID = -(1 << 63)
#: What names a row: its doc_id and 128 bits of its text, for many rows may share a doc_id or have none.
NAMES = ["id", "key", "more"]

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_U = np.uint64
_BASE = (_U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95))
_ALL = (1 << 64) - 1
_NONE = _U(_ALL)
#: Low bits of a window's best symbol that hold its place.
_PLACE = _U(40)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of ``texts``, and the index of each one's text."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = ~_SPACE[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = end - start
    short = np.minimum(size, WORD_BYTES)
    order = np.argsort(-short.astype(np.int8), kind="stable")
    at, h = start[order], np.zeros(len(start), np.uint64)
    more = np.searchsorted(-short[order], -np.arange(WORD_BYTES), side="left")  # words longer than j
    for j in range(WORD_BYTES):
        if not more[j]:
            break
        h[: more[j]] = h[: more[j]] * _U(0x100000001B3) + raw[at[: more[j]] + j] + _U(1)
    out = np.empty_like(h)
    out[order] = h
    out = mix(out ^ (size.astype(np.uint64) << _U(48)))
    for i in np.flatnonzero(size > WORD_BYTES):
        out[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    last = np.cumsum([len(t) + 1 for t in texts])
    return out, np.searchsorted(last, start, side="right")


class Powers:
    """Polynomial hashes of runs of words, modulo 2**64."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64)] * 2
        self.down = list(self.up)

    def prefix(self, words: np.ndarray, k: int) -> np.ndarray:
        n = len(words) + 1
        if len(self.up[k]) < n:
            inverse = _U(pow(int(_BASE[k]), -1, 1 << 64))
            self.up[k] = np.multiply.accumulate(np.append(_U(1), np.full(n, _BASE[k])))
            self.down[k] = np.multiply.accumulate(np.append(_U(1), np.full(n, inverse)))
        return np.append(_U(0), np.cumsum((words ^ _U(k)) * self.up[k][: n - 1]))

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[k][start] + (end - start).astype(np.uint64))


class Segments(NamedTuple):
    """Neighbouring windows under one symbol: symbol, first window, their number."""

    symbol: np.ndarray
    start: np.ndarray
    count: np.ndarray


def segments(words: np.ndarray, text: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, powers: Powers | None = None) -> Segments:
    """All windows of the texts (``text``: the index of each word's, ascending), filed by recompression. A symbol is
    told apart by its name and the words of its context."""
    powers = powers or Powers()
    prefix = powers.prefix(words, 0)
    n, far = len(words), 4 * window
    none = Segments(*(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64)))
    if n < window:
        return none
    start = np.arange(n - window + 1)
    start = start[text[start] == text[start + window - 1]]
    if not len(start):
        return none
    levels = []
    name, lo, hi, of = words, np.arange(n), np.arange(1, n + 1), text
    levels.append((name, lo, hi))
    # runs, named by symbol and length; the words before and after them tell where they end
    edge = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (of[1:] != of[:-1]), True])
    run, size = edge[:-1], np.diff(edge)
    fit = (size >= 2) & (size <= window - 2) & (run > 0) & (edge[1:] < n)
    run, size = run[fit], size[fit]
    fit = (of[run - 1] == of[run]) & (of[run + size] == of[run]) if len(run) else np.zeros(0, bool)
    run, size = run[fit], size[fit]
    runs = (mix(name[run] + size.astype(np.uint64) * _U(0xA0761D6478BD642F)), run - 1, run + size + 1)
    for r in range(rounds):
        m = len(name)
        side = (mix(name + _U(0xE7037ED1A0B428DB * (r + 1) & _ALL)) >> _U(63)).astype(bool)
        same = np.append(of[1:] == of[:-1], False)
        pair = np.append(~side[:-1] & side[1:], False) & same
        after = np.append(False, pair[:-1])  # the right half of a pair
        # an unpaired symbol's context has the neighbour that it could have paired with
        lone = ~pair & ~after
        k = np.flatnonzero(lone & side)  # the one before; at a text's start there is none, but elsewhere might be
        edge_at = (k == 0) | ~same[k - 1]
        new_lo, new_hi = lo.copy(), hi.copy()
        new_lo[k] = np.where(edge_at, lo[k] - far, np.minimum(lo[k], lo[k - 1]))
        new_hi[k] = np.where(edge_at, hi[k], np.maximum(hi[k], hi[k - 1]))
        k = np.flatnonzero(lone & ~side)
        nxt = np.minimum(k + 1, m - 1)
        new_lo[k] = np.where(same[k], np.minimum(lo[k], lo[nxt]), lo[k])
        new_hi[k] = np.where(same[k], np.maximum(hi[k], hi[nxt]), hi[k] + far)
        k = np.flatnonzero(pair)
        new_lo[k], new_hi[k] = np.minimum(lo[k], lo[k + 1]), np.maximum(hi[k], hi[k + 1])
        made = name.copy()
        made[k] = mix(name[k] * _U(0x8EBC6AF09C88C6E3) + name[k + 1] + _U(r))
        stay = ~after
        name, lo, hi, of = made[stay], new_lo[stay], new_hi[stay], of[stay]
        levels.append((name, lo, hi))
    levels.append(runs)
    best, symbol = np.full(n, _NONE), np.zeros(n, np.uint64)
    wanted = np.zeros(n, bool)
    wanted[start] = True
    for height in range(len(levels) - 1, -1, -1):
        name, lo, hi = levels[height]
        fit = np.flatnonzero((hi - lo <= window) & (lo >= 0) & (hi <= n))
        if not len(fit):
            continue
        rank = mix(name[fit] + _U(0x589965CC75374CC3 * height & _ALL))
        rank = (rank >> (_U(64) - _PLACE) << (_U(64) - _PLACE)) | np.arange(len(fit), dtype=np.uint64)
        here = np.full(n, _NONE)
        first, last = np.maximum(hi[fit] - window, 0), lo[fit]
        for t in range(window):
            at = last - t
            on = at >= first
            if not on.any():
                break
            np.minimum.at(here, at[on], rank[on])
        got = np.flatnonzero(wanted & (here != _NONE))
        place = (here[got] & _U((1 << (64 - int(_PLACE))) - 1)).astype(np.int64)
        best[got] = _U(height << 56) | fit[place].astype(np.uint64)
        at = fit[place]
        symbol[got] = mix(name[at] ^ mix(powers.of(prefix, lo[at], hi[at], 0) + _U(height + 1)))
        wanted[got] = False
    # neighbouring windows of one text under one symbol
    new = np.r_[True, (best[start[1:]] != best[start[:-1]]) | (np.diff(start) != 1) | (text[start[1:]] != text[start[:-1]])]
    at = np.flatnonzero(new)
    return Segments(symbol[start[at]], start[at], np.diff(np.r_[at, len(start)]))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes], range]]:
    """The ids, texts and row numbers of portions of a batch (id, key, text)."""
    ids = batch.column("id").to_numpy()
    texts, at, size = [], 0, 0
    for i, t in enumerate(batch.column("text")):
        texts.append(t.as_py() or b"")
        size += len(texts[-1])
        if size >= CHUNK or i + 1 == len(ids):
            yield ids[at : i + 1], texts, range(at, i + 1)
            texts, at, size = [], i + 1, 0


def _settle(rows: dict[str, np.ndarray], by: list[str]) -> np.ndarray:
    """True for rows that repeat one of an earlier (id, start) with the same ``by``."""
    order = np.lexsort((rows["start"], rows["id"], *(rows[c] for c in reversed(by))))
    keys = [rows[c][order] for c in by]
    first = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]) if len(order) else np.zeros(0, int)
    lead = order[np.repeat(first, np.diff(np.r_[first, len(order)]))]
    out = np.zeros(len(order), bool)
    out[order] = (rows["id"][order] != rows["id"][lead]) | (rows["start"][order] != rows["start"][lead])
    return out


def _table(parts: list[dict[str, np.ndarray]], kinds: dict[str, type]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([np.zeros(0, t), *(p[c] for p in parts)]) for c, t in kinds.items()}


def _rows(table: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for v in table.values()], list(table))


_FILED = {"symbol": np.uint64, "words": np.uint64, "id": np.int64, "key": np.int64, "more": np.int64, "start": np.int64, "count": np.int32, "settled": np.bool_}
_SCHEMA = {np.uint64: "long", np.int64: "long", np.int32: "int", np.bool_: "boolean"}


def _schema(kinds: dict[str, type]) -> str:
    return ", ".join(f"`{c}` {_SCHEMA[t]}" for c, t in kinds.items())


def filed(texts: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(id, key, more, text) -> one row per segment; a segment settled here (it repeats one of the same batch) gets a symbol
    of its own, so that it meets no other."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            parts, keys, more = [], batch.column("key").to_numpy(), batch.column("more").to_numpy()
            for ids, some, rows in _chunks(batch):
                words, text = words_of(some)
                s = segments(words, text, window, rounds, powers)
                prefix, of = powers.prefix(words, 0), text[s.start]
                base = np.searchsorted(text, np.arange(len(some)))  # the first word of each text
                parts.append({
                    "symbol": s.symbol, "words": powers.of(prefix, s.start, s.start + s.count + (window - 1), 0), "id": ids[of], "key": keys[rows.start : rows.stop][of], "more": more[rows.start : rows.stop][of],
                    "start": s.start - base[of], "count": s.count.astype(np.int32), "settled": np.zeros(len(of), bool),
                })
            t = _table(parts, _FILED)
            t["settled"] = _settle(t, ["symbol", "words"])
            # settled neighbours need no symbol of their own: one row for a run of them
            start, count, settled = t["start"], t["count"], t["settled"]
            on = settled[1:] & settled[:-1] & np.all([t[c][1:] == t[c][:-1] for c in NAMES], axis=0) & (start[1:] == start[:-1] + count[:-1])
            first = np.flatnonzero(np.append(True, ~on)) if len(start) else np.zeros(0, np.int64)
            t = {c: np.add.reduceat(v, first).astype(v.dtype) if c == "count" and len(v) else v[first] for c, v in t.items()}
            own = mix(mix(t["id"].view(np.uint64)) + t["start"].astype(np.uint64) + _U(1))
            t["symbol"] = np.where(t["settled"], own, t["symbol"])
            yield _rows(t)

    return texts.mapInArrow(each, _schema(_FILED))


_HASHED = {"h0": np.uint64, "h1": np.uint64, "id": np.int64, "key": np.int64, "more": np.int64, "start": np.int64, "settled": np.bool_}


def windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, key, more, text, open: array of struct(start, count)) -> one row per open window: its hash, id, key, more, start."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            parts, keys, more, asked = [], batch.column("key").to_numpy(), batch.column("more").to_numpy(), batch.column("open")
            for ids, some, rows in _chunks(batch):
                words, text = words_of(some)
                prefixes = [powers.prefix(words, k) for k in (0, 1)]
                base = np.searchsorted(text, np.arange(len(some)))
                for i, row in enumerate(rows):
                    spans = asked[row].values
                    start, count = (spans.field(c).to_numpy() for c in ("start", "count"))
                    at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
                    h = [powers.of(prefixes[k], base[i] + at, base[i] + at + window, k) for k in (0, 1)]
                    parts.append({"h0": h[0], "h1": h[1], "id": np.full(len(at), ids[i]), "key": np.full(len(at), keys[row]), "more": np.full(len(at), more[row]), "start": at.astype(np.int64), "settled": np.zeros(len(at), bool)})
            t = _table(parts, _HASHED)
            t["settled"] = _settle(t, ["h0", "h1"])
            own = mix(mix(t["id"].view(np.uint64)) + t["start"].astype(np.uint64) + _U(1))
            t["h0"] = np.where(t["settled"], own, t["h0"])
            yield _rows(t)

    return rows.mapInArrow(each, _schema(_HASHED))


def _repeats(place: Column, w) -> Column:
    """True for rows that do not stand first in their window."""
    return place > F.min(place).over(w)


def named(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> id, key, more, doc_id, text: the row's name, and its text as bytes."""
    hashes = F.xxhash64("text").alias("key"), F.xxhash64(F.md5(F.col("text").cast("binary"))).alias("more")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), *hashes, "doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def repeated(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` (doc_id, text) -> id, key, more, doc_id, text and gone: the spans (start, count of windows) of repeated
    windows, null if none."""
    texts = named(docs)
    place = F.struct("id", "start")
    rows = filed(texts.select(*NAMES, "text"), window, rounds)
    by_symbol = Window.partitionBy("symbol")
    rows = rows.select(
        *NAMES, "start", "count",
        (F.col("settled") | _repeats(place, Window.partitionBy("symbol", "words"))).alias("gone"),
        (F.min("words").over(by_symbol) < F.max("words").over(by_symbol)).alias("mixed"),
    )
    span = F.struct("start", "count")
    rows = rows.filter("gone OR mixed").groupBy(*NAMES).agg(F.collect_list(F.when(F.col("gone"), span)).alias("gone"), F.collect_list(F.when(~F.col("gone"), span)).alias("open"))
    theirs = [F.col(c).alias(f"_{c}") for c in NAMES]
    found = rows.select(*theirs, "gone", "open")
    mine = (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key")) & (F.col("more") == F.col("_more"))
    # rows of one name share their windows; each is compared once
    # all columns of texts, so that both joins read one and the same exchange of the texts
    asked = texts.join(found.filter(F.size("open") > 0).drop("gone"), mine).select(*NAMES, "doc_id", "text", "open")
    single = windows(asked, window)
    single = single.select(*NAMES, "start", (F.col("settled") | _repeats(place, Window.partitionBy("h0", "h1"))).alias("gone")).filter("gone")
    single = single.select(*NAMES, F.array(F.struct("start", F.lit(1).alias("count"))).alias("gone"))
    gone = found.filter(F.size("gone") > 0).select(*(F.col(f"_{c}").alias(c) for c in NAMES), "gone").unionByName(single)
    gone = gone.groupBy(*theirs).agg(F.flatten(F.collect_list("gone")).alias("gone"))
    return texts.join(gone, mine, "left").select(*NAMES, "doc_id", "text", "gone")


def kept_words(text: bytes, gone: tuple[np.ndarray, np.ndarray] | None, window: int = WINDOW) -> tuple[int, list[bytes]]:
    """The number of words of a text, and the words outside all repeated windows."""
    words = text.split()
    if gone is None:
        return len(words), words
    start, count = gone
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + count + (window - 1), -1)
    keep = np.cumsum(depth[:-1]) == 0
    return len(words), [words[i] for i in np.flatnonzero(keep)]


def deduplicated(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept text; with ``digest`` its SHA-256 in its place."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, out = [], [], []
            for text, gone in zip(b.column("text"), b.column("gone"), strict=True):
                spans = tuple(gone.values.field(c).to_numpy().astype(np.int64) for c in ("start", "count")) if gone.is_valid else None
                size, words = kept_words(text.as_py(), spans, window)
                n.append(size)
                removed.append(size - len(words))
                joined = b" ".join(words)
                out.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", last])

    last = "kept_sha256" if digest else "text"
    kind = docs.schema["doc_id"].dataType.simpleString()
    return repeated(docs, window, rounds).select("doc_id", "text", "gone").mapInArrow(each, f"doc_id {kind}, n_words long, n_removed long, {last} string")


def digest(docs: DataFrame) -> DataFrame:
    return deduplicated(docs, digest=True)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20),
q AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM p),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM q) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(s, s + 20)) AS i FROM r)),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept, count(*) AS n FROM e ANTI JOIN g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
