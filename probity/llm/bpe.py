"""BPE encoding and decoding by speculation and verification.

A word is first cut greedily into its longest tokens. That guess is the exact encoding if every token encodes to
itself and no two neighbours would have merged across their border: both are checked with array operations over all
pairs of a batch, following the merges of the two tokens down from the later one. Only words that fail are merged
exactly, rank by rank.

Works for vocabularies of the tokenizers library with a BPE model over byte letters and an end-of-word suffix, whose
words are split at white space and by a pattern of letters, digits and other signs, lower-cased and in NFC; decoding
without a decoder joins the tokens by a space. The vocabulary travels to the executors once (its size is fixed by the
file); remembered words are bounded by ``KNOWN``.

Defined results: a null or empty text, or one of white space, has no tokens and decodes to the empty text; special
tokens written in a text get their own ids; rows with one doc_id are separate documents; an empty table gives an empty
table; other columns of any name stay as they are in ``encoded``.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Units (words without the signs around them) that a Python worker remembers.
KNOWN = 400_000
#: Units that are learned at once.
PORTION = 50_000
FAR = 1 << 40


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable in Latin-1, else the next free from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class Encoder:
    """A vocabulary of ``path`` (JSON of the tokenizers library)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        n = max([*self.vocab.values(), *self.special.values()]) + 1
        self.names = [""] * n
        for name, i in [*self.vocab.items(), *self.special.items()]:
            self.names[i] = name
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left, right = (np.array([self.vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        # a token's rank is that of the merge that makes it; -1: a letter
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.arange(n), np.arange(n)
        self.rank[made], self.left[made], self.right[made] = np.arange(len(made)), left, right
        key = left * n + right
        order = np.argsort(key)
        self.keys, self.key_rank, self.n = key[order], order, n
        self.made = made
        # tokens that encode to themselves: both halves do, and nothing ranked lower merges across them
        self.stable = np.ones(n, bool)
        fine = self.compatible(left, right, np.arange(len(made)))
        for a, b, c, ok in zip(left, right, made, fine, strict=True):  # in order of rank: halves come first
            self.stable[c] = ok and self.stable[a] and self.stable[b]
        self.inner_letter, self.end_letter = np.full(512, -1, np.int64), np.full(512, -1, np.int64)
        for c in byte_letters():
            self.inner_letter[ord(c)], self.end_letter[ord(c)] = self.vocab.get(c, -1), self.vocab.get(c + self.suffix, -1)
        self.ends = {name.removesuffix(self.suffix): i for name, i in self.vocab.items() if name.endswith(self.suffix)}
        self.longest = max(map(len, self.ends))
        self.digits = [str(i) for i in range(n)]
        self.letters = byte_letters()
        self._ready()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "marked", "split", "marks")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _ready(self) -> None:
        import regex

        self.marked = {name: (i,) for name, i in self.special.items()}
        self.known: dict[str, tuple[int, ...]] = dict(self.marked)
        self.split = regex.compile(self.pattern)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of a and b; FAR if there is none."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], FAR)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether merging the letters of a and b leaves the border between them, up to merges ranked ``before``.

        Undoes the later of the two tokens' merges step by step. A merge across the border happens if it ranks before
        the merge that would use up one of its sides; at equal rank the left one is first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok, open_ = np.ones(len(a), bool), np.arange(len(a))
        # the border must hold while both tokens exist as they are now: ranks under ``limit``
        limit = np.full(len(a), FAR - 1, np.int64) if before is None else before.astype(np.int64)
        while len(open_):
            x, y, most = a[open_], b[open_], limit[open_]
            joins = self.merge_rank(x, y) < most
            ok[open_[joins]] = False
            rx, ry = self.rank[x], self.rank[y]
            left = rx > ry  # undo the later one; at equal rank, the right one was made last
            done = ~joins & (rx < 0) & (ry < 0)
            a[open_[left]] = self.right[x[left]]
            b[open_[~left]] = self.left[y[~left]]
            # before the left token was made, a merge across of lower rank comes first; one of the right token's rank
            # comes first too, as it lies further left
            limit[open_] = np.minimum(most, np.where(left, rx, ry + 1))
            open_ = open_[~joins & ~done]
        return ok

    def exact(self, words: list[str]) -> list[tuple[int, ...]]:
        """Merging by rank, the leftmost first: one merge of every word at a time."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.array([len(w) for w in words], np.int64)
        ids, word = self.inner_letter[codes], np.repeat(np.arange(len(words)), size)
        last = np.cumsum(size)[size > 0] - 1
        ids[last] = self.end_letter[codes[last]]
        ids, word = ids[ids >= 0], word[ids >= 0]
        inner = np.append(word[1:] == word[:-1], False) if len(ids) else np.zeros(0, bool)
        rank = np.full(len(ids), FAR)  # of the merge with the next letter of the word
        rank[inner] = self.merge_rank(ids[inner], ids[np.flatnonzero(inner) + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, starts)
            count = np.diff(np.append(starts, len(ids)))
            ended = np.repeat(least == FAR, count)
            done.append((word[ended], ids[ended]))
            hit = np.flatnonzero((rank == np.repeat(least, count)) & (rank < FAR))
            first = hit[np.append(True, word[hit][1:] != word[hit][:-1])] if len(hit) else hit
            ids[first] = self.made[rank[first]]
            stay = ~ended
            stay[first + 1] = False
            shift = np.cumsum(stay) - 1
            ids, word, rank, first = ids[stay], word[stay], rank[stay], shift[first]
            for at in (first, first[first > 0] - 1):  # the merges with the new letter
                at = at[at + 1 < len(ids)]
                same = word[at] == word[at + 1]
                rank[at] = np.where(same, self.merge_rank(ids[at], ids[at + 1]), FAR)
            if len(ids):
                rank[-1] = FAR
        owner, ids = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*done, strict=True) if done else ([], [])))
        order = np.argsort(owner, kind="stable")
        flat, edges = ids[order].tolist(), np.searchsorted(owner[order], np.arange(len(words) + 1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip(edges, edges[1:], strict=False)]

    def greedy(self, letters: str) -> list[int]:
        """The longest tokens from the left; the end of the unit carries the suffix."""
        inner, ends, out, at, n, most = self.vocab.get, self.ends.get, [], 0, len(letters), self.longest
        while at < n:
            if n - at <= most and (i := ends(letters[at:])) is not None:
                out.append(i)
                break
            for end in range(min(n - 1, at + most), at, -1):
                if (i := inner(letters[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
            else:
                at += 1  # a letter outside the vocabulary has no token
        return out

    def pieces(self, words: list[str]) -> list[list[int]]:
        """The ids of words, each in byte letters: guessed, verified all at once, mended where the guess fails."""
        guess = [self.greedy(w) for w in words]
        flat = np.array([i for g in guess for i in g], np.int64)
        size = np.array([len(g) for g in guess], np.int64)
        owner = np.repeat(np.arange(len(guess)), size)
        bad = np.zeros(len(guess), bool)
        bad[owner[~self.stable[flat]]] = True
        if len(flat) > 1:
            inner = owner[1:] == owner[:-1]
            a, b, of = flat[:-1][inner], flat[1:][inner], owner[1:][inner]
            pairs, back = np.unique(a * self.n + b, return_inverse=True)
            bad[of[~self.compatible(pairs // self.n, pairs % self.n)[back]]] = True
        wrong = np.flatnonzero(bad).tolist()
        for i, ids in zip(wrong, self.exact([words[i] for i in wrong]), strict=True):
            guess[i] = ids
        return guess

    def learn(self, units: set[str]) -> None:
        """Remembers the ids of units of text, lower-cased and in NFC."""
        if len(self.known) + len(units) > KNOWN:
            self.known.clear()
            self.known.update(self.marked)
        new = list(units)
        collects = gc.isenabled()
        gc.disable()  # many small tuples and no cycles
        try:
            spelt = ["".join(map(self.letters.__getitem__, u.encode())) for u in new]
            self.known.update(zip(new, map(tuple, self.pieces(spelt)), strict=True))
        finally:
            if collects:
                gc.enable()

    def _units(self, text: str) -> list[str]:
        """What a text is split into: runs of letters, digits, runs of other signs, special tokens."""
        out: list[str] = []
        for part in self.marks.split(text) if self.marks and any(s in text for s in self.special) else [text]:
            if part in self.special:
                out.append(part)
            else:
                low = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final form
                out += self.split.findall(low.lower())
        return out

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text. Units are learned for many texts at once, and for a long text in portions."""
        held, n = [], 0
        for text in texts:
            held.append(self._units(text or ""))
            n += len(held[-1])
            if n >= PORTION:
                yield from self._encode(held)
                held, n = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[list[str]]) -> Iterator[list[int]]:
        known = self.known
        if sum(map(len, texts)) <= 2 * PORTION:
            units = set(chain.from_iterable(texts))
            if new := units.difference(known):
                self.learn(new)
            if not units.difference(known):  # else learning has cleared the memory
                for text in texts:
                    yield list(chain.from_iterable(map(known.__getitem__, text)))
                return
        for units in texts:
            ids: list[int] = []
            for i in range(0, len(units), PORTION):
                part = units[i : i + PORTION]
                if new := set(part).difference(known):
                    self.learn(new)
                    if lost := set(part).difference(known):
                        self.learn(lost)
                ids += chain.from_iterable(map(known.__getitem__, part))
            yield ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.names.__getitem__, ids))


def _shared(spark: SparkSession, path: str | None):
    return spark.sparkContext.broadcast(Encoder(path or vocabulary_file()))


def encoded(docs: DataFrame, path: str | None = None, column: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text``."""
    encoder = _shared(docs.sparkSession, path)

    @F.pandas_udf("array<int>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([np.array(x, np.int32) for x in encoder.value.encode_batch(texts)])

    return docs.withColumn(column, encode(F.col("text")))


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``rows`` with the text of a column of token ids."""
    encoder = _shared(rows.sparkSession, path)

    @F.pandas_udf("string")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in parts:
            yield pd.Series([encoder.value.decode(x) if x is not None else None for x in some], dtype=object)

    return rows.withColumn(column, decode(F.col(ids)))


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text, taken where the ids are, so that they need not travel."""
    encoder = _shared(docs.sparkSession, path)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder.value
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for ids in e.encode_batch(t.as_py() for t in b.column(1)):
                n.append(len(ids))
                ids_sha.append(sha(" ".join(map(e.digits.__getitem__, ids))))
                text_sha.append(sha(e.decode(ids)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(each, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
