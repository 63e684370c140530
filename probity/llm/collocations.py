r"""Phrase collocation mining by mergeable Misra-Gries summaries and an exact second pass.

Texts become chunks of word numbers. A chunk hands on the hashes of its n-grams with their counts, sorted and packed, one
bundle for each hash partition. In a hash partition the bundles are merged into a Misra-Gries summary whose capacity
exceeds the partition's mass divided by the threshold, so its error is below the threshold and every n-gram that reaches
the threshold survives (two that share a hash only add up, and survive too). The survivors' hashes are counted over the
same bundles, and those that reach the threshold go back to the chunks that hold them. There the n-grams are spelt out and
counted as words, so the counts handed on are exact and know no hashes.

A hot n-gram is one entry of a bundle; a hot language or source is many chunks. The number of hash partitions follows the
corpus, so a partition's summary and its packed bundles are bounded. Nothing is broadcast but one number per hash partition.

Defined results: a null text is empty; a null language is ``und``, together with rows that say so; rows with one doc_id
are separate documents; an empty table gives an empty table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.common import cut, partitions, running

THRESHOLD, LONGEST, TOP = 30, 4, 2000
#: floor(SCALE * a / (l + r)); a phrase goes if SHARE % of its occurrences are in a longer candidate.
SCALE, SHARE = 2_000_000, 80
#: Words of a chunk (a text is never cut within a piece unless the piece alone is longer).
CHUNK = 1 << 19
#: N-grams of a hash partition, about.
MASS = 1 << 25
#: Bits of a packed hash beyond those that tell a hash partition's mass: one n-gram in 500 shares its hash, at most.
SPARE = 9
#: Bits of the map of words that phrases need; two words with one bit only cost a row each.
WORD_BITS = 1 << 24
#: Phrases that a task holds before it hands their counts on.
HELD = 500_000
#: A table of so many languages, or fewer, is broadcast.
LANGS = 50_000
#: A-Z to a-z, the marks that end a piece to line feeds, tabs to spaces.
TABLE = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")
BREAK = -1


class _Words(dict):
    """Word -> number within a chunk; a break is BREAK, an empty string GONE."""

    GONE = -2

    def __init__(self, lang: str, all_words: list[tuple[str, bytes]]):
        super().__init__({b"": self.GONE, b"\n": BREAK})
        self.lang, self.all = lang, all_words

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.all)
        self.all.append((self.lang, word))
        return n


def _planes(x: np.ndarray, kind: str = "<u4") -> np.ndarray:
    """The numbers byte by byte, lowest first: the high bytes of small numbers are zeros and pack to nothing."""
    x = np.ascontiguousarray(x, kind)
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)


def _numbers(planes: np.ndarray, kind: str = "<u4") -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack(*parts: bytes | np.ndarray) -> bytes:
    return pa.compress(b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts), codec="zstd", asbytes=True)


def _unpack(size: int, packed: bytes) -> bytes:
    return pa.decompress(packed, size, codec="zstd", asbytes=True)


def chunked(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """chunk, mass, sizes (of codes, of words, of words in bytes), codes (packed, breaks between pieces), words (packed: the
    chunk's own dictionary and the language of each), langs and n (words of each language): one row for about ``size`` words."""
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    fields = [("chunk", pa.int64()), ("mass", pa.int64()), ("sizes", pa.list_(pa.int64())), ("codes", pa.binary()), ("words", pa.binary()), ("langs", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))]
    spec, schema = "chunk long, mass long, sizes array<long>, codes binary, words binary, langs array<string>, n array<long>", pa.schema(fields)
    table, longest = TABLE, LONGEST

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, n_held = TaskContext.get().partitionId() << 32, [], 0
        every: list[tuple[str, bytes]] = []
        by_lang: dict[str, _Words] = {}

        def flush() -> pa.RecordBatch:
            nonlocal made, held, n_held, every, by_lang
            codes = np.concatenate(held)
            lang_of = {lang: i for i, lang in enumerate(by_lang)}
            of_word = np.array([lang_of[lang] for lang, _ in every], np.int64)
            n = np.bincount(of_word[codes[codes >= 0]], minlength=len(lang_of))
            flat = b"\n".join(w for _, w in every)
            words = _pack(_planes(of_word), flat)
            values = [made, n_held * (longest - 1), [len(codes), len(every), len(flat)], _pack(_planes(codes + 1)), words, list(lang_of), n.tolist()]
            made, held, n_held, every, by_lang = made + 1, [], 0, [], {}
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = text.translate(table).replace(b"\n", b" \n ").split(b" ")
                numbers = by_lang.get(lang) or by_lang.setdefault(lang, _Words(lang, every))
                codes = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                codes = codes[codes != numbers.GONE]
                # a long text is several parts; n-grams do not cross a break, so only within a piece a part must go on
                breaks = np.flatnonzero(codes == BREAK)
                at = 0
                while at < len(codes):
                    stop = len(codes)
                    if stop - at > size:
                        near = np.searchsorted(breaks, at + size)
                        stop = int(breaks[near]) + 1 if near < len(breaks) else stop
                    if n_held and n_held + stop - at > size:
                        rest = codes[at:].copy()
                        old = [every[c] if c >= 0 else None for c in np.unique(rest[rest >= 0])]
                        yield flush()
                        # the numbers of a new chunk start anew
                        numbers = by_lang.setdefault(lang, _Words(lang, every))
                        was = np.unique(rest[rest >= 0])
                        new = np.array([numbers[w] for _, w in old], np.int32)
                        rest[rest >= 0] = new[np.searchsorted(was, rest[rest >= 0])] if len(was) else 0
                        codes = np.concatenate([codes[:at], rest])
                    held += [codes[at:stop], np.array([BREAK], np.int32)]
                    n_held += stop - at + 1
                    at = stop
        if n_held:
            yield flush()

    return rows.mapInArrow(each, spec)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Codes, the language (as a place in ``langs``), the bytes and the hash of each word of a chunk."""
    n_codes, n_words, n_bytes = row["sizes"]
    codes = _numbers(np.frombuffer(_unpack(4 * n_codes, row["codes"]), np.uint8)).astype(np.int32) - 1
    flat = _unpack(4 * n_words + n_bytes, row["words"])
    of_word = _numbers(np.frombuffer(flat, np.uint8, 4 * n_words)).astype(np.int64)
    words = flat[4 * n_words :].split(b"\n") if n_words else []
    seeds = [lang.encode() + b"\0" for lang in row["langs"]]
    hashes = np.array([xxhash.xxh64_intdigest(seeds[k] + w) for k, w in zip(of_word.tolist(), words, strict=True)], np.uint64)
    return codes, of_word, words, hashes


def _grams(codes: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 2 to ``longest`` the starts and the 64-bit hashes of the n-grams."""
    word = np.append(hashes, np.uint64(0))[codes]
    fits, h = np.ones(len(codes), bool), np.zeros(len(codes), np.uint64)
    for n in range(1, longest + 1):
        m = max(0, len(codes) - n + 1)
        fits, h = fits[:m] & (codes[n - 1 : n - 1 + m] >= 0), h[:m]
        h = (h ^ word[n - 1 : n - 1 + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        at = np.flatnonzero(fits)
        if n > 1:
            yield n, at, (h[at] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)


def _slot_keys(h: np.ndarray, slots: int, bits: int) -> np.ndarray:
    """Slot and packed part of a hash in one number, sorted by slot first."""
    return (((h >> np.uint64(bits)) % np.uint64(slots)) << np.uint64(bits)) | (h & np.uint64((1 << bits) - 1))


def _bundle(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys, 16 bits as they are and the steps of the rest, and their counts."""
    high = (keys >> np.uint64(16)).astype(np.int64)
    return _pack(keys.astype("<u2"), _planes(np.diff(high, prepend=0)), _planes(counts))


def _unbundle(n: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(_unpack(10 * n, packed), np.uint8)
    high = np.cumsum(_numbers(flat[2 * n : 6 * n]), dtype=np.uint64)
    return (high << np.uint64(16)) | flat[: 2 * n].view("<u2"), _numbers(flat[6 * n :]).astype(np.int64)


class Summary:
    """A Misra-Gries summary of (sorted keys, counts). With a capacity of at least mass / threshold, the counters of all
    keys whose counts add up to the threshold or more are still there at the end, in whatever order counts came."""

    def __init__(self, capacity: int):
        self.capacity, self.keys, self.counts = capacity, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n += len(keys)
        if self.n > max(self.capacity, 1 << 18):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        self.waiting, self.n = [], 0
        if (over := len(self.keys) - self.capacity) > 0:
            # the (capacity + 1)-th largest counter is taken from all: at least capacity + 1 counters lose as much
            less = np.partition(self.counts, over - 1)[over - 1]
            left = self.counts > less
            self.keys, self.counts = self.keys[left], self.counts[left] - less

    def survivors(self) -> np.ndarray:
        self.settle()
        return self.keys


def _bundles(chunks: DataFrame, slots: int, longest: int, bits: int) -> DataFrame:
    """chunk, slot, n, mass, packed: the n-gram hashes of each chunk, counted, one row per hash partition."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                codes, _, _, hashes = _opened(row)
                keys, counts = np.unique(_slot_keys(np.concatenate([h for _, _, h in _grams(codes, hashes, longest)]), slots, bits), return_counts=True)
                edges = np.searchsorted(keys, np.arange(slots + 1, dtype=np.uint64) << np.uint64(bits))
                some = np.flatnonzero(np.diff(edges))
                low = keys & np.uint64((1 << bits) - 1)
                packed = [_bundle(low[edges[i] : edges[i + 1]], counts[edges[i] : edges[i + 1]]) for i in some]
                mass = [int(counts[edges[i] : edges[i + 1]].sum()) for i in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), row["chunk"])), pa.array(some.astype(np.int32)), pa.array(np.diff(edges)[some].astype(np.int32)), pa.array(mass, pa.int64()), pa.array(packed, pa.binary())],
                    ["chunk", "slot", "n", "mass", "packed"],
                )

    return chunks.select("chunk", "sizes", "codes", "words", "langs").mapInArrow(each, "chunk long, slot int, n int, mass long, packed binary")


def frequent(bundles: DataFrame, threshold: int) -> DataFrame:
    """chunk, slot, n, packed: of each bundle the hashes whose counts over all chunks reach the threshold."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mass = [], 0
        for b in batches:
            held += zip(b.column("chunk").to_pylist(), b.column("slot").to_pylist(), b.column("n").to_pylist(), b.column("packed").to_pylist(), strict=True)
            mass += sum(b.column("mass").to_pylist())
        summary = Summary(mass // threshold + 1)
        for _, _, n, packed in held:
            summary.add(*_unbundle(n, packed))
        alive = summary.survivors()
        # the second pass: exact counts of the survivors
        total = np.zeros(len(alive) + 1, np.int64)
        for _, _, n, packed in held:
            keys, counts = _unbundle(n, packed)
            at = np.searchsorted(alive, keys)
            at[at < len(alive)] = np.where(alive[at[at < len(alive)]] == keys[at < len(alive)], at[at < len(alive)], len(alive))
            there = at < len(alive)
            total[at[there]] += counts[there]  # a bundle has each key once
        alive = alive[total[:-1] >= threshold]
        for chunk, slot, n, packed in held:
            keys, _ = _unbundle(n, packed)
            mine = alive[keys[np.minimum(np.searchsorted(keys, alive), n - 1)] == alive]
            if len(mine):
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([slot], pa.int32()), pa.array([len(mine)], pa.int32()), pa.array([_bundle(mine, np.zeros(len(mine)))], pa.binary())], ["chunk", "slot", "n", "packed"])

    return bundles.groupBy("slot").applyInArrow(each, "chunk long, slot int, n int, packed binary")


def phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, chunk: int = CHUNK, mass: int = MASS, spare: int = SPARE) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) for all phrases of 1 to ``longest`` words that occur ``threshold`` times or more in a
    language, and (lang, n), the words of each language."""
    spark = docs.sparkSession
    chunks = cut(chunked(docs, chunk))
    every = chunks.agg(F.sum("mass").alias("mass")).first()["mass"] or 0
    slots = max(2 * partitions(spark), -(-every // mass))
    bits = min(47, max(4, int(-(-every // slots)).bit_length() + spare))
    found = frequent(_bundles(chunks, slots, longest, bits), threshold)
    mine = found.groupBy("chunk").agg(F.collect_list(F.struct("slot", "n", "packed")).alias("found")).withColumnRenamed("chunk", "_chunk")
    both = chunks.join(mine, F.col("chunk") == F.col("_chunk")).select("sizes", "codes", "words", "langs", "found")

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes], list[int]]]:
        for b in batches:
            for row in b.to_pylist():
                codes, of_word, words, hashes = _opened(row)
                wanted = np.sort(np.concatenate([_unbundle(f["n"], f["packed"])[0] | (np.uint64(f["slot"]) << np.uint64(bits)) for f in row["found"]]))
                langs = np.array(row["langs"], object)
                for n, at, h in _grams(codes, hashes, longest):
                    keys = _slot_keys(h, slots, bits)
                    near = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
                    at = at[wanted[near] == keys]
                    if not len(at):
                        continue
                    tuples = codes[at[:, None] + np.arange(n)]
                    tuples = tuples[np.lexsort(tuples.T[::-1])]
                    starts = np.flatnonzero(np.append(True, (tuples[1:] != tuples[:-1]).any(axis=1)))
                    times = np.diff(np.append(starts, len(at)))
                    spelling = [b" ".join([words[i] for i in t]) for t in tuples[starts].tolist()]
                    yield langs[of_word[tuples[starts, 0]]].tolist(), spelling, times.tolist()

    totals = chunks.select(F.explode(F.arrays_zip("langs", "n")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.n").alias("n"))
    exact = cut(_summed(both.mapInArrow(lambda batches: _tallies(spelt(batches), slots), TALLY), threshold))
    return exact.unionByName(_summed(_words_of(exact, chunks, slots), threshold)), totals


#: Counts of the phrases of a bucket: a table of languages; packed, the counts and the phrases, each with its language.
TALLY = "bucket int, n int, size long, langs array<string>, packed binary"


def _tallies(found: Iterator[tuple[list[str], list[bytes], list[int]]], buckets: int, most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Adds up (language, phrase, count) in a task, and hands the counts on in one row per bucket."""
    held: dict[str, dict[bytes, int]] = {}

    def flush() -> pa.RecordBatch:
        table = list(held)
        rows: list[list[tuple[bytes, int]]] = [[] for _ in range(buckets)]
        for i, lang in enumerate(table):
            seed, before = lang.encode() + b"\0", b"%d\0" % i
            for phrase, n in sorted(held[lang].items()):
                rows[xxhash.xxh64_intdigest(seed + phrase) % buckets].append((before + phrase, n))
        some = [i for i, r in enumerate(rows) if r]
        flat = [b"\n".join(p for p, _ in rows[i]) for i in some]
        packed = [_pack(_planes(np.array([n for _, n in rows[i]])), x) for i, x in zip(some, flat, strict=True)]
        held.clear()
        columns = [pa.array(some, pa.int32()), pa.array([len(rows[i]) for i in some], pa.int32()), pa.array([len(x) for x in flat], pa.int64()), pa.array([table] * len(some), pa.list_(pa.string())), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "n", "size", "langs", "packed"])

    for langs, phrases_, counts in found:
        for lang, phrase, n in zip(langs, phrases_, counts, strict=True):
            mine = held.get(lang)
            if mine is None:
                mine = held[lang] = {}
            mine[phrase] = mine.get(phrase, 0) + n
        if sum(map(len, held.values())) > most:
            yield flush()
    if held:
        yield flush()


def _summed(tallies: DataFrame, threshold: int) -> DataFrame:
    """lang, phrase, words, a: the exact counts that reach the threshold."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, dict[bytes, int]] = {}
        for b in batches:
            for row in b.to_pylist():
                flat = _unpack(4 * row["n"] + row["size"], row["packed"])
                counts = _numbers(np.frombuffer(flat, np.uint8, 4 * row["n"])).tolist()
                mine = [total.setdefault(lang, {}) for lang in row["langs"]]
                for one, n in zip(flat[4 * row["n"] :].split(b"\n"), counts, strict=True):
                    i, _, phrase = one.partition(b"\0")
                    t = mine[int(i)]
                    t[phrase] = t.get(phrase, 0) + n
        for lang, t in total.items():
            kept = [(p, p.count(b" ") + 1, n) for p, n in t.items() if n >= threshold]
            if kept:
                phrase, words, n = zip(*kept, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(kept)), pa.array(phrase, pa.binary()), pa.array(words, pa.int32()), pa.array(n, pa.int64())], ["lang", "phrase", "words", "a"])

    counted = tallies.groupBy("bucket").applyInArrow(each, "lang string, phrase binary, words int, a long")
    return counted.withColumn("phrase", F.col("phrase").cast("string"))


def _words_of(known: DataFrame, chunks: DataFrame, buckets: int) -> DataFrame:
    """Tallies of the words of ``known`` phrases, and of few others. Which words those are goes to the chunks as a bit map
    of a fixed size."""
    needed = known.select(F.explode(F.split("phrase", " ", -1)).alias("w"))
    # positions of bitmap functions are counted from 1
    bits = needed.select((F.pmod(F.xxhash64(F.col("w").cast("binary")), F.lit(WORD_BITS)) + 1).alias("bit"))
    bits = bits.groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    wanted = np.zeros(WORD_BITS, bool)
    for r in bits.collect():  # WORD_BITS / 8 bytes in all, at most
        part = np.unpackbits(np.frombuffer(r["map"], np.uint8), bitorder="little")
        wanted[(r["k"] - 1) * len(part) : r["k"] * len(part)] = part[: WORD_BITS - (r["k"] - 1) * len(part)]
    packed, all_bits = np.packbits(wanted), WORD_BITS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes], list[int]]]:
        wanted = np.unpackbits(packed)
        for b in batches:
            for row in b.to_pylist():
                codes, of_word, words, _ = _opened(row)
                at = np.array([xxhash.xxh64_intdigest(w, seed=42) for w in words], np.uint64).astype(np.int64) % all_bits
                mine = np.flatnonzero(wanted[at])
                times = np.bincount(codes[codes >= 0], minlength=len(words))[mine]
                yield np.array(row["langs"], object)[of_word[mine]].tolist(), [words[i] for i in mine], times.tolist()

    return chunks.select("sizes", "codes", "words", "langs").mapInArrow(lambda batches: _tallies(counted(batches), buckets), TALLY)


def _small(langs: DataFrame) -> DataFrame:
    """A table with one row per language, broadcast if it is as small as it should be."""
    langs = cut(langs)
    return F.broadcast(langs) if langs.count() <= LANGS else langs


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, share: int = SHARE, scale: int = SCALE, **sizes: int) -> DataFrame:
    """lang, phrase, a, l, r, n, score: all candidates that no longer candidate holds."""
    known, totals = phrases(docs, threshold, longest, **sizes)
    known = cut(known)
    words = F.split("phrase", " ", -1)
    part = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    candidates = known.filter("words > 1")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("_first"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("_rest"))
    side = lambda f, c: known.select(F.col("lang").alias(f"_{c}_lang"), F.col("phrase").alias(f"_{c}_phrase"), F.col("a").alias(c))
    cuts = cuts.join(side("f", "l"), (F.col("lang") == F.col("_l_lang")) & (F.col("_first") == F.col("_l_phrase")))
    cuts = cuts.join(side("f", "r"), (F.col("lang") == F.col("_r_lang")) & (F.col("_rest") == F.col("_r_phrase")))
    exact = F.expr(f"cast({scale} as decimal(18, 0)) * cast(a as decimal(19, 0)) div cast(l + r as decimal(19, 0))")
    best = cuts.withColumn("score", exact).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("_s"))
    # the shorter phrases inside each candidate
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: part(i, m))))
    longer = candidates.filter("words > 2").select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), "a")
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    kept = best.join(most, ["lang", "phrase"], "left").filter(F.col("_most").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("_most") < F.lit(share).cast("decimal(3,0)") * F.col("_s.a")))
    return kept.join(_small(totals), "lang").select("lang", "phrase", "_s.a", "_s.l", "_s.r", "n", "_s.score")


def digest(docs: DataFrame, top: int = TOP) -> DataFrame:
    # the place in one order of all, less the first place of the language
    found = collocations(docs).withColumns({"_s": -F.col("score"), "_a": -F.col("a"), "_one": F.lit(1).cast("long")})
    placed = running(found, ["lang", "_s", "_a", "phrase"], {"_at": "_one"})
    first = _small(placed.groupBy("lang").agg(F.min("_at").alias("_first")))
    ranked = placed.join(first, "lang").withColumn("rank", F.col("_at") - F.col("_first") + 1).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM
  (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {THRESHOLD}),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, (({SCALE}::HUGEINT * c.a) // (l.a + r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:cut], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
most AS (SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN most m USING (lang, phrase) WHERE most IS NULL OR 100 * most < {SHARE} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {TOP}
"""
