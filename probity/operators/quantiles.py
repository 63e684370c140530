"""Exact order statistics by radix selection, with bounded memory.

``percentile_disc`` / ``median`` keep a value -> count map whose final merge
happens in ONE task.  The exact k-th smallest value is found instead digit by
digit, most significant first, on an order-preserving 64-bit image of the value:

* integers and booleans are their own image, dates are days, timestamps
  microseconds, narrow decimals their unscaled value;
* a floating value's image is what its IEEE 754 bits read as an integer (sign
  and magnitude), made with JVM arithmetic that is exact at every step: -inf first,
  +inf and then NaN last, as in Spark's own order; -0.0 equals 0.0;
* wide decimals have three images (two for the whole part, one for the
  fraction), texts one for every seven bytes of their UTF-8 (with the number of
  bytes, so a prefix sorts first).  A text's digits start behind what the
  smallest and the largest text still in question have in common.

One round is one ``groupBy(range, digit)`` over the columns in question: count,
smallest and largest image of each digit, at most ``2 ** BITS`` keys per wanted
rank, so partial aggregates, shuffle and driver rows are bounded.  The
digit holding the rank is the next range; its smallest and largest image are
real, so the next digit starts where they differ.  A range of at most
``2 ** BITS`` rows is grouped by the image itself; a range of one image (a hot
value) is the answer.  An image takes at most ``64 / BITS`` rounds, rounded up,
whatever the distribution and the number of rows; nothing is left over for an
unbounded percentile.

Nulls do not count; an empty or all-null column has no ranks.  Types without an
order here (arrays, intervals, decimals with over 18 digits behind the point)
raise ``ValueError``.
"""

from __future__ import annotations

import datetime
import math
import struct
from decimal import Decimal
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 13  # a digit: at most 2 ** BITS groups per wanted rank and round
PORTION = 32  # ranges of one pass: a row is expanded at most this many times
TEXT_BYTES = 7  # bytes of a text in one image

_MANTISSA = 2 ** 52
_INFINITE = 2047 * _MANTISSA
_WIDE = 10 ** 18


def _q(col: str) -> str:
    return f"`{col}`"


# ---- images


def _floating(col: str) -> Column:
    """Sign and IEEE magnitude of a double as one long."""
    a = f"abs(cast({_q(col)} AS DOUBLE))"
    # the exponent of a normal number, or -1022 for what is smaller; log2 may be off by one, so it is put right below
    e = f"least(greatest(floor(log2({a})), -1022L), 1023L)"
    p = f"pow(2D, {e})"

    def magnitude(shift: int, scale: str) -> str:
        return f"(({e}) + {1022 + shift}L) * {_MANTISSA}L + floor({a} / ({p} * {scale}) * {_MANTISSA}D)"

    return F.expr(
        f"CASE WHEN isnan({a}) THEN {_INFINITE + 1}L WHEN {a} = 0D THEN 0L WHEN {a} = double('Infinity') THEN {_INFINITE}L "
        f"WHEN {a} < {p} AND {e} > -1022L THEN {magnitude(-1, '0.5D')} WHEN {a} / {p} >= 2D THEN {magnitude(1, '2D')} "
        f"ELSE {magnitude(0, '1D')} END * CASE WHEN {_q(col)} < 0 THEN -1L ELSE 1L END"
    )


def _images(col: str, dt: T.DataType) -> list[Column]:
    """Order-preserving longs of a value that is no text, most significant first."""
    c = F.col(_q(col))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return [_floating(col)]
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return [c.cast("long")]
    if isinstance(dt, T.DateType):
        return [F.unix_date(c).cast("long")]
    if isinstance(dt, T.TimestampType):
        return [F.unix_micros(c)]
    if isinstance(dt, T.TimestampNTZType):  # by its fields: no time zone takes part
        day = F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000)
        micros = F.expr(f"cast(extract(SECOND FROM {_q(col)}) * 1000000 AS BIGINT)")
        return [day + (F.hour(c) * 60 + F.minute(c)).cast("long") * F.lit(60_000_000) + micros]
    if isinstance(dt, T.DecimalType) and dt.precision <= 18:
        return [(c * F.lit(10 ** dt.scale).cast(f"decimal({dt.scale + 1},0)")).cast("decimal(38,0)").cast("long")]
    if isinstance(dt, T.DecimalType) and dt.scale <= 18:
        fraction = f"({_q(col)} % 1BD)"
        whole = f"cast({_q(col)} - {fraction} AS DECIMAL(38,0))"
        return [
            F.expr(f"{whole} div {_WIDE}BD"),
            F.expr(f"cast({whole} % {_WIDE}BD AS BIGINT)"),
            F.expr(f"cast(cast({fraction} AS DECIMAL(19,{dt.scale})) * {10 ** dt.scale}BD AS BIGINT)"),
        ]
    raise ValueError(f"no order statistics of {dt.simpleString()}: {col}")


def _text_image(col: str, start: int) -> Column:
    """Seven bytes of a text from byte ``start`` (0-based) and how many there are."""
    part = f"substring(cast({_q(col)} AS BINARY), {start + 1}, {TEXT_BYTES})"
    return F.expr(f"cast(conv(rpad(hex({part}), {2 * TEXT_BYTES}, '0'), 16, 10) AS BIGINT) * 8 + length({part})")


def _value(images: list[int], dt: T.DataType):
    """The value of its images, as ``collect`` gives it."""
    i = images[0]
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        if abs(i) > _INFINITE:
            return math.nan
        v = struct.unpack(">d", struct.pack(">q", abs(i)))[0]
        return -v if i < 0 else v
    if isinstance(dt, T.BooleanType):
        return bool(i)
    if isinstance(dt, T.DateType):
        return datetime.date(1970, 1, 1) + datetime.timedelta(days=i)
    if isinstance(dt, T.TimestampType):
        return dt.fromInternal(i)
    if isinstance(dt, T.TimestampNTZType):
        return datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=i)
    if isinstance(dt, T.DecimalType):
        unscaled = i if len(images) == 1 else (images[0] * _WIDE + images[1]) * 10 ** dt.scale + images[2]
        digits = tuple(int(d) for d in str(abs(unscaled)))
        return Decimal((int(unscaled < 0), digits, -dt.scale))
    return i


# ---- selection


class _Rank:
    """One wanted rank of a column and the rows still in question: those whose first images are ``found`` (a text: that
    begin with ``prefix``) and whose next image is in ``lo..hi`` (None: any)."""

    __slots__ = ("want", "col", "k", "below", "inside", "found", "prefix", "lo", "hi", "value", "done")

    def __init__(self, want: int, col: str, k: int, n: int):
        self.want, self.col, self.k = want, col, k
        self.below, self.inside = 0, n
        self.found: tuple = ()
        self.prefix = b""
        self.lo = self.hi = None
        self.value, self.done = None, False

    def range(self) -> tuple:
        return self.col, self.found, self.prefix, self.lo, self.hi, self.inside <= 2 ** BITS


def _is_text(dt: T.DataType) -> bool:
    return isinstance(dt, T.StringType)


def _round(df: DataFrame, ranges: list[tuple], types: dict[str, T.DataType]) -> list[list[tuple]]:
    """Of each range, in the order of its digits: (rows, smallest image, largest image)."""
    images: dict[tuple, Column] = {}  # (column, number of the image or start of the text's bytes)
    for col, found, prefix, *_ in ranges:
        if _is_text(types[col]):
            images.setdefault((col, len(prefix)), _text_image(col, len(prefix)))
        else:
            for j, image in enumerate(_images(col, types[col])[: len(found) + 1]):
                images.setdefault((col, j), image)
    name = {key: f"__i{i}" for i, key in enumerate(images)}
    texts = {col: f"__t{i}" for i, col in enumerate(dict.fromkeys(r[0] for r in ranges if r[2]))}
    base = df.select(*[image.alias(name[key]) for key, image in images.items()],
                     *[F.col(_q(col)).cast("binary").alias(t) for col, t in texts.items()])
    parts = []
    for at, (col, found, prefix, lo, hi, small) in enumerate(ranges):
        image = F.col(name[col, len(prefix) if _is_text(types[col]) else len(found)])
        inside = image.isNotNull()
        for j, v in enumerate(found):
            inside = inside & (F.col(name[col, j]) == F.lit(v))
        if prefix:
            inside = inside & (F.substring(F.col(texts[col]), 1, len(prefix)) == F.lit(prefix))
        if lo is not None:
            inside = inside & image.between(F.lit(lo), F.lit(hi))
        if small:
            digit = image
        elif lo is None:
            digit = F.shiftright(image, 64 - BITS)
        else:  # from one digit of a round before, so hi - lo is a long
            digit = F.shiftright(image - F.lit(lo), max(0, (hi - lo).bit_length() - BITS))
        parts.append(F.when(inside, F.struct(F.lit(at).alias("r"), digit.cast("long").alias("d"), image.alias("v"))))
    rows = (
        base.select(F.explode(F.array(*parts)).alias("e")).where(F.col("e").isNotNull()).select("e.*")
        .groupBy("r", "d").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    )
    out: list[list[tuple]] = [[] for _ in ranges]
    for row in sorted(rows, key=lambda x: (x["r"], x["d"])):
        out[row["r"]].append((row["n"], row["lo"], row["hi"]))
    return out


def _rounds(df: DataFrame, ranges: list[tuple], types: dict[str, T.DataType]) -> dict[tuple, list[tuple]]:
    """``_round`` over any number of ranges, equal ones once, ``PORTION`` in a pass."""
    todo = list(dict.fromkeys(ranges))
    out: dict[tuple, list[tuple]] = {}
    for i in range(0, len(todo), PORTION):
        out.update(zip(todo[i : i + PORTION], _round(df, todo[i : i + PORTION], types)))
    return out


def _narrow(r: _Rank, digits: list[tuple], dt: T.DataType) -> bool:
    """Keeps the digit that holds the rank; True if a text goes on behind a found image."""
    for n, lo, hi in digits:
        if r.below + n >= r.k:
            break
        r.below += n
    r.inside = n
    if lo != hi:
        r.lo, r.hi = lo, hi
        return False
    r.lo = r.hi = None
    if _is_text(dt):
        size = lo & 7
        r.prefix += (lo >> 3).to_bytes(TEXT_BYTES, "big")[:size]
        if size == TEXT_BYTES:
            return True
        r.value, r.done = r.prefix.decode("utf-8", "replace"), True
    else:
        r.found += (lo,)
        if len(r.found) == _width(dt):
            r.value, r.done = _value(list(r.found), dt), True
    return False


def _width(dt: T.DataType) -> int:
    return 3 if isinstance(dt, T.DecimalType) and dt.precision > 18 else 1


def _skip_common(df: DataFrame, ranks: list[_Rank]) -> None:
    """Texts go on where the smallest and the largest one in question differ; if they are equal, that is the value."""
    for at in range(0, len(ranks), PORTION):
        part = ranks[at : at + PORTION]
        ends = []
        for i, r in enumerate(part):
            raw = F.col(_q(r.col)).cast("binary")
            held = F.when(F.substring(raw, 1, len(r.prefix)) == F.lit(r.prefix), raw)
            ends += [F.min(held).alias(f"lo{i}"), F.max(held).alias(f"hi{i}")]
        row = df.agg(*ends).first()
        for i, r in enumerate(part):
            lo, hi = bytes(row[f"lo{i}"]), bytes(row[f"hi{i}"])
            if lo == hi:
                r.value, r.done = lo.decode("utf-8", "replace"), True
            else:
                same = next((j for j, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
                r.prefix = lo[:same]


def select_ranks(
    df: DataFrame,
    wants: list[tuple[str, Callable[[int], list[int]], list[float]]],
    n_known: dict[str, int] | None = None,
) -> list[tuple[int, list]]:
    """For each ``(column, ranks_of_n, shares)``: ``ranks_of_n(n)`` gives 1-based
    ranks among the ``n`` non-null values.  Returns ``(n, [value per rank])`` per
    want.  ``n_known``: non-null counts that the caller already has."""
    if not wants:
        return []
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(dict.fromkeys(c for c, _, _ in wants))
    for c in cols:
        if not _is_text(types[c]):
            _images(c, types[c])  # refuses types without an order
    n_of = dict(n_known or {})
    # the first round counts the column where the caller has not
    whole = {c: (c, (), b"", None, None, n_of.get(c, math.inf) <= 2 ** BITS) for c in cols if n_of.get(c) != 0}
    first = _rounds(df, list(whole.values()), types)
    for c in cols:
        n_of[c] = sum(n for n, _, _ in first[whole[c]]) if c in whole else 0
    ranks = [_Rank(w, c, int(k), n_of[c]) for w, (c, fn, _) in enumerate(wants) for k in (fn(n_of[c]) if n_of[c] else [])]
    found = {r: first[whole[r.col]] for r in ranks}
    while found:
        longer = [r for r, digits in found.items() if _narrow(r, digits, types[r.col])]
        _skip_common(df, longer)
        active = [r for r in found if not r.done]
        by_range = _rounds(df, [r.range() for r in active], types)
        found = {r: by_range[r.range()] for r in active}
    out: list[tuple[int, list]] = [(n_of[c], []) for c, _, _ in wants]
    for r in ranks:
        out[r.want][1].append(r.value)
    return out


def order_statistics(df: DataFrame, shares: dict[str, list[float]]) -> DataFrame:
    """One row per column and share: the first value whose cumulative share reaches it, as text
    (``column_name, share, non_null, value``); null for a column without values."""
    wants = [(c, *disc(p)) for c, ps in shares.items() for p in ps]
    got = select_ranks(df, wants)
    rows = [(c, p[0], n, _shown(v[0]) if v else None) for (c, _, p), (n, v) in zip(wants, got)]
    return df.sparkSession.createDataFrame(rows, "column_name STRING, share DOUBLE, non_null BIGINT, value STRING")


def _shown(v) -> str:
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ", timespec="microseconds")
    return v.isoformat() if isinstance(v, datetime.date) else str(v)


# ---- rank rules


def disc(p: float):
    """Want for ``percentile_disc(p)``: the first value whose cumulative share reaches p."""

    def fn(n: int) -> list[int]:
        return [min(n, max(1, math.ceil(p * n - 1e-9)))]

    return fn, [p]


def median_ranks(n: int) -> list[int]:
    """Interpolated median: the two middle values (the same one when n is odd)."""
    return [(n - 1) // 2 + 1, n // 2 + 1]


MEDIAN = (median_ranks, [0.5, 0.5])


def median_of(values: list) -> float | None:
    if not values:
        return None
    a, b = float(values[0]), float(values[1])
    return a + (b - a) * 0.5


def profile_ranks(n: int) -> list[int]:
    """The reference's p01 / p99 rule (0-based i01 = max(0, floor(n*0.01) - 1),
    i99 = min(n-1, floor(n*0.99))), as 1-based ranks."""
    return [max(0, int(n * 0.01) - 1) + 1, min(n - 1, int(n * 0.99)) + 1]


PROFILE = (profile_ranks, [0.01, 0.99])
