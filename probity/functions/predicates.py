"""Column-expression helpers used by the row-level checks.

Everything here returns a JVM-side ``Column``: no Python UDF, so every check
stays inside whole-stage codegen of the fused aggregate.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _dec
import json
import zlib
from typing import Any, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strftime directive -> Spark datetime pattern letter(s).
STRFTIME_TO_SPARK = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%j": "DDD",
    "%z": "Z",
    "%%": "%",
}

# Default format list for the "dateutil parseable" check (a stated list of
# formats replaces free-form per-row parsing; see SURVEY E24).
DEFAULT_DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd.MM.yyyy",
    "yyyyMMdd",
    "dd MMM yyyy",
    "MMM dd, yyyy",
]


def strftime_to_spark(fmt: str) -> str:
    """Translate a strftime format to a Spark datetime pattern; literal text is quoted."""
    out, i, lit = [], 0, []

    def flush():
        if lit:
            text = "".join(lit).replace("'", "''")
            out.append(text if all(not ch.isalpha() for ch in text) else f"'{text}'")
            lit.clear()

    while i < len(fmt):
        tok = fmt[i : i + 2]
        if fmt[i] == "%" and tok in STRFTIME_TO_SPARK:
            flush()
            out.append(STRFTIME_TO_SPARK[tok])
            i += 2
        else:
            lit.append(fmt[i])
            i += 1
    flush()
    return "".join(out)


def parses_as(c: Column, spark_fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(spark_fmt)).isNotNull()


def matches_strftime(c: Column, strftime_fmt: str) -> Column:
    """Parses under the format and formats back to the very same text."""
    fmt = strftime_to_spark(strftime_fmt)
    ts = F.try_to_timestamp(c, F.lit(fmt))
    return F.coalesce(ts.isNotNull() & (F.date_format(ts, fmt) == c), F.lit(False))


def parseable_any(c: Column, formats: Iterable[str] | None) -> Column:
    fmts = list(formats or DEFAULT_DATE_FORMATS)
    fmts = [strftime_to_spark(f) if "%" in f else f for f in fmts]
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in fmts]).isNotNull()


def json_whole_value(c: Column) -> Column:
    """True when the whole text is exactly one JSON value.

    ``try_parse_json`` alone accepts trailing text, so the value is also
    wrapped in an array (exactly one element) and in an object field."""
    wrapped_arr = F.concat(F.lit("["), c, F.lit("]"))
    wrapped_obj = F.concat(F.lit('{"v":'), c, F.lit("}"))
    return F.coalesce(
        (F.json_array_length(wrapped_arr) == 1)
        & F.try_parse_json(wrapped_arr).isNotNull()
        & F.try_parse_json(wrapped_obj).isNotNull(),
        F.lit(False),
    )


# JSON-schema type name -> accepted variant type names (schema_of_variant output prefix).
_JSON_TYPES = {
    "integer": ("BIGINT", "INT", "SMALLINT", "TINYINT"),
    "number": ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
    "null": ("VOID",),
}


def matches_json_schema(c: Column, schema: dict) -> Column:
    """Object with the ``required`` keys present and ``properties`` of the stated types.

    Supports the common subset: top-level ``type: object``, ``required`` and
    per-property ``type`` (string or list).  Absent optional keys pass."""
    v = F.try_parse_json(c)
    ok = v.isNotNull() & json_whole_value(c)
    if schema.get("type", "object") == "object":
        ok = ok & F.schema_of_variant(v).startswith("OBJECT")
    props = schema.get("properties") or {}
    for key in schema.get("required") or []:
        ok = ok & F.try_variant_get(v, f"$.{key}", "variant").isNotNull()
    for key, sub in props.items():
        types = sub.get("type")
        if not types:
            continue
        types = [types] if isinstance(types, str) else list(types)
        field = F.try_variant_get(v, f"$.{key}", "variant")
        tname = F.schema_of_variant(field)
        accepted = F.lit(False)
        for t in types:
            for prefix in _JSON_TYPES.get(t, ()):
                accepted = accepted | tname.startswith(prefix)
        ok = ok & (field.isNull() | accepted)
    return F.coalesce(ok, F.lit(False))


_INT_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _exact_int(v: Any, bits: int) -> int:
    """``v`` as an integer of ``bits`` bits, never by way of a double; ValueError if it is none."""
    d = _dec.Decimal(int(v)) if isinstance(v, bool) else _dec.Decimal(str(v).strip())
    if not d.is_finite() or d != d.to_integral_value():
        raise ValueError(v)
    n = int(d)
    if not -(1 << (bits - 1)) <= n < 1 << (bits - 1):
        raise ValueError(v)
    return n


def _exact_bool(v: Any) -> bool:
    text = str(v).strip().lower()
    if text in ("true", "1"):
        return True
    if text in ("false", "0"):
        return False
    raise ValueError(v)


def coerce_members(values: Iterable[Any], dtype: T.DataType) -> tuple[list[Any], list[Any]]:
    """A value set in the column's type, and the members that do not fit it.

    Contracts declare e.g. the strings '1'..'5' for an integer column; a bare
    ``c IN ('1', 'x')`` throws under ANSI.  A member that does not convert can
    never equal a value of the column, but it still belongs to the set."""
    out, unfit = [], []
    for v in values:
        if v is None:
            continue
        try:
            if type(dtype) in _INT_BITS:
                out.append(_exact_int(v, _INT_BITS[type(dtype)]))
            elif isinstance(dtype, (T.FloatType, T.DoubleType)):
                out.append(float(v))
            elif isinstance(dtype, T.DecimalType):
                out.append(_dec.Decimal(str(v)))
            elif isinstance(dtype, T.BooleanType):
                out.append(_exact_bool(v))
            elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
                out.append(v if isinstance(v, _dt.datetime) else _dt.datetime.fromisoformat(str(v)))
            elif isinstance(dtype, T.DateType):
                out.append(v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)))
            elif isinstance(dtype, T.StringType):
                out.append(str(v))
            else:
                out.append(v)
        except (ValueError, TypeError, ArithmeticError):
            unfit.append(v)
    return out, unfit


def coerce_values(values: Iterable[Any], dtype: T.DataType) -> list[Any]:
    """The members of a value set that fit the column's type."""
    return coerce_members(values, dtype)[0]


def normalized(c: Column, chk) -> Column:
    """Optional value normalisation of a check: ``trim`` (e.g. a trailing tab in a
    code) and ``case_insensitive`` (the ``UTF8_LCASE`` collation, so equality,
    IN, grouping and join keys ignore case, as MySQL's default collations do)."""
    if chk.p("trim"):
        c = F.btrim(c, F.lit(" \t\r\n"))  # blanks and control whitespace, not spaces only
    if chk.p("case_insensitive"):
        c = F.collate(c, "UTF8_LCASE")
    return c


def fold(text: Any) -> Any:
    """A member of a case-insensitive set, in the spelling ``folded`` gives the column."""
    return "".join(x.lower() for x in text.replace("Σ", "σ").replace("ς", "σ")) if isinstance(text, str) else text


def folded(c: Column) -> Column:
    """Case folded by the plain collation: members of any number are then one hash lookup."""
    return F.lower(F.translate(F.collate(c, "UTF8_BINARY"), "Σς", "σσ"))


def members(values: Iterable[Any], dtype: T.DataType, chk) -> tuple[list[Any], int]:
    """The distinct members under the check's normalisation, and how many distinct ones do not fit the type."""
    fit, unfit = coerce_members(values, dtype)
    same = fold if chk.p("case_insensitive") else (lambda v: v)
    return list(dict.fromkeys(map(same, fit))), len({str(v) for v in unfit})


def is_member(c: Column, values: list[Any], chk) -> Column:
    """Membership of a column in ``members`` of a check, whatever their number."""
    if chk.p("trim"):
        c = F.btrim(c, F.lit(" \t\r\n"))
    return in_set(folded(c) if chk.p("case_insensitive") else c, values)


#: A plan setting: members written into the plan one by one; more are one literal.
#: Both forms test the same equality.
INLINE = 200


def in_set(c: Column, values: list[Any]) -> Column:
    """Membership in a list of members of one type.

    A short list is an ``IN``, which a scan can push down.  A long list of
    integers or texts is one constant: the members dealt into buckets by a hash
    (integers by remainder, texts by CRC-32 of their UTF-8 bytes), of which a
    value looks into its own, so neither the plan nor the work per row grows
    with the list."""
    if not values:
        return F.lit(False)
    whole = all(type(v) is int for v in values)
    if len(values) <= INLINE or not (whole or all(type(v) is str for v in values)):
        return c.isin(*values)
    n = len(values)
    buckets: list[list[Any]] = [[] for _ in range(n)]
    for v in values:
        buckets[v % n if whole else zlib.crc32(v.encode()) % n].append(v)
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<bigint>>" if whole else "array<array<string>>")
    key = c.cast("bigint") if whole else F.collate(c, "UTF8_BINARY")
    at = F.pmod(key if whole else F.crc32(key.cast("binary")), F.lit(n))
    return F.array_contains(F.get(table, at.cast("int")), key)


def like_any(c: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.like(p)
    return out


def like_all(c: Column, patterns: list[str]) -> Column:
    out = F.lit(True)
    for p in patterns:
        out = out & c.like(p)
    return out


def rlike_any(c: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike(p)
    return out


def rlike_all(c: Column, patterns: list[str]) -> Column:
    out = F.lit(True)
    for p in patterns:
        out = out & c.rlike(p)
    return out


def sentinel_to_null(c: Column, sentinels: Iterable[Any]) -> Column:
    """Missing-value normalisation: sentinel texts (after trim) become null."""
    texts = [str(s) for s in sentinels if s is not None]
    if not texts:
        return c
    return F.when(F.trim(c.cast("string")).isin(*texts), F.lit(None)).otherwise(c)
