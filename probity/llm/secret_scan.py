r"""Secret scans by corpus-wide ownership frequency. DataFrame operations only.

A base scan finds assignments, access keys and long hex strings; a wider scan proposes token-like strings. The hash of
every candidate value is aggregated over the corpus: by its repositories (different texts, so copies of a text count
once) and by its owners (``source``). A value in many repositories of several owners is an example that was copied; one
that a single owner holds, or that few repositories have, looks like a live credential. Live-looking token strings join
the spans; base spans always stay, each with its class.

Places are running sums over the matches of a text, and overlaps are found by running maxima, so the work is linear (but
for sorting) in a text's matches. Documents without candidates take part in no shuffle. A hot value is aggregated by
(value, text) and (value, owner) before it is counted, and joined back by value.

Spans are in code points, end exclusive. Defined results: a null text is empty; an empty text has no spans; a null
source is an owner of its own; rows that are equal in doc_id, source and text count as one document and get the same
result; an empty table gives an empty table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probity.llm.common import cut, row_key

ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that has 24 (20) characters is the same as any run that then must have as many.
HEX = r"[0-9a-f]{24,}"
ACCESS = r"AKIA[A-Z0-9]{16,}"
#: Vendor prefixes, three-part web tokens, and long strings with capitals, small letters and digits (looked up behind).
TOKEN = r"(?:(?:gh[pousr]|glpat|sk_live|rk_live|xox[abprs])[_-][A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|[A-Za-z0-9_]{32,})"
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "token": TOKEN}
BASE = ("assign", "access", "hex")
#: (owners, repositories) from which on a value is an example; either pair will do.
EXAMPLE = ((3, 3), (2, 10))
MASK = "[SECRET]"
#: Texts are rebuilt from pieces of so many code points.
PIECE = 512
NO_OWNER = "-"


def _matches(text: Column, kind: str) -> Column:
    """All matches of a kind, in order: array of struct(kind, i, gap before it, len, value)."""
    pattern = F.lit(KINDS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else found
    # what a lambda names is evaluated for each element: it is given the arrays zipped, made once
    rows = F.arrays_zip(F.split(text, KINDS[kind], -1).alias("gap"), found.alias("whole"), value.alias("value"))
    order = list(KINDS).index(kind)
    each = F.transform(rows, lambda m, i: F.struct(F.lit(order).alias("kind"), i.alias("i"), F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("len"), m["value"].alias("value")))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,value:string>>")
    # the last gap is the text after the last match
    return F.when(text.rlike(KINDS[kind]), F.filter(each, lambda m: m["len"].isNotNull())).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, source, row_key and text_key (null without matches), matches: one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", "source", F.col("text"), F.concat(*(_matches(text, k) for k in KINDS)).alias("matches"))
    some = F.size("matches") > 0
    key = row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    return found.select("doc_id", "source", F.when(some, key).alias("row_key"), F.when(some, F.md5(text.cast("binary"))).alias("text_key"), "matches")


def candidates(found: DataFrame) -> DataFrame:
    """row_key, text_key, source, start, kind, end, value: base spans, and wider ones that overlap none, of the documents
    (each once) of :func:`scan`."""
    units = found.filter("row_key IS NOT NULL").dropDuplicates(["row_key"])
    rows = units.select("row_key", "text_key", "source", F.explode("matches").alias("m")).select("row_key", "text_key", "source", "m.*")
    before = Window.partitionBy("row_key", "kind").orderBy("i")
    end = F.sum(F.col("gap").cast("long") + F.col("len")).over(before)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    base, value = F.col("kind") < len(BASE), F.col("value")
    token = (value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")) | value.rlike("^(gh[pousr]|glpat|sk_live|rk_live|xox[abprs])[_-]")
    rows = rows.filter((base & ((F.col("kind") != list(KINDS).index("assign")) | (F.length("value") >= 6))) | (~base & token))
    # the end of the base spans that start up to here, and the start of those that start from here on
    up, down = Window.partitionBy("row_key").orderBy("start"), Window.partitionBy("row_key").orderBy(F.desc("start"))
    rows = rows.withColumns({"_before": F.max(F.when(base, F.col("end"))).over(up), "_after": F.min(F.when(base, F.col("start"))).over(down)})
    free = (F.col("_before").isNull() | (F.col("_before") <= F.col("start"))) & (F.col("_after").isNull() | (F.col("_after") >= F.col("end")))
    return rows.filter(base | free).select("row_key", "text_key", "source", "start", "kind", "end", "value")


def ownership(spans: DataFrame, example: tuple[tuple[int, int], ...] = EXAMPLE) -> DataFrame:
    """value_hash, repositories (different texts), owners (sources), live: one row per candidate value of the corpus."""
    seen = spans.select(F.sha2("value", 256).alias("value_hash"), "text_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(NO_OWNER)).alias("_owner"))
    out = seen.groupBy("value_hash").agg(F.count_distinct("text_key").alias("repositories"), F.count_distinct("_owner").alias("owners"))
    copied = F.lit(False)
    for owners, repositories in example:
        copied = copied | ((F.col("owners") >= owners) & (F.col("repositories") >= repositories))
    return out.withColumn("live", ~copied)


def _judged(spans: DataFrame, example: tuple[tuple[int, int], ...]) -> DataFrame:
    """Base spans, and wider ones that look live, each with live, repositories and owners."""
    known = ownership(spans, example).withColumnRenamed("value_hash", "_known")
    judged = spans.withColumn("_hash", F.sha2("value", 256)).join(known, F.col("_hash") == F.col("_known"))
    return judged.filter((F.col("kind") < len(BASE)) | F.col("live"))


def secrets(docs: DataFrame, example: tuple[tuple[int, int], ...] = EXAMPLE) -> DataFrame:
    """One row per document: doc_id, row_key, spans (base and live-looking tokens, each with its class)."""
    found = cut(scan(docs))
    judged = _judged(cut(candidates(found)), example)
    one = F.struct("start", "kind", "end", "value", "live", "repositories", "owners")
    marked = judged.groupBy("row_key").agg(F.array_sort(F.collect_list(one)).alias("spans")).withColumnRenamed("row_key", "_key")
    none = F.array().cast(marked.schema["spans"].dataType)
    # only documents with matches go through the join: the others have no key to be dealt by
    some = found.filter("row_key IS NOT NULL").join(marked, F.col("row_key") == F.col("_key"), "left")
    some = some.select("doc_id", "row_key", F.coalesce("spans", none).alias("spans"))
    return some.unionByName(found.filter("row_key IS NULL").select("doc_id", "row_key", none.alias("spans")))


def redacted(docs: DataFrame, example: tuple[tuple[int, int], ...] = EXAMPLE, mask: str = MASK) -> DataFrame:
    """``docs`` with every live-looking span replaced by ``mask``, overlapping spans by one; n_chars, if a column, is
    counted anew."""
    live = _judged(cut(candidates(cut(scan(docs)))), example).filter("live").select("row_key", "start", "end")
    # a span that starts behind the end of all before it begins a new group
    ordered = Window.partitionBy("row_key").orderBy("start", "end")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    groups = live.withColumn("_new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("long")).withColumn("_group", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    merged = groups.groupBy("row_key", "_group").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    found = cut(merged.groupBy(F.col("row_key").alias("_key")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_live")))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("_mine"))
    both = rows.join(found, F.col("_mine") == F.col("_key"), "left")
    # the text between the spans, cut out of pieces of a fixed length
    far = F.lit((1 << 31) - 1).cast("long")
    kept = F.arrays_zip(F.concat(F.array(F.lit(0).cast("long")), F.col("_live.end")).alias("a"), F.concat(F.col("_live.start"), F.array(far)).alias("b"))

    def between(s: Column, bits: Column) -> Column:
        stop = F.least(s["b"], F.size(bits).cast("long") * PIECE)
        first, last = F.floor(s["a"] / PIECE).cast("int"), F.ceil(stop / PIECE).cast("int")
        near = F.array_join(F.slice(bits, first + 1, F.greatest(last - first, F.lit(0))), "")
        return F.substr(near, (s["a"] - first * F.lit(PIECE) + 1).cast("int"), (stop - s["a"]).cast("int"))

    bits = F.regexp_extract_all(F.col("_row.text"), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    text = F.get(F.transform(F.array(bits), lambda b: F.array_join(F.transform(kept, lambda s: between(s, b)), mask)), F.lit(0))
    out = both.select("_row", F.when(F.col("_live").isNull(), F.col("_row.text")).otherwise(text).alias("_new"))
    mine = lambda c: F.col("_row").getField(c)
    new = {"text": F.col("_new"), "n_chars": F.when(F.col("_new").eqNullSafe(mine("text")), mine("n_chars")).otherwise(F.length("_new")) if "n_chars" in docs.columns else None}
    return out.select(*((new[c].cast(docs.schema[c].dataType) if c in new else mine(c)).alias(c) for c in docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(k) for k in KINDS))
    told = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == list(KINDS).index(k))).cast("long").alias(f"n_{k}")
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live")
    return secrets(docs).select("doc_id", *(count(k) for k in BASE), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), live)


def _sql_spans(kind: str) -> str:
    pattern = KINDS[kind].replace("'", "''")
    value = f"list_extract(regexp_extract_all(t, '{pattern}', 2), i)" if kind == "assign" else f"list_extract(regexp_extract_all(t, '{pattern}', 0), i)"
    keep = {"assign": "length(value) >= 6", "token": r"((regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')) OR regexp_matches(value, '^(gh[pousr]|glpat|sk_live|rk_live|xox[abprs])[_-]'))"}.get(kind, "true")
    return f"""SELECT k, {list(KINDS).index(kind)} AS kind, '{kind}' AS name, start, start + n AS stop, value FROM (
      SELECT k, {value} AS value, length(m[i]) AS n,
        coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)::BIGINT AS start
      FROM (SELECT k, t, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT k, t, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_split_to_array(t, '{pattern}') AS g FROM d) WHERE len(m) > 0)) WHERE {keep}"""


_SQL_EXAMPLE = " OR ".join(f"(owners >= {o} AND repositories >= {r})" for o, r in EXAMPLE)
ORACLE = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, md5(concat_ws('|', '', coalesce('d' || doc_id, '-'), coalesce('s' || source, '-'), coalesce(md5(text), '-'))) AS k FROM documents),
base AS ({" UNION ALL ".join(_sql_spans(k) for k in BASE)}),
wide AS (SELECT w.* FROM ({_sql_spans("token")}) w WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.k = w.k AND b.start < w.stop AND w.start < b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM wide),
owned AS (SELECT value, NOT ({_SQL_EXAMPLE}) AS live FROM (SELECT value, count(DISTINCT coalesce('s' || source, '{NO_OWNER}')) AS owners, count(DISTINCT t) AS repositories
  FROM every JOIN (SELECT DISTINCT k, source, t FROM d) USING (k) GROUP BY value)),
b AS (SELECT k, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
      string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS told FROM base GROUP BY k),
a AS (SELECT k, string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans, count(*) FILTER (live) AS n_live
      FROM every JOIN owned USING (value) WHERE kind < 3 OR live GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(told, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live
FROM d LEFT JOIN b USING (k) LEFT JOIN a USING (k)
"""
