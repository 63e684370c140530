r"""Chat formatting by schema fingerprinting. DataFrame operations only.

Records of any layout are variants. The nested field paths of a record (``messages[].role``) that any layout knows are
hashed; the fingerprint selects a declarative :class:`Layout`, which says where turns, roles and texts are. So prompt,
instruction and message records and single turns kept as rows all become canonical turns, and a conversation may be
spread over any number of records. A record whose fingerprint no layout has gives no turns and is counted, never guessed.

A :class:`Template` puts marks around the turns. Wherever a text holds a mark, a backslash is put behind the mark's
first character (one more, if backslashes stand there already), so that no text can end a turn, and taking one away
gives the text back exactly. The result is the formatted conversation and its loss mask: the code points, end
exclusive, of the assistant's texts. :func:`read_back` parses both again.

Places are running sums over a conversation's turns and spans are cut out of pieces of a fixed length, so the work is
linear in the length of a conversation. A conversation is one row of the result, hence in one task at the end; nothing
else is gathered.

Defined results: a null text is empty, a null role is the empty role; a null key belongs to no conversation: each such
record is one of its own; turns are in order of (turn, null last; place in the record; role; text), so repeated rows are
repeated turns; a record without turns gives an empty conversation; a null record is unmapped; an empty table gives an
empty table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Spans are cut out of pieces of so many code points.
PIECE = 512
NOTHING = "array<string>"


@dataclass(frozen=True)
class Turns:
    """Where a layout holds turns: one for each element of the array ``each``, else one. ``role`` is a path that starts
    with a dot, or else the role itself; the texts that are there are joined by an empty line."""

    text: tuple[str, ...]
    role: str
    each: str = ""


@dataclass(frozen=True)
class Layout:
    """A declarative mapping. Records have the paths ``needs`` and any of the groups of paths ``may``."""

    name: str
    needs: tuple[str, ...]
    turns: tuple[Turns, ...]
    may: tuple[tuple[str, ...], ...] = ()
    order: str = ""
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def fingerprints(self) -> list[str]:
        groups = [g for n in range(len(self.may) + 1) for g in combinations(self.may, n)]
        return [_hash({*self.needs, *(p for g in chosen for p in g)}) for chosen in groups]


def _hash(paths: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


NAMES = {"human": "user", "gpt": "assistant", "chatgpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("turn", ("conv_id", "turn", "role", "text"), (Turns((".text",), ".role"),), order="turn"),
    Layout("messages", ("messages",), (Turns((".system",), "system"), Turns((".content",), ".role", "messages")), (("messages[]", "messages[].role", "messages[].content"), ("conv_id",), ("prompt",), ("system",))),
    Layout("shares", ("conversations",), (Turns((".system",), "system"), Turns((".value",), ".from", "conversations")), (("conversations[]", "conversations[].from", "conversations[].value"), ("conv_id",), ("system",)), roles=NAMES),
    Layout("instruction", ("instruction", "output"), (Turns((".system",), "system"), Turns((".instruction", ".input"), "user"), Turns((".output",), "assistant")), (("input",), ("conv_id",), ("system",))),
    Layout("prompt", ("prompt", "completion"), (Turns((".system",), "system"), Turns((".prompt",), "user"), Turns((".completion",), "assistant")), (("conv_id",), ("system",))),
    Layout("response", ("prompt", "response"), (Turns((".system",), "system"), Turns((".prompt",), "user"), Turns((".response",), "assistant")), (("conv_id",), ("system",))),
    Layout("question", ("question", "answer"), (Turns((".system",), "system"), Turns((".question",), "user"), Turns((".answer",), "assistant")), (("conv_id",), ("system",))),
)


@dataclass(frozen=True)
class Template:
    """Marks before and after the turns of each role; ``other`` (before the role, between role and text, after) for the
    rest. A mark's first character may stand in no mark but as the first, so that marks cannot overlap."""

    marks: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    loss: str = "assistant"

    def __post_init__(self):
        every, first = self.every(), {m[0] for m in self.every()}
        if len(set(every)) < len(every) or any(a != b and b.startswith(a) for a in every for b in every):
            raise ValueError("marks must differ, and none may begin another")
        if any(c in first or c == "\\" for m in every for c in m[1:]) or "\\" in first:
            raise ValueError("a mark's first character, or a backslash, stands inside a mark")

    def every(self) -> list[str]:
        return [m for pair in self.marks.values() for m in pair] + list(self.other)

    def held(self) -> tuple[str, str]:
        """Patterns (Java and RE2) of a mark's first character, of its rest."""
        quote = lambda s: re.sub(r"([^A-Za-z0-9/])", r"\\\1", s)
        return "[" + "".join(sorted({quote(m[0]) for m in self.every()})) + "]", "|".join(sorted({quote(m[1:]) for m in self.every()}, key=lambda s: (-len(s), s)))

    def pattern(self) -> str:
        """One formatted turn."""
        quote = lambda s: re.sub(r"([^A-Za-z0-9/])", r"\\\1", s)
        return "(?s)" + "|".join(".*?".join(map(quote, ms)) for ms in [*self.marks.values(), self.other])


TEMPLATE = Template({"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}, ("[ROLE]", "[TEXT]", "[/ROLE]"))


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    first, rest = template.held()
    return F.regexp_replace(text, F.lit(rf"({first})(\\*)({rest})"), F.lit(r"$1\\$2$3"))


def plain(text: Column, template: Template = TEMPLATE) -> Column:
    """The text that :func:`escaped` was given."""
    first, rest = template.held()
    return F.regexp_replace(text, F.lit(rf"({first})\\(\\*)({rest})"), F.lit("$1$2$3"))


def _paths(v: Column, prefix: Column, depth: int) -> Column:
    """Nested field paths of a variant, down to ``depth`` steps, with repeats."""
    none = F.array().cast(NOTHING)
    if not depth:
        return none

    def inside(e: Column) -> Column:
        path = F.concat(prefix, F.when(prefix == "", F.lit("")).otherwise(F.lit(".")), e["key"])
        return F.concat(F.array(path), _paths(e["value"], path, depth - 1))

    def element(x: Column) -> Column:
        path = F.concat(prefix, F.lit("[]"))
        return F.concat(F.array(path), _paths(x, path, depth - 1))

    fields = F.flatten(F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), inside))
    return F.coalesce(fields, F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), element)), none)


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The hash of the nested field paths that any layout knows; null for a null record."""
    known = sorted({p for s in layouts for p in (*s.needs, *(x for g in s.may for x in g))})
    depth = max(p.count(".") + p.count("[]") + 1 for p in known)
    mine = F.array_intersect(F.array(*map(F.lit, known)), _paths(record, F.lit(""), depth))
    return F.when(record.isNotNull(), F.md5(F.array_join(F.array_sort(mine), "\n").cast("binary")))


def _turns(record: Column, layout: Layout) -> Column:
    """array<struct<place, slot, role, text>> of a record of the layout."""

    def text_at(v: Column, path: str) -> Column:
        return F.try_variant_get(v, "$" + path, "string")

    def role_of(v: Column, t: Turns) -> Column:
        if not t.role.startswith("."):
            return F.lit(t.role)
        role = F.coalesce(text_at(v, t.role), F.lit(""))
        return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in layout.roles.items() for x in kv)), role), role) if layout.roles else role

    def turn(v: Column, t: Turns, slot: int, place: Column) -> Column:
        text = text_at(v, t.text[0]) if len(t.text) == 1 else F.concat_ws("\n\n", *(F.nullif(text_at(v, p), F.lit("")) for p in t.text))
        return F.struct(F.lit(slot).alias("slot"), place.cast("int").alias("place"), role_of(v, t).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    none = F.array().cast("array<struct<slot:int,place:int,role:string,text:string>>")
    parts = []
    for slot, t in enumerate(layout.turns):
        if t.each:
            items = F.try_variant_get(record, "$." + t.each, "array<variant>")
            parts.append(F.coalesce(F.transform(items, _nth(turn, t, slot)), none))
        else:
            one = F.array(turn(record, t, slot, F.lit(0)))
            # a place of its own that a layout may leave out, as a system text
            left_out = t.text[0][1:] in {p for g in layout.may for p in g}
            parts.append(F.when(text_at(record, t.text[0]).isNotNull(), one).otherwise(none) if left_out else one)
    return F.concat(*parts)


def _nth(turn, t: Turns, slot: int):
    return lambda x, i: turn(x, t, slot, i)


def canonical(records: DataFrame, key: str, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` (key, variant) -> key, _own, layout, fingerprint, at, slot, place, role, text: one row per turn, or one
    without a turn (slot null) for a record that has none. _own tells records with a null key apart."""
    rows = records.select(F.col(f"`{key}`").alias("key"), F.col(f"`{record}`").alias("_record"))
    rows = rows.withColumns({"_own": F.when(F.col("key").isNull(), F.monotonically_increasing_id()), "fingerprint": fingerprint(F.col("_record"), layouts)})
    names = {f: s.name for s in reversed(layouts) for f in s.fingerprints()}
    rows = rows.withColumn("layout", F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("fingerprint")))
    turns, at = F.lit(None), F.lit(None).cast("long")
    for s in layouts:
        turns = F.when(F.col("layout") == s.name, _turns(F.col("_record"), s)).otherwise(turns)
        if s.order:
            at = F.when(F.col("layout") == s.name, F.try_variant_get(F.col("_record"), "$." + s.order, "long")).otherwise(at)
    one = rows.select("key", "_own", "layout", "fingerprint", at.alias("at"), F.explode_outer(turns).alias("_t"))
    return one.select("key", "_own", "layout", "fingerprint", "at", "_t.slot", "_t.place", "_t.role", "_t.text")


def layouts_found(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """fingerprint, layout (null if none has it), n: what kinds of records there are, and how many of each."""
    names = {f: s.name for s in reversed(layouts) for f in s.fingerprints()}
    counts = records.select(fingerprint(F.col(f"`{record}`"), layouts).alias("fingerprint")).groupBy("fingerprint").agg(F.count("*").alias("n"))
    return counts.select("fingerprint", F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("fingerprint")).alias("layout"), "n")


def formatted(records: DataFrame, key: str, record: str, layouts: tuple[Layout, ...] = LAYOUTS, template: Template = TEMPLATE) -> DataFrame:
    """key, formatted, loss (array of start, end in code points), n_unmapped (records that no layout has): one row per
    conversation."""
    turns = canonical(records, key, record, layouts)
    role, text = F.col("role"), escaped(F.col("text"), template)
    before, after = F.concat(F.lit(template.other[0]), escaped(role, template), F.lit(template.other[1])), F.lit(template.other[2])
    for name, (a, b) in template.marks.items():
        before, after = F.when(role == name, F.lit(a)).otherwise(before), F.when(role == name, F.lit(b)).otherwise(after)
    there = F.col("slot").isNotNull()
    pieces = turns.withColumns({"_before": before, "_text": text})
    pieces = pieces.withColumns({"_from": F.length("_before").cast("long"), "_long": F.length("_text").cast("long"), "_piece": F.when(there, F.concat("_before", "_text", after))})
    order = Window.partitionBy("key", "_own").orderBy(F.col("at").asc_nulls_last(), "slot", "place", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("_start", F.coalesce(F.sum(F.length("_piece").cast("long")).over(order), F.lit(0)))
    # a piece is never empty, so its start alone gives the order
    one = F.struct("_start", "_piece", F.when(role == template.loss, F.col("_start") + F.col("_from")).alias("_a"), (F.col("_start") + F.col("_from") + F.col("_long")).alias("_b"))
    held = placed.groupBy("key", "_own").agg(F.array_sort(F.collect_list(F.when(there, one))).alias("_all"), F.count_if(F.col("layout").isNull()).alias("n_unmapped"))
    loss = F.transform(F.filter("_all", lambda p: p["_a"].isNotNull()), lambda p: F.struct(p["_a"].alias("start"), p["_b"].alias("end")))
    return held.select("key", F.array_join(F.transform("_all", lambda p: p["_piece"]), "").alias("formatted"), loss.alias("loss"), "n_unmapped")


def read_back(out: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Parses :func:`formatted` rows: and turns (array of role, text), loss_texts (array), all unescaped."""

    def turn(p: Column) -> Column:
        a, b, c = template.other
        role = plain(F.substring_index(F.substr(p, F.lit(len(a) + 1)), b, 1), template)
        # the text is what follows the first mark between role and text
        rest = F.substr(p, F.lit(len(a) + 1) + F.instr(F.substr(p, F.lit(len(a) + 1)), F.lit(b)) - 1 + len(b))
        text = F.substr(rest, F.lit(1), F.length(rest) - len(c))
        for name, (x, y) in template.marks.items():
            mine = F.startswith(p, F.lit(x))
            role = F.when(mine, F.lit(name)).otherwise(role)
            text = F.when(mine, F.substr(p, F.lit(len(x) + 1), F.length(p) - len(x) - len(y))).otherwise(text)
        return F.struct(role.alias("role"), plain(text, template).alias("text"))

    def masked(s: Column, bits: Column) -> Column:
        first, last = F.floor(s["start"] / PIECE).cast("int"), F.ceil(s["end"] / PIECE).cast("int")
        near = F.array_join(F.slice(bits, first + 1, F.greatest(last - first, F.lit(0))), "")
        return plain(F.substr(near, (s["start"] - first * F.lit(PIECE) + 1).cast("int"), (s["end"] - s["start"]).cast("int")), template)

    # as a lambda's argument the bits of a conversation are made once, not once for each span
    bits = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    loss = F.get(F.transform(F.array(bits), lambda b: F.transform("loss", lambda s: masked(s, b))), F.lit(0))
    pieces = F.regexp_extract_all("formatted", F.lit(template.pattern()), F.lit(0))
    return out.withColumns({"turns": F.transform(pieces, turn), "loss_texts": loss})


#: A conversation that says nothing but marks, added to the table by the query.
EXTRA = (-7, "</s>[INST] ok [/INST]")


def digest(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", F.to_variant_object(F.struct("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")).alias("record"))
    says = lambda role: F.struct(F.lit(role).alias("role"), F.lit(EXTRA[1]).alias("content"))
    extra = conversations.sparkSession.range(1).select(F.lit(EXTRA[0]).cast(conversations.schema["conv_id"].dataType).alias("conv_id"), F.array(says("user"), says("assistant")).alias("messages"))
    extra = extra.select("conv_id", F.to_variant_object(F.struct("conv_id", "messages")).alias("record"))
    out = read_back(formatted(rows.unionByName(extra), "conv_id", "record"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        F.col("key").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), sha(said).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), sha(loss).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_length() -> str:
    first, rest = TEMPLATE.held()
    grown = lambda c: rf"length(regexp_replace({c}, '({first})(\\*)({rest})', '\1\\\2\3', 'g'))"
    known = " ".join(f"WHEN role = '{name}' THEN {len(a) + len(b)}" for name, (a, b) in TEMPLATE.marks.items())
    return f"{grown('text')} + CASE {known} ELSE {sum(map(len, TEMPLATE.other))} + {grown('role')} END"


ORACLE = f"""
WITH c AS (SELECT conv_id, turn, 0 AS place, coalesce(role, '') AS role, coalesce(text, '') AS text,
    coalesce(conv_id::VARCHAR, 'row ' || row_number() OVER ()) AS k FROM conversations
  UNION ALL SELECT {EXTRA[0]}, NULL, place, role, '{EXTRA[1]}', '{EXTRA[0]}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(place, role))
SELECT any_value(conv_id) AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, place, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, place, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_sql_length()})::BIGINT AS formatted_chars
FROM c GROUP BY k
"""
