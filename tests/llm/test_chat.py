"""Chat formatting against a plain version, on every layout, and on marks inside texts."""

import hashlib
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from probity.llm import chat_format as chat

ROWS = "conv_id long, turn long, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_digest(rows):
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256), as a list: null ids are rows of their own."""
    rows = [(i if c is None else c, c, t, 0, r or "", x or "") for i, (c, t, r, x) in enumerate(rows)]
    rows = [(("own", k) if c is None else k, c, t, p, r, x) for k, c, t, p, r, x in rows]
    rows += [(-7, -7, None, i, r, chat.EXTRA[1]) for i, r in enumerate(("user", "assistant"))]
    out = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[2] is None, r[2] or 0, r[3], r[4].encode(), r[5].encode()))
        loss = "".join(r[5] for r in mine if r[4] == "assistant")
        out.append((mine[0][1], len(mine), sha("".join(f"{r[4]}\n{r[5]}\n" for r in mine)), len(loss), sha(loss)))
    return sorted(out, key=str)


def digest(spark, rows):
    got = chat.digest(spark.createDataFrame(rows, ROWS)).drop("formatted_chars").collect()
    return sorted((tuple(r) for r in got), key=str)


MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]", "[", "<", "\\", "\\\\", "s>", "INST]", "$1", "\n", " ", "é", "😀", "a"]


def test_marks_inside_texts_come_back(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(60):
        for t in range(rnd.randint(1, 6)):
            text = "".join(rnd.choice(MARKS) for _ in range(rnd.randint(0, 40)))
            role = rnd.choice(["user", "assistant", "system", "tool", "[TEXT]", "a[/ROLE]", "\\[TEXT]"])
            rows.append((c, t, role, text))
    assert digest(spark, rows) == plain_digest(rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, None, "assistant", "last"), (1, 0, "user", None), (None, 0, "assistant", "x"),
            (None, 0, "assistant", "x"), (2, 0, None, "no role"), (3, 0, "assistant", "a😀" * 40_000), (3, 0, "assistant", "b"), (-7, 0, "user", "own")]
    assert digest(spark, rows) == plain_digest(rows)
    assert [r["conv_id"] for r in chat.digest(spark.createDataFrame([], ROWS)).collect()] == [-7]


def test_other_columns_are_not_looked_at(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("z") for c in ("key", "record", "_record", "at", "slot", "formatted", "loss", "_own", "layout")})
    got = sorted((tuple(r) for r in chat.digest(df).drop("formatted_chars").collect()), key=str)
    assert got == plain_digest(rows)


def test_template_and_mask(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi [INST]"), (1, 1, "assistant", "a</s>b"), (1, 2, "tool", "t")], ROWS)
    rows = df.select("conv_id", F.to_variant_object(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    out = chat.formatted(rows, "conv_id", "record").first()
    assert out["formatted"] == "[INST]hi [\\INST][/INST]<s>a<\\/s>b</s>[ROLE]tool[TEXT]t[/ROLE]"
    assert [out["formatted"][s["start"] : s["end"]] for s in out["loss"]] == ["a<\\/s>b"]
    assert out["n_unmapped"] == 0


def test_long_conversation_is_linear(spark):
    df = spark.range(60_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("some text "), "id").alias("text"))
    began = time.time()
    got = {r["conv_id"]: r for r in chat.digest(df).collect()}[1]
    assert time.time() - began < 60
    said = "".join(f"some text {i}" for i in range(1, 60_000, 2))
    assert (got["n_turns"], got["loss_chars"], got["loss_sha256"]) == (60_000, len(said), sha(said))


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 4}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"messages": [], "meta": {"x": [1]}}, "messages", []),
    ({"prompt": "ignored here", "messages": [{"content": None, "role": None}]}, "messages", [("", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "s"}, "shares", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done", "extra": {"messages": [1]}}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "r", "system": "s"}, "response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    ({"conv_id": 9, "turn": 3, "role": "user", "text": "t"}, "turn", [("user", "t")]),
    ({"prompt": "p", "completion": "c", "response": "r"}, None, []),
    ({"something": "else"}, None, []),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(len(RECORDS), None), (len(RECORDS) + 1, "not json")]
    df = spark.createDataFrame(rows, "id long, line string").select("id", F.try_parse_json("line").alias("record"))
    out = {r["key"]: r for r in chat.read_back(chat.formatted(df, "id", "record")).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert [tuple(t) for t in out[i]["turns"]] == turns, RECORDS[i]
        assert out[i]["n_unmapped"] == (layout is None)
        assert list(out[i]["loss_texts"]) == [t for r, t in turns if r == "assistant"]
    assert out[len(RECORDS)]["n_unmapped"] == out[len(RECORDS) + 1]["n_unmapped"] == 1
    kinds = {r["layout"]: 0 for r in chat.layouts_found(df, "record").collect()}
    assert kinds.keys() == {"messages", "shares", "instruction", "prompt", "response", "question", "turn", None}


def test_native(spark):
    plan = chat.digest(spark.createDataFrame([(1, 0, "user", "q")], ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("marks", [{"user": ("[A]", "[A]")}, {"user": ("<a", "<ab")}, {"user": ("<a[", "]")}])
def test_templates_that_cannot_be_read_back_are_refused(marks):
    with pytest.raises(ValueError):
        chat.Template(marks, ("[ROLE]", "[TEXT]", "[/ROLE]"))
