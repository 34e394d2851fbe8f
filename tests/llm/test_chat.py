"""Layouts, template and loss mask."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from aerolap.llm import chat

NASTY = ["", "\\", "\\l", "\\b\\g", "<turn user>", "</turn>\n", "a > b < c", "\\### Assistant: </turn> ok",
         "\n", "é漢\U0001f600", "$1 \\1 .*", "</turn>", "<turn assistant>x</turn>\n"]


def turns_df(spark, conversations):
    return spark.createDataFrame(conversations, f"conv_id bigint, turns {chat.TURNS}")


def test_round_trip_and_loss(spark):
    rng = random.Random(1)
    rows = [(i, [(rng.choice(["user", "assistant", "system", "<\\>", ""]), rng.choice(NASTY) + rng.choice(NASTY))
                 for _ in range(rng.randint(0, 6))]) for i in range(200)]
    done = chat.format_turns(turns_df(spark, rows))
    out = done.select("conv_id", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("back"),
                      chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    for r in out:
        want = rows[r["conv_id"]][1]
        assert [(t["role"], t["text"]) for t in r["back"]] == want
        assert r["learned"] == "".join(t for role, t in want if role == "assistant")
        spans = [(s["start"], s["start"] + s["length"]) for s in r["loss"]]
        assert all(a <= b for a, b in spans) and spans == sorted(spans)
        for (a, b), text in zip(spans, [t for role, t in want if role == "assistant"]):
            assert r["formatted"][b:].startswith(chat.END) and "<" not in r["formatted"][a:b]
            assert len(r["formatted"][a:b]) >= len(text)


def test_json_records_of_mixed_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": 1},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"turns": [{"role": "user", "text": "q"}, {"role": "bot", "text": "a"}]},
        {"instruction": "q", "input": "", "output": "a", "id": 3},
        {"instruction": "q", "output": "a"}, {"prompt": "q", "response": "a"},
        {"prompt": "q", "completion": "a"}, {"question": "q", "answer": "a"}]
    odd = [None, "", "{broken", "[]", json.dumps({"else": 1}), json.dumps({"messages": []}),
           json.dumps({"prompt": None, "response": "a"})]
    rows = list(enumerate([*map(json.dumps, records), *odd]))
    got = {r["k"]: r for r in chat.from_json(spark.createDataFrame(rows, "k int, raw string"), "k", "raw").collect()}
    for i in range(len(records)):
        assert [tuple(t) for t in got[i]["turns"]] == [("user", "q"), ("assistant", "a")], records[i]
    assert len({got[i]["layout"] for i in range(len(records))}) == len(records)
    for i in range(len(records), len(rows) - 1):
        assert got[i]["turns"] == [] and got[i]["layout"] is None
    assert [tuple(t) for t in got[len(rows) - 1]["turns"]] == [("user", ""), ("assistant", "a")]


def test_json_records_whose_turns_lack_fields(spark):
    records = [
        ({"messages": [{"role": "system"}, {"role": "user", "content": "q"}]}, [("system", ""), ("user", "q")]),
        ({"messages": [{"content": "q"}, {"role": "bot"}]}, [("", "q"), ("assistant", "")]),
        ({"conversations": [{}, {"from": "gpt", "value": "a"}]}, [("", ""), ("assistant", "a")]),
        ({"turns": [None, {"role": "user", "text": "q"}]}, [("", ""), ("user", "q")]),
        ({"turns": [{"role": "user"}, {"role": "bot"}]}, []),
        ({"messages": "[{\"role\": \"user\", \"content\": \"q\"}]"}, []),
        ({"messages": 5, "turns": [{"text": "q"}, {"role": "bot", "text": "a"}]}, [("", "q"), ("assistant", "a")])]
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(records)]
    got = {r["k"]: r for r in chat.from_json(spark.createDataFrame(rows, "k int, raw string"), "k", "raw").collect()}
    for i, (record, want) in enumerate(records):
        assert [tuple(t) for t in got[i]["turns"]] == want, record
        assert (got[i]["layout"] is None) == (want == []), record


def test_table_layout_by_schema(spark):
    df = spark.createDataFrame([(1, "q", "more", None)], "id int, instruction string, input string, output string")
    r = chat.from_columns(df, "id").first()
    assert [tuple(t) for t in r["turns"]] == [("user", "q\n\nmore"), ("assistant", "")]
    assert chat.field_paths(df.schema) == ["id", "instruction", "input", "output"]
    with pytest.raises(ValueError):
        chat.from_columns(df.drop("instruction"), "id")


def test_turn_rows_with_nulls_ties_and_repeats(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (1, None, None, "z"),
            (None, 0, "user", "x"), (2, 0, "user", "t")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumn("turns", F.lit("clash")).withColumn("a.b", F.lit(1))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]]
           for r in chat.from_columns(chat.gather_turns(df), "conv_id").collect()}
    assert got == {1: [("", "z"), ("user", ""), ("assistant", "b"), ("assistant", "b")],
                   None: [("user", "x")], 2: [("user", "t")]}
    assert chat.gather_turns(df.limit(0)).collect() == []
    assert chat.format_turns(turns_df(spark, [(1, None)])).first()["formatted"] in (None, "")


def test_a_long_conversation(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"<{i}>" * 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    done = chat.format_turns(chat.from_columns(chat.gather_turns(df), "conv_id"))
    r = done.select(chat.read_loss(F.col("formatted"), F.col("loss")).alias("x")).first()
    assert r["x"] == "".join(t for *_, role, t in rows if role == "assistant")


def test_columns_of_callers_stay(spark):
    """Columns named like the operator's own, with dots, and keys of such names."""
    df = turns_df(spark, [(1, [("user", "q"), ("assistant", "a")])])
    plain = chat.format_turns(df).first()
    more = {"_parts": 7, "_sizes": 8, "__parts": 9, "a.b": 10}
    clash = df
    for name, value in more.items():
        clash = clash.withColumn(name, F.lit(value))
    got = chat.format_turns(clash).first()
    assert {n: got[n] for n in more} == more
    assert (got["formatted"], got["loss"]) == (plain["formatted"], plain["loss"])
    raw = json.dumps({"messages": [{"role": "user", "content": "q"}]})
    for key in ("_paths", "__paths", "meta.id"):
        r = chat.from_json(spark.createDataFrame([(3, raw)], f"`{key}` int, `raw.text` string"), key, "raw.text").first()
        assert r[key] == 3 and [tuple(t) for t in r["turns"]] == [("user", "q")]
    table = spark.createDataFrame([(4, "i", "x", "o")], "`meta.id` int, instruction string, input string, output string")
    assert chat.from_columns(table, "meta.id").first()["meta.id"] == 4
