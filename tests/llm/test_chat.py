"""Layouts, escaping, loss runs, and the query against SQL."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from check_queries import compare
from ledgerhub.llm import chat
from ledgerhub.llm.queries import ORACLES, QUERIES

LONG = "word \\ <|end|>\n" * 20000


def turns_of(rows):
    return {r["id"]: r["canonical_turns"] and [(t["role"], t["text"]) for t in r["canonical_turns"]] for r in rows}


RECORDS = {
    1: ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        [("user", "a"), ("assistant", "")]),
    2: ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        [("user", "a"), ("assistant", "b")]),
    3: ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    4: ({"prompt": "p"}, [("user", "p"), ("assistant", "")]),
    5: ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    6: ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    7: ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
    8: ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    9: ({"turns": [{"turn": 2, "role": "user", "text": "b"}, {"turn": 1, "role": None, "text": "a"}]},
        [("", "a"), ("user", "b")]),
    10: ({"messages": []}, []),
    11: ({}, None),
    12: ({"prompt": "p", "question": "q"}, None),
    13: ({"response": "r"}, None),
}


def test_layouts(spark):
    rows = [(k, json.dumps(r), "mine") for k, (r, _) in RECORDS.items()] + [(14, None, "x"), (15, "not json", "x")]
    df = chat.from_json(spark.createDataFrame(rows, "id int, j string, layout string"), "j")
    got = chat.canonical(df).collect()
    assert turns_of(got) == {k: w for k, (_, w) in RECORDS.items()} | {14: None, 15: None}
    assert {r["layout"] for r in got if r["id"] in (3, 4)} == {"prompt and response"}
    assert {r["layout"] for r in got if r["id"] > 10} == {None}


def test_fingerprints_are_distinct():
    found = [f for layout in chat.LAYOUTS for f in layout.fingerprints()]
    assert len(found) == len(set(found))


TEXTS = ["", "plain", "\\", "\\\\", "<|end|>\n", "<|turn|>user<|text|>x", "</s>[INST] ok [/INST]", "<<SYS>>a<</SYS>>",
         "<|", "<", "\\<|", "<\\|", "[INST", "é🙂\n\n", "<|text|>", "a<", "\\n", "<start_of_turn>", LONG]


def test_escaping_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    escaped = chat.escaped(F.col("t"))
    for r in df.select("t", escaped.alias("e"), chat.unescaped(escaped).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in ("<|", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>"))


def test_round_trip_and_loss(spark):
    rows = [(1, i, ("assistant", "user", "<|text|>")[i % 3], t) for i, t in enumerate(TEXTS)]
    rows += [(2, None, None, None), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, 1, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = chat.read_back(chat.formatted(chat.canonical(chat.by_conversation(df))))
    got = {r["conv_id"]: r for r in out.collect()}
    assert [(t["role"], t["text"]) for t in got[1]["read_turns"]] == [(r, t) for _, _, r, t in rows[:len(TEXTS)]]
    assert [(t["role"], t["text"]) for t in got[2]["read_turns"]] == [("", ""), ("assistant", "x"), ("assistant", "x")]
    assert got[None]["read_turns"][0]["text"] == "n"
    for r in got.values():
        assert all(t["sound"] for t in r["read_turns"])
        assert sum(x["length"] for x in r["loss_runs"]) == len(r["formatted"])
        at, under = 0, []
        for x in r["loss_runs"]:
            if x["loss"]:
                under.append(r["formatted"][at:at + x["length"]])
            at += x["length"]
        said = [t["text"] for t in r["read_turns"] if t["role"] == "assistant"]
        assert len(under) == len(said)
    empty = df.limit(0)
    assert chat.formatted(chat.canonical(chat.by_conversation(empty))).count() == 0


def test_planted_conversation(spark, small):
    row = QUERIES["op4_chat"](spark, small).where("conv_id = -7").collect()[0]
    text = "</s>[INST] ok [/INST]"
    assert (row["n_turns"], row["loss_chars"]) == (2, len(text))
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_plan_is_native(spark, small):
    text = QUERIES["op4_chat"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize("name", ["op4_chat"])
def test_query(spark, con, small, name):
    good, note = compare(QUERIES[name](spark, small), con, ORACLES[name])
    assert good, note
