"""Chat formats: every layout, exact round trips, loss on assistant texts alone."""

import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stockrecon.llm import chat_format as C

HARD = ["", "plain", "\\", "a\\", "<|end|>", "<|turn|>user\nx<|end|>", "<\\|", "</s>[INST] ok [/INST]", "<<SYS>>x<</SYS>>", "<<|", "<<s>", "\n\n", "\\n", "é<\n|"]


def formatted(spark, records):
    rows = spark.createDataFrame([(i, json.dumps(r) if not isinstance(r, (str, type(None))) else r) for i, r in enumerate(records)], "conv_id long, record string")
    return C.canonical(rows)


def pairs(turns):
    return [(t.role, t.text) for t in turns]


CASES = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user"}, {"role": "tool", "content": "r"}]}, "messages", [("user", ""), ("tool", "r")]),
    ({"messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", [("user", "q"), ("assistant", "a")]),
    ({"dialog": [{"speaker": "bot", "text": "hi"}]}, "dialog", [("assistant", "hi")]),
    ({"instruction": "do", "input": "this", "output": "done", "topic": {"a": [1]}}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done", "system": "be"}, "instruction", [("system", "be"), ("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "response": "r"}, "prompt_response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "response": None}, "prompt_response", [("user", "p"), ("assistant", "")]),
    ({"completion": "c", "prompt": "p"}, "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "a"}, "question_answer", [("user", "q"), ("assistant", "a")]),
    ({"unknown": 1}, None, []),
    ({}, None, []),
    (None, None, []),
    ("not json", None, []),
    ("[1]", None, []),
]


def test_layouts(spark):
    got = formatted(spark, [c[0] for c in CASES]).orderBy("conv_id").collect()
    for row, (record, layout, turns) in zip(got, CASES):
        assert (row.layout, pairs(row.turns)) == (layout, turns), record
    marks = {}
    for row in got:
        if row.layout:
            marks.setdefault(row.fingerprint, set()).add(row.layout)
    assert all(len(layouts) == 1 for layouts in marks.values())


def round_trip(spark, conversations):
    records = [{"messages": [{"role": r, "content": t} for r, t in turns]} for turns in conversations]
    text = C.format_turns(formatted(spark, records).select("conv_id", "turns"))
    written = {r.conv_id: r for r in text.collect()}
    back = {r.conv_id: r for r in C.read_back(text).collect()}
    told = {r.conv_id: r for r in C.digests(text).collect()}
    for i, turns in enumerate(conversations):
        assert pairs(back[i].turns) == turns
        assert written[i].formatted.count(C.TURN) == written[i].formatted.count(C.END) == len(turns)
        for control in C.CONTROLS[1:]:
            assert control not in written[i].formatted
        assert written[i].loss == [r == "assistant" for r, _ in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert told[i].n_turns == len(turns) and told[i].formatted_chars == len(written[i].formatted)
        assert told[i].turns_sha256 == digest("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (told[i].loss_chars, told[i].loss_sha256) == (len(loss), digest(loss))


def test_hard_texts(spark):
    round_trip(spark, [[("user", a), ("assistant", b)] for a in HARD for b in HARD[:6]] + [[(a, "x")] for a in HARD] + [[]])


text = st.text(alphabet=st.sampled_from("ab\\<|>/s[]INSTYu\né"), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(text, text), max_size=4), min_size=20, max_size=60))
def test_random_texts(spark, conversations):
    round_trip(spark, [[(r, t) for r, t in c] for c in conversations])


def test_rows_become_records(spark):
    rows = spark.createDataFrame(
        [(1, 1, "assistant", "b", 0), (1, 0, "user", None, 0), (1, 1, "assistant", "b", 0), (2, None, None, "x", 1), (None, 0, "user", "n", 2)],
        "conv_id long, turn long, role string, text string, record int",
    )
    got = {r.conv_id: pairs(r.turns) for r in C.canonical(C.records_of_rows(rows)).collect()}
    assert got == {1: [("user", ""), ("assistant", "b"), ("assistant", "b")], 2: [("", "x")], None: [("user", "n")]}


@pytest.mark.parametrize("n", [0, 400])
def test_empty_and_long(spark, n):
    round_trip(spark, [[("user", "<|x\\" * 20_000)] * bool(n) + [("assistant", str(i)) for i in range(n)]])


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.digests(C.format_turns(C.canonical(C.records_of_rows(empty)).select("conv_id", "turns"))).count() == 0


def test_a_very_long_turn_is_kept_whole(spark):
    text = "x" * 24_999_990 + " </s> end "
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (2, 0, "user", "")], "conv_id long, turn long, role string, text string")
    found = C.digests(C.format_turns(C.canonical(C.records_of_rows(rows)).select("conv_id", "turns"))).collect()
    whole, empty = sorted(found, key=lambda r: r.conv_id)
    assert (whole.n_turns, whole.loss_chars) == (2, 25_000_000)
    assert whole.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (empty.n_turns, empty.loss_chars) == (1, 0)


def test_an_unreadable_record_differs_from_an_empty_one(spark):
    records = spark.createDataFrame([("{}",), ("{broken",), (None,), ('{"messages": []}',)], "record string")
    unread = [(r.fingerprint is None, r.layout, len(r.turns)) for r in C.canonical(records).collect()]
    assert unread == [(False, None, 0), (True, None, 0), (True, None, 0), (False, "messages", 0)]
