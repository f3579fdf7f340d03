from __future__ import annotations

import hashlib
import json

from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import chat

TEXT = st.one_of(st.text(), st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "\n", "a", "|"])).map("".join))


@given(TEXT)
def test_escape_is_reversible_and_leaves_no_mark(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(mark in escaped for mark in chat.CONTROL)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_turns_come_back(turns):
    assert chat.read_turns("".join(chat.write_turn(*t)[0] for t in turns)) == turns


LAYOUTS = [
    {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    {"instruction": "q", "output": "a"},
    {"instruction": "q", "input": "", "output": "a"},
    {"prompt": "q", "completion": "a"},
    {"prompt": "q", "response": "a"},
    {"question": "q", "answer": "a"},
]


def test_layouts_become_the_same_turns(llm):
    rows = [(i, json.dumps(r)) for i, r in enumerate(LAYOUTS)]
    rows += [(50, "not json"), (51, None), (52, '{"foo": [{"bar": 1}]}'), (53, "[]")]
    found = chat.canonical_turns(llm.createDataFrame(rows, "conv_id long, record string")).collect()
    by_conv = {}
    for r in sorted(found, key=lambda r: (r["conv_id"], r["turn"] or 0)):
        by_conv.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert all(by_conv[i] == [("user", "q"), ("assistant", "a")] for i in range(len(LAYOUTS)))
    assert all(r["layout"] is None for r in found if r["conv_id"] >= 50) and len(by_conv) == len(rows)


def test_fingerprints_tell_nested_layouts_apart():
    paths = chat.field_paths({"a": [{"b": 1}, {"c": {"d": None}}]})
    assert paths == {"a", "a[].b", "a[].c", "a[].c.d"}
    assert len(chat.fingerprints(chat.LAYOUTS)) == 1 + 1 + 2 + 4 + 1 + 1 + 1


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        chars = sum(len(chat.write_turn(r, t)[0]) for r, t in turns)
        yield conv, len(turns), digest[0], len(loss), digest[1], chars


def test_query_equals_brute_force(llm, folder):
    rows = [
        (1, 0, "user", "hi <|im_end|>"),
        (1, 1, "assistant", "a\\<s>b"),
        (1, 1, "assistant", "a\\<s>b"),
        (1, 1, "assistant", "0"),
        (2, None, None, None),
        (2, 3, "odd\nrole%0A", ""),
        (None, 0, "assistant", "x" * 200_000),
        (4, 0, "assistant", "é漢"),
    ]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS record")
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    found = chat.op7_chat_formatting(llm, folder(conversations=df)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute(rows)))
    assert chat.op7_chat_formatting(llm, folder(conversations=df.limit(0))).count() == 1


def test_null_ids_only(llm, folder):
    df = llm.createDataFrame([(None, 0, "user", "hello")], "conv_id long, turn long, role string, text string")
    found = chat.op7_chat_formatting(llm, folder(conversations=df)).collect()
    assert sorted((r["conv_id"] is None, r["n_turns"]) for r in found) == [(False, 2), (True, 1)]
    back = chat.read_back(chat.format_turns(df)).collect()
    assert [(r["conv_id"], r["n_turns"]) for r in back] == [(None, 1)]


def test_bad_records_are_one_row_with_a_reason(llm):
    messages = lambda item: json.dumps({"messages": [{"role": "user", "content": "q"}, item]})
    row = lambda turn, text="t": json.dumps({"turn": turn, "role": "user", "text": text})
    bad = {
        1: (messages("text"), "item 1 of messages has no fields"),
        2: (messages(None), "item 1 of messages has no fields"),
        3: (row("first"), "turn is no 64-bit number"),
        4: (row(1 << 63), "turn is no 64-bit number"),
        5: (row(0, "\ud800"), "lone surrogate"),
        6: ("[" * 100_000, "nested too deeply"),
        7: ('{"a":' * 5000 + "1" + "}" * 5000, "nested too deeply"),
        8: ("{", "no JSON"),
        9: ("[]", "no record"),
        10: (None, "no record"),
        11: ('{"foo": 1}', "unknown layout"),
        12: (row(1.5), "turn is no 64-bit number"),
        13: ('{"\\ud800": 1}', "lone surrogate"),
    }
    rows = [(i, text) for i, (text, _) in bad.items()] + [(20, row(-(1 << 63))), (21, row(None))]
    found = chat.canonical_turns(llm.createDataFrame(rows, "conv_id long, record string")).collect()
    assert {r["conv_id"]: r["reason"] for r in found} == {i: why for i, (_, why) in bad.items()} | {20: None, 21: None}
    assert len(found) == len(rows)
    assert {r["conv_id"]: r["text"] for r in found if r["reason"]} == {i: text for i, (text, _) in bad.items()}
