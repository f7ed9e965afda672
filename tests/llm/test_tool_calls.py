import json

from ledgerlake.llm import tool_calls as C

TALK = [
    (1, 0, "user", 'hi "x"\n'), (1, 1, "assistant", "yo"), (1, 2, "user", "more"),
    (1, 3, "assistant", "ok"), (1, 4, "system", None), (4, 0, "assistant", "nobody asked"),
    (4, 3, "assistant", "nobody asked"), (4, 6, "user", "open"),
]


def said(conv, turn, calls):
    return conv, turn, "assistant", json.dumps({"tool_calls": calls})


TOOLS = [
    said(2, 0, [
        {"id": "a", "name": "search",
         "arguments": {"query": "q", "limit": 3, "Zed": {"b": 1, "a": [1, {"d": 1, "c": 2}]}}},
        {"id": "b", "name": "run", "arguments": {"code": 5}, "after": "a"},
    ]),
    (2, 1, "tool", json.dumps({"tool_call_id": "b", "content": "out"})),
    (2, 2, "tool", json.dumps({"tool_call_id": "zz"})),
    said(2, 3, [
        {"id": "c", "name": "nope", "arguments": '{"x":1}', "after": "d"},
        {"id": "d", "name": "search", "arguments": "no json", "after": "c"},
        {"id": "e", "name": "search", "arguments": '{"query": null}', "after": "d"},
        {"id": "e", "name": "search", "arguments": "{}"},
    ]),
]


def linked(spark, rows):
    frame = spark.createDataFrame(
        [(*r, "x", "x") for r in rows],
        "conv_id long, turn long, role string, text string, kind string, level string",
    )
    return C.link(frame.repartition(3)).collect()


def test_plain_talk(spark):
    got = {(r.conv_id, r.turn): r for r in linked(spark, TALK)}
    order = [(r.kind, r.call_id, r.step, r.linked, r.problems) for _, r in sorted(got.items())]
    assert order == [
        ("call", "0", 0, True, ""), ("result", "0", 1, True, ""), ("call", "2", 2, True, ""),
        ("result", "2", 3, True, ""), ("text", None, -1, False, ""),
        ("text", None, -1, False, ""), ("result", "2", -1, False, "no such call"),
        ("call", "6", 0, False, ""),
    ]
    assert got[1, 0].json == (
        '{"arguments":{"role":"user","text":"hi \\"x\\"\\n"},"call_id":"0","name":"reply",'
        '"role":"user","type":"call"}'
    )
    assert got[1, 4].json == '{"content":"","role":"system","type":"text"}'


def test_tool_calls(spark):
    rows = linked(spark, TOOLS)
    got = {(r.call_id, r.kind): r for r in rows if r.call_id != "e"}
    assert {k: (r.step, r.linked, r.problems) for k, r in got.items()} == {
        ("a", "call"): (0, False, "Zed is not expected"),
        ("b", "call"): (2, True, "code is not a string"),
        ("b", "result"): (3, True, ""),
        ("zz", "result"): (-1, False, "no such call"),
        ("c", "call"): (-1, False, "unknown tool nope; cycle of calls"),
        ("d", "call"): (-1, False, "arguments are not an object; cycle of calls"),
    }
    assert json.loads(got["a", "call"].json)["arguments"]["Zed"] == {"a": [1, {"c": 2, "d": 1}], "b": 1}
    assert '{"Zed":{"a":[1,{"c":2,"d":1}],"b":1},"limit":3,"query":"q"}' in got["a", "call"].json
    twice = [r for r in rows if r.call_id == "e"]
    assert len(twice) == 2 and all("repeated call id" in r.problems for r in twice)


def test_a_long_chain(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", "t") for t in range(150)]
    got = {r.turn: r.step for r in linked(spark, rows)}
    assert got == {t: t for t in range(150)}


def test_edge_cases(spark):
    rows = [(None, 0, "user", "x"), (3, None, "user", "x"), (3, 0, None, ""),
            (5, 0, "user", "x"), (5, 0, "user", "x"), (5, 1, "assistant", "{not json"),
            (5, 2, "user", "long " * 50_000), (6, 0, "user", None)]
    got = linked(spark, rows)
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert not by[None, 0].linked and not by[3, None].linked and by[3, 0].kind == "text"
    assert [r.problems for r in got if (r.conv_id, r.turn) == (5, 0)] == ["repeated call id"] * 2
    assert by[5, 1].linked and json.loads(by[5, 1].json)["content"] == "{not json"
    assert linked(spark, []) == []


def test_main_path_runs_no_python(spark):
    frame = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string")
    plan = C.link(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_what_is_said_beside_calls_stays(spark):
    calls = [{"id": "a", "name": "run", "arguments": {"code": "1"}}]
    speak = json.dumps({"content": "let me see", "tool_calls": calls})
    silent = json.dumps({"content": "", "tool_calls": [{**calls[0], "id": "b"}]})
    rows = linked(spark, [(1, 0, "assistant", speak), (1, 1, "assistant", silent)])
    assert sorted((r.turn, r.kind, r.call_id or "") for r in rows) == [
        (0, "call", "a"), (0, "text", ""), (1, "call", "b"),
    ]
    (text,) = [r for r in rows if r.kind == "text"]
    assert json.loads(text.json) == {"content": "let me see", "role": "assistant", "type": "text"}
    assert (text.step, text.linked, text.problems) == (-1, False, "")
