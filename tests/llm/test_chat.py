import json

from pyspark.sql import functions as F

from pricedex.llm import chat as C

SCHEMAS = [("f", [("q", "string", True), ("n", "integer", False), ("z", "object", False), ("x", "number", False),
                  ("l", "array", False), ("b", "boolean", False), ("w", "any", False)])]


def call(i, arguments, name="f", after=()):
    return {"id": i, "name": name, "arguments": arguments, "depends_on": list(after)}


def calls(*found):
    return json.dumps({"tool_calls": list(found)})


def run(spark, rows):
    messages = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, json string, level int")
    schemas = spark.createDataFrame(SCHEMAS, "name string, fields array<struct<field:string,type:string,required:boolean>>")
    return C.format_chat(spark, messages, schemas).collect()


def test_links_order_checks_and_json(spark):
    rows = [(1, 0, "system", 'say "é"\n\t/'), (1, 1, "assistant", calls(
        call("a", {"q": "x", "n": 1, "z": {"b": 1.50, "a": []}}), call("b", {"q": 2, "k": 1}, after=["a"]),
        call("c", "zz", "g", after=["b", "unknown"]))),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "r"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "a", "content": "again"})),
        (1, 4, "tool", json.dumps({"tool_call_id": "nope", "content": None})),
        (1, 5, "assistant", calls(call("a", {"q": "repeat"}))),
        (2, 0, "assistant", calls(call("a", {"q": "", "x": 1.5, "l": [1], "b": True, "w": None}, after=["b"]),
                                  call("b", [1], after=["a"]), call("d", {}, after=["a"]), call("e", {"n": 1.5, "q": None}))),
        (2, 1, "assistant", None), (2, 2, "tool", "{bad"), (None, 1, "user", ""), (3, None, "tool", "null"), (3, 0, "user", '{"tool_calls":1}')]
    got = {(r.conv_id, r.turn, r.at, r.kind): r for r in run(spark, rows)}
    assert len(got) == 3 + 3 + 1 + 1 + 4 + 2 + 3
    one = {r.at: r for k, r in got.items() if k[:2] == (1, 1)}
    assert [one[i].level for i in range(3)] == [0, 1, 2] and [one[i].status for i in range(3)] == ["answered", "unanswered", "unanswered"]
    assert [one[i].errors for i in range(3)] == [[], ["type of q", "unexpected k"], ["unknown tool"]]
    assert one[0].json == '{"arguments":{"n":1,"q":"x","z":{"a":[],"b":1.5}},"id":"a","kind":"call","name":"f","status":"answered"}'
    assert got[1, 2, 0, "result"].status == got[1, 3, 0, "result"].status == "linked"
    assert got[1, 4, 0, "result"].status == "orphan" and json.loads(got[1, 4, 0, "result"].json)["content"] is None
    assert got[1, 5, 0, "call"].status == "repeated"
    two = [got[2, 0, i, "call"] for i in range(4)]
    assert [r.level for r in two] == [None, None, None, 0]  # a cycle, one behind it, one apart
    assert [r.errors for r in two] == [[], ["not an object"], ["missing q"], ["type of n", "type of q"]]
    assert json.loads(got[1, 0, 0, "message"].json) == {"kind": "message", "role": "system", "text": 'say "é"\n\t/'}
    for r in got.values():  # canonical: sorted keys, no white space, and stable
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_levels_against_brute_force(spark):
    import random

    rng = random.Random(4)
    edges = {(c, i): [j for j in range(12) if rng.random() < 0.12 and j != i] for c in range(8) for i in range(12)}
    rows = [(c, 0, i, str(i), "f", "{}", [str(j) for j in need]) for (c, i), need in edges.items()]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, at int, call_id string, name string, arguments string, depends_on array<string>")
    level = {}
    for _ in range(13):
        for k, need in edges.items():
            if all((k[0], j) in level for j in need):
                level[k] = max((level[k[0], j] + 1 for j in need), default=0)
    assert {(r.conv_id, int(r.call_id)): r.level for r in C.levels(frame).collect()} == level


def test_levels_of_chains_and_cycles(spark):
    need = {str(i): [str(i - 1)] for i in range(1, 40)} | {"0": []}  # a chain
    need |= {f"c{i}": [f"c{(i + 1) % 5}"] for i in range(5)} | {"in1": ["c0"], "in2": ["in1"], "self": ["self"]}  # cycles
    need |= {"two": ["39", "7"], "after": ["two"], "three": ["after", "0"], "stuck": ["c1", "0"], "behind": ["stuck"]}
    rows = [(1, 0, 0, k, "f", "{}", v) for k, v in need.items()]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, at int, call_id string, name string, arguments string, depends_on array<string>")
    got = {r.call_id: r.level for r in C.levels(frame).collect()}
    assert got == {**{str(i): i for i in range(40)}, "two": 40, "after": 41, "three": 42}


def test_long_and_empty(spark):
    assert run(spark, []) == []
    chain = [(7, i, "assistant", calls(call(str(i), {"q": "y" * 100_000}, after=[str(i - 1)]))) for i in range(3)]
    assert sorted(r.level for r in run(spark, chain)) == [0, 1, 2]


def test_calls_without_identifier_stay(spark):
    rows = [(1, 0, "assistant", calls(call(None, {"q": "x"}, after=["a"]), call("a", {"q": "y"}), call(None, {}))),
            (2, 0, "assistant", calls(call(None, {"q": "z"}))), (None, None, "assistant", calls(call(None, {"q": "w"}))),
            (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": "r"}))]
    got = {(r.conv_id, r.turn, r.at, r.kind): r for r in run(spark, rows)}
    assert len(got) == 6
    for key, errors in (((1, 0, 0), []), ((1, 0, 2), ["missing q"]), ((2, 0, 0), []), ((None, None, 0), [])):
        r = got[*key, "call"]
        assert (r.call_id, r.level, r.status, r.errors) == (None, None, "no identifier", errors)
        assert json.loads(r.json)["id"] is None
    assert (got[1, 0, 1, "call"].level, got[1, 0, 1, "call"].status) == (0, "answered")


def test_turns_without_conversation_or_turn_stay(spark):
    from pricedex.llm.queries import conversations_as_tool_use

    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, 0, "user", "c"), (1, None, "user", "d"),
                                   (None, None, "assistant", "e")], "conv_id long, turn int, role string, text string")
    schemas = spark.createDataFrame(SCHEMAS, "name string, fields array<struct<field:string,type:string,required:boolean>>")
    got = C.format_chat(spark, conversations_as_tool_use(turns), schemas).collect()
    assert len(got) == 5
    assert sorted((r.conv_id or 0, r.turn) for r in got if r.status == "no identifier") == [(0, 0), (1, None)]


def test_main_path_is_native(spark):
    messages = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    schemas = spark.createDataFrame(SCHEMAS, "name string, fields array<struct<field:string,type:string,required:boolean>>")
    plan = C.format_chat(spark, messages, schemas)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_long_plain_messages_and_repeated_schemas(spark):
    rows = spark.createDataFrame([(1, 0, "user", 40_000_000), (1, 2, "user", 3)], "conv_id long, turn long, role string, n int")
    text = F.repeat(F.lit("ab\\"), (F.col("n") / 3).cast("int"))
    call = '{"tool_calls": [{"id": "a", "name": "t", "arguments": {"x": 1, "x": 2}}, {"id": "b", "name": "t", "arguments": {"x": 1}}]}'
    rows = rows.select("conv_id", "turn", "role", text.alias("text")).unionByName(
        spark.createDataFrame([(1, 1, "assistant", call)], "conv_id long, turn long, role string, text string"))
    schema = ("t", [("x", "integer", True)])
    schemas = spark.createDataFrame([schema, schema], "name string, fields array<struct<field:string,type:string,required:boolean>>")
    found = C.format_chat(spark, rows, schemas).select("turn", "call_id", "errors", F.length("json").alias("n"),
                                                       F.substring("json", 1, 60).alias("head")).collect()
    by = {(r.turn, r.call_id): r for r in found}
    assert len(found) == 4 and by[1, "b"].errors == [] and len(by[1, "a"].errors) == 1
    assert by[0, None].n > 50_000_000 and by[2, None].head == '{"kind":"message","role":"user","text":"ab\\\\"}'
