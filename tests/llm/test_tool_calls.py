import json
from collections import defaultdict

from chronotape.llm.tool_calls import link_tool_calls

SCHEMAS = [("find", "q", "string", True), ("find", "n", "integer", False), ("find", "near", "object", False), ("sum", "of", "array", True), ("sum", "scale", "number", False)]


def run(spark, messages, calls, results, schemas=SCHEMAS):
    return link_tool_calls(
        spark.createDataFrame([(*m, "mine") for m in messages], "conv_id long, turn long, role string, text string, json string"),
        spark.createDataFrame([(*c, "mine") for c in calls], "conv_id long, turn long, call_id string, name string, arguments string, faults string"),
        spark.createDataFrame([(*r, "mine") for r in results], "conv_id long, turn long, call_id string, content string, node string"),
        spark.createDataFrame(schemas, "name string, param string, type string, required boolean"),
    ).collect()


def test_links_orders_validates_and_serialises(spark):
    messages = [(1, 0, "user", "hé \"x\"\n"), (1, 5, "assistant", None), (None, 0, None, "lost"), (9, 0, "user", "only talk")]
    calls = [
        (1, 1, "a", "find", '{"q": "x", "n": 3}'), (1, 2, "b", "sum", '{ "scale": 1.5, "of": [1, {"z": 1, "a": 2}] }'),
        (1, 0, "late", "find", '{"q": {"$ref": "b"}}'),  # asked early, needs b's result, which comes at turn 4
        (1, 6, "bad", "find", '{"n": "3", "more": 1}'), (1, 6, "txt", "find", "not json"), (1, 6, "who", "nope", "{}"), (1, 7, "a", "find", '{"q": "again"}'),
        (1, 8, "c1", "find", '{"q": {"$ref": "c2"}}'), (1, 8, "c2", "find", '{"q": {"$ref": "c1"}}'), (1, 9, "u", "find", '{"q": {"$ref": "gone"}}'),
        (1, 9, None, "find", '{"q": "no id"}'), (2, 0, "a", "find", None),
    ]
    results = [(1, 3, "a", "ra"), (1, 4, "b", None), (1, 5, "a", "second"), (1, 5, "zzz", "stray"), (1, 6, None, "no id"), (1, 1, "late", "early answer"), (2, 0, "a", "other talk")]
    out = run(spark, messages, calls, results)
    assert len(out) == len(messages) + len(calls) + len(results)
    places = defaultdict(list)
    for r in out:
        places[r.conv_id].append(r.position)
        parsed = json.loads(r.json)
        assert list(parsed) == sorted(parsed) and json.dumps(parsed, separators=(",", ":"), ensure_ascii=False, sort_keys=True) == r.json
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    at = {(r.conv_id, r.kind, r.call_id, r.turn): r for r in out}
    assert at[1, "call", "a", 1].linked and at[1, "result", "a", 3].linked and not at[1, "result", "a", 5].linked
    assert at[1, "result", "a", 5].faults == "repeated_result" and at[1, "result", "zzz", 5].faults == "orphan"
    assert at[1, "call", "a", 7].faults == "duplicate_id" and at[1, "call", "bad", 6].faults == "type:n,missing:q,unexpected:more,unanswered"
    assert at[1, "call", "txt", 6].faults == "invalid_arguments,unanswered" and at[1, "call", "who", 6].faults == "unknown_tool,unanswered"
    assert "cyclic" in at[1, "call", "c1", 8].faults and "cyclic" in at[1, "call", "c2", 8].faults
    assert "unknown_reference" in at[1, "call", "u", 9].faults
    assert at[2, "call", "a", 0].faults == "invalid_arguments" and at[2, "result", "a", 0].linked
    order = {k: r.position for k, r in at.items() if k[0] == 1}
    assert order[1, "call", "b", 2] < order[1, "result", "b", 4] < order[1, "call", "late", 0] < order[1, "result", "late", 1]
    assert order[1, "call", "c1", 8] > order[1, "call", "u", 9]
    assert at[1, "call", "b", 2].json == '{"arguments":{"of":[1,{"a":2,"z":1}],"scale":1.5},"id":"b","name":"sum","type":"tool_call"}'
    assert json.loads(at[1, "message", None, 0].json)["content"] == "hé \"x\"\n"


def test_long_chains_of_references(spark):
    calls = [(1, k, f"c{k}", "find", json.dumps({"q": {"$ref": f"c{k - 1}"}}) if k else '{"q": "x"}') for k in range(7)]
    results = [(1, 0, f"c{k}", "r") for k in range(7)]
    out = sorted(run(spark, [], calls[::-1], results), key=lambda r: r.position)
    assert [(r.kind, r.call_id) for r in out] == [(kind, f"c{k}") for k in range(7) for kind in ("call", "result")]


def test_repeated_rows_and_empty_tables(spark):
    out = run(spark, [(1, 0, "user", "x")] * 3, [(1, 1, "a", "find", '{"q": "x"}')] * 2, [])
    assert len(out) == 5 and sorted(r.faults for r in out if r.kind == "call") == ["duplicate_id", "unanswered"]
    assert run(spark, [], [], []) == []


def test_the_query_keeps_rows_of_every_role(spark, tmp_path):
    from chronotape.llm.queries import op5_tool_call_linking

    rows = [(1, 0, "user", "a question"), (1, 1, "assistant", "an answer"), (1, 2, "system", "note"), (1, 3, None, "no role"), (2, 0, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert op5_tool_call_linking(spark, str(tmp_path)).count() == len(rows)
