import json

import duckdb
from pyspark.sql import functions as F

from recspark.llm.chat import conversation_calls, conversation_schemas, formatted, levels
from recspark.llm.queries import CHAT_SQL, QUERIES

CALLS = "conv_id long, call_id string, name string, arguments string, after array<string>, turn long, line string, level string"
RESULTS = "conv_id long, call_id string, content string, turn long, kind string, errors int"


def schemas(spark):
    rows = [("search", "query", "string", True), ("search", "limit", "integer", False), ("search", "opts", "object", False), ("sum", "values", "array", True), ("sum", "scale", "number", False), ("sum", "strict", "boolean", False)]
    return spark.createDataFrame(rows, "tool string, param string, type string, required boolean")


def run(spark, calls, results):
    c = spark.createDataFrame([(*x, "l", "v") for x in calls], CALLS)
    r = spark.createDataFrame([(*x, "k", 1) for x in results], RESULTS)
    return formatted(c, r, schemas(spark)).orderBy("conv_id", "position").collect()


def test_links_orders_validates_and_serialises(spark):
    calls = [
        (1, "b", "sum", '{"scale": 1.5, "values": [3, 1.0]}', ["a"], 0),
        (1, "a", "search", '{ "query":"é \\"q\\"", "opts": {"z":1, "b":{"y":null,"x":true}}, "limit":3}', [], 9),
        (1, "c", "sum", '{"values": [], "strict": "yes", "extra": 1}', ["a", "b", "nowhere", "c"], 1),
        (1, "d", "search", '{"limit": 2.5}', None, 2),
        (1, "e", "fly", "{}", [], 3),
        (1, "f", "search", "not json", [], 4),
        (1, "g", "search", None, [], 5),
        (1, "h", "search", "[1]", [], 6),
        (1, "x", "sum", '{"values":[1]}', ["y"], 7),
        (1, "y", "sum", '{"values":[1]}', ["x"], 8),
        (1, "z", "sum", '{"values":[1]}', ["y"], 8),
        (2, "a", "sum", '{"values":[2]}', [], 0),
        (2, "a", "sum", '{"values":[1]}', [], 0),
        (None, "n", "sum", '{"values":[1]}', [], 0), (2, None, "sum", '{"values":[1]}', [], 0),
    ]
    results = [(1, "a", "late", 11), (1, "a", 'first "one"\n', 10), (1, "b", None, 12), (1, "missing", "lost", 13), (2, "a", "same", 1), (2, "a", "same", 1), (2, None, "no id", 2)]
    got = run(spark, calls, results)
    one = [g for g in got if g.conv_id == 1]
    assert [(g.kind, g.call_id) for g in one] == [("call", "d"), ("call", "e"), ("call", "f"), ("call", "g"), ("call", "h"), ("call", "a"), ("result", "a"), ("result", "a"), ("call", "b"), ("result", "b"), ("call", "c"),
                                                   ("call", "x"), ("call", "y"), ("call", "z"), ("orphan", "missing")]
    by = {(g.kind, g.call_id): g for g in one}
    assert by["call", "a"].line == '{"arguments":{"limit":3,"opts":{"b":{"x":true,"y":null},"z":1},"query":"é \\"q\\""},"id":"a","name":"search"}'
    assert by["call", "a"].errors == [] and by["call", "b"].errors == [] and [by["call", k].level for k in "abcx"] == [0, 1, 2, None]
    assert by["call", "c"].errors == ["unknown parameter extra", "wrong type of strict", "no result"]
    assert by["call", "d"].errors == ["missing query", "wrong type of limit", "no result"]
    assert by["call", "e"].errors == ["unknown tool", "no result"]
    assert by["call", "f"].errors == by["call", "g"].errors == by["call", "h"].errors == ["arguments are not a JSON object", "no result"]
    assert by["call", "x"].errors == ["no result", "cyclic"] and by["call", "z"].errors == ["no result", "cyclic"]
    assert [json.loads(g.line).get("content") for g in one if g.kind == "result"] == ['first "one"\n', "late", None]
    for g in got:
        json.loads(g.line)
    assert json.loads(by["call", "f"].line)["arguments"] == "not json" and json.loads(by["call", "g"].line)["arguments"] is None
    two = [g for g in got if g.conv_id == 2]
    assert [(g.kind, g.call_id) for g in two] == [("call", "a"), ("result", "a"), ("result", "a"), ("orphan", None)]
    assert two[0].errors == ["repeated identifier"] and json.loads(two[0].line)["arguments"] == {"values": [1]}
    assert not [g for g in got if g.conv_id is None]


def test_levels_of_a_deep_graph(spark):
    n = 12
    rows = [(7, str(i), [str(j) for j in (i - 1, i - 3, 0) if 0 <= j < i]) for i in range(n)]
    got = {r.call_id: r.level for r in levels(spark.createDataFrame(rows, "conv_id long, call_id string, after array<string>")).collect()}
    assert got == {str(i): i for i in range(n)}


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert [g.kind for g in run(spark, [], [(1, "a", "x", 0)])] == ["orphan"]


def test_conversations_equal_sql(spark):
    rows = [(1, 0, "user", "hi \"you\"\n\ttab"), (1, 1, "assistant", "ho"), (1, 2, "assistant", None), (1, 3, "system", "be é"), (1, 4, "user", None), (2, 0, "assistant", "alone"), (2, 1, "user", ""), (2, 2, None, "who"),
            (3, 0, "system", "s"), (3, 1, "system", "t"), (3, 2, "user", "u" * 100_000), (4, 0, "user", "unanswered")]
    extra = [(None, 0, "user", "x"), (5, None, "user", "x")]
    df = spark.createDataFrame(rows + extra, "conv_id long, turn long, role string, text string")
    calls, results = conversation_calls(df)
    out = formatted(calls, results, conversation_schemas(spark)).withColumn("errors", F.array_join("errors", ";"))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows + extra)
    assert sorted(map(tuple, out.collect())) == sorted(con.execute(CHAT_SQL).fetchall())


def test_native_plan(spark):
    plan = QUERIES["op8_tool_call_linking"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
