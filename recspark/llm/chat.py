"""Chat formatting: tool calls linked with their results, ordered, validated and written as canonical JSON.

Built-in DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.stages import cut, small_side

#: JSON schema type to the variant types that satisfy it.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY", "null": "^VOID$"}


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of calls with ``after array<string>``; 0 where nothing goes before.

    Kahn's rounds as joins: a round settles the calls whose predecessors are all settled;
    there are as many rounds as the longest chain has calls. Predecessors that don't exist in
    the conversation, and a call itself, don't count. Calls on or behind a cycle get no row.
    """
    key = ["conv_id", "call_id"]
    nodes = cut(calls.select(*key).distinct())
    edges = calls.select(*key, F.explode("after").alias("before")).where("before <> call_id").distinct()
    edges = cut(edges.join(nodes.select("conv_id", F.col("call_id").alias("before")), ["conv_id", "before"]))
    done = cut(nodes.join(edges, key, "left_anti").withColumn("level", F.lit(0)))
    level, parts, left = 0, [done], edges
    while True:
        # an edge goes once its start is settled; a call whose last edge went is settled next
        settled = parts[-1].select("conv_id", F.col("call_id").alias("before"))
        gone = left.join(settled, ["conv_id", "before"], "left_semi").select(*key).distinct()
        left = cut(left.join(settled, ["conv_id", "before"], "left_anti"))
        level += 1
        now = cut(gone.join(left.select(*key).distinct(), key, "left_anti").withColumn("level", F.lit(level)))
        if not now.take(1):
            break
        parts.append(now)
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``arguments`` as canonical JSON and ``errors array<string>``, sorted.

    ``schemas`` has a row ``tool, param, type, required`` per parameter (types as in
    ``TYPES``); a tool without rows is unknown. Canonical JSON has sorted keys, no white
    space and no repeated keys. Arguments that aren't a JSON object stay as they are.
    """
    tools = schemas.groupBy(F.col("tool").alias("s_tool")).agg(F.collect_list(F.struct("param", "type", "required")).alias("params"))
    tools = cut(tools)
    pattern = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    v = F.expr("try_parse_json(arguments)")
    kind = "coalesce(schema_of_variant(v) LIKE 'OBJECT%', false)"
    args = F.expr(f"CASE WHEN {kind} THEN transform(map_entries(CAST(v AS MAP<STRING, VARIANT>)), e -> struct(e.key AS param, schema_of_variant(e.value) AS type)) END")
    out = calls.withColumn("v", v).withColumn("args", args).withColumn("canonical", F.expr(f"CASE WHEN {kind} THEN to_json(v) ELSE arguments END")).drop("v", "arguments")
    out = out.join(small_side(tools, tools.count(), 4096), F.col("name") == F.col("s_tool"), "left")
    declared = lambda a: F.filter("params", lambda p: p["param"] == a["param"])
    fits = lambda a: F.exists(declared(a), lambda p: F.rlike(a["type"], F.element_at(pattern, p["type"])))
    text = lambda word, f: lambda a: F.concat(F.lit(word + " "), a[f])
    unknown = F.transform(F.filter("args", lambda a: F.size(declared(a)) == 0), text("unknown parameter", "param"))
    wrong = F.transform(F.filter("args", lambda a: (F.size(declared(a)) > 0) & ~F.coalesce(fits(a), F.lit(False))), text("wrong type of", "param"))
    absent = F.transform(F.filter("params", lambda p: p["required"] & ~F.exists("args", lambda a: a["param"] == p["param"])), text("missing", "param"))
    errors = (F.when(F.col("args").isNull(), F.array(F.lit("arguments are not a JSON object")))
              .when(F.col("s_tool").isNull(), F.array(F.lit("unknown tool")))
              .otherwise(F.array_sort(F.concat(unknown, wrong, absent))))
    return out.withColumn("errors", errors).withColumn("arguments", F.col("canonical")).drop("args", "canonical", "s_tool", "params")


def canonical(**fields: Column) -> Column:
    """A JSON object of the fields: keys sorted, no white space, null fields left out."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))


def formatted(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result: ``conv_id, position, kind, call_id, level, errors, line``.

    ``calls``: conv_id, call_id, name, arguments (JSON text), after (ids that go before),
    turn. ``results``: conv_id, call_id, content, turn. Results are joined to their calls
    by identifier; positions (from 1) order a conversation topologically: by level, then
    by the call's turn and identifier, a call right before its results by their turn.
    A result without a call is an ``orphan`` and comes last, as do calls on a cycle (error
    ``cyclic``, level null). A call without a result has the error ``no result``. ``line``
    is the canonical JSON of the row. Repeated call rows of one identifier are one call
    (the least by turn, name, arguments, with an error ``repeated identifier``); repeated
    results are all kept. Null identifiers link with nothing. Empty tables are fine.
    """
    key = ["conv_id", "call_id"]
    rank = Window.partitionBy(*key).orderBy("turn", "name", "arguments")
    known = calls.select(*key, "name", "arguments", F.coalesce("after", F.array().cast("array<string>")).alias("after"), "turn")
    known = known.withColumn("n", F.row_number().over(rank)).withColumn("all", F.count("*").over(Window.partitionBy(*key)))
    known = cut(validated(known.where("n = 1 and conv_id is not null and call_id is not null"), schemas))
    answered = results.where("conv_id is not null and call_id is not null").select(*key).distinct().withColumn("answered", F.lit(True))
    known = known.join(levels(known), key, "left").join(answered, key, "left")
    more = F.filter(F.array(F.when(F.col("all") > 1, F.lit("repeated identifier")), F.when(F.col("answered").isNull(), F.lit("no result")), F.when(F.col("level").isNull(), F.lit("cyclic"))),
                    lambda e: e.isNotNull())
    known = cut(known.withColumn("errors", F.concat("errors", more)))
    quoted = F.to_json(F.array("arguments"))  # ["text"] or [null]
    quoted = F.substr(quoted, F.lit(2), F.length(quoted) - 2)
    whole = F.when(F.array_contains("errors", "arguments are not a JSON object"), quoted).otherwise(F.col("arguments"))
    line = F.concat(F.lit('{"arguments":'), whole, F.lit(","), F.substring(canonical(id=F.col("call_id"), name=F.col("name")), 2, 1 << 30))
    one = known.select(*key, "level", "turn", F.lit(0).alias("part"), F.lit(None).cast("long").alias("at"), F.lit("call").alias("kind"), "errors", line.alias("line"))
    link = known.select(*key, "level", "turn", F.lit(True).alias("linked"))
    two = results.select(*key, F.col("turn").cast("long").alias("at"), "content").join(link, key, "left")
    two = two.select(*key, "level", "turn", F.lit(1).alias("part"), "at", F.when(F.col("linked"), "result").otherwise("orphan").alias("kind"),
                     F.array().cast("array<string>").alias("errors"), canonical(content=F.col("content"), tool_call_id=F.col("call_id")).alias("line"))
    order = Window.partitionBy("conv_id").orderBy(F.col("kind") == "orphan", F.col("level").asc_nulls_last(), F.col("turn").asc_nulls_last(), "call_id", "part", "at", "line")
    return one.union(two).select("conv_id", F.row_number().over(order).alias("position"), "kind", "call_id", "level", "errors", "line")


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read off plain turns ``conv_id, turn, role, text``.

    A system turn calls ``configure``, a user turn ``reply``, after the last system turn
    before it; any other turn is the result of the last user turn before it (an orphan where there
    is none). Identifiers are ``<conv>-<turn>``. Rows of null conversation or turn are left to no call.
    """
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    name = lambda c: F.concat_ws("-", F.col("conv_id").cast("string"), c.cast("string"))
    t = turns.select("conv_id", "turn", "role", "text").where("conv_id is not null and turn is not null")
    t = t.withColumn("system", F.last(F.when(F.col("role") == "system", F.col("turn")), True).over(before)).withColumn("user", F.last(F.when(F.col("role") == "user", F.col("turn")), True).over(before))
    arguments = F.when(F.col("role") == "system", canonical(settings=F.col("text"))).otherwise(canonical(prompt=F.col("text"), turn=F.col("turn")))
    calls = t.where("role in ('system', 'user')").select(
        "conv_id", name(F.col("turn")).alias("call_id"), F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"), arguments.alias("arguments"),
        F.when((F.col("role") == "user") & F.col("system").isNotNull(), F.array(name(F.col("system")))).otherwise(F.array().cast("array<string>")).alias("after"), "turn")
    results = t.where("role is null or role not in ('system', 'user')").select("conv_id", F.when(F.col("user").isNotNull(), name(F.col("user"))).alias("call_id"), F.col("text").alias("content"), "turn")
    return calls, results


def conversation_schemas(spark) -> DataFrame:
    rows = [("configure", "settings", "string", True), ("reply", "prompt", "string", True), ("reply", "turn", "integer", True)]
    return spark.createDataFrame(rows, "tool string, param string, type string, required boolean")
