"""Chat messages with tool calls linked to their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on (conversation, call id). A result comes after its call and a
call after the results its arguments refer to; ordering peels the graph of these references level by
level, so the number of rounds is the longest chain of references and never depends on a conversation's
length. Every message, call and result is a row of its own: no conversation is gathered anywhere, and
positions come from a range shuffle and per-partition counts.

Everything is DataFrame functions. JSON is parsed into variants, whose objects keep their keys in order,
which makes their text canonical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import numbered, present, stored
from chronotape.operators.sizing import broadcast_if_small

MESSAGE, CALL, RESULT = "message", "call", "result"
#: In arguments, ``{"$ref": "<call id>"}`` stands for the result of that call.
REFERENCE = r'"\$ref"\s*:\s*"([^"\\]*)"'
#: Variant types a parameter type admits.
_ADMITS = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*|FLOAT", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*"}


def _validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Add ``parsed`` (variant, null for arguments that are not a JSON object) and ``faults``."""
    names = F.struct("param", "type", "required")
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(names)).alias("params")).withColumnRenamed("name", "__tool")
    parsed = calls.withColumn("parsed", F.expr("try_parse_json(arguments)"))
    parsed = parsed.withColumn("parsed", F.expr("if(schema_of_variant(parsed) LIKE 'OBJECT%', parsed, NULL)"))
    # {"$ref": ...} has the type of whatever it stands for
    kinds = F.expr(
        "transform_values(CAST(parsed AS MAP<STRING, VARIANT>), (k, v) -> if(try_variant_get(v, '$[\"$ref\"]', 'string') IS NOT NULL, '*', schema_of_variant(v)))"
    )
    joined = parsed.withColumn("kinds", kinds).join(broadcast_if_small(tools, 100_000), F.col("name") == F.col("__tool"), "left")
    admits = F.create_map(*[F.lit(x) for pair in _ADMITS.items() for x in pair])
    params = F.col("params")

    def wrong(p: Column) -> Column:
        kind = F.element_at(F.col("kinds"), p["param"])
        missing = F.when(p["required"], F.concat(F.lit("missing:"), p["param"]))
        fits = (kind == "*") | F.rlike(kind, F.concat(F.lit("^(?:"), F.coalesce(F.element_at(admits, p["type"]), F.lit(".*")), F.lit(")$")))
        return F.when(kind.isNull(), missing).when(~fits, F.concat(F.lit("type:"), p["param"]))

    known = F.transform(params, lambda p: p["param"])
    extra = F.transform(F.array_except(F.map_keys("kinds"), known), lambda k: F.concat(F.lit("unexpected:"), k))
    of_arguments = F.concat(F.array_compact(F.transform(params, wrong)), F.array_sort(extra))
    faults = F.when(F.col("__tool").isNull(), F.array(F.lit("unknown_tool"))).when(F.col("parsed").isNull(), F.array(F.lit("invalid_arguments"))).otherwise(of_arguments)
    return joined.withColumn("faults", faults).drop("kinds", "params", "__tool")


def link_tool_calls(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, position (from 0 without gaps), turn, kind, role, call_id, name, linked, faults and json per row.

    ``messages`` has conv_id, turn, role, text; ``calls`` conv_id, turn, call_id, name, arguments (JSON
    text); ``results`` conv_id, turn, call_id, content; ``schemas`` name, param, type, required. Further
    columns are ignored.

    Of several calls with one id in a conversation the earliest owns it, of several results the earliest
    answers it; the others stay, marked duplicate_id or repeated_result. Calls without a result are
    marked unanswered, results without a call orphan. Null ids link nothing. References to unknown ids
    are marked unknown_reference and order nothing; rows on a cycle of references are marked cyclic and
    come last. Null texts stay null in the JSON, where fields that are null are left out. Repeated rows
    stay repeated. Empty tables give an empty result.
    """
    conv = F.col("conv_id").cast("long").alias("conv_id")
    turn = F.col("turn").cast("long").alias("turn")
    said = messages.select(conv, turn, F.lit(MESSAGE).alias("kind"), "role", F.lit(None).cast("string").alias("call_id"), F.col("text").alias("content"))
    called = stored(_validated(calls.select(conv, turn, "call_id", "name", "arguments"), schemas).withColumn("node", F.monotonically_increasing_id()), "chat-calls")
    answered = stored(results.select(conv, turn, "call_id", "content").withColumn("node", F.monotonically_increasing_id()), "chat-results")

    by = ["conv_id", "call_id"]
    owner = called.where(F.col("call_id").isNotNull()).groupBy(*by).agg(F.min(F.struct("turn", "node")).alias("c"))
    reply = answered.where(F.col("call_id").isNotNull()).groupBy(*by).agg(F.min(F.struct("turn", "node")).alias("r"))
    pairs = stored(
        owner.join(reply, by, "full").select(*by, F.col("c.node").alias("call_node"), F.col("c.turn").alias("call_turn"), F.col("r.node").alias("result_node"), F.col("r.turn").alias("result_turn")),
        "chat-pairs",
    )
    levels = _ordered(called, pairs)

    link = pairs.select(*by, "call_node", "result_node", "call_turn")
    owns = F.col("node") == F.col("call_node")
    calls_out = called.join(link, by, "left").join(levels.withColumnsRenamed({"conv_id": "__c", "call_id": "__i"}), (F.col("conv_id") == F.col("__c")) & (F.col("call_id") == F.col("__i")) & F.coalesce(owns, F.lit(False)), "left")
    status = F.array_compact(
        F.array(
            F.when(F.col("call_node").isNotNull() & ~owns, "duplicate_id").when(F.col("result_node").isNull(), "unanswered"),
            F.when(F.col("unknown"), "unknown_reference"), F.when(F.col("cyclic"), "cyclic"),
        )
    )
    faults = F.concat("faults", status)
    call_json = F.to_json(
        F.struct(
            F.coalesce(F.col("parsed"), F.expr("parse_json(to_json(struct(arguments AS text)))")).alias("arguments"),
            F.when(F.size(faults) > 0, faults).alias("faults"), F.col("call_id").alias("id"), F.col("name").alias("name"), F.lit("tool_call").alias("type"),
        )
    )
    answered_call = owns & F.col("result_node").isNotNull()
    rows_c = calls_out.select(
        "conv_id", "turn", F.lit(CALL).alias("kind"), F.lit("assistant").alias("role"), "call_id", "name", F.coalesce(answered_call, F.lit(False)).alias("linked"),
        F.array_join(faults, ",").alias("faults"), call_json.alias("json"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        F.coalesce(F.greatest("turn", "after"), "turn").alias("at"), F.coalesce("level", F.lit(0)).alias("level"),
    )
    first = F.col("node") == F.col("result_node")
    results_out = answered.join(link, by, "left").join(levels.drop("unknown").withColumnsRenamed({"conv_id": "__c", "call_id": "__i"}), (F.col("conv_id") == F.col("__c")) & (F.col("call_id") == F.col("__i")), "left")
    fault = F.when(F.col("call_node").isNull(), "orphan").when(~first, "repeated_result").otherwise("")
    result_json = F.to_json(
        F.struct(F.col("content").alias("content"), F.when(fault != "", F.array(fault)).alias("faults"), F.col("call_id").alias("id"), F.lit("tool_result").alias("type"))
    )
    rows_r = results_out.select(
        "conv_id", "turn", F.lit(RESULT).alias("kind"), F.lit("tool").alias("role"), "call_id", F.lit(None).cast("string").alias("name"),
        F.coalesce(first & F.col("call_node").isNotNull(), F.lit(False)).alias("linked"), fault.alias("faults"), result_json.alias("json"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"), F.greatest("turn", "call_turn", "after").alias("at"), (F.coalesce("level", F.lit(0)) + 1).alias("level"),
    )
    message_json = F.to_json(F.struct(F.col("content").alias("content"), F.col("role").alias("role"), F.lit("message").alias("type")))
    rows_m = said.select(
        "conv_id", "turn", "kind", "role", "call_id", F.lit(None).cast("string").alias("name"), F.lit(False).alias("linked"), F.lit("").alias("faults"),
        message_json.alias("json"), F.lit(False).alias("cyclic"), F.col("turn").alias("at"), F.lit(-1).alias("level"),
    )
    every = rows_m.unionByName(rows_c).unionByName(rows_r)
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "cyclic", "at", "level", "turn", "kind", "call_id", "json")]
    placed, _ = numbered(every, keys, "chat-rows")
    starts = placed.groupBy("conv_id").agg(F.min("row_number").alias("__first")).withColumnRenamed("conv_id", "__conv")
    out = placed.join(starts, F.col("conv_id").eqNullSafe(F.col("__conv")))
    return out.select("conv_id", (F.col("row_number") - F.col("__first")).alias("position"), "turn", "kind", "role", "call_id", "name", "linked", "faults", "json")


def _ordered(called: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per owned call id: ``level`` (longest chain of references before it, two steps per call), ``after`` (the
    latest turn on that chain), ``unknown`` and ``cyclic``."""
    ids = pairs.where(F.col("call_node").isNotNull())
    nodes = ids.select("conv_id", "call_id", F.col("call_turn").alias("turn"), F.greatest("call_turn", "result_turn").alias("done_at"), "call_node")
    refs = called.join(nodes.select("call_node"), F.col("node") == F.col("call_node"), "left_semi").select(
        "conv_id", "call_id", F.explode(F.array_distinct(F.regexp_extract_all(present(F.col("arguments")), F.lit(REFERENCE), F.lit(1)))).alias("needs")
    )
    target = nodes.select(F.col("conv_id").alias("__c"), F.col("call_id").alias("needs_id"))
    matched = stored(refs.join(target, (F.col("conv_id") == F.col("__c")) & (F.col("needs") == F.col("needs_id")), "left").drop("__c"), "chat-references")
    edges = matched.where(F.col("needs_id").isNotNull()).select("conv_id", "call_id", "needs_id")
    unknown = matched.where(F.col("needs_id").isNull()).select("conv_id", "call_id").distinct().withColumn("unknown", F.lit(True))

    by = ["conv_id", "call_id"]
    open_ = nodes.drop("call_node")
    waits = edges.groupBy(*by).agg(F.count("*").alias("needed"))
    free = open_.join(waits, by, "left_anti").withColumns({"level": F.lit(0), "after": F.col("turn")})
    solved = stored(free.select(*by, "done_at", "level", "after"), "chat-levels")
    fresh, frontier = not edges.isEmpty(), solved
    rest = waits
    while fresh:
        known = solved.select(F.col("conv_id").alias("__c"), F.col("call_id").alias("__i"), "level", F.greatest("done_at", "after").alias("end"))
        met = edges.join(rest.select(*by), by, "left_semi").join(known, (F.col("conv_id") == F.col("__c")) & (F.col("needs_id") == F.col("__i")))
        ready = met.groupBy(*by).agg(F.count("*").alias("met"), F.max("level").alias("l"), F.max("end").alias("e")).join(rest, by).where("met = needed")
        frontier = stored(
            ready.join(open_, by).select(*by, F.greatest("done_at", "e").alias("done_at"), (F.col("l") + 2).alias("level"), F.greatest("turn", "e").alias("after")), "chat-levels"
        )
        fresh = not frontier.isEmpty()
        if fresh:
            solved = stored(solved.unionByName(frontier), "chat-levels")
            rest = stored(rest.join(frontier, by, "left_anti"), "chat-waiting")
    stuck = rest.join(open_, by).select(*by, "done_at", F.lit(0).alias("level"), F.col("turn").alias("after"), F.lit(True).alias("cyclic"))
    return (
        solved.withColumn("cyclic", F.lit(False)).unionByName(stuck).drop("done_at").join(unknown, by, "left").withColumn("unknown", F.coalesce("unknown", F.lit(False)))
    )
