"""Tool-call linking, with DataFrame functions only: calls meet their results by a hash join on identifiers, are
put in topological order, checked against schemas, and written as canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import table
from strandline.session import land

# The tools of the query: name, required arguments, and the type of each argument.
TOOLS = (
    ("search", ("query", "limit"), {"query": "string", "limit": "integer", "after": "string"}),
    ("fetch", ("path",), {"path": "string", "depth": "integer", "after": "string"}),
    ("note", ("text", "pinned"), {"text": "string", "pinned": "boolean", "after": "string"}),
)

_CALL = "struct<id:string,name:string,arguments:string>"


def tool_schemas(spark: SparkSession, tools: tuple = TOOLS) -> DataFrame:
    """(name, required, kinds) of the tools; a fixed table."""
    rows = [(name, list(required), dict(kinds)) for name, required, kinds in tools]
    return spark.createDataFrame(rows, "name string, required array<string>, kinds map<string,string>")


def calls_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, id, name, arguments) of the calls in assistant messages: JSON with an array `tool_calls` of
    objects with id, name and arguments (an object or its text). Messages that aren't such JSON have no calls."""
    found = messages.filter("role = 'assistant' and text like '{%tool_calls%'").select(
        "conv_id", "turn", F.posexplode(F.from_json("text", f"struct<tool_calls:array<{_CALL}>>")["tool_calls"]).alias("nth", "call"))
    return found.select("conv_id", "turn", "nth", "call.id", "call.name", "call.arguments").filter("id is not null")


def results_of(messages: DataFrame) -> DataFrame:
    """(conv_id, id, result_turn, content) of tool messages: JSON with tool_call_id and content."""
    result = F.from_json("text", "struct<tool_call_id:string,content:string>")
    found = messages.filter("role = 'tool' and text like '{%tool_call_id%'").select("conv_id", F.col("turn").alias("result_turn"), result.alias("r"))
    return found.select("conv_id", F.col("r.tool_call_id").alias("id"), "result_turn", F.col("r.content").alias("content")).filter("id is not null")


def _kind(value: Column) -> Column:
    """The JSON type that a variant's type stands for."""
    kind = F.schema_of_variant(value)
    return (F.when(kind.like("OBJECT%"), "object").when(kind.like("ARRAY%"), "array").when(kind == "STRING", "string")
            .when(kind == "BOOLEAN", "boolean").when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
            .when(kind.like("DECIMAL(%,0)"), "integer").when(kind.like("DECIMAL%") | kind.isin("DOUBLE", "FLOAT"), "number").otherwise("null"))


def problems(arguments: Column, required: Column, kinds: Column) -> Column:
    """What is wrong with an arguments object: missing:x, unknown:x and type:x, in the order of the names."""
    names = F.json_object_keys(arguments)
    missing = F.transform(F.array_except(required, names), lambda n: F.concat(F.lit("missing:"), n))
    unknown = F.transform(F.array_except(names, F.map_keys(kinds)), lambda n: F.concat(F.lit("unknown:"), n))
    values = F.map_entries(F.from_json(arguments, "map<string,variant>"))
    wrong = F.filter(values, lambda e: F.element_at(kinds, e["key"]).isNotNull() & (_kind(e["value"]) != F.element_at(kinds, e["key"]))
                     & ~((F.element_at(kinds, e["key"]) == "number") & (_kind(e["value"]) == "integer")))
    return F.array_sort(F.concat(missing, unknown, F.transform(wrong, lambda e: F.concat(F.lit("type:"), e["key"]))))


def ordered(calls: DataFrame) -> DataFrame:
    """(conv_id, id, level): the longest chain of calls that each call waits for; null if it waits for itself.

    `calls` has (conv_id, id, needs), needs being ids of the same conversation; others are ignored. Each round
    settles the calls whose needs are all settled, by joins on identifiers, so a conversation of any size is
    spread over tasks; there are as many rounds as the longest chain has calls.
    """
    edges = calls.select("conv_id", "id", F.explode("needs").alias("need")).distinct()
    edges = edges.join(calls.select("conv_id", F.col("id").alias("need")), ["conv_id", "need"])
    edges = land(edges.select("conv_id", "id", "need"), "needs")
    waiting = edges.select("conv_id", "id").distinct()
    settled = land(calls.select("conv_id", "id").join(waiting, ["conv_id", "id"], "left_anti").withColumn("level", F.lit(0)), "settled")
    level, last, found = 0, settled, [settled]
    while not edges.isEmpty() and not last.isEmpty():
        level += 1
        # needs settled in the last round are met; calls without other needs are settled in this one
        met = edges.join(last.select("conv_id", F.col("id").alias("need")), ["conv_id", "need"]).select("conv_id", "id", "need")
        edges = land(edges.join(met, ["conv_id", "id", "need"], "left_anti"), "needs")
        ready = met.select("conv_id", "id").distinct().join(edges.select("conv_id", "id").distinct(), ["conv_id", "id"], "left_anti")
        last = land(ready.withColumn("level", F.lit(level)), "settled")
        found.append(last)
    union = found[0]
    for part in found[1:]:
        union = union.unionByName(part)
    return union


def link(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, turn, call_id, name, level, status, problems, result_turn, canonical), one row for each call id.

    Of several calls with one id in a conversation the first counts (by turn, then place); of several results the
    first. A call waits for the calls whose ids stand in its argument `after`, separated by commas. status: ok;
    cycle (it waits for itself); unknown_tool; bad_arguments (no JSON object, or `problems` lists what differs
    from the schema); no_result; early_result (the result's turn is not after the call's). canonical: the call
    and its result as JSON with sorted keys and no blanks; null where the arguments are no object. Null
    conversations or ids, and messages that are no such JSON, are passed over; numbers are
    written in their shortest form (2.0 is the integer 2). Repeated rows count once. Other columns are ignored; an empty table gives an empty table.
    """
    rank = F.struct("turn", "nth", "name", "arguments")
    calls = calls_of(messages).filter("conv_id is not null").groupBy("conv_id", "id").agg(F.min(rank).alias("c")).select("conv_id", "id", "c.turn", "c.name", "c.arguments")
    results = results_of(messages).filter("conv_id is not null").groupBy("conv_id", "id").agg(F.min(F.struct("result_turn", "content")).alias("r")).select("conv_id", "id", "r.result_turn", "r.content")
    calls = land(calls, "calls")
    after = F.split(F.coalesce(F.get_json_object("arguments", "$.after"), F.lit("")), ",")
    levels = ordered(calls.select("conv_id", "id", F.filter(after, lambda x: x != "").alias("needs")))
    joined = (calls.join(results, ["conv_id", "id"], "left").join(levels, ["conv_id", "id"], "left")
              .join(F.broadcast(schemas), "name", "left"))
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).like("OBJECT%"), F.lit(False))
    checked = joined.withColumn("is_object", is_object).withColumn(
        "problems", F.when(F.col("is_object") & F.col("required").isNotNull(), problems(F.col("arguments"), F.col("required"), F.col("kinds"))))
    status = (F.when(F.col("level").isNull(), "cycle").when(F.col("required").isNull(), "unknown_tool")
              .when(~F.col("is_object") | (F.size("problems") > 0), "bad_arguments").when(F.col("result_turn").isNull(), "no_result")
              .when(F.col("result_turn") <= F.col("turn"), "early_result").otherwise("ok"))
    # the fields are named in sorted order; sorting inside the arguments is done by the variant's encoding
    text = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit(""))
    quoted = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(text(c))
    canonical = F.when(F.col("is_object"), F.concat(
        F.lit('{"arguments":'), F.to_json(parsed), F.lit(',"id":'), quoted("id"), F.lit(',"name":'), quoted("name"),
        F.lit(',"result":'), quoted("content"), F.lit("}")))
    return checked.select("conv_id", "turn", F.col("id").alias("call_id"), "name", "level", status.alias("status"),
                          F.array_join(F.coalesce("problems", F.array().cast("array<string>")), ",").alias("problems"), "result_turn", canonical.alias("canonical"))


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Tool messages derived from plain conversations, for the query: each assistant turn becomes a call whose tool,
    arguments and needs follow from its turn and length, and each user turn after the first the result of the
    call before it; by the length some arguments break their schema and some results are left out."""
    n = F.coalesce(F.length("text"), F.lit(0))
    key = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn, word = F.col("turn"), F.regexp_extract(F.coalesce("text", F.lit("")), "^[A-Za-z]*", 0)
    after = F.when(~(turn % 6).isin(1, 2) & (turn > 2), key(turn - 2))
    search = F.struct(F.when(n % 7 == 0, F.lit(None)).otherwise(word).alias("query"), n.alias("limit"), after.alias("after"))
    fetch = F.struct(word.alias("path"), F.when(n % 5 == 0, F.lit(1.5)).otherwise(F.lit(2.0)).alias("depth"), after.alias("after"))
    note = F.struct(word.alias("text"), (n % 2 == 0).alias("pinned"), F.when(n % 11 == 0, n).alias("extra"), after.alias("after"))
    call = lambda name, arguments: F.to_json(F.struct(F.array(F.struct(key(turn).alias("id"), F.lit(name).alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    asked = F.when(n % 3 == 0, call("search", search)).when(n % 3 == 1, call("fetch", fetch)).otherwise(call("note", note))
    answer = F.to_json(F.struct(key(turn - 1).alias("tool_call_id"), word.alias("content")))
    rows = conversations.filter("role = 'assistant' or (role = 'user' and turn > 0)").filter((F.col("role") == "assistant") | (n % 13 != 0))
    return rows.select("conv_id", "turn", F.when(F.col("role") == "user", "tool").otherwise("assistant").alias("role"),
                       F.when(F.col("role") == "user", answer).otherwise(asked).alias("text"))


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results derived from all conversations, linked, ordered, checked and written as canonical JSON."""
    return link(as_tool_messages(table(spark, sf_dir, "conversations")), tool_schemas(spark))


OP3_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(length(text), 0) AS n, regexp_extract(coalesce(text, ''), '^[A-Za-z]*') AS word,
         'c' || conv_id || '-' || turn AS id, 'c' || conv_id || '-' || (turn - 2) AS two, 'c' || conv_id || '-' || (turn - 1) AS one
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND (role = 'assistant' OR (role = 'user' AND turn > 0))
), raw AS (
  SELECT *, CASE WHEN turn % 6 NOT IN (1, 2) AND turn > 2 THEN two END AS after, ['search', 'fetch', 'note'][n % 3 + 1] AS name FROM t WHERE role = 'assistant'
), args AS (
  SELECT *,
    CASE name
      WHEN 'search' THEN CASE WHEN n % 7 = 0 THEN 'missing:query' ELSE '' END
      WHEN 'fetch' THEN CASE WHEN n % 5 = 0 THEN 'type:depth' ELSE '' END
      ELSE CASE WHEN n % 11 = 0 THEN 'unknown:extra' ELSE '' END END AS problems,
    '{' || CASE WHEN after IS NULL THEN '' ELSE '"after":"' || after || '",' END ||
    CASE name
      WHEN 'search' THEN '"limit":' || n || CASE WHEN n % 7 = 0 THEN '' ELSE ',"query":"' || word || '"' END
      WHEN 'fetch' THEN '"depth":' || CASE WHEN n % 5 = 0 THEN '1.5' ELSE '2' END || ',"path":"' || word || '"'
      ELSE CASE WHEN n % 11 = 0 THEN '"extra":' || n || ',' ELSE '' END || '"pinned":' || CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END || ',"text":"' || word || '"' END || '}' AS arguments
  FROM raw
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, id ORDER BY turn, name, arguments) AS nth FROM args
), calls AS (SELECT * FROM ranked WHERE nth = 1),
results AS (
  SELECT conv_id, one AS id, min(turn) AS result_turn, min(word) AS content FROM t WHERE role = 'user' AND n % 13 <> 0 GROUP BY conv_id, one
), levels AS (
  SELECT a.conv_id, a.id,
         CASE WHEN a.after IS NULL OR b.id IS NULL THEN 0 WHEN b.after IS NULL OR c.id IS NULL THEN 1 ELSE 2 END AS level
  FROM calls a LEFT JOIN calls b ON a.conv_id = b.conv_id AND a.after = b.id LEFT JOIN calls c ON b.conv_id = c.conv_id AND b.after = c.id
)
SELECT a.conv_id, a.turn, a.id AS call_id, a.name, level,
       CASE WHEN problems <> '' THEN 'bad_arguments' WHEN result_turn IS NULL THEN 'no_result' ELSE 'ok' END AS status,
       problems, result_turn,
       '{"arguments":' || arguments || ',"id":"' || a.id || '","name":"' || a.name || '","result":' || CASE WHEN content IS NULL THEN 'null' ELSE '"' || content || '"' END || '}' AS canonical
FROM calls a JOIN levels USING (conv_id, id) LEFT JOIN results r ON a.conv_id = r.conv_id AND a.id = r.id
"""
