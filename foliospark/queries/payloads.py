"""Queries for models' payloads (C)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import payloads as P
from ..functions import requests as R
from ..functions import text as X
from ..registry import query
from ..session import stored, table
from ..streaming import texts


def _joined(spark, folder, part, head, tail):
    """One payload for each conversation from a JSON text of every turn."""
    own = table(spark, folder, "conversations").select(F.col("conv_id").alias("message"), "turn", part.alias("part"))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "part"))), lambda r: r["part"]), ",")
    return own.groupBy("message").agg(F.concat(head, parts, tail).alias("payload"))


def _text(*pieces):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def candidates(spark, folder):
    """Turns as parts of a candidate: text, a call and its response (for a third of the messages under another id), a thought, code and its result."""
    t, c, said = F.col("turn"), F.col("conv_id"), P.quote(F.coalesce("text", F.lit("")))
    n = lambda x: x.cast("string")
    part = (
        F.when(t % 6 == 0, _text('{"text":', said, "}")).when(t % 6 == 1, _text('{"functionCall":{"id":"k', n(t), '","name":"lookup","args":{"q":', said, "}}}"))
        .when(t % 6 == 2, _text('{"functionResponse":{"id":"', F.when(c % 3 == 0, "other").otherwise(_text("k", n(t - 1))), '","name":"lookup","response":{"turn":', n(t), "}}}"))
        .when(t % 6 == 3, _text('{"thought":true,"thoughtSignature":"private","text":', said, "}")).when(t % 6 == 4, _text('{"executableCode":{"language":"PYTHON","code":', said, "}}"))
        .otherwise(_text('{"codeExecutionResult":{"outcome":"OUTCOME_', F.when(c % 2 == 1, "OK").otherwise("FAILED"), '","output":"o', n(t), '"}}'))
    )
    web = lambda i: _text('{"web":{"uri":"https://e.example/', n(c % i), '","title":"', F.when(c % 2 == 0, "t").otherwise(""), '"}}')
    own = table(spark, folder, "conversations").select(F.col("conv_id")).distinct().select(F.col("conv_id").alias("message"), _text('],"role":"model"},"finishReason":"STOP","groundingMetadata":{"groundingChunks":[', web(3), ",", web(4), "]}}]}").alias("tail"))
    return _joined(spark, folder, part, F.lit('{"responseId":"r","candidates":[{"content":{"parts":['), F.lit("")).join(own, "message").select("message", F.concat("payload", "tail").alias("payload"))


def interactions(spark, folder):
    """Turns as steps of an agent: thoughts, code with results, texts and searches without."""
    t, said = F.col("turn"), P.quote(F.coalesce("text", F.lit("")))
    n = t.cast("string")
    part = (
        F.when(t % 5 == 0, _text('{"type":"thought","signature":"private","summary":[{"type":"text","text":', said, "}]}"))
        .when(t % 5 == 1, _text('{"type":"code_execution_call","id":"k', n, '","code":', said, "}"))
        .when(t % 5 == 2, _text('{"type":"code_execution_result","call_id":"k', (t - 1).cast("string"), '","output":"o', n, '","exit_code":', (F.col("conv_id") % 2).cast("string"), "}"))
        .when(t % 5 == 3, _text('{"type":"model_output","content":[{"type":"text","text":', said, ',"annotations":[{"url":"https://e.example/', n, '"}]}]}'))
        .otherwise(_text('{"type":"web_search_call","queries":[', said, "]}"))
    )
    states = F.element_at(F.array(*map(F.lit, ("completed", "incomplete", "failed", "cancelled", "requires_action"))), (F.col("message") % 5 + 1).cast("int"))
    whole = _joined(spark, folder, part, F.lit('{"steps":['), F.lit(""))
    return whole.select("message", _text(F.col("payload"), '],"status":"', states, '","usage":{"total_tokens":', F.col("message").cast("string"), ',"total_input_tokens":-1},"error":{"message":"', F.when(F.col("message") % 2 == 0, "broken").otherwise(""), '"}}').alias("payload"))


TURNS_SQL = "t AS (SELECT conv_id AS message, turn, to_json(coalesce(text, ''))::VARCHAR AS q, coalesce(text, '') AS text, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)"
DISPLAY_SQL = f"""WITH {TURNS_SQL}, k AS (SELECT *, turn % 6 AS m, turn + 1 < n AS more FROM t WHERE NOT (turn % 6 = 2 AND message % 3 <> 0) AND turn % 6 <> 5),
p AS (SELECT message, row_number() OVER (PARTITION BY message ORDER BY turn) AS sequence, CASE m WHEN 0 THEN 'text' WHEN 3 THEN 'reasoning' WHEN 4 THEN 'server_tool' ELSE 'tool' END AS type,
CASE m WHEN 1 THEN 'k' || turn WHEN 2 THEN 'other' WHEN 4 THEN 'c0p' || turn || ':code_execution' END AS tool_call_id, CASE WHEN m IN (1, 2) THEN 'lookup' WHEN m = 4 THEN 'code_execution' END AS tool_name,
CASE WHEN m = 1 THEN CASE WHEN more AND message % 3 <> 0 THEN 'completed' ELSE 'in_progress' END WHEN m = 2 THEN 'completed' WHEN m = 4 THEN CASE WHEN NOT more THEN 'in_progress' WHEN message % 2 = 1 THEN 'completed' ELSE 'failed' END END AS status,
CASE m WHEN 1 THEN '{{"q": ' || q || '}}' WHEN 2 THEN '{{}}' WHEN 4 THEN '{{"language": "PYTHON", "code": ' || q || '}}' END AS input,
CASE WHEN m = 1 AND more AND message % 3 <> 0 THEN '{{"turn": ' || turn + 1 || '}}' WHEN m = 2 THEN '{{"turn": ' || turn || '}}' WHEN m = 4 AND more THEN '{{"outcome": "OUTCOME_' || CASE WHEN message % 2 = 1 THEN 'OK' ELSE 'FAILED' END || '", "output": "o' || turn + 1 || '"}}' END AS output,
CASE WHEN m IN (0, 3) THEN text END AS text FROM k)"""


@query(DISPLAY_SQL + " SELECT message, sequence, type, tool_call_id, tool_name, status, sha256(input) AS input, sha256(output) AS output, sha256(text) AS text FROM p")
def c19_display_parts(spark, folder):
    own = P.display_parts(candidates(spark, folder), P.CANDIDATES)
    digest = lambda c: F.sha2(c, 256).alias(c)
    return own.select("message", "sequence", "type", "tool_call_id", "tool_name", "status", digest("input"), digest("output"), digest("text"))


@query(DISPLAY_SQL + " SELECT message, sequence, tool_call_id AS call_id, CASE WHEN type = 'tool' THEN 'client' ELSE 'server' END AS kind, status, octet_length(encode(input)) AS input_bytes, octet_length(encode(output)) AS output_bytes FROM p WHERE type IN ('tool', 'server_tool')")
def c19_tool_calls(spark, folder):
    calls = P.tool_calls(P.display_parts(candidates(spark, folder), P.CANDIDATES))
    size = lambda c: F.octet_length(c).cast("long").alias(f"{c}_bytes")
    return calls.select("message", "sequence", "call_id", "kind", "status", size("input"), size("output"))


@query(f"""WITH {TURNS_SQL} SELECT a.message, row_number() OVER (PARTITION BY a.message ORDER BY a.turn)::INTEGER AS place, 'k' || a.turn AS call_id, sha256(a.text) AS code, 'o' || b.turn AS output, a.message % 2 AS exit_code,
CASE WHEN a.message % 2 = 1 THEN 'failed' ELSE 'completed' END AS status FROM t a JOIN t b ON a.message = b.message AND b.turn = a.turn + 1 WHERE a.turn % 5 = 1""")
def c19_code_executions(spark, folder):
    runs = P.code_executions(P.display_parts(interactions(spark, folder), P.INTERACTIONS))
    return runs.select("message", "place", "call_id", F.sha2("code", 256).alias("code"), "output", "exit_code", "status")


@query("""WITH c AS (SELECT DISTINCT conv_id AS message FROM conversations), u AS (SELECT message, CASE WHEN message % 2 = 0 THEN 't' ELSE '' END AS title, unnest(list_distinct(['https://e.example/' || message % 3, 'https://e.example/' || message % 4])) AS url FROM c)
SELECT message, coalesce(nullif(title, ''), url) AS title, url FROM u""")
def c19_annotations(spark, folder):
    return P.annotations(candidates(spark, folder), P.CANDIDATES).select("message", "title", "url")


@query(f"""WITH {TURNS_SQL}, b AS (SELECT message, turn, octet_length(encode('{{"id": "c0p' || turn || CASE turn % 6
WHEN 0 THEN '", "candidate": 0, "type": "text", "text": ' || q WHEN 3 THEN '", "candidate": 0, "type": "reasoning", "text": ' || q
WHEN 1 THEN 'functionCall", "candidate": 0, "type": "tool-call", "name": "lookup", "callId": "k' || turn || '", "data": {{"args": {{"q": ' || q || '}}, "id": "k' || turn || '", "name": "lookup"}}'
WHEN 2 THEN 'functionResponse", "candidate": 0, "type": "tool-result", "name": "lookup", "callId": "' || i || '", "data": {{"id": "' || i || '", "name": "lookup", "response": {{"turn": ' || turn || '}}}}'
WHEN 4 THEN 'executableCode", "candidate": 0, "type": "tool-call", "name": "code_execution", "callId": "", "data": {{"code": ' || q || ', "language": "PYTHON"}}'
ELSE 'codeExecutionResult", "candidate": 0, "type": "tool-result", "name": "code_execution", "callId": "", "data": {{"outcome": "OUTCOME_' || CASE WHEN message % 2 = 1 THEN 'OK' ELSE 'FAILED' END || '", "output": "o' || turn || '"}}' END || '}}')) AS bytes
FROM (SELECT *, CASE WHEN message % 3 = 0 THEN 'other' ELSE 'k' || turn - 1 END AS i FROM t))
SELECT message, count(*)::INTEGER AS total_parts, 0::BIGINT AS omitted_parts, FALSE AS truncated, sum(bytes)::BIGINT AS bytes FROM b GROUP BY message""")
def c18_snapshots(spark, folder):
    """Sizes of snapshots and what they say of themselves."""
    parts, captures = P.snapshots(candidates(spark, folder), P.CANDIDATES)
    sizes = stored(parts).filter("kept").groupBy("message").agg(F.sum("bytes").alias("bytes"))
    return captures.join(sizes, "message").select("message", "total_parts", "omitted_parts", "truncated", "bytes")


@query(f"""WITH {TURNS_SQL}, r AS (SELECT message, count(*) AS step_count, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (turn % 5 = 3), '') AS reply, count(*) FILTER (turn % 5 = 1) AS codes, count(*) FILTER (turn % 5 = 4) AS searches FROM t GROUP BY message)
SELECT message, sha256(reply) AS reply, CASE message % 5 WHEN 1 THEN '{P.SAID["incomplete"]}' WHEN 3 THEN '{P.SAID["cancelled"]}' WHEN 0 THEN CASE WHEN trim(reply) = '' THEN '{P.SAID["no text"]}' ELSE '' END
ELSE '{P.SAID["failed"]}' || CASE WHEN message % 2 = 0 THEN 'broken' WHEN message % 5 = 4 THEN '{P.SAID["external"]}' ELSE '{P.SAID["no detail"]}' END END AS error,
['COMPLETED', 'INCOMPLETE', 'FAILED', 'CANCELLED', 'REQUIRES_ACTION'][(message % 5 + 1)::INTEGER] AS finish_reason, message AS total_tokens, NULL::BIGINT AS prompt_tokens, nullif(codes, 0) AS codes, nullif(searches, 0) AS searches, step_count FROM r""")
def c10_interactions(spark, folder):
    own = P.interaction_results(interactions(spark, folder))
    used = lambda n: F.col("usage")[n]
    calls = lambda n: F.col("tool_calls")[n]
    return own.select(
        "message", F.sha2("reply", 256).alias("reply"), "error", "finish_reason", used("totalTokenCount").alias("total_tokens"), used("promptTokenCount").alias("prompt_tokens"),
        calls("code_execution_call").alias("codes"), calls("web_search_call").alias("searches"), "step_count",
    )


@query(f"""WITH {TURNS_SQL}, f AS (SELECT message, text, ['STOP', 'MAX_TOKENS', 'SAFETY', '', ''][(message % 5 + 1)::INTEGER] AS reason FROM t WHERE turn = 0)
SELECT message, sha256(text) AS reply, CASE message % 5 WHEN 1 THEN '{P.CUT}' WHEN 2 THEN '{P.NOT_ENDED[0]}SAFETY{P.NOT_ENDED[1]}' WHEN 4 THEN '{P.NOT_ENDED[0]}PROMPT_BLOCKED{P.NOT_ENDED[1]}' ELSE CASE WHEN trim(text) = '' THEN '{P.NO_TEXT}' ELSE '' END END AS error,
reason AS finish_reason, message AS total, CASE WHEN message % 2 = 1 THEN 3 END AS tools, CASE WHEN message % 2 = 1 THEN 2 ELSE 1 END AS counters FROM f""")
def c09_answer_results(spark, folder):
    """First turns as replies with a thought, ended in five ways."""
    c = F.col("conv_id")
    reason = F.element_at(F.array(*map(F.lit, ("STOP", "MAX_TOKENS", "SAFETY", "", ""))), (c % 5 + 1).cast("int"))
    tools = F.when(c % 2 == 1, ',"toolUsePromptTokenCount":3').otherwise(',"toolUseTokenCount":-1')
    payload = _text(
        '{"candidates":[{"finishReason":"', reason, '","content":{"parts":[{"text":"thinking","thought":true},{"text":', P.quote(F.coalesce("text", F.lit(""))), '}]}}],"promptFeedback":{"blockReason":"', F.when(c % 5 == 4, "OTHER").otherwise(""),
        '"},"usageMetadata":{"totalTokenCount":', c.cast("string"), ',"promptTokenCount":"many"', tools, "}}",
    )
    own = P.answer_results(table(spark, folder, "conversations").filter("turn = 0").select(c.alias("message"), payload.alias("payload")))
    used = own.withColumn("usage", F.map_filter("usage", lambda k, _: k != "toolUsePromptTokenCount"))
    return used.select("message", F.sha2("reply", 256).alias("reply"), "error", "finish_reason", F.col("usage")["totalTokenCount"].alias("total"), F.col("usage")["toolUseTokenCount"].alias("tools"), F.size("usage").cast("long").alias("counters"))


MODELS = ("gemini-2.5-pro", "gemini-2.0-flash", "gemini-3-flash", "other", "gemini-2.5-flash", "gemini-1.5-thinking")
LEVELS = ("none", "high", "", "max", "Low")
#: What each model sends for each level, as known from the families' rules.
THINKING = {
    (0, 0): '{"thinkingBudget":128,"includeThoughts":true}', (0, 1): '{"thinkingBudget":24576,"includeThoughts":true}', (0, 2): '{"includeThoughts":true}', (0, 3): '{"thinkingBudget":24576,"includeThoughts":true}', (0, 4): '{"thinkingBudget":4096,"includeThoughts":true}',
    **{(m, l): f'{{"thinkingLevel":"{v}","includeThoughts":true}}' for m in (2, 3, 5) for l, v in ((1, "high"), (3, "high"), (4, "low"))}, (2, 2): '{"includeThoughts":true}',
    (4, 0): '{"thinkingBudget":0}', (4, 1): '{"thinkingBudget":24576,"includeThoughts":true}', (4, 2): '{"includeThoughts":true}', (4, 3): '{"thinkingBudget":24576,"includeThoughts":true}', (4, 4): '{"thinkingBudget":4096,"includeThoughts":true}',
}
THINKING_SQL = "CASE " + " ".join(f"WHEN message % 6 = {m} AND message % 5 = {level} THEN '\"thinkingConfig\":{text},'" for (m, level), text in THINKING.items()) + " ELSE '' END"


@query(f"""WITH {TURNS_SQL}, m AS (SELECT message, max(q) FILTER (turn = 0) AS first, coalesce(string_agg('{{"role":"' || CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'model' END || '","parts":[{{"text":' || {{0}} || '}}]}}', ',' ORDER BY turn) FILTER (turn > 0) || ',', '') AS history FROM t GROUP BY message)
SELECT message, sha256('{{"contents":[' || history || '{{"role":"user","parts":[{{"text":"do"}}' || CASE WHEN first = '""' THEN '' ELSE ',{{"text":' || first || '}}' END || ',{{"inlineData":{{"mimeType":"image/png","data":"AA=="}}}}]}}],"generationConfig":{{' || {THINKING_SQL} || '"maxOutputTokens":' || CASE WHEN message % 2 = 0 THEN '8192' ELSE '100' END || '}},"systemInstruction":{{"parts":[{{"text":"be brief"}}]}}}}') AS payload FROM m""".replace("{0}", "q"))
def c16_content_requests(spark, folder):
    """First turns as inputs, the others as history, over six models and five levels."""
    own = table(spark, folder, "conversations").select(F.col("conv_id").alias("message"), "turn", F.coalesce("text", F.lit("")).alias("text"))
    later = F.collect_list(F.when(F.col("turn") > 0, F.struct("turn", F.when(F.col("turn") % 2 == 0, "user").otherwise("model").alias("role"), X.strip(F.col("text")).alias("text"))))
    jobs = own.groupBy("message").agg(F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("text"), F.transform(F.array_sort(later), lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("history"))
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (F.col("message") % n + 1).cast("int"))
    options = _text('{"thinkingLevel":"', pick(LEVELS, 5), '","maxOutputTokens":', F.when(F.col("message") % 2 == 0, "0").otherwise("100"), "}")
    images = F.array(F.struct(F.lit("image/png").alias("mime"), F.lit("AA==").alias("data")))
    return jobs.select("message", F.sha2(R.content_request(pick(MODELS, 6), F.lit("do"), F.col("text"), images, F.col("history"), F.lit("be brief"), options), 256).alias("payload"))


@query(f"""WITH {TURNS_SQL} SELECT message, turn, sha256('{{"model":"m","messages":[{{"role":"user","content":[{{"type":"text","text":' || q || '}},{{"type":"image_url","image_url":{{"url":"data:image/png;base64,AA=="' || CASE turn % 3 WHEN 0 THEN '' WHEN 1 THEN ',"detail":"low"' ELSE ',"detail":"high"' END || '}}}}]}}]'
|| CASE turn % 2 WHEN 0 THEN ',"reasoning_effort":"low"' ELSE '' END || CASE WHEN turn > 2 THEN ',"max_tokens":' || turn ELSE '' END || '}}') AS payload FROM t""")
def c16_chat_requests(spark, folder):
    t = F.col("turn")
    images = F.array(F.struct(F.lit("").alias("mime"), F.lit("AA==").alias("data")))
    detail = F.when(t % 3 == 1, "media_resolution_low").when(t % 3 == 2, "media_resolution_ultra_high")
    request = R.chat_request(F.lit("m"), F.array(F.coalesce("text", F.lit(""))), images, detail, F.when(t % 2 == 0, "Minimal "), F.when(t > 2, t).otherwise(0))
    return table(spark, folder, "conversations").select(F.col("conv_id").alias("message"), "turn", F.sha2(request, 256).alias("payload"))


STREAM_SQL = f"{TURNS_SQL}, r AS (SELECT *, CASE WHEN turn = 0 OR (turn % 3 = 1) <> ((turn - 1) % 3 = 1) THEN 1 ELSE 0 END AS fresh FROM t)"


@query(f"""WITH {STREAM_SQL} SELECT message, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (turn % 3 <> 1), '')) AS answer, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (turn % 3 = 1), '')) AS summary, sum(fresh)::INTEGER AS parts,
'"' || arg_max(CASE WHEN turn = n - 1 THEN 'STOP' ELSE 'OTHER' END, turn) || '"' AS reason, string_agg(turn::VARCHAR, ',' ORDER BY turn) FILTER (turn > CASE WHEN n > 4 THEN 4 ELSE -1 END) AS sources, max(turn)::VARCHAR AS usage, count(*) AS chunks FROM r GROUP BY message""")
def q15_streamed_texts(spark, folder):
    """Turns as chunks of one reply: texts and thoughts, a source in each but the fifth, which drops those before it."""
    t = F.col("turn")
    last = F.max("turn").over(Window.partitionBy("conv_id"))
    data = _text(
        '{"candidates":[{"content":{"parts":[{"text":', P.quote(F.coalesce("text", F.lit(""))), F.when(t % 3 == 1, ',"thought":true').otherwise(""), '}]},"finishReason":"', F.when(t == last, "STOP").otherwise("OTHER"),
        '","groundingMetadata":{"groundingChunks":[', F.when(t == 4, "").otherwise(t.cast("string")), ']}}],"usageMetadata":{"totalTokenCount":', t.cast("string"), "}}",
    )
    own = texts.merged(table(spark, folder, "conversations").select(F.col("conv_id").alias("message"), t.alias("chunk"), data.alias("data")))
    usage = F.get_json_object(F.col("reply")["usageMetadata"], "$.totalTokenCount")
    listed = F.nullif(F.array_join("sources", ","), F.lit(""))
    return own.select("message", F.sha2("answer", 256).alias("answer"), F.sha2("summary", 256).alias("summary"), F.size("parts").alias("parts"), F.col("candidate")["finishReason"].alias("reason"), listed.alias("sources"), usage.alias("usage"), "chunks")
