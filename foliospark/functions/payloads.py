"""Models' payloads as rows: snapshots under a byte budget, parts for display, tool calls, code runs, citations, agents' results.

Two families are read, both as VARIANT: candidates with parts, and interactions
with steps. Each part or step becomes a row in its place; calls and results are
then paired over that one order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import pairing
from ..session import stored
from . import markup as M
from .text import strip

#: Limits of a snapshot: bytes, of which so many are left for what stands around the parts; parts; bytes of a metadata field.
MOST_BYTES, MARGIN, MOST_PARTS, MOST_FIELD = 2 << 20, 4096, 500, 128 << 10
OMITTED = {"omitted": True, "reason": "metadata field exceeds 128 KiB"}
#: What the bounds of single values leave behind.
MARKS = ("[truncated]", "[nested value omitted]", "_captureOmitted")
MOST_REPLY = 2 << 20
CANDIDATES, INTERACTIONS = "generateContent", "interactions"

# A part's keys that hold calls (True) or results, and what a call without a name of its own is called.
TOOL_KEYS = {"functionCall": True, "functionResponse": False, "toolCall": True, "toolResponse": False, "executableCode": True, "codeExecutionResult": False}
DATA_KEYS = ("fileData", "inlineData")
RESPONSE_FIELDS = ("responseId", "modelVersion", "createTime", "promptFeedback", "usageMetadata", "error")
CANDIDATE_FIELDS = ("index", "finishReason", "finishMessage", "safetyRatings", "citationMetadata", "groundingMetadata", "urlContextMetadata", "avgLogprobs", "logprobsResult")
INTERACTION_FIELDS = ("id", "environment_id", "model", "agent", "status", "created", "updated", "usage", "error", "incomplete_details")
USAGE = {
    "total_input_tokens": "promptTokenCount", "total_output_tokens": "candidatesTokenCount", "total_thought_tokens": "thoughtsTokenCount",
    "total_cached_tokens": "cachedContentTokenCount", "total_tokens": "totalTokenCount", "total_tool_use_tokens": "toolUseTokenCount",
}
# What is said of an interaction that didn't complete with a text.
SAID = {
    "incomplete": "Agent 执行未完成，已保留现有回复；请检查上游状态或服务端限制。", "cancelled": "Agent 已取消", "canceled": "Agent 已取消",
    "no text": "Agent 已结束但没有返回正文，可在当前对话发送下一条指令继续。", "empty": "Agent 返回空回复",
    "failed": "Agent 执行失败：", "no detail": "上游未提供详情", "external": "需要外部操作",
}


def get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def is_text(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def text_at(v: Column, path: str) -> Column:
    """A string at a path; null for anything else."""
    return F.when(is_text(get(v, path)), get(v, path, "string"))


def array_at(v: Column, path: str) -> Column:
    return F.coalesce(get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def said(v: Column, *paths: str) -> Column:
    """The first value, as text, that isn't empty."""
    return F.coalesce(*[F.nullif(get(v, p, "string"), F.lit("")) for p in paths], F.lit(""))


def joined_texts(v: Column, path: str, mark: str) -> Column:
    """A text, or the texts of an object or list of objects, joined."""
    own = get(v, path)
    items = F.when(is_object(own), F.array(own)).otherwise(array_at(v, path))
    texts = F.array_compact(F.transform(items, lambda x: text_at(x, "text")))
    return F.coalesce(text_at(v, path), F.array_join(texts, mark))


def _json(v: Column) -> Column:
    return F.to_json(v)


def _fields(v: Column, names: tuple[str, ...], also: dict[str, Column] | None = None) -> Column:
    """The fields that are there, as a JSON object."""
    every = [F.when(get(v, n).isNotNull(), F.concat(F.lit(f'"{n}":'), _json(get(v, n)))) for n in names]
    every += [F.concat(F.lit(f'"{n}":'), c) for n, c in (also or {}).items()]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*every)), ","), F.lit("}"))


def _object(**values: Column) -> Column:
    """A JSON object of JSON values; null ones are left out."""
    every = [F.when(c.isNotNull(), F.concat(F.lit(f'"{n}":'), c)) for n, c in values.items()]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*every)), ","), F.lit("}"))


def quote(text: Column) -> Column:
    """A text as a JSON value; null stays null."""
    return F.when(text.isNotNull(), F.substring(F.to_json(F.array(text)), F.lit(2), F.length(F.to_json(F.array(text))) - 2))


def _candidate_parts(payloads: DataFrame) -> DataFrame:
    """(message, ci, pi, p): parts of candidates."""
    each = payloads.select("message", F.posexplode(array_at(F.try_parse_json("payload"), "candidates")).alias("ci", "c"))
    return each.select("message", "ci", "c", F.posexplode(array_at(F.col("c"), "content.parts")).alias("pi", "p")).drop("c")


def _steps(payloads: DataFrame) -> DataFrame:
    """(message, index, s, kind): steps of interactions, or outputs where there are none."""
    v = F.try_parse_json("payload")
    own = F.when(F.size(array_at(v, "steps")) > 0, array_at(v, "steps")).otherwise(array_at(v, "outputs"))
    rows = payloads.select("message", F.posexplode(own).alias("index", "s")).filter(is_object(F.col("s")))
    return rows.withColumn("kind", F.coalesce(F.nullif(get(F.col("s"), "type", "string"), F.lit("")), F.lit("unknown")))


# Snapshots


def snapshot_parts(payloads: DataFrame, protocol: str) -> DataFrame:
    """(message, place, part): parts as JSON, in order, before any bound but those of their values."""
    if protocol == CANDIDATES:
        p = F.col("p")
        here = F.concat(F.lit("c"), F.col("ci").cast("string"), F.lit("p"), F.col("pi").cast("string"))
        base = lambda suffix="": {"id": quote(F.concat(here, F.lit(suffix))), "candidate": F.col("ci").cast("string")}
        thought = F.coalesce(get(p, "thought", "boolean"), F.lit(False))
        own = [F.when(is_text(get(p, "text")), _object(**base(), type=quote(F.when(thought, "reasoning").otherwise("text")), text=quote(get(p, "text", "string"))))]
        for key, call in TOOL_KEYS.items():
            v = get(p, key)
            name = F.coalesce(F.nullif(said(v, "name", "toolType"), F.lit("")), F.lit("code_execution" if "ode" in key else key))
            made = _object(**base(key), type=F.lit('"tool-call"' if call else '"tool-result"'), name=quote(F.left(name, F.lit(240))), callId=quote(F.left(said(v, "id"), F.lit(256))), data=_json(v))
            own.append(F.when(is_object(v), made))
        for key in DATA_KEYS:
            v = get(p, key)
            what = _object(mimeType=quote(said(v, "mimeType")), uri=quote(said(v, "fileUri")), inline=F.lit("true" if key == "inlineData" else "false"))
            own.append(F.when(is_object(v), _object(**base(key), type=F.lit('"artifact"'), data=what)))
        rows = _candidate_parts(payloads).select("message", "ci", "pi", F.posexplode(F.array_compact(F.array(*own))).alias("n", "part"))
        return _placed(rows, ["ci", "pi", "n"])
    s, kind = F.col("s"), F.col("kind")
    here = F.concat(F.lit("s"), F.col("index").cast("string"))
    base = {"step": F.col("index").cast("string"), "providerType": quote(kind)}
    block = lambda b, i: F.when(
        F.coalesce(get(b, "type", "string") == "text", F.lit(False)), _object(id=quote(F.concat(here, F.lit("p"), i.cast("string"))), **base, type=F.lit('"text"'), text=quote(said(b, "text")))
    ).when(is_object(b), _object(id=quote(F.concat(here, F.lit("p"), i.cast("string"))), **base, type=F.lit('"artifact"'), data=_json(b)))
    blocks = F.when(kind == "model_output", array_at(s, "content")).otherwise(F.array(s))
    tool = lambda what: _object(
        id=quote(here), **base, type=F.lit(f'"tool-{what}"'), name=quote(F.left(F.coalesce(F.nullif(said(s, "name", "tool_name"), F.lit("")), F.regexp_replace(kind, "_[^_]*$", "")), F.lit(240))),
        callId=quote(F.left(said(s, "call_id", "id"), F.lit(256))), data=_without(s, "type"),
    )
    thought = _object(id=quote(here), **base, type=F.lit('"reasoning"'), text=quote(joined_texts(s, "summary", "\n\n")))
    own = (
        F.when(kind == "thought", F.array(thought)).when(kind.isin("model_output", "text"), F.array_compact(F.transform(blocks, block)))
        .when(F.endswith(kind, F.lit("_call")), F.array(tool("call"))).when(F.endswith(kind, F.lit("_result")), F.array(tool("result")))
        .otherwise(F.array(_object(id=quote(here), **base, type=F.lit('"artifact"'), data=_json(s))))
    )
    return _placed(_steps(payloads).select("message", "index", F.posexplode(own).alias("n", "part")), ["index", "n"])


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("message").orderBy(*order)) - 1
    return rows.select("message", place.alias("place"), "part")


def _without(v: Column, *names: str) -> Column:
    """An object without some fields, as JSON."""
    kept = F.map_filter(v.try_cast("map<string,variant>"), lambda k, _: ~k.isin(*names))
    each = F.transform(F.map_entries(kept), lambda e: F.concat(quote(e["key"]), F.lit(":"), F.coalesce(_json(e["value"]), F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(each, ","), F.lit("}"))


SHELL = T.StructType([T.StructField("metadata", T.StringType()), T.StructField("truncated", T.BooleanType()), T.StructField("bytes", T.LongType())])


def _shell(protocol: str):
    """The metadata with too large fields left out, and the bytes of a snapshot without parts."""

    def one(metadata: str | None, total: int):
        own = json.loads(metadata or "{}")
        cut = any(m in json.dumps(own, ensure_ascii=False) for m in MARKS)
        for key, value in own.items():
            if len(json.dumps(value, ensure_ascii=False).encode()) > MOST_FIELD:
                own[key], cut = OMITTED, True
        shell = {"version": 1, "protocol": protocol, "parts": [], "metadata": own, "capture": {"totalParts": total, "omittedParts": 0, "truncated": cut}}
        return {"metadata": json.dumps(own, ensure_ascii=False), "truncated": cut, "bytes": len(json.dumps(shell, ensure_ascii=False).encode())}

    return F.udf(one, SHELL, useArrow=True)


def metadata(payload: Column, protocol: str) -> Column:
    """What a snapshot says of the response as a whole, as JSON."""
    v = F.try_parse_json(payload)
    if protocol == INTERACTIONS:
        return _fields(v, INTERACTION_FIELDS)
    own = F.transform(array_at(v, "candidates"), lambda c: _fields(c, CANDIDATE_FIELDS))
    return _fields(v, RESPONSE_FIELDS, {"candidates": F.concat(F.lit("["), F.array_join(own, ","), F.lit("]"))})


def within(parts: DataFrame, shells: DataFrame, most_parts: int = MOST_PARTS, most_bytes: int = MOST_BYTES - MARGIN) -> DataFrame:
    """(message, place, kept): a running byte budget that starts with the shell and goes on after a part that doesn't fit; smaller ones may.

    parts: message, place, bytes; shells: message, shell_bytes. Messages are dealt to
    tasks, sorted there and read in one go.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, size = None, None
        for batch in batches:
            kept = []
            for message, place, own, shell in zip(*(batch.column(c).to_pylist() for c in ("message", "place", "bytes", "shell_bytes")), strict=True):
                if size is None or message != last:
                    last, size = message, shell
                fits = place < most_parts and size + own + 2 <= most_bytes
                size += own + 2 if fits else 0
                kept.append(fits)
            yield pa.RecordBatch.from_arrays([batch.column("message"), batch.column("place"), pa.array(kept, pa.bool_())], names=["message", "place", "kept"])

    message = parts.schema["message"].dataType.simpleString()
    both = parts.select("message", "place", "bytes").join(shells, "message").select("message", F.col("place").cast("int").alias("place"), "bytes", "shell_bytes")
    return both.repartition("message").sortWithinPartitions("message", "place").mapInArrow(fold, f"message {message}, place int, kept boolean")


def snapshots(payloads: DataFrame, protocol: str, secrets: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(parts, captures) of payloads (message, payload).

    parts: (message, place, part, bytes, kept), with kept false for what the budget
    left out; captures: (message, protocol, metadata, total_parts, omitted_parts,
    truncated), a row for every message, so that nothing is left out unsaid.
    """
    rows = snapshot_parts(payloads, protocol).select("message", "place", M.sanitize(F.col("part"), secrets).alias("part"))
    rows = stored(rows.withColumn("bytes", F.octet_length("part").cast("long")), "parts")  # cleaned once
    counted = rows.groupBy("message").agg(F.count("*").alias("total"))
    known = payloads.join(counted, "message", "left").select("message", _shell(protocol)(M.sanitize(metadata(F.col("payload"), protocol), secrets), F.coalesce("total", F.lit(0)).cast("long")).alias("s"), F.coalesce("total", F.lit(0)).alias("total_parts"))
    kept = within(rows, known.select("message", F.col("s.bytes").alias("shell_bytes")))
    parts = rows.join(kept, ["message", "place"])
    marked = F.exists(F.array(*map(F.lit, MARKS)), lambda m: F.contains("part", m))
    bounds = parts.groupBy("message").agg(F.count_if(~F.col("kept")).alias("omitted"), F.bool_or(marked | ~F.col("kept")).alias("cut"))
    captures = known.join(bounds, "message", "left").select(
        "message", F.lit(protocol).alias("protocol"), F.col("s.metadata").alias("metadata"), "total_parts", F.coalesce("omitted", F.lit(0)).alias("omitted_parts"),
        (F.col("s.truncated") | F.coalesce("cut", F.lit(False))).alias("truncated"),
    )
    return parts, captures


# Parts for display

ROW = "type", "side", "kind", "id", "call_id", "name", "provider", "status", "text", "body", "uri", "inline", "policy"


def _row(**values: Column | str | None) -> Column:
    as_column = lambda c: F.lit(c) if isinstance(c, str) else c
    return F.struct(*[F.coalesce(as_column(values.get(n)), F.lit(None).cast("string")).cast("boolean" if n == "inline" else "string").alias(n) if values.get(n) is not None else F.lit(None).cast("boolean" if n == "inline" else "string").alias(n) for n in ROW])


def _candidate_row() -> Column:
    p = F.col("p")
    here = F.concat(F.lit("c"), F.col("ci").cast("string"), F.lit("p"), F.col("pi").cast("string"), F.lit(":"))

    def tool(key: str, call: bool) -> Column:
        v, client, code = get(p, key), key.startswith("function"), "ode" in key
        name = F.lit("code_execution") if code else F.left(F.coalesce(F.nullif(said(v, "name") if client else said(v, "toolType", "name"), F.lit("")), F.lit("function" if client else "server_tool")), F.lit(120))
        own = F.left(F.coalesce(F.nullif(said(v, "id"), F.lit("")), F.concat(here, name)), F.lit(256))
        outcome = said(v, "outcome")
        if code:
            body = _object(language=quote(F.coalesce(get(v, "language", "string"), F.lit("PYTHON"))), code=quote(said(v, "code"))) if call else _object(outcome=quote(outcome), output=quote(said(v, "output")))
            status = F.lit("in_progress") if call else F.when(outcome.isin("", "OUTCOME_OK"), "completed").otherwise("failed")
        else:
            body = _json(get(v, "args" if call else "response"))
            body = F.when(F.coalesce(body, F.lit("null")).isin("null", '""', "0", "false", "[]"), "{}").otherwise(body) if client else body
            status = F.lit(None).cast("string") if client else F.lit("in_progress" if call else "completed")
        policy = pairing.FIRST_IF_NO_ID if code else pairing.EXACT
        return _row(type="tool" if client else "server_tool", side="call" if call else "result", kind=F.concat(F.lit("client:" if client else "server:"), name), id=said(v, "id"), call_id=own, name=name, provider=key, status=status, body=body, policy=policy)

    order = ("executableCode", "codeExecutionResult", "toolCall", "toolResponse", "functionCall", "functionResponse")
    thought = F.coalesce(get(p, "thought", "boolean"), F.lit(False))
    made = F.when(is_text(get(p, "text")), F.when(thought, _row(type="reasoning", provider="thought", text=get(p, "text", "string"))).otherwise(_row(type="text", text=get(p, "text", "string"))))
    for key in order:
        made = made.when(is_object(get(p, key)), tool(key, TOOL_KEYS[key]))
    for key in ("inlineData", "fileData"):
        mime = said(get(p, key), "mimeType")
        made = made.when(is_object(get(p, key)), _row(type=F.when(F.startswith(mime, F.lit("image/")), "image").otherwise("document"), name=mime, uri=said(get(p, key), "fileUri"), inline=F.lit(key == "inlineData")))
    return made


def _step_rows() -> Column:
    s, kind = F.col("s"), F.col("kind")

    def block(b: Column) -> Column:
        mime = F.coalesce(F.nullif(said(b, "mime_type", "mimeType"), F.lit("")), F.lit("image/png"))
        inline = ~F.coalesce(_json(get(b, "data")), F.lit("null")).isin("null", '""', "false", "0", "[]", "{}")
        return F.when(F.coalesce(get(b, "type", "string") == "text", F.lit(False)) & is_text(get(b, "text")), _row(type="text", text=get(b, "text", "string"))).when(
            F.coalesce(get(b, "type", "string") == "image", F.lit(False)), _row(type="image", name=mime, uri=said(b, "uri"), inline=inline)
        )

    blocks = F.when(kind == "model_output", array_at(s, "content")).otherwise(F.array(s))
    fname = F.left(F.coalesce(F.nullif(said(s, "name"), F.lit("")), F.lit("function")), F.lit(120))
    at = F.concat(F.lit("step-"), F.col("index").cast("string"), F.lit(":"))
    plain = lambda v: F.when(is_text(v), v.try_cast("string")).otherwise(F.when(F.coalesce(_json(v), F.lit("null")).isin("null", "0", "false", "[]"), "{}").otherwise(_json(v)))
    given = F.left(F.coalesce(F.nullif(said(s, "id", "call_id"), F.lit("")), F.concat(at, fname)), F.lit(256))
    answered = F.left(said(s, "call_id", "id"), F.lit(256))
    out = F.coalesce(get(s, "result"), get(s, "output"))
    base = F.regexp_replace(kind, "_(call|result)$", "")
    tname = F.left(F.coalesce(F.nullif(said(s, "server_name", "name", "tool_name"), F.lit("")), base), F.lit(120))
    server_id = F.left(F.coalesce(F.nullif(said(s, "id", "call_id"), F.lit("")), F.concat(at, tname)), F.lit(256))
    body = _without(s, "type", "id", "call_id", "signature")
    wrong = F.coalesce(~F.coalesce(_json(get(s, "is_error")), F.lit("null")).isin("null", "false", "0", '""', "[]", "{}"), F.lit(False)) | F.coalesce(get(s, "exit_code", "long") != 0, F.lit(False))
    status = F.when(wrong, "failed").otherwise("completed")
    kinds = (
        (kind == "thought", F.array(_row(type="reasoning", provider="thought", text=joined_texts(s, "summary", "\n")))),
        (kind.isin("model_output", "text"), F.array_compact(F.transform(blocks, block))),
        (kind == "function_call", F.array(_row(type="tool", side="call", kind="client", id=given, call_id=given, name=fname, provider=kind, body=plain(get(s, "arguments")), policy=pairing.EXACT))),
        (kind == "function_result", F.array(_row(type="tool", side="result", kind="client", id=answered, call_id=F.coalesce(F.nullif(answered, F.lit("")), F.concat(at, F.lit("function"))), name=fname, provider=kind, body=plain(out), policy=pairing.EXACT))),
        (F.endswith(kind, F.lit("_call")), F.array(_row(type="server_tool", side="call", kind=F.concat(F.lit("server:"), base), id=server_id, call_id=server_id, name=tname, provider=kind, status="in_progress", body=body, policy=pairing.FIRST_OF_KIND))),
        (F.endswith(kind, F.lit("_result")), F.array(_row(type="server_tool", side="result", kind=F.concat(F.lit("server:"), base), id=answered, call_id=F.coalesce(F.nullif(answered, F.lit("")), F.concat(at, tname)), name=tname, provider=kind, status=status, body=body, policy=pairing.FIRST_OF_KIND))),
    )
    made = F
    for when, rows in kinds:
        made = made.when(when, rows)
    return made


def raw_parts(payloads: DataFrame, protocol: str) -> DataFrame:
    """(message, seq, ROW...): each part of a payload in its place, results on their own."""
    if protocol == CANDIDATES:
        rows = _candidate_parts(payloads).select("message", "ci", "pi", _candidate_row().alias("r")).filter("r IS NOT NULL")
        order = ["ci", "pi"]
    else:
        rows = _steps(payloads).select("message", "index", F.posexplode(_step_rows()).alias("n", "r"))
        order = ["index", "n"]
    seq = F.row_number().over(Window.partitionBy("message").orderBy(*order))
    return rows.select("message", seq.cast("long").alias("seq"), "r.*")


def display_parts(payloads: DataFrame, protocol: str, secrets: list[str] | None = None) -> DataFrame:
    """(message, sequence, type, tool_call_id, tool_name, status, input, output, provider, text, mime, uri, inline, result_seq).

    A result goes into the row of its call; one without a call is a row of its own,
    in its place. Inputs and outputs are JSON, bounded and without credentials. The
    payloads are read once; their parts go to the shared folder.
    """
    rows = stored(raw_parts(payloads, protocol), "parts")
    tools = rows.filter("side IS NOT NULL").select("message", "seq", "side", "kind", "id", "policy")
    pairs = pairing.pair(tools, None, replaced=True)
    matched = pairs.filter("call IS NOT NULL AND result IS NOT NULL").select("message", "call", "result")
    results = rows.filter("side = 'result'").select("message", F.col("seq").alias("result"), F.col("body").alias("__out"), F.col("status").alias("__status"))
    answered = matched.join(results, ["message", "result"]).withColumnRenamed("call", "seq")
    alone = rows.join(matched.select("message", F.col("result").alias("seq")), ["message", "seq"], "left_anti")
    whole = alone.join(answered, ["message", "seq"], "left")
    is_result, is_call, client = F.col("side") == "result", F.col("side") == "call", F.col("type") == "tool"
    given = F.when(is_call, F.col("body")).when(is_result & client, "{}")
    got = F.when(is_result, F.col("body")).otherwise(F.col("__out"))
    status = F.when(client, F.when(got.isNotNull(), "completed").otherwise("in_progress")).otherwise(F.coalesce("__status", "status"))
    number = F.row_number().over(Window.partitionBy("message").orderBy("seq"))
    clean = lambda c: M.sanitize(c, secrets)
    return whole.select(
        "message", number.cast("long").alias("sequence"), "type", F.when(F.col("side").isNotNull(), F.col("call_id")).alias("tool_call_id"), F.when(F.col("side").isNotNull(), F.col("name")).alias("tool_name"),
        F.when(F.col("side").isNotNull(), status).alias("status"), clean(given).alias("input"), clean(got).alias("output"), "provider", F.from_json(F.concat(F.lit("["), clean(quote(F.col("text"))), F.lit("]")), "array<string>")[0].alias("text"),
        F.when(F.col("type").isin("image", "document"), F.col("name")).alias("mime"), "uri", "inline", F.when(is_result, F.col("seq")).otherwise(F.col("result")).alias("result_seq"),
    )


def tool_calls(parts: DataFrame) -> DataFrame:
    """(message, sequence, call_id, tool_name, kind, status, input, output, provider) of display_parts' rows."""
    own = parts.filter(F.col("type").isin("tool", "server_tool"))
    kind = F.when(F.col("type") == "tool", "client").otherwise("server")
    return own.select("message", "sequence", F.col("tool_call_id").alias("call_id"), "tool_name", kind.alias("kind"), "status", "input", "output", "provider")


def code_executions(parts: DataFrame) -> DataFrame:
    """(message, place, call_id, language, code, outcome, output, stdout, stderr, exit_code, status) of ended runs, in the order of their results."""
    own = parts.filter((F.col("type") == "server_tool") & F.col("result_seq").isNotNull() & ((F.col("tool_name") == "code_execution") | F.col("provider").isin("code_execution_call", "code_execution_result")))
    given, got = F.try_parse_json("input"), F.try_parse_json("output")
    place = F.row_number().over(Window.partitionBy("message").orderBy("result_seq"))
    code = F.when(is_object(get(given, "arguments")), said(given, "code", "command", "arguments.code")).otherwise(said(given, "code", "command"))
    return own.select(
        "message", place.alias("place"), F.col("tool_call_id").alias("call_id"), F.coalesce(F.nullif(said(given, "language"), F.lit("")), F.lit("PYTHON")).alias("language"), F.when(F.col("input").isNull(), "").otherwise(code).alias("code"),
        said(got, "outcome").alias("outcome"), said(got, "output", "result").alias("output"), said(got, "stdout").alias("stdout"), said(got, "stderr").alias("stderr"), get(got, "exit_code", "long").alias("exit_code"), "status",
    )


def annotations(payloads: DataFrame, protocol: str) -> DataFrame:
    """(message, place, title, url): cited sources in order, each (title, url) once; a missing title is the url."""
    cite = lambda title, url: F.struct(title.alias("title"), url.alias("url"))
    if protocol == CANDIDATES:
        each = payloads.select("message", F.posexplode(array_at(F.try_parse_json("payload"), "candidates")).alias("a", "c"))
        c = F.col("c")
        web = F.transform(array_at(c, "groundingMetadata.groundingChunks"), lambda x: cite(said(x, "web.title"), said(x, "web.uri")))
        read = F.transform(array_at(c, "urlContextMetadata.urlMetadata"), lambda x: cite(said(x, "retrievedUrl"), said(x, "retrievedUrl")))
        cited = F.transform(array_at(c, "citationMetadata.citationSources"), lambda x: cite(said(x, "title", "uri"), said(x, "uri")))
        rows = each.select("message", "a", F.posexplode(F.concat(web, read, cited)).alias("b", "s"))
    else:
        own = _steps(payloads).filter(F.col("kind").isin("model_output", "text"))
        blocks = F.when(F.col("kind") == "model_output", array_at(F.col("s"), "content")).otherwise(F.array("s"))
        listed = F.flatten(F.transform(blocks, lambda b: F.transform(array_at(b, "annotations"), lambda x: cite(said(x, "title"), said(x, "url")))))
        rows = own.select("message", F.col("index").alias("a"), F.posexplode(listed).alias("b", "s"))
    named = rows.select("message", F.struct("a", "b").alias("at"), strip(F.col("s.title")).alias("title"), strip(F.col("s.url")).alias("url")).filter("url <> ''")
    first = named.groupBy("message", "title", "url").agg(F.min("at").alias("at"))
    place = F.row_number().over(Window.partitionBy("message").orderBy("at"))
    return first.select("message", place.alias("place"), F.coalesce(F.nullif("title", F.lit("")), "url").alias("title"), "url")


# Models' and agents' results

# Counters that a reply may have, and what is said of one that didn't end with a text.
COUNTERS = ("promptTokenCount", "candidatesTokenCount", "totalTokenCount", "thoughtsTokenCount", "cachedContentTokenCount", "toolUsePromptTokenCount", "toolUseTokenCount")
CUT, NOT_ENDED, NO_TEXT = "回复达到输出上限，已保留不完整正文；可提高输出上限后重新提交。", ("Gemini 未正常完成回复（", "）"), "Gemini 返回空回复"


def answer_results(payloads: DataFrame) -> DataFrame:
    """(message, reply, error, finish_reason, usage) of replies with candidates: the first one's texts, its thoughts apart, a line feed between them.

    error is what is to be said of an end that wasn't a proper one; the reply and the
    usage are there all the same. Counters are whole numbers of at least 0; those of
    a tool's prompt count as a tool's use.
    """
    v = F.try_parse_json("payload")
    c = F.get(array_at(v, "candidates"), 0)
    parts = F.filter(array_at(c, "content.parts"), lambda p: is_text(get(p, "text")) & ~F.coalesce(get(p, "thought", "boolean"), F.lit(False)))
    reply = F.array_join(F.transform(parts, lambda p: get(p, "text", "string")), "\n")
    reason = F.left(F.coalesce(get(c, "finishReason", "string"), F.lit("")), F.lit(64))
    stopped = F.coalesce(get(v, "promptFeedback.blockReason", "string"), F.lit("")) != ""
    own = payloads.select("message", reply.alias("reply"), reason.alias("finish_reason"), stopped.alias("stopped"), v.alias("v"))
    error = (
        F.when(F.col("finish_reason") == "MAX_TOKENS", CUT)
        .when(F.col("stopped") | ~F.col("finish_reason").isin("", "STOP"), F.concat(F.lit(NOT_ENDED[0]), F.coalesce(F.nullif("finish_reason", F.lit("")), F.lit("PROMPT_BLOCKED")), F.lit(NOT_ENDED[1])))
        .when(strip(F.col("reply")) == "", NO_TEXT).otherwise("")
    )
    count = lambda n: F.when(F.schema_of_variant(get(F.col("v"), f"usageMetadata.{n}")) == "BIGINT", get(F.col("v"), f"usageMetadata.{n}", "long"))
    of = {n: count(n) for n in COUNTERS}
    prompt = of["toolUsePromptTokenCount"]
    of["toolUseTokenCount"] = F.when(prompt >= 0, prompt).otherwise(of["toolUseTokenCount"])
    usage = F.map_filter(F.create_map(*[x for n, k in of.items() for x in (F.lit(n), k)]), lambda _, n: n >= 0)
    checked = F.when(F.octet_length("reply") > MOST_REPLY, F.raise_error(F.lit("a reply exceeds 2 MiB")).cast("string")).otherwise(F.col("reply"))
    return own.select("message", checked.alias("reply"), error.alias("error"), "finish_reason", usage.alias("usage"))


def interaction_results(payloads: DataFrame) -> DataFrame:
    """(message, reply, error, finish_reason, usage, tool_calls, step_count) of interactions (message, payload).

    reply is the text that the agent returned, or those of its output steps; error
    what is to be said of any end but a completed one with a text; usage a map of
    counters that are there and not negative; tool_calls counts calls by kind.
    """
    v = F.try_parse_json("payload")
    steps, outputs = array_at(v, "steps"), array_at(v, "outputs")
    of_type = lambda xs, kind: F.filter(xs, lambda x: F.coalesce(get(x, "type", "string") == kind, F.lit(False)))
    texts = lambda xs: F.array_compact(F.transform(of_type(xs, "text"), lambda x: text_at(x, "text")))
    filled = lambda c: strip(c) != ""
    said_once = F.coalesce(text_at(v, "output_text"), F.lit(""))
    by_steps = F.array_join(F.flatten(F.transform(of_type(steps, "model_output"), lambda s: texts(array_at(s, "content")))), "\n\n")
    reply = F.when(filled(said_once), said_once).when(filled(by_steps), by_steps).when(F.size(outputs) > 0, F.array_join(texts(outputs), "\n")).otherwise(by_steps)
    own = payloads.select("message", "payload", reply.alias("reply"))
    status = F.coalesce(get(v, "status", "string"), F.lit(""))
    detail = F.left(F.coalesce(F.when(is_object(get(v, "error")), said(v, "error.message")).otherwise(get(v, "error", "string")), F.lit("")), F.lit(1000))
    missing = F.when(status == "requires_action", SAID["external"]).otherwise(SAID["no detail"])
    error = (
        F.when(status == "incomplete", SAID["incomplete"]).when(status.isin("failed", "requires_action"), F.concat(F.lit(SAID["failed"]), F.coalesce(F.nullif(detail, F.lit("")), missing)))
        .when(status.isin("cancelled", "canceled"), SAID["cancelled"]).when(~filled(F.col("reply")), F.when(status == "completed", SAID["no text"]).otherwise(SAID["empty"])).otherwise("")
    )
    count = lambda n: F.when(F.schema_of_variant(get(v, f"usage.{n}")) == "BIGINT", get(v, f"usage.{n}", "long"))
    usage = F.map_filter(F.create_map(*[x for n, target in USAGE.items() for x in (F.lit(target), count(n))]), lambda _, n: n >= 0)
    all_steps = F.when(F.size(steps) > 0, steps).otherwise(outputs)
    kinds = F.filter(F.transform(all_steps, lambda s: F.coalesce(text_at(s, "type"), F.lit(""))), lambda k: F.endswith(k, F.lit("_call")) & (F.length(k) <= 80))
    calls = F.map_from_entries(F.transform(F.array_distinct(kinds), lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)).cast("long"))))
    checked = F.when(F.octet_length("reply") > MOST_REPLY, F.raise_error(F.lit("a reply exceeds 2 MiB")).cast("string")).otherwise(F.col("reply"))
    return own.select("message", checked.alias("reply"), error.alias("error"), F.left(F.upper(status), F.lit(64)).alias("finish_reason"), usage.alias("usage"), calls.alias("tool_calls"), F.size(all_steps).cast("long").alias("step_count"))
