"""Request payloads by model family, as JSON text built in columns.

jobs: model, prompt, system, history (an array of role and text), options (a JSON
text), and input, images (an array of mime and data, base64). Texts lose their
image list first; empty ones are left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import classify as C
from . import text as X
from .payloads import _object, get, is_object, quote

DEFAULT_TOKENS = 8192
# Thinking budgets of the family that takes budgets, and the least of its larger models.
BUDGETS, LEAST_BUDGET = {"off": 0, "minimal": 0, "low": 4096, "medium": 8192, "high": 24576}, 128
BUDGET_FAMILY, PLAIN_FAMILIES, SUMMARY_FAMILIES = r"^gemini-2\.5", r"^gemini-(?:1\.5|2\.0)", r"^gemini-[34]"
LEVELS = ("minimal", "low", "medium", "high")
AGENT_TOOLS = ("code_execution", "google_search", "url_context")


def _array(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _filled(c: Column) -> Column:
    """A text without its image list; null if nothing is left."""
    return F.nullif(X.without_image_list(c), F.lit(""))


def thinking(model: Column, level: Column) -> Column:
    """The thinking configuration of a model family for a level, as JSON; null where none is sent."""
    m, value = F.lower(model), C.alias(X.strip(F.lower(F.coalesce(level, F.lit("")))), C.THINKING)
    summaries = F.lit('{"includeThoughts":true}')
    budget = F.create_map(*[F.lit(x) for kv in BUDGETS.items() for x in kv])[value]
    least = F.when((budget == 0) & F.contains(m, F.lit("pro")), LEAST_BUDGET).otherwise(budget)
    with_budget = F.when(least == 0, '{"thinkingBudget":0}').otherwise(F.concat(F.lit('{"thinkingBudget":'), least.cast("string"), F.lit(',"includeThoughts":true}')))
    of_level = F.concat(F.lit('{"thinkingLevel":"'), value, F.lit('","includeThoughts":true}'))
    return (
        F.when(m.rlike(BUDGET_FAMILY), F.when(budget.isNotNull(), with_budget).when(value.isin("", "auto"), summaries))
        .when(m.rlike(PLAIN_FAMILIES) & ~F.contains(m, F.lit("thinking")), None).when(value == "off", None).when(value.isin(*LEVELS), of_level)
        .when(m.rlike(SUMMARY_FAMILIES), summaries)
    )


def _images(c: Column, shape) -> Column:
    return F.transform(F.coalesce(c, F.array().cast("array<struct<mime:string,data:string>>")), shape)


def content_request(model: Column, prompt: Column, text: Column, images: Column, history: Column, system: Column, options: Column) -> Column:
    """The payload of a family that takes contents and a generation configuration."""
    o = F.try_parse_json(options)
    said = F.transform(F.array_compact(F.array(_filled(prompt), _filled(text))), lambda t: _object(text=quote(t)))
    shown = _images(images, lambda i: _object(inlineData=_object(mimeType=quote(i["mime"]), data=quote(i["data"]))))
    turns = F.transform(F.coalesce(history, F.array().cast("array<struct<role:string,text:string>>")), lambda t: _object(role=quote(t["role"]), parts=_array(F.array(_object(text=quote(X.without_image_list(t["text"])))))))
    tokens = F.coalesce(F.nullif(get(o, "maxOutputTokens", "long"), F.lit(0)), F.lit(DEFAULT_TOKENS))
    schema, json_schema = get(o, "responseSchema"), get(o, "responseJsonSchema")
    config = _object(
        thinkingConfig=thinking(model, get(o, "thinkingLevel", "string")), maxOutputTokens=F.when(tokens > 0, tokens.cast("string")), responseMimeType=quote(F.nullif(get(o, "responseMimeType", "string"), F.lit(""))),
        responseSchema=F.when(is_object(schema), F.to_json(schema)), responseJsonSchema=F.when(is_object(json_schema) & ~is_object(schema), F.to_json(json_schema)),
    )
    tools = get(o, "tools", "array<variant>")
    return _object(
        contents=_array(F.concat(turns, F.array(_object(role=F.lit('"user"'), parts=_array(F.concat(said, shown)))))), generationConfig=config,
        tools=F.when(F.size(tools) > 0, _array(F.transform(tools, lambda t: F.to_json(t)))), systemInstruction=F.when(system != "", _object(parts=_array(F.array(_object(text=quote(system)))))),
    )


def chat_request(model: Column, texts: Column, images: Column, detail: Column, effort: Column, tokens: Column) -> Column:
    """The payload of a chat family: texts, then images as data URLs with a detail, an effort and a limit where they are set."""
    said = F.transform(texts, lambda t: _object(type=F.lit('"text"'), text=quote(t)))
    level = C.image_detail(detail)
    url = lambda i: F.concat(F.lit("data:"), F.coalesce(F.nullif(i["mime"], F.lit("")), F.lit("image/png")), F.lit(";base64,"), F.coalesce(i["data"], F.lit("")))
    shown = _images(images, lambda i: _object(type=F.lit('"image_url"'), image_url=_object(url=quote(url(i)), detail=F.when(level.isNotNull(), quote(level)))))
    own = C.alias(F.nullif(X.strip(F.lower(F.coalesce(effort, F.lit("")))), F.lit("")), C.EFFORT)
    message = _object(role=F.lit('"user"'), content=_array(F.concat(said, shown)))
    return _object(model=quote(model), messages=_array(F.array(message)), reasoning_effort=quote(own), max_tokens=F.when(tokens > 0, tokens.cast("string")))


def agent_request(agent: Column, model: Column, prompt: Column, text: Column, images: Column, history: Column, system: Column, environment: Column, previous: Column) -> Column:
    """The payload of an agent: a text of history, prompt and input, or a list where images come with it; history only without an earlier interaction, a new environment unless one is reused."""
    earlier, reused = F.nullif(X.strip(F.coalesce(previous, F.lit(""))), F.lit("")), F.nullif(X.strip(F.coalesce(environment, F.lit(""))), F.lit(""))
    turns = F.transform(F.coalesce(history, F.array().cast("array<struct<role:string,text:string>>")), lambda t: F.concat(t["role"], F.lit(": "), X.without_image_list(t["text"])))
    said = F.concat(F.when(earlier.isNull(), turns).otherwise(F.array().cast("array<string>")), F.array_compact(F.array(_filled(prompt), _filled(text))))
    whole = F.array_join(F.filter(said, lambda t: t != ""), "\n\n")
    shown = _images(images, lambda i: _object(type=F.lit('"image"'), mime_type=quote(i["mime"]), data=quote(i["data"])))
    listed = F.concat(F.array_compact(F.array(F.when(whole != "", _object(type=F.lit('"text"'), text=quote(whole))))), shown)
    return _object(
        agent=quote(agent), input=F.when(F.size(shown) > 0, _array(listed)).otherwise(quote(whole)), background=F.lit("true"), store=F.lit("true"),
        environment=F.coalesce(quote(reused), F.lit('{"type":"remote"}')), tools=F.lit("[" + ",".join(f'{{"type":"{t}"}}' for t in AGENT_TOOLS) + "]"),
        agent_config=_object(type=quote(agent), model=quote(model)), previous_interaction_id=quote(earlier), system_instruction=F.when(system != "", quote(system)),
    )
