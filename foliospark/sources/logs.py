"""Scans of page plans, JSON lines, catalogs, spool files and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

ID = r"^[a-zA-Z0-9][a-zA-Z0-9._-]{0,109}$"


def page_plan(documents: DataFrame) -> DataFrame:
    """One row a page: documents (doc, total, first, last; the ends may be null) over their range; an impossible range is an error."""
    first, last = F.coalesce("first", F.lit(1)), F.coalesce("last", "total")
    ok = (first >= 1) & (first <= last) & (last <= F.col("total"))
    checked = F.when(ok, F.sequence(first, last)).otherwise(F.raise_error(F.concat(F.lit("page range outside the document: "), F.col("doc").cast("string"))).cast("array<int>"))
    width = F.greatest(F.lit(3), F.length(F.col("total").cast("string")))
    return documents.select("doc", "total", F.explode(checked).alias("number")).withColumn("stem", F.lpad(F.col("number").cast("string"), width, "0"))


def ocr_pages(lines: DataFrame, first: str = "first") -> DataFrame:
    """(doc, number, markdown, images) from JSON lines (doc, line, value, first): blank lines skipped, arrays flattened over the lines in order."""
    schema = "struct<result:struct<layoutParsingResults:array<struct<markdown:struct<text:string,images:map<string,string>>>>>>"
    parsed = lines.filter(F.trim("value") != "").select("doc", "line", first, F.from_json("value", schema).alias("j"))
    rows = parsed.select("doc", "line", first, F.posexplode("j.result.layoutParsingResults").alias("pos", "r"))
    nth = F.row_number().over(Window.partitionBy("doc").orderBy("line", "pos"))
    return rows.select("doc", (F.col(first) + nth - 1).cast("long").alias("number"), F.col("r.markdown.text").alias("markdown"), F.col("r.markdown.images").alias("images"))


def catalog(pages: DataFrame) -> DataFrame:
    """Models of a paged catalog (page, pos, name, displayName, description, inputTokenLimit): valid ids, the last row of an id wins, in the order of id."""
    identifier = F.regexp_replace("name", "^models/", "")
    own = pages.withColumn("id", identifier).filter(F.col("id").rlike(ID))
    w = Window.partitionBy("id").orderBy(F.desc("page"), F.desc("pos"))
    last = own.withColumn("__r", F.row_number().over(w)).filter("__r = 1")
    shown = F.left(F.coalesce(F.nullif("displayName", F.lit("")), "id"), F.lit(128))
    return last.select("id", shown.alias("displayName"), F.left(F.coalesce("description", F.lit("")), F.lit(2000)).alias("description"), F.coalesce("inputTokenLimit", F.lit(0)).alias("inputTokenLimit")).orderBy("id")


def spool(files: DataFrame) -> DataFrame:
    """Spool files (path, value) with valid ids, progress before final ones, by name."""
    name = F.element_at(F.split("path", "/"), -1)
    own = files.withColumn("name", name).withColumn("id", F.regexp_extract("name", r"^([a-z0-9]{15})(?:\.progress)?\.json$", 1)).filter("id <> ''")
    return own.withColumn("progress", F.endswith("name", F.lit(".progress.json"))).orderBy(F.desc("progress"), "name")


def run_log(lines: DataFrame) -> DataFrame:
    """Time, state and seconds of the [done] lines of a run's log (value)."""
    pattern = r"^(\S+) .*\[done\] (\S+) .*?([0-9.]+)s"
    part = lambda i: F.regexp_extract("value", pattern, i)
    return lines.filter(F.col("value").rlike(pattern)).select(part(1).alias("at"), part(2).alias("chunk"), part(3).cast("double").alias("seconds"))


def retry_after(header: Column, body: Column, now: Column | None = None) -> Column:
    """The longest wait that a header, in seconds or as a date, and the body's retry delays ask for."""
    delays = F.transform(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r'"retryDelay"\s*:\s*"\s*(\d+(?:\.\d+)?)s\s*"'), F.lit(1)), lambda x: x.cast("double"))
    day = F.regexp_extract(header, r"^\s*\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT\s*$", 1)
    date = F.try_to_timestamp(F.concat(day, F.lit(" +0000")), F.lit("dd MMM yyyy HH:mm:ss xx"))
    left = (F.unix_micros(date) - F.unix_micros(F.current_timestamp() if now is None else now)) / 1e6
    seconds = F.coalesce(header.try_cast("double"), left)
    own = F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), seconds))
    return F.array_max(F.array_compact(F.concat(delays, F.array(own))))


CANDIDATES = "struct<candidates:array<struct<finishReason:string,content:struct<parts:array<struct<text:string,thought:boolean>>>>>>"
CHAT = "struct<choices:array<struct<finish_reason:string,message:struct<content:variant,refusal:string>>>>"
# Finish reasons that refuse a page.
BLOCKED = ("RECITATION", "SAFETY", "PROHIBITED_CONTENT", "BLOCKLIST", "SPII", "IMAGE_SAFETY", "LANGUAGE", "CONTENT_FILTER")


def first_candidate(payload: Column) -> Column:
    return F.get(F.from_json(payload, CANDIDATES)["candidates"], 0)


def answer(payload: Column) -> Column:
    """The text of a model's answer: not its thoughts, parts joined by a line feed."""
    parts = F.filter(first_candidate(payload)["content"]["parts"], lambda p: p["text"].isNotNull() & ~F.coalesce(p["thought"], F.lit(False)))
    return F.array_join(F.transform(parts, lambda p: p["text"]), "\n")


def answer_state(payload: Column) -> Column:
    """truncated, blocked, empty or ok; an unfinished or refused answer is none, whatever text it has."""
    reason = first_candidate(payload)["finishReason"]
    return F.when(reason == "MAX_TOKENS", "truncated").when(reason.isin(*BLOCKED), "blocked").when(F.coalesce(F.trim(answer(payload)), F.lit("")) == "", "empty").otherwise("ok")


def fast_reply(payload: Column) -> Column:
    """The stripped answer of a reply that ended by itself; the empty text for any other."""
    ended = F.coalesce(first_candidate(payload)["finishReason"], F.lit("")).isin("", "STOP")
    return F.when(ended, X.strip(F.coalesce(answer(payload), F.lit("")))).otherwise("")


def chat_answer(payload: Column) -> Column:
    """(state, text) of a chat reply whose choices hold a text or a list of items: blocked before truncated before empty; text only where it is ok."""
    choices = F.coalesce(F.from_json(payload, CHAT)["choices"], F.array().cast(CHAT[len("struct<choices:") : -1]))

    def texts(choice: Column) -> Column:
        content = choice["message"]["content"]
        plain = F.try_variant_get(content, "$", "string")
        item = lambda v: F.when(F.coalesce(F.try_variant_get(v, "$.type", "string"), F.lit("text")) == "text", F.nullif(F.try_variant_get(v, "$.text", "string"), F.lit("")))
        return F.when(F.schema_of_variant(content) == "STRING", F.array(F.when(X.strip(plain) != "", plain))).otherwise(F.coalesce(F.transform(F.try_variant_get(content, "$", "array<variant>"), item), F.array().cast("array<string>")))

    reason = lambda c: F.upper(F.coalesce(c["finish_reason"], F.lit("")))
    refused = F.exists(choices, lambda c: (F.coalesce(c["message"]["refusal"], F.lit("")) != "") | reason(c).isin(*BLOCKED))
    cut = F.exists(choices, lambda c: reason(c) == "LENGTH")
    text = X.strip(F.array_join(F.flatten(F.transform(choices, texts)), "\n"))
    state = F.when(refused, "blocked").when(cut, "truncated").when(text == "", "empty").otherwise("ok")
    return F.struct(state.alias("state"), F.when(state == "ok", text).alias("text"))


def record(table: DataFrame, key: str, value: object, fields: list[str]) -> DataFrame:
    """Fields of the record with this key; the condition and the columns reach the scan."""
    return table.filter(F.col(key) == F.lit(value)).select(*fields)
