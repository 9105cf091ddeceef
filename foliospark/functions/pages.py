"""Page-level rules: blanks, batch answers, labels, settings, rubrics, mentions, payload parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import holding
from . import text as X

# Fixed value: texts that number a part of a drawing.
SMALL_LABEL = r"^(?:[①-⑳](?:h=[0-9]+)?|[（(][a-zA-Z][)）]|[0-9]{1,2}|[A-Za-z])$"


def is_blank(samples: Column) -> Column:
    """Whether a page's grey values leave it blank: under a thousandth darker than 250 and none darker than 200."""
    ink = F.coalesce(F.try_divide(F.size(F.filter(samples, lambda v: v < 250)), F.size(samples)), F.lit(0.0))
    return (ink < 0.001) & (F.coalesce(F.array_min(samples), F.lit(255)) >= 200)


def batch_answer(text: Column, expected: Column) -> Column:
    """The pages of one answer as (number, body) structs; null where the marks aren't exactly the expected ones in order,
    something stands before the first, or a page is empty or faulty."""
    marks = F.transform(F.regexp_extract_all(text, F.lit(X.LOOSE_MARK), F.lit(1)), lambda n: n.cast("int"))
    parts = F.split(text, X.LOOSE_MARK, -1)
    bodies = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), X.strip)
    ok = (marks == expected) & (X.strip(parts[0]) == "") & ~F.exists(bodies, lambda b: (b == "") | X.fault(b).isNotNull())
    return F.when(ok, F.arrays_zip(marks.alias("number"), bodies.alias("body")))


def small_label(text: Column) -> Column:
    """A label without white space and dollars, if it is one that numbers a part of a drawing."""
    own = F.regexp_replace(text, r"(?U)[\s$]", "")
    return F.when(own.rlike(SMALL_LABEL), own)


def workflow_inputs(inputs: Column) -> Column:
    """Inputs as strings, truth values in lower case; null for more than 25."""
    return F.when(F.size(inputs) <= 25, F.transform_values(inputs, lambda _, v: F.when(F.lower(v).isin("true", "false"), F.lower(v)).otherwise(v)))


def violations(checks: dict[str, Column]) -> Column:
    """Names of the checks that don't hold; null counts as not holding."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


def quality_report(pages: DataFrame, key: str, text: str) -> DataFrame:
    """Structural metrics before and after the layout cleanup, and whether pages and images are as many as before."""
    before, after = X.metrics(F.col(text)), X.metrics(F.col("__clean"))
    own = pages.withColumn("__clean", X.clean_layout(F.col(text)))
    named = [c.alias(f"{side}_{n}") for side, m in (("before", before), ("after", after)) for n, c in m.items() if n != "text_chars"]
    return own.select(key, *named).withColumn("unchanged", (F.col("before_pages") == F.col("after_pages")) & (F.col("before_images") == F.col("after_images")))


def rubric_score(pages: DataFrame, rubric: DataFrame) -> DataFrame:
    """(page, passed, total, failed) from pages (page, text) and rubric (page, anchor, wanted): anchors that a page must or must not hold."""
    texts = pages.select("page", X.score_text(F.col("text")).alias("t"))
    own = rubric.join(texts, "page", "left").withColumn("ok", F.contains(F.coalesce("t", F.lit("")), X.score_text(F.col("anchor"))) == F.col("wanted"))
    return own.groupBy("page").agg(F.count_if("ok").alias("passed"), F.count("*").alias("total"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("anchor")))).alias("failed"))


def mentioned_repositories(tasks: DataFrame, repositories: DataFrame) -> DataFrame:
    """(task, name, score): the best-ranked repositories that a task mentions: by owner/name, by name, by the name's last part.

    tasks: task, text; repositories: name. Names are searched for in all tasks at
    once, in one pass each for whole names and for names without marks; last parts
    meet the tasks' distinct words by key.
    """
    short = F.element_at(F.split("name", "/"), 2)
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    suffix = F.element_at(F.split(F.lower(short), "[-_.]"), -1)
    listed = repositories.filter("name IS NOT NULL").select("name", F.coalesce(short, F.lit("")).alias("short"), F.coalesce(bare(short), F.lit("")).alias("bare"), F.coalesce(suffix, F.lit("")).alias("suffix")).distinct()
    own = tasks.filter("length(text) > 0").select("task", "text")
    lower = own.select(F.struct("task", "text").alias("text_id"), F.lower("text").alias("text"))
    edge = "[A-Za-z0-9_.-]"
    whole = holding(lower, listed.select(F.col("name").alias("anchor_id"), F.lower("name").alias("anchor"))).select("text_id.*", F.col("anchor_id").alias("name"))
    whole = whole.filter(F.expr(f"text RLIKE concat('(?i)(?<!{edge})', '\\\\Q', name, '\\\\E', '(?!{edge})')")).select("task", "name", (1000 + F.length("name")).alias("score"))
    joined = own.select(F.col("task").alias("text_id"), bare(F.col("text")).alias("text"))
    inner = holding(joined, listed.filter("length(bare) >= 4").select(F.struct("name", "short").alias("anchor_id"), F.col("bare").alias("anchor")))
    inner = inner.select(F.col("text_id").alias("task"), F.col("anchor_id.name").alias("name"), (100 + F.length("anchor_id.short")).alias("score"))
    words = own.select("task", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)))).alias("suffix"))
    ends = words.join(listed.filter("length(suffix) >= 4").select("name", "suffix"), "suffix").select("task", "name", (10 + F.length("suffix")).alias("score"))
    best = whole.unionByName(inner).unionByName(ends).groupBy("task", "name").agg(F.max("score").alias("score"))
    w = Window.partitionBy("task").orderBy(F.desc("score"))
    return best.withColumn("r", F.rank().over(w)).filter("r = 1").select("task", "name", "score")


PARTS = """struct<candidates:array<struct<content:struct<parts:array<struct<text:string,thought:boolean,executableCode:struct<id:string,language:string,code:string>,
codeExecutionResult:struct<id:string,outcome:string,output:string>,functionCall:struct<id:string,name:string,args:string>,functionResponse:struct<id:string,name:string,response:string>,
toolCall:struct<id:string,toolType:string,args:string>,toolResponse:struct<id:string,toolType:string,response:string>>>>,groundingMetadata:struct<groundingChunks:array<struct<web:struct<uri:string,title:string>>>>>>>"""


def payload_parts(payloads: DataFrame) -> DataFrame:
    """(message, seq, side, kind, id, type, body) of each part of a model's payload (message, payload), in order.

    side is call or result for tools, so that pairing.pair brings them together.
    """
    parsed = payloads.select("message", F.from_json("payload", PARTS).alias("p"))
    each = parsed.select("message", F.posexplode("p.candidates").alias("ci", "c")).select("message", "ci", F.posexplode("c.content.parts").alias("pi", "t"))
    t = lambda n: F.col(f"t.{n}")
    kinds = (
        ("executableCode", "call", "server_tool", F.lit("code_execution"), t("executableCode.code")),
        ("codeExecutionResult", "result", "server_tool", F.lit("code_execution"), t("codeExecutionResult.output")),
        ("toolCall", "call", "server_tool", t("toolCall.toolType"), t("toolCall.args")),
        ("toolResponse", "result", "server_tool", t("toolResponse.toolType"), t("toolResponse.response")),
        ("functionCall", "call", "tool", t("functionCall.name"), t("functionCall.args")),
        ("functionResponse", "result", "tool", t("functionResponse.name"), t("functionResponse.response")),
    )
    text = F.when(F.coalesce(t("thought"), F.lit(False)), "reasoning").otherwise("text")
    pick = lambda f, first: F.coalesce(first, *[F.when(t(n).isNotNull(), f(n, side, kind, name, body)) for n, side, kind, name, body in kinds])
    said = t("text").isNotNull()
    none = F.lit(None).cast("string")
    return each.select(
        "message", (F.row_number().over(Window.partitionBy("message").orderBy("ci", "pi"))).cast("long").alias("seq"),
        pick(lambda n, side, kind, name, body: F.lit(side), none).alias("side"), pick(lambda n, side, kind, name, body: name, none).alias("kind"),
        pick(lambda n, side, kind, name, body: F.coalesce(t(f"{n}.id"), F.lit("")), none).alias("id"),
        pick(lambda n, side, kind, name, body: F.lit(kind), F.when(said, text)).alias("type"), pick(lambda n, side, kind, name, body: body, t("text")).alias("body"),
    )


def citations(payloads: DataFrame) -> DataFrame:
    """(message, title, url): distinct web sources of a payload; a missing title is the url."""
    parsed = payloads.select("message", F.explode(F.from_json("payload", PARTS)["candidates"]).alias("c"))
    web = parsed.select("message", F.explode("c.groundingMetadata.groundingChunks").alias("g")).select("message", F.trim("g.web.title").alias("title"), F.trim("g.web.uri").alias("url"))
    return web.filter("url <> ''").distinct().select("message", F.coalesce(F.nullif("title", F.lit("")), "url").alias("title"), "url")


def reconciled(streamed: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Parts of a stream, and a snapshot's parts only for streams that sent no indexed step: a snapshot's places may be shifted."""
    return streamed.unionByName(snapshot.join(streamed.select("stream").distinct(), "stream", "left_anti"))


def same_type(batch: DataFrame, saved: DataFrame, key: list[str], kind: str) -> DataFrame:
    """Rows of ``batch`` whose type is that of the first write, which is fixed."""
    first = saved.select(*key, F.col(kind).alias("__kind"))
    return batch.join(first, key, "left").filter(F.col("__kind").isNull() | (F.col("__kind") == F.col(kind))).drop("__kind")


def step_times(events: DataFrame) -> DataFrame:
    """(stream, index, seconds): from the first start to the last stop of each step. events: stream, index, event, at."""
    at = lambda e, f: f(F.when(F.col("event") == e, F.col("at")))
    own = events.groupBy("stream", "index").agg(at("step.start", F.min).alias("a"), at("step.stop", F.max).alias("b"))
    return own.select("stream", "index", (F.col("b") - F.col("a")).alias("seconds"))


def section(text: Column, start: str, end: str) -> Column:
    """What stands between two marks; null without both."""
    after = F.substring_index(text, start, -1)
    return F.when(F.contains(text, F.lit(start)) & F.contains(after, F.lit(end)), F.substring_index(after, end, 1))


def telemetry(event: str, **fields: Column) -> Column:
    """A JSON row of metadata."""
    return F.to_json(F.struct(F.lit(event).alias("event"), *[c.alias(n) for n, c in fields.items()]))
