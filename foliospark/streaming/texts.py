"""A model's streamed reply, merged from its chunks: texts appended, metadata replaced, sources gathered.

A chunk adds parts: adjacent texts of one kind (said or thought) become one, any
other part stands alone. Of the candidate's metadata the last value of a field
wins; its grounding is merged field by field, and the sources in it are appended.
Of the reply as a whole the last value of a field wins. A reply of over 2 MiB, or
a thought of so many, is an error.

``merged`` reads finished replies with windows and aggregates; ``merge_stream``
keeps a reply's state by message and gives what it is so far.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.payloads import array_at, get, is_object, text_at

MOST_BYTES = 2 << 20
# A candidate's fields that are kept, and the reply's.
CANDIDATE = ("index", "finishReason", "finishMessage", "safetyRatings", "citationMetadata", "urlContextMetadata", "avgLogprobs", "logprobsResult")
REPLY = ("responseId", "modelVersion", "createTime", "promptFeedback", "usageMetadata", "error")
GROUNDING, SOURCES = "groundingMetadata", "groundingChunks"
MERGED = "message {0}, answer string, summary string, parts array<string>, candidate map<string,string>, grounding map<string,string>, sources array<string>, reply map<string,string>, chunks long"


def _present(v: Column, path: str) -> Column:
    own = F.to_json(get(v, path))
    return F.when(own != "null", own)


def _last(v: Column, names: tuple[str, ...]) -> list[Column]:
    return [F.max_by(_present(v, n), F.when(_present(v, n).isNotNull(), F.col("chunk"))).alias(f"__{n}") for n in names]


def _map(names: tuple[str, ...]) -> Column:
    return F.map_filter(F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"__{n}"))]), lambda _, v: v.isNotNull())


def merged(chunks: DataFrame) -> DataFrame:
    """MERGED rows of finished replies (message, chunk, data): chunk numbers a reply's JSON pieces. A reply is bounded by its 2 MiB."""
    rows = chunks.select("message", "chunk", F.try_parse_json("data").alias("v")).filter(is_object(F.col("v")))
    c = F.get(array_at(F.col("v"), "candidates"), 0)
    rows = rows.withColumn("c", c)
    parts = rows.select("message", "chunk", F.posexplode(array_at(F.col("c"), "content.parts")).alias("at", "p")).filter(is_object(F.col("p")))
    said = text_at(F.col("p"), "text")
    kind = F.when(said.isNull(), "other").when(F.coalesce(get(F.col("p"), "thought", "boolean"), F.lit(False)), "thought").otherwise("text")
    order = Window.partitionBy("message").orderBy("chunk", "at")
    typed = parts.select("message", "chunk", "at", kind.alias("kind"), said.alias("text"), F.to_json("p").alias("part"))
    new = (F.col("kind") == "other") | ~F.col("kind").eqNullSafe(F.lag("kind").over(order))
    runs = typed.withColumn("run", F.sum(new.cast("int")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "at", "text", "part")))
    joined = F.array_join(F.transform(F.col("o"), lambda x: x["text"]), "")
    whole = runs.groupBy("message", "run", "kind").agg(ordered.alias("o")).select("message", "run", "kind", F.when(F.col("kind") == "other", F.col("o")[0]["part"]).otherwise(joined).alias("body"))
    listed = F.array_sort(F.collect_list(F.struct("run", "kind", "body")))
    texts = lambda k: F.array_join(F.transform(F.filter("l", lambda x: x["kind"] == k), lambda x: x["body"]), "")
    as_part = lambda x: F.when(x["kind"] == "other", x["body"]).otherwise(F.to_json(F.struct(F.when(x["kind"] == "thought", F.lit(True)).alias("thought"), x["body"].alias("text"))))
    said_all = whole.groupBy("message").agg(listed.alias("l")).select("message", _bounded(texts("text")).alias("answer"), _bounded(texts("thought")).alias("summary"), F.transform("l", as_part).alias("parts"))

    g = get(F.col("c"), GROUNDING)
    held = rows.select("message", "chunk", "c", "v", F.when(F.to_json(g) != "null", g).alias("g"))
    listed_sources = array_at(F.col("g"), SOURCES)
    has = _present(F.col("g"), SOURCES).isNotNull()
    resets = F.col("g").isNotNull() & (~is_object(F.col("g")) | (has & (F.size(listed_sources) == 0)))
    since = F.max(F.when(resets, F.col("chunk"))).over(Window.partitionBy("message"))
    fields = F.when(is_object(F.col("g")), F.transform_values(F.col("g").try_cast("map<string,variant>"), lambda _, x: F.to_json(x)))
    held = held.withColumn("__since", since)
    scalar = F.max(F.when(F.col("g").isNotNull() & ~is_object(F.col("g")), F.col("chunk"))).over(Window.partitionBy("message"))
    held = held.withColumn("__scalar", scalar)
    grounding = (
        held.filter(F.col("chunk") > F.coalesce("__scalar", F.lit(-1))).select("message", "chunk", F.explode(fields).alias("k", "x")).filter(F.col("k") != SOURCES)
        .groupBy("message", "k").agg(F.max_by("x", "chunk").alias("x")).groupBy("message").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "x")))).alias("grounding"))
    )
    sources = held.filter((F.col("chunk") > F.coalesce("__since", F.lit(-1))) & has).groupBy("message").agg(F.array_sort(F.collect_list(F.struct("chunk", F.transform(listed_sources, lambda x: F.to_json(x)).alias("s")))).alias("o"))
    sources = sources.select("message", F.flatten(F.transform("o", lambda x: x["s"])).alias("sources"))
    facts = rows.groupBy("message").agg(F.count("*").alias("chunks"), *_last(F.col("c"), CANDIDATE), *_last(F.col("v"), REPLY))
    facts = facts.select("message", "chunks", _map(CANDIDATE).alias("candidate"), _map(REPLY).alias("reply"))
    empty = {"answer": F.lit(""), "summary": F.lit(""), "parts": F.array().cast("array<string>"), "grounding": F.create_map().cast("map<string,string>"), "sources": F.array().cast("array<string>")}
    own = facts.join(said_all, "message", "left").join(grounding, "message", "left").join(sources, "message", "left")
    fill = lambda n: F.coalesce(F.col(n), empty[n]).alias(n)
    return own.select("message", fill("answer"), fill("summary"), fill("parts"), "candidate", fill("grounding"), fill("sources"), "reply", "chunks")


def _bounded(text: Column) -> Column:
    return F.when(F.octet_length(text) > MOST_BYTES, F.raise_error(F.lit("a streamed reply exceeds 2 MiB")).cast("string")).otherwise(text)


class Reply:
    """The state of one reply as plain data."""

    def __init__(self, saved: str | None = None):
        own = json.loads(saved) if saved else {}
        self.parts, self.candidate, self.grounding, self.sources, self.reply, self.chunks = (own.get(k, d) for k, d in (("parts", []), ("candidate", {}), ("grounding", {}), ("sources", []), ("reply", {}), ("chunks", 0)))

    def saved(self) -> str:
        return json.dumps(vars(self), ensure_ascii=False)

    def add(self, data) -> None:
        if not isinstance(data, dict):
            return
        self.chunks += 1
        self.reply.update({n: data[n] for n in REPLY if data.get(n) is not None})
        candidates = data.get("candidates")
        c = candidates[0] if isinstance(candidates, list) and candidates and isinstance(candidates[0], dict) else {}
        self.candidate.update({n: c[n] for n in CANDIDATE if c.get(n) is not None})
        g = c.get(GROUNDING)
        if g is not None and not isinstance(g, dict):
            self.grounding, self.sources = {}, []
        elif g:
            self.grounding.update({k: v for k, v in g.items() if k != SOURCES})
            found = g.get(SOURCES)
            if found is not None:
                self.sources = self.sources + found if found else []
        content = c.get("content")
        for part in (content.get("parts") if isinstance(content, dict) else None) or []:
            if not isinstance(part, dict):
                continue
            text, thought = part.get("text"), bool(part.get("thought"))
            last = self.parts[-1] if self.parts else None
            if not isinstance(text, str):
                self.parts.append({"kind": "other", "body": part})
            elif last and last["kind"] == ("thought" if thought else "text"):
                last["body"] += text
            else:
                self.parts.append({"kind": "thought" if thought else "text", "body": text})
        for kind in ("text", "thought"):
            if len(self.text(kind).encode()) > MOST_BYTES:
                raise ValueError("a streamed reply exceeds 2 MiB")

    def text(self, kind: str) -> str:
        return "".join(p["body"] for p in self.parts if p["kind"] == kind)

    def row(self, message) -> tuple:
        dump = lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        part = lambda p: dump(p["body"]) if p["kind"] == "other" else dump({"text": p["body"]} | ({"thought": True} if p["kind"] == "thought" else {}))
        maps = [{k: dump(v) for k, v in m.items()} for m in (self.candidate, self.grounding, self.reply)]
        return (message, self.text("text"), self.text("thought"), [part(p) for p in self.parts], maps[0], maps[1], [dump(s) for s in self.sources], maps[2], self.chunks)


def merge_stream(chunks: DataFrame) -> DataFrame:
    """MERGED rows of a stream of (message, chunk, data), in update mode: each message that a trigger's chunks changed.

    State is a reply's, bounded by its limit; chunks of one trigger are put in order.
    """
    columns = [c.split()[0] for c in MERGED.split(", ")]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = Reply(state.get[0] if state.exists else None)
        for r in pd.concat(list(batches)).sort_values("chunk", kind="stable").itertuples():
            try:
                data = json.loads(r.data)
            except (TypeError, ValueError):
                continue
            own.add(data)
        state.update((own.saved(),))
        yield pd.DataFrame([own.row(key[0])], columns=columns)

    kind = chunks.schema["message"].dataType.simpleString()
    return chunks.select("message", "chunk", "data").groupBy("message").applyInPandasWithState(step, MERGED.format(kind), "state string", "update", GroupStateTimeout.NoTimeout)
