"""Server-sent events: frames, identities, and step accumulation as keyed state."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import strip

MOST_BYTES = 2 << 20
PART_BYTES, MOST_STEPS, MOST_INDEX, MOST_SEEN = 60 << 10, 128, 10_000, 20_000
ACCUMULATED = "stream string, index int, kind string, content string, status string, truncated boolean"
STATE = "state string"


def frames(body: Column) -> Column:
    """Events (data, event, id) of a stream's text, in order.

    Lines end with LF or CRLF, an empty line ends a frame, comments are skipped,
    one space after the colon is dropped, several data lines are joined. Frames
    without data and the final [DONE] give no event; too large a frame is an error.
    """
    lines = lambda frame: F.filter(F.split(frame, "\n"), lambda x: (x != "") & ~F.startswith(x, F.lit(":")))
    value = lambda x: F.regexp_replace(x, r"^[^:]*:? ?", "")
    named = lambda ls, name: F.transform(F.filter(ls, lambda x: F.substring_index(x, ":", 1) == name), value)
    def event(frame: Column) -> Column:
        ls = lines(frame)
        return F.struct(
            F.array_join(named(ls, "data"), "\n").alias("data"), F.coalesce(F.try_element_at(named(ls, "event"), F.lit(-1)), F.lit("")).alias("event"),
            F.try_element_at(named(ls, "id"), F.lit(-1)).alias("id"), F.octet_length(frame).alias("size"),
        )

    own = F.transform(F.split(F.replace(body, F.lit("\r\n"), F.lit("\n")), r"\n\n+"), event)
    checked = F.when(F.exists(own, lambda e: e["size"] > MOST_BYTES), F.raise_error(F.lit("an event exceeds 2 MiB")).cast("array<struct<data:string,event:string,id:string,size:int>>")).otherwise(own)
    return F.filter(checked, lambda e: (e["data"] != "") & (strip(e["data"]) != "[DONE]"))


def event_id(sse_id: Column, json_id: Column, sse_first: bool) -> Column:
    """An event's identity: progress takes the frame's id first and ignores ids over 256 characters, tracing the JSON's first."""
    if not sse_first:
        return F.coalesce(F.nullif(json_id, F.lit("")), F.nullif(sse_id, F.lit("")))
    own = F.coalesce(F.nullif(sse_id, F.lit("")), F.nullif(json_id, F.lit("")))
    return F.when(F.length(own) <= 256, own)


def first_seen(events: DataFrame, stream: str, identity: str, arrival: str) -> DataFrame:
    """The first arrival of each identity in its stream; events without one are all kept."""
    w = Window.partitionBy(stream, identity).orderBy(arrival)
    return events.withColumn("__r", F.row_number().over(w)).filter(F.col(identity).isNull() | (F.col("__r") == 1)).drop("__r")


#: Deltas: the kind of a step whose start was missed, where the added text stands, the kinds of steps that take it (a regex).
DELTAS = {
    "text": ("model_output", "$.delta.text", "^model_output$"), "arguments_delta": ("function_call", "$.delta.arguments", ""), "thought_summary": ("thought", "$.delta.content.text", ""),
    "thought_signature": ("thought", None, ""), "image": ("model_output", None, ""), "text_annotation_delta": ("model_output", None, ""),
}
#: Tool steps take any other delta whole, in place of the one before.
TOOLS = "(_call|_result)$"
REPLAY = "replay"


def operations(events: DataFrame) -> DataFrame:
    """(stream, arrival, id, index, op, kind, text, into): what events (stream, arrival, event, id, data) do to a stream's steps.

    op is open, add, put, close or replay (an event of that name: a new connection
    without a cursor); kind that of the step, or null where it stays what it was;
    into says by a regex which kinds take the text. Other events are left out.
    """
    at = lambda path: F.get_json_object("data", path)
    name = F.coalesce(F.nullif(at("$.event_type"), F.lit("")), F.col("event"))
    index = F.when(at("$.index").rlike("^[0-9]{1,5}$"), at("$.index").cast("int"))
    table = lambda i: F.create_map(*[F.lit(x) for k, v in DELTAS.items() if v[i] is not None for x in (k, v[i])])
    delta, step = F.coalesce(at("$.delta.type"), F.lit("")), F.startswith(at("$.step"), F.lit("{"))
    added = F.coalesce(*[F.when(delta == k, at(path)) for k, (_, path, _) in DELTAS.items() if path], F.lit(""))
    rest = F.regexp_replace(F.regexp_replace(at("$.delta"), r'^\{"type":"[^"]*",?', "{"), r',"type":"[^"]*"(?=\}$)', "")
    known = F.array_contains(F.map_keys(table(1)), delta)
    final = F.coalesce(*[F.nullif(at(f"$.step.{c}"), F.lit("")) for c in ("text", "summary", "arguments")], F.lit(""))
    cases = {
        "open": (name == "step.start", F.coalesce(at("$.step.type"), F.lit("")), F.lit(""), F.lit("")),
        "add": ((name == "step.delta") & known, F.try_element_at(table(0), delta), added, F.try_element_at(table(2), delta)),
        "put": (name == "step.delta", F.coalesce(F.try_element_at(table(0), delta), delta), F.nullif(rest, F.lit("{}")), F.lit(TOOLS)),
        "close": (name == "step.stop", F.when(step, F.coalesce(at("$.step.type"), F.lit(""))), final, F.lit("")),
        REPLAY: (name == REPLAY, F.lit(None).cast("string"), F.lit(""), F.lit("")),
    }
    made = F.coalesce(*[F.when(when, F.struct(F.lit(op).alias("op"), kind.alias("kind"), text.alias("text"), into.alias("into"))) for op, (when, kind, text, into) in cases.items()])
    own = events.select("stream", "arrival", F.nullif(F.col("id"), F.lit("")).alias("id"), index.alias("index"), made.alias("o"))
    return own.filter((F.col("index") < MOST_INDEX) | (F.col("o.op") == REPLAY)).select("stream", "arrival", "id", "index", "o.*")


class Steps:
    """The steps of one stream as plain data, so that they can be kept as state: open ones by index, indexes that were closed, ids that were seen."""

    def __init__(self, saved: str | None = None):
        own = json.loads(saved) if saved else {"open": {}, "closed": [], "seen": []}
        self.open, self.closed, self.seen = own["open"], set(own["closed"]), dict.fromkeys(own["seen"])

    def saved(self) -> str:
        return json.dumps({"open": self.open, "closed": sorted(self.closed), "seen": list(self.seen)})

    def new(self, identity: str | None) -> bool:
        """Whether an event wasn't there before; the last MOST_SEEN identities are kept."""
        if not identity:
            return True
        fresh = identity not in self.seen
        self.seen[identity] = None
        if len(self.seen) > MOST_SEEN:
            del self.seen[next(iter(self.seen))]
        return fresh

    def apply(self, rows: pd.DataFrame) -> dict[int, dict]:
        """The rows of ACCUMULATED that operations, in order of arrival, leave changed, by index."""
        changed = {}
        for r in rows.sort_values("arrival", kind="stable").itertuples():
            if not self.new(r.id):
                continue
            if r.op == REPLAY:  # buffers start anew, what is closed stays so
                self.open.clear()
                continue
            key = str(int(r.index_))
            step = self.open.get(key)
            if r.op == "open" or step is None and r.op != "close" or r.op == "close" and r.kind is not None:
                if key not in self.open and len(self.open) >= MOST_STEPS and r.op != "close":
                    continue
                step = self.open[key] = {"kind": r.kind, "content": "", "truncated": False}
            if step is None:
                continue
            if r.op != "open" and r.text and re.search(r.into, step["kind"]):
                whole = (step["content"] if r.op != "put" else "") + r.text
                raw = whole.encode()
                step["truncated"] |= len(raw) > PART_BYTES and r.op != "put"
                step["content"] = raw[:PART_BYTES].decode("utf-8", "ignore")
            if r.op == "close":
                self.closed.add(key)
                changed[int(key)] = {"index": int(key), **self.open.pop(key), "status": "completed"}
            elif key not in self.closed:  # a replay takes nothing back
                changed[int(key)] = {"index": int(key), **step, "status": "running"}
        return changed


def _rows(stream, changed: dict[int, dict]) -> pd.DataFrame:
    return pd.DataFrame([{"stream": stream, **r} for r in changed.values()], columns=["stream", "index", "kind", "content", "status", "truncated"])


def accumulate(events: DataFrame) -> DataFrame:
    """Parts of each stream from its events: a streaming DataFrame of (stream, arrival, event, id, data).

    State is keyed by stream and bounded: 128 open steps, 60 KiB a step, 20,000
    ids. A part is emitted whenever a trigger changed it, in update mode; a
    trigger's events of a stream are ordered over all of its Arrow batches.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = Steps(state.get[0] if state.exists else None)
        changed = own.apply(pd.concat(list(batches)))
        state.update((own.saved(),))
        yield _rows(key[0], changed)

    return operations(events).withColumnRenamed("index", "index_").groupBy("stream").applyInPandasWithState(step, ACCUMULATED, STATE, "update", GroupStateTimeout.NoTimeout)


def accumulated(events: DataFrame) -> DataFrame:
    """The same over a finished log: the last state of each part."""
    fold = lambda pdf: _rows(pdf["stream"].iloc[0], Steps().apply(pdf))
    return operations(events).withColumnRenamed("index", "index_").groupBy("stream").applyInPandas(fold, ACCUMULATED)
