"""Fields of replies and jobs: image links, usage, summaries, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import redaction as R
from . import text as X

# Counters as a service names them and as they are kept.
USAGE = {
    "total_tokens": "totalTokens", "total_input_tokens": "inputTokens", "total_output_tokens": "outputTokens",
    "total_thought_tokens": "thoughtTokens", "total_tool_use_tokens": "toolTokens", "total_cached_tokens": "cachedTokens",
}
ITEMS, ITEM_CHARS = (12, 12, 8), 120


def image_urls(images: Column, text: Column) -> Column:
    """Image addresses of a list and of a text's image marks, in order, each once: http(s) and inline images only."""
    marked = F.flatten(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(X.IMAGE_LIST_MARK), F.lit(1)), lambda j: F.coalesce(F.from_json(j, "array<string>"), F.array().cast("array<string>"))))
    both = F.concat(F.coalesce(images, F.array().cast("array<string>")), marked)
    return F.array_distinct(F.filter(both, lambda u: u.rlike("^(?:https?://|data:image/)")))


def usage(raw: Column) -> Column:
    """Counters of a usage object under the names that are kept: whole numbers from 0; what is missing stays missing."""
    own = F.from_json(raw, "map<string,string>")
    counts = F.map_filter(own, lambda k, v: k.isin(*USAGE) & v.rlike("^[0-9]+$"))
    names = F.create_map(*[F.lit(x) for kv in USAGE.items() for x in kv])
    return F.transform_values(F.transform_keys(counts, lambda k, _: names[k]), lambda _, v: v.cast("long"))


def summary(raw: Column, fields: tuple[str, str, str] = ("done", "next", "risks")) -> Column:
    """A summary's three lists from a reply with a JSON object somewhere in it: trimmed, capped in number and length; null without one."""
    body = F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)\{.*\}", 0)
    parsed = F.from_json(body, "struct<" + ",".join(f"{f}:array<string>" for f in fields) + ">")
    lists = [F.slice(F.filter(F.transform(F.coalesce(parsed[f], F.array().cast("array<string>")), lambda s: F.left(X.strip(s), F.lit(ITEM_CHARS))), lambda s: s != ""), 1, n).alias(f) for f, n in zip(fields, ITEMS, strict=True)]
    return F.when(F.try_parse_json(body).isNotNull(), F.struct(*lists))


def snapshot_rows(snapshots: DataFrame) -> DataFrame:
    """(stream, row, kind, status): one summary row of each snapshot (stream, data) and one for each step that is an object."""
    parsed = snapshots.select("stream", F.from_json("data", "struct<status:string,steps:array<struct<type:string,status:string>>>").alias("d"))
    head = parsed.select("stream", F.lit(-1).alias("row"), F.lit("snapshot").alias("kind"), F.coalesce("d.status", F.lit("unknown")).alias("status"))
    steps = parsed.select("stream", F.posexplode("d.steps").alias("row", "s")).filter("s IS NOT NULL")
    return head.unionByName(steps.select("stream", "row", F.left(F.coalesce("s.type", F.lit("unknown")), F.lit(80)).alias("kind"), "s.status"))


def redacted_list(values: Column) -> Column:
    return F.transform(values, lambda v: R.redact(v))


def unknown_settings(given: Column, known: list[str]) -> Column:
    """Keys of a settings map that nobody knows."""
    return F.array_sort(F.array_except(F.map_keys(given), F.array(*[F.lit(k) for k in known])))
