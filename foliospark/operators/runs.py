"""Facts of a run: pace of its buckets, retired credentials, metrics of its log, its summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.redaction import MASK

#: Pace: what a refusal and a success multiply it with, and its bounds.
SLOWER, FASTER, MOST_PACE, LEAST_PACE = 1.5, 0.95, 8.0, 1.0
#: Outcomes that are folded in one row.
BLOCK = 4096


def pace(outcomes: DataFrame, key: str, order: str, status: str) -> DataFrame:
    """(key, pace): the factor after a bucket's outcomes in order; 429 slows it down, 200 speeds it up, others leave it.

    An outcome maps x to min(high, max(low, x * m)), and so do any in a row: blocks
    of outcomes are folded to one such map each, then a bucket's maps are folded.
    No bucket's log is ever in one row.
    """
    step = F.when(F.col(status) == 429, SLOWER).when(F.col(status) == 200, FASTER)
    own = outcomes.select(key, order, step.alias("m")).filter("m IS NOT NULL")
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    blocks = own.withColumn("__b", F.floor(place / BLOCK)).groupBy(key, "__b").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("m").alias("m")))).alias("ms"))
    one = lambda m: F.struct(m.alias("m"), F.lit(LEAST_PACE).alias("low"), F.lit(MOST_PACE).alias("high"))
    clamp = lambda x, f: F.least(f["high"], F.greatest(f["low"], x * f["m"]))
    then = lambda f, g: F.struct((f["m"] * g["m"]).alias("m"), clamp(f["low"], g).alias("low"), clamp(f["high"], g).alias("high"))
    nothing = F.struct(F.lit(1.0).alias("m"), F.lit(LEAST_PACE).alias("low"), F.lit(MOST_PACE).alias("high"))
    folded = blocks.select(key, "__b", F.aggregate("ms", nothing, lambda f, x: then(f, one(x["m"]))).alias("f"))
    whole = folded.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__b", "f"))), lambda x: x["f"]).alias("fs"))
    return whole.select(key, F.aggregate("fs", F.lit(LEAST_PACE), clamp).alias("pace"))


def retirements(responses: DataFrame, tokens: DataFrame) -> DataFrame:
    """(run, seq, token, state, retired, reason) of fatal responses (run, seq, token, reason): a token goes with its first one.

    tokens: run, token. state is retired while another token of the run is left, else
    fatal; retired counts those that are gone by then; no token is in a reason.
    """
    known = tokens.groupBy("run").agg(F.collect_set("token").alias("all"))  # a run's own few
    nth = F.row_number().over(Window.partitionBy("run", "token").orderBy("seq"))
    own = responses.withColumn("__new", (nth == 1).cast("int"))
    order = Window.partitionBy("run").orderBy("seq")
    counted = own.join(known, "run").withColumn("retired", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    longest = F.array_sort("all", lambda a, b: F.length(b) - F.length(a))
    masked = F.aggregate(longest, F.col("reason"), lambda acc, t: F.replace(acc, t, F.lit(MASK)))
    return counted.select("run", "seq", "token", F.when(F.col("retired") >= F.size("all"), "fatal").otherwise("retired").alias("state"), F.col("retired").cast("long").alias("retired"), masked.alias("reason"))


PERFORMANCE = "struct<p50_seconds:double,p95_seconds:double,`429`:bigint,`503`:bigint>"


def run_metrics(lines: DataFrame) -> DataFrame:
    """One row for each run of its log's lines (run, line): seconds from configuration to the quota's last word, requests, hedges, percentiles and refusals, pages by source."""
    at = F.try_to_timestamp(F.regexp_extract("line", r"\d{4}-\d{2}-\d{2}T[0-9:.]+Z", 0))
    has = lambda mark: F.contains("line", F.lit(mark))
    told = lambda pattern: F.nullif(F.regexp_extract("line", pattern, 1), F.lit(""))
    quota = has("[quota]") & has("action complete")
    done = told(r"\[done\] \d+\.md \(([^\n]+)\)")
    performance = F.from_json(F.min(told(r"\[performance\] (\{[^\n]+\})")), PERFORMANCE)
    own = lines.groupBy("run").agg(
        F.max(F.when(has("[config]"), at)).alias("__a"), F.max(F.when(quota, at)).alias("__b"), F.max(told(r"\[quota\] action complete[^\n]* requests=(\d+)").cast("long")).alias("requests"),
        F.count_if(has("[hedge]")).alias("hedges"), performance.alias("__p"), F.count_if(done.isNotNull()).alias("pages"), F.count_if(F.contains(done, F.lit("ocr+model"))).alias("both_sources"),
        F.first(told(r"\[ocr\] finished (\{[^\n]+\})"), ignorenulls=True).alias("ocr"),
    )
    seconds = F.round((F.unix_micros("__b") - F.unix_micros("__a")) / 1e6, 2)
    p = lambda n: F.col("__p")[n]
    return own.select("run", seconds.alias("wall_seconds"), "requests", "hedges", p("p50_seconds").alias("p50_seconds"), p("p95_seconds").alias("p95_seconds"), p("429").alias("http_429"), p("503").alias("http_503"), "pages", "both_sources", "ocr")


def batch_summary(metrics: DataFrame, pages_per_request: Column, first: Column, last: Column) -> DataFrame:
    """``metrics`` with the number of batches that a page range makes at so many pages a request."""
    return metrics.withColumn("pages_per_request", pages_per_request).withColumn("logical_batches", F.floor((last - first + pages_per_request) / pages_per_request).cast("long"))


# The labels of a run's summary.
LABELS = (
    "State", "Completed pages", "Successful / blank / failed", "OCR + model / model only / OCR only", "OCR pages / failed / seconds", "OCR jobs by link / relay / uploaded", "Model HTTP 429 / 503", "Model request P50 / P95 seconds",
    "Cumulative quota wait seconds (across requests)", "Retired model keys / OCR tokens", "OCR polling retries (same job)", "SVG figures scheduled / succeeded / original retained", "Requests per key bucket (min–max)", "Elapsed seconds", "Speculative copies / wins",
)


def job_summary(runs: DataFrame) -> DataFrame:
    """(run, place, metric, result): the fifteen rows of each run's summary.

    runs: run, progress, usage and requests, the latter three JSON objects; a part
    that is missing counts 0, an OCR or drawing that wasn't used is off.
    """
    p = lambda path: F.get_json_object("progress", f"$.{path}")
    u = lambda path: F.get_json_object("usage", f"$.{path}")
    n = lambda c: F.coalesce(c, F.lit("0"))
    pages = lambda kind: n(F.coalesce(p(f"{kind}_pages"), p(f"{kind}_chunks")))
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    line = lambda *parts: F.concat_ws(" / ", *parts)
    given = lambda part: F.coalesce(~u(part).isin("{}", "null"), F.lit(False))
    none = lambda c: F.coalesce(c, F.lit("None"))
    keys = F.from_json(u("keys"), "map<string,struct<disabled:boolean>>")
    retired = F.coalesce(F.size(F.filter(F.map_values(keys), lambda k: k["disabled"])), F.lit(0))
    results = (
        p("state"), text(pages("completed"), "/", p("total_pages"), " (", p("percent"), "%)"), line(pages("success"), pages("blank"), pages("failed")),
        line(n(u("page_sources['ocr+model']")), n(u("page_sources.model")), n(u("page_sources.ocr"))), F.when(given("ocr"), line(n(u("ocr.pages")), n(u("ocr.failed_pages")), n(u("ocr.seconds")))).otherwise("off"),
        F.when(given("ocr"), line(n(u("ocr.remote_jobs")), n(u("ocr.relay_jobs")), n(u("ocr.uploaded_jobs")))).otherwise("off"), line(n(u("performance['429']")), n(u("performance['503']"))),
        line(none(u("performance.p50_seconds")), none(u("performance.p95_seconds"))), n(u("performance.quota_wait_seconds")), line(F.greatest(retired, F.lit(0)).cast("string"), n(u("ocr.retired_tokens"))), n(u("ocr.poll_retries")),
        F.when(given("svg"), line(n(u("svg.scheduled")), n(u("svg.succeeded")), n(u("svg.failed")))).otherwise("off"), text(n(u("spread.min_requests")), "–", n(u("spread.max_requests"))), p("elapsed_seconds"),
        line(n(F.get_json_object("requests", "$.hedges_launched")), n(F.get_json_object("requests", "$.hedge_wins"))),
    )
    rows = F.array(*[F.struct(F.lit(label).alias("metric"), c.alias("result")) for label, c in zip(LABELS, results, strict=True)])
    return runs.select("run", F.posexplode(rows).alias("place", "r")).select("run", (F.col("place") + 1).alias("place"), "r.metric", "r.result")


def summary_markdown(rows: DataFrame) -> DataFrame:
    """(run, text): the summary as a Markdown table."""
    line = F.concat(F.lit("| "), "metric", F.lit(" | "), "result", F.lit(" |"))
    own = rows.groupBy("run").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    return own.select("run", F.concat(F.lit("## File conversion\n\n| Metric | Result |\n| --- | --- |\n"), F.array_join("lines", "\n"), F.lit("\n")).alias("text"))
