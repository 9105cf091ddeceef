"""Queries for aggregations (A)."""

from pyspark.sql import functions as F

from ..adapters import PAGES_SQL, REQUESTS_SQL, pages, requests
from ..functions import text as X
from ..operators import aggregates as A
from ..registry import query
from ..session import table

WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TAG = r"(?i)</?[a-z][a-z\d-]*\b[^>]*>"

_COUNTS = """count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'blank') AS blank, count(*) FILTER (status = 'failed') AS failed,
greatest(0, count(*) - count(*) FILTER (status IN ('ok', 'blank'))) AS pending, 100.0::DOUBLE * count(*) FILTER (status IN ('ok', 'blank')) / count(*) AS percent"""


@query(f"WITH {PAGES_SQL} SELECT doc, {_COUNTS} FROM pg GROUP BY doc")
def a01_progress_counts(spark, folder):
    return A.status_counts(pages(spark, folder), "doc")


@query(f"""WITH {PAGES_SQL}, u AS (SELECT doc, (number - 1) // 5 AS unit, list(status) AS ss, max(number) % 2 = 0 AS nested, min(status) AS own FROM pg GROUP BY ALL),
f AS (SELECT unnest(CASE WHEN nested THEN ss ELSE [own] END) AS status FROM u) SELECT status, count(*) AS n FROM f GROUP BY status""")
def a02_page_level_counts(spark, folder):
    own = F.struct(F.concat("doc", F.lit("-"), F.col("number").cast("string")).alias("chunk"), "status")
    units = pages(spark, folder).groupBy("doc", F.floor((F.col("number") - 1) / 5).alias("unit")).agg(F.collect_list(own).alias("page_results"), F.max("number").alias("m"), F.min("status").alias("status"))
    units = units.select("doc", F.col("unit").cast("string").alias("chunk"), "status", F.when(F.col("m") % 2 == 0, F.col("page_results")).alias("page_results"))
    return A.flattened(units).groupBy("status").agg(F.count("*").alias("n"))


@query(f"""WITH {PAGES_SQL}, c AS (SELECT doc, count(*) AS total, count(*) FILTER (status IN ('ok', 'blank')) AS done, 10.0::DOUBLE * max(number) AS elapsed FROM pg GROUP BY doc)
SELECT doc, CASE WHEN total = 0 THEN 100.0 ELSE 100.0::DOUBLE * done / total END AS percent, CASE WHEN done = 0 THEN NULL ELSE elapsed / done * (total - done) END AS eta FROM c""")
def a03_percent_eta(spark, folder):
    c = pages(spark, folder).groupBy("doc").agg(F.count("*").alias("total"), F.count_if(F.col("status").isin("ok", "blank")).alias("done"), (10.0 * F.max("number")).alias("elapsed"))
    percent = F.when(F.col("total") == 0, 100.0).otherwise(100.0 * F.col("done") / F.col("total"))
    return c.select("doc", percent.alias("percent"), F.when(F.col("done") > 0, F.col("elapsed") / F.col("done") * (F.col("total") - F.col("done"))).alias("eta"))


@query(f"""WITH {PAGES_SQL} SELECT doc, CASE WHEN bool_or(status = 'failed' AND number % 7 = 0) THEN 'failed' WHEN bool_or(status = 'failed') THEN 'partial' ELSE 'completed' END AS state FROM pg GROUP BY doc""")
def a04_overall_state(spark, folder):
    failed = F.col("status") == "failed"
    return pages(spark, folder).groupBy("doc").agg(A.overall_state(F.bool_or(failed & (F.col("number") % 7 == 0)), F.bool_or(failed)).alias("state"))


@query(f"""WITH {PAGES_SQL}, c AS (SELECT origin, count(*) AS n FROM pg GROUP BY origin)
SELECT v.origin, coalesce(c.n, 0) AS n FROM (VALUES ('model'), ('ocr'), ('ocr+model')) v(origin) LEFT JOIN c USING (origin)""")
def a05_source_counts(spark, folder):
    counts = pages(spark, folder).groupBy("origin").agg(F.count("*").alias("n"))
    return A.zero_filled(counts, "origin", ["model", "ocr", "ocr+model"])


_RANKED = "row_number() OVER (PARTITION BY {k} ORDER BY seconds) - 1 AS r, count(*) OVER (PARTITION BY {k}) AS n"


@query(f"""WITH {REQUESTS_SQL}, w AS (SELECT *, {_RANKED.format(k='event_type')} FROM rq WHERE seconds IS NOT NULL)
SELECT event_type, count(*) AS n, max(seconds) FILTER (r = round_even((n - 1) * 0.5::DOUBLE, 0)) AS p50, max(seconds) FILTER (r = round_even((n - 1) * 0.95::DOUBLE, 0)) AS p95 FROM w GROUP BY event_type""")
def a06_nearest_rank(spark, folder):
    return A.nearest_rank(requests(spark, folder), ["event_type"], "seconds", {"p50": 0.5, "p95": 0.95})


@query(f"""WITH {REQUESTS_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY seq DESC) AS rr FROM rq), l AS (SELECT * FROM t WHERE rr <= 1000),
w AS (SELECT *, {_RANKED.format(k='event_type')} FROM l)
SELECT event_type, count(*) AS n, max(seconds) FILTER (r = round_even((n - 1) * 0.5::DOUBLE, 0)) AS p50, max(seconds) FILTER (r = round_even((n - 1) * 0.95::DOUBLE, 0)) AS p95 FROM w GROUP BY event_type""")
def a07_bounded_history(spark, folder):
    return A.nearest_rank(A.recent(requests(spark, folder), ["event_type"], "seq", 1000), ["event_type"], "seconds", {"p50": 0.5, "p95": 0.95})


@query(f"WITH {REQUESTS_SQL} SELECT CASE WHEN status IN (200, 429, 503) THEN status::VARCHAR ELSE 'other' END AS class, count(*) AS n FROM rq GROUP BY 1")
def a07_status_classes(spark, folder):
    return requests(spark, folder).groupBy(A.status_class(F.col("status")).alias("class")).agg(F.count("*").alias("n"))


@query(f"WITH {REQUESTS_SQL}, u AS (SELECT bucket, count(*) AS used FROM rq GROUP BY bucket) SELECT count(*) AS buckets, min(used) AS min_requests, max(used) AS max_requests FROM u")
def a08_bucket_spread(spark, folder):
    used = requests(spark, folder).groupBy("bucket").agg(F.count("*").alias("used"))
    return used.agg(F.count("*").alias("buckets"), F.min("used").alias("min_requests"), F.max("used").alias("max_requests"))


@query("""SELECT c_nationkey AS bucket, c_custkey AS key, c_acctbal < 0 OR n_regionkey = 0 AS disabled, count(o_orderkey) AS used
FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def a09_key_usage(spark, folder):
    keys = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    disabled = (F.col("c_acctbal") < 0) | (F.col("n_regionkey") == 0)
    used = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("used"))
    return keys.join(used, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("c_nationkey").alias("bucket"), F.col("c_custkey").alias("key"), disabled.alias("disabled"), F.coalesce("used", F.lit(0)).alias("used"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def a10_event_counts(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def a11_longest_steps(spark, folder):
    return table(spark, folder, "events").select("event_id", "event_type", "value").orderBy(F.desc("value"), "event_id").limit(10)


@query("SELECT CASE WHEN regexp_full_match(event_type, '[a-z_]{1,48}') AND event_type <> 'view' THEN event_type ELSE 'other' END AS kind, count(*) AS n FROM events GROUP BY 1")
def a12_step_types(spark, folder):
    kind = F.when(F.col("event_type").rlike("^[a-z_]{1,48}$") & (F.col("event_type") != "view"), F.col("event_type")).otherwise("other")
    return table(spark, folder, "events").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS calls FROM events WHERE (event_type || '_call') LIKE '%\\_call' ESCAPE '\\' AND length(event_type || '_call') <= 80 AND event_type <> 'error' GROUP BY user_id")
def a13_tool_calls(spark, folder):
    name = F.concat("event_type", F.lit("_call"))
    return table(spark, folder, "events").filter(F.endswith(name, F.lit("_call")) & (F.length(name) <= 80) & (F.col("event_type") != "error")).groupBy("user_id").agg(F.count("*").alias("calls"))


_USAGE = "u AS (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN floor(value)::BIGINT END AS total, CASE WHEN event_type = 'purchase' THEN (floor(value)::BIGINT) // 2 END AS cached FROM events)"


def _usage(spark, folder):
    floor = F.floor("value").cast("long")
    return table(spark, folder, "events").select(
        "user_id", "event_id", F.when(F.col("event_type") != "error", floor).alias("total"), F.when(F.col("event_type") == "purchase", F.expr("CAST(floor(value) AS BIGINT) DIV 2")).alias("cached")
    )


@query(f"WITH {_USAGE} SELECT user_id, sum(total)::BIGINT AS total, sum(cached)::BIGINT AS cached, count(*) FILTER (coalesce(total, cached) IS NOT NULL) AS reporting FROM u GROUP BY user_id")
def a14_token_totals(spark, folder):
    return A.usage_totals(_usage(spark, folder), ["user_id"], ["total", "cached"])


@query("SELECT o_orderstatus AS outcome, count(*) AS n FROM orders GROUP BY 1")
def a15_outcome_counts(spark, folder):
    return table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("outcome")).agg(F.count("*").alias("n"))


@query(rf"""SELECT page_id, len(list_distinct(list_transform(regexp_extract_all(html, '<!-- 第 (\d+) 页 -->', 1), lambda x: x::INT)))::BIGINT AS pages, len(regexp_extract_all(html, '!\[[^\]\n]*\]\(images/[^)\s]+\)'))::BIGINT AS images,
len(regexp_extract_all(html, '{TAG}'))::BIGINT AS html_tags, len(regexp_extract_all(html, '(?i)</?div\b'))::BIGINT AS div_tags, len(regexp_extract_all(html, '&nbsp;'))::BIGINT AS nbsp,
length(regexp_replace(regexp_replace(html, '{TAG}', '', 'g'), '{WS}', '', 'g'))::BIGINT AS text_chars FROM pages""")
def a16_markdown_metrics(spark, folder):
    return table(spark, folder, "pages").select("page_id", *[c.alias(n) for n, c in X.metrics(F.col("html")).items()])


@query(rf"""WITH b AS (SELECT lang, unnest(list_sort(list(doc_id)))  AS doc_id FROM documents GROUP BY lang), d AS (SELECT lang, doc_id % 50 AS page, doc_id, text FROM documents), l AS (SELECT lang, page, arg_max(text, doc_id) AS body FROM d GROUP BY ALL)
SELECT lang, page, len(regexp_extract_all(body, '{TAG}'))::BIGINT AS html_tags, length(regexp_replace(regexp_replace(body, '{TAG}', '', 'g'), '{WS}', '', 'g'))::BIGINT AS text_chars FROM l""")
def a17_page_metrics(spark, folder):
    """The last text under a page number wins, as where a number is marked twice."""
    last = table(spark, folder, "documents").groupBy("lang", (F.col("doc_id") % 50).alias("page")).agg(F.max_by("text", "doc_id").alias("body"))
    return last.select("lang", "page", F.regexp_count("body", F.lit(TAG)).cast("long").alias("html_tags"), X.plain_chars(F.col("body")).cast("long").alias("text_chars"))


@query(rf"""WITH l AS (SELECT source, unnest(regexp_extract_all(text, '[^ \n]*[0-9]{{3}}[^ \n]*')) AS line FROM documents) SELECT source, line, count(*) AS n FROM l GROUP BY ALL HAVING count(*) >= 3""")
def a18_repeated_lines(spark, folder):
    found = table(spark, folder, "documents").select("source", F.explode(F.regexp_extract_all("text", F.lit(r"[^ \n]*[0-9]{3}[^ \n]*"), F.lit(0))).alias("line"))
    return found.groupBy("source", "line").agg(F.count("*").alias("n")).filter("n >= 3")


@query(r"""WITH a AS (SELECT page_id, list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS o, list_distinct(regexp_extract_all(substr(html, 1, 900), 'href="([^"]+)"', 1)) AS k FROM pages)
SELECT page_id, len(o)::BIGINT AS ocr_links, len(list_filter(o, lambda x: list_contains(k, x)))::BIGINT AS retained, len(list_filter(o, lambda x: NOT list_contains(k, x)))::BIGINT AS dropped FROM a""")
def a19_figure_audit(spark, folder):
    links = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit('href="([^"]+)"'), F.lit(1)))
    own = table(spark, folder, "pages").select("page_id", links(F.col("html")).alias("o"), links(F.substring("html", 1, 900)).alias("k"))
    size = lambda c: F.size(c).cast("long")
    return own.select("page_id", size(F.col("o")).alias("ocr_links"), size(F.array_intersect("o", "k")).alias("retained"), size(F.array_except("o", "k")).alias("dropped"))


@query("SELECT event_type, median(value) AS median FROM events GROUP BY event_type")
def a22_median(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.median("value").alias("median"))


@query("SELECT c_nationkey AS g, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def a23_duplicate_groups(spark, folder):
    return A.duplicate_groups(table(spark, folder, "customer").select(F.col("c_nationkey").alias("g")), "g")


@query("""SELECT count(*) FILTER (event_type = 'click') AS launched, count(*) FILTER (event_type = 'click' AND value > 50) AS wins,
coalesce(max(CASE WHEN event_type = 'view' THEN 1000.0::DOUBLE - value END), 0) AS oldest FROM events""")
def a24_hedge_summary(spark, folder):
    hedge = F.col("event_type") == "click"
    oldest = F.coalesce(F.max(F.when(F.col("event_type") == "view", 1000.0 - F.col("value"))), F.lit(0.0))
    return table(spark, folder, "events").agg(F.count_if(hedge).alias("launched"), F.count_if(hedge & (F.col("value") > 50)).alias("wins"), oldest.alias("oldest"))


@query("SELECT count(*) AS scheduled, count(*) FILTER (event_type <> 'error') AS succeeded, count(*) FILTER (event_type = 'error') AS failed FROM events")
def a25_svg_summary(spark, folder):
    bad = F.col("event_type") == "error"
    return table(spark, folder, "events").agg(F.count("*").alias("scheduled"), F.count_if(~bad).alias("succeeded"), F.count_if(bad).alias("failed"))


@query("""SELECT l_returnflag AS route, count(*) AS jobs, count(*) FILTER (l_linestatus = 'F') AS failed, sum(l_quantity)::DOUBLE AS pages FROM lineitem GROUP BY 1""")
def a26_ocr_run_stats(spark, folder):
    return table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("route")).agg(F.count("*").alias("jobs"), F.count_if(F.col("l_linestatus") == "F").alias("failed"), F.sum("l_quantity").cast("double").alias("pages"))


@query(f"WITH {_USAGE} SELECT user_id, max(total) AS total, max(cached) AS cached FROM u GROUP BY user_id")
def a27_cumulative_usage(spark, folder):
    return A.cumulative_usage(_usage(spark, folder), ["user_id"], ["total", "cached"])


@query(f"WITH {_USAGE} SELECT user_id, arg_max(total, event_id) AS total FROM u WHERE total IS NOT NULL GROUP BY user_id")
def a28_last_usage(spark, folder):
    return A.last_value(_usage(spark, folder), ["user_id"], "total", "event_id")


@query("""SELECT conv_id, turn, sum(strlen(text)) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS bytes, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS chars FROM conversations""")
def a29_capture_budget(spark, folder):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, folder, "conversations").select("conv_id", "turn", F.sum(F.octet_length("text")).over(w).alias("bytes"), F.sum(F.length("text")).over(w).alias("chars"))
