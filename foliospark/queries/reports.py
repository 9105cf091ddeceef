"""Queries for reports, page rules and event streams (F, K, A, J, X, Q, Z, V)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..adapters import PAGES_SQL, pages
from ..functions import pages as G

from ..plans import simulation as Z
from ..registry import query
from ..session import table

TAG = r"(?i)</?[a-z][a-z\d-]*\b[^>]*>"


@query(rf"""WITH a AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', '<br />', 'g'), '(?i)(<(?:table|td|th)\b[^>]*?)\s+border\s*=\s*(?:"\d+"|\d+)', '\1', 'g') AS t FROM pages)
SELECT page_id, 0::BIGINT AS before_pages, len(regexp_extract_all(html, '!\[[^\]\n]*\]\(images/[^)\s]+\)'))::BIGINT AS before_images, len(regexp_extract_all(html, '{TAG}'))::BIGINT AS before_html_tags, len(regexp_extract_all(html, '(?i)</?div\b'))::BIGINT AS before_div_tags, len(regexp_extract_all(html, '&nbsp;'))::BIGINT AS before_nbsp,
0::BIGINT AS after_pages, len(regexp_extract_all(t, '!\[[^\]\n]*\]\(images/[^)\s]+\)'))::BIGINT AS after_images, len(regexp_extract_all(t, '{TAG}'))::BIGINT AS after_html_tags, len(regexp_extract_all(t, '(?i)</?div\b'))::BIGINT AS after_div_tags, len(regexp_extract_all(t, '&nbsp;'))::BIGINT AS after_nbsp, TRUE AS unchanged FROM a""")
def k07_quality_report(spark, folder):
    return G.quality_report(table(spark, folder, "pages"), "page_id", "html")


@query("SELECT doc_id, (CASE WHEN len(v) = 0 THEN 0 ELSE len(list_filter(v, lambda x: x < 250)) / len(v)::DOUBLE END) < 0.001 AND coalesce(list_min(v), 255) >= 200 AS blank FROM (SELECT doc_id, list_transform(range(0, n_chars % 40), lambda i: (255 - (i * doc_id) % 7 * 10)::INT) AS v FROM documents)")
def f01_blank_pages(spark, folder):
    samples = F.expr("IF(n_chars % 40 = 0, CAST(array() AS array<int>), transform(sequence(0, n_chars % 40 - 1), i -> CAST(255 - (i * doc_id) % 7 * 10 AS INT)))")
    return table(spark, folder, "documents").select("doc_id", G.is_blank(samples).alias("blank"))


@query("SELECT part.p_partkey, array_to_string(list_filter([CASE WHEN NOT p_size BETWEEN 5 AND 45 THEN 'size' END, CASE WHEN NOT p_retailprice > 905 THEN 'price' END, CASE WHEN NOT p_brand LIKE 'Brand#%' THEN 'brand' END], lambda x: x IS NOT NULL), ',') AS failed FROM part")
def f17_range_checks(spark, folder):
    checks = {"size": F.col("p_size").between(5, 45), "price": F.col("p_retailprice") > 905, "brand": F.startswith("p_brand", F.lit("Brand#"))}
    return table(spark, folder, "part").select("p_partkey", F.array_join(G.violations(checks), ",").alias("failed"))


@query(None)
def x12_batch_answers(spark, folder):
    """Answers to batches of three whole pages; in every fourth the marks are out of order. Faults have no SQL form in the oracle."""
    own = pages(spark, folder).select("doc", "number", F.floor((F.col("number") - 1) / 3).alias("batch"), F.concat(F.lit("<!-- 第 "), F.col("number").cast("string"), F.lit(" 页 -->\n"), "text").alias("part"))
    got = own.groupBy("doc", "batch").agg(F.array_sort(F.collect_list(F.struct("number", "part"))).alias("p"))
    numbers = F.transform("p", lambda r: r["number"].cast("int"))
    wrong = F.col("batch") % 4 == 0
    expected = F.when(wrong, F.transform(numbers, lambda n: n + 1)).otherwise(numbers)
    answer = G.batch_answer(F.array_join(F.transform("p", lambda r: r["part"]), "\n"), expected)
    return got.select("doc", "batch", F.when(answer.isNotNull(), F.size(answer).cast("long")).alias("accepted"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey::VARCHAR WHEN n_nationkey % 3 = 1 THEN '(' || chr((97 + n_nationkey)::INT) || ')' END AS label FROM nation")
def x20_small_labels(spark, folder):
    n = F.col("n_nationkey")
    raw = F.when(n % 3 == 0, F.concat(F.lit(" $"), n.cast("string"), F.lit("$ "))).when(n % 3 == 1, F.concat(F.lit("( "), F.char(n + 97), F.lit(" )"))).otherwise("caption")
    return table(spark, folder, "nation").select("n_nationkey", G.small_label(raw).alias("label"))


@query("SELECT s_suppkey, lower((s_acctbal > 0)::VARCHAR) AS enabled, s_name AS name FROM supplier")
def x26_workflow_inputs(spark, folder):
    inputs = F.create_map(F.lit("enabled"), F.initcap((F.col("s_acctbal") > 0).cast("string")), F.lit("name"), F.col("s_name"))
    own = table(spark, folder, "supplier").select("s_suppkey", G.workflow_inputs(inputs).alias("m"))
    return own.select("s_suppkey", F.col("m")["enabled"].alias("enabled"), F.col("m")["name"].alias("name"))


_BARE = r"regexp_replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '[\\s$*`{{}}\\\\]', '', 'g')"


@query(f"""WITH r AS (SELECT item_id AS page, text AS anchor, item_id % 3 <> 0 AS wanted FROM benchmark UNION ALL SELECT doc_id, regexp_extract(text, '[a-z]+[^a-z]*$'), doc_id % 3 <> 0 FROM documents UNION ALL SELECT doc_id, 'license', TRUE FROM documents),
b AS (SELECT page, {_BARE.format(c='anchor')} AS anchor, wanted FROM r), t AS (SELECT doc_id AS page, {_BARE.format(c='text')} AS t FROM documents)
SELECT page, count(*) FILTER (contains(coalesce(t, ''), anchor) = wanted) AS passed, count(*) AS total FROM b LEFT JOIN t USING (page) GROUP BY page""")
def a20_rubric(spark, folder):
    """Each page is asked for a whole passage, for its own last word and for a word that few hold."""
    items, documents = table(spark, folder, "benchmark"), table(spark, folder, "documents")
    rubric = items.select(F.col("item_id").alias("page"), F.col("text").alias("anchor"), (F.col("item_id") % 3 != 0).alias("wanted"))
    last = F.regexp_extract("text", "[a-z]+[^a-z]*$", 0)
    rubric = rubric.unionByName(documents.select(F.col("doc_id").alias("page"), last.alias("anchor"), (F.col("doc_id") % 3 != 0).alias("wanted")))
    rubric = rubric.unionByName(documents.select(F.col("doc_id").alias("page"), F.lit("license").alias("anchor"), F.lit(True).alias("wanted")))
    return G.rubric_score(documents.select(F.col("doc_id").alias("page"), "text"), rubric).select("page", "passed", "total")


@query("SELECT l_returnflag AS segment, ceil(count(*) / 5.0::DOUBLE)::BIGINT AS batches, max(l_quantity) AS wall, count(*) FILTER (l_linestatus = 'O') AS checks FROM lineitem GROUP BY 1")
def a21_batch_benchmark(spark, folder):
    own = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("segment"))
    return own.agg(F.ceil(F.count("*") / 5.0).alias("batches"), F.max("l_quantity").alias("wall"), F.count_if(F.col("l_linestatus") == "O").alias("checks"))


@query(r"""WITH n AS (SELECT DISTINCT 'ation/' || substr(n_name, 1, 4) || '-tion' AS name, substr(n_name, 1, 4) || '-tion' AS short FROM nation),
l AS (SELECT name, short, regexp_replace(lower(short), '[^a-z0-9]', '', 'g') AS bare, 'tion' AS suffix FROM n),
t AS (SELECT doc_id AS task, text, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS joined, regexp_extract_all(lower(text), '[a-z0-9]+') AS words FROM documents WHERE length(text) > 0),
s AS (SELECT task, name, CASE WHEN regexp_matches(text, '(?i)(^|[^A-Za-z0-9_.-])' || name || '($|[^A-Za-z0-9_.-])') THEN 1000 + length(name) WHEN contains(joined, bare) THEN 100 + length(short) WHEN list_contains(words, suffix) THEN 10 + length(suffix) END AS score FROM t, l)
SELECT task, name, score::INTEGER AS score FROM (SELECT *, rank() OVER (PARTITION BY task ORDER BY score DESC) AS r FROM s WHERE score IS NOT NULL) WHERE r = 1""")
def j21_repository_mentions(spark, folder):
    """Parts' brands as repositories that documents may mention."""
    listed = table(spark, folder, "nation").select(F.concat(F.lit("ation/"), F.substring("n_name", 1, 4), F.lit("-tion")).alias("name")).distinct()
    return G.mentioned_repositories(table(spark, folder, "documents").select(F.col("doc_id").alias("task"), "text"), listed)


@query("WITH d AS (SELECT *, row_number() OVER (PARTITION BY user_id, value ORDER BY event_id) AS r FROM events) SELECT event_id FROM d WHERE r = 1")
def q01_event_dedup(spark, folder):
    from ..streaming.sse import first_seen

    own = table(spark, folder, "events").select("event_id", F.col("user_id").alias("stream"), F.col("value").cast("string").alias("identity"))
    return first_seen(own, "stream", "identity", "event_id").select("event_id")


@query("SELECT user_id AS stream, event_id AS part FROM events WHERE event_type = 'click' UNION ALL SELECT user_id, event_id FROM events e WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events c WHERE c.user_id = e.user_id AND c.event_type = 'click')")
def q05_snapshot_reconcile(spark, folder):
    own = table(spark, folder, "events").select(F.col("user_id").alias("stream"), F.col("event_id").alias("part"), "event_type")
    return G.reconciled(own.filter("event_type = 'click'").drop("event_type"), own.filter("event_type = 'error'").drop("event_type"))


@query("WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS kind FROM events GROUP BY user_id) SELECT event_id FROM events JOIN f USING (user_id) WHERE event_type = kind")
def q06_fixed_types(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type")
    saved = events.groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("event_type"))
    return G.same_type(events, saved, ["user_id"], "event_type").select("event_id")


@query("SELECT user_id AS stream, event_id % 5 AS index, max(value) FILTER (event_type = 'view') - min(value) FILTER (event_type = 'click') AS seconds FROM events GROUP BY ALL")
def q12_step_times(spark, folder):
    event = F.when(F.col("event_type") == "click", "step.start").when(F.col("event_type") == "view", "step.stop")
    return G.step_times(table(spark, folder, "events").select(F.col("user_id").alias("stream"), (F.col("event_id") % 5).alias("index"), event.alias("event"), F.col("value").alias("at")))


@query("WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS place FROM events) SELECT user_id, arg_max(event_id, place) AS last FROM r GROUP BY user_id")
def q13_ready_order(spark, folder):
    w = Window.partitionBy("user_id").orderBy("value", "event_id")
    ranked = table(spark, folder, "events").select("user_id", "event_id", F.row_number().over(w).alias("place"))
    return ranked.groupBy("user_id").agg(F.max_by("event_id", "place").alias("last"))


@query("SELECT event_id AS unit, least(event_id % 6 + 1, 3) AS attempts, CASE WHEN event_id % 6 < 3 THEN 'ok' ELSE 'failed' END AS status FROM events")
def q14_retry_rounds(spark, folder):
    return Z.retry_rounds(table(spark, folder, "events").select(F.col("event_id").alias("unit"), (F.col("event_id") % 6).alias("failures")), 3)


@query("""WITH w AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations), l AS (SELECT conv_id, turn, role || ': ' || substr(text, 1, 400) AS line FROM w WHERE r <= 80)
SELECT conv_id, sha256(substr(string_agg(line, E'\\n' ORDER BY turn), 1, 1800)) AS digest FROM l GROUP BY conv_id""".replace("\\\\n", "\\n"))
def q17_digest(spark, folder):
    from ..operators.aggregates import recent

    line = F.concat("role", F.lit(": "), F.left("text", F.lit(400)))
    last = recent(table(spark, folder, "conversations"), ["conv_id"], "turn", 80)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda r: r["line"])
    return last.groupBy("conv_id").agg(F.sha2(F.left(F.array_join(lines, "\n"), F.lit(1800)), 256).alias("digest"))


@query("SELECT user_id, min(value) FILTER (event_type = 'click') AS dispatched, arg_min(value, event_id) FILTER (event_type = 'view') AS first_reply, arg_max(value, event_id) AS total FROM events GROUP BY user_id")
def q18_timing(spark, folder):
    is_view = F.col("event_type") == "view"
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "click", F.col("value"))).alias("dispatched"), F.min_by(F.when(is_view, F.col("value")), F.when(is_view, F.col("event_id"))).alias("first_reply"), F.max_by("value", "event_id").alias("total")
    )


@query("SELECT event_id, least(a, 3.0::DOUBLE + b) AS seconds, CASE WHEN a <= 3.0::DOUBLE + b THEN 'primary' ELSE 'copy' END AS winner FROM (SELECT event_id, value AS a, (event_id % 30)::DOUBLE AS b FROM events)")
def z03_hedged_race(spark, folder):
    own = table(spark, folder, "events").select("event_id", Z.race(F.col("value"), (F.col("event_id") % 30).cast("double"), F.lit(3.0)).alias("r"))
    return own.select("event_id", "r.seconds", "r.winner")


@query(f"WITH {PAGES_SQL} SELECT doc_id, CASE WHEN origin = 'model' AND n_chars % 2 = 0 THEN 'ocr+model' WHEN origin = 'model' THEN 'model' WHEN n_chars % 2 = 0 THEN 'ocr' END AS source FROM pg")
def z04_page_sources(spark, folder):
    answer, draft = F.when(F.col("origin") == "model", "a"), F.when(F.col("n_chars") % 2 == 0, "d")
    return pages(spark, folder).select("doc_id", Z.page_source(answer, draft).alias("source"))


@query(f"WITH {PAGES_SQL} SELECT doc, (number - 1) // 4 AS batch, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_and(status = 'blank') THEN 'blank' ELSE 'ok' END AS status FROM pg GROUP BY ALL")
def z05_batch_status(spark, folder):
    own = pages(spark, folder).groupBy("doc", F.floor((F.col("number") - 1) / 4).alias("batch")).agg(F.collect_list("status").alias("s"))
    return own.select("doc", "batch", Z.unit_status(F.col("s")).alias("status"))


@query("WITH a AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 'unavailable' ELSE event_type END AS state FROM events) SELECT user_id, arg_min(state, event_id) AS state, min(event_id) AS attempt FROM a WHERE state <> 'unavailable' GROUP BY user_id")
def z06_fallback_chain(spark, folder):
    own = table(spark, folder, "events").select("user_id", "event_id", F.when(F.col("event_type") == "error", "unavailable").otherwise(F.col("event_type")).alias("state"))
    return Z.first_available(own, ["user_id"], "event_id")


@query("WITH w AS (SELECT user_id, event_id, coalesce(max((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM events) SELECT user_id, count(*) AS attempts FROM w WHERE done = 0 GROUP BY user_id")
def z07_failover(spark, folder):
    own = table(spark, folder, "events").select("user_id", "event_id", (F.col("event_type") == "purchase").alias("ok"))
    return Z.failover(own, ["user_id"], "event_id").groupBy("user_id").agg(F.count("*").alias("attempts"))


@query("SELECT page_id, CASE WHEN page_id % 4 < 2 THEN 'link' WHEN page_id % 3 < 2 THEN 'relay' ELSE 'upload' END AS route FROM pages")
def z08_routes(spark, folder):
    return table(spark, folder, "pages").select("page_id", Z.submitted_route(F.col("page_id") % 4, F.col("page_id") % 3).alias("route"))


@query("SELECT o_orderpriority AS job, count(*) FILTER (o_orderstatus = 'F') AS saved, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus = 'P') AS canceled FROM orders GROUP BY 1")
def z09_job_accounting(spark, folder):
    n = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("job")).agg(n("F").alias("saved"), n("O").alias("failed"), n("P").alias("canceled"))


@query("SELECT l_partkey AS figure, min(l_orderkey) AS scheduled FROM lineitem GROUP BY 1")
def z10_svg_scheduling(spark, folder):
    """Scheduling twice is scheduling once: the first counts."""
    return table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("figure")).agg(F.min("l_orderkey").alias("scheduled"))


@query("SELECT page_id, CASE WHEN contains(html, '<title>') AND contains(string_split(html, '<title>')[-1], '</title>') THEN string_split(string_split(html, '<title>')[-1], '</title>')[1] END AS section FROM pages")
def v22_sections(spark, folder):
    return table(spark, folder, "pages").select("page_id", G.section(F.col("html"), "<title>", "</title>").alias("section"))


@query("SELECT conv_id, len(list_distinct(list(role)))::BIGINT AS kinds, sha256(string_agg(trim(text), E'\\n\\n' ORDER BY turn)) AS request FROM conversations GROUP BY conv_id".replace("\\\\n", "\\n"))
def v02_request_parts(spark, folder):
    ordered = F.array_sort(F.collect_list(F.struct("turn", F.trim("text").alias("t"))))
    return table(spark, folder, "conversations").groupBy("conv_id").agg(F.count_distinct("role").alias("kinds"), F.sha2(F.array_join(F.transform(ordered, lambda r: r["t"]), "\n\n"), 256).alias("request"))


@query("SELECT page_id, CASE WHEN page_id % 5 IN (0, 1) THEN 'gone' WHEN page_id % 5 = 2 THEN 'retry' ELSE 'ok' END AS state FROM pages")
def v18_source_status(spark, folder):
    status = F.element_at(F.array(*[F.lit(s) for s in (404, 410, 503, 200, 206)]), (F.col("page_id") % 5 + 1).cast("int"))
    return table(spark, folder, "pages").select("page_id", F.when(status.isin(404, 410), "gone").when(status >= 500, "retry").otherwise("ok").alias("state"))
