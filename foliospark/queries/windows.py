"""Queries for window-like computations, sorts and sets (W, T, U)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..adapters import PAGES_SQL, REQUESTS_SQL, pages, parts, requests
from ..operators import windows as W
from ..registry import query
from ..session import table

_ISLANDS = "d AS (SELECT DISTINCT doc, number FROM pg WHERE status <> 'failed'), g AS (SELECT doc, number, number - row_number() OVER (PARTITION BY doc ORDER BY number) AS k FROM d), i AS (SELECT doc, k, min(number) AS a, max(number) AS b FROM g GROUP BY ALL)"


@query(f"WITH {PAGES_SQL}, {_ISLANDS} SELECT doc, a AS first, CASE WHEN a = b THEN a::VARCHAR ELSE a || '–' || b END AS label FROM i")
def w01_page_ranges(spark, folder):
    """A row a range: a source may have any number of them."""
    own = W.islands(pages(spark, folder).filter("status <> 'failed'"), ["doc"], "number")
    return own.select("doc", "first", W.range_label(F.col("first"), F.col("last")).alias("label"))


@query("""WITH s AS (SELECT page_id, string_split(html, '<p>') AS p FROM pages), e AS (SELECT page_id, generate_subscripts(p, 1) - 1 AS nth, unnest(p) AS body FROM s)
SELECT page_id, nth::BIGINT AS nth, sha256(body) AS body FROM e WHERE nth > 0""")
def w02_segments(spark, folder):
    """What stands between one mark and the next."""
    cut = table(spark, folder, "pages").select("page_id", F.posexplode(F.split("html", "<p>")).alias("nth", "body"))
    return cut.filter("nth > 0").select("page_id", F.col("nth").cast("long").alias("nth"), F.sha2("body", 256).alias("body"))


@query(f"WITH {PAGES_SQL} SELECT doc, (number - 1) // 4 AS batch, count(*) AS n, min(number) AS first, max(number) AS last FROM pg GROUP BY ALL")
def w03_page_batches(spark, folder):
    own = W.batches(pages(spark, folder).select("doc", "number"), ["doc"], "number", 4)
    return own.groupBy("doc", "batch").agg(F.count("*").alias("n"), F.min("number").alias("first"), F.max("number").alias("last"))


@query(f"""WITH {PAGES_SQL}, w AS (SELECT doc, number, lag(number) OVER o AS p, lead(number) OVER o AS n FROM pg WHERE status <> 'blank' WINDOW o AS (PARTITION BY doc ORDER BY number))
SELECT doc, number, CASE WHEN p = number - 1 THEN p END AS previous, CASE WHEN n = number + 1 THEN n END AS next FROM w""")
def w04_neighbour_strips(spark, folder):
    return W.neighbours(pages(spark, folder).filter("status <> 'blank'").select("doc", "number"), ["doc"], "number")


@query("""WITH w AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events)
SELECT user_id, event_id, greatest(0.0, value - coalesce(p, 1.5)) AS delta FROM w WHERE r <= 100""")
def w05_step_deltas(spark, folder):
    steps = table(spark, folder, "events").select("user_id", "event_id", "value")
    return W.step_deltas(steps, ["user_id"], "event_id", "value", F.lit(1.5)).select("user_id", "event_id", "delta")


@query(f"WITH {REQUESTS_SQL} SELECT seq, avg(CASE WHEN status IN (429, 503) THEN 1.0::DOUBLE ELSE 0 END) OVER (PARTITION BY bucket ORDER BY seq ROWS 19 PRECEDING) AS share FROM rq")
def w06_rolling_errors(spark, folder):
    return W.rolling_share(requests(spark, folder), ["bucket"], "seq", F.col("status").isin(429, 503)).select("seq", "share")


@query("""WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)
SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS digest FROM w WHERE r <= 80 GROUP BY user_id""")
def w07_digest_lines(spark, folder):
    from ..operators.aggregates import recent

    last = recent(table(spark, folder, "events"), ["user_id"], "event_id", 80)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda r: r["event_type"])
    return last.groupBy("user_id").agg(F.array_join(lines, ",").alias("digest"))


@query("WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_type = 'view') SELECT user_id, event_id FROM w WHERE r <= 10")
def w08_tail_pending(spark, folder):
    from ..operators.aggregates import recent

    return recent(table(spark, folder, "events").filter("event_type = 'view'"), ["user_id"], "event_id", 10).select("user_id", "event_id")


@query("SELECT conv_id AS message, turn AS sequence, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS number FROM conversations")
def w10_part_numbering(spark, folder):
    return parts(spark, folder).select("message", "sequence", F.row_number().over(Window.partitionBy("message").orderBy("sequence")).cast("long").alias("number"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def w11_latest_per_key(spark, folder):
    return W.latest(table(spark, folder, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("""WITH f AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER o OR row_number() OVER o = 1 THEN 1 ELSE 0 END AS b FROM conversations WHERE turn <> 1 WINDOW o AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(b) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM f)
SELECT conv_id AS message, run::BIGINT AS run, role AS kind, sha256(string_agg(text, '' ORDER BY turn)) AS content, count(*) AS n FROM g GROUP BY conv_id, run, role""")
def w12_text_runs(spark, folder):
    own = W.merged_runs(parts(spark, folder).filter("sequence <> 1"), ["message"], "sequence", "kind", "content")
    return own.withColumn("content", F.sha2("content", 256))


@query("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch(date_trunc('second', ts))::BIGINT RANGE 59 PRECEDING) AS n_within FROM events""")
def w14_pacing(spark, folder):
    at = F.unix_seconds(F.col("ts").cast("timestamp")).alias("at")
    own = table(spark, folder, "events").select("event_id", "user_id", at)
    return W.within_seconds(own, ["user_id"], "at", 60).select("event_id", "n_within")


@query("""WITH u AS (SELECT c_nationkey, c_custkey, count(o_orderkey) AS used, max(o_orderdate) AS last_used FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY used, last_used NULLS FIRST, c_custkey) AS r FROM u) SELECT c_nationkey AS bucket, c_custkey AS key, used FROM w WHERE r = 1""")
def w15_least_used(spark, folder):
    used = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("used"), F.max("o_orderdate").alias("last_used"))
    own = table(spark, folder, "customer").join(used, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("used", F.coalesce("used", F.lit(0)))
    w = Window.partitionBy("c_nationkey").orderBy("used", F.asc_nulls_first("last_used"), "c_custkey")
    return own.withColumn("r", F.row_number().over(w)).filter("r = 1").select(F.col("c_nationkey").alias("bucket"), F.col("c_custkey").alias("key"), "used")


@query("""WITH f AS (SELECT event_id, user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events) SELECT user_id, run::BIGINT AS run, count(*) AS n FROM f GROUP BY ALL""")
def w16_runs(spark, folder):
    own = W.runs(table(spark, folder, "events"), ["user_id"], "event_id", F.col("event_type") == "error")
    return own.groupBy("user_id", "run").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, strpos(text, 'the') > 0 AND strpos(text, 'of') > 0 AND strpos(text, 'and') > 0 AND strpos(text, 'the') <= strpos(text, 'of') AND strpos(text, 'of') <= strpos(text, 'and') AS in_order FROM documents""")
def w17_reading_order(spark, folder):
    places = F.array(*[F.instr("text", w) for w in ("the", "of", "and")])
    return table(spark, folder, "documents").select("doc_id", (~F.exists(places, lambda p: p == 0) & (F.array_sort(places) == places)).alias("in_order"))


@query(f"WITH {PAGES_SQL} SELECT doc, number, status FROM pg WHERE status IN ('ok', 'blank') ORDER BY doc, number")
def t01_pages_by_number(spark, folder):
    return pages(spark, folder).filter(F.col("status").isin("ok", "blank")).select("doc", "number", "status").orderBy("doc", "number")


@query("SELECT conv_id, string_agg(turn::VARCHAR, ',' ORDER BY turn) AS turns FROM conversations GROUP BY conv_id")
def t02_children_in_order(spark, folder):
    return table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list("turn")), ",").alias("turns"))


@query("SELECT conv_id AS message, turn AS sequence, role AS kind FROM conversations ORDER BY 1, 2")
def t03_parts_by_sequence(spark, folder):
    return parts(spark, folder).select("message", "sequence", "kind").orderBy("message", "sequence")


@query("SELECT event_id, value FROM events WHERE event_type <> 'error' ORDER BY value DESC, event_id LIMIT 10")
def t04_top_ten(spark, folder):
    return table(spark, folder, "events").filter("event_type <> 'error'").select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(10)


@query("WITH w AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS due FROM events WHERE event_type = 'error') SELECT user_id, event_id, due FROM w")
def t05_retry_order(spark, folder):
    w = Window.partitionBy("user_id").orderBy("value", "event_id")
    return table(spark, folder, "events").filter("event_type = 'error'").select("user_id", "event_id", F.row_number().over(w).cast("long").alias("due"))


@query("WITH w AS (SELECT p_brand, p_partkey, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS r FROM part) SELECT p_brand, p_partkey, p_size FROM w WHERE r = 1")
def t06_top_ties(spark, folder):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_size"))
    return table(spark, folder, "part").withColumn("r", F.rank().over(w)).filter("r = 1").select("p_brand", "p_partkey", "p_size")


@query("SELECT p_name AS id, max(p_partkey) AS last FROM part GROUP BY 1 ORDER BY 1")
def t07_catalog_by_id(spark, folder):
    return table(spark, folder, "part").groupBy(F.col("p_name").alias("id")).agg(F.max("p_partkey").alias("last")).orderBy("id")


@query("WITH w AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS first FROM w WHERE r <= 4 GROUP BY 1")
def t08_first_parts(spark, folder):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    few = table(spark, folder, "orders").withColumn("r", F.row_number().over(w)).filter("r <= 4")
    return few.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")), ",").alias("first"))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS place FROM events")
def t10_completion_order(spark, folder):
    w = Window.partitionBy("user_id").orderBy("value", "event_id")
    return table(spark, folder, "events").select("event_id", F.row_number().over(w).cast("long").alias("place"))


@query(f"WITH {PAGES_SQL}, r AS (SELECT doc, unnest(range(min(number), max(number) + 1)) AS number FROM pg GROUP BY doc) SELECT doc, number FROM r EXCEPT SELECT doc, number FROM pg WHERE status IN ('ok', 'blank')")
def u01_missing_pages(spark, folder):
    own = pages(spark, folder)
    planned = own.groupBy("doc").agg(F.explode(F.sequence(F.min("number"), F.max("number"))).alias("number"))
    return planned.join(own.filter(F.col("status").isin("ok", "blank")).select("doc", "number"), ["doc", "number"], "left_anti")


@query(r"""WITH a AS (SELECT page_id, list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS o, list_distinct(regexp_extract_all(substr(html, 1, 900), 'href="([^"]+)"', 1)) AS k FROM pages)
SELECT page_id, unnest(list_filter(o, lambda x: NOT list_contains(k, x))) AS link FROM a""")
def u02_dropped_links(spark, folder):
    links = lambda c: F.regexp_extract_all(c, F.lit('href="([^"]+)"'), F.lit(1))
    return table(spark, folder, "pages").select("page_id", F.explode(F.array_except(links(F.col("html")), links(F.substring("html", 1, 900)))).alias("link"))


@query("""SELECT event_id, array_to_string(list_filter(json_keys(props), lambda k: k <> 'x'), ',') AS unknown FROM events""")
def u03_unknown_keys(spark, folder):
    keys = F.json_object_keys("props")
    return table(spark, folder, "events").select("event_id", F.array_join(F.array_except(keys, F.array(F.lit("x"))), ",").alias("unknown"))


@query("SELECT n, sha256(string_agg(t, '|' ORDER BY o)) AS joined FROM (SELECT item_id AS n, 0 AS o, text AS t FROM benchmark UNION ALL SELECT doc_id, 1, text FROM documents) WHERE t IS NOT NULL GROUP BY n")
def u04_union_of_texts(spark, folder):
    """Passage and document of one number joined, the passage first."""
    a = table(spark, folder, "benchmark").select(F.col("item_id").alias("n"), F.lit(0).alias("o"), F.col("text").alias("t"))
    b = table(spark, folder, "documents").select(F.col("doc_id").alias("n"), F.lit(1).alias("o"), F.col("text").alias("t"))
    own = a.unionByName(b).filter("t IS NOT NULL").groupBy("n").agg(F.array_sort(F.collect_list(F.struct("o", "t"))).alias("p"))
    return own.select("n", F.sha2(F.array_join(F.transform("p", lambda r: r["t"]), "|"), 256).alias("joined"))


@query(r"""WITH e AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages), x AS (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS i FROM e), f AS (SELECT page_id, link, min(i) AS i FROM x GROUP BY ALL)
SELECT page_id, string_agg(link, ' ' ORDER BY i) AS links FROM f GROUP BY page_id""")
def u05_ordered_distinct(spark, folder):
    own = table(spark, folder, "pages").select("page_id", F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("l"))
    return own.filter(F.size("l") > 0).select("page_id", F.array_join("l", " ").alias("links"))


@query("""WITH a AS (SELECT l_suppkey AS doc, NULLIF(l_returnflag, 'N') AS title, CASE WHEN l_linenumber > 2 THEN '' ELSE 'u' || l_linenumber END AS url FROM lineitem)
SELECT doc, coalesce(title, url) AS title, url, count(*) AS seen FROM (SELECT DISTINCT doc, title, url FROM a WHERE url <> '') GROUP BY ALL""")
def u06_annotations(spark, folder):
    """Distinct by (title, url) before a missing title becomes the url."""
    url = F.when(F.col("l_linenumber") > 2, "").otherwise(F.concat(F.lit("u"), F.col("l_linenumber").cast("string")))
    own = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("doc"), F.nullif("l_returnflag", F.lit("N")).alias("title"), url.alias("url"))
    return own.filter("url <> ''").distinct().groupBy("doc", F.coalesce("title", "url").alias("title"), "url").agg(F.count("*").alias("seen"))


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def u07_stale(spark, folder):
    return table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels"), "doc_id", "left_anti")


@query("SELECT count(DISTINCT c_nationkey) AS groups, count(*) AS keys FROM customer")
def u08_group_count(spark, folder):
    return table(spark, folder, "customer").agg(F.count_distinct("c_nationkey").alias("groups"), F.count("*").alias("keys"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1 AND count(*) = count(DISTINCT value)")
def u09_distinct_guard(spark, folder):
    own = table(spark, folder, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("value").alias("d"))
    return own.filter("n > 1 AND n = d").select("user_id", "n")
