"""Queries for joins and for filters and predicates (J, F)."""

from pyspark.sql import functions as F

from ..adapters import PAGES_SQL, REQUESTS_SQL, pages, requests
from ..functions import classify as C
from ..functions import text as X
from ..operators import joins as J
from ..operators import windows as W
from ..registry import query
from ..session import table


@query(f"""WITH {PAGES_SQL}, r AS (SELECT user_id + 1 AS number, arg_max(event_type, event_id) AS result FROM events GROUP BY ALL)
SELECT doc, number, coalesce(result IN ('click', 'view'), FALSE) AS completed FROM pg LEFT JOIN r USING (number)""")
def j01_pages_results(spark, folder):
    """The last result of a page counts; pages without one are not completed."""
    results = table(spark, folder, "events").select((F.col("user_id") + 1).alias("number"), "event_id", F.col("event_type").alias("result"))
    joined = J.with_latest(pages(spark, folder).select("doc", "number"), results, ["number"], "event_id")
    return joined.select("doc", "number", F.coalesce(F.col("result").isin("click", "view"), F.lit(False)).alias("completed"))


@query("""WITH m AS (SELECT p_partkey AS source, p_partkey + 100000 AS target FROM part WHERE p_size < 10), a AS (SELECT target FROM m WHERE target % 3 = 0)
SELECT l_orderkey, l_linenumber, coalesce(m.target, l_partkey) AS link, count(*) AS n FROM lineitem LEFT JOIN (SELECT m.* FROM m SEMI JOIN a USING (target)) m ON m.source = l_partkey GROUP BY ALL""")
def j02_mapped_links(spark, folder):
    mapping = table(spark, folder, "part").filter("p_size < 10").select(F.col("p_partkey").alias("source"), (F.col("p_partkey") + 100000).alias("target"))
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("link"))
    return J.mapped(rows, "link", mapping, mapping.filter("target % 3 = 0")).groupBy("l_orderkey", "l_linenumber", "link").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey FROM supplier SEMI JOIN lineitem ON l_suppkey = s_suppkey AND l_quantity > 49 UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0")
def j03_referenced_figures(spark, folder):
    own, used = table(spark, folder, "supplier"), table(spark, folder, "lineitem").filter("l_quantity > 49")
    kept = own.join(used, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select("s_suppkey")
    return kept.unionByName(own.filter("s_acctbal < 0").select("s_suppkey")).distinct()


@query("SELECT c_custkey, n_name AS bucket FROM customer JOIN nation ON n_nationkey = c_nationkey")
def j04_key_bucket(spark, folder):
    return table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("bucket"))


@query("""WITH k AS (SELECT n_regionkey AS r, n_name AS key, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation)
SELECT r, i::INT AS key_index, key, CASE WHEN r % 2 = 0 THEN 'key-' || i ELSE 'g' || (i % 2) END AS "group" FROM k""")
def j05_positional_zip(spark, folder):
    keys = table(spark, folder, "nation").groupBy(F.col("n_regionkey").alias("r")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("keys"))
    groups = F.when(F.col("r") % 2 == 0, F.array().cast("array<string>")).otherwise(F.transform("keys", lambda _, i: F.concat(F.lit("g"), ((i + 1) % 2).cast("string"))))
    return keys.select("r", F.explode(J.zipped(F.col("keys"), groups)).alias("z")).select("r", "z.*")


@query("SELECT c_custkey, coalesce(s_name, 'unresolved-key-' || c_custkey) AS project FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def j06_key_project(spark, folder):
    own = table(spark, folder, "customer").join(table(spark, folder, "supplier"), F.col("s_suppkey") == F.col("c_custkey"), "left")
    return own.select("c_custkey", F.coalesce("s_name", F.concat(F.lit("unresolved-key-"), F.col("c_custkey").cast("string"))).alias("project"))


@query(f"WITH {PAGES_SQL} SELECT pg.doc_id, item_id, b.text IS NOT NULL AS has_draft FROM pg LEFT JOIN benchmark b ON b.item_id = pg.number - 1 AND b.item_id % 5 <> 0")
def j07_drafts_by_page(spark, folder):
    drafts = table(spark, folder, "benchmark").filter("item_id % 5 <> 0").select("item_id", F.col("text").alias("draft"))
    own = pages(spark, folder).join(drafts, F.col("item_id") == F.col("number") - 1, "left")
    return own.select("doc_id", "item_id", F.col("draft").isNotNull().alias("has_draft"))


@query("""SELECT a.doc_id, b.doc_id AS previous, c.doc_id AS next FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id - 1 AND b.n_chars >= 200 LEFT JOIN documents c ON c.doc_id = a.doc_id + 1 AND c.n_chars >= 200""")
def j08_adjacent_pages(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "n_chars")
    full = d.filter("n_chars >= 200")
    before = full.select((F.col("doc_id") + 1).alias("doc_id"), F.col("doc_id").alias("previous"))
    after = full.select((F.col("doc_id") - 1).alias("doc_id"), F.col("doc_id").alias("next"))
    return d.select("doc_id").join(before, "doc_id", "left").join(after, "doc_id", "left")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (CASE WHEN d.n_chars > 1000 THEN 1 END) IS NOT DISTINCT FROM (CASE WHEN l.quality = 1 THEN 1 END))")
def j12_unsaved_parts(spark, folder):
    batch = table(spark, folder, "documents").select("doc_id", F.when(F.col("n_chars") > 1000, 1).alias("state"))
    saved = table(spark, folder, "labels").select("doc_id", F.when(F.col("quality") == 1, 1).alias("state"))
    return J.unsaved(batch, saved, ["doc_id", "state"]).select("doc_id")


@query("""SELECT o_custkey, count(*) AS matches FROM orders o WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber > 5) GROUP BY o_custkey HAVING count(*) > 1""")
def j13_new_runs(spark, folder):
    before = table(spark, folder, "lineitem").filter("l_linenumber > 5")
    new = table(spark, folder, "orders").filter("o_orderstatus = 'O'").join(before, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    return new.groupBy("o_custkey").agg(F.count("*").alias("matches")).filter("matches > 1")


@query("WITH h AS (SELECT s_suppkey, sha256(s_name) AS id FROM supplier), u AS (SELECT n_nationkey, sha256('Supplier#' || lpad(n_nationkey::VARCHAR, 9, '0')) AS id FROM nation) SELECT n_nationkey, s_suppkey FROM u JOIN h USING (id)")
def j14_credential_hash(spark, folder):
    known = table(spark, folder, "supplier").select("s_suppkey", F.sha2("s_name", 256).alias("id"))
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("n_nationkey").cast("string"), 9, "0"))
    return table(spark, folder, "nation").select("n_nationkey", F.sha2(name, 256).alias("id")).join(known, "id").select("n_nationkey", "s_suppkey")


_NORM = r"regexp_replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '[\t-\r \x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\\$*`{{}}]', '', 'g')"


@query(f"""WITH b AS (SELECT item_id, {_NORM.format(c='text')} AS anchor FROM benchmark), d AS (SELECT doc_id, {_NORM.format(c='text')} AS t FROM documents)
SELECT item_id, count(doc_id) AS n_docs, min(doc_id) AS first_doc FROM b LEFT JOIN d ON contains(t, anchor) GROUP BY item_id""")
def j15_anchor_matches(spark, folder):
    """Whole passages that a normalised text contains."""
    items = table(spark, folder, "benchmark")
    texts = table(spark, folder, "documents").select(F.col("doc_id").alias("text_id"), X.score_text(F.col("text")).alias("text"))
    hits = J.holding(texts, items.select(F.col("item_id").alias("anchor_id"), X.score_text(F.col("text")).alias("anchor"))).groupBy("anchor_id").agg(F.count("*").alias("n"), F.min("text_id").alias("first_doc"))
    return items.join(hits, F.col("anchor_id") == F.col("item_id"), "left").select("item_id", F.coalesce("n", F.lit(0)).alias("n_docs"), "first_doc")


_BOXES = "bx AS (SELECT event_id, user_id, event_type, value AS x0, value + 12 AS x1, (event_id % 97)::DOUBLE AS y0, (event_id % 97 + 5)::DOUBLE AS y1, event_type = 'view' AS panel FROM events)"


def _boxes(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.col("value").alias("x0"), (F.col("value") + 12).alias("x1"), (F.col("event_id") % 97).cast("double").alias("y0"), (F.col("event_id") % 97 + 5).cast("double").alias("y1"), (F.col("event_type") == "view").alias("panel")
    )


@query(f"""WITH {_BOXES}, l AS (SELECT a.event_id AS image, b.event_id AS label, row_number() OVER (PARTITION BY a.event_id ORDER BY b.event_id) AS r FROM bx a JOIN bx b ON a.user_id = b.user_id AND b.event_type = 'error' AND a.event_type = 'click'
AND b.y1 - b.y0 <= 40 AND a.x0 - 2 <= b.x0 AND b.x1 <= a.x1 + 2 AND a.y0 <= b.y0 AND b.y0 <= a.y1 + 25) SELECT image, label FROM l WHERE r = 1""")
def j16_image_labels(spark, folder):
    """The first label that lies within an image's sides and at or just below it."""
    b = _boxes(spark, folder)
    images, labels = b.filter("event_type = 'click'").alias("a"), b.filter("event_type = 'error'").alias("b")
    fits = (F.col("b.y1") - F.col("b.y0") <= 40) & (F.col("a.x0") - 2 <= F.col("b.x0")) & (F.col("b.x1") <= F.col("a.x1") + 2) & (F.col("a.y0") <= F.col("b.y0")) & (F.col("b.y0") <= F.col("a.y1") + 25)
    return images.join(labels, (F.col("a.user_id") == F.col("b.user_id")) & fits).groupBy(F.col("a.event_id").alias("image")).agg(F.min("b.event_id").alias("label"))


@query(f"""WITH {_BOXES} SELECT a.event_id AS a, b.event_id AS b FROM bx a JOIN bx b ON a.user_id = b.user_id AND a.event_id < b.event_id
WHERE (least(a.y1, b.y1) - greatest(a.y0, b.y0) >= 0.5::DOUBLE * least(a.y1 - a.y0, b.y1 - b.y0) AND greatest(a.x0 - b.x1, b.x0 - a.x1, 0) <= 0.08::DOUBLE * 100)
OR (a.panel AND b.panel AND least(a.x1, b.x1) - greatest(a.x0, b.x0) >= 0.5::DOUBLE * least(a.x1 - a.x0, b.x1 - b.x0) AND greatest(a.y0 - b.y1, b.y0 - a.y1, 0) <= 0.055::DOUBLE * 100)""")
def j17_near_boxes(spark, folder):
    b = _boxes(spark, folder)
    joined = b.alias("a").join(b.alias("b"), (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.event_id") < F.col("b.event_id")) & J.near("a", "b", F.lit(100.0), F.lit(100.0)))
    return joined.select(F.col("a.event_id").alias("a"), F.col("b.event_id").alias("b"))


@query(f"""WITH {_BOXES}, u AS (SELECT user_id, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1 FROM bx WHERE event_type = 'view' AND event_id % 3 = 0 GROUP BY user_id)
SELECT user_id FROM u WHERE NOT EXISTS (SELECT 1 FROM bx b WHERE b.user_id = u.user_id AND b.event_type = 'error' AND greatest(0, least(b.x1, u.x1) - greatest(b.x0, u.x0)) * greatest(0, least(b.y1, u.y1) - greatest(b.y0, u.y0)) > 0.2::DOUBLE * (b.x1 - b.x0) * (b.y1 - b.y0))""")
def j18_unblocked_unions(spark, folder):
    """Union boxes that cover no text block by more than a fifth."""
    b = _boxes(spark, folder)
    u = b.filter("event_type = 'view' AND event_id % 3 = 0").groupBy("user_id").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1")).alias("u")
    t = b.filter("event_type = 'error'").alias("t")
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(F.col(f"t.{hi}"), F.col(f"u.{hi}")) - F.greatest(F.col(f"t.{lo}"), F.col(f"u.{lo}")))
    covered = side("x0", "x1") * side("y0", "y1") > 0.2 * (F.col("t.x1") - F.col("t.x0")) * (F.col("t.y1") - F.col("t.y0"))
    return u.join(t, (F.col("u.user_id") == F.col("t.user_id")) & covered, "left_anti").select("user_id")


@query("SELECT a.o_orderkey AS job, c.c_name AS parent FROM orders a LEFT JOIN orders b ON b.o_orderkey = a.o_orderkey - 1 AND b.o_orderstatus IN ('F', 'O') LEFT JOIN customer c ON c.c_custkey = b.o_custkey")
def j19_parent_messages(spark, folder):
    o = table(spark, folder, "orders")
    parent = o.filter(F.col("o_orderstatus").isin("F", "O")).select((F.col("o_orderkey") + 1).alias("job"), "o_custkey")
    own = o.select(F.col("o_orderkey").alias("job")).join(parent, "job", "left")
    return own.join(table(spark, folder, "customer"), F.col("c_custkey") == F.col("o_custkey"), "left").select("job", F.col("c_name").alias("parent"))


@query("SELECT p_brand, list_contains(list([p_type, p_size::VARCHAR]), ['ECONOMY', '11']) AS has_row FROM part GROUP BY p_brand")
def j20_expected_rows(spark, folder):
    same = (F.col("p_type") == "ECONOMY") & (F.col("p_size").cast("string") == "11")
    return table(spark, folder, "part").groupBy("p_brand").agg(F.bool_or(F.coalesce(same, F.lit(False))).alias("has_row"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice > 2000.0::DOUBLE * (l_quantity + 1) AS heavy FROM lineitem")
def f02_heavy_segments(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") > 2000.0 * (F.col("l_quantity") + 1)).alias("heavy"))


@query(r"""WITH n AS (SELECT doc_id, trim(substr(text, 1, 10 + (doc_id % 140)::INT), E' \n\t\r') AS n FROM documents)
SELECT doc_id, NOT (n = '' OR length(n) > 120 OR strlen(n) > 240 OR starts_with(n, '.') OR regexp_matches(lower(n), '\.(md|zip)$') OR regexp_matches(n, '[<>:"/\\|?*\x00-\x1f\x7f]') OR regexp_matches(n, '[. ]$')
OR regexp_matches(n, '(?i)^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])(\.|$)')) AS valid FROM n""")
def f03_output_names(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.valid_name(F.expr("substring(text, 1, 10 + CAST(doc_id % 140 AS INT))")).alias("valid"))


@query("SELECT event_id, event_type NOT IN ('error', 'signup') AS retryable FROM events")
def f04_retryable(spark, folder):
    return table(spark, folder, "events").select("event_id", (~F.col("event_type").isin("error", "signup")).alias("retryable"))


@query("""WITH u AS (SELECT c_nationkey AS bucket, count(o_orderkey) AS used, bool_or(c_acctbal > 0) AS any_key FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) SELECT bucket FROM u WHERE bucket % 7 <> 0 AND used < 700 AND any_key""")
def f05_live_buckets(spark, folder):
    used = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    own = table(spark, folder, "customer").join(used, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy(F.col("c_nationkey").alias("bucket"))
    return own.agg(F.sum(F.coalesce("n", F.lit(0))).alias("used"), F.bool_or(F.col("c_acctbal") > 0).alias("any")).filter("bucket % 7 <> 0 AND used < 700 AND any").select("bucket")


@query("SELECT s_suppkey FROM supplier WHERE greatest(s_acctbal, (s_suppkey * 37 % 9000)::DOUBLE) <= 5000")
def f06_ready(spark, folder):
    return table(spark, folder, "supplier").filter(F.greatest(F.col("s_acctbal"), (F.col("s_suppkey") * 37 % 9000).cast("double")) <= 5000).select("s_suppkey")


@query(f"WITH {PAGES_SQL} SELECT doc, number FROM pg WHERE status IN ('ok', 'blank')")
def f08_completed(spark, folder):
    return pages(spark, folder).filter(F.col("status").isin("ok", "blank")).select("doc", "number")


@query("SELECT o_orderkey, o_orderpriority = '1-URGENT' OR (o_orderkey % 5 = 0) OR (o_orderkey % 7 <> 0 AND o_orderkey <> o_custkey) AS continuation FROM orders")
def f09_continuation_jobs(spark, folder):
    history = F.when(F.col("o_orderpriority") == "1-URGENT", "x")
    parent = F.when(F.col("o_orderkey") % 5 == 0, " p ").otherwise(" ")
    root = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("string")).otherwise("")
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return table(spark, folder, "orders").select("o_orderkey", (has(history) | has(parent) | (has(root) & (root != F.col("o_orderkey").cast("string")))).alias("continuation"))


@query(None)
def f10_project_tasks(spark, folder):
    """Texts that speak of a repository (look-behind, which the oracle's regex lacks)."""
    words = r"(?i)github|\bgit\b|\bgh\b|repo(?:sitory)?|codebase|项目|仓库|代码库|分支|部署|推送|重构"
    name = r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+"
    return table(spark, folder, "documents").select("doc_id", (F.col("text").rlike(words) | F.col("text").rlike(name)).alias("project"))


@query(r"SELECT doc_id, regexp_matches(text, '(?i)(?:push|redeploy|refactor|implement|commit)') AS writes FROM documents")
def f11_write_tasks(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.col("text").rlike(r"(?i)(?:push|redeploy|refactor|implement|commit)").alias("writes"))


@query("SELECT p_partkey, lower(p_name) = 'small ring' OR starts_with(lower(p_name), 'small ') AS agent FROM part")
def f12_agent_models(spark, folder):
    name = F.lower("p_name")
    return table(spark, folder, "part").select("p_partkey", ((name == "small ring") | F.startswith(name, F.lit("small "))).alias("agent"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(url, '/[a-z]{2}/[^\s"'']+\?page') THEN 'deny' ELSE 'allow' END AS decision FROM pages""")
def f13_dispatch_gate(spark, folder):
    return table(spark, folder, "pages").select("page_id", F.when(F.col("url").rlike(r"""/[a-z]{2}/[^\s"']+\?page"""), "deny").otherwise("allow").alias("decision"))


@query(f"WITH {REQUESTS_SQL} SELECT seq FROM rq WHERE status = 429 AND event_type = 'error' AND seconds < 20")
def f14_precondition_errors(spark, folder):
    return requests(spark, folder).filter((F.col("status") == 429) & (F.col("event_type") == "error") & (F.col("seconds") < 20)).select("seq")


@query("SELECT event_id FROM events WHERE event_id BETWEEN 0 AND 9999 AND event_id < 100000")
def f15_index_bounds(spark, folder):
    return table(spark, folder, "events").filter("event_id >= 0 AND event_id < 10000").select("event_id")


@query(f"WITH {REQUESTS_SQL} SELECT seq FROM rq WHERE (event_type || '_error') LIKE 'error%' OR event_type LIKE '%up' OR (event_type = 'purchase' AND status >= 400)")
def f16_log_levels(spark, folder):
    kind = F.col("event_type")
    return requests(spark, folder).filter(F.startswith(kind, F.lit("error")) | F.endswith(kind, F.lit("up")) | ((kind == "purchase") & (F.col("status") >= 400))).select("seq")


@query("SELECT doc_id, floor(n_chars * 700 * 4 / 3)::BIGINT + strlen(text) + 65536 AS bytes, floor(n_chars * 700 * 4 / 3)::BIGINT + strlen(text) + 65536 > 18 * 1048576 AS too_large FROM documents")
def f19_request_size(spark, folder):
    size = C.request_bytes(F.col("n_chars") * 700, F.col("text"))
    return table(spark, folder, "documents").select("doc_id", size.alias("bytes"), (size > 18 * 1048576).alias("too_large"))


@query(f"WITH {REQUESTS_SQL}, s AS (SELECT seq, bucket, avg(CASE WHEN status IN (429, 503) THEN 1.0::DOUBLE ELSE 0 END) OVER (PARTITION BY bucket ORDER BY seq ROWS 19 PRECEDING) AS share FROM rq) SELECT bucket, arg_max(share, seq) < 0.2 AS hedge FROM s GROUP BY bucket")
def f20_hedge_predicate(spark, folder):
    shares = W.rolling_share(requests(spark, folder), ["bucket"], "seq", F.col("status").isin(429, 503))
    return shares.groupBy("bucket").agg((F.max_by("share", "seq") < 0.2).alias("hedge"))


@query("SELECT event_id, CASE WHEN list_contains(json_keys(props), 'k') THEN substr((props::JSON ->> 'k'), 1, 200) END AS k FROM events")
def f21_allowed_fields(spark, folder):
    return table(spark, folder, "events").select("event_id", F.left(F.get_json_object("props", "$.k"), F.lit(200)).alias("k"))


@query("""WITH s AS (SELECT page_id, 'h' || (page_id % 5) AS host, page_id * 1000003 % 300000000 AS size, page_id % 2 = 0 AS relay FROM pages)
SELECT page_id, CASE WHEN relay AND host IN ('h1', 'h2') THEN 'relay' WHEN relay AND size > 40000000 THEN 'relay' WHEN size > 200000000 THEN 'no_link' ELSE 'link' END AS route FROM s""")
def f22_link_routing(spark, folder):
    n = F.col("page_id")
    route = C.link_route(F.concat(F.lit("h"), (n % 5).cast("string")), n * 1000003 % 300000000, n % 2 == 0, ["h1", "h2"])
    return table(spark, folder, "pages").select("page_id", route.alias("route"))


@query("SELECT doc_id, least(300.0::DOUBLE, greatest(60.0::DOUBLE, 30.0::DOUBLE + n_chars * 20000 / 1e6::DOUBLE)) AS seconds FROM documents")
def f23_submit_timeout(spark, folder):
    return table(spark, folder, "documents").select("doc_id", C.submit_timeout(F.col("n_chars") * 20000).alias("seconds"))
