"""Queries for scalar functions, redaction, classification and numeric rules (X, R, C, M), sources and sinks (S, K), and the rest (V)."""

from pyspark.sql import functions as F

from ..adapters import PAGES_SQL, REQUESTS_SQL, pages, requests
from ..functions import classify as C
from ..functions import redaction as R
from ..functions import text as X
from ..registry import query
from ..session import table

WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = r"[^\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(c):
    return f"regexp_replace(regexp_replace({c}, '^{WS}+', ''), '{WS}+$', '')"


@query(r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', '<br />', 'g'), '(?i)(<(?:table|td|th)\b[^>]*?)\s+border\s*=\s*(?:"\d+"|\d+)', '\1', 'g') AS t FROM pages) SELECT page_id, sha256(t) AS cleaned FROM a""")
def x01_table_tags(spark, folder):
    """The single-pass rules of the layout cleanup; pages hold no wrapper that the others would take off."""
    return table(spark, folder, "pages").select("page_id", F.sha2(X.clean_layout(F.col("html")), 256).alias("cleaned"))


@query(None)
def x06_output_faults(spark, folder):
    """Rejection reasons; back-references have no SQL form in the oracle."""
    return table(spark, folder, "documents").select("doc_id", X.fault(F.col("text")).alias("fault"))


@query(r"""WITH n AS (SELECT doc_id, list_filter(string_split(replace(text, E'\r', E'\n'), E'\n'), lambda x: regexp_full_match(x, '\s*[0-9]{4,8}\s*')) AS l FROM documents)
SELECT doc_id, CASE WHEN contains(text, '�') THEN 'replacement' WHEN length(text) > 30000 THEN 'too_long' WHEN contains(text, '此行视具体排版') THEN 'commentary' WHEN len(l) >= 3 AND len(l) >= 3 * len(list_distinct(l)) THEN 'numbers' END AS fault
FROM documents JOIN n USING (doc_id)""")
def x06_faults_without_repeats(spark, folder):
    own = X.fault(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", F.when(own != "repeats", own).when(F.length("text") > X.MOST_CHARS, "too_long").alias("fault"))


@query(r"""WITH f AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '~~~markdown' || text || '~~~' WHEN 1 THEN '```markdown' || text || '```' WHEN 2 THEN '```md' || text || '```' ELSE text END AS t, text FROM documents)
SELECT doc_id, sha256(CASE WHEN doc_id % 4 = 3 THEN text ELSE """ + _strip("text") + r""" END) AS body FROM f""")
def x07_fences(spark, folder):
    n = F.col("doc_id") % 4
    t = F.when(n == 0, F.concat(F.lit("~~~markdown"), "text", F.lit("~~~"))).when(n == 1, F.concat(F.lit("```markdown"), "text", F.lit("```"))).when(n == 2, F.concat(F.lit("```md"), "text", F.lit("```"))).otherwise(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", t.alias("t")).select("doc_id", F.sha2(X.without_fences(F.col("t")), 256).alias("body"))


@query(r"""WITH t AS (SELECT page_id, replace(replace(html, '<a href="/', '![x](images/'), '">', ') ') AS t FROM pages), e AS (SELECT page_id, regexp_extract_all(t, '!\[[^\]\n]*\]\((images/[^)\s]+)\)', 1) AS l FROM t),
u AS (SELECT page_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM e), f AS (SELECT page_id, x, min(i) AS i FROM u GROUP BY ALL) SELECT page_id, string_agg(x, ' ' ORDER BY i) AS figures FROM f GROUP BY page_id""")
def x08_figures_used(spark, folder):
    t = F.replace(F.replace(F.col("html"), F.lit('<a href="/'), F.lit("![x](images/")), F.lit('">'), F.lit(") "))
    own = table(spark, folder, "pages").select("page_id", X.figures_used(t).alias("l"))
    return own.filter(F.size("l") > 0).select("page_id", F.array_join("l", " ").alias("figures"))


@query(rf"SELECT doc_id, sha256(regexp_replace({_strip(f'regexp_replace(text, {chr(39)}{WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '([\\`*_{{}}\[\]<>()!#|])', '\\\1', 'g')) AS escaped FROM documents")
def x09_escape(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(X.escaped(F.col("text")), 256).alias("escaped"))


@query("SELECT page_id, sha256(replace(html, '](images/', '](../images/')) AS body FROM pages")
def x11_page_links(spark, folder):
    return table(spark, folder, "pages").select("page_id", F.sha2(X.page_links(F.col("html")), 256).alias("body"))


@query(rf"SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '<[^>]+>', '', 'g'), '[\t-\r \x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\\$*`{{}}]', '', 'g')) AS t FROM documents")
def x13_score_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(X.score_text(F.col("text")), 256).alias("t"))


@query(rf"SELECT doc_id, sha256(regexp_replace(replace(replace(text, '\left', ''), '\right', ''), '[\t-\r \x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}{{}}$]', '', 'g')) AS t FROM documents")
def x14_formula_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(X.formula_text(F.col("text")), 256).alias("t"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, E'\n')) AS line, generate_subscripts(string_split(text, E'\n'), 1) AS i FROM documents WHERE contains(text, ' | '))
SELECT doc_id, i::INT AS i, list_transform(string_split(line, '|'), lambda c: trim(c))[1] AS first, len(string_split(line, '|'))::INT AS cells FROM l WHERE contains(line, '|')""")
def x15_pipe_rows(spark, folder):
    """Rows of pipe tables; a separator line counts as a row."""
    lines = table(spark, folder, "documents").filter(F.contains("text", F.lit(" | "))).select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).filter(F.contains("line", F.lit("|")))
    cells = F.split("line", r"\|")
    return lines.select("doc_id", (F.col("i") + 1).alias("i"), F.trim(cells[0]).alias("first"), F.size(cells).alias("cells"))


@query(rf"""WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN text || E'\n<!-- aw:images:["u"] -->' ELSE text END AS t FROM conversations)
SELECT conv_id, turn, sha256({_strip("regexp_replace(t, '(?s)" + chr(92) + "n?<!--" + chr(92) + "s*aw:images:(" + chr(92) + "[.*?" + chr(92) + "])" + chr(92) + "s*-->', '', 'g')")}) AS t FROM t""")
def x16_image_marks(spark, folder):
    t = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit('\n<!-- aw:images:["u"] -->'))).otherwise(F.col("text"))
    return table(spark, folder, "conversations").select("conv_id", "turn", F.sha2(X.without_image_list(t), 256).alias("t"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/webp' WHEN 2 THEN CASE WHEN page_id % 3 = 0 THEN 'image/gif' ELSE 'image/png' END ELSE 'image/png' END AS mime FROM pages""")
def x18_image_mime(spark, folder):
    n = F.col("page_id")
    kind = F.when(n % 4 == 0, " image/JPG; q=1").when(n % 4 == 1, "image/webp").otherwise("text/html")
    ending = F.when((n % 4 == 2) & (n % 3 == 0), ".GIF").when(n % 4 == 2, ".png").otherwise("")
    url = F.concat(F.lit("http://x/y"), ending, F.lit("?a=b.jpg#c"))
    return table(spark, folder, "pages").select("page_id", X.image_mime(url, kind).alias("mime"))


@query(rf"""WITH f AS (SELECT item_id, {_strip("string_split(text, E'" + chr(92) + "n')[1]")} AS l FROM benchmark), c AS (SELECT item_id, regexp_replace(regexp_replace(l, '^[#*\-\s"]+', ''), '[#*\-\s".,!?:]+$', '') AS t FROM f)
SELECT item_id, rtrim(substr(regexp_replace(t, '\s+', ' ', 'g'), 1, 24)) AS title FROM c""")
def x19_titles(spark, folder):
    return table(spark, folder, "benchmark").select("item_id", X.title(F.col("text")).alias("title"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'none' WHEN n_nationkey % 3 = 1 THEN n_name ELSE n_name || E'\n\nx' END AS prompt FROM nation")
def x22_prompt(spark, folder):
    n = F.col("n_nationkey") % 3
    first, second = F.when(n == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "n_name")), F.when(n == 2, F.lit("x"))
    return table(spark, folder, "nation").select("n_nationkey", X.composed(first, second, default="none").alias("prompt"))


@query("SELECT doc_id, CASE WHEN length(doc_id::VARCHAR) >= 3 THEN doc_id::VARCHAR ELSE lpad(doc_id::VARCHAR, 3, '0') END AS stem FROM documents")
def x23_stems(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.stem(F.col("doc_id"), F.lit(99)).alias("stem"))


@query(r"SELECT doc_id, sha256(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')) AS t FROM documents")
def x25_controls(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(X.without_controls(F.col("text")), 256).alias("t"))


_REDACT = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\b(?:gh[pousr]_[A-Za-z0-9_]+|github_pat_[A-Za-z0-9_]+|AIza[A-Za-z0-9_-]{20,})', '[REDACTED]', 'g'),
'(?i)(\b(?:Bearer|Basic)\s+)[A-Za-z0-9._~+/=-]+', '\1[REDACTED]', 'g'), '(?i)((?:password|authorization|api[_-]?key|access[_-]?token|token|secret)["'']?\s*[:=]\s*["'']?)[^\s,"'';&}]+', '\1[REDACTED]', 'g'), '(https?://)[^/@\s]+:[^/@\s]+@', '\1[REDACTED]@', 'g')"""


@query(f"SELECT doc_id, sha256({_REDACT}) AS t, {_REDACT} <> text AS changed FROM documents")
def r01_redaction(spark, folder):
    safe = R.redact(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", F.sha2(safe, 256).alias("t"), (safe != F.col("text")).alias("changed"))


@query("SELECT doc_id, substr(replace(replace(text, 'token', '[REDACTED]'), 'the', '[REDACTED]'), 1, 500) AS t FROM documents")
def r05_key_literals(spark, folder):
    return table(spark, folder, "documents").select("doc_id", R.redact_keys(F.col("text"), ["token", "the"]).alias("t"))


@query(f"""WITH r AS (SELECT doc_id, {_REDACT} AS t FROM documents), n AS (SELECT *, greatest(1, ceil(length(t) / 4000.0::DOUBLE))::INT AS parts FROM r), p AS (SELECT *, unnest(range(1, parts + 1)) AS part FROM n)
SELECT doc_id, part::INT AS part, parts, sha256(substr(t, ((part - 1) * 4000 + 1)::BIGINT, 4000)) AS chunk FROM p""")
def k12_log_chunks(spark, folder):
    own = table(spark, folder, "documents").select("doc_id", F.explode(R.log_chunks(F.col("text"))).alias("c"))
    return own.select("doc_id", "c.part", "c.parts", F.sha2("c.chunk", 256).alias("chunk"))


def _words():
    n = F.col("event_id") % 6
    return F.when(n == 0, "GenerateRequestsPerDay").when(n == 1, "tokens per minute").when(n == 2, "Requests-Per-Minute").when(n == 3, "monthly spending cap").when(n == 4, "rate limit reached").otherwise("Invalid API key")


_CASES = "SELECT event_id, CASE event_id % 6 WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN {2} WHEN 3 THEN {3} WHEN 4 THEN {4} ELSE {5} END AS kind FROM events"


@query(_CASES.format("'rpd'", "'tpm'", "'rpm'", "'spend'", "'unknown'", "'unknown'"))
def c01_quota_class(spark, folder):
    return table(spark, folder, "events").select("event_id", C.quota_class(_words()).alias("kind"))


@query(_CASES.format("'unknown'", "'rpm'", "'rpm'", "'unknown'", "'rpm'", "'unknown'"))
def c05_gateway_quota(spark, folder):
    return table(spark, folder, "events").select("event_id", C.gateway_quota(_words()).alias("kind"))


_STATUS = "s AS (SELECT event_id, [200, 400, 401, 402, 403, 404, 405, 408, 422, 429, 500, 503, 504][(event_id % 13 + 1)::INT] AS status, [0, 500, 401, 12001, 10002, 10010, 504][(event_id % 7 + 1)::INT] AS code FROM events)"


def _status():
    pick = lambda xs, n: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("event_id") % n + 1).cast("int"))
    return pick((200, 400, 401, 402, 403, 404, 405, 408, 422, 429, 500, 503, 504), 13), pick((0, 500, 401, 12001, 10002, 10010, 504), 7)


@query(f"WITH {_STATUS} SELECT event_id, CASE WHEN status = 429 THEN 'rate_limited' WHEN status IN (400, 401, 402, 403, 405, 422) THEN 'permanent' WHEN status = 404 OR status BETWEEN 500 AND 599 THEN 'unavailable' ELSE 'retryable' END AS kind FROM s")
def c03_status_kind(spark, folder):
    return table(spark, folder, "events").select("event_id", C.status_kind(_status()[0]).alias("kind"))


@query(f"WITH {_STATUS} SELECT event_id, CASE WHEN status = 402 THEN 'bucket' WHEN status IN (401, 403) THEN 'key' WHEN status = 400 AND event_id % 6 = 5 THEN 'key' END AS scope FROM s")
def c04_credential_scope(spark, folder):
    return table(spark, folder, "events").select("event_id", C.credential_scope(_status()[0], _words()).alias("scope"))


@query(f"""WITH {_STATUS} SELECT event_id, CASE WHEN code IN (401, 12001) OR status IN (401, 403) THEN 'fatal' WHEN code IN (10002, 10004, 10005) THEN 'rejected' WHEN status IN (408, 504) OR code IN (408, 504) THEN 'timeout'
WHEN code IN (10010, 12002, 500) OR status = 429 OR status >= 500 THEN 'retryable' WHEN status <> 200 OR code <> 0 THEN 'other' ELSE 'ok' END AS kind FROM s""")
def c06_ocr_class(spark, folder):
    return table(spark, folder, "events").select("event_id", C.ocr_class(*_status()).alias("kind"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN '404' WHEN 1 THEN 'RESOURCE_EXHAUSTED' ELSE 'UNKNOWN' END AS code FROM events")
def c11_error_codes(spark, folder):
    n = F.col("event_id") % 4
    return table(spark, folder, "events").select("event_id", C.error_code(F.when(n == 0, "404").when(n == 1, "resource_exhausted").when(n == 2, "no such thing")).alias("code"))


@query(r"SELECT event_id, json_valid(CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN props || '}' ELSE '[1' END) AS valid FROM events")
def c12_structured_output(spark, folder):
    n = F.col("event_id") % 3
    raw = F.when(n == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(n == 1, F.concat("props", F.lit("}"))).otherwise(F.lit("[1"))
    bare = F.regexp_replace(X.strip(raw), r"(?s)^```(?:json)?\s*(.*?)\s*```$", "$1")
    one = F.size(F.from_json(F.concat(F.lit("["), bare, F.lit("]")), "array<variant>")) == 1  # nothing may follow the value
    ok = one & bare.rlike(r"^[\[{]") & (F.octet_length(bare) <= 262144)
    return table(spark, folder, "events").select("event_id", F.coalesce(ok, F.lit(False)).alias("valid"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 'off' WHEN 'click' THEN 'high' ELSE event_type END AS level FROM events")
def c14_thinking_level(spark, folder):
    raw = F.when(F.col("event_type") == "view", " None ").when(F.col("event_type") == "click", "MAX").otherwise(F.col("event_type"))
    return table(spark, folder, "events").select("event_id", C.alias(F.lower(F.trim(raw)), C.THINKING).alias("level"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 'low' WHEN 'click' THEN 'high' WHEN 'error' THEN '' END AS effort FROM events")
def c15_reasoning_effort(spark, folder):
    raw = F.when(F.col("event_type") == "view", "Minimal").when(F.col("event_type") == "click", "high").when(F.col("event_type") == "error", "unspecified").otherwise("?")
    value = F.lower(F.trim(raw))
    return table(spark, folder, "events").select("event_id", F.when(value.isin("", "unspecified"), "").otherwise(C.alias(value, C.EFFORT, F.lit(None))).alias("effort"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS detail FROM events")
def c17_image_detail(spark, folder):
    n = F.col("event_id") % 3
    return table(spark, folder, "events").select("event_id", C.image_detail(F.when(n == 0, "MEDIA_RESOLUTION_LOW").when(n == 1, "MEDIA_RESOLUTION_MEDIUM").otherwise("UNSPECIFIED")).alias("detail"))


@query("SELECT event_id, greatest(0.0::DOUBLE, epoch(TIMESTAMP '2024-06-01') - epoch(ts)) AS seconds FROM events")
def m01_queue_seconds(spark, folder):
    micros = F.unix_micros(F.try_to_timestamp(F.col("ts").cast("string")))
    seconds = (F.unix_micros(F.lit("2024-06-01").cast("timestamp")) - micros) / 1e6
    return table(spark, folder, "events").select("event_id", F.greatest(F.lit(0.0), seconds).alias("seconds"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS iso FROM events")
def m02_iso_format(spark, folder):
    return table(spark, folder, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00")).alias("iso"))


@query("SELECT n_nationkey, least(60.0::DOUBLE, 5.0::DOUBLE * 2.0::DOUBLE ** (n_nationkey % 8 - 2)) AS base FROM nation")
def m03_retry_delay(spark, folder):
    return table(spark, folder, "nation").select("n_nationkey", C.retry_base(F.col("n_nationkey") % 8).alias("base"))


@query("SELECT n_nationkey, least(300.0::DOUBLE, 20.0::DOUBLE * 2.0::DOUBLE ** least(4, n_nationkey)) AS seconds FROM nation")
def m04_backoff(spark, folder):
    return table(spark, folder, "nation").select("n_nationkey", C.backoff(F.col("n_nationkey") + 1).alias("seconds"))


@query(f"WITH {PAGES_SQL}, p AS (SELECT doc, min(number) AS a, max(number) AS b FROM pg GROUP BY doc), s AS (SELECT *, unnest(range(a, b + 1, 6)) AS first FROM p) SELECT doc, first, least(b, first + 5) AS last FROM s")
def m06_segments(spark, folder):
    from ..plans.segments import segments

    return segments(pages(spark, folder).groupBy("doc").agg(F.min("number").alias("first"), F.max("number").alias("last")), 6)


@query(f"""WITH {PAGES_SQL}, p AS (SELECT doc, max(number) AS b FROM pg GROUP BY doc), f AS (SELECT doc, b, unnest([1, 6, 16]) AS first, unnest([5, 15, 30]) AS fixed FROM p),
t AS (SELECT doc, b, unnest(range(31, b + 1, 20)) AS first FROM p) SELECT doc, first::BIGINT AS first, least(b, fixed)::BIGINT AS last FROM f WHERE first <= b UNION ALL SELECT doc, first, least(b, first + 19) FROM t""")
def m07_ramp_segments(spark, folder):
    from ..plans.segments import ramp

    return ramp(pages(spark, folder).groupBy("doc").agg(F.min("number").alias("first"), F.max("number").alias("last")), 20)


@query(f"""WITH RECURSIVE {PAGES_SQL}, p AS (SELECT doc, 1::BIGINT AS first, max(number) AS last FROM pg GROUP BY doc),
h AS (SELECT * FROM p UNION ALL SELECT doc, CASE side WHEN 0 THEN first ELSE (first + last) // 2 + 1 END, CASE side WHEN 0 THEN (first + last) // 2 ELSE last END FROM h, (VALUES (0), (1)) s(side) WHERE last - first + 1 > 7)
SELECT doc, first, last FROM h WHERE last - first + 1 <= 7""")
def m08_halving(spark, folder):
    from ..plans.segments import halved

    return halved(pages(spark, folder).groupBy("doc").agg(F.min("number").alias("first"), F.max("number").alias("last")), 7)


@query(f"WITH {PAGES_SQL}, c AS (SELECT doc, count(*) AS n FROM pg GROUP BY doc) SELECT doc, greatest(2, ceil(n * 0.1::DOUBLE))::BIGINT AS budget, greatest(12.0::DOUBLE, 2 * (n / 10.0::DOUBLE)) AS delay FROM c")
def m09_hedging(spark, folder):
    c = pages(spark, folder).groupBy("doc").agg(F.count("*").alias("n"))
    return c.select("doc", C.hedge_budget(F.col("n")).alias("budget"), C.hedge_delay(F.lit(12.0), F.col("n") / 10.0).alias("delay"))


@query(f"WITH {PAGES_SQL} SELECT doc, ceil(count(*) / 3.0::DOUBLE)::BIGINT AS batches FROM pg GROUP BY doc")
def m10_batches(spark, folder):
    return pages(spark, folder).groupBy("doc").agg(F.ceil(F.count("*") / 3.0).alias("batches"))


@query("SELECT event_id, (props::JSON ->> 'k')::BIGINT AS total FROM events WHERE (props::JSON ->> 'k')::BIGINT >= 0")
def m11_usage_rename(spark, folder):
    counters = F.map_filter(F.from_json("props", "map<string,bigint>"), lambda _, v: v >= 0)
    renamed = F.transform_keys(counters, lambda k, _: F.when(k == "k", "total").otherwise(k))
    return table(spark, folder, "events").select("event_id", F.try_element_at(renamed, F.lit("total")).alias("total")).filter("total IS NOT NULL")


@query("SELECT c_nationkey AS g, min(c_acctbal) - 1 AS x0, max(c_acctbal) + 1 AS x1, greatest(0, least(max(c_acctbal) + 1, 9000)) AS clipped FROM customer GROUP BY 1")
def m12_rectangles(spark, folder):
    own = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("g")).agg((F.min("c_acctbal") - 1).alias("x0"), (F.max("c_acctbal") + 1).alias("x1"))
    return own.withColumn("clipped", F.greatest(F.lit(0.0), F.least(F.col("x1"), F.lit(9000.0))))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def m13_sha256(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("SELECT p_type AS k, count(*) AS n FROM part GROUP BY 1")
def m14_map_counter(spark, folder):
    return table(spark, folder, "part").groupBy(F.col("p_type").alias("k")).agg(F.count("*").alias("n"))


@query("WITH b AS (SELECT p_partkey, unnest(range(0, p_size * 1000 + 1, 16384)) AS start, p_size * 1000 + 1 AS total FROM part) SELECT p_partkey, start, least(total, start + 16384) - 1 AS last FROM b")
def s06_range_blocks(spark, folder):
    from ..sources.ranges import blocks

    return blocks(table(spark, folder, "part").select("p_partkey", (F.col("p_size") * 1000 + 1).alias("total")), "total", 16384).select("p_partkey", F.col("start").cast("long").alias("start"), F.col("last").cast("long").alias("last"))


@query("SELECT page_id, regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) AS host, regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) LIKE '%.example.com' OR regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) = 'example.com' AS ours FROM pages")
def s07_host_predicate(spark, folder):
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    return table(spark, folder, "pages").select("page_id", host.alias("host"), ((host == "example.com") | F.endswith(host, F.lit(".example.com"))).alias("ours"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
def s10_filtered_list(spark, folder):
    return table(spark, folder, "orders").filter("o_orderstatus = 'P'").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50).select("o_orderkey", "o_orderdate")


@query(r"""WITH i AS (SELECT item_id, regexp_split_to_array(text, '[\r\n,;]+') AS l FROM benchmark), u AS (SELECT item_id, trim(unnest(l)) AS x, generate_subscripts(l, 1) AS n FROM i), f AS (SELECT item_id, x, min(n) AS n FROM u WHERE x <> '' GROUP BY ALL)
SELECT item_id, string_agg(x, '|' ORDER BY n) AS items FROM f GROUP BY item_id""")
def s16_list_setting(spark, folder):
    return table(spark, folder, "benchmark").select("item_id", F.array_join(X.items(F.col("text")), "|").alias("items"))


@query(r"""WITH i AS (SELECT item_id, regexp_split_to_array(text, '[,;\s]+') AS l FROM benchmark), u AS (SELECT item_id, unnest(l) AS x, generate_subscripts(l, 1) AS n FROM i), f AS (SELECT item_id, x, min(n) AS n FROM u WHERE x <> '' GROUP BY ALL)
SELECT item_id, string_agg(x, '|' ORDER BY n) AS items FROM f GROUP BY item_id""")
def s17_model_list(spark, folder):
    return table(spark, folder, "benchmark").select("item_id", F.array_join(X.items(F.col("text"), r"(?U)[,;\s]+"), "|").alias("items"))


@query(f"""WITH {PAGES_SQL}, c AS (SELECT doc, count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'blank') AS blank, count(*) FILTER (status = 'failed') AS failed FROM pg GROUP BY doc)
SELECT doc, 'completed' AS metric, (ok + blank) || '/' || total AS result FROM c UNION ALL SELECT doc, 'successful / blank / failed', ok || ' / ' || blank || ' / ' || failed FROM c""")
def k06_summary_table(spark, folder):
    from ..sources.sinks import summary_rows

    return summary_rows(pages(spark, folder), "doc")


@query("SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1 EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'")
def k09_verified_write(spark, folder):
    """What a re-read of the target doesn't hold as it was written."""
    batch = table(spark, folder, "lineitem").filter("l_linenumber = 1").select("l_orderkey").distinct()
    return batch.join(table(spark, folder, "orders").filter("o_orderstatus <> 'P'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query(f"WITH {REQUESTS_SQL} SELECT seq, CASE WHEN event_type = 'error' AND seconds > 50 THEN 'blocked' WHEN event_type = 'error' AND seconds > 20 THEN 'permanent' ELSE 'empty' END AS error FROM rq WHERE event_type = 'error'")
def v03_refusals(spark, folder):
    own = requests(spark, folder).filter("event_type = 'error'")
    return own.select("seq", F.when(F.col("seconds") > 50, "blocked").when(F.col("seconds") > 20, "permanent").otherwise("empty").alias("error"))


@query("SELECT c_custkey, coalesce(NULLIF(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END), ''), 'default') AS model FROM customer")
def v05_fast_model(spark, folder):
    raw = F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_mktsegment"))
    return table(spark, folder, "customer").select("c_custkey", F.coalesce(F.nullif(F.trim(raw), F.lit("")), F.lit("default")).alias("model"))


@query("SELECT event_id, CASE WHEN value BETWEEN 15 AND 3600 AND event_id % 4 <> 0 THEN value ELSE 120.0 END AS seconds FROM events")
def v06_summary_interval(spark, folder):
    raw = F.when(F.col("event_id") % 4 == 0, "soon").otherwise(F.col("value").cast("string"))
    return table(spark, folder, "events").select("event_id", C.summary_interval(raw).alias("seconds"))


@query("SELECT conv_id FROM conversations WHERE turn = 0 AND role = 'user' AND length(text) > 0 AND conv_id % 4 <> 0")
def v07_title_eligible(spark, folder):
    own = table(spark, folder, "conversations").filter((F.col("turn") == 0) & (F.col("role") == "user") & (X.strip(F.col("text")) != ""))
    return own.filter(F.col("conv_id") % 4 != 0).select("conv_id")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props ELSE '{}' END AS state FROM events")
def v09_provider_state(spark, folder):
    n = F.col("event_id") % 3
    raw = F.when(n == 0, F.col("props")).when(n == 1, "[1]").otherwise("{")
    parsed = F.try_parse_json(raw)
    ok = F.coalesce(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), F.lit(False))
    return table(spark, folder, "events").select("event_id", F.when(ok, raw).otherwise("{}").alias("state"))


@query("SELECT s_name, to_base64(encode('x-oauth-basic:' || s_name)) AS form FROM supplier")
def v13_secret_forms(spark, folder):
    return table(spark, folder, "supplier").select("s_name", F.base64(F.encode(F.concat(F.lit("x-oauth-basic:"), "s_name"), "UTF-8")).alias("form"))


@query("SELECT o_orderstatus, count(*) FILTER (o_orderpriority LIKE '1%') AS canceled, count(*) FILTER (o_orderpriority LIKE '5%') AS errors FROM orders GROUP BY 1")
def v14_pool_counters(spark, folder):
    n = lambda d: F.count_if(F.startswith("o_orderpriority", F.lit(d)))
    return table(spark, folder, "orders").groupBy("o_orderstatus").agg(n("1").alias("canceled"), n("5").alias("errors"))


@query("SELECT event_id, event_id % 3 AS token FROM events")
def v15_round_robin(spark, folder):
    return table(spark, folder, "events").select("event_id", F.pmod("event_id", F.lit(3)).alias("token"))


@query("SELECT user_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id")
def v17_first_resolution(spark, folder):
    return table(spark, folder, "events").groupBy("user_id").agg(F.min_by("value", "event_id").alias("value"))


@query("SELECT p_partkey, coalesce(b.r_name, 'default') AS provider FROM part LEFT JOIN region b ON b.r_regionkey = p_size % 7")
def v19_registry(spark, folder):
    r = table(spark, folder, "region")
    return table(spark, folder, "part").join(F.broadcast(r), F.col("r_regionkey") == F.col("p_size") % 7, "left").select("p_partkey", F.coalesce("r_name", F.lit("default")).alias("provider"))


@query("SELECT page_id, rtrim(url || '//', '/') || '/v1' AS endpoint FROM pages")
def v20_endpoints(spark, folder):
    return table(spark, folder, "pages").select("page_id", F.concat(F.regexp_replace(F.concat("url", F.lit("//")), "/+$", ""), F.lit("/v1")).alias("endpoint"))


@query(r"SELECT p_partkey, regexp_full_match(p_name, '[A-Za-z0-9_.-]+ [A-Za-z0-9_.-]+') AS valid, p_name || E'\n' || coalesce(NULLIF(p_brand, 'Brand#2'), '') AS task FROM part")
def v21_repository_names(spark, folder):
    text = F.concat_ws("\n", F.coalesce("p_name", F.lit("")), F.coalesce(F.nullif("p_brand", F.lit("Brand#2")), F.lit("")))
    return table(spark, folder, "part").select("p_partkey", F.col("p_name").rlike("^[A-Za-z0-9_.-]+ [A-Za-z0-9_.-]+$").alias("valid"), text.alias("task"))


def _candidates(spark, folder):
    reason = F.when(F.col("conv_id") % 4 == 0, "MAX_TOKENS").when(F.col("conv_id") % 4 == 1, "SAFETY").when(F.col("conv_id") % 4 == 2, "STOP")
    part = lambda text, thought: F.struct(text.alias("text"), F.lit(thought).alias("thought"))
    parts = F.array(part(F.lit("draft"), True), part(F.col("text"), False))
    return table(spark, folder, "conversations").select("conv_id", "turn", F.to_json(F.struct(F.array(F.struct(reason.alias("finishReason"), F.struct(parts.alias("parts")).alias("content"))).alias("candidates"))).alias("payload"))


@query("""SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN 'truncated' WHEN conv_id % 4 = 1 THEN 'blocked' WHEN trim(coalesce(text, '')) = '' THEN 'empty' ELSE 'ok' END AS state, sha256(coalesce(text, '')) AS answer FROM conversations""")
def c07_answers(spark, folder):
    from ..sources import logs

    return _candidates(spark, folder).select("conv_id", "turn", logs.answer_state(F.col("payload")).alias("state"), F.sha2(logs.answer(F.col("payload")), 256).alias("answer"))


@query(f"SELECT conv_id, turn, sha256(CASE WHEN conv_id % 4 >= 2 THEN {_strip("coalesce(text, '')")} ELSE '' END) AS reply FROM conversations")
def c20_fast_replies(spark, folder):
    from ..sources import logs

    return _candidates(spark, folder).select("conv_id", "turn", F.sha2(logs.fast_reply(F.col("payload")), 256).alias("reply"))


@query(rf"""WITH c AS (SELECT conv_id, turn, conv_id % 6 AS k, coalesce(text, '') AS text FROM conversations),
s AS (SELECT conv_id, turn, k, {_strip("CASE WHEN k = 1 THEN text || chr(10) || 'more' WHEN k = 4 THEN '' ELSE text END")} AS t FROM c)
SELECT conv_id, turn, CASE WHEN k IN (2, 5) THEN 'blocked' WHEN k = 3 THEN 'truncated' WHEN t = '' THEN 'empty' ELSE 'ok' END AS state, CASE WHEN k < 2 AND t <> '' THEN sha256(t) END AS answer FROM s""")
def c08_chat_answers(spark, folder):
    from ..sources import logs

    k, own = F.col("conv_id") % 6, F.coalesce("text", F.lit(""))
    whole = F.to_json(F.struct(own.alias("content")))
    body = F.expr("substring(j, 12, length(j) - 12)")  # the text as JSON
    content = F.when(k == 1, F.concat(F.lit('[{"type": "text", "text": '), body, F.lit('}, {"type": "image"}, 7, {"text": "more"}]'))).when(k == 4, F.lit('" "')).otherwise(body)
    refusal = F.when(k == 2, F.lit(', "refusal": "no"')).otherwise("")
    reason = F.when(k == 3, F.lit('"length"')).when(k == 5, F.lit('"content_filter"')).otherwise("null")
    payload = F.concat(F.lit('{"choices": [{"finish_reason": '), reason, F.lit(', "message": {"content": '), content, refusal, F.lit("}}]}"))
    rows = table(spark, folder, "conversations").withColumn("j", whole).select("conv_id", "turn", logs.chat_answer(payload).alias("a"))
    return rows.select("conv_id", "turn", "a.state", F.sha2("a.text", 256).alias("answer"))


@query("SELECT c_name, c_acctbal FROM customer WHERE c_custkey = 42")
def s09_point_read(spark, folder):
    from ..sources import logs

    return logs.record(table(spark, folder, "customer"), "c_custkey", 42, ["c_name", "c_acctbal"])
