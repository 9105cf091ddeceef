"""Queries for scans, sinks, markup, redaction, pairing and event streams whose rules were tested on small inputs only (S, K, X, R, J, Q, W, V)."""

from pyspark.sql import functions as F

from ..adapters import PAGES_SQL, pages
from ..functions import markup as M
from ..functions import pages as G
from ..functions import redaction as R
from ..functions import replies as Y
from ..functions.payloads import quote
from ..operators import aggregates as A
from ..operators import pairing as P
from ..registry import query
from ..session import table
from ..sources import logs, ranges, sinks
from ..streaming import batches, sse


def _text(*pieces):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def _digest(c):
    return F.sha2(c, 256)


# Scans


@query("""WITH s AS (SELECT s_suppkey AS doc, s_suppkey % 50 + 1 AS total, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % (s_suppkey % 50 + 1) + 1 END AS f FROM supplier)
SELECT doc, total, n::INTEGER AS number, lpad(n::VARCHAR, greatest(3, length(total::VARCHAR))::INTEGER, '0') AS stem FROM (SELECT doc, total, unnest(range(coalesce(f, 1), total + 1)) AS n FROM s)""")
def s01_page_plan(spark, folder):
    key = F.col("s_suppkey")
    total = (key % 50 + 1).cast("int")
    own = table(spark, folder, "supplier").select(key.alias("doc"), total.alias("total"), F.when(key % 3 > 0, key % total + 1).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    return logs.page_plan(own).withColumn("total", F.col("total").cast("long"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 <> 1 AND p_size % 3 <> 1 AND p_size >= 32 THEN p_size * 1048576 END AS total, CASE WHEN p_size % 4 <> 1 AND p_size % 3 <> 1 AND p_size >= 32 AND p_size % 2 = 0 THEN p_name END AS if_range FROM part""")
def s05_range_plans(spark, folder):
    size = F.col("p_size")
    accept, encoding = F.when(size % 4 == 1, "none").otherwise("Bytes"), F.when(size % 3 == 1, "gzip").when(size % 3 == 2, "identity")
    etag = F.when(size % 2 == 0, F.col("p_name")).otherwise(_text("W/", F.col("p_name")))
    plan = ranges.range_plan(accept, encoding, size * 1048576, etag)
    return table(spark, folder, "part").select("p_partkey", plan.alias("r")).select("p_partkey", F.col("r.total").cast("long").alias("total"), "r.if_range")


@query("SELECT doc_id, doc_id % 3 = 0 AS is_pdf FROM documents")
def s04_magic_bytes(spark, folder):
    own = F.when(F.col("doc_id") % 3 == 0, _text("%PDF-1.7", F.coalesce("text", F.lit("")))).when(F.col("doc_id") % 3 == 1, _text(" %PDF-", F.coalesce("text", F.lit("")))).otherwise("%PDF")
    return table(spark, folder, "documents").select("doc_id", ranges.is_pdf(own.cast("binary")).alias("is_pdf"))


@query("""WITH l AS (SELECT conv_id AS doc, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS r FROM conversations WHERE turn % 3 <> 2)
SELECT l.doc, 1 + 2 * r + k AS number, sha256(coalesce(text, '')) AS markdown, CASE k WHEN 0 THEN 'u' || l.turn END AS image FROM l JOIN conversations c ON c.conv_id = l.doc AND c.turn = l.turn, (VALUES (0), (1)) v(k)""")
def s08_ocr_pages(spark, folder):
    """Turns as lines of two pages each; every third line is blank."""
    said = F.coalesce("text", F.lit(""))
    page = lambda with_image: F.struct(F.struct(said.alias("text"), F.when(F.lit(with_image), F.create_map(F.lit("a.png"), _text("u", F.col("turn").cast("string")))).alias("images")).alias("markdown"))
    line = F.to_json(F.struct(F.struct(F.array(page(True), page(False)).alias("layoutParsingResults")).alias("result")))
    own = table(spark, folder, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("line"), F.when(F.col("turn") % 3 == 2, "  ").otherwise(line).alias("value"), F.lit(1).alias("first"))
    return logs.ocr_pages(own).select("doc", "number", _digest("markdown").alias("markdown"), F.col("images")["a.png"].alias("image"))


@query("""WITH p AS (SELECT *, p_partkey % 3 = 0 AS odd, CASE WHEN p_partkey % 2 = 0 THEN 'm' || p_partkey // 2 ELSE 'm' || (p_partkey - 1) // 2 END AS id FROM part WHERE p_partkey % 7 <> 3)
SELECT id, arg_max(CASE WHEN p_size % 5 = 0 THEN id ELSE p_name END, p_partkey) AS "displayName", arg_max(p_type, p_partkey) AS description, arg_max(p_size, p_partkey) AS "inputTokenLimit" FROM p GROUP BY id""")
def s11_catalog_rows(spark, folder):
    """Rows of a catalog's pages, two for each model; every seventh has no valid name."""
    key = F.col("p_partkey")
    name = F.when(key % 7 == 3, _text("models/-", key.cast("string"))).otherwise(_text("models/m", F.floor(key / 2).cast("string")))
    own = table(spark, folder, "part").select(F.floor(key / 100).alias("page"), (key % 100).alias("pos"), name.alias("name"), F.when(F.col("p_size") % 5 != 0, F.col("p_name")).otherwise("").alias("displayName"), F.col("p_type").alias("description"), F.col("p_size").alias("inputTokenLimit"))
    return logs.catalog(own)


@query("""SELECT 'spool/' || lpad(c_custkey::VARCHAR, 15, 'a') || CASE WHEN c_custkey % 2 = 0 THEN '.progress' ELSE '' END || '.json' AS path, lpad(c_custkey::VARCHAR, 15, 'a') AS id, c_custkey % 2 = 0 AS progress FROM customer WHERE c_custkey % 5 > 0""")
def s12_spool_files(spark, folder):
    key = F.col("c_custkey").cast("string")
    path = _text("spool/", F.when(F.col("c_custkey") % 5 == 0, key).otherwise(F.lpad(key, 15, "a")), F.when(F.col("c_custkey") % 2 == 0, ".progress").otherwise(""), ".json")
    return logs.spool(table(spark, folder, "customer").select(path.alias("path"), F.lit("{}").alias("value"))).select("path", "id", "progress")


@query(r"""WITH e AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations), l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS lines FROM e)
SELECT conv_id, turn, 'step' AS event, conv_id || '-' || turn AS id, sha256(array_to_string(lines, chr(10))) AS data FROM l WHERE len(lines) > 0""")
def s13_event_frames(spark, folder):
    """Each conversation as one stream of frames: a comment, a name, an id, a data line for each line of the turn; frames without data give no event."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x != "")
    data = F.array_join(F.transform(lines, lambda x: _text("data: ", x)), "\r\n")
    frame = _text(": keep\nevent: step\nid: ", F.col("conv_id").cast("string"), "-", F.col("turn").cast("string"), "\n", data, "\n\n")
    own = table(spark, folder, "conversations").select("conv_id", "turn", frame.alias("frame"))
    body = own.groupBy("conv_id").agg(_text(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "frame"))), lambda r: r["frame"]), ""), "data: [DONE]\n\n").alias("body"))
    each = body.select("conv_id", F.explode(sse.frames(F.col("body"))).alias("e"))
    return each.select("conv_id", F.element_at(F.split("e.id", "-"), 2).cast("long").alias("turn"), "e.event", "e.id", _digest("e.data").alias("data"))


@query("""SELECT '2024-01-01T' || lpad((event_id % 24)::VARCHAR, 2, '0') || ':00Z' AS "at", 'c' || user_id AS chunk, value AS seconds FROM events WHERE event_type = 'click'""")
def s15_run_log(spark, folder):
    hour = F.lpad((F.col("event_id") % 24).cast("string"), 2, "0")
    state = F.when(F.col("event_type") == "click", "[done]").otherwise("[wait]")
    line = _text("2024-01-01T", hour, ":00Z info ", state, " c", F.col("user_id").cast("string"), " took ", F.col("value").cast("string"), "s")
    return logs.run_log(table(spark, folder, "events").select(line.alias("value")))


@query(f"""WITH {PAGES_SQL}, p AS (SELECT doc || '-' || (number - 1) // 50 AS doc, number, trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS body, status FROM pg)
SELECT doc, sha256(string_agg('<!-- 第 ' || number || ' 页 -->' || chr(10) || chr(10) || body, chr(10) || chr(10) ORDER BY number)) AS body FROM p WHERE status = 'ok' AND body <> '' GROUP BY doc""")
def k01_merged_documents(spark, folder):
    """Documents of fifty pages."""
    own = pages(spark, folder).withColumn("doc", _text(F.col("doc"), "-", F.floor((F.col("number") - 1) / 50).cast("string")))
    return sinks.merged_documents(own, "doc").select("doc", _digest("body").alias("body"))


# Markup


@query("""SELECT item_id, CASE item_id % 3 WHEN 0 THEN '![](images/a.png) ' || chr(10) ELSE '' END || '**' || replace(text, chr(10), ' ') || '**' || chr(10) || chr(10) || '$$' || chr(10) || 'x' || chr(10) || '$$' || chr(10) || '$y$ z' AS markdown
FROM (SELECT item_id, regexp_replace(replace(text, '$', ''), '\\s+', ' ', 'g') AS text FROM benchmark) WHERE item_id % 3 <> 0""".replace("'\\s+'", r"'\s+'"))
def x02_normalized(spark, folder):
    """Passages wrapped, with a formula on a line, a padded one and an image that nothing stands for."""
    said = F.regexp_replace(F.replace("text", F.lit("$"), F.lit("")), r"\s+", " ")
    raw = _text("<div align='center'>\n<div>**", said, '**</div>\n\n\n<img src="b.png" alt="Image"/>\n\n $$ x $$ \n$ y $ z  \n</div>')
    own = table(spark, folder, "benchmark").filter("item_id % 3 <> 0")
    return own.select("item_id", M.normalized(raw, F.create_map(F.lit("a.png"), F.lit("images/a.png"))).alias("markdown"))


@query("""SELECT doc_id, i::INTEGER AS i, CASE WHEN doc_id % 3 = 0 THEN 'a $x$ b $y$ ' || w WHEN doc_id % 3 = 1 THEN 'a $ x $ b $ ' || w ELSE '$$ x $$ $z$ ' || w END AS line FROM (SELECT doc_id, generate_subscripts(l, 1) AS i, replace(unnest(l), '$', '') AS w FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))""")
def x03_tidy_formulas(spark, folder):
    """Lines of documents with padded formulas before them: two, an odd number, a displayed one beside one."""
    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "w"))
    w = F.replace("w", F.lit("$"), F.lit(""))
    line = F.when(F.col("doc_id") % 3 == 0, _text("a $ x $ b $y $ ", w)).when(F.col("doc_id") % 3 == 1, _text("a $ x $ b $ ", w)).otherwise(_text("$$ x $$ $ z $ ", w))
    return lines.select("doc_id", (F.col("i") + 1).alias("i"), M.tidy_math_line(line).alias("line"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'a $x y$ b' || chr(10) || w ELSE 'a $x' || w END AS text, CASE WHEN turn % 2 = 0 THEN 0 ELSE 1 END AS odd FROM (SELECT conv_id, turn, regexp_replace(replace(coalesce(text, ''), '$', ''), '[^A-Za-z]', '', 'g') AS w FROM conversations)""")
def x05_formula_lines(spark, folder):
    w = F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")
    raw = F.when(F.col("turn") % 2 == 0, _text("a $x \n  y$ b\n", w)).otherwise(_text("a $x", w))
    own = M.math_lines(raw)
    return table(spark, folder, "conversations").select("conv_id", "turn", own["text"].alias("text"), F.size(own["odd"]).alias("odd"))


@query("""SELECT page_id, url || '?q=a%20b&x=%C3%A9%22#f' AS url FROM pages""")
def x10_quoted_urls(spark, folder):
    return table(spark, folder, "pages").select("page_id", M.quoted(_text(F.col("url"), '?q=a b&x=é"#f')).alias("url"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'https://a/' || conv_id || '|data:image/png;x|http://b/' || turn ELSE 'http://b/' || turn END AS urls FROM conversations""")
def x17_image_urls(spark, folder):
    turn = F.col("turn").cast("string")
    listed = F.when(F.col("turn") % 2 == 0, F.array(_text("https://a/", F.col("conv_id").cast("string")), F.lit("ftp://no"), F.lit("data:image/png;x"), _text("http://b/", turn)))
    text = _text(F.coalesce("text", F.lit("")), '\n<!-- aw:images:["http://b/', turn, '","javascript:x"] -->')
    return table(spark, folder, "conversations").select("conv_id", "turn", F.array_join(Y.image_urls(listed, text), "|").alias("urls"))


@query("""SELECT p_partkey, p_size % 4 = 0 AS ok, CASE WHEN p_size % 4 = 0 THEN '<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 ' || p_size + 1 || ' 5"><rect id="' || replace(p_name, ' ', '_') || '"/></svg>' END AS svg FROM part""")
def x21_drawings(spark, folder):
    """Parts as answers with a drawing: fenced and sound, without a box, with a script, not well-formed."""
    n = F.col("p_size")
    open_ = _text('<svg xmlns="http://www.w3.org/2000/svg"', F.when(n % 4 == 1, "").otherwise(_text(' viewBox="0 0 ', (n + 1).cast("string"), ' 5"')), ">")
    inner = F.when(n % 4 == 2, "<script/>").when(n % 4 == 3, "<g>").otherwise(_text('<rect id="', F.replace("p_name", F.lit(" "), F.lit("_")), '"/>'))
    own = M.svg(_text("```svg\n", open_, inner, "</svg>\n```"))
    return table(spark, folder, "part").select("p_partkey", own["ok"].alias("ok"), own["svg"].alias("svg"))


@query("""SELECT item_id, CASE WHEN item_id % 2 = 0 THEN repeat('é', 20) ELSE 'a' || repeat('é', 19) END AS cut FROM benchmark""")
def x24_cut_bytes(spark, folder):
    """Two-byte characters cut at forty bytes, on a character's end and within one."""
    return table(spark, folder, "benchmark").select("item_id", M.cut_bytes(_text(F.when(F.col("item_id") % 2 == 0, "").otherwise("a"), F.repeat(F.lit("é"), 30), F.col("text")), 40).alias("cut"))


@query("""SELECT page_id, 'a ![x](images/k.png) b  c' || chr(10) || url AS text FROM pages""")
def f07_known_figures(spark, folder):
    own = _text("a ![x](images/k.png) b ![](images/", F.col("page_id").cast("string"), ".png) c\n", F.col("url"))
    return table(spark, folder, "pages").select("page_id", M.known_figures(own, F.array(F.lit("images/k.png"))).alias("text"))


# Redaction of nested values


def _payload():
    said = quote(F.coalesce("text", F.lit("")))
    return _text('{"args":{"q":', said, ',"api_key":"s3cret","Signature":"x"},"list":["Bearer abc",', said, '],"n":', F.col("turn").cast("string"), ',"headers":"h"}')


_SAID = "to_json(coalesce(text, ''))::VARCHAR"


@query(f"""SELECT conv_id, turn, sha256('{{"args": {{"q": ' || {_SAID} || '}}, "list": ["Bearer [REDACTED]", ' || {_SAID} || '], "n": ' || turn || '}}') AS value FROM conversations""")
def r02_sanitized(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", _digest(M.sanitize(_payload())).alias("value"))


@query(f"""SELECT conv_id, turn, sha256(substr('{{"args": {{"q": ' || {_SAID} || ', "api_key": "[REDACTED]", "Signature": "x"}}, "list": ["Bearer [REDACTED]", ' || {_SAID} || '], "n": ' || turn || ', "headers": "h"}}', 1, 1800)) AS value FROM conversations""")
def r03_previews(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", _digest(M.preview(_payload())).alias("value"))


@query(f"""SELECT conv_id, turn, sha256('{{"args": {{"q": ' || {_SAID} || '}}, "list": ["Bearer [REDACTED]", ' || {_SAID} || '], "n": ' || turn || '}}') AS value FROM conversations""")
def r04_tool_payloads(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", _digest(M.scrub(_payload())).alias("value"))


@query("SELECT item_id, item_id || ' [REDACTED] [REDACTED] ' || 'eC1vYXV0' AS text FROM benchmark")
def t09_longest_secret_first(spark, folder):
    return table(spark, folder, "benchmark").select("item_id", R.redact(_text(F.col("item_id").cast("string"), " abcdef abcd eC1vYXV0"), ["abcd", "abcdef", "abc"]).alias("text"))


@query("SELECT conv_id, 'a|Bearer [REDACTED]|' || conv_id AS shown FROM (SELECT DISTINCT conv_id FROM conversations)")
def v12_emitted_lists(spark, folder):
    own = table(spark, folder, "conversations").select("conv_id").distinct()
    return own.select("conv_id", F.array_join(Y.redacted_list(F.array(F.lit("a"), F.lit("Bearer abc123"), F.col("conv_id").cast("string"))), "|").alias("shown"))


# Pairing and streams

_PAIRS = "e AS (SELECT user_id AS message, event_id AS seq, CASE event_type WHEN 'click' THEN 'call' ELSE 'result' END AS side FROM events WHERE event_type IN ('click', 'view'))"


def _calls(spark, folder, known):
    """Clicks as calls and each next but one event as their result; ids agree for ``known`` ones."""
    own = table(spark, folder, "events")
    kind, number = F.lit("k"), F.floor(F.col("event_id") / 2).cast("string")
    is_call = F.col("event_id") % 2 == 0
    number = F.when(is_call | known, number).otherwise(_text("x", number))
    return own.select(F.floor(F.col("event_id") / 20).alias("message"), F.col("event_id").alias("seq"), F.when(is_call, "call").otherwise("result").alias("side"), kind.alias("kind"), number.alias("id"))


@query("""WITH e AS (SELECT event_id, event_id // 20 AS message, event_id % 3 = 0 OR (event_id - 1) % 3 = 0 AS hit FROM events WHERE event_id % 2 = 0 AND event_id + 1 IN (SELECT event_id FROM events)),
m AS (SELECT event_id, message, (event_id + 1) % 3 = 0 AS known FROM e)
SELECT message, event_id AS call, event_id + 1 AS result, 'call_id' AS association FROM m WHERE known UNION ALL SELECT message, event_id, NULL, NULL FROM m WHERE NOT known UNION ALL SELECT message, NULL, event_id + 1, NULL FROM m WHERE NOT known
UNION ALL SELECT event_id // 20, event_id, NULL, NULL FROM events WHERE event_id % 2 = 0 AND event_id + 1 NOT IN (SELECT event_id FROM events) UNION ALL SELECT event_id // 20, NULL, event_id, NULL FROM events WHERE event_id % 2 = 1 AND event_id - 1 NOT IN (SELECT event_id FROM events)""")
def j09_exact_pairs(spark, folder):
    """A third of the results has its call's id."""
    return P.pair(_calls(spark, folder, F.col("event_id") % 3 == 0), P.EXACT).select("message", "call", "result", "association")


@query("""WITH e AS (SELECT event_id, event_id // 20 AS message FROM events WHERE event_id % 2 = 0 AND event_id + 1 IN (SELECT event_id FROM events))
SELECT message, event_id AS call, event_id + 1 AS result, CASE WHEN (event_id + 1) % 3 = 0 THEN 'call_id' ELSE 'type_fifo_estimate' END AS association FROM e
UNION ALL SELECT event_id // 20, event_id, NULL, NULL FROM events WHERE event_id % 2 = 0 AND event_id + 1 NOT IN (SELECT event_id FROM events)""")
def j10_pairs_by_order(spark, folder):
    """Results follow their calls; those without the id take the first open call of their kind."""
    return P.pair(_calls(spark, folder, F.col("event_id") % 3 == 0), P.FIRST_OF_KIND).select("message", "call", "result", "association")


@query("""WITH e AS (SELECT user_id, event_id, 'step:' || (event_id % 3) AS key, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id) AS r FROM events)
SELECT user_id AS message, key, substr(key, 6)::BIGINT + 1 AS sequence FROM e WHERE r = 1 UNION ALL SELECT DISTINCT user_id, 'answer', 9999 FROM events UNION ALL SELECT DISTINCT user_id, 'agent-status', 10000 FROM events""")
def w09_numbered_parts(spark, folder):
    own = table(spark, folder, "events").select(F.col("user_id").alias("message"), F.col("event_id").alias("arrival"), _text("step:", (F.col("event_id") % 3).cast("string")).alias("key"))
    users = own.select("message").distinct()
    fixed = [users.select("message", F.lit(-1).cast("long").alias("arrival"), F.lit(k).alias("key")) for k in ("answer", "agent-status")]
    return batches.numbered(own.unionByName(fixed[0]).unionByName(fixed[1]))


def _events(spark, folder, replay=False):
    """Each conversation as a stream: a step for each turn, its text in two deltas, each event twice, every other step stopped."""
    said = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(said) / 2).cast("int")
    one = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("string").alias("i"), "turn", F.left(said, half).alias("a"), F.substring(said, half + 1, F.length(said)).alias("b"))
    delta = lambda c: _text('{"event_type":"step.delta","index":', F.col("i"), ',"delta":', F.to_json(F.struct(F.lit("text").alias("type"), c.alias("text"))), "}")
    stop = F.when(F.col("turn") % 2 == 0, _text('{"event_type":"step.stop","index":', F.col("i"), "}"))
    data = F.array(_text('{"event_type":"step.start","index":', F.col("i"), ',"step":{"type":"model_output"}}'), delta(F.col("a")), delta(F.col("a")), delta(F.col("b")), stop)
    ids = F.array(*map(F.lit, ("s", "a", "a", "b", "e")))
    rows = one.select("conv_id", "turn", F.posexplode(F.arrays_zip(data.alias("data"), ids.alias("id"))).alias("n", "r")).filter("r.data IS NOT NULL")
    events = rows.select(F.col("conv_id").cast("string").alias("stream"), (F.col("turn") * 10 + F.col("n")).alias("arrival"), F.lit("").alias("event"), _text(F.col("turn").cast("string"), "-", F.col("r.id")).alias("id"), F.col("r.data").alias("data"))
    if replay:
        again = table(spark, folder, "conversations").groupBy("conv_id").agg(F.max("turn").alias("m")).select(F.col("conv_id").cast("string").alias("stream"), (F.col("m") * 10 + 9).alias("arrival"), F.lit("replay").alias("event"), F.lit("").alias("id"), F.lit("{}").alias("data"))
        later = events.withColumn("arrival", F.col("arrival") + 1_000_000).withColumn("id", _text("r", F.col("id")))
        events = events.unionByName(again).unionByName(later)
    return events


@query("""SELECT conv_id::VARCHAR AS stream, turn::INTEGER AS index, 'model_output' AS kind, CASE WHEN turn % 2 = 0 THEN 'completed' ELSE 'running' END AS status, sha256(coalesce(text, '')) AS content FROM conversations""")
def q03_accumulated_steps(spark, folder):
    return sse.accumulated(_events(spark, folder)).select("stream", "index", "kind", "status", _digest("content").alias("content"))


@query("""SELECT conv_id::VARCHAR AS stream, turn::INTEGER AS index, CASE WHEN turn % 2 = 0 THEN 'completed' ELSE 'running' END AS status, sha256(coalesce(text, '')) AS content FROM conversations""")
def q04_replayed_steps(spark, folder):
    """The whole stream again on a connection without a cursor: nothing doubles, what is completed stays so."""
    return sse.accumulated(_events(spark, folder, replay=True)).select("stream", "index", "status", _digest("content").alias("content"))


@query("SELECT conv_id::VARCHAR AS stream, turn, min(id) AS id FROM (SELECT conv_id, turn, turn || '-' || unnest(['s', 'a', 'b', 'e']) AS id FROM conversations) WHERE turn % 2 = 0 OR id NOT LIKE '%-e' GROUP BY conv_id, turn, id")
def q02_trace_events(spark, folder):
    own = sse.first_seen(_events(spark, folder), "stream", "id", "arrival")
    return own.select("stream", F.floor(F.col("arrival") / 10).cast("long").alias("turn"), "id")


# Replies


@query("""SELECT event_id, greatest((event_id % 7)::DOUBLE, CASE WHEN event_id % 2 = 0 THEN value END, CASE WHEN event_id % 3 = 0 THEN 2.5::DOUBLE END) AS seconds FROM events""")
def c02_retry_after(spark, folder):
    body = _text('{"a":"', F.when(F.col("event_id") % 2 == 0, _text('","retryDelay": "', F.format_string("%.2f", "value"), "s")).otherwise(""), '"}', F.when(F.col("event_id") % 3 == 0, '{"retryDelay":"2.5s"}').otherwise(""))
    return table(spark, folder, "events").select("event_id", logs.retry_after((F.col("event_id") % 7).cast("string"), body).alias("seconds"))


@query("""SELECT p_partkey, p_name || '|' || p_brand AS done, 12 AS n_next FROM part""")
def c13_summaries(spark, folder):
    raw = _text("Sure: ", F.to_json(F.struct(F.array(_text(" ", F.col("p_name")), F.lit(" "), F.col("p_brand")).alias("done"), F.array_repeat("p_type", 20).alias("next"))), " end")
    own = Y.summary(raw)
    return table(spark, folder, "part").select("p_partkey", F.array_join(own["done"], "|").alias("done"), F.size(own["next"]).alias("n_next"))


@query("""SELECT conv_id AS chunk, 'ok' AS status FROM conversations WHERE conv_id % 2 = 0 UNION ALL SELECT DISTINCT conv_id, 'failed' FROM conversations WHERE conv_id % 2 = 1""")
def v01_flattened_results(spark, folder):
    own = table(spark, folder, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(F.col("conv_id").alias("chunk"), F.lit("ok").alias("status"))).alias("r"))
    units = own.select(F.col("conv_id").alias("chunk"), F.lit("failed").alias("status"), F.when(F.col("conv_id") % 2 == 0, F.col("r")).alias("page_results"))
    return A.flattened(units)


@query("""SELECT event_id, '{"event":"' || event_type || '","user":' || user_id || ',"seconds":' || value || '}' AS line FROM events""")
def v10_telemetry(spark, folder):
    own = None
    for kind in ("click", "view", "purchase", "signup", "error"):  # a row's name is fixed where it is written
        line = G.telemetry(kind, user=F.col("user_id"), seconds=F.col("value"))
        own = F.when(F.col("event_type") == kind, line) if own is None else own.when(F.col("event_type") == kind, line)
    return table(spark, folder, "events").select("event_id", own.alias("line"))


@query("""SELECT conv_id AS stream, -1 AS "row", 'snapshot' AS kind, 'unknown' AS status FROM (SELECT DISTINCT conv_id FROM conversations) UNION ALL SELECT conv_id, turn::INTEGER, role, 's' || turn FROM conversations""")
def v11_snapshot_rows(spark, folder):
    steps = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda r: F.struct(r["role"].alias("type"), _text("s", r["turn"].cast("string")).alias("status")))
    own = table(spark, folder, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(steps.alias("steps"))).alias("data"))
    return Y.snapshot_rows(own.select(F.col("conv_id").alias("stream"), "data"))
