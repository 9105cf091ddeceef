"""Operators whose results can't be told from the driver's tables, on small inputs with known results."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions import classify as C
from foliospark.functions import markup as M
from foliospark.functions import redaction as R
from foliospark.functions import text as X
from foliospark.operators import aggregates as A
from foliospark.operators import figures as G
from foliospark.operators import joins as J
from foliospark.operators import pairing as P
from foliospark.operators import windows as W
from foliospark.plans import segments as S
from foliospark.plans import simulation as Z
from foliospark.sources import logs, ranges, sinks
from foliospark.streaming import batches as B
from foliospark.streaming import sse


def one(spark, column, **values):
    kinds = {str: "string", int: "long", float: "double", bool: "boolean"}
    fields = [T.StructField(k, T._parse_datatype_string(kinds[type(v)]) if type(v) in kinds else (T.ArrayType(T.StringType()) if isinstance(v, list) else T.MapType(T.StringType(), T.StringType()) if isinstance(v, dict) else T.StringType())) for k, v in (values or {"x": 1}).items()]
    return spark.createDataFrame([tuple((values or {"x": 1}).values())], T.StructType(fields)).select(column.alias("r")).first()["r"]


def text(spark, f, value, *more):
    return one(spark, f(F.col("t"), *more), t=value)


def test_clean_layout(spark):
    clean = lambda t: text(spark, X.clean_layout, t)
    assert clean('<div class="analysis-box"><div align="right">Section II</div>\n正文</div>') == "Section II\n正文"
    odd = '<div data-x="1">a &nbsp; b</div>'
    assert clean(odd) == odd
    table = '<table border="1" style="width:10px"><tr><td style="text-align: center; color:red">a<br>b</td></tr></table>'
    assert clean(table) == '<table><tr><td align="center">a<br />b</td></tr></table>'
    nested = "<div>" * 8 + "x" + "</div>" * 8
    assert clean(nested) == "x" and clean(clean(nested)) == "x"


def test_wrappers_of_any_depth(spark):
    assert text(spark, X.clean_layout, "<div>" * 40 + "\nx\n" + "</div>" * 40) == "x"
    assert text(spark, X.clean_layout, "a</div><div><div id='k'>x</div>y</div><div>z") == "a</div><div><div id='k'>x</div>y</div><div>z"
    assert text(spark, X.clean_layout, "<div><div align=right>\n\nx</div>\n</div >b") == "xb"


def test_metrics(spark):
    df = spark.createDataFrame([("<!-- 第 1 页 -->\n<div>![a](images/p1.png) b&nbsp;</div>",)], "t string")
    row = df.select(*[c.alias(n) for n, c in X.metrics(F.col("t")).items()]).first()
    assert (row["pages"], row["images"], row["div_tags"], row["html_tags"], row["nbsp"]) == (1, 1, 2, 2, 1)


def test_faults(spark):
    fault = lambda t: text(spark, X.fault, t)
    assert fault("&nbsp;" * 120 + "　" * 80) is None
    assert fault("ab" * 1900) == "repeats"
    assert fault("row of text 7\n" * 2500) == "too_long"
    assert fault("a�b") == "replacement"
    assert fault("此行视具体排版而定") == "commentary"
    assert fault("1234\nx\n 1234 \ny\n1234") == "numbers" and fault("1234\n1235\n1236") is None


def test_names(spark):
    ok = lambda t: text(spark, X.valid_name, t)
    assert ok("report") and ok(" 学习 资料 ")
    for bad in ("", ".x", "a.md", "a.ZIP", "a/b", "a\\b", "a:b", "x.", "CON", "com1.txt", "x" * 121, "字" * 81):
        assert not ok(bad), bad


def test_titles(spark):
    title = lambda t: text(spark, X.title, t)
    assert title("\n## 《代码重构与性能优化》。\nmore") == "代码重构与性能优化"
    assert title('"Hello   World!"') == "Hello World"
    assert title("一二三四五六七八九十一二三四五六七八") == "一二三四五六七八九十一二三四五六"


def test_lists(spark):
    assert text(spark, X.items, " a\nb, a ;\n") == ["a", "b"]
    assert text(spark, X.items, "a b;c,a", r"[,;\s]+") == ["a", "b", "c"]


def test_math(spark):
    assert text(spark, M.tidy_math_line, "x $ a + b $   $ c $ y") == "x $a + b$ $c$ y"
    assert text(spark, M.tidy_math_line, "one $ only") == "one $ only"
    assert text(spark, M.tidy_math_line, "$$$ x $") == "$$$x$" and text(spark, M.tidy_math_line, r"\\$ a $ b $") == r"\\$ a $b$"
    assert text(spark, M.math_lines, "$$$\nx")["odd"] == [] and text(spark, M.math_lines, "a $\nb\n c\nd $ e\nf")["text"] == "a $ b c d $ e\nf"
    row = text(spark, M.math_lines, "a $x\n= y$ b\nc $d")
    assert (row["text"], row["odd"]) == ("a $x = y$ b\nc $d", [2])


def test_plain_markdown(spark):
    raw = '<div style="text-align:center"><img src="imgs/a.jpg" alt="Image" /></div>\n\n\n\n$$ x $$\nb $ y $'
    assert one(spark, M.normalized(F.col("t"), F.col("m")), t=raw, m={"imgs/a.jpg": "images/p1.jpg"}) == "![](images/p1.jpg)\n\n$$\nx\n$$\nb $y$"
    assert one(spark, M.known_figures(F.col("t"), F.col("k")), t="a ![](images/p001-1.jpg) b ![x](images/no.jpg) c", k=["images/p001-1.jpg"]) == "a ![](images/p001-1.jpg) b  c"


def test_urls(spark):
    assert "%3E%0A%3Cscript%3E" in text(spark, M.quoted, "https://x.y/a>\n<script>")
    assert text(spark, M.cut_bytes, "aé日", 4) == "aé"


def test_svg(spark):
    ns = 'xmlns="http://www.w3.org/2000/svg" viewBox="0 0 10 10"'
    svg = lambda t: tuple(text(spark, M.svg, t))[:2]
    assert svg(f"```svg\n<svg {ns}><path d='M0 0'/></svg>\n```") == (True, "")
    for body, why in (("<script/>", "element"), ("<rect onclick='x'/>", "attribute"), ("<use href='http://x'/>", "reference"), ("<rect style='fill:url(http://x)'/>", "resource"), ("<g/>", "nothing drawn"), ("<rect style='a:expression(1)'/>", "style")):
        assert svg(f"<svg {ns}>{body}</svg>") == (False, why), body
    assert svg("text")[1] == "no svg" and svg("<svg><rect></svg>")[1] == "malformed" and svg("<!DOCTYPE x><svg/>")[1] == "declaration"
    assert svg('<svg viewBox="0 0 1 1"><rect/></svg>')[1] == "namespace" and svg(f"<svg {ns.replace('10 10', '0 10')}><rect/></svg>")[1] == "view box"


def test_redaction(spark):
    raw = "see https://bob:pw12@host/x with Bearer abc.def, password = 'hunter2' and ghp_abcdef; key zzzz9999"
    safe = text(spark, R.redact, raw, ["zzzz9999"])
    assert not any(s in safe for s in ("pw12", "abc.def", "hunter2", "ghp_abcdef", "zzzz9999"))
    value = json.dumps({"a": "Bearer qqqq", "Authorization": "x", "inlineData": {"d": 1}, "token": "t", "nested": json.dumps({"secret": "s", "k": 1}), "list": list(range(600)), "xsignature": 1})
    drop, tool = json.loads(text(spark, M.sanitize, value)), json.loads(text(spark, M.scrub, value))
    assert set(drop) == {"a", "nested", "list"} and json.loads(drop["nested"]) == {"k": 1} and drop["list"][-1] == {"_captureOmittedItems": 100}
    assert set(tool) == {"a", "inlineData", "nested", "list"}
    assert json.loads(text(spark, M.preview, '{"token": "t", "b": "x"}')) == {"token": R.MASK, "b": "x"}
    deep = "1"
    for _ in range(14):
        deep = f'{{"a": {deep}}}'
    assert "[nested value omitted]" in text(spark, M.sanitize, deep)


def test_quota_and_waits(spark):
    kind = lambda t: text(spark, C.quota_class, t)
    assert [kind(t) for t in ("GenerateRequestsPerMinute", "InputTokensPerMinute", "GenerateRequestsPerDay", "try again")] == ["rpm", "tpm", "rpd", "unknown"]
    wait = logs.retry_after(F.col("h"), F.col("b"))
    assert one(spark, wait, h="5", b='{"details": [{"retryDelay": "60s"}]}') == 60.0
    assert one(spark, wait, h="soon", b="{}") is None
    dated = logs.retry_after(F.col("h"), F.col("b"), F.expr("timestamp'2015-10-21 07:27:30Z'"))
    assert one(spark, dated, h="Wed, 21 Oct 2015 07:28:00 GMT", b='{"retryDelay": "7s"}') == 30.0
    assert one(spark, dated, h="Wed, 21 Oct 2015 07:00:00 GMT", b="{}") == 0.0


def test_answers(spark):
    payload = lambda reason, *parts: json.dumps({"candidates": [{"finishReason": reason, "content": {"parts": list(parts)}}]})
    whole = payload("STOP", {"text": "think", "thought": True}, {"text": "a"}, {"text": "b"})
    assert text(spark, logs.answer, whole) == "a\nb"
    assert [text(spark, logs.answer_state, p) for p in (whole, payload("MAX_TOKENS", {"text": "a"}), payload("SAFETY"), payload("STOP"))] == ["ok", "truncated", "blocked", "empty"]


def test_chat_answers(spark):
    def state(*choices):
        own = text(spark, logs.chat_answer, json.dumps({"choices": list(choices)}))
        return own["state"], own["text"]

    choice = lambda content, reason="stop", **more: {"finish_reason": reason, "message": {"content": content, **more}}
    items = [{"type": "text", "text": "b"}, {"type": None, "text": "c"}, {"type": "image", "text": "x"}, {"text": ""}, 7, {"type": "text"}]
    assert state(choice(" a "), choice(items)) == ("ok", "a \nb\nc")
    assert state(choice("a", "length")) == ("truncated", None)
    assert state(choice("a", "length"), choice("b", "safety")) == ("blocked", None)
    assert state(choice("a", refusal="no")) == ("blocked", None)
    assert [state(), state({}), state(choice(None)), state(choice(" ")), state(choice(5))] == [("empty", None)] * 5
    assert text(spark, logs.chat_answer, "{")["state"] == text(spark, logs.chat_answer, None)["state"] == "empty"


def test_fast_replies(spark):
    reply = lambda reason, *parts: text(spark, logs.fast_reply, json.dumps({"candidates": [{"finishReason": reason, "content": {"parts": list(parts)}}]}))
    assert [reply(r, {"text": " a"}, {"text": "t", "thought": True}, {"text": "b "}) for r in ("STOP", "", None, "MAX_TOKENS")] == ["a\nb"] * 3 + [""]
    assert [text(spark, logs.fast_reply, t) for t in ('{"candidates": []}', "{}", "{", None)] == [""] * 4
    assert text(spark, logs.answer_state, '{"candidates": []}') == "empty"


def test_segments(spark):
    own = lambda f, a, b, n: sorted((r["first"], r["last"]) for r in f(spark.createDataFrame([(1, a, b)], "doc int, first long, last long"), n).collect())
    assert own(S.segments, 3, 9, 3) == [(3, 5), (6, 8), (9, 9)]
    assert own(S.ramp, 1, 100, 25) == [(1, 5), (6, 15), (16, 30), (31, 55), (56, 80), (81, 100)]
    assert own(S.ramp, 1, 8, 25) == [(1, 5), (6, 8)] and own(S.ramp, 1, 3, 25) == [(1, 3)] and own(S.ramp, 3, 9, 6) == [(3, 7), (8, 9)]
    assert own(S.halved, 1, 10, 3) == [(1, 3), (4, 5), (6, 8), (9, 10)]


def test_page_plan(spark):
    plan = lambda *rows: logs.page_plan(spark.createDataFrame(list(rows), "doc string, total int, first int, last int"))
    assert [r["stem"] for r in plan(("a", 12, 11, None)).collect()] == ["011", "012"]
    assert [r["stem"] for r in plan(("a", 12345, 9, 9)).collect()] == ["00009"]
    with pytest.raises(Exception, match="page range"):
        plan(("a", 3, 2, 9)).collect()


def test_positional_zip(spark):
    zipped = lambda k, g: [tuple(r) for r in one(spark, J.zipped(F.col("k"), F.col("g")), k=k, g=g)]
    assert zipped(["a", "b"], []) == [(1, "a", "key-1"), (2, "b", "key-2")]
    assert zipped(["a", "b"], ["p1", "p2"]) == [(1, "a", "p1"), (2, "b", "p2")]
    with pytest.raises(Exception, match="group name"):
        zipped(["a", "b"], ["p1"])


def test_ranges_and_percentiles(spark):
    pages = spark.createDataFrame([("d", n) for n in (2, 5, 3, 3, 9)], "doc string, number long")
    assert W.page_ranges(pages, ["doc"], "number").first()["ranges"] == "2–3、5、9"
    values = spark.createDataFrame([("a", float(v)) for v in range(1, 11)], "k string, v double")
    assert tuple(A.nearest_rank(values, ["k"], "v", {"p50": 0.5, "p95": 0.95}).first()) == ("a", 10, 5.0, 10.0)


def test_documents(spark):
    pages = spark.createDataFrame([("d", 3, "ok", "third ![](images/a.png)"), ("d", 2, "ok", " second "), ("d", 4, "failed", None), ("d", 5, "failed", "x"), ("d", 6, "blank", "")], "doc string, number long, status string, text string")
    assert sinks.merged_documents(pages, "doc").first()["body"] == "<!-- 第 2 页 -->\n\nsecond\n\n<!-- 第 3 页 -->\n\nthird ![](images/a.png)"
    assert sinks.missing_ranges(pages, "doc").first()["missing"] == "4–5"
    head = one(spark, sinks.header(F.lit(9), F.lit(2), F.lit(6), F.lit(3), F.lit("4–5")))
    assert "部分完成（3/5 页）" in head and "未完成页码：4–5" in head
    assert text(spark, X.page_links, "![](images/a.png) [b](images/c)") == "![](../images/a.png) [b](../images/c)"


def test_upsert_and_pages_sink(spark, tmp_path):
    saved = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, n int")
    batch = spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "k int, v string, n int")
    after = sinks.upserted(saved, batch, ["k"], "n")
    assert sorted(map(tuple, after.collect())) == [(1, "a", 1), (2, "c", 2), (3, "d", 2)] == sorted(map(tuple, sinks.upserted(after, batch, ["k"], "n").collect()))
    path = str(tmp_path / "pages")
    pages = spark.createDataFrame([("d", 1, "x"), ("d", 2, "y"), ("e", 1, "z")], "doc string, number long, text string")
    sinks.write_pages(pages, path, "doc")
    sinks.write_pages(pages.filter("doc = 'd' AND number = 1"), path, "doc")
    assert sorted((r["doc"], r["number"]) for r in spark.read.parquet(path).collect()) == [("d", 1), ("e", 1)]


def test_ranges(spark):
    plan = ranges.range_plan(F.col("a"), F.col("e"), F.col("n"), F.col("t"))
    assert tuple(one(spark, plan, a="bytes", e="identity", n=40 << 20, t='"x"')) == (40 << 20, '"x"')
    assert one(spark, plan, a="bytes", e="identity", n=40 << 20, t='W/"x"')["if_range"] is None
    assert one(spark, plan, a="none", e="identity", n=40 << 20, t="x") is None and one(spark, plan, a="bytes", e="gzip", n=40 << 20, t="x") is None
    assert spark.createDataFrame([(bytearray(b"%PDF-1.7"),), (bytearray(b"<html>"),)], "c binary").select(ranges.is_pdf(F.col("c")).alias("r")).collect() == [(True,), (False,)]


def test_scans(spark):
    line = lambda *t: json.dumps({"result": {"layoutParsingResults": [{"markdown": {"text": x, "images": {}}} for x in t]}})
    rows = spark.createDataFrame([("d", 0, line("a", "b"), 5), ("d", 1, " ", 5), ("d", 2, line("c"), 5)], "doc string, line int, value string, first int")
    assert sorted((r["number"], r["markdown"]) for r in logs.ocr_pages(rows).collect()) == [(5, "a"), (6, "b"), (7, "c")]
    models = spark.createDataFrame([(1, 0, "models/b", "B", None, 5), (1, 1, "models/a", "", "x" * 3000, None), (2, 0, "models/b", "B2", None, 6), (2, 1, "models/-bad", "", None, 1)], "page int, pos int, name string, displayName string, description string, inputTokenLimit long")
    got = logs.catalog(models).collect()
    assert [(r["id"], r["displayName"], len(r["description"]), r["inputTokenLimit"]) for r in got] == [("a", "a", 2000, 0), ("b", "B2", 0, 6)]
    files = spark.createDataFrame([("/s/abcdefghij12345.json", ""), ("/s/abcdefghij12345.progress.json", ""), ("/s/no.json", "")], "path string, value string")
    assert [r["name"] for r in logs.spool(files).collect()] == ["abcdefghij12345.progress.json", "abcdefghij12345.json"]
    log = spark.createDataFrame([("2026-01-01T00:00:00Z run [done] p001 in 12.5s",), ("noise",)], "value string")
    assert [tuple(r) for r in logs.run_log(log).collect()] == [("2026-01-01T00:00:00Z", "p001", 12.5)]


def calls(spark, *rows):
    return spark.createDataFrame([("m", i, *r) for i, r in enumerate(rows)], "message string, seq long, side string, kind string, id string")


def paired(df, policy):
    return sorted((r["call"] is None, r["call"], r["result"], r["association"]) for r in P.pair(df, policy).collect())


def test_pairing(spark):
    rows = calls(spark, ("call", "code", "a"), ("call", "code", "b"), ("result", "code", "b"), ("result", "code", ""), ("result", "code", "zz"))
    assert paired(rows, P.FIRST_IF_NO_ID) == [(False, 0, 3, "type_fifo_estimate"), (False, 1, 2, "call_id"), (True, None, 4, None)]
    assert paired(rows, P.EXACT) == [(False, 0, None, None), (False, 1, 2, "call_id"), (True, None, 3, None), (True, None, 4, None)]
    other = calls(spark, ("call", "search", "x"), ("call", "code", "y"), ("result", "search", "unknown"), ("result", "fetch", "q"))
    assert paired(other, P.FIRST_OF_KIND) == [(False, 0, 2, "type_fifo_estimate"), (False, 1, None, None), (True, None, 3, None)]


def test_messages_are_paired_by_one_task_for_many(spark):
    """Many small messages in few batches, one that goes over several; the same as a plain fold. No worker's call for each message."""
    rnd = random.Random(5)
    rows = [(m, seq, rnd.choice(["call", "result"]), rnd.choice("pq"), rnd.choice(["a", "b", "", None])) for m in range(40) for seq in range(400 if m == 7 else rnd.randrange(9))]
    df = spark.createDataFrame(rows, "message long, seq long, side string, kind string, id string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        for policy in (P.EXACT, P.FIRST_OF_KIND, P.FIRST_IF_NO_ID):
            for replaced in (False, True):
                found = P.pair(df, policy, replaced)
                assert "FlatMapGroups" not in found._jdf.queryExecution().toString()
                got = Counter(tuple(r) for r in found.collect())
                assert got == plain_pairs(rows, policy, replaced)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def plain_pairs(rows, policy, replaced):
    out = Counter()
    for m in {r[0] for r in rows}:
        calls = []
        for _, seq, side, kind, own in sorted((r for r in rows if r[0] == m), key=lambda r: r[1]):
            own = own or ""
            if side == "call":
                if replaced:
                    out.update((m, k, s, None, None) for k, i, s in calls if (k, i) == (kind, own))
                    calls = [c for c in calls if c[:2] != (kind, own)]
                calls.append((kind, own, seq))
                continue
            same = [c for c in calls if c[0] == kind]
            hit, how = next((c for c in reversed(same) if c[1] == own and own), None), "call_id"
            if hit is None and not own and policy != P.FIRST_OF_KIND:
                hit = next((c for c in reversed(same) if not c[1]), None)
            if hit is None and (policy == P.FIRST_OF_KIND or policy == P.FIRST_IF_NO_ID and not own):
                hit, how = next(iter(same), None), "type_fifo_estimate"
            if hit:
                calls.remove(hit)
            out[m, kind, hit[2] if hit else None, seq, how if hit else None] += 1
        out.update((m, k, s, None, None) for k, _, s in calls)
    return out


def test_figures(spark):
    html = '<img src="img_in_image_box_10_10_100_100.jpg"/> <div></div> <img src="img_in_image_box_110_12_200_100.jpg"/>\ntext <img src="img_in_image_box_500_500_600_600.jpg"/>'
    pages = spark.createDataFrame([(1, html, 1000.0, 1000.0)], "page long, text string, width double, height double")
    f = W.runs(G.fragments(pages).withColumn("panel", F.lit(False)), ["page"], "nth", F.col("apart") | ~F.col("valid"))
    labels = G.groups(f)
    assert sorted((r["nth"], r["label"]) for r in labels.collect()) == [(0, 0), (1, 0), (2, 2)]
    found = G.unions(f, labels)
    assert [(r["n"], r["x0"], r["x1"]) for r in found.collect()] == [(2, 10.0, 200.0)]
    members = f.join(labels, ["page", "run", "nth"])
    block = lambda *b: spark.createDataFrame([(1, "text", *map(float, b))], "page long, kind string, x0 double, y0 double, x1 double, y1 double")
    assert G.unblocked(found, members, block(90, 20, 120, 60)).count() == 0
    assert G.unblocked(found, members, block(20, 20, 60, 60)).count() == 1 and G.unblocked(found, members, block(400, 20, 460, 60)).count() == 1


def test_frames(spark):
    body = ": hello\r\nid: e1\r\nevent: step.start\r\ndata: {\"name\":\r\ndata:  \"中文\"}\r\n\r\ndata: [DONE]\r\n\r\n"
    got = text(spark, sse.frames, body)
    assert [(json.loads(e["data"]), e["event"], e["id"]) for e in got] == [({"name": "中文"}, "step.start", "e1")]


def test_identities(spark):
    ids = lambda first: one(spark, sse.event_id(F.col("s"), F.col("j"), first), s="sse", j="json")
    assert (ids(True), ids(False)) == ("sse", "json")
    assert one(spark, sse.event_id(F.col("s"), F.col("j"), True), s="x" * 300, j="") is None


EVENTS = [
    ("s", 1, "step.start", "1", {"index": 0, "step": {"type": "model_output"}}), ("s", 2, "step.delta", "2", {"index": 0, "delta": {"type": "text", "text": "sum"}}),
    ("s", 3, "step.delta", "2", {"index": 0, "delta": {"type": "text", "text": "twice"}}), ("s", 4, "step.delta", "3", {"index": 0, "delta": {"type": "text", "text": "mary"}}),
    ("s", 5, "step.stop", "4", {"index": 0}), ("s", 6, "step.delta", None, {"index": 1, "delta": {"type": "arguments_delta", "arguments": "{\"a\""}}),
    ("s", 7, "step.delta", None, {"index": 1, "delta": {"type": "arguments_delta", "arguments": ": 1}"}}), ("s", 8, "step.start", None, {"index": True, "step": {}}), ("t", 1, "step.delta", None, {"index": 0, "delta": {"type": "thought_summary", "content": {"type": "text", "text": "x" * 70_000}}}),
]
WANT = {("s", 0, "model_output", "summary", "completed", False), ("s", 1, "function_call", '{"a": 1}', "running", False), ("t", 0, "thought", "x" * sse.PART_BYTES, "running", True)}


def events(spark):
    return spark.createDataFrame([(*e[:4], json.dumps(e[4])) for e in EVENTS], "stream string, arrival long, event string, id string, data string")


def test_steps(spark):
    assert {tuple(r) for r in sse.accumulated(events(spark)).collect()} == WANT
    assert sse.first_seen(events(spark), "stream", "id", "arrival").count() == len(EVENTS) - 1
    event = lambda n, name, data: ("s", n, name, None, json.dumps({"index": 0, **data}))
    start, stop = {"step": {"type": "model_output"}}, {"step": {"type": "x_result", "text": "done"}}
    rows = [event(1, "step.start", start), event(2, "step.stop", stop), event(3, sse.REPLAY, {}), event(4, "step.start", start), event(5, "step.delta", {"delta": {"type": "text", "text": "again"}})]
    got = sse.accumulated(spark.createDataFrame(rows, "stream string, arrival long, event string, id string, data string")).collect()
    assert [tuple(r) for r in got] == [("s", 0, "x_result", "done", "completed", False)]
    tool = [event(1, "step.start", {"step": {"type": "search_call"}}), event(2, "step.delta", {"delta": {"type": "query", "q": "a"}}), event(3, "step.delta", {"delta": {"q": "b", "type": "query"}})]
    got = sse.accumulated(spark.createDataFrame(tool, "stream string, arrival long, event string, id string, data string")).collect()
    assert [tuple(r) for r in got] == [("s", 0, "search_call", '{"q":"b"}', "running", False)]


def test_streamed_steps(spark, tmp_path):
    path = str(tmp_path / "events")
    for i in range(3):
        events(spark).filter(F.floor((F.col("arrival") - 1) / 3) == i).coalesce(1).write.mode("append").json(path)
    stream = spark.readStream.schema("stream string, arrival long, event string, id string, data string").option("maxFilesPerTrigger", 1).option("latestFirst", "false").json(path)
    target = {}

    def write(batch, _):
        for r in batch.collect():
            target[r["stream"], r["index"]] = tuple(r)

    B.deliver(sse.accumulate(stream), write, str(tmp_path / "cp")).awaitTermination(120)
    assert {k[0] for k in target} == {"s", "t"} and target["t", 0] in WANT


def test_numbering_and_batches(spark):
    keys = ["step:0", "reasoning", "x", "step:2", "answer", "agent-status", "step:0"]
    parts = spark.createDataFrame([("m", i, k) for i, k in enumerate(keys)], "message string, arrival long, key string")
    assert {r["key"]: r["sequence"] for r in B.numbered(parts).collect()} == {"step:0": 1, "reasoning": 2, "x": 3, "step:2": 4, "answer": 9999, "agent-status": 10000}
    big = spark.createDataFrame([("m", i, 100 << 10) for i in range(1, 13)], "message string, sequence long, bytes long")
    assert [r["batch"] for r in B.batched(big).orderBy("sequence").collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6]
    small = spark.createDataFrame([("m", i, 10) for i in range(9)], "message string, sequence long, bytes long")
    assert [r["batch"] for r in B.batched(small).orderBy("sequence").collect()] == [1, 1, 1, 1, 2, 2, 2, 2, 3]
    mixed = spark.createDataFrame([("m", 1, 60), ("m", 2, 60), ("m", 3, 20)], "message string, sequence long, bytes long")
    assert [r["kept"] for r in B.kept_within(mixed, 500, 100).orderBy("sequence").collect()] == [True, False, True]
    assert one(spark, B.heartbeat_due(35.0, F.col("f")), f=5.0) and not one(spark, B.heartbeat_due(34.0, F.col("f")), f=5.0)


def test_schedulers(spark):
    pools = spark.createDataFrame([("p", f"b{i}", [f"k{i}"], 50) for i in range(5)], "pool string, bucket string, keys array<string>, picks int")
    got = Z.acquired(pools, 10).collect()
    assert {b: sum(r["bucket"] == b for r in got) for b in {r["bucket"] for r in got}} == {f"b{i}": 10 for i in range(5)}
    assert len({r["bucket"] for r in got[:5]}) == 5
    for b in range(5):
        at = sorted(r["at"] for r in got if r["bucket"] == f"b{b}")
        assert min(y - x for x, y in zip(at, at[1:], strict=False)) >= 6
    two = spark.createDataFrame([("p", "a", ["a1", "a2"], 3)], "pool string, bucket string, keys array<string>, picks int")
    assert [r["key"] for r in Z.acquired(two, 6).orderBy("pick").collect()] == ["a1", "a2", "a1"]
    cool = lambda s, server: one(spark, Z.cooled_until(F.lit(0.0), F.lit(s), F.lit(server).cast("double")))
    assert (cool(1, None), cool(2, None), cool(1, 75.0), cool(9, None)) == (20.0, 40.0, 75.0, 300.0)
    race = lambda p, c, d: tuple(one(spark, Z.race(F.lit(p).cast("double"), F.lit(c).cast("double"), F.lit(d))))
    assert race(10.0, 2.0, 3.0) == (5.0, "copy") and race(2.0, 1.0, 3.0) == (2.0, "primary") and race(5.0, 2.0, 3.0) == (5.0, "primary") and race(None, 4.0, 3.0) == (7.0, "copy")
    chain = spark.createDataFrame([("a", 1, "unavailable"), ("a", 2, "blocked"), ("a", 3, "ok")], "k string, n int, state string")
    assert tuple(Z.first_available(chain, ["k"], "n").first()) == ("a", "blocked", 2)
    tries = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, False)], "k string, n int, ok boolean")
    assert Z.failover(tries, ["k"], "n").count() == 2
    units = spark.createDataFrame([("a", 0, 9.0), ("b", 1, 1.0), ("c", 2, 2.0)], "unit string, nth int, ready double")
    assert [r["unit"] for r in Z.ready_first(units, 3).orderBy("place").collect()] == ["b", "c", "a"]
    rounds = spark.createDataFrame([("a", 0), ("b", 2), ("c", 9)], "unit string, failures int")
    assert sorted(map(tuple, Z.retry_rounds(rounds, 3).collect())) == [("a", 1, "ok"), ("b", 3, "ok"), ("c", 3, "failed")]
    assert [one(spark, Z.unit_status(F.col("s")), s=s) for s in (["ok", "failed"], ["blank", "blank"], ["ok", "blank"])] == ["failed", "blank", "ok"]
    assert [one(spark, Z.submitted_route(F.lit(a), F.lit(b))) for a, b in ((0, 0), (2, 1), (2, 2))] == ["link", "relay", "upload"]
    assert one(spark, Z.page_source(F.lit("a"), F.lit("b"))) == "ocr+model"


def test_batch_answers(spark):
    from foliospark.functions import pages as G2

    good = "<!-- 第 7 页 -->\nseven\n<!--第 8 页-->\neight"
    f = lambda t: text(spark, G2.batch_answer, t, F.array(F.lit(7), F.lit(8)))
    assert [tuple(r) for r in f(good)] == [(7, "seven"), (8, "eight")]
    for bad in ("seven", "intro " + good, good.replace("eight", " "), good.replace("8", "9"), good + "\n<!-- 第 8 页 -->\nagain", good.replace("eight", "x" * 31_000)):
        assert f(bad) is None


def test_payloads(spark):
    from foliospark.functions import pages as G2

    parts = [{"text": "t", "thought": True}, {"executableCode": {"language": "PYTHON", "code": "print(42)"}}, {"codeExecutionResult": {"outcome": "OUTCOME_OK", "output": "42\n"}}, {"functionCall": {"id": "f", "name": "g", "args": {"a": 1}}}, {"text": "answer"}]
    web = [{"web": {"uri": "http://a", "title": "A"}}, {"web": {"uri": "http://a", "title": "A"}}, {"web": {"uri": "http://b"}}, {"web": {"title": "none"}}]
    payload = json.dumps({"candidates": [{"content": {"parts": parts}, "groundingMetadata": {"groundingChunks": web}}]})
    df = spark.createDataFrame([("m", payload)], "message string, payload string")
    rows = G2.payload_parts(df).orderBy("seq")
    assert [r["type"] for r in rows.collect()] == ["reasoning", "server_tool", "server_tool", "tool", "text"]
    tools = rows.filter("side IS NOT NULL")
    assert paired(tools, P.FIRST_IF_NO_ID) == [(False, 2, 3, "call_id"), (False, 4, None, None)]
    assert sorted((r["title"], r["url"]) for r in G2.citations(df).collect()) == [("A", "http://a"), ("http://b", "http://b")]


def test_replies(spark):
    from foliospark.functions import replies as Y

    assert one(spark, Y.image_urls(F.col("l"), F.col("t")), l=["http://a", "ftp://b", "http://a"], t='x <!-- aw:images:["https://c", "data:image/png;base64,x"] -->') == ["http://a", "https://c", "data:image/png;base64,x"]
    assert text(spark, Y.usage, '{"total_tokens": 5, "total_cached_tokens": -1, "total_input_tokens": true, "x": 1}') == {"totalTokens": 5}
    got = text(spark, Y.summary, 'sure: ```json\n{"done": ["a", " "], "next": ["' + "b" * 200 + '"]}\n```')
    assert (got["done"], len(got["next"][0]), got["risks"]) == (["a"], 120, []) and text(spark, Y.summary, "none") is None
    rows = Y.snapshot_rows(spark.createDataFrame([("s", '{"status": "done", "steps": [{"type": "thought"}, null]}')], "stream string, data string"))
    assert sorted((r["row"], r["kind"]) for r in rows.collect()) == [(-1, "snapshot"), (0, "thought")]
    assert one(spark, Y.unknown_settings(F.col("m"), ["a"]), m={"a": "1", "z": "2"}) == ["z"]
    assert one(spark, Y.redacted_list(F.col("l")), l=["Bearer abc", "x"]) == ["Bearer [REDACTED]", "x"]


def test_mentions(spark):
    from foliospark.functions import pages as G2

    repos = spark.createDataFrame([("me/any-flow",), ("me/other-tool",), ("you/page-tool",)], "name string")
    tasks = spark.createDataFrame([(1, "deploy me/any-flow now"), (2, "fix anyflow"), (3, "the tool is broken"), (4, "hello")], "task int, text string")
    got = {(r["task"], r["name"]) for r in G2.mentioned_repositories(tasks, repos).collect()}
    assert got == {(1, "me/any-flow"), (2, "me/any-flow"), (3, "me/other-tool"), (3, "you/page-tool")}
