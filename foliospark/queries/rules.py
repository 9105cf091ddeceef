"""Queries for argument checks, configurations, error classes and tables in pages (F, V, X)."""

from pyspark.sql import functions as F

from ..functions import checks, tables, taxonomy
from ..registry import query
from ..session import table

#: Valid values of the arguments that a part doesn't decide.
USUAL = {
    "output_name": "book", "source_url": "https://e.example/a.pdf", "conversion_type": "pdf_to_md", "system_prompt": "", "prompt": "", "images_per_request": 1, "ocr_relay_url": "", "ocr_url": "http://o.example", "ocr_parallel_jobs": 2,
    "ocr_segment_pages": 10, "jpeg_quality": 95, "verification_passes": 0, "rpm_per_key": 15.0, "rpd_per_key": 500, "retry_rounds": 5, "attempts_per_page": 2, "api_base": "", "reasoning_effort": "", "max_output_tokens": 0, "thinking_level": "high",
    "image_format": "png", "media_resolution": "ultra_high", "svg_api_base": "", "svg_reasoning_effort": "", "svg_prompt": "", "svg_max_output_tokens": 0, "svg_concurrency": 0, "provider": "", "svg_provider": "",
}


@query("""SELECT p_partkey, array_to_string(list_filter([
CASE WHEN p_name LIKE '%ring%' THEN 'source_url' END, CASE WHEN p_retailprice - 900 > 60 THEN 'hedge_after' END, CASE WHEN p_size % 10 = 3 THEN 'hedge_budget' END, CASE WHEN p_size * 3 > 100 THEN 'concurrency' END,
CASE WHEN p_partkey % 400 <> 0 AND p_partkey % 400 NOT BETWEEN 72 AND 300 THEN 'ocr_relay_dpi' END, CASE WHEN p_partkey % 400 NOT BETWEEN 72 AND 300 THEN 'dpi' END, CASE WHEN p_size = 11 THEN 'start_page' END, CASE WHEN p_size % 9 = 0 THEN 'end_page' END,
CASE WHEN p_brand = 'Brand#2' THEN 'provider' END, CASE WHEN p_size <> 11 AND p_size > p_size % 9 AND p_size % 4 > 0 THEN 'start_page<=end_page' END], lambda x: x IS NOT NULL), ',') AS failed FROM part""")
def f17_arguments(spark, folder):
    """Parts as conversions: what their columns make of the arguments, the others usual."""
    size, key = F.col("p_size"), F.col("p_partkey")
    decided = {
        "source_url": F.when(F.contains("p_name", F.lit("ring")), "ftp://e.example").otherwise("https://E.example/x"), "hedge_after": (F.col("p_retailprice") - 900) * 10, "hedge_budget": F.when(size % 10 == 3, -2).otherwise(-1),
        "concurrency": size * 3, "dpi": key % 400, "ocr_relay_dpi": key % 400, "start_page": F.when(size == 11, 0).when(size % 4 > 0, size), "end_page": size % 9, "provider": F.when(F.col("p_brand") == "Brand#2", "p2").otherwise(" P1 "),
    }
    own = table(spark, folder, "part").select("p_partkey", *[decided.get(n, F.lit(v)).alias(n) for n, v in {**USUAL, **dict.fromkeys(decided)}.items()])
    failed = checks.violations((*checks.ARGUMENTS, *checks.of_providers("p1")), checks.ORDERED)
    return own.select("p_partkey", F.array_join(failed, ",").alias("failed"))


@query("""SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size % 5 = 1 THEN 'image_config: no object' END, CASE WHEN p_size % 5 = 2 THEN 'image_config: unknown fields' END, CASE WHEN p_size % 4 = 1 THEN 'svg_config: unknown fields' END,
CASE WHEN p_size % 4 = 2 THEN 'svg_config.enabled: no BOOLEAN' END, CASE WHEN p_size % 5 IN (2, 3) AND p_size < 50 THEN 'image_config.jpeg_quality: out of range' END, CASE WHEN p_size % 4 = 3 THEN 'svg_config.thinking_level: unknown' END], lambda x: x IS NOT NULL), ',') AS faults FROM part""")
def f18_config_faults(spark, folder):
    size = F.col("p_size")
    n = size.cast("string")
    image = F.when(size % 5 == 1, F.concat(F.lit("["), n, F.lit("]"))).when(size % 5 == 2, F.concat(F.lit('{"jpeg_quality":'), n, F.lit(',"x":1}'))).when(size % 5 == 3, F.concat(F.lit('{"jpeg_quality":'), n, F.lit(',"svg":{"model":"m"}}'))).otherwise(" ")
    svg = F.when(size % 4 == 1, F.lit('{"colour":"red"}')).when(size % 4 == 2, F.lit('{"enabled":"yes"}')).when(size % 4 == 3, F.lit('{"thinking_level":"most","concurrency":3}')).otherwise('{"enabled":true,"prompt":"p"}')
    return table(spark, folder, "part").select("p_partkey", F.array_join(checks.config_faults(image, svg), ",").alias("faults"))


#: An error's source, its facts and the class that it belongs to; every class but those that are kinds of others only.
CASES = (
    ("model", {"state": "canceled", "status": "429"}, "canceled"), ("model", {"kind": "argument"}, "invalid"), ("ocr", {"kind": "timeout", "status": "500"}, "transport"), ("model", {"scope": "key", "status": "401"}, "credential retired"),
    ("model", {"pool": "empty", "status": "429"}, "exhausted"), ("model", {"status": "429"}, "rate limited"), ("model", {"status": "422", "answer": "empty"}, "rejected request"), ("model", {"status": "404"}, "unavailable"),
    ("model", {"status": "503"}, "unavailable"), ("model", {"answer": "truncated"}, "truncated"), ("model", {"answer": "blocked"}, "blocked"), ("model", {"answer": "empty"}, "empty answer"), ("model", {"answer": "page marks"}, "batch answer"),
    ("model", {"answer": "faulty"}, "unusable answer"), ("ocr", {"code": "12001", "status": "429"}, "ocr fatal"), ("ocr", {"code": "10004"}, "ocr source rejected"), ("ocr", {"status": "504", "code": "500"}, "ocr fetch timeout"),
    ("ocr", {"status": "502"}, "ocr retryable"), ("ocr", {"job": "failed"}, "ocr job failed"), ("ocr", {"token": "retired"}, "ocr token retired"), ("source", {"range": "whole file"}, "ranges unsupported"), ("source", {"status": "410"}, "source gone"),
    ("source", {"status": "429"}, "error"), ("model", {}, "error"),
)
RETRYABLE = {"canceled": False, "invalid": False, "exhausted": False, "rejected request": False, "truncated": False, "blocked": False, "ocr fatal": False, "ocr source rejected": False, "source gone": False}
TERMINAL = ("canceled", "exhausted", "ocr fatal", "source gone")
CASES_SQL = ", ".join(f"({i}, '{c}', {RETRYABLE.get(c, True)}, {c in TERMINAL}, {c.startswith('ocr')})" for i, (_, _, c) in enumerate(CASES))


@query(f"SELECT event_id, class, retryable, terminal, of_ocr FROM events JOIN (VALUES {CASES_SQL}) v(i, class, retryable, terminal, of_ocr) ON event_id % {len(CASES)} = i")
def v04_error_classes(spark, folder):
    """Events as errors, each with the facts of one case."""
    at = (F.col("event_id") % len(CASES) + 1).cast("int")
    facts = F.array(*[F.create_map(*[F.lit(x) for kv in f.items() for x in kv]).cast("map<string,string>") if f else F.create_map().cast("map<string,string>") for _, f, _ in CASES])
    errors = table(spark, folder, "events").select("event_id", F.element_at(F.array(*[F.lit(s) for s, _, _ in CASES]), at).alias("source"), F.element_at(facts, at).alias("facts"))
    return taxonomy.classified(errors, "event_id").select("event_id", "class", "retryable", "terminal", taxonomy.is_a(F.col("ancestors"), "ocr").alias("of_ocr"))


@query(r"""WITH l AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1), '(?s)<li>(.*?)</li>', 1) AS items FROM pages), i AS (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS n FROM l)
SELECT page_id, 1 AS "row", 'Links|to' AS cells FROM pages UNION ALL
SELECT page_id, n::INTEGER + 1, regexp_replace(regexp_replace(replace(regexp_replace(item, '<[^>]+>', '', 'g'), '&amp;', '&'), '<[^>]+>', '', 'g'), '[\s\\$*`{}]', '', 'g') || '|' || n FROM i""")
def x15_html_rows(spark, folder):
    """Pages whose list of links is a table: a head, a row for each link, and one without a cell's end that is lost."""
    html = F.regexp_replace(F.replace("html", F.lit("<ul>"), F.lit("<table><tr><th>Links<TH>Li nks</th><td> to</TD></tr><tr><td>lost")), "</li>", "</li>")
    number = F.transform(F.split(html, "</li>", -1), lambda part, i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.lit("</td><td title='a>b'>"), i.cast("string"), F.lit("</td></tr>"))))
    parts = F.split(html, "</li>", -1)
    joined = F.array_join(F.transform(F.arrays_zip(number.alias("n"), parts.alias("p")), lambda x: F.concat(x["n"], F.replace(F.replace(x["p"], F.lit("<li>"), F.lit("<tr><td>")), F.lit("</ul>"), F.lit("</table>")))), "")
    rows = tables.table_rows(table(spark, folder, "pages").select("page_id", joined.alias("text")), "page_id")
    return rows.select("page_id", "row", F.array_join("cells", "|").alias("cells"))
