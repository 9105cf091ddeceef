"""One query for each operator, over its whole table. Parameters are the production ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, licenses, mixing, ordermin, packing, perplexity, pii, prefixes, quality, ranking, secrets, simhash, suffixes
from .common import documents


def _of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def _joined(spans: Column | str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts and digests of base spans, and all spans as a string."""
    counts = [F.size(_of_kinds(k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(_joined(_of_kinds(*base)), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secrets.find_secrets(documents(spark, sf_dir)), secrets.BASE)


def op2_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(documents(spark, sf_dir))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(documents(spark, sf_dir))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.with_spans(documents(spark, sf_dir)).select("doc_id", suffixes.digest(F.col("text"), F.col("spans")).alias("d")).select("doc_id", "d.*")


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND toxic = 0").select("doc_id")
    return perplexity.classify(documents(spark, sf_dir), trusted)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.edit_report_by_row(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.spans_by_row(documents(spark, sf_dir)), pii.KINDS)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.turn_arrays(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefixes.prefix_trie(prefixes.rebuilt(turns))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", packing.digest("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_ALL = (
    op1_secret_scans, op2_mixing_sources, op3_simhash_near_dedup, op4_license_scans, op5_suffix_array_dedup,
    op6_bpe_encoding, op7_quality_classifier, op8_document_fingerprints, op9_quality_rules, op10_pii,
    op11_conversation_trie, op12_packing, op13_ranked_search,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: The other operators can't be stated in SQL over whole tables; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op11_conversation_trie": """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
steps AS (
    SELECT DISTINCT conv_id, [4294967295::BIGINT] || flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i::INTEGER, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS ops FROM turns
),
heads AS (
    SELECT conv_id, xor(list_reduce(ops, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END), 4294967295::BIGINT) % 9 AS h FROM steps
),
pieces AS (
    SELECT c.conv_id, 0 AS part, place, role, text FROM heads c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND place <= h
    UNION ALL SELECT c.conv_id, 1, place, role, text FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND place > h
),
prefixes AS (
    SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(role) || md5(text), '') OVER w AS path, octet_length(encode(text)) AS size
    FROM pieces WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT conv_id, 0, '', 0 FROM heads
),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM (SELECT conv_id, max_by(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved, CASE WHEN depth > 0 THEN left(path, 64 * (depth - 1)) END AS above FROM prefixes GROUP BY path, depth),
children AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
sums AS (
    SELECT left(path, 64 * unnest(range(0, depth + 1))) AS path, saved, (n_children IS NULL)::BIGINT AS leaf FROM nodes LEFT JOIN children USING (path)
),
subtrees AS (SELECT path, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM sums GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
    coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.above = p.path LEFT JOIN children c ON n.path = c.path LEFT JOIN ends e ON n.path = e.path JOIN subtrees s ON n.path = s.path
""",
    "op13_ranked_search": f"""
WITH postings AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, totals GROUP BY term, docs),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
""",
}
