"""The conversation trie, packing and ranked search against plain readings of their contracts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import packing, prefixes, queries, ranking

TURNS = "conv_id long, turn long, role string, text string, path string, sizes int, node string, kind int"


# 11. Conversation trie


def turns(seed=3, conversations=60):
    rnd = random.Random(seed)
    say = ["", "hi", "é", "yes", "no", None]
    rows = []
    for c in range(conversations):
        if c in (5, 17):  # an absent first conversation of five, an absent one among them
            continue
        for t in range(rnd.randint(1, 12)):
            rows.append((c, t if rnd.random() < 0.95 or t else None, rnd.choice(["user", "assistant", None]) if rnd.random() < 0.2 else ("user", "assistant")[t % 2], rnd.choice(say), "p", 1, "n", 2))
    rows += [(1000 + i, 0, "user", "same", None, None, None, None) for i in range(40)] + [(1000 + i, 1, "assistant", "x" * (i % 3), None, None, None, None) for i in range(40)]
    rows += [rows[3], (None, 0, "user", "hi", None, None, None, None), (2001, 0, None, None, None, None, None, None)]
    rows += [(3000, i, "user", f"long {i}", None, None, None, None) for i in range(300)]
    return rows


def plain_arrays(rows):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append(((t is not None, t or 0), digest, role, text))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}


def plain_rebuilt(own):
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + mine[h:]
    return out


def plain_trie(arrays):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, a in arrays.items():
        for d in range(len(a) + 1):
            members[tuple(a[:d])].append(c)
            if d:
                children[tuple(a[: d - 1])].add(tuple(a[:d]))
        ends[tuple(a)].append(c)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], sha(p)) for p, m in members.items())


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def as_counter(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_trie(spark, partitions):
    """One stretch of the order, some, and so many that copies, paths and the long conversation are cut."""
    rows = turns()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = prefixes.prefix_trie(prefixes.rebuilt(prefixes.turn_arrays(spark.createDataFrame(rows, TURNS).repartition(3))))
        assert as_counter(made) == plain_trie(plain_rebuilt(plain_arrays(rows)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_trie_of_plain_conversations(spark):
    """Without rebuilding, joined by key in place of broadcasts."""
    rows = turns(9, 30)
    before = prefixes.BROADCAST_NODES
    prefixes.BROADCAST_NODES = -1
    try:
        made = prefixes.prefix_trie(prefixes.turn_arrays(spark.createDataFrame(rows, TURNS)).select("conv_id", "turns"))
        assert as_counter(made) == plain_trie(plain_arrays(rows))
    finally:
        prefixes.BROADCAST_NODES = before


def test_turnless_and_empty(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefixes.prefix_trie(prefixes.rebuilt(prefixes.turn_arrays(empty))).count() == 0
    c = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    one = spark.createDataFrame([(c, 0, "user", "gone", None, None, None, None)], TURNS)
    (row,) = prefixes.prefix_trie(prefixes.rebuilt(prefixes.turn_arrays(one))).collect()
    assert tuple(row[x] for x in COLUMNS) == (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())


# 12. Packing


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_are_whole_documents(docs, library):
    pieces = packing.packed(docs)
    rows = pieces.withColumn("crc", packing.digest("ids")).collect()
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        start = 0
        for n in packing.lengths(len(ids)):
            want[r["doc_id"], start, n, zlib.crc32(np.array(ids[start : start + n], dtype="<u4").tobytes()), len(ids)] += 1
            start += n
        assert start == len(ids)
    assert Counter((r["doc_id"], r["start"], r["length"], r["crc"], r["doc_tokens"]) for r in rows) == want
    assert all(len(r["ids"]) == 4 * r["length"] and r["length"] & (r["length"] - 1) == 0 and 0 < r["length"] <= 4096 and r["offset"] == 0 for r in rows)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert all(r["sequence_id"] >> 59 == r["length"].bit_length() - 1 for r in rows)


def test_words_as_the_library_cuts_them(library):
    import public_tokenizers

    rnd, own = random.Random(5), packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    odd = [*"abZ1 \t\n\x0b\x0c\r\x1c\x85\xa0é́ͅΣσςİıß.,!'½²日가‍\x00\x7f", " ", " ", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", " ́", "AΣ "]
    texts = ["".join(rnd.choice(odd) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + ["x" * 300_000, "long " * 5000 + "y" * 200]
    for text, ids in zip(texts, own.encode_all([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_texts_are_split_at_white_space(library, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "SPLIT_BYTES", 64)
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    own, rnd = packing.WordIds(public_tokenizers.path("word_bpe_49k.json")), random.Random(2)
    texts = [" ".join("".join(rnd.choice("abcé'<|") for _ in range(rnd.randint(1, 90))) for _ in range(n)) for n in (0, 1, 3, 40, 200)]
    for text, ids in zip(texts, own.encode_all([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_lengths():
    assert packing.lengths(10_000) == [4096, 4096, 1024, 512, 256, 16]
    assert packing.lengths(1) == [1] and packing.lengths(4096) == [4096] and packing.lengths(7, 4) == [4, 2, 1]
    assert all(sum(packing.lengths(n)) == n for n in range(1, 9000, 37))


def test_buckets_and_batches(spark, docs, tmp_path):
    pieces = packing.packed(docs, longest=256).cache()
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.count() == pieces.count() and back.agg(F.max("length")).first()[0] <= 256
    dealt = packing.batches(pieces, 1024)
    per = dealt.groupBy("batch_id").agg(F.countDistinct("length").alias("lengths"), F.sum("length").alias("tokens")).collect()
    assert all(r["lengths"] == 1 for r in per) and sum(r["tokens"] for r in per) == pieces.agg(F.sum("length")).first()[0]
    assert dealt.count() == pieces.count()
    with pytest.raises(ValueError):
        packing.packed(docs, longest=100)
    pieces.unpersist()


# 13. Ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in counted:
            n = sum(c.values())
            m = 10 + (90 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            scores.append((-s, i is not None, i or 0, i))
        top = sorted(x for x in scores if x[0] < 0)[:k]
        out.update((item, rank, i, -s) for rank, (s, _, _, i) in enumerate(top, 1))
    return out


ITEMS = "item_id long, text string, query string, term string, w int"


def items_of(rows, seed=4):
    rnd = random.Random(seed)
    out = []
    for i in range(30):
        t = rnd.choice(rows)["text"] or ""
        words = t.split()
        at = rnd.randint(0, len(words))
        out.append((i, " ".join(words[at : at + 25]), "q", "t", 1))
    return out + [(3, "Alpha beta, GAMMA", None, None, None), (40, None, None, None, None), (41, "", None, None, None), (42, "nowhere-to-be-found", None, None, None), (None, "alphabe éé 12", None, None, None), (44, rows[0]["text"], None, None, None)]


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search(spark, docs, monkeypatch, small):
    """Whole shards and blocks, and very small ones."""
    if small:
        monkeypatch.setattr(ranking, "SHARD_DOCS", 3)
        monkeypatch.setattr(ranking, "BLOCK_ITEMS", 7)
        monkeypatch.setattr(ranking, "PART_BYTES", 10)
    rows = docs.collect()
    items = items_of(rows)
    found = ranking.search(docs, spark.createDataFrame(items, ITEMS).repartition(2))
    got = Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect())
    assert got == plain_search([(r["doc_id"], r["text"]) for r in rows], [i[:2] for i in items])


def test_many_equal_documents(spark):
    """Far more copies than ranks: the smallest ids win, in every shard."""
    ranking_docs = [(i, "the same words here" if i % 3 else f"other {i} text", "x") for i in range(400)]
    table = spark.createDataFrame(ranking_docs, "doc_id long, text string, shard string").repartition(5)
    items = [(1, "same words", None, None, None), (2, "text here", None, None, None)]
    got = Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranking.search(table, spark.createDataFrame(items, ITEMS)).collect())
    assert got == plain_search([r[:2] for r in ranking_docs], [i[:2] for i in items])


def test_search_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "alpha", None, None, None)], ITEMS)
    for d, i in ((docs, none), (empty, one), (empty, none)):
        found = ranking.search(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_bounds_hold():
    rnd = np.random.default_rng(1)
    tf, n = rnd.integers(1, 5000, 2000), rnd.integers(1, 10**6, 2000)
    exact = ranking.impacts(np.minimum(tf, n), n, 10**6, 10**9)
    byte = (exact + ranking.STEP - 1) // ranking.STEP
    assert byte.max() <= 255 and (byte * ranking.STEP >= exact).all() and ((byte - (byte > 0)) * ranking.STEP + (byte > 0) <= exact).all()


def test_registered():
    for name in ("op11_conversation_trie", "op12_packing", "op13_ranked_search"):
        assert name in queries.QUERIES
    assert {"op11_conversation_trie", "op13_ranked_search"} <= set(queries.ORACLE_SQL)
