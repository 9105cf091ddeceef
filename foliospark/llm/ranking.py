"""Ranked lexical search over a two-level quantised index.

Documents are dealt to shards of bounded size; a shard has its own postings. The
first level holds a byte for each posting: the impact of the term in the
document, rounded up to one of 255 steps. Sums of weighted bytes bound a score
from above and, a step lower, from below. The second level holds the exact
counts. A search

1. bounds all documents of each shard and keeps each item's ten highest lower bounds,
2. takes the tenth highest of all shards as the item's threshold,
3. bounds again, and scores exactly every document whose upper bound reaches the threshold.

No document that could be among the ten is lost, however many are equal, and no
task holds more than one shard and one block of items.

The score of a document sums w * ((1000000000 * tf) div (1000 * tf + 8 * m)) over
an item's terms, once each, with w = floor(1000 * ln((2N + 2) / (2df + 1))) and
m = 10 + ((90 * n * N) div L); N counts the documents with a term, L all terms
with repeats, n those of the document, df the documents with the term.

Rows: a null text has no terms, in documents and items; such rows, and empty
tables, find nothing. A document row that occurs twice is two documents, ranked
side by side; an item_id that occurs in two rows is ranked for each. Equal scores
go by doc_id, null first. Texts of any length are read whole. Other columns are
ignored.
"""

from __future__ import annotations

import itertools
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, small_batches, stored, text_of

#: Bytes of text and documents of one shard; a longer document is a shard of its own.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 4096
#: Items that are searched together, which bounds a task's table of sums.
BLOCK_ITEMS = 512
#: Bytes of a text that are counted at once.
PART_BYTES = 1 << 20
#: An impact is below a million: 255 steps of this width cover it.
STEP = 3922
#: Bytes that are no part of a term become a space; A-Z become small.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
SHARDS = "shard bigint, term binary, docs binary, impacts binary, counts binary"


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at once; bytes from 128 on are parts of terms."""
    at = 0
    while at < len(text):
        end = min(at + PART_BYTES, len(text))
        while end < len(text) and FOLD[text[end]] != 32:
            end += 1
        yield text[at:end].translate(FOLD).split()
        at = end


def _texts(docs: DataFrame) -> Column:
    return text_of().cast("binary").alias("text")


def statistics(docs: DataFrame) -> DataFrame:
    """One row (n_docs, n_terms): documents with a term, and all their terms with repeats."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = total = 0
        for batch in batches:
            for text in batch.column(0):
                n = sum(map(len, _terms(text.as_py())))
                many, total = many + (n > 0), total + n
        yield pa.RecordBatch.from_pydict({"n_docs": [many], "n_terms": [total]}, pa.schema({"n_docs": pa.int64(), "n_terms": pa.int64()}))

    counted = docs.select(_texts(docs)).mapInArrow(count, "n_docs bigint, n_terms bigint")
    return counted.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n_terms"))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The exact impact of a term that occurs tf times in a document of n terms; 64-bit integers throughout."""
    m = 10 + (90 * n * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def build_index(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """The stored index of all documents and (N, L).

    A shard's row without a term holds its documents: their ids in ``docs``, their
    lengths in ``counts``, and in ``impacts`` a 1 for each null id. The rows of its
    terms hold places among these documents (32 bits), bytes, and counts (32 bits).
    """
    n_docs, n_terms = statistics(docs).first()
    small_batches(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        names: list = []
        total: array
        size = 0

        def fresh() -> None:
            nonlocal names, total, size, words, term, place, tf
            names, total, size = [], array("q"), 0
            words = defaultdict(itertools.count().__next__)
            term, place, tf = array("I"), array("I"), array("I")

        def shard() -> Iterator[pa.RecordBatch]:
            own = np.frombuffer(term, dtype="u4")
            order = np.argsort(own, kind="stable")
            docs_of, counts = np.frombuffer(place, dtype="u4")[order], np.frombuffer(tf, dtype="u4")[order]
            n = np.frombuffer(total, dtype="i8")
            byte = ((impacts(counts.astype("i8"), n[docs_of], n_docs, n_terms) + STEP - 1) // STEP).astype("u1")
            ends = np.searchsorted(own[order], np.arange(len(words) + 1)).astype("i8")
            nulls = np.array([x is None for x in names], dtype="u1")
            ids = np.array([x or 0 for x in names], dtype="i8")
            here = next(number)
            head = [[here], [None], [ids.tobytes()], [nulls.tobytes()], [n.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(head[0], pa.int64()), *(pa.array(x, pa.binary()) for x in head[1:])], names=NAMES)
            keys = list(words)
            for a in range(0, len(keys), 20_000):
                b = min(a + 20_000, len(keys))
                cuts, low = ends[a : b + 1] - ends[a], slice(ends[a], ends[b])
                lists = [pa.array(keys[a:b], pa.binary())]
                for width, data in ((4, docs_of[low]), (1, byte[low]), (4, counts[low])):
                    lists.append(pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((cuts * width).astype("i4")), pa.py_buffer(data.tobytes())]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, here)), *lists], names=NAMES)

        words = term = place = tf = None
        fresh()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if names and (size + len(text) > SHARD_BYTES or len(names) == SHARD_DOCS):
                    yield from shard()
                    fresh()
                counted: Counter = Counter()
                for part in _terms(text):
                    counted.update(part)
                if not counted:
                    continue
                term.extend(map(words.__getitem__, counted))
                tf.extend(counted.values())
                place.extend(itertools.repeat(len(names), len(counted)))
                names.append(doc_id)
                total.append(sum(counted.values()))
                size += len(text)
        if names:
            yield from shard()

    NAMES = [c.split()[0] for c in SHARDS.split(", ")]
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _texts(docs)).mapInArrow(shards, SHARDS)), n_docs, n_terms


def item_terms(items: DataFrame) -> DataFrame:
    """(query, item_id, term), a row for each distinct term of each row of ``items``; ``query`` numbers the rows."""
    small_batches(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = itertools.count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own, here = sorted(set().union(*_terms(text.as_py()))), next(query)
                for a in range(0, len(own), 100_000):
                    part = own[a : a + 100_000]
                    columns = [pa.array([here] * len(part), pa.int64()), pa.array([item] * len(part), pa.int64()), pa.array(part, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["query", "item_id", "term"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), _texts(items)).mapInArrow(cut, "query bigint, item_id bigint, term binary")


def _sums(table: pa.Table, weights: dict[bytes, list[tuple[int, int]]], many: int) -> tuple:
    """A shard's head and, for each item of a block, sums of weighted bytes and weights over its documents."""
    terms = table.column("term").to_pylist()
    head = terms.index(None)
    at = lambda name, i, kind: np.frombuffer(table.column(name)[i].as_py(), dtype=kind)
    ids, nulls, n = at("docs", head, "i8"), at("impacts", head, "u1"), at("counts", head, "i8")
    upper, count = np.zeros((many, len(ids)), dtype="i8"), np.zeros((many, len(ids)), dtype="i8")
    for i, term in enumerate(terms):
        if i == head:
            continue
        place, byte = at("docs", i, "u4"), at("impacts", i, "u1").astype("i8")
        some = (byte > 0).astype("i8")
        for item, w in weights[term]:
            upper[item][place] += w * byte
            count[item][place] += w * some
    return terms, head, ids, nulls, n, upper, count


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents with a score above 0."""
    index, n_docs, n_terms = build_index(docs)
    found = search_index(index, n_docs, n_terms, items, k)
    dropped(index)
    return found


def search_index(index: DataFrame, n_docs: int, n_terms: int, items: DataFrame, k: int = 10) -> DataFrame:
    """The same over a stored index, block of items by block; a block's terms are all that the driver sees."""
    wanted = stored(item_terms(items))
    queries = wanted.select("query").distinct().count()
    blocks = max(1, -(-queries // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks))
    found = [_block(index, wanted.filter(block == b), n_docs, n_terms, k) for b in range(blocks)]
    dropped(wanted)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _block(index: DataFrame, wanted: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    spark = index.sparkSession
    terms = F.broadcast(wanted.select("term").distinct())  # those of one block of items
    df = index.select("term", "impacts").join(terms, "term", "left_semi").groupBy("term").agg(F.sum(F.octet_length("impacts")).alias("df"))
    weighed = df.select("term", F.floor(1000 * F.log((2 * F.lit(n_docs).cast("double") + 2) / (2 * F.col("df") + 1))).alias("w"))
    rows = wanted.join(weighed, "term").select("query", "item_id", "term", "w").collect()
    places = {q: i for i, q in enumerate(sorted({r["query"] for r in rows}))}
    names = {places[r["query"]]: r["item_id"] for r in rows}
    weights: dict[bytes, list[tuple[int, int]]] = {}
    for r in rows:
        weights.setdefault(bytes(r["term"]), []).append((places[r["query"]], r["w"]))
    many, shared = len(places), spark.sparkContext.broadcast(weights)

    def bounds(table: pa.Table) -> pa.Table:
        *_, upper, count = _sums(table, shared.value, many)
        lower = (upper - count) * STEP + count  # an impact above b - 1 steps is one more at least
        item, value = [], []
        for i in range(many):
            own = lower[i][lower[i] > 0]
            best = np.partition(own, -k)[-k:] if len(own) > k else own
            item += [i] * len(best)
            value += best.tolist()
        return pa.table({"item": pa.array(item, pa.int32()), "bound": pa.array(value, pa.int64())})

    with_heads = F.broadcast(wanted.select(F.col("term").alias("__term")).distinct().unionByName(spark.createDataFrame([(None,)], "__term binary")))
    lists = index.join(with_heads, F.col("term").eqNullSafe(F.col("__term")), "left_semi")
    first = lists.select("shard", "term", "docs", "impacts", F.when(F.col("term").isNull(), F.col("counts")).alias("counts"))
    bounded = first.groupBy("shard").applyInArrow(bounds, "item int, bound bigint")
    ranked = bounded.withColumn("at", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound")))).filter(F.col("at") <= k)
    floor = np.ones(many, dtype="i8")  # scores above 0 only
    for r in ranked.filter(F.col("at") == k).collect():  # a row for each item of the block
        floor[r["item"]] = r["bound"]
    least = spark.sparkContext.broadcast(floor)

    def exact(table: pa.Table) -> pa.Table:
        terms, head, ids, nulls, n, upper, _ = _sums(table, shared.value, many)
        reach = upper * STEP >= least.value[:, None]
        score = np.zeros_like(upper)
        for i, term in enumerate(terms):
            if i == head:
                continue
            place = np.frombuffer(table.column("docs")[i].as_py(), dtype="u4")
            for item, w in shared.value[term]:
                kept = reach[item][place]
                if kept.any():
                    tf = np.frombuffer(table.column("counts")[i].as_py(), dtype="u4")[kept].astype("i8")
                    score[item][place[kept]] += w * impacts(tf, n[place[kept]], n_docs, n_terms)
        out: list[list] = [[], [], []]
        for item in range(many):
            own = np.nonzero(score[item] > 0)[0]
            top = own[np.lexsort((ids[own], 1 - nulls[own], -score[item][own]))[:k]]
            out[0] += [item] * len(top)
            out[1] += [None if nulls[d] else int(ids[d]) for d in top]
            out[2] += score[item][top].tolist()
        return pa.table({"item": pa.array(out[0], pa.int32()), "doc_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    scored = lists.groupBy("shard").applyInArrow(exact, "item int, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    top = stored(scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
    named = spark.createDataFrame(list(names.items()) or [(0, None)], "item int, item_id bigint")
    return top.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
