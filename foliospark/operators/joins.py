"""Keyed, anti, positional and spatial joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def with_latest(left: DataFrame, right: DataFrame, key: list[str], order: str) -> DataFrame:
    """``left`` with the last row of ``right`` for its key; unmatched rows stay."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    last = right.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")
    return left.join(last, key, "left")


def mapped(rows: DataFrame, column: str, mapping: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """``column`` replaced through ``mapping`` (source, target); values without an (allowed) target stay."""
    usable = mapping if allowed is None else mapping.join(allowed.select(F.col("target")), "target", "left_semi")
    return rows.join(usable, rows[column] == usable["source"], "left").withColumn(column, F.coalesce("target", column)).drop("source", "target")


def zipped(keys: Column, groups: Column) -> Column:
    """Structs (key_index, key, group) by position; without groups each key has its own, key-N.

    Different lengths are an error.
    """
    own = F.when(F.size(groups) == 0, F.transform(keys, lambda _, i: F.concat(F.lit("key-"), (i + 1).cast("string")))).when(F.size(groups) == F.size(keys), groups)
    checked = F.coalesce(own, F.raise_error(F.lit("one non-empty group name is needed for each key")).cast("array<string>"))
    return F.transform(keys, lambda k, i: F.struct((i + 1).alias("key_index"), k.alias("key"), F.get(checked, i).alias("group")))


def unsaved(batch: DataFrame, saved: DataFrame, fields: list[str]) -> DataFrame:
    """Rows of ``batch`` without a saved row that is equal, nulls too, in every field."""
    same = [batch[f].eqNullSafe(saved[f]) for f in fields]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return batch.join(saved, condition, "left_anti")


#: Bytes of anchors in one automaton, which bounds what a task holds.
BLOCK_BYTES = 16 << 20


def holding(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """(text_id, anchor_id) of each text that contains an anchor; an empty anchor is in every text, a null one in none.

    texts: text_id, text; anchors: anchor_id, anchor. Anchors are dealt to blocks
    of bounded size; a block is an automaton that reads each text once, whatever
    the number of anchors. Texts are neither shuffled nor compared pair by pair.
    """
    known = anchors.select("anchor_id", F.col("anchor").cast("string").alias("anchor")).filter("anchor IS NOT NULL")
    size = known.agg(F.coalesce(F.sum(F.octet_length("anchor")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    number = F.pmod(F.xxhash64("anchor"), F.lit(blocks))
    kinds = {n: t.schema[n].dataType.simpleString() for t, n in ((texts, "text_id"), (anchors, "anchor_id"))}
    found = None
    for b in range(blocks):
        rows = known.filter(number == b).collect() if blocks > 1 else known.collect()  # one block of anchors
        hits = _in_block(texts, [(r["anchor"], r["anchor_id"]) for r in rows], kinds)
        found = hits if found is None else found.unionByName(hits)
    return found


def _in_block(texts: DataFrame, anchors: list[tuple], kinds: dict[str, str]) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(anchors)
    schema = T._parse_datatype_string(f"text_id {kinds['text_id']}, anchor_id {kinds['anchor_id']}")
    arrow = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        ids: dict[str, list] = {}
        for anchor, i in shared.value:
            ids.setdefault(anchor, []).append(i)
        automaton = ahocorasick.Automaton()
        for anchor in ids:
            if anchor:
                automaton.add_word(anchor, anchor)
        automaton.make_automaton()
        everywhere = ids.get("", [])
        for batch in batches:
            out: list[tuple] = []
            for text_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text is None:
                    continue
                held = {anchor for _, anchor in automaton.iter(text)} if len(automaton) else set()
                out += [(text_id, i) for anchor in held for i in ids[anchor]] + [(text_id, i) for i in everywhere]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], arrow.field(c).type) for c in range(2)], schema=arrow)

    return texts.select("text_id", "text").mapInArrow(search, schema)


def near(a: str, b: str, width: Column | str, height: Column | str) -> Column:
    """Whether two boxes stand side by side: half of the smaller height overlaps and the gap is at most 8 % of the
    page's width; or both are panels, half of the smaller width overlaps and the gap is at most 5.5 % of its height."""
    c = lambda t, n: F.col(f"{t}.{n}")
    def along(lo: str, hi: str) -> tuple[Column, Column, Column]:
        overlap = F.least(c(a, hi), c(b, hi)) - F.greatest(c(a, lo), c(b, lo))
        smaller = F.least(c(a, hi) - c(a, lo), c(b, hi) - c(b, lo))
        gap = F.greatest(c(a, lo) - c(b, hi), c(b, lo) - c(a, hi), F.lit(0))
        return overlap, smaller, gap

    v_overlap, v_size, v_gap = along("y0", "y1")
    h_overlap, h_size, h_gap = along("x0", "x1")
    width, height = (F.col(x) if isinstance(x, str) else x for x in (width, height))
    side = (v_overlap >= 0.5 * v_size) & (h_gap <= 0.08 * width)
    stacked = c(a, "panel") & c(b, "panel") & (h_overlap >= 0.5 * h_size) & (v_gap <= 0.055 * height)
    return side | stacked
