"""SimHash near-duplicates: a segment-popcount grid join under Manhattan distance.

A fingerprint's 64 bits are cut into 32 segments of two bits; the embedding is
the number of set bits in each. The Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints, so it is a lower bound that
may discard a pair but never a link. Counts are kept as thermometer codes (0, 1
or 2 ones from the low end of each segment), so that a whole embedding is one
long and the Manhattan distance is the bit count of an exclusive or.

The grid: the 32 dimensions are dealt to six blocks. Embeddings at a distance of
three or less differ in at most three blocks, so they share a unit cell in one of
the 20 choices of three blocks. A cell's key has 15 to 17 segments.

Large cells: fingerprints are made distinct first. Each one is then tried
against the smallest of each of its cells (linear), components are formed, and
only pairs of different components that still share a cell are joined, with the
bound and the exact distance inside the join condition. A group of near copies
costs a star, not all of its pairs, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import dropped, handing_back, small_batches, stored, text_of
from .graph import components

DISTANCE = 3
#: Stands for a missing doc_id where one is needed, after all others.
NO_ID = (1 << 63) - 1
LOW_BITS = 0x5555555555555555
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes, k: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a text's k-word shingles, repeats included; 0 without words."""
    words = text.translate(LOWER).split()  # bytes.split() cuts at \x20 and \x09-\x0D
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    n = max(1, len(words) - k + 1)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = [digest(b" ".join(words[i : i + k]), seed) for i in range(at, min(n, at + (1 << 16)))]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, k: int = 3, seed: int = 42) -> Column:
    """The fingerprint as a signed long; the unsigned bits are the same."""

    @arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        own = [fingerprint(x or b"", k, seed) for x in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(own, dtype=np.uint64).view(np.int64))

    return simhash(text)


def thermometer(bits: Column) -> Column:
    """Counts of the two-bit segments as thermometer codes."""
    half = F.shiftrightunsigned(bits, 1)
    one, two = bits.bitwiseOR(half).bitwiseAND(F.lit(LOW_BITS)), bits.bitwiseAND(half).bitwiseAND(F.lit(LOW_BITS))
    return one.bitwiseOR(F.shiftleft(two, 1))


def _masks(distance: int, blocks: int = 0) -> list[int]:
    """Masks of the kept blocks: all but any ``distance`` of that many (2 * distance) blocks of segments."""
    masks = [sum(3 << (2 * int(i)) for i in b) for b in np.array_split(np.arange(32), blocks or 2 * distance)]
    whole = [sum(c) for c in combinations(masks, len(masks) - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in whole]


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def link_components(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp long) to (fp, component): fingerprints connected by links of ``distance`` or fewer bits.

    Repeated fingerprints count once; null fingerprints are left out.
    """
    own = fingerprints.select("fp").filter("fp IS NOT NULL").distinct()
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("grid"), F.col("t").bitwiseAND(F.lit(m).cast("long")).alias("at")) for i, m in enumerate(_masks(distance))]))
    grid = stored(own.withColumn("t", thermometer(F.col("fp"))).select("fp", "t", cells.alias("cell")).select("fp", "t", F.xxhash64("cell.grid", "cell.at").alias("cell")))
    near = (_differing("t", "t2") <= distance) & (_differing("fp", "fp2") <= distance)

    least = grid.groupBy("cell").agg(F.min("fp").alias("fp2"), F.count("*").alias("n")).filter("n > 1").drop("n")
    crowded = grid.join(least, "cell").withColumn("t2", thermometer(F.col("fp2")))
    stars = crowded.filter("fp > fp2").filter(near).select(F.col("fp").alias("u"), F.col("fp2").alias("v"))
    first = components(stars)

    labelled = crowded.select("cell", "fp", "t").join(first, F.col("fp") == F.col("node"), "left").select("cell", "fp", "t", F.coalesce("component", "fp").alias("comp"))
    mixed = labelled.groupBy("cell").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a < b").select("cell")
    left = stored(labelled.join(mixed, "cell", "left_semi"))
    right = left.select("cell", F.col("fp").alias("fp2"), F.col("t").alias("t2"), F.col("comp").alias("comp2"))
    across = left.join(right, (left["cell"] == right["cell"]) & (F.col("comp") < F.col("comp2")) & near)
    more = components(across.select(F.col("comp").alias("u"), F.col("comp2").alias("v")))

    labels = own.join(first, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("comp"))
    return labels.join(more, F.col("comp") == F.col("node"), "left").select("fp", F.coalesce("component", "comp").alias("component"))


def _classes(docs: DataFrame, k: int, distance: int) -> DataFrame:
    """(doc_id, fp, component, component_id) for each row."""
    small_batches(docs.sparkSession)
    own = stored(docs.select("doc_id", fingerprint_of(text_of(), k).alias("fp")))
    labels = link_components(own, distance)
    least = own.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    classes = stored(least.join(labels, "fp").select("fp", "component", "doc_id"))
    smallest = classes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = classes.join(smallest, "component").select("fp", "component", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, k: int = 3, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    component_id is the smallest doc_id of the component, null if it has none.
    Texts without words have fingerprint zero and are linked like any other; rows
    with equal doc_id or null doc_id are each handled on their own.
    """
    return _classes(docs, k, distance).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Near copies by shingle sets: the pipeline's stage. Fingerprints of whole texts differ in some ten of 64 bits where 0.8 of
# the shingles are shared, too many for a selective grid. Here a text has fingerprints of its parts, and the grid is theirs.

#: Shingles of five words; texts are near copies if they share 0.8 of their distinct shingles (Jaccard).
SHINGLE, SIMILARITY = 5, 0.8
#: Parts of a text, at least and at most, the shingles that a part has on average at least, and those that it must have where there are PARTS.
LEAST_PARTS, PARTS, PART_SHINGLES, LEAST_SHINGLES = 8, 16, 3, 3
#: Manhattan distance of two parts' segment counts up to which their texts are tried. A cell keeps all but PART_DISTANCE of PART_BLOCKS blocks:
#: 24 segments, so that few parts share one by chance.
PART_DISTANCE, PART_BLOCKS = 1, 4
#: Sets in a cell up to which all of its pairs of different classes are tried; those of larger cells meet by rare shingles.
CROWDED = 32
#: Longs of a shingle set's sketch.
SKETCH = 8
#: Pairs of one text above which its shingles are dealt to several tasks.
FAN = 256


def shingles(text: bytes, k: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles, ASCII letters in lower case; a shorter text is one shingle, no words none."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest, at = xxhash.xxh64_intdigest, {}
    for w in words:
        if w not in at:
            at[w] = digest(w, seed)
    own = np.array([at[w] for w in words], dtype=np.uint64)
    k = min(k, len(own))
    out = np.zeros(len(own) - k + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + own[i : len(own) - k + 1 + i]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return np.unique(out ^ (out >> np.uint64(32)))


def parts(own: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Slots and SimHash fingerprints (signed) of a shingle set's parts; only parts of one slot, a part's number in its size class, are compared.

    Hashes deal shingles to parts, so equal shingles of two texts are in equal
    parts. There are 8 or 16 parts by the number of shingles; of longer texts every
    second, fourth, ... shingle, by hash, is looked at, so that a part has 3 to 6 of
    them on average at any length; of 16 parts those with fewer than 3 say little
    and are left out. Texts near the end of a size class have parts in the next
    one as well. Parts that no edit touched have equal fingerprints: distance 0.
    """
    slots, out, n = [], [], len(own)
    level = max(0, (n // PART_SHINGLES).bit_length() - 1)
    top = PART_SHINGLES << (level + 1)
    for g in (level, level + 1) if n <= top and n > similarity * top - 1 else (level,):
        count = min(max(1 << g, LEAST_PARTS), PARTS)
        some = own[(own >> np.uint64(8)) & np.uint64((1 << max(0, g - 4)) - 1) == 0]
        part = (some & np.uint64(count - 1)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, some = part[order], some[order]
        if not len(part):
            continue
        new = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        size = np.diff(np.concatenate([new, [len(part)]]))
        if count == PARTS:
            full = size >= LEAST_SHINGLES
            some, new, size = some[np.repeat(full, size)], new[full], size[full]
            named, new = part[new], np.cumsum(size) - size
            if not len(size):
                continue
        else:
            named = part[new]
        bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, new, axis=0, dtype=np.int64)
        prints = np.packbits(2 * ones > size[:, None], axis=1, bitorder="little").view("<u8").ravel()
        slots.append((g * PARTS + named).astype(np.int16))
        out.append(prints.view(np.int64))
    return (np.concatenate(slots), np.concatenate(out)) if out else (np.zeros(0, np.int16), np.zeros(0, np.int64))


SET = "struct<id:bigint,n:int,slots:array<smallint>,prints:array<bigint>>"


def _lists(rows: list[np.ndarray], kind: type = np.int64) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]).astype("i4")), pa.array(flat.view(kind)))


def shingle_set(text: Column, k: int = SHINGLE, similarity: float = SIMILARITY) -> Column:
    """SET of a text: a hash of its shingle set, how many there are and the parts. A text without words has id 0."""

    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            own = [shingles(x or b"", k) for x in texts.cast(pa.binary()).to_pylist()]
            ids = np.array([xxhash.xxh64_intdigest(x.tobytes()) if len(x) else 0 for x in own], dtype=np.uint64).view(np.int64)
            cut = [parts(x, similarity) for x in own]
            columns = [pa.array(ids), pa.array([len(x) for x in own], pa.int32()), _lists([x[0] for x in cut], np.int16), _lists([x[1] for x in cut])]
            yield pa.StructArray.from_arrays(columns, names=["id", "n", "slots", "prints"])

    return arrow_udf(handing_back(sets, cached=False), SET)(text)


def sketch(own: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in 64 * SKETCH buckets, as longs. The sketches of two sets differ in no more bits than the sets in shingles."""
    bucket = (own >> np.uint64(20)).astype(np.int64) % (64 * SKETCH)
    return np.packbits(np.bincount(bucket, minlength=64 * SKETCH) & 1, bitorder="little").view(np.int64)


def shingles_of(text: Column, k: int = SHINGLE) -> Column:
    """Struct (shingles, sketch) of a text: its sorted distinct shingles as signed longs."""

    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            own = [shingles(x or b"", k) for x in texts.cast(pa.binary()).to_pylist()]
            yield pa.StructArray.from_arrays([_lists(own), _lists([sketch(x) for x in own])], names=["shingles", "sketch"])

    return arrow_udf(handing_back(sets, cached=False), "struct<shingles:array<bigint>,sketch:array<bigint>>")(text)


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (u, v) of set ids whose shingles have that Jaccard similarity or more. sets: id, n, shingles.

    A set that is in very many pairs is sent to several tasks, each with a share of them.
    """
    own = pairs.select("u", "v").distinct()
    fans = own.groupBy("v").agg((F.count("*") / FAN).cast("int").alias("fan"))  # one row a set
    dealt = own.join(fans, "v").withColumn("salt", F.pmod(F.xxhash64("u"), F.col("fan") + 1).cast("int"))
    second = sets.join(fans, F.col("id") == F.col("v")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("fan")))).select("v", "salt", F.col("shingles").alias("s2"), F.col("n").alias("n2"))
    first = sets.select(F.col("id").alias("u"), F.col("shingles").alias("s1"), F.col("n").alias("n1"))
    both = dealt.join(first, "u").join(second, ["v", "salt"])
    shared = F.size(F.array_intersect("s1", "s2"))
    return both.filter(shared >= similarity * (F.col("n1") + F.col("n2") - shared)).select("u", "v")


def part_cells(ids: DataFrame, distance: int = PART_DISTANCE) -> DataFrame:
    """(id, n, e, cell): each part's embedding e, as thermometer codes, in each of its grid cells. Parts of one slot at that Manhattan distance or less share one."""
    own = ids.filter("n > 0").select("id", "n", F.explode(F.arrays_zip("slots", "prints")).alias("p")).select("id", "n", "p.slots", thermometer(F.col("p.prints")).alias("e"))
    cells = [F.xxhash64("slots", F.lit(i), F.col("e").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(_masks(distance, max(PART_BLOCKS, 2 * distance)))]
    return own.select("id", "n", "e", F.explode(F.array(*cells)).alias("cell"))


def near_copy_classes(ids: DataFrame, read: Callable[[DataFrame], DataFrame], similarity: float = SIMILARITY, distance: int = PART_DISTANCE) -> DataFrame:
    """(id, class) of the distinct sets that have a near copy; class is the smallest id reachable.

    ids has (id, n, slots, prints) of each set once; ``read`` gets (id) of those that may
    have a near copy and gives (id, n, shingles, sketch).

    The grid join: candidates are sets with parts of one slot whose segment counts are at
    a Manhattan distance of ``distance`` or less. They share a cell; the distance is part
    of the join's condition. First all sets of a cell are tried against one (linear): the
    set whose cells hold the most sets, which of edited copies is the one with the fewest
    edits, and the same in all of their cells. Then the cells' pairs of different classes
    are joined. Sketches bound the difference of two sets from below, so that hardly any
    pairs but links leave the join.

    Sets of cells that still hold several classes and more than CROWDED sets are not all
    paired there: their rarest shingles are. Two sets with that similarity share one of the
    n - ceil(similarity * n) + 1 rarest shingles of the larger one and of the
    n - ceil(2 * similarity / (1 + similarity) * n) + 1 rarest of the smaller one.
    So no link within a cell's sets is lost, and what many unlike texts have in
    common makes no pairs.
    """
    sized = (F.col("n") >= similarity * F.col("n2")) & (F.col("n2") >= similarity * F.col("n"))
    near = _differing("e", "e2") <= distance
    cells = part_cells(ids, distance)
    many = cells.groupBy("cell").agg(F.count("*").alias("many")).filter("many > 1")
    shared = stored(cells.join(many, "cell"))
    popular = shared.groupBy("id").agg(F.sum("many").alias("score"))
    centre = shared.join(popular, "id").groupBy("cell").agg(F.max(F.struct("score", "id", "n", "e")).alias("l")).select("cell", F.col("l.id").alias("v"), F.col("l.n").alias("n2"), F.col("l.e").alias("e2"))
    starred = shared.join(centre, "cell").filter((F.col("id") != F.col("v")) & sized & near).select(F.col("id").alias("u"), "v")
    starred = stored(starred.distinct())
    # Two that share a cell by chance are no longer of interest; of three or more any two may be near.
    some = starred.select(F.col("u").alias("id")).unionByName(starred.select(F.col("v").alias("id"))).unionByName(shared.filter("many > 2").select("id"))
    sets = stored(read(some.distinct()))
    named = _joined(stored(sets.select("id", F.col("id").alias("comp"))), verified(starred, sets, similarity))
    dropped(starred)

    labelled = shared.join(named, "id").select("cell", "id", "n", "e", "comp")
    mixed = labelled.groupBy("cell").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("many")).filter("a < b").select("cell", "many")
    left = stored(labelled.join(mixed, "cell"))
    dropped(shared)
    words = [f"s{i}" for i in range(SKETCH)]
    sketches = sets.select("id", *[F.get("sketch", F.lit(i)).alias(s) for i, s in enumerate(words)])
    second = [F.col(x).alias(f"{x}2") for x in ("id", "n", "comp", *words)]
    apart = sum((_differing(s, f"{s}2") for s in words), F.lit(0))
    alike = sized & (F.col("comp") != F.col("comp2")) & (apart <= (1 - similarity) / (1 + similarity) * (F.col("n") + F.col("n2")) + 1e-9)
    larger = (F.col("n") > F.col("n2")) | (F.col("n") == F.col("n2")) & (F.col("id") > F.col("id2"))
    pair = [F.col("id").alias("u"), F.col("id2").alias("v")]

    few = left.filter(F.col("many") <= CROWDED).drop("many").join(sketches, "id")
    across = few.join(few.select("cell", F.col("e").alias("e2"), *second), "cell").filter(near & alike & larger).select(*pair)

    crowd = stored(left.filter(F.col("many") > CROWDED).select("id", "comp").distinct())
    each = sets.join(crowd, "id").select("id", "n", "comp", F.explode("shingles").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("df"), F.min("comp").alias("a"), F.max("comp").alias("b"))
    ranked = each.join(often, "h").withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("df", "h")))
    length = lambda share: F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    prefix = ranked.filter((F.col("rank") <= length(similarity)) & (F.col("a") < F.col("b")))
    prefix = stored(prefix.join(sketches, "id").select("h", "id", "n", "comp", "rank", *words))
    small = prefix.filter(F.col("rank") <= length(2 * similarity / (1 + similarity))).select("h", F.col("rank").alias("rank2"), *second)
    least = F.ceil((F.col("n") + F.col("n2")) * (similarity / (1 + similarity)) - 1e-9)
    first = (F.col("rank") <= F.col("n") - least + 1) & (F.col("rank2") <= F.col("n2") - least + 1)
    rare = prefix.join(small, "h").filter(alike & larger & first).select(*pair)
    found = stored(across.unionByName(rare).distinct())
    named = _joined(named, verified(found, sets, similarity))
    for table in (sets, left, crowd, prefix, found):
        dropped(table)
    return named.withColumnRenamed("comp", "class")


def _joined(named: DataFrame, links: DataFrame) -> DataFrame:
    """(id, comp) with the classes that links (u, v) connect as one. The table that was there before is removed."""
    of = lambda c: named.select(F.col("id").alias(c), F.col("comp").alias(f"comp_{c}"))
    between = links.join(of("u"), "u").join(of("v"), "v").select(F.col("comp_u").alias("u"), F.col("comp_v").alias("v"))
    more = components(between)
    out = stored(named.join(more, F.col("comp") == F.col("node"), "left").select("id", F.coalesce("component", "comp").alias("comp")))
    dropped(named)
    return out


def deduplicated(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near copies: the smallest doc_id's, with all columns, whatever their names.

    Texts are near copies if their sets of ``k``-word shingles have that Jaccard
    similarity; groups are what such links connect. Texts without words (null,
    empty, white space) are copies of each other; of rows that repeat or share a
    doc_id one stays, and a null doc_id only stays where the group has no other. An
    empty table gives an empty one. Texts are taken whole, at any length.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("row.text", F.lit(""))
    marked = docs.select(F.struct("*").alias("row")).select("row", "row.doc_id", F.xxhash64(text).alias("mark"))  # rows that agree in both are the same to us
    own = stored(marked.select("doc_id", "mark", shingle_set(text, k, similarity).alias("s")).select("doc_id", "mark", "s.*"))
    key = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "mark")
    ids = stored(own.groupBy("id").agg(F.min(key).alias("key"), *[F.first(c).alias(c) for c in ("n", "slots", "prints")]))
    dropped(own)

    def read(some: DataFrame) -> DataFrame:
        marks = ids.join(some, "id").select("id", F.col("key.mark").alias("mark"), "n", F.col("key.doc_id").alias("doc_id"))
        found = marked.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "mark", text.alias("text")).join(marks, ["doc_id", "mark"])
        return found.dropDuplicates(["id"]).select("id", "n", shingles_of(F.col("text"), k).alias("s")).select("id", "n", "s.*")

    classes = near_copy_classes(ids.drop("key"), read, similarity)
    keep = ids.select("id", "key").join(classes, "id", "left").groupBy(F.coalesce("class", "id").alias("class")).agg(F.min("key").alias("key"))
    keep = stored(keep.select(F.xxhash64("key.doc_id", "key.mark").alias("kept")))
    dropped(ids)
    same = marked.select("row", F.xxhash64(F.coalesce("doc_id", F.lit(NO_ID)), "mark").alias("kept"))
    return same.join(keep, "kept", "left_semi").dropDuplicates(["kept"]).select("row.*")  # both lie by key: one shuffle
