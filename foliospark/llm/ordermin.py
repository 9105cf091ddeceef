"""Document fingerprints that are sensitive to edits: Order MinHash.

A document's k-mers are its runs of K words, numbered by occurrence, so that a
repeated one counts each time. One hash deals them into BINS bins of two halves;
the smallest of each half is selected, and a bin's two k-mers, in the order in
which they stand in the text, are hashed to one element of the signature. Two
signatures agree in a bin if both chose the same k-mers in the same order, which
an edit that moves text breaks even where the set of k-mers stays.

Only DataFrame operations. The k-mers of a document are rows of one task, and a
k-mer's hash and place share one long, so that selection is a plain minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of

K, BINS = 2, 64
#: Bits for a k-mer's place in its text; its hash has the upper ones. The bin and half are in the lower ones.
PLACE_BITS = 28
SPACES = r"[\x20\x09-\x0D]+"


def signatures(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, signature): sorted longs, the bin above 32 bits of the element; bins without k-mers are left out.

    ``keys`` identify a row of ``texts`` (keys, text) and ``texts`` should be
    partitioned by some of them. Texts without words are absent; a text of fewer
    than K words has one k-mer, all of it.
    """
    words = texts.select(*keys, F.array_remove(F.split("text", SPACES), "").alias("w"))
    grams = F.arrays_zip(*[F.slice("w", i + 1, F.greatest(F.size("w") - (K - 1), F.lit(1))).alias(f"w{i}") for i in range(K)])
    rows = words.select(*keys, F.posexplode(grams).alias("at", "g")).select(*keys, "at", F.xxhash64(*[f"g.w{i}" for i in range(K)]).alias("kmer"))
    numbered = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys, "kmer").orderBy("at")))
    hashed = numbered.select(*keys, F.xxhash64("kmer", "nth").alias("h"), F.col("at").cast("long").alias("at"))
    packed = F.shiftleft(F.shiftrightunsigned("h", PLACE_BITS), PLACE_BITS).bitwiseOR(F.col("at"))
    half = F.col("h").bitwiseAND(F.lit(BINS).cast("long")) == 0
    binned = hashed.groupBy(*keys, F.col("h").bitwiseAND(F.lit(BINS - 1).cast("long")).alias("bin")).agg(F.min(F.when(half, packed)).alias("a"), F.min(F.when(~half, packed)).alias("b"))
    place = lambda c: F.col(c).bitwiseAND(F.lit((1 << PLACE_BITS) - 1).cast("long"))
    own = lambda c: F.shiftrightunsigned(c, PLACE_BITS)
    pair = F.when(place("a") > place("b"), F.xxhash64(own("b"), own("a"))).otherwise(F.xxhash64(own("a"), own("b")))
    element = F.shiftleft("bin", 32).bitwiseOR(F.shiftrightunsigned(pair, 32))
    return binned.select(*keys, element.alias("e")).groupBy(*keys).agg(F.sort_array(F.collect_list("e")).alias("signature"))  # at most BINS


def likeness(a: str, b: str) -> Column:
    """Share of the bins of either signature in which both agree; 1 if neither has any."""
    none = F.array().cast("array<bigint>")
    x, y = F.coalesce(F.col(a), none), F.coalesce(F.col(b), none)
    bins = lambda s: F.transform(s, lambda e: F.shiftright(e, 32))
    either = F.size(F.array_union(bins(x), bins(y)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / either)


def shown(signature: str) -> Column:
    """A signature as a string: two hex digits for the bin and eight for the element, for each bin."""
    return F.coalesce(F.array_join(F.transform(signature, lambda e: F.lower(F.lpad(F.hex(e), 10, "0"))), ""), F.lit(""))


#: Stands for a missing doc_id while rows are keyed; such rows come before all others but are nobody's neighbour.
NO_ID = -(1 << 63)


def neighbours(docs: DataFrame) -> DataFrame:
    """(id, previous, next, room) in the order of doc_id, around the ends; null ids have none.

    room is how many code points the text before will replace by this text's
    start. Ids are sorted in ranges; the ranges' ends, one row a range, close the gaps.
    """
    sized = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.floor(F.length(text_of()) / 2)).cast("int").alias("half"))
    ids = stored(sized.repartitionByRange("id").withColumn("run", F.spark_partition_id()))
    ends = ids.groupBy("run").agg(F.min("id").alias("first"), F.max(F.struct("id", "half")).alias("last"))  # as many as ranges
    order = Window.orderBy("run")
    all_runs = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("first").over(order), F.min("first").over(all_runs)).alias("after")
    before = F.coalesce(F.lag("last").over(order), F.max("last").over(all_runs)).alias("before")
    within = Window.partitionBy("run").orderBy("id")
    own = ids.join(F.broadcast(ends.select("run", after, before)), "run")
    last = F.coalesce(F.lag(F.struct("id", "half")).over(within), "before")
    return stored(own.select("id", last.alias("last"), F.coalesce(F.lead("id").over(within), "after").alias("next")).select("id", F.col("last.id").alias("previous"), F.col("last.half").alias("room"), "next"))


def edited_text(text: str, following: str) -> Column:
    """The text with its last half (of its code points, rounded down) replaced by as much of the following text's start."""
    n, half = F.length(text), F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(F.col(text), n - half), F.left(F.col(following), half))


def with_edits(docs: DataFrame, rows_each: int = 2500) -> DataFrame:
    """(id, mark, next, next_mark, text, edited) for each distinct row of ``docs``, partitioned by id, about ``rows_each`` to a partition.

    mark is a hash of the text. Of rows that share a doc_id the smallest text
    stands for it where it follows another. Nothing follows a null doc_id. Only
    as much of a following text is sent as the text before it has room for.
    """
    near = neighbours(docs)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-near.count() // rows_each))
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), text_of().alias("text")).repartition(parts, "id")
    own = texts.groupBy("id", F.xxhash64("text").alias("mark")).agg(F.min("text").alias("text"))
    first = texts.groupBy("id").agg(F.min("text").alias("text")).join(near, "id")
    ahead = first.select(F.col("previous").alias("id"), F.left("text", F.col("room")).alias("following"), F.xxhash64("text").alias("next_mark"))
    both = own.join(near.select("id", "next"), "id", "left").join(ahead.repartition(parts, "id"), "id", "left").withColumn("following", F.coalesce("following", F.lit("")))
    return both.select("id", "mark", "next", "next_mark", "text", edited_text("text", "following").alias("edited"))


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are, for each row of ``docs``.

    near_edited compares a text with its edited text, near_next with the text of
    the next doc_id (after the last, the first; the empty text for a null doc_id).
    """
    both = with_edits(docs)
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("t")
    signed = signatures(both.select("id", "mark", kinds).select("id", "mark", "t.kind", "t.text"), "id", "mark", "kind")
    of = lambda kind: F.first(F.when(F.col("kind") == kind, F.col("signature")), ignorenulls=True)
    paired = signed.groupBy("id", F.col("mark").alias("own_mark")).agg(of(0).alias("own"), of(1).alias("changed")).withColumnRenamed("id", "own_id")
    facts = both.select("id", "mark", "next", "next_mark", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    same = (F.col("id") == F.col("own_id")) & (F.col("mark").bitwiseXOR(F.col("own_mark")) == 0)  # both lie by id: no second shuffle
    rows = stored(facts.join(paired, same, "left").drop("own_id", "own_mark"), large=True)
    following = rows.select(F.col("id").alias("next"), F.col("mark").alias("next_mark"), F.col("own").alias("following"))
    found = rows.join(following, ["next", "next_mark"], "left")
    return found.select(
        "id", "mark", "n_chars", "edited_sha256", shown("own").alias("fingerprint"), shown("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )


def edit_report_by_row(docs: DataFrame) -> DataFrame:
    """edit_report with doc_id in place of the keys, and repeated rows as often as they are in ``docs``."""
    times = docs.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text_of()).alias("mark")).agg(F.count("*").alias("times"))
    again = edit_report(docs).join(times, ["id", "mark"]).withColumn("n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return again.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
