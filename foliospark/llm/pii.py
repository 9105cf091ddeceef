"""Personal data: base patterns, and bootstrapped contextual extraction of unseen identifiers.

Base matches are the seed entities. What stands before a seed induces lexical
patterns: the two words before the word in which it starts, and the one word
before that. Words with digits after the same words are instances of a pattern;
the context of a match is taken from the text in the same way for every kind.
Scores go back and forth over this pattern-instance graph: a pattern is as
trustworthy as the share of its instances that are believed, an instance as
believable as its patterns make it. Instances of patterns that end up trustworthy
and were induced by several different seeds are added as spans.

Only DataFrame operations. The regexes are linear: where the plain form would try
every start in a run of characters, a look-behind admits the first one only, and
repetitions of groups are possessive, so they neither backtrack nor recurse.

A null text is empty and has no spans; rows with equal doc_id and text are one;
rows that share a doc_id are each handled on their own; texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of

SPACE = r"\x20\x09-\x0D"
#: (kind, regex, text that must be there for a match). The match sequence of each equals that of the
#: plain form: \G admits a start right after the match before it. A card's digits are counted in the
#: regex; a run of digits with single separators is maximal, so its neighbours tell its ends.
BASE = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])", ""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
KINDS = tuple(k for k, _, _ in BASE)
#: Words with a digit or an at sign. Every base match starts in one; those with enough digits are what a pattern may find.
WORD = ("word", rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+", "")
LEAST_DIGITS = 4
#: Different seeds that must induce a pattern, its least final score, and the rounds of scoring.
SUPPORT, TRUST, ROUNDS = 3, 0.8, 3
#: Stands for a missing doc_id while rows are keyed.
NO_ID = -(1 << 63)

_OCTET = "0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(i: Column) -> Column:  # i-th digit from the right, from 1
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", match.rlike(rf"^({_OCTET}\.){{3}}{_OCTET}$"))
        .when(kind == "card", F.length(digits).between(12, 19) & luhn(digits))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(F.length(digits) >= LEAST_DIGITS)
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text_of()).alias("mark"), text_of().alias("text"))


def _last_word(text: Column) -> Column:
    """The last word of a text whose white space is blanks, null if there is none."""
    return F.nullif(F.substring_index(F.rtrim(text), " ", -1), F.lit(""))


def matches(docs: DataFrame) -> DataFrame:
    """(id, mark, kind, start, end, match, one, two): base matches that hold, and words with enough digits.

    one is the word before the word in which a match starts, two the word before that.
    """
    text = F.col("text")
    own = lambda kind, regex, must: F.struct(
        F.lit(kind).alias("kind"), F.lit(regex).alias("regex"), F.when(F.contains(text, F.lit(must)), F.regexp_extract_all(text, F.lit(regex), F.lit(0))).alias("m")
    )
    found = _keyed(docs).select("id", "mark", "text", F.explode(F.array(*[own(*k) for k in (*BASE, WORD)])).alias("k")).filter(F.size("k.m") > 0)

    def gap(g: Column) -> Column:
        """Its length; of the gaps between words also their last two words."""
        blank = F.when(F.col("k.kind") == WORD[0], F.translate(g, "\t\n\x0b\x0c\r", "     "))
        last = _last_word(blank)
        return F.struct(F.length(g).alias("n"), last.alias("g1"), _last_word(F.left(F.rtrim(blank), F.length(F.rtrim(blank)) - F.length(last))).alias("g2"))

    gaps = F.transform(F.slice(F.split(text, F.col("k.regex"), -1), 1, F.size("k.m")), gap)
    rows = found.select("id", "mark", "k.kind", F.posexplode(F.arrays_zip(gaps.alias("g"), F.col("k.m").alias("m"))).alias("nth", "z"))
    flat = rows.select("id", "mark", "kind", "nth", F.col("z.g.n").alias("gap"), F.col("z.g.g1").alias("g1"), F.col("z.g.g2").alias("g2"), F.col("z.m").alias("match"))
    once = flat.repartition("id", "mark").dropDuplicates(["id", "mark", "kind", "nth"])  # rows that repeat are one
    line = Window.partitionBy("id", "mark", "kind").orderBy("nth")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = lambda c, n=1: F.lag(c, n).over(line)
    placed = once.select("*", F.sum(F.col("gap") + F.length("match")).over(upto).alias("end"), before("match").alias("m1"), before("match", 2).alias("m2"), before("g1").alias("p1"))
    # Between two words with digits there are whole words only, so the words before one are the gap's last ones, then the word before it.
    one = F.coalesce("g1", "m1")
    two = F.coalesce("g2", F.when(F.col("g1").isNotNull(), F.col("m1")).otherwise(F.coalesce("p1", "m2")))
    placed = placed.select("id", "mark", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match", F.struct(one.alias("one"), two.alias("two")).alias("c"))
    word = F.col("kind") == WORD[0]
    held = Window.partitionBy("id", "mark").orderBy("start", F.when(word, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = placed.withColumn("c", F.last(F.when(word, F.col("c")), ignorenulls=True).over(held))
    return named.filter(_valid(F.col("kind"), F.col("match"))).select("id", "mark", "kind", "start", "end", "match", "c.one", "c.two")


def apart(found: DataFrame) -> DataFrame:
    """``found`` without the words that overlap a base match."""
    place = Window.partitionBy("id", "mark").orderBy("start")
    base = F.col("kind") != WORD[0]
    past = F.max(F.when(base, F.col("end"))).over(place.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    coming = F.min(F.when(base, F.col("start"))).over(place.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    marked = found.withColumn("past", F.coalesce(past, F.lit(0))).withColumn("coming", F.coalesce(coming, F.lit(1 << 62)))
    return marked.filter(base | (F.col("past") <= F.col("start")) & (F.col("coming") >= F.col("end"))).drop("past", "coming")


def patterns_of(one: Column, two: Column) -> Column:
    """The patterns of a match's context: both words, and the nearer one alone, in lower case with runs of digits as 0."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "0")
    return F.array_compact(F.array(F.concat(plain(two), F.lit(" "), plain(one)), plain(one)))


def trusted_patterns(found: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, as_kind, score) of the patterns that are trusted in the end. found: pattern, kind, match.

    Edges are distinct (pattern, instance) pairs, so that copies of a document
    vote once. A pattern's score is the belief in its instances over one more
    than their number, so that few instances prove little. Ties between kinds go to the first in their order.
    """
    edges = found.filter("pattern IS NOT NULL").groupBy("pattern", "kind", "match").agg(F.lit(1).alias("one")).drop("one")
    induced = edges.filter(F.col("kind") != WORD[0]).groupBy("pattern", F.col("kind").alias("as_kind")).agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= support)
    induced = stored(induced)
    edges = stored(edges.join(induced.select("pattern").distinct(), "pattern", "left_semi"))
    links = edges.join(induced.select("pattern", "as_kind"), "pattern")
    belief = links.select("as_kind", "match", F.when(F.col("kind") == F.col("as_kind"), 1.0).otherwise(0.0).alias("b")).groupBy("as_kind", "match").agg(F.max("b").alias("belief"))
    scores = None
    for n in range(rounds):
        scored = links.join(belief, ["as_kind", "match"]).groupBy("pattern", "as_kind").agg((F.sum("belief") / (F.count("*") + 1)).alias("score"))
        scores = stored(scored)
        if n + 1 < rounds:
            doubt = F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999))))
            told = links.join(scores, ["pattern", "as_kind"]).groupBy("as_kind", "match").agg(doubt.alias("d"), F.max((F.col("kind") == F.col("as_kind")).cast("int")).alias("seed"))
            belief = stored(told.select("as_kind", "match", F.when(F.col("seed") == 1, 1.0).otherwise(1 - F.exp("d")).alias("belief")))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    best = scores.filter(F.col("score") >= trust).groupBy("pattern").agg(F.max(F.struct("score", (-order[F.col("as_kind")]).alias("o"), "as_kind")).alias("b"))
    return best.select("pattern", "b.as_kind", "b.score")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(id, mark, spans): sorted spans (start, kind, end) of each distinct (doc_id, text) that has any.

    Code points, end exclusive. Kinds of added spans begin with "like_".
    """
    found = stored(apart(matches(docs)).withColumn("patterns", patterns_of(F.col("one"), F.col("two"))).drop("one", "two"))
    each = found.withColumn("pattern", F.explode("patterns"))
    patterns = trusted_patterns(each.select("pattern", "kind", "match"))
    told = each.filter(F.col("kind") == WORD[0]).join(patterns, "pattern")
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    best = F.max(F.struct("score", -order[F.col("as_kind")], "as_kind")).getField("as_kind")  # of a word's patterns
    added = told.groupBy("id", "mark", "start", "end").agg(F.concat(F.lit("like_"), best).alias("kind"))
    every = found.filter(F.col("kind") != WORD[0]).select("id", "mark", "start", "end", "kind").unionByName(added)
    names = [*KINDS, *(f"like_{k}" for k in KINDS)]
    order = F.create_map(*[F.lit(x) for i, k in enumerate(names) for x in (k, i)])
    ordered = F.array_sort(F.collect_list(F.struct("start", order[F.col("kind")].alias("o"), "end", "kind")))  # as many as a text holds
    return every.groupBy("id", "mark").agg(ordered.alias("spans"))


def spans_by_row(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``; no spans: an empty array."""
    own = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text_of()).alias("mark"))
    none = F.array().cast("array<struct<start:bigint,o:int,end:bigint,kind:string>>")
    return own.join(find_personal_data(docs), ["id", "mark"], "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def _merged(spans: Column) -> Column:
    """Sorted spans, joined where they overlap; the first one's kind stands."""
    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        overlaps = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"])
        return F.when(overlaps, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(own)))

    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"), add)


def masked(text: Column, spans: Column) -> Column:
    """The text with each merged span replaced by its kind in square brackets."""
    own = _merged(spans)
    piece = lambda s, i: F.concat(
        F.substring(text, F.when(i > 0, F.get(own, i - 1)["end"]).otherwise(0).cast("int") + 1, (s["start"] - F.when(i > 0, F.get(own, i - 1)["end"]).otherwise(0)).cast("int")),
        F.lit("["), F.upper(s["kind"]), F.lit("]"),
    )
    tail = F.substring(text, F.element_at(own, -1)["end"].cast("int") + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(own, piece), ""), tail)).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in text, by a join that is planned alike at every size; n_chars follows where there is such a column. Other columns stay as they are, whatever their names."""
    found = find_personal_data(docs).hint("shuffle_hash")  # texts need no sort
    text = F.coalesce("row.text", F.lit(""))
    own = docs.select(F.struct("*").alias("row")).select("row", F.coalesce("row.doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("mark")).join(found, ["id", "mark"], "left")
    own = own.withColumn("masked", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(masked(F.col("row.text"), F.col("spans"))))
    new = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length("masked").cast(docs.schema["n_chars"].dataType))
    return own.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
