"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed into cells of (source, language, topic). Raking scales the
cells until the token shares of every source, language and topic meet their
targets; a cell's weight over its tokens, scaled so that the largest is 1, is
the probability with which its documents are kept. Only DataFrame operations:
cells stay in Spark, whatever the number of sources.

A round is one job. The cells of a source, at most languages times topics, meet
its target in a window; what they sum to in each (language, topic) is a small
table, in which the factors of languages and topics are found. Only that table
is written in a round, and the one before it is removed.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, stored

DIMS = ("source", "lang", "topic")
#: Target share of a value: its own token share to this power, so that large ones give way to small ones.
TEMPER = 0.9
ROUNDS, TOLERANCE = 50, 1e-5
SEED = 20_240_101
#: What a missing source or language counts as.
UNKNOWN = "(none)"
#: Topics by the marks that a text holds; most different marks win, the first of equals. Any table of this form will do; each mark is one search of every text.
TOPICS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("legal", ("icense", "opyright")),
    ("contact", ("@", "tel.")),
    ("code", ("();", "return ")),
    ("web", ("http", "www.")),
)
OTHER = "general"


def tokens_of(text: Column) -> Column:
    """Words, at least one, so that an empty document has a weight too."""
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(1).cast("long"))


def topic_of(text: Column, topics: tuple[tuple[str, tuple[str, ...]], ...] = TOPICS) -> Column:
    """The topic with the most of its marks in the text."""
    scores = [sum((F.contains(text, F.lit(m)).cast("int") for m in marks), F.lit(0)) for _, marks in topics]
    named = F.array_max(F.array(*[F.struct(score.alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name")) for i, (score, (name, _)) in enumerate(zip(scores, topics, strict=True))]))
    return F.when(named["score"] > 0, named["name"]).otherwise(F.lit(OTHER))


def _measured(docs: DataFrame) -> DataFrame:
    """(row, source, lang, topic, tokens): row holds all columns of ``docs``. A string column ``topic`` is taken as it is."""
    text = F.coalesce("row.text", F.lit(""))
    own = lambda c: F.coalesce(F.col(f"row.{c}").cast("string"), F.lit(UNKNOWN))
    topic = own("topic") if "topic" in docs.columns else topic_of(text)
    return docs.select(F.struct("*").alias("row")).select("row", own("source").alias("source"), own("lang").alias("lang"), topic.alias("topic"), tokens_of(text).cast("double").alias("tokens"))


def _stacked(cells: DataFrame) -> DataFrame:
    """(dim, value, tokens): the cells once for each dimension."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in DIMS])).alias("e")
    return cells.select(each, "tokens").select("e.dim", "e.value", "tokens")


def tempered_targets(cells: DataFrame, temper: float = TEMPER) -> DataFrame:
    """Default targets (dim, value, target); rake scales them to shares."""
    return _stacked(cells).groupBy("dim", "value").agg(F.pow(F.sum("tokens"), F.lit(temper)).alias("target"))


def _goals(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """(dim, value, target) of the values that have documents, shares that sum to 1 in each dimension."""
    there = targets.join(_stacked(cells).select("dim", "value").distinct(), ["dim", "value"], "left_semi")
    sums = there.groupBy("dim").agg(F.sum("target").alias("all"))  # three rows
    return there.join(F.broadcast(sums), "dim").select("dim", "value", F.coalesce(F.try_divide("target", "all"), F.lit(0.0)).alias("target"))


def rake(cells: DataFrame, targets: DataFrame, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """``cells`` (source, lang, topic, tokens) plus ``weight``: token shares that meet the targets; and the largest gap that is left.

    Values without a target get weight 0. Targets that contradict each other
    (cells without documents may forbid a solution) leave a gap above
    ``tolerance`` after all rounds; it is returned and warned of, not hidden.
    """
    goals = stored(_goals(cells, targets))
    of = lambda d: goals.filter(F.col("dim") == d).select(F.col("value").alias(d), F.col("target").alias(f"t_{d}"))
    base = cells
    for d in DIMS:
        base = base.join(of(d), d, "left")
    base = stored(base.select(*DIMS, "tokens", *[F.coalesce(f"t_{d}", F.lit(0.0)).alias(f"t_{d}") for d in DIMS]))
    dropped(goals)
    strata = ["lang", "topic", "t_lang", "t_topic"]
    factors = stored(base.select(*strata).distinct().withColumn("factor", F.lit(1.0)))
    source = Window.partitionBy("source")  # at most languages times topics cells

    def scaled(factors: DataFrame) -> DataFrame:
        own = base.join(factors.select("lang", "topic", "factor"), ["lang", "topic"]).withColumn("y", F.col("tokens") * F.col("factor"))
        return own.withColumn("weight", F.coalesce(F.try_divide(F.col("y") * F.col("t_source"), F.sum("y").over(source)), F.lit(0.0)))

    gap = 0.0
    for _ in range(rounds):
        met = scaled(factors).groupBy(*strata, "factor").agg(F.sum("weight").alias("m"))
        lang, topic = Window.partitionBy("lang"), Window.partitionBy("topic")
        looked = met.withColumns({"lang_now": F.sum("m").over(lang), "topic_now": F.sum("m").over(topic)})
        by_lang = looked.withColumn("m1", F.coalesce(F.try_divide(F.col("m") * F.col("t_lang"), F.col("lang_now")), F.lit(0.0)))
        by_topic = by_lang.withColumn("m2", F.coalesce(F.try_divide(F.col("m1") * F.col("t_topic"), F.sum("m1").over(topic)), F.lit(0.0)))
        off = F.greatest(F.abs(F.col("lang_now") - F.col("t_lang")), F.abs(F.col("topic_now") - F.col("t_topic")))
        now = stored(by_topic.select(*strata, (F.col("factor") * F.coalesce(F.try_divide("m2", "m"), F.lit(0.0))).alias("factor"), off.alias("off")))
        gap = now.agg(F.max("off")).first()[0] or 0.0
        if gap < tolerance:  # the factors before this round meet all targets
            dropped(now)
            break
        dropped(factors)
        factors = now
    else:
        if rounds:
            warnings.warn(f"raking leaves a gap of {gap:.2g} to the targets after {rounds} rounds", stacklevel=2)
    out = stored(scaled(factors).select(*DIMS, "tokens", "weight"))
    dropped(factors)
    dropped(base)
    return out, gap


def mixture(docs: DataFrame, targets: DataFrame | None = None, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(row, source, lang, topic, tokens, weight, probability, gap, selected): row holds all columns of ``docs``.

    ``targets`` has (dim, value, target) for the dimensions source, lang and
    topic. Without any the tempered shares are used. A document is selected if a
    uniform hash of its doc_id and text lies below its probability: the same rows
    give the same sample, and rows that are repeated are selected together. A
    missing source or language is a value of its own, an empty text counts as one
    token, and nothing depends on a text's length but its tokens.
    """
    measured = _measured(docs)
    cells = stored(measured.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")))
    raked, gap = rake(cells, tempered_targets(cells) if targets is None else targets, rounds)
    dropped(cells)
    scaled = raked.select(*DIMS, (F.col("weight") / F.col("tokens")).alias("weight"))
    top = scaled.agg(F.max("weight")).first()[0]
    rated = scaled.withColumn("probability", F.coalesce(F.try_divide("weight", F.lit(top)), F.lit(0.0)))
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "row.doc_id", F.coalesce("row.text", F.lit(""))), 11) / F.lit(float(1 << 53))
    return measured.join(rated, list(DIMS), "left").select("row", *DIMS, "tokens", "weight", "probability", F.lit(gap).alias("gap"), (uniform < F.col("probability")).alias("selected"))


def mixture_report(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability, selected, gap) for each row of ``docs``."""
    own = docs.select(*[c for c in ("doc_id", "source", "lang", "text", "topic") if c in docs.columns])
    return mixture(own).select("row.doc_id", "row.source", "row.lang", "topic", F.col("tokens").cast("long").alias("n_tokens"), "weight", "probability", "selected", "gap")


def sampled(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The selected rows of ``docs``, with their columns."""
    return mixture(docs, targets).filter("selected").select("row.*")
