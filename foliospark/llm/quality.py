"""Quality rules as weak supervision.

Each rule votes good (1), votes bad (-1) or abstains (0) on a document's counts.
Expectation-maximisation estimates how often each rule is right on good and on
bad documents, without labels; the verdict is the posterior probability of being
good. The sufficient statistic is the number of documents for each pattern of
votes, at most 3 ** len(RULES) of them whatever the size of the corpus, so only
that bounded table comes to the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import handing_back, small_batches, stored, text_of

SYMBOLS, UPPER = b"#*$%&|<>", bytes(range(65, 91))
SPACES = b"\x20\t\n\x0b\x0c\r"
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs", "n_digits", "n_plain", "n_runs")
COUNTS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

#: Classes of bytes: letters a, digits 0, SYMBOLS #, full stop and comma, white space.
KINDS = bytearray(range(256))
for _kind, _bytes in ((b"a", range(65, 91)), (b"a", range(97, 123)), (b"a", range(128, 256)), (b"0", b"0123456789"), (b"#", SYMBOLS), (b".", b",."), (b" ", SPACES)):
    for _byte in _bytes:
        KINDS[_byte] = _kind[0]
KINDS = bytes(KINDS)

#: (name, good if, bad if) on a row of COUNTS; neither: the rule abstains. Bad wins over good.
RULES: tuple[tuple[str, str, str], ...] = (
    ("length", "n_words >= 50", "n_words < 20"),
    ("repetition", "20 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    ("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    ("lines", "n_dup_lines = 0", "10 * n_dup_lines > 3 * n_lines"),
    ("shouting", "5 * n_upper <= n_letters", "2 * n_upper > n_letters"),
    ("word_length", "word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("exclaiming", "50 * n_bangs <= n_words", "5 * n_bangs > n_words"),
    ("digits", "20 * n_digits <= word_chars", "5 * n_digits > word_chars"),
    ("plain_words", "5 * n_plain >= 4 * n_words", "5 * n_plain < 2 * n_words"),
    ("symbol_runs", "n_runs = 0", "10 * n_runs > n_words"),
)


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by the ``window``-word sequences that occur twice or more, each word once."""
    if len(words) <= window:
        return 0
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    seen = Counter(grams)
    if len(seen) == len(grams):
        return 0
    covered, reach = 0, 0
    for at, gram in enumerate(grams):
        if seen[gram] > 1:
            covered += at + window - max(at, reach)
            reach = at + window
    return covered


def counts(text: bytes) -> tuple[int, ...]:
    """COUNTS of one text in UTF-8."""
    words = text.split()
    bare = text.translate(None, SPACES)
    chars = len(bare) if bare.isascii() else len(bare.decode("utf-8", "replace"))
    lines, dup, n_lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.translate(None, SPACES):
            n_lines += 1
            if line in lines:
                dup += 1
            else:
                lines.add(line)
    upper = len(bare) - len(bare.translate(None, UPPER))
    lower = len(bare) - len(bare.translate(None, bytes(range(97, 123))))
    digits = len(bare) - len(bare.translate(None, b"0123456789"))
    kinds = text.translate(KINDS) + b" "
    plain, runs = kinds.count(b"a ") + kinds.count(b"a. "), kinds.count(b"###")
    symbols = len(bare) - len(bare.translate(None, SYMBOLS))
    return (len(words), chars, symbols, dup, repeat_words(words), n_lines, upper, upper + lower, bare.count(b"!"), digits, plain, runs)


def _counts_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = [counts(x or b"") for x in texts.cast(pa.binary()).to_pylist()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(COUNTS)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(COUNTS))


#: Not "deterministic", else Spark would count once more in a filter below, by a second worker for each task.
counts_of = arrow_udf(handing_back(_counts_of, cached=False), COUNTS_TYPE).asNondeterministic()


def base_failed(c: str) -> Column:
    return F.expr(f"{c}.n_words < 20 OR 100 * {c}.n_repeat_words > 30 * {c}.n_words")


def pattern(c: str) -> Column:
    """The votes as a string of +, - and 0, one character a rule."""
    within = lambda rule: " ".join(f"{c}.{w}" if w in COUNTS else w for w in rule.split())
    return F.concat(*[F.expr(f"CASE WHEN {within(bad)} THEN '-' WHEN {within(good)} THEN '+' ELSE '0' END") for _, good, bad in RULES])


def fit(patterns: Iterable[tuple[str, int]], rounds: int = 100, good: float = 0.85, on_good: float = 0.98, on_bad: float = 0.6) -> dict[str, float]:
    """Posterior probability of good for each vote pattern, by expectation-maximisation.

    Each class has its own probability of a vote for good under each rule; an
    abstention says nothing. The start names the classes: a good document is
    seldom voted down (1 - ``on_good``), and a rule catches some kinds of bad ones
    (1 - ``on_bad``). It also serves as a weak prior of 20 documents, so that no
    probability reaches 0 or 1 and few documents don't move it far.
    """
    own = sorted((p, n) for p, n in patterns)
    if not own:
        return {}
    votes = np.array([[{"+": 1, "-": -1, "0": 0}[v] for v in p] for p, _ in own])
    n = np.array([float(k) for _, k in own])
    up, down, prior = votes > 0, votes < 0, 20.0
    share, p_good, p_bad = good, np.full(votes.shape[1], on_good), np.full(votes.shape[1], on_bad)
    posterior = np.zeros(len(own))
    for _ in range(rounds):
        log = lambda p: (up * np.log(p) + down * np.log1p(-p)).sum(axis=1)
        gap = np.log(share) - np.log1p(-share) + log(p_good) - log(p_bad)
        now = 1 / (1 + np.exp(-np.clip(gap, -500, 500)))
        if np.abs(now - posterior).max() < 1e-9:
            break
        posterior = now
        g, b = n * posterior, n * (1 - posterior)
        share = (g.sum() + prior * good) / (n.sum() + prior)
        p_good = (g @ up + prior * on_good) / (g @ (up | down) + prior)
        p_bad = np.minimum((b @ up + prior * on_bad) / (b @ (up | down) + prior), p_good - 1e-6)  # no vote for good speaks against it
    return {p: float(x) for (p, _), x in zip(own, posterior, strict=True)}


def judged(counted: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``counted`` (with a struct ``counts`` of COUNTS) plus votes, posterior, base_failed and kept."""
    spark = counted.sparkSession
    voted = counted.withColumn("votes", pattern("counts"))
    found = voted.groupBy("votes").count().collect()  # at most 3 ** len(RULES) rows
    scores = fit([(r[0], r[1]) for r in found])
    table = spark.createDataFrame([(p, x) for p, x in scores.items()], "votes string, posterior double")
    scored = voted.join(F.broadcast(table), "votes", "left")
    return scored.withColumn("base_failed", base_failed("counts")).withColumn("kept", ~F.col("base_failed") & (F.coalesce("posterior", F.lit(0.0)) >= threshold))


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts, votes, posterior and verdict for each row of ``docs``; a null text has no words."""
    small_batches(docs.sparkSession)
    counted = stored(docs.select("doc_id", counts_of(text_of()).alias("counts")))
    return judged(counted).select("doc_id", *[f"counts.{c}" for c in COUNTS], "base_failed", "kept", "votes", "posterior")


def passed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever their names.

    A null or empty text has no words and goes; repeated rows have one verdict;
    texts of any length are counted whole. An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    counted = docs.select(F.struct("*").alias("row")).select("row", counts_of(F.coalesce("row.text", F.lit(""))).alias("counts"))  # counted twice: keeping it would keep all texts
    return judged(counted).filter("kept").select("row.*")
