"""Secret scans over a trigram inverted index.

Each rule's regex is parsed, and the strings that any match must contain are
turned into a Boolean query over trigrams (a set of clauses, each a set of
trigrams that must all be there; case is folded for A-Z). The index holds the
postings of the trigrams that the rules ask for, as (trigram, doc_id) rows.
A clause's posting lists are intersected by counting, per document, how many of
the clause's trigrams it has: no posting list is ever held in one row. Documents
that satisfy a clause are verified with the regex. Rules without mandatory
trigrams scan every text.
"""

from __future__ import annotations

import re
import re._constants as _c
import re._parser as _p
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import small_batches, text_of

#: Sets of possible strings larger than this are treated as unknown.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and non-overlapping; a match counts if its ``group`` has ``least`` characters. The span is that of ``span``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    span: int = 0


def _any_case(word: str) -> str:
    return "".join(f"[{ch.upper()}{ch}]" if ch.isalpha() else ch for ch in word)


_PART = "[A-Za-z0-9_-]"
_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key")
#: The first three are the base kinds; the others are what the method adds. A run of hex digits is
#: greedy and starts where no hex digit precedes it, so its minimum length can stand in the pattern.
#: A token's parts have any length: only the first "eyJ" of a run is tried, since later ones end alike.
RULES = (
    Rule("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN (?:(?!PRIVATE KEY-----)[A-Z]++ )*+PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", rf"(?<!{_PART})(?>{_PART}*?(?=eyJ))(eyJ{_PART}{{8,}}+\.eyJ{_PART}{{8,}}+\.{_PART}++)", span=1),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/=-]{16,}"),
)
BASE = ("assign", "access", "hex")


def _fold(code: int) -> str:
    return chr(code + 32) if 65 <= code <= 90 else chr(code)


def _strings(op, arg) -> set[str] | None:
    """All strings that an element of a parsed regex can match, None if there are too many to list."""
    if op is _c.LITERAL:
        return {_fold(arg)}
    if op is _c.AT or op is _c.ASSERT or op is _c.ASSERT_NOT:
        return {""}
    if op is _c.IN and all(o is _c.LITERAL for o, _ in arg):
        return {_fold(a) for _, a in arg}
    if op is _c.SUBPATTERN:
        return _sequence_strings(arg[-1])
    if op is _c.BRANCH:
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if None in parts else _few(set().union(*parts))
    if op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and arg[1] is not _c.MAXREPEAT and arg[1] <= 8:
        one = _sequence_strings(arg[2])
        return None if one is None else _few({"".join(x) for n in range(arg[0], arg[1] + 1) if len(one) ** n <= MOST_STRINGS for x in product(one, repeat=n)}) if len(one) ** arg[1] <= MOST_STRINGS else None
    return None


def _few(strings: set[str]) -> set[str] | None:
    return strings if len(strings) <= MOST_STRINGS else None


def _sequence_strings(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        own = _strings(op, arg)
        if own is None or len(own) * len(out) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def _clauses(items) -> set[frozenset[str]]:
    """Clauses of a sequence; the empty clause among them means that nothing is mandatory."""
    run, found = {""}, {frozenset()}

    def close(strings: set[str]) -> set[frozenset[str]]:
        return {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}

    def both(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
        return a if frozenset() in b or len(a) * len(b) > MOST_STRINGS and frozenset() not in a else {x | y for x in a for y in b}

    for op, arg in items:
        own = _strings(op, arg)
        if own is not None and len(own) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        found, run = both(found, close(run)), {""}
        if own is not None:
            run = own
        elif op is _c.SUBPATTERN:
            found = both(found, _clauses(arg[-1]))
        elif op is _c.BRANCH:
            found = both(found, set().union(*(_clauses(x) for x in arg[1])))
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and arg[0] > 0:
            found = both(found, _clauses(arg[2]))
    return both(found, close(run))


def trigram_query(pattern: str) -> list[list[str]] | None:
    """The clauses of a regex, smallest form, or None if it has no mandatory trigrams."""
    own = _clauses(_p.parse(pattern))
    if frozenset() in own:
        return None
    return sorted(sorted(x) for x in own if not any(y < x for y in own))


def trigram_postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index as rows (trigram, doc_id), for the given trigrams."""
    wanted = [(t, t.encode()) for t in trigrams]
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

    @arrow_udf(T.ArrayType(T.StringType()))
    def present(texts: pa.Array) -> pa.Array:
        rows = []
        for x in texts.cast(pa.binary()).to_pylist():
            own = (x or b"").translate(lower)
            rows.append([t for t, b in wanted if b in own])
        return pa.array(rows, pa.list_(pa.string()))

    return docs.select("doc_id", F.explode(present(text_of())).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, rules) of the documents that satisfy the trigram query of at least one rule."""
    clauses = [(r.kind, i, len(c), t) for r in rules if (q := trigram_query(r.pattern)) for i, c in enumerate(q) for t in c]
    asked = docs.sparkSession.createDataFrame(clauses, "kind string, clause int, need int, trigram string")  # as large as the rules
    postings = trigram_postings(docs, sorted({c[-1] for c in clauses}))
    met = postings.join(F.broadcast(asked), "trigram").groupBy("doc_id", "kind", "clause", "need").agg(F.count_distinct("trigram").alias("has")).filter("has = need")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("rules"))  # at most one entry a rule


def verified(text: Column, kinds: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans (kind, start, end) of the rules without mandatory trigrams and of ``kinds``, by start, then in the rules' order."""
    patterns = [(r, re.compile(r.pattern.encode()), trigram_query(r.pattern) is None) for r in rules]
    names = [r.kind for r in rules]

    def found(raw: bytes, own: set[str]) -> list[tuple[int, int, int]]:
        spans = []
        for i, (rule, regex, always) in enumerate(patterns):
            if always or rule.kind in own:
                spans += [(m.start(rule.span), i, m.end(rule.span)) for m in regex.finditer(raw) if len(m[rule.group]) >= rule.least]
        if not spans:
            return spans
        at, chars, ends = 0, 0, {}
        for b in sorted({b for s in spans for b in (s[0], s[2])}):  # bytes to code points
            chars += len(raw[at:b].decode("utf-8", "replace"))
            at, ends[b] = b, chars
        return sorted((ends[s], i, ends[e]) for s, i, e in spans)

    kind = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    @arrow_udf(T.ArrayType(kind))
    def spans_of(texts: pa.Array, picked: pa.Array) -> pa.Array:
        rows = [[{"kind": names[i], "start": s, "end": e} for s, i, e in found(x or b"", set(k or ()))] for x, k in zip(texts.cast(pa.binary()).to_pylist(), picked.to_pylist(), strict=True)]
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    return spans_of(text, kinds)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``: code point offsets, end exclusive; a null text has no spans.

    Rows that share a doc_id share candidates, and each is verified on its own text.
    """
    small_batches(docs.sparkSession)
    own = docs.select("doc_id", text_of().alias("text"))
    picked = candidates(own, rules).select(F.col("doc_id").alias("__id"), "rules")
    return own.join(picked, F.col("doc_id").eqNullSafe(F.col("__id")), "left").select("doc_id", verified(F.col("text"), F.col("rules"), rules).alias("spans"))
