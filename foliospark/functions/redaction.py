"""Redaction of secrets. The four policies differ and are kept apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "[REDACTED]"
# Token prefixes, authorization schemes, key=value pairs, user data in URLs.
PATTERNS = (
    (r"\b(?:gh[pousr]_[A-Za-z0-9_]+|github_pat_[A-Za-z0-9_]+|AIza[A-Za-z0-9_-]{20,})", MASK),
    (r"(?i)(\b(?:Bearer|Basic)\s+)[A-Za-z0-9._~+/=-]+", "$1" + MASK),
    (r"""(?i)((?:password|authorization|api[_-]?key|access[_-]?token|token|secret)["']?\s*[:=]\s*["']?)[^\s,"';&}]+""", "$1" + MASK),
    (r"(https?://)[^/@\s]+:[^/@\s]+@", "$1" + MASK + "@"),
)


def expanded(secrets: list[str]) -> list[str]:
    """Secrets of four characters or more, longest first, then their basic-auth forms."""
    import base64

    own = sorted({s for s in secrets if len(s) >= 4}, key=lambda s: (-len(s), s))
    return own + [base64.b64encode(f"x-oauth-basic:{s}".encode()).decode() for s in own]


def redact(text: Column, secrets: list[str] | None = None) -> Column:
    """Known secrets literally, longest first, then the patterns."""
    for s in expanded(secrets or []):
        text = F.replace(text, F.lit(s), F.lit(MASK))
    for pattern, mask in PATTERNS:
        text = F.regexp_replace(text, pattern, mask)
    return text


def redact_keys(text: Column, keys: list[str], most: int = 500) -> Column:
    """Error texts: the keys as they stand, then cut."""
    for k in sorted(keys, key=lambda k: (-len(k), k)):
        text = F.replace(text, F.lit(k), F.lit(MASK))
    return F.left(text, F.lit(most))


def log_chunks(text: Column, size: int = 4000) -> Column:
    """(part, parts, chunk) structs of a redacted text; an empty text has one empty chunk. The text is redacted once, before it is cut."""
    cut = F.regexp_extract_all(redact(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    some = lambda own: F.when(F.size(own) == 0, F.array(F.lit(""))).otherwise(own)
    numbered = lambda own: F.transform(own, lambda c, i: F.struct((i + 1).alias("part"), F.size(own).alias("parts"), c.alias("chunk")))
    return F.get(F.transform(F.array(cut), lambda own: numbered(some(own))), F.lit(0))
