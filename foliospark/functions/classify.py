"""Classification of statuses, codes and quota messages, and numeric rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PERMANENT = (400, 401, 402, 403, 405, 422)
OCR_RETRYABLE, OCR_FATAL, OCR_REJECTED = (10010, 12002, 500), (401, 12001), (10002, 10004, 10005)
EFFORT = {"minimal": "low", "low": "low", "medium": "medium", "high": "high"}
THINKING = {"none": "off", "xhigh": "high", "max": "high"}
NOT_RETRYABLE = ("blocked", "empty", "permanent", "exhausted")


def compact(text: Column) -> Column:
    """Lower-case letters and digits, one space between words."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")


def quota_class(words: Column) -> Column:
    """Quota kind from an error's keys and strings: per day, tokens, requests, spending; substrings count."""
    c = F.replace(compact(words), F.lit(" "), F.lit(""))
    has = lambda s: F.contains(c, F.lit(s))
    return (
        F.when(has("request") & (has("perday") | has("daily") | has("requestsday")), "rpd")
        .when(has("tpm") | (has("token") & has("perminute")), "tpm")
        .when(has("rpm") | (has("request") & has("perminute")), "rpm")
        .when(has("spend") | has("costlimit"), "spend")
        .otherwise("unknown")
    )


def gateway_quota(words: Column) -> Column:
    c = compact(words)
    has = lambda *s: F.expr("false") if not s else _any(c, s)
    return F.when(has("per day", "daily", "rpd"), "rpd").when(has("per minute", "rpm", "rate limit"), "rpm").when(has("balance", "credit", "quota"), "spend").otherwise("unknown")


def _any(c: Column, parts: tuple[str, ...]) -> Column:
    own = F.contains(c, F.lit(parts[0]))
    for p in parts[1:]:
        own = own | F.contains(c, F.lit(p))
    return own


def status_kind(status: Column) -> Column:
    return F.when(status == 429, "rate_limited").when(status.isin(*PERMANENT), "permanent").when((status == 404) | status.between(500, 599), "unavailable").otherwise("retryable")


def credential_scope(status: Column, words: Column) -> Column:
    marks = ("api key not valid", "api key expired", "api key invalid", "api key service blocked", "invalid api key")
    return F.when(status == 402, "bucket").when(status.isin(401, 403), "key").when((status == 400) & _any(compact(words), marks), "key")


def ocr_class(status: Column, code: Column) -> Column:
    """Fatal, rejected, timeout, retryable, other or ok, in this order."""
    return (
        F.when(code.isin(*OCR_FATAL) | status.isin(401, 403), "fatal")
        .when(code.isin(*OCR_REJECTED), "rejected")
        .when(status.isin(408, 504) | code.isin(408, 504), "timeout")
        .when(code.isin(*OCR_RETRYABLE) | (status == 429) | (status >= 500), "retryable")
        .when((status != 200) | (code != 0), "other")
        .otherwise("ok")
    )


def error_code(raw: Column) -> Column:
    """An error's machine-readable status: digits as they are, an identifier in upper case, else UNKNOWN."""
    return F.when(raw.rlike("^-?[0-9]+$"), raw).when(raw.rlike("^[A-Za-z][A-Za-z0-9_]{0,63}$"), F.upper(raw)).otherwise("UNKNOWN")


def alias(value: Column, names: dict[str, str], other: Column | None = None) -> Column:
    own = None
    for k, v in names.items():
        own = F.when(value == k, v) if own is None else own.when(value == k, v)
    return own.otherwise(value if other is None else other)


def image_detail(level: Column) -> Column:
    last = F.lower(F.element_at(F.split(F.coalesce(level, F.lit("")), "_"), -1))
    return F.when((last == "") | (last == "unspecified"), None).when(last == "low", "low").otherwise("high")


def retry_base(attempt: Column) -> Column:
    """Seconds before jitter: 5, 10, 20, ... from the second round, at most 60."""
    return F.least(F.lit(60.0), 5.0 * F.pow(F.lit(2.0), attempt - 2))


def backoff(strikes: Column) -> Column:
    return F.least(F.lit(300.0), 20.0 * F.pow(F.lit(2.0), F.least(F.lit(4), strikes - 1)))


def submit_timeout(size: Column) -> Column:
    return F.least(F.lit(300.0), F.greatest(F.lit(60.0), 30.0 + size / 1e6))


def link_route(host: Column, size: Column, relay: Column, preferred: list[str]) -> Column:
    """How a source is submitted: through the relay, not by link, or by link."""
    return F.when(relay & host.isin(*preferred), "relay").when(relay & (size > 40_000_000), "relay").when(size > 200_000_000, "no_link").otherwise("link")


def request_bytes(image_bytes: Column, text: Column) -> Column:
    """The size of a request: images in base64, the text in UTF-8 and what surrounds them."""
    return F.floor(image_bytes * 4 / 3).cast("long") + F.octet_length(text) + 65536


def hedge_delay(after: Column, p95: Column) -> Column:
    return F.greatest(after, 2 * F.coalesce(p95, F.lit(0.0)))


def hedge_budget(pages: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(pages * 0.1)).cast("long")


def summary_interval(raw: Column) -> Column:
    value = F.try_cast(raw, "double") if hasattr(F, "try_cast") else raw.try_cast("double")
    return F.when(value.between(15.0, 3600.0), value).otherwise(120.0)


def is_continuation(history: Column, parent: Column, root: Column, identity: Column) -> Column:
    """Whether a job goes on with a thread: it has a history or a parent, or a root that isn't itself."""
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return has(history) | has(parent) | (has(root) & has(identity) & (F.trim(root) != F.trim(identity)))


# How a service says that a precondition failed.
PRECONDITION = (400, "invalid_request", "Precondition check failed.")


def is_precondition_error(status: Column, code: Column, message: Column) -> Column:
    """Exactly the error that a reconnection may meet while the one before is released."""
    return F.coalesce((status == PRECONDITION[0]) & (code == PRECONDITION[1]) & (message == PRECONDITION[2]), F.lit(False))


def source_state(status: Column, path: Column, library: str) -> Column:
    """gone for a missing source of the library below the path ``library``, failed for any other error, else ok."""
    return F.when(status.isin(404, 410) & F.startswith(path, F.lit(library)), "gone").when(status >= 400, "failed").otherwise("ok")
