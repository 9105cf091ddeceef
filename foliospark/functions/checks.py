"""Checks of a conversion's arguments and configuration: constraints as data, compiled to one expression that names all that is wrong."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X
from .payloads import get

MOST_PROMPT = 12_000


@dataclass(frozen=True)
class Check:
    """A constraint on a field: one of the kinds in ``HOLDS``, with its arguments; null passes where the field is ``optional``."""

    field: str
    kind: str
    args: tuple = ()
    optional: bool = False


def _url(c: Column, *schemes: str) -> Column:
    host = F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:@]*)", 1))
    return F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)).isin(*schemes) & (host != "")


#: Kinds of constraints: whether a field meets one.
HOLDS = {
    "between": lambda c, low, high: ~F.isnan(c.cast("double")) & c.between(low, high),
    "zero or between": lambda c, low, high: (c == 0) | c.between(low, high),
    "above": lambda c, low: c > low,
    "at least": lambda c, low: c >= low,
    "one of": lambda c, *values: c.isin(*values),
    "characters": lambda c, most: F.length(c) <= most,
    "url": _url,
    "empty or url": lambda c, *schemes: (c == "") | _url(c, *schemes),
    "name": lambda c: X.valid_name(c),
    "empty or one of": lambda c, *values: (X.strip(F.lower(c)) == "") | X.strip(F.lower(c)).isin(*values),
}

# What a conversion accepts.
EFFORTS = ("minimal", "low", "medium", "high")
ARGUMENTS = (  # what providers there are is the caller's to say: PROVIDER_FIELDS
    Check("output_name", "name"), Check("source_url", "url", ("http", "https")), Check("hedge_after", "between", (0, 600)), Check("hedge_budget", "between", (-1, 10_000)),
    Check("conversion_type", "one of", ("pdf_to_md",)), Check("system_prompt", "characters", (MOST_PROMPT,)), Check("prompt", "characters", (MOST_PROMPT,)),
    Check("images_per_request", "between", (1, 20)), Check("concurrency", "between", (1, 100)), Check("ocr_relay_url", "empty or url", ("https",)), Check("ocr_url", "url", ("http", "https")),
    Check("ocr_parallel_jobs", "between", (1, 10)), Check("ocr_relay_dpi", "zero or between", (72, 300)), Check("ocr_segment_pages", "between", (1, 100)), Check("dpi", "between", (72, 300)),
    Check("jpeg_quality", "between", (50, 100)), Check("verification_passes", "between", (0, 3)), Check("start_page", "at least", (1,), True), Check("end_page", "at least", (1,), True),
    Check("rpm_per_key", "above", (0,)), Check("rpd_per_key", "above", (0,)), Check("retry_rounds", "between", (1, 10)), Check("attempts_per_page", "between", (1, 5)),
    Check("api_base", "empty or url", ("http", "https")), Check("reasoning_effort", "empty or one of", EFFORTS), Check("max_output_tokens", "between", (0, 200_000)),
    Check("thinking_level", "one of", EFFORTS), Check("image_format", "one of", ("png", "jpeg")), Check("media_resolution", "one of", ("unspecified", "low", "medium", "high", "ultra_high")),
    Check("svg_api_base", "empty or url", ("http", "https")), Check("svg_reasoning_effort", "empty or one of", EFFORTS),
    Check("svg_prompt", "characters", (MOST_PROMPT,)), Check("svg_max_output_tokens", "between", (0, 200_000)), Check("svg_concurrency", "between", (0, 100)),
)
PROVIDER_FIELDS = ("provider", "svg_provider")
#: Pairs of fields of which the first is at most the second, where both are given.
ORDERED = (("start_page", "end_page"),)


def of_providers(*names: str) -> tuple[Check, ...]:
    """The fields that name a provider, or nothing."""
    return tuple(Check(f, "empty or one of", names) for f in PROVIDER_FIELDS)


def violations(checks: tuple[Check, ...] = ARGUMENTS, ordered: tuple[tuple[str, str], ...] = ORDERED) -> Column:
    """Names of the fields whose checks don't hold, in the order of the checks; pairs as a<=b. A missing value of a field that isn't optional doesn't hold."""
    each = []
    for check in checks:
        c = F.col(check.field)
        holds = F.coalesce(HOLDS[check.kind](c, *check.args), F.lit(False))
        each.append(F.when(~(c.isNull() | holds) if check.optional else ~holds, F.lit(check.field)))
    each += [F.when(F.col(a) > F.col(b), F.lit(f"{a}<={b}")) for a, b in ordered]
    return F.array_compact(F.array(*each))


# Configurations in JSON: a field's type, and what else holds of it.
IMAGE = {"jpeg_quality": "BIGINT", "svg": "OBJECT"}
SVG = {
    "enabled": "BOOLEAN", "provider": "STRING", "model": "STRING", "api_base": "STRING", "prompt": "STRING", "thinking_level": "STRING", "reasoning_effort": "STRING",
    "max_output_tokens": "BIGINT", "concurrency": "BIGINT",
}


def _once(c: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(c), then), F.lit(0))


def _facts(v: Column) -> Column:
    keys = F.map_keys(v.try_cast("map<string,variant>"))
    return F.struct(v.alias("v"), keys.alias("keys"), F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False)).alias("whole"))


def _config(facts: Column, fields: dict[str, str], prefix: str) -> list[Column]:
    v, keys = facts["v"], facts["keys"]
    unknown = F.when(F.size(F.array_except(keys, F.array(*map(F.lit, fields)))) > 0, F.lit(f"{prefix}: unknown fields"))
    kind = lambda n: F.coalesce(F.schema_of_variant(get(v, n)), F.lit("VOID"))
    wrong = [F.when(F.array_contains(keys, n) & ~F.startswith(kind(n), F.lit(t)), F.lit(f"{prefix}.{n}: no {t}")) for n, t in fields.items()]
    return [unknown, *wrong]


def config_faults(image: Column, svg: Column) -> Column:
    """What is wrong with an image and an SVG configuration in JSON: unknown fields, values of another type, a quality or level that there isn't; empty texts are none.

    Each text is parsed once.
    """

    def faults(s: Column) -> Column:
        i, inner, own = s["image"]["v"], s["inner"], s["svg"]["v"]
        out = []
        for side, fields, prefix in (("image", IMAGE, "image_config"), ("svg", SVG, "svg_config")):
            given, whole = s[f"{side}_given"], s[side]["whole"]
            out.append(F.when(given & ~whole, F.lit(f"{prefix}: no object")))
            out += [F.when(given & whole, c) for c in _config(s[side], fields, prefix)]
        out.append(F.when((F.schema_of_variant(get(i, "jpeg_quality")) == "BIGINT") & ~get(i, "jpeg_quality", "long").between(50, 100), F.lit("image_config.jpeg_quality: out of range")))
        out += [F.when(inner["whole"], c) for c in _config(inner, SVG, "image_config.svg")]
        level = X.strip(F.coalesce(get(own, "thinking_level", "string"), get(inner["v"], "thinking_level", "string"), F.lit("")))
        out.append(F.when(~level.isin("", *EFFORTS), F.lit("svg_config.thinking_level: unknown")))
        return F.array_compact(F.array(*out))

    given = lambda raw: X.strip(F.coalesce(raw, F.lit(""))) != ""
    parsed = F.struct(F.try_parse_json(image).alias("i"), F.try_parse_json(svg).alias("s"))
    facts = lambda p: F.struct(_facts(p["i"]).alias("image"), _facts(p["s"]).alias("svg"), _facts(get(p["i"], "svg")).alias("inner"), given(image).alias("image_given"), given(svg).alias("svg_given"))
    return _once(parsed, lambda p: _once(facts(p), faults))
