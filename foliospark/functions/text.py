"""Text functions over page Markdown, as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup the engine knows.
PAGE_MARK = r"<!-- 第 (\d+) 页 -->"
LOOSE_MARK = r"<!--\s*第\s*(\d+)\s*页\s*-->"
IMAGE = r"!\[[^\]\n]*\]\(images/[^)\s]+\)"
IMAGE_TARGET = r"!\[[^\]\n]*\]\((images/[^)\s]+)\)"
TAG = r"(?i)</?[a-z][a-z\d-]*\b[^>]*>"
IMAGE_LIST_MARK = r"(?s)\n?<!--\s*aw:images:(\[.*?\])\s*-->"
SAFE_DIV = r"""(?:class\s*=\s*["']analysis-box["']|align\s*=\s*["']?right["']?|style\s*=\s*["']\s*text-align\s*:\s*right\s*;?\s*["'])"""
MOST_CHARS, MOST_REPEATS = 30_000, 400
LAYOUT_COMMENT = "此行视具体排版"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def strip(c: Column) -> Column:
    """Without white space at the ends, Unicode white space included."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


#: A character that marks places in a text while it is worked on; where the text holds it itself, it is written as a pair.
MARK = "\ue000"
CUT = MARK + "1"


def marked(text: Column, work: Callable[[Column], Column]) -> Column:
    """What ``work``, which may put CUT into the text and must take it out again, makes of ``text``, whatever characters it holds."""
    own = F.replace(text, F.lit(MARK), F.lit(MARK + "0"))
    return F.replace(work(own), F.lit(MARK + "0"), F.lit(MARK))


def unwrapped(text: Column, removable: Callable[[Column], Column], trim: Callable[[Column], Column]) -> Column:
    """``text`` without the div wrappers whose opening tag is ``removable``, at any depth; their content is trimmed.

    A fold over tags and the text between them keeps what is open: a closing tag
    ends the wrapper that was opened last. A wrapper that stays keeps those around
    it; tags without a partner stay too.
    """
    tag = r"(?i)<div\b[^>]*>|</div\s*>"
    level = lambda tag, free, own: F.struct(tag.alias("tag"), free.alias("free"), own.alias("own"))
    below = lambda s, n: F.slice(s, 1, F.size(s) - n)

    def take(s: Column, piece: Column) -> Column:
        top, under = F.element_at(s, -1), F.try_element_at(s, F.lit(-2))
        free = top["free"] & removable(top["tag"])
        inner = F.when(free, trim(top["own"])).otherwise(F.concat(top["tag"], top["own"], piece))
        closed = F.concat(below(s, 2), F.array(level(under["tag"], under["free"] & free, F.concat(under["own"], inner))))
        added = F.concat(below(s, 1), F.array(level(top["tag"], top["free"], F.concat(top["own"], piece))))
        opened = F.concat(s, F.array(level(piece, F.lit(True), F.lit(""))))
        return F.when(piece.rlike(r"(?i)^<div\b[^>]*>$"), opened).when(piece.rlike(r"(?i)^</div\s*>$") & (F.size(s) > 1), closed).otherwise(added)

    start = F.array(level(F.lit(""), F.lit(True), F.lit("")))

    def folded(own: Column) -> Column:
        pieces = F.split(F.regexp_replace(own, f"({tag})", f"{CUT}$1{CUT}"), CUT, -1)
        return F.aggregate(pieces, start, take, lambda s: F.array_join(F.transform(s, lambda x: F.concat(x["tag"], x["own"])), ""))

    return F.when(text.rlike(r"(?i)</div\s*>"), marked(text, folded)).otherwise(text)


def clean_layout(text: Column) -> Column:
    """Decorative wrappers unwrapped, table styles reduced to alignment, borders dropped, line breaks closed.

    Text, tables and image links stay. Wrappers go, at any depth, if they have no
    attributes or only decorative ones and no wrapper inside stays.
    """
    newlines = lambda c: F.regexp_replace(c, r"^\n+|\n+$", "")
    text = unwrapped(text, lambda tag: tag.rlike(rf"(?is)^<div(?:\s+{SAFE_DIV})?\s*>$"), newlines)
    style = r"""\s+style\s*=\s*(["'])"""
    align = rf"""(?is)(<(?:td|th)\b[^>]*?){style}(?:(?!\2)[^>])*?(?:(?<=["';])|(?<=["';]\s))\s*text-align\s*:\s*(left|right|center)\b(?:(?!\2)[^>])*?\2"""
    text = F.regexp_replace(text, align, '$1 align="$3"')
    text = F.regexp_replace(text, rf"(?is)(<(?:table|td|th)\b[^>]*?){style}.*?\2", "$1")
    text = F.regexp_replace(text, r"""(?i)(<(?:table|td|th)\b[^>]*?)\s+border\s*=\s*(?:(["'])\d+\2|\d+)""", "$1")
    return F.regexp_replace(text, r"(?i)<br\s*/?>", "<br />")


def plain_chars(text: Column) -> Column:
    """Characters that are left without images, tags and white space."""
    return F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, IMAGE, ""), TAG, ""), r"(?U)\s", ""))


def metrics(text: Column) -> dict[str, Column]:
    """Structural counts of a document; indicators, not accuracy."""
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    return {
        "pages": F.size(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PAGE_MARK), F.lit(1)), lambda n: n.cast("int")))).cast("long"),
        "images": count(IMAGE), "html_tags": count(TAG), "div_tags": count(r"(?i)</?div\b"), "nbsp": count("&nbsp;"), "text_chars": plain_chars(text).cast("long"),
    }


def figures_used(text: Column) -> Column:
    """Image targets in order, each once."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(IMAGE_TARGET), F.lit(1)))


def without_fences(text: Column) -> Column:
    """One Markdown fence around the whole answer taken off; tildes first, then back-ticks."""
    def off(c: Column, start: str, end: str) -> Column:
        return F.when(F.startswith(c, F.lit(start)) & F.endswith(c, F.lit(end)), strip(F.substring(c, F.lit(len(start) + 1), F.length(c) - len(start) - len(end))))

    text = F.coalesce(off(text, "~~~markdown", "~~~"), text)
    return F.coalesce(off(text, "```markdown", "```"), off(text, "```md", "```"), text)


def escaped(text: Column) -> Column:
    """White space collapsed and Markdown's special characters escaped."""
    return F.regexp_replace(strip(F.regexp_replace(text, r"(?U)\s+", " ")), r"([\\`*_{}\[\]<>()!#|])", r"\\$1")


def page_links(text: Column) -> Column:
    """Image links as seen from a folder below."""
    return F.replace(text, F.lit("](images/"), F.lit("](../images/"))


def without_image_list(text: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), IMAGE_LIST_MARK, ""))


def image_mime(url: Column, content_type: Column) -> Column:
    """From the content type, else from the path's ending, else PNG."""
    ct = F.lower(strip(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    path = F.lower(F.substring_index(F.substring_index(url, "?", 1), "#", 1))
    own = F.when(ct == "image/jpg", "image/jpeg").when(F.startswith(ct, F.lit("image/")), ct)
    for ending, mime in ((".jpg", "image/jpeg"), (".jpeg", "image/jpeg"), (".png", "image/png"), (".webp", "image/webp"), (".gif", "image/gif")):
        own = own.when(F.endswith(path, F.lit(ending)), mime)
    return own.otherwise("image/png")


def title(raw: Column) -> Column:
    """The first line with text, without markup and punctuation at its ends; 16 characters with Han, else 24."""
    lines = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), r"\r\n|[\n\r]"), strip), lambda x: x != "")
    first = F.coalesce(F.get(lines, 0), F.lit(""))
    ends = F.regexp_replace(F.regexp_replace(first, r"""(?U)^[#*\-\s"'“”‘’《》【】「」]+""", ""), r"""(?U)[#*\-\s"'“”‘’《》【】「」。，,.!?！？:：]+$""", "")
    flat = strip(F.regexp_replace(F.regexp_replace(ends, r"[\x00-\x1f\x7f]", " "), r"(?U)\s+", " "))
    return F.when(flat.rlike("[㐀-鿿]"), F.rtrim(F.left(flat, F.lit(16)))).otherwise(F.rtrim(F.left(flat, F.lit(24))))


def stem(number: Column, last: Column) -> Column:
    """The number with leading zeros, at least three digits and as many as the last page has; never cut."""
    width = F.greatest(F.lit(3), F.length(last.cast("string")), F.length(number.cast("string")))
    return F.lpad(number.cast("string"), width, "0")


def without_controls(text: Column) -> Column:
    """Without control characters but tab, line feed and carriage return."""
    return F.regexp_replace(text, CONTROL, "")


def composed(*parts: Column, default: str) -> Column:
    """The parts with text, a blank line between them, or the default."""
    given = F.array_compact(F.array(*[F.nullif(strip(p), F.lit("")) for p in parts]))
    return F.when(F.size(given) > 0, F.array_join(given, "\n\n")).otherwise(F.lit(default))


def score_text(text: Column) -> Column:
    """For comparing transcriptions: no tags, no white space, none of the characters that mark up."""
    return F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", ""), r"(?U)[\s\\$*`{}]", "")


def formula_text(text: Column) -> Column:
    """Spellings of one LaTeX formula brought together."""
    for old, new in (("\\left", ""), ("\\right", ""), ("\\operatorname", ""), ("\\mathrm", ""), ("\\text", ""), ("\\,", ""), ("\\;", "")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, r"(?U)[\s{}$]", "")


def repeated_numbers(text: Column) -> Column:
    """Standalone lines of four to eight digits, as an array."""
    return F.filter(F.transform(F.split(text, r"\r\n|[\n\r]"), strip), lambda x: x.rlike(r"^\d{4,8}$"))


def runs_away(text: Column) -> Column:
    """Whether one unit of up to 40 characters comes 400 times in a row.

    Such a run holds a whole one of the text's pieces of 100 characters, which then
    has a period of 40 or less: only texts with such a piece are searched for it.
    """
    pieces = F.regexp_extract_all(text, F.lit("(?s).{1,100}"), F.lit(0))
    periodic = F.exists(pieces, lambda p: (F.length(p) == 100) & p.rlike(r"(?s)^(.{1,40}?)\1++.{0,39}$"))
    return F.when(periodic, text.rlike(rf"(?s)(.{{1,40}}?)\1{{{MOST_REPEATS - 1},}}")).otherwise(False)


def fault(text: Column) -> Column:
    """Why a page's Markdown is rejected: the first check that fails, null if none does."""
    numbers = repeated_numbers(text)
    thrice = F.exists(F.array_distinct(numbers), lambda v: F.size(F.filter(numbers, lambda x: x == v)) >= 3)
    return (
        F.when(F.contains(text, F.lit("�")), "replacement")
        .when(F.length(text) > MOST_CHARS, "too_long")
        .when(runs_away(text), "repeats")
        .when(F.contains(text, F.lit(LAYOUT_COMMENT)), "commentary")
        .when(thrice, "numbers")
    )


def items(raw: Column, separators: str = r"[\r\n,;]+") -> Column:
    """A list setting: split, trimmed, without empty items, each once in its first place."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), separators), strip), lambda x: x != ""))


def valid_name(raw: Column) -> Column:
    """Whether a name can serve as an output file's base name."""
    n = strip(raw)
    bad = (
        (n == "") | (F.length(n) > 120) | (F.octet_length(n) > 240) | F.startswith(n, F.lit(".")) | F.lower(n).rlike(r"\.(md|zip)$")
        | n.rlike(r'[<>:"/\\|?*\x00-\x1f\x7f]') | n.rlike(r"[. ]$") | n.rlike(r"(?i)^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])(\.|$)")
    )
    return F.coalesce(~bad, F.lit(False))
