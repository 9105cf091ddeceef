"""Rows of the tables in HTML or Markdown texts.

An HTML text is cut into tags, comments and text between them; what each does
(open or close a row, open or close a cell, add to a cell) is told by windows over
a text's tokens in order, so that cost grows with a text's length. A text without
a table tag is read as Markdown, a row for each line between pipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as X

#: Comments, scripts and styles whole, tags with their quoted values, text, a bracket that opens nothing.
TOKEN = r"""(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|</?[a-z](?:[^>"']|"[^"]*"|'[^']*')*+>|<[!?][^>]*>|[^<]+|<"""
ROW, CELL = r"(?is)^<(/?)tr(?=[\s/>])", r"(?is)^<(/?)t[dh](?=[\s/>])"
#: Entities that texts use, the ampersand last; any other by number.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&minus;": "−", "&times;": "×", "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&le;": "≤", "&ge;": "≥", "&ne;": "≠", "&amp;": "&"}
MINUS = "−"


def unescaped(text: Column) -> Column:
    """Character references replaced, each once: those with a number by it, known names by what they stand for."""
    reference = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8});"
    names = F.create_map(*[F.lit(x) for kv in ENTITIES.items() for x in kv])
    number = lambda r: F.when(r.rlike("^&#[xX]"), F.conv(F.regexp_extract(r, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10)).otherwise(F.regexp_extract(r, "^&#([0-9]+)", 1)).cast("int")
    utf8 = lambda n: F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")
    shown = lambda r: F.when(F.startswith(r, F.lit("&#")), F.when(number(r).between(1, 0x10FFFF) & ~number(r).between(0xD800, 0xDFFF), utf8(number(r))).otherwise("�")).otherwise(F.coalesce(F.try_element_at(names, r), r))
    found = F.regexp_extract_all(text, F.lit(f"({reference})"), F.lit(1))
    whole = F.transform(F.arrays_zip(F.split(text, reference, -1).alias("a"), F.transform(found, shown).alias("b")), lambda p: F.concat(p["a"], F.coalesce(p["b"], F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(whole, "")).otherwise(text)


def cell_text(text: Column) -> Column:
    """A cell for comparing: references replaced, no tags, no white space or mark-up characters, a plain minus sign."""
    return F.replace(X.score_text(unescaped(text)), F.lit(MINUS), F.lit("-"))


def html_rows(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, row, cells): closed rows of tables, numbered from 1, with their closed cells.

    A row that is opened anew before it was closed is lost, a cell's end outside a
    row closes nothing, and one without an opened cell is an empty cell; text
    outside cells, and comments, count for nothing.
    """
    tokens = texts.filter(F.contains(F.lower(text), F.lit("<table"))).select(key, F.posexplode(F.regexp_extract_all(text, F.lit(f"({TOKEN})".replace(r"\1", r"\2")), F.lit(1))).alias("at", "token"))
    row, cell = F.regexp_extract("token", ROW, 0), F.regexp_extract("token", CELL, 0)
    kind = (
        F.when(row != "", F.when(F.substring(row, 2, 1) == "/", "row end").otherwise("row")).when(cell != "", F.when(F.substring(cell, 2, 1) == "/", "cell end").otherwise("cell"))
        .when(F.startswith("token", F.lit("<")) & F.col("token").rlike(r"(?is)^<(?:!|\?|/?[a-z])"), F.when(F.col("token").rlike(r"(?is)^<(?:script|style)\b"), "raw").otherwise("other")).otherwise("text")
    )
    order = Window.partitionBy(key).orderBy("at")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    typed = tokens.select(key, "at", "token", kind.alias("kind")).filter("kind <> 'other'")
    is_row = F.col("kind").isin("row", "row end")
    last = F.last(F.when(is_row, F.struct("kind", "at")), ignorenulls=True).over(before)
    following = F.first(F.when(is_row, F.col("kind")), ignorenulls=True).over(after)
    placed = typed.withColumn("__last", last).withColumn("__next", following).withColumn("row", F.when(F.col("__last.kind") == "row", F.col("__last.at")))
    closes = (F.col("kind") == "cell end") & F.col("row").isNotNull()
    opened = F.max(F.when(F.col("kind") == "cell", F.col("at"))).over(before)
    closed = F.max(F.when(closes, F.col("at"))).over(before)
    within = placed.withColumn("__closes", closes).withColumn("__open", opened).withColumn("__closed", closed)
    cell_at = F.when(F.col("__open") > F.coalesce("__closed", F.lit(-1)), F.col("__open"))
    live = within.withColumn("cell", cell_at)
    said = F.when(F.col("kind") == "raw", F.regexp_replace("token", r"(?is)^<[^>]*>|</[^<]*>$", "")).otherwise(unescaped(F.col("token")))
    bodies = live.filter(F.col("kind").isin("text", "raw") & F.col("cell").isNotNull()).groupBy(key, "cell").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", said.alias("t")))), lambda x: x["t"]), "").alias("body"))
    ends = live.filter(F.col("__closes") & (F.col("__next") == "row end")).select(key, "row", "at", "cell")
    cells = ends.join(bodies, [key, "cell"], "left").select(key, "row", "at", cell_text(F.coalesce("body", F.lit(""))).alias("body"))
    gathered = cells.groupBy(key, "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]).alias("cells"))
    starts = live.filter((F.col("kind") == "row") & (F.col("__next") == "row end")).select(key, F.col("at").alias("row"))
    whole = starts.join(gathered, [key, "row"], "left")
    number = F.row_number().over(Window.partitionBy(key).orderBy("row"))
    return whole.select(key, number.alias("row"), F.coalesce("cells", F.array().cast("array<string>")).alias("cells"))


def pipe_rows(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, row, cells) of lines between pipes; a separator line is a row."""
    lines = texts.filter(~F.contains(F.lower(text), F.lit("<table"))).select(key, F.posexplode(F.split(text, r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]", -1)).alias("at", "line"))
    own = lines.select(key, "at", X.strip(F.col("line")).alias("line")).filter(F.startswith("line", F.lit("|")) & F.endswith("line", F.lit("|")))
    inner = F.when(F.length("line") > 2, F.substring("line", F.lit(2), F.length("line") - 2)).otherwise("")
    number = F.row_number().over(Window.partitionBy(key).orderBy("at"))
    return own.select(key, number.alias("row"), F.transform(F.split(inner, r"\|", -1), cell_text).alias("cells"))


def table_rows(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, row, cells) of each text: of its HTML tables if it has a table tag, else of its pipe tables."""
    return html_rows(texts, key, text).unionByName(pipe_rows(texts, key, text))
