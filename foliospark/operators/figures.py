"""Figure fragments of one figure brought together: runs, labels, near boxes, groups, union boxes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import near

IMAGE = r'<img\b[^>]*?\bsrc="([^"]+)"[^>]*?/?>'
BOX = r"(?i)img_in_(?:image|chart)_box_(\d+)_(\d+)_(\d+)_(\d+)\.[a-z]+$"


def fragments(pages: DataFrame) -> DataFrame:
    """(page, width, height, nth, source, x0, y0, x1, y1, valid, apart) of the images of each page, in order.

    apart: text, not only wrappers and white space, stands before the image.
    pages: page, text, width, height.
    """
    pattern = F.lit("(?i)" + IMAGE)
    sources = F.regexp_extract_all("text", pattern, F.lit(1))
    gaps = F.slice(F.split("text", "(?i)" + IMAGE, -1), 1, F.size(sources))
    own = pages.select("page", "width", "height", F.posexplode(F.arrays_zip(sources.alias("source"), gaps.alias("gap"))).alias("nth", "z"))
    number = lambda i: F.regexp_extract("source", BOX, i).try_cast("double")
    flat = own.select("page", "width", "height", "nth", F.col("z.source").alias("source"), F.col("z.gap").alias("gap"))
    boxed = flat.select("*", number(1).alias("x0"), number(2).alias("y0"), number(3).alias("x1"), number(4).alias("y1"))
    valid = F.coalesce((F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1")) & (F.col("x1") <= F.col("width")) & (F.col("y1") <= F.col("height")), F.lit(False))
    apart = F.regexp_replace(F.regexp_replace("gap", r"(?i)</?div\b[^>]*>", ""), r"(?U)\s", "") != ""
    return boxed.select("page", "width", "height", "nth", "source", "x0", "y0", "x1", "y1", valid.alias("valid"), apart.alias("apart"))


def groups(boxes: DataFrame) -> DataFrame:
    """(page, run, nth, label): label is the first fragment that is reachable over near boxes of the same run.

    boxes: page, run, nth, x0, y0, x1, y1, panel, width, height. Edges come from a
    join within the run; a page's fragments are few, so its groups are closed in one task.
    """
    a, b = boxes.alias("a"), boxes.alias("b")
    same = (F.col("a.page") == F.col("b.page")) & (F.col("a.run") == F.col("b.run")) & (F.col("a.nth") < F.col("b.nth"))
    edges = a.join(b, same & near("a", "b", "a.width", "a.height")).select("a.page", "a.run", F.col("a.nth").alias("u"), F.col("b.nth").alias("v"))
    every = boxes.select("page", "run", F.col("nth").alias("u"), F.col("nth").alias("v")).unionByName(edges)

    def close(pdf: pd.DataFrame) -> pd.DataFrame:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for u, v in zip(pdf["u"], pdf["v"], strict=True):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
        return pd.DataFrame([(pdf["page"].iloc[0], pdf["run"].iloc[0], n, root(n)) for n in sorted(parent)], columns=["page", "run", "nth", "label"])

    return every.groupBy("page", "run").applyInPandas(close, "page long, run long, nth int, label int")


def unions(boxes: DataFrame, labels: DataFrame) -> DataFrame:
    """Union boxes of the groups of two or more fragments with distinct sources."""
    own = boxes.join(labels, ["page", "run", "nth"]).groupBy("page", "run", "label", "width", "height")
    box = own.agg(F.count("*").alias("n"), F.count_distinct("source").alias("d"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return box.filter("n > 1 AND n = d").drop("d")


def unblocked(found: DataFrame, members: DataFrame, blocks: DataFrame) -> DataFrame:
    """The unions that cover no text block by more than a fifth, unless one member covers most of it.

    members: page, run, label, x0..y1; blocks: page, kind, x0..y1.
    """
    def area(t: str, o: str | None = None):
        c = lambda n: F.col(f"{t}.{n}")
        if o is None:
            return (c("x1") - c("x0")) * (c("y1") - c("y0"))
        side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(c(hi), F.col(f"{o}.{hi}")) - F.greatest(c(lo), F.col(f"{o}.{lo}")))
        return side("x0", "x1") * side("y0", "y1")

    text = blocks.filter(~F.col("kind").isin("image", "chart"))
    hit = found.alias("g").join(text.alias("t"), (F.col("g.page") == F.col("t.page")) & (area("t") > 0) & (area("t", "g") > 0.2 * area("t")))
    hit = hit.select("g.page", "g.run", "g.label", *[F.col(f"t.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])
    same = (F.col("h.page") == F.col("m.page")) & (F.col("h.run") == F.col("m.run")) & (F.col("h.label") == F.col("m.label"))
    blocking = hit.alias("h").join(members.alias("m"), same & (area("h", "m") > 0.8 * area("h")), "left_anti")
    return found.join(blocking.select("page", "run", "label").distinct(), ["page", "run", "label"], "left_anti")
