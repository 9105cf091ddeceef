"""Text rules that once depended on what characters a text holds, or were slow, against plain readings."""

import random
import re

from pyspark.sql import functions as F

from foliospark.functions import markup as M
from foliospark.functions import pages as G
from foliospark.functions import text as X
from foliospark.operators import joins as J

ODD = "\ue000", "\ue001", "\ue0000", "\ue0001", "\ue000\ue0001"


def each(spark, f, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r["r"] for r in df.select("i", f(F.col("t")).alias("r")).orderBy("i").collect()]


def test_private_characters_stay(spark):
    texts = [f"{o}a <div>{o}\nx{o}\n</div> b{o}" for o in ODD] + [f"<div class='k{o}'>{o}</div>" for o in ODD]
    assert each(spark, X.clean_layout, texts) == [f"{o}a {o}\nx{o} b{o}" for o in ODD] + [f"<div class='k{o}'>{o}</div>" for o in ODD]
    lines = [f"{o} $ x{o} $ and $${o}$$ {o}" for o in ODD]
    assert each(spark, M.tidy_math_line, lines) == [f"{o} $x{o}$ and $${o}$$ {o}" for o in ODD]
    joined = each(spark, M.math_lines, [f"ab{o}\nplain{o}\nc" for o in ODD] + [f"a {o}$x\n y$ {o}\nz" for o in ODD])
    assert [j["text"] for j in joined] == [f"ab{o}\nplain{o}\nc" for o in ODD] + [f"a {o}$x y$ {o}\nz" for o in ODD]


def test_wrappers_within_wrappers(spark):
    """Against the removal of innermost wrappers until none is left."""
    block = re.compile(r"<div\b([^>]*)>((?:(?!<div\b).)*?)</div\s*>", re.I | re.S)
    safe = re.compile(rf"\s*|\s*{X.SAFE_DIV}\s*", re.I)

    def plain(t):
        before = None
        while before != t:
            before, t = t, block.sub(lambda m: m[2].strip("\n") if safe.fullmatch(m[1]) else m[0], t)
        return t

    rnd = random.Random(6)
    pieces = ["<div>", "<div align=right>", "<div id='x'>", "</div>", "</div >", "\n", "a", " b ", *ODD]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(600)]
    assert each(spark, X.clean_layout, texts) == [plain(t) for t in texts]


def test_runaway_texts(spark):
    run = re.compile(r"(?s)(.{1,40}?)\1{399,}")
    rnd = random.Random(1)
    unit = lambda n: "".join(rnd.choice("abcde") for _ in range(n))
    texts = ["", "x" * 399, "x" * 400, None]
    for n in (1, 2, 3, 7, 19, 39, 40, 41):
        u = unit(n)
        texts += [unit(rnd.randint(0, 130)) + u * many + unit(60) for many in (398, 399, 400, 401)]
    texts += ["&nbsp;" * 120 + "ab", unit(5000), "\n" * 450, ("ab" * 150 + "c") * 20]
    assert each(spark, X.runs_away, texts) == [None if t is None else bool(run.search(t)) for t in texts] or each(spark, X.runs_away, texts) == [bool(t and run.search(t)) for t in texts]


def test_texts_that_hold_anchors(spark, monkeypatch):
    rnd = random.Random(2)
    word = lambda n: "".join(rnd.choice("abé ") for _ in range(n))
    texts = [(i, word(rnd.randint(0, 60))) for i in range(80)] + [(7, "again"), (90, None), (None, "abab")]
    anchors = [(str(i), word(rnd.randint(1, 5))) for i in range(40)] + [("e", ""), ("n", None), ("d1", "ab"), ("d2", "ab")]
    want = sorted(((i, a) for i, t in texts for a, w in anchors if t is not None and w is not None and w in t), key=str)
    for size in (J.BLOCK_BYTES, 20):
        monkeypatch.setattr(J, "BLOCK_BYTES", size)
        got = J.holding(spark.createDataFrame(texts, "text_id int, text string").repartition(3), spark.createDataFrame(anchors, "anchor_id string, anchor string")).collect()
        assert sorted(((r["text_id"], r["anchor_id"]) for r in got), key=str) == want
    none = spark.createDataFrame([], "anchor_id string, anchor string")
    assert J.holding(spark.createDataFrame(texts, "text_id int, text string"), none).count() == 0


def test_mentioned_repositories(spark):
    tasks = [(1, "see Own/Repo-Name, there"), (2, "xown/repo-name"), (3, "the repo name thing"), (4, "about name only"), (5, "nothing"), (6, ""), (7, None), (8, "own/repo-name and own/other-name")]
    listed = spark.createDataFrame([("own/repo-name",), ("own/other-name",), ("own/x",), (None,)], "name string")
    got = sorted((r["task"], r["name"], r["score"]) for r in G.mentioned_repositories(spark.createDataFrame(tasks, "task int, text string"), listed).collect())
    assert got == [(1, "own/repo-name", 1013), (2, "own/repo-name", 109), (3, "own/repo-name", 109), (4, "own/other-name", 14), (4, "own/repo-name", 14), (8, "own/other-name", 1014)]
