"""Catalog scans, packages, heartbeats and delivery on small inputs with known results."""

import hashlib
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from foliospark.queries import stores
from foliospark.sources import catalogs, packages
from foliospark.streaming import delivery as D
from foliospark.streaming import heartbeats as H

# Catalogs


def responses(**pages):
    return {t.removeprefix("t_") if t != "first" else "": (200, p if isinstance(p, str) else json.dumps(p)) for t, p in pages.items()}


def model(name, **more):
    return {"name": f"models/{name}", **more}


def test_chain_of_pages():
    models, pages = catalogs.models_of(responses(first={"models": [model("b", displayName="old"), model("-no")], "nextPageToken": "n"}, t_n={"models": [model("b", thinking=True, inputTokenLimit="7"), model("a", description="d" * 3000)]}))
    assert sorted(models) == ["a", "b"] and pages == 2
    assert models["b"] == ("b", "", 7, 0, [], True) and len(models["a"][1]) == 2000


@pytest.mark.parametrize(
    ("pages", "said"),
    [
        (responses(first={"models": [], "nextPageToken": "x"}, t_x={"models": [], "nextPageToken": "x"}), "comes again"),
        (responses(first={"models": []}), "empty"),
        (responses(first={"models": [model(f"m{i}") for i in range(1001)]}), "over 1000 models"),
        (responses(first={"models": [model("a")], "nextPageToken": "0"}, **{f"t_{i}": {"models": [], "nextPageToken": str(i + 1)} for i in range(12)}), "over 10 pages"),
        (responses(first={"models": [model("a")], "nextPageToken": 7}), "invalid"),
        (responses(first={"models": [model("a")], "nextPageToken": "y" * 4097}), "invalid"),
        (responses(first="[]"), "no list"),
        (responses(first="nonsense"), "no JSON"),
        (responses(first={"models": ["x"]}), "no object"),
        (responses(first={"models": [model("a", inputTokenLimit="many")]}), "no number"),
        ({"": (403, "a secret")}, "HTTP 403"),
        (responses(first=json.dumps({"models": [model("a", description="z" * (2 << 20))]})), "2 MiB"),
        ({}, "not there"),
    ],
)
def test_broken_catalogs(pages, said):
    with pytest.raises(catalogs.CatalogError, match=said) as error:
        catalogs.models_of(pages)
    assert "secret" not in str(error.value)


def test_catalogs_as_a_source(spark, tmp_path):
    rows = [("good / one", t, s, b) for t, (s, b) in responses(first={"models": [model("z")], "nextPageToken": "n"}, t_n={"models": [model("y")]}).items()] + [("bad", "", 500, "")]
    path = str(tmp_path / "catalogs")
    catalogs.write_responses(spark.createDataFrame(rows, "catalog string, token string, status int, body string").repartition(3), path)
    found = catalogs.read_catalogs(spark, path, "permissive")
    assert sorted((r["catalog"], r["id"], r["pages"], r["error"]) for r in found.collect()) == sorted([("bad", None, None, "HTTP 500"), ("good / one", "y", 2, None), ("good / one", "z", 2, None)], key=str)
    with pytest.raises(Exception, match="catalog bad: HTTP 500"):
        catalogs.read_catalogs(spark, path).count()


# Packages


def files_of(package):
    return {r["path"]: bytes(r["content"]).decode() for r in package.files().collect()}


def as_files(spark, **files):
    return spark.createDataFrame([(p.replace("__", "/") + ".md", c) for p, c in files.items()], "path string, content string")


def test_package_commits(spark, tmp_path):
    package = packages.Package(spark, str(tmp_path / "p"))
    assert package.current() is None and files_of(package) == {}
    package.write(as_files(spark, pages__1="one", pages__2="two", name="all"))
    second = as_files(spark, pages__1="one", pages__3="three", name="all!")
    assert {r["path"]: r["state"] for r in package.changes(second).collect()} == {"pages/1.md": "kept", "pages/2.md": "removed", "pages/3.md": "written", "name.md": "written"}
    first = package.current()
    package.write(second)
    assert files_of(package) == {"pages/1.md": "one", "pages/3.md": "three", "name.md": "all!"}
    assert {r["path"]: r["commit"] == first for r in package.manifest().collect()} == {"pages/1.md": True, "pages/3.md": False, "name.md": False}
    package.write(as_files(spark, only="x"))
    assert package.vacuum() == 4 and files_of(package) == {"only.md": "x"}


def test_killed_writer_leaves_the_old_package(spark, tmp_path):
    package = packages.Package(spark, str(tmp_path / "p"))
    package.write(as_files(spark, a="old"))
    staged = package.stage(as_files(spark, a="new", b="more"))
    assert files_of(package) == {"a.md": "old"}  # the writer ends here
    other = packages.Package(spark, str(tmp_path / "p"))
    before = other.current()
    other.write(as_files(spark, a="other"))
    with pytest.raises(RuntimeError, match="meanwhile"):
        package.commit(staged, before)
    assert files_of(other) == {"a.md": "other"} and other.vacuum() == 4

    def dies(path, content):
        raise OSError("killed")

    package.store.replace = dies
    with pytest.raises(OSError):
        package.write(as_files(spark, a="lost"))
    assert files_of(other) == {"a.md": "other"}


def test_paths_stay_within(spark, tmp_path):
    package = packages.Package(spark, str(tmp_path / "p"))
    for bad in ("../x", "/etc/x", "a/../../x", "a/./b", "a\nb", None):
        with pytest.raises(ValueError, match="leaves"):
            package.write(spark.createDataFrame([(bad, "c")], "path string, content string"))
    with pytest.raises(ValueError, match="twice"):
        package.write(spark.createDataFrame([("a", "c"), ("a", "d")], "path string, content string"))
    assert package.current() is None


def test_export(spark, tmp_path):
    package, folder = packages.Package(spark, str(tmp_path / "p")), tmp_path / "out"
    package.write(as_files(spark, pages__1="one", pages__2="two"))
    assert package.export(str(folder)) == {"written": 2, "kept": 0, "removed": 0}
    stamp = os.stat(folder / "pages/1.md").st_mtime_ns
    package.write(as_files(spark, pages__1="one", pages__2="TWO", name="n"))
    (folder / "pages/9.md").write_text("stale")
    assert package.export(str(folder)) == {"written": 2, "kept": 1, "removed": 1}
    assert os.stat(folder / "pages/1.md").st_mtime_ns == stamp
    assert {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file()} == {"pages/1.md": "one", "pages/2.md": "TWO", "name.md": "n"}


def test_replace_leaves_nothing_beside(tmp_path, monkeypatch):
    path = tmp_path / "f"
    assert packages.replace_file(str(path), b"a") and not packages.replace_file(str(path), b"a")

    def fails(a, b):
        raise OSError("full")

    monkeypatch.setattr(os, "replace", fails)
    with pytest.raises(OSError):
        packages.replace_file(str(path), b"b")
    assert path.read_bytes() == b"a" and os.listdir(tmp_path) == ["f"]


def test_reset_folders(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    work, out = tmp_path / "work", tmp_path / "out"
    (work / "conversion").mkdir(parents=True)
    (work / "conversion/x").write_text("old")
    (work / "kept").write_text("stays")
    state = packages.reset_folders(str(work), str(out))
    assert os.listdir(state) == [] and os.listdir(out) == [] and sorted(os.listdir(work)) == ["conversion", "kept"]
    (tmp_path / "link").symlink_to(out)
    (tmp_path / "file").write_text("")
    for a, b in ((work, work), (work, work / "in"), (out / "in", out), (work, tmp_path), (tmp_path / "link", out), (work, tmp_path / "link"), (work, tmp_path / "file")):
        with pytest.raises(ValueError):
            packages.reset_folders(str(a), str(b))
    assert (work / "kept").read_text() == "stays"


def test_page_and_figure_files(spark):
    pages = spark.createDataFrame([("d", "001", "ok", " ![a](images/a.png)\n"), ("d", "002", "blank", "x"), ("d", "003", "ok", " \n"), ("d", "004", "failed", "y"), ("d", "005", "ok", None)], "doc string, stem string, status string, text string")
    assert [tuple(r) for r in packages.page_files(pages, "doc").collect()] == [("d", "001", "pages/001.md", "![a](../images/a.png)\n")]
    figures = spark.createDataFrame([("d", f, b"1") for f in ("a.png", "b.png", "c.svg", "c.png")] + [("e", "a.png", b"1")], "doc string, figure string, content binary")
    drawings = spark.createDataFrame([("d", "c.png", "c.svg")], "doc string, figure string, drawing string")
    texts = spark.createDataFrame([("d", "![](images/a.png) [x](images/c.svg \"t\") ![](images/a.png)"), ("e", "images/a.png")], "doc string, text string")
    assert sorted(r["path"] for r in packages.figure_files(texts, figures, "doc", drawings).collect()) == ["images/a.png", "images/c.png", "images/c.svg"]
    mapped = texts.select(packages.relinked(F.col("text"), F.create_map(F.lit("images/a.png"), F.lit("images/z.svg"))).alias("t")).first()["t"]
    assert mapped == "![](images/z.svg) [x](images/c.svg \"t\") ![](images/z.svg)"


def test_progress_files(spark):
    rows = [("r", 8, "002", 2, "ok"), ("r", 8, "001", 1, "failed"), ("r", 8, "003", 3, "blank"), ("q", 0, "001", 1, "pending")]
    made = {(r["run"], r["path"]): json.loads(r["content"]) for r in packages.progress_files(spark.createDataFrame(rows, "run string, total int, chunk string, page int, status string"), "run", "total").collect()}
    assert [x["chunk"] for x in made["r", "results.json"]] == ["001", "002", "003"]
    assert made["r", "progress.json"] == {"total_pages": 8, "completed_pages": 3, "success_pages": 1, "blank_pages": 1, "failed_pages": 1, "pending_pages": 5, "percent": 37.5}
    assert made["q", "progress.json"]["percent"] == 100.0


# Heartbeats


def test_quiet_beats(spark):
    rows = [("a", 0), ("a", 12), ("a", 100), ("b", 7)]
    got = {(r["job"], r["at"]): (r["beats"], r["first"], r["last"]) for r in H.quiet_beats(spark.createDataFrame(rows, "job string, at int"), F.lit(160)).collect()}
    assert got == {("a", 0): (0, None, None), ("a", 12): (2, 45.0, 75.0), ("a", 100): (1, 130.0, 130.0), ("b", 7): (5, 37.0, 157.0)}

    def plain(at, start, until):
        beats, last, tick = [], at, start
        while (tick := tick + 5) < until:
            if tick > at and tick - last >= 30:
                beats.append(tick)
                last = tick
        return beats

    for (job, at), (n, first, last) in got.items():
        want = plain(at, 0 if job == "a" else 7, {("a", 0): 12, ("a", 12): 100}.get((job, at), 160))
        assert (n, first, last) == (len(want), *((want[0], want[-1]) if want else (None, None)))


def test_heartbeats_of_a_quiet_stream(spark, tmp_path):
    """A silent job beats, a closed one doesn't; content passes unchanged, and a restart goes on."""
    source, out = tmp_path / "in", []
    source.mkdir()

    def put(name, *rows):
        (tmp_path / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
        os.replace(tmp_path / name, source / name)

    put("1.json", {"job": "quiet", "kind": "parts", "sequence": 3, "parts": 2}, {"job": "gone", "kind": "parts", "sequence": 1, "parts": 1})
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", H.STORE)

    def start():
        stream = spark.readStream.schema("job string, kind string, sequence long, parts int").json(str(source))
        keep = lambda df, _: out.extend(tuple(r) for r in df.collect())
        return H.with_heartbeats(stream, quiet=2.0).writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="4 seconds").start()

    def until(done, seconds=90):
        end = time.time() + seconds
        while not done() and time.time() < end:
            assert query.exception() is None
            time.sleep(0.2)
        assert done(), out

    try:
        query = start()
        until(lambda: len(out) >= 2)
        put("2.json", {"job": "gone", "kind": "closed", "sequence": 2, "parts": 0})
        until(lambda: sum(r[1] == "heartbeat" and r[0] == "quiet" for r in out) >= 2 and any(r[1] == "closed" for r in out))
        until(lambda: not query.status["isTriggerActive"])  # between two batches
        query.stop()
        seen = len(out)
        query = start()
        put("3.json", {"job": "new", "kind": "parts", "sequence": 1, "parts": 1})
        until(lambda: any(r[:2] == ("quiet", "heartbeat") for r in out[seen:]))
        query.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert {r[:4] for r in out if r[1] != "heartbeat"} == {("quiet", "parts", 3, 2), ("gone", "parts", 1, 1), ("gone", "closed", 2, 0), ("new", "parts", 1, 1)}
    beats = [r for r in out if r[0] == "quiet" and r[1] == "heartbeat"]
    assert [r[2] for r in beats] == list(range(4, 4 + len(beats))) and all(r[3] == 0 for r in beats)
    assert all(b[4] - a[4] >= 2000 for a, b in zip(beats, beats[1:], strict=False))
    closed = next(r[4] for r in out if r[1] == "closed")
    assert not any(r[0] == "gone" and r[4] > closed for r in out)


# Delivery

PARTS = "message string, key string, sequence long, content string"


def tables(spark, local, saved=(), pending=(), sent=()):
    return (spark.createDataFrame(local, PARTS), spark.createDataFrame(list(saved), PARTS), spark.createDataFrame(list(pending), PARTS + ", number long"), spark.createDataFrame(list(sent), "message string, number long"))


def test_lost_acknowledgement_keeps_newer_content(spark):
    local, saved, pending, sent = tables(spark, [("m", "a", 1, "first")])
    batch = D.outgoing(local, saved, pending, sent)
    assert [(r["number"], r["content"], r["again"]) for r in batch.collect()] == [(1, "first", False)]
    none = spark.createDataFrame([], "message string, state string")
    saved, pending = D.acknowledged(saved, batch, none)  # the answer is lost
    newer = spark.createDataFrame([("m", "a", 1, "newer"), ("m", "b", 2, "more")], PARTS)
    batch = D.outgoing(newer, saved, pending, sent)
    assert [(r["number"], r["key"], r["content"], r["again"]) for r in batch.collect()] == [(1, "a", "first", True)]
    saved, pending = D.acknowledged(saved, batch, spark.createDataFrame([("m", "accepted")], "message string, state string"))
    assert pending.count() == 0
    batch = D.outgoing(newer, saved, pending, spark.createDataFrame([("m", 1)], "message string, number long"))
    assert sorted((r["number"], r["key"], r["content"]) for r in batch.collect()) == [(2, "a", "newer"), (2, "b", "more")]


def test_batches_are_bounded(spark):
    local, saved, pending, sent = tables(spark, [("m", f"k{i}", i, "x" * (100_000 if i < 4 else 10)) for i in range(1, 9)] + [("n", "big", 1, "y" * 400_000), ("n", "k", 2, "z")])
    got = {}
    for r in D.outgoing(local, saved, pending, sent).collect():
        got.setdefault(r["message"], []).append(r["key"])
    assert {m: sorted(k) for m, k in got.items()} == {"m": ["k1", "k2"], "n": ["big"]}
    small = [("m", f"k{i}", i, "x") for i in range(1, 9)]
    local, *rest = tables(spark, small, small[:2] + [("m", "k4", 4, "other")])
    assert sorted(r["key"] for r in D.outgoing(local, *rest).collect()) == ["k3", "k4", "k5", "k6"]


class Store:
    """A store with a script of what each message's posts meet: accepted, conflict, duplicate, closed, lost (saved without an answer) or vanished (neither)."""

    def __init__(self, spark, script, jobs, running=None):
        self.spark, self.script, self.jobs, self.saved, self.number, self.log = spark, {m: list(s) for m, s in script.items()}, jobs, {}, {}, []
        self.running = running or {}

    def state(self):
        jobs = self.spark.createDataFrame([(m, *j) for m, j in self.jobs.items()], "message string, status string, execution string, wanted string, cancelled boolean")
        messages = self.spark.createDataFrame([(m, self.running.get(m, "running"), self.number.get(m, 0)) for m in self.jobs], "message string, status string, number long")
        return jobs, messages, self.spark.createDataFrame([(*k, *v) for k, v in self.saved.items()], PARTS)

    def post(self, batch):
        answers = {}
        for r in sorted(batch.collect(), key=lambda r: (r["message"], r["sequence"])):
            m = r["message"]
            if m not in answers:
                answers[m] = self.script.get(m, []).pop(0) if self.script.get(m) else "accepted"
            if answers[m] in ("accepted", "lost"):
                self.saved[m, r["key"]] = (r["sequence"], r["content"])
                self.number[m] = r["number"]
            self.log.append((m, r["number"], r["key"], answers[m]))
        return self.spark.createDataFrame([(m, a) for m, a in answers.items() if a not in ("lost", "vanished")], "message string, answer string")


def test_repair(spark):
    job = ("running", "e", "e", False)
    jobs = {"ok": job, "late": job, "lost": job, "dup": job, "gone": job, "done": ("completed", "e", "e", False), "other": ("running", "x", "e", False), "stop": ("running", "e", "e", True), "ended": job, "never": job, "shut": job, "clean": job}
    script = {"late": ["conflict", "vanished"], "lost": ["lost"], "dup": ["duplicate"], "never": ["conflict"] * 9, "shut": ["accepted", "closed"]}
    parts = [(m, f"k{i}", i, f"{m} {i}") for m in jobs for i in range(1, 7 if m in ("ok", "shut") else 3)]
    store = Store(spark, script, {m: j for m, j in jobs.items() if m != "gone"}, {"ended": "completed"})
    store.saved = {("clean", "k1"): (1, "clean 1"), ("clean", "k2"): (2, "clean 2"), ("ok", "k1"): (1, "stale")}
    got = {r["message"]: (r["state"], r["batches"], r["attempts"]) for r in D.Repair(store, attempts=4).run(spark.createDataFrame(parts, PARTS)).collect()}
    assert got == {
        "ok": ("delivered", 2, 2), "late": ("delivered", 1, 3), "lost": ("delivered", 1, 1), "dup": ("delivered", 1, 2), "clean": ("delivered", 0, 0), "never": ("failed", 0, 4),
        "shut": ("closed", 1, 2), **{m: ("closed", 0, 0) for m in ("gone", "done", "other", "stop", "ended")},
    }
    assert store.saved["ok", "k1"] == (1, "ok 1") and store.number["ok"] == 2
    assert not any(m in ("gone", "done", "other", "stop", "ended", "clean") for m, *_ in store.log)


def test_stream_of_parts_is_delivered(spark, tmp_path):
    (tmp_path / "in").mkdir()
    job = ("running", "e", "e", False)
    store, held = Store(spark, {"m": ["vanished"]}, {"m": job, "n": job}), {}

    def upsert(batch):
        held.update({(r["message"], r["key"]): tuple(r) for r in batch.collect()})

    local = lambda: spark.createDataFrame(list(held.values()), PARTS)
    for i, rows in enumerate(([("m", "a", 1, "1"), ("n", "a", 1, "1")], [("m", "a", 1, "2"), ("m", "b", 2, "x")])):
        spark.createDataFrame(rows, PARTS).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(PARTS).json(str(tmp_path / "in"))
        D.deliver_stream(stream, local, upsert, store, str(tmp_path / "c")).awaitTermination(120)
        assert {k: v[1] for k, v in store.saved.items() if k[0] == "n"} == {("n", "a"): "1"}
        assert store.saved["m", "a"][1] == str(i + 1)
    assert hashlib.sha256(str(sorted(store.saved)).encode()).hexdigest() == hashlib.sha256(str([("m", "a"), ("m", "b"), ("n", "a")]).encode()).hexdigest()


def test_catalogs_longer_than_a_reader_takes(spark, duck_of, tmp_path):
    """Brands with over 1,000 parts, broken ones among them: with models over the limit, and with pages over it only."""
    brands = [("Brand#11", 1300), ("Brand#22", 1300), ("Brand#13", 1300), ("Brand#1", 1300), ("Brand#2", 1010), ("Brand#3", 1100), ("Brand#4", 1000)]
    rows = [(k, f"name {k}", brand, "type", 7 if brand == "Brand#3" and k % 5 == 0 else k % 6 + 1) for k, brand in enumerate(b for b, n in brands for _ in range(n))]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    got = {(r["catalog"], r["error"]) for r in stores.s11_catalog_scan(spark, folder).collect()}
    assert got == set(duck_of(folder, "part", f"SELECT catalog, error FROM ({stores.CATALOGS_SQL})")) and ("Brand#1", "over 1000 models") in got and ("Brand#3", "over 10 pages") in got


@pytest.fixture
def duck_of():
    import duckdb

    def rows(folder, table, sql):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        return con.sql(sql).fetchall()

    return rows
