"""Packages of files with a manifest: written beside the old one, committed by one rename.

A package is a set of named files. Their contents lie in Parquet tables, a table
for each commit that brought something new; a manifest (path, sha256, bytes,
commit) lists the files of a commit and says which table holds each. ``CURRENT``
names the manifest that counts. A writer adds a table and a manifest under names
of their own and then renames a new ``CURRENT`` over the old one: whoever reads
sees the old package or the new, and a writer that is killed leaves the old.
Files that are the same by hash aren't written again; files that the new set
lacks are stale and leave with the manifest.

``export`` lays a package out as real files in a folder, each replaced whole.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

MANIFEST = "path string, sha256 string, bytes bigint, commit string"
DATA = "path string, sha256 string, content binary"
#: A file's name within a package: relative, no step upwards.
SAFE_PATH = r"^(?!/)(?!.*(?:^|/)\.\.?(?:/|$))[^\x00-\x1f\\]+$"


class Files:
    """The few file operations that Spark's writers don't offer, on any store that Hadoop knows."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway, self.conf = spark.sparkContext._jvm, spark.sparkContext._gateway, spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, path: str):
        own = self.jvm.org.apache.hadoop.fs.Path(path)
        return own.getFileSystem(self.conf), own

    def exists(self, path: str) -> bool:
        store, own = self.at(path)
        return store.exists(own)

    def read(self, path: str) -> str:
        store, own = self.at(path)
        stream = store.open(own)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, path: str, content: str) -> None:
        """A small file in place of another: written beside it, renamed over it."""
        beside = f"{path}.{uuid.uuid4().hex}.tmp"
        store, own = self.at(beside)
        stream = store.create(own, True)
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()
        self.rename(beside, path)

    def rename(self, source: str, target: str) -> None:
        """Rename over what is there, in one step."""
        store, own = self.at(source)
        kinds = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        over = self.gateway.new_array(kinds, 1)
        over[0] = kinds.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), self.conf)
        context.rename(own, self.jvm.org.apache.hadoop.fs.Path(target), over)

    def names(self, path: str) -> list[str]:
        store, own = self.at(path)
        return [s.getPath().getName() for s in store.listStatus(own)] if store.exists(own) else []

    def remove(self, path: str) -> None:
        store, own = self.at(path)
        store.delete(own, True)


class Package:
    """A package below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Files(spark)

    def current(self) -> str | None:
        """The commit that counts; None before the first."""
        pointer = f"{self.root}/CURRENT"
        return self.store.read(pointer).strip() if self.store.exists(pointer) else None

    def manifest(self, commit: str | None = None) -> DataFrame:
        own = commit or self.current()
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{own}") if own else self.spark.createDataFrame([], MANIFEST)

    def files(self) -> DataFrame:
        """(path, sha256, bytes, content) of the package as it stands."""
        own = self.manifest()
        commits = sorted(r[0] for r in own.select("commit").distinct().collect())  # those since the last compaction
        if not commits:
            return own.select("path", "sha256", "bytes", F.lit(None).cast("binary").alias("content"))
        held = self.spark.read.schema(DATA).parquet(*[f"{self.root}/data/{c}" for c in commits]).withColumn("commit", F.regexp_extract(F.input_file_name(), "/data/([0-9a-f]{32})/", 1))
        return own.join(held.select("path", "commit", "content"), ["path", "commit"]).select("path", "sha256", "bytes", "content")

    def changes(self, files: DataFrame) -> DataFrame:
        """(path, state): written, kept or removed if ``files`` (path, content) were the package."""
        new = _hashed(files).select("path", "sha256")
        old = self.manifest().select("path", F.col("sha256").alias("before"))
        state = F.when(F.col("sha256").isNull(), "removed").when(F.col("sha256") == F.col("before"), "kept").otherwise("written")
        return new.join(old, "path", "full").select("path", state.alias("state"))

    def stage(self, files: DataFrame) -> str:
        """Write what is new in ``files`` (path, content) and their manifest; nothing that is read now changes. Returns the commit.

        Names are checked: each once, relative, without steps upwards.
        """
        commit = uuid.uuid4().hex
        old = self.manifest()
        new = _hashed(files).join(old.select("path", "sha256", F.col("commit").alias("held")), ["path", "sha256"], "left")
        data = f"{self.root}/data/{commit}"
        new.filter("held IS NULL").select("path", "sha256", "content").write.parquet(data)
        fresh = self.spark.read.schema(DATA).parquet(data).select("path", "sha256", F.octet_length("content").cast("long").alias("bytes"), F.lit(commit).alias("commit"))
        kept = old.join(_hashed(files).select("path", "sha256"), ["path", "sha256"], "left_semi").select("path", "sha256", "bytes", "commit")
        manifest = fresh.unionByName(kept)
        manifest.write.parquet(f"{self.root}/manifest/{commit}")
        listed = self.manifest(commit)
        twice = listed.groupBy("path").count().filter("count > 1").limit(1).collect()
        wrong = listed.filter(~F.coalesce(F.col("path").rlike(SAFE_PATH), F.lit(False))).limit(1).collect()
        if twice or wrong:
            raise ValueError(f"a path that comes twice: {twice[0]['path']}" if twice else "a path that leaves the package")
        return commit

    def commit(self, commit: str, expected: str | None = None) -> None:
        """Make a staged commit the package; ``expected``: the commit that it was staged over."""
        if expected is not None and self.current() != expected:
            raise RuntimeError("the package changed meanwhile: stage again")
        self.store.replace(f"{self.root}/CURRENT", commit)

    def write(self, files: DataFrame) -> str:
        """``files`` (path, content) in place of the package."""
        before = self.current()
        own = self.stage(files)
        self.commit(own, before)
        return own

    def vacuum(self) -> int:
        """Remove tables and manifests that no reader of the current package needs; returns how many."""
        own = self.current()
        needed = {r[0] for r in self.manifest().select("commit").distinct().collect()} if own else set()
        gone = [f"{self.root}/data/{n}" for n in self.store.names(f"{self.root}/data") if n not in needed]
        gone += [f"{self.root}/manifest/{n}" for n in self.store.names(f"{self.root}/manifest") if n != own]
        for path in gone:
            self.store.remove(path)
        return len(gone)

    def export(self, folder: str) -> dict[str, int]:
        """The package as files below ``folder``, which all executors reach by this path; counts of files written, kept and removed.

        A file is written beside its place and renamed, so that none is ever seen
        half; equal files stay untouched; files that the package lacks go last.
        """
        from pyspark.sql.types import StructType

        def lay_out(rows: Iterator) -> Iterator:
            import pandas as pd

            for pdf in rows:
                states = []
                for path, content in zip(pdf["path"], pdf["content"], strict=True):
                    states.append("written" if replace_file(os.path.join(folder, path), bytes(content)) else "kept")
                yield pd.DataFrame({"path": pdf["path"], "state": states})

        done = self.files().select("path", "content").mapInPandas(lay_out, StructType.fromDDL("path string, state string"))
        counts = {r["state"]: r["count"] for r in done.groupBy("state").count().collect()}
        listed = self.spark.createDataFrame([(p,) for p in _below(folder)], "path string")
        stale = [r[0] for r in listed.join(self.manifest(), "path", "left_anti").collect()]
        for path in stale:
            os.remove(os.path.join(folder, path))
        return {"written": counts.get("written", 0), "kept": counts.get("kept", 0), "removed": len(stale)}


def _hashed(files: DataFrame) -> DataFrame:
    """Files with the hash of their content; none counts as an empty one."""
    content = F.coalesce(F.col("content").cast("binary"), F.lit("").cast("binary"))
    return files.select("path", F.sha2(content, 256).alias("sha256"), content.alias("content"))


def _below(folder: str) -> list[str]:
    return [os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names]


def replace_file(path: str, content: bytes) -> bool:
    """Put ``content`` in the file's place at once; False, and nothing touched, if it is there already."""
    try:
        with open(path, "rb") as f:
            if hashlib.sha256(f.read()).digest() == hashlib.sha256(content).digest():
                return False
    except FileNotFoundError:
        os.makedirs(os.path.dirname(path), exist_ok=True)
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with open(beside, "wb") as f:
            f.write(content)
        os.replace(beside, path)
    finally:
        if os.path.exists(beside):
            os.remove(beside)
    return True


def reset_folders(work: str, output: str) -> str:
    """Empty folders for a run's state, which is returned, and its output; only these two are ever removed.

    Refused: one within the other, links, a folder that holds the current one, files in their place.
    """
    real, here = os.path.realpath, os.path.realpath(os.getcwd())
    inside = lambda a, b: os.path.commonpath([a, b]) == b  # noqa: E731  a lies in b or is b
    a, b = real(work), real(output)
    if inside(a, b) or inside(b, a) or inside(here, b) or os.path.islink(work) or os.path.islink(output):
        raise ValueError("work and output must be two folders of their own")
    state = os.path.join(a, "conversion")
    if os.path.islink(state) or inside(here, state):
        raise ValueError("the state's folder must be no link and not hold the current folder")
    if any(os.path.exists(p) and not os.path.isdir(p) for p in (state, b)):
        raise ValueError("a file is in a folder's place")
    for path in (state, b):
        aside = f"{path}.{uuid.uuid4().hex}.old"
        if os.path.exists(path):
            os.rename(path, aside)  # gone at once, as seen by readers
        os.makedirs(path)
        if os.path.exists(aside):
            shutil.rmtree(aside)
    return state


#: Links to figures, and to figures of a text that lies in a folder below.
FIGURE_LINK = r"\]\(images/([^)\s/]+)(?=[\s)])"
MAPPED_LINK = r"(!\[[^\]\n]*\]\()(images/[^)\s]+)(?=[\s)])"


def relinked(text: Column, links: Column) -> Column:
    """Image links replaced by what a map says; others stay."""
    part = lambda i: F.regexp_extract_all(text, F.lit(MAPPED_LINK), F.lit(i))
    between = F.split(text, MAPPED_LINK, -1)
    each = F.arrays_zip(between.alias("a"), part(1).alias("b"), part(2).alias("c"))
    whole = F.transform(each, lambda x: F.concat(x["a"], F.coalesce(x["b"], F.lit("")), F.coalesce(F.try_element_at(links, x["c"]), x["c"], F.lit(""))))
    return F.array_join(whole, "")


def page_files(pages: DataFrame, key: str) -> DataFrame:
    """(key, stem, path, content): a file for each completed page with text, links as seen from the folder pages.

    pages: key, stem, status, text. Blank and failed pages, and texts of white space only, have none.
    """
    body = X.strip(F.col("text"))
    own = pages.filter((F.col("status") == "ok") & (body != ""))
    content = F.concat(F.regexp_replace(body, r"\]\(images/", "](../images/"), F.lit("\n"))
    return own.select(key, "stem", F.concat(F.lit("pages/"), "stem", F.lit(".md")).alias("path"), content.alias("content"))


def figure_files(texts: DataFrame, figures: DataFrame, key: str, drawings: DataFrame | None = None) -> DataFrame:
    """(key, path, content) of figures (key, figure, content) that a document's texts (key, text) link to, each once.

    drawings (key, figure, drawing): where a text links to a drawing, the figure that it stands for comes too.
    """
    linked = texts.select(key, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(FIGURE_LINK), F.lit(1)))).alias("figure")).distinct()
    if drawings is not None:
        behind = drawings.join(linked.withColumnRenamed("figure", "drawing"), [key, "drawing"]).select(key, "figure")
        linked = linked.unionByName(behind).distinct()
    return figures.join(linked, [key, "figure"], "left_semi").select(key, F.concat(F.lit("images/"), "figure").alias("path"), "content")


PROGRESS = ("ok", "blank", "failed")


def progress_files(results: DataFrame, key: str, total: str) -> DataFrame:
    """(key, path, content): progress.json and results.json of each run, from its page results so far.

    results: key, total (pages of the run), chunk, page, status, and whatever else a
    page's entry shall hold. A run's results are one file, so they must fit into a
    row. Counts are those of the pages; a page that is retried is no failed one.
    """
    entry = F.struct(*[F.col(c) for c in results.columns if c not in (key, total)])
    many = {s: F.count_if(F.col("status") == s) for s in PROGRESS}
    done = many["ok"] + many["blank"] + many["failed"]
    share = F.when(F.col(total) > 0, F.bround(100.0 * done / F.col(total), 1)).otherwise(F.lit(100.0))
    counts = F.struct(
        F.col(total).cast("long").alias("total_pages"), done.alias("completed_pages"), many["ok"].alias("success_pages"), many["blank"].alias("blank_pages"), many["failed"].alias("failed_pages"),
        F.greatest(F.lit(0), F.col(total) - done).cast("long").alias("pending_pages"), share.alias("percent"),
    )
    rows = results.groupBy(key, total).agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("results"), F.to_json(counts).alias("progress"))
    each = F.explode(F.array(*[F.struct(F.lit(f"{n}.json").alias("path"), F.concat(F.col(n), F.lit("\n")).alias("content")) for n in ("progress", "results")]))
    return rows.select(key, each.alias("f")).select(key, "f.path", "f.content")
