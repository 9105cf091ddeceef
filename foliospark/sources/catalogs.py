"""Paged model catalogs as a data source.

A catalog is read page by page: each response names the next one by a token. The
responses are stored as JSON lines (token, status, body), a folder for each
catalog; ``spark.read.format("paged_catalog")`` makes a partition of every
catalog, follows its chain there, and stops at what is wrong with it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Limits of a catalog: pages, models, bytes of a response, characters of a token.
MOST_PAGES, MOST_MODELS, MOST_BYTES, MOST_TOKEN = 10, 1000, 2 << 20, 4096
IDENTIFIER = re.compile("[a-zA-Z0-9][a-zA-Z0-9._-]{0,109}")
SCHEMA = (
    "catalog string, id string, displayName string, description string, inputTokenLimit bigint, outputTokenLimit bigint, "
    "methods array<string>, thinking boolean, pages int, error string"
)
FORMAT = "paged_catalog"


class CatalogError(ValueError):
    """What is wrong with a catalog; never holds a response's text."""


def _page(status: int, body: str) -> dict:
    if status != 200:
        raise CatalogError(f"HTTP {status}")
    if len(body.encode()) > MOST_BYTES:
        raise CatalogError("response over 2 MiB")
    try:
        page = json.loads(body)
    except ValueError:
        raise CatalogError("response is no JSON") from None
    if not isinstance(page, dict) or not isinstance(page.get("models"), list):
        raise CatalogError("response has no list of models")
    if not all(isinstance(m, dict) for m in page["models"]):
        raise CatalogError("a model is no object")
    return page


def _model(m: dict, identifier: str) -> tuple:
    try:
        limits = [int(m.get(k) or 0) for k in ("inputTokenLimit", "outputTokenLimit")]
    except (TypeError, ValueError):
        raise CatalogError("a limit is no number") from None
    methods = m.get("supportedGenerationMethods") or []
    return (str(m.get("displayName") or identifier)[:128], str(m.get("description") or "")[:2000], *limits, [str(x) for x in methods] if isinstance(methods, list) else [], m.get("thinking") is True)


def models_of(responses: dict[str, tuple[int, str]]) -> tuple[dict[str, tuple], int]:
    """Models by id of a catalog's responses by token, and how many pages the chain from the empty token has; the last row of an id wins."""
    models: dict[str, tuple] = {}
    token, seen = "", {""}
    for number in range(1, MOST_PAGES + 1):
        if token not in responses:
            raise CatalogError("a page is not there")
        page = _page(*responses[token])
        for m in page["models"]:
            identifier = str(m.get("name", "")).removeprefix("models/")
            if IDENTIFIER.fullmatch(identifier):
                models[identifier] = _model(m, identifier)
        if len(models) > MOST_MODELS:
            raise CatalogError(f"over {MOST_MODELS} models")
        token = page.get("nextPageToken") or ""
        if not token:
            if not models:
                raise CatalogError("empty catalog")
            return models, number
        if not isinstance(token, str) or len(token) > MOST_TOKEN or token in seen:
            raise CatalogError("page token is invalid or comes again")
        seen.add(token)
    raise CatalogError(f"over {MOST_PAGES} pages")


class CatalogPartition(InputPartition):
    def __init__(self, catalog: str, files: list[str]):
        super().__init__((catalog, files))


class CatalogReader(DataSourceReader):
    """mode failfast: a catalog's error ends the read; permissive: it is the catalog's only row."""

    def __init__(self, options: dict[str, str]):
        self.path, self.mode = options["path"], options.get("mode", "failfast").lower()
        if self.mode not in ("failfast", "permissive"):
            raise ValueError("mode is failfast or permissive")

    def partitions(self) -> list[CatalogPartition]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path)
        files: dict[str, list[str]] = {}
        for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
            named = re.search("/catalog=([^/]*)/[^/_.][^/]*$", info.path)
            if info.type == fs.FileType.File and named:
                files.setdefault(named[1], []).append(info.path)
        return [CatalogPartition(c, sorted(f)) for c, f in sorted(files.items())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from urllib.parse import unquote

        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(self.path)
        catalog, files = partition.value
        responses: dict[str, tuple[int, str]] = {}
        for name in files:
            with store.open_input_stream(name) as f:
                for line in f.read().decode().splitlines():
                    r = json.loads(line)
                    responses[r.get("token", "")] = (r["status"], r.get("body", ""))
        catalog = unquote(catalog)
        try:
            models, pages = models_of(responses)
        except CatalogError as error:
            if self.mode == "failfast":
                raise CatalogError(f"catalog {catalog}: {error}") from None
            yield (catalog, *[None] * 7, None, str(error))
            return
        for identifier in sorted(models):
            yield (catalog, identifier, *models[identifier], pages, None)


class PagedCatalog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CatalogReader:
        return CatalogReader(dict(self.options))


def read_catalogs(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """Models of all catalogs stored under ``path``, those of one in the order of their ids."""
    spark.dataSource.register(PagedCatalog)
    return spark.read.format(FORMAT).option("mode", mode).load(path)


def write_responses(responses: DataFrame, path: str) -> None:
    """Store responses (catalog, token, status, body) where read_catalogs finds them."""
    responses.select("catalog", "token", "status", "body").write.mode("overwrite").partitionBy("catalog").json(path)


def as_pages(models: DataFrame, catalog: str, order: str, size: int, model: Column, moved: Callable[[Column], Column] = lambda page: page) -> DataFrame:
    """(catalog, token, status, body): ``model`` structs in pages of ``size``; the first page's token is empty, page n's is p<n>.

    ``moved`` may put a page's models on another page, which is longer then; the token of a page that has none is given all the same.

    Pages are numbered by windows over a catalog; a catalog has at most a few thousand models.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(catalog)
    numbered = models.select(F.col(catalog).alias("catalog"), moved(F.floor((F.row_number().over(w.orderBy(order)) - 1) / size)).alias("page"), F.floor((F.count("*").over(w) - 1) / size).alias("last"), F.col(order).alias("at"), model.alias("m"))
    grouped = numbered.groupBy("catalog", "page", "last").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "m"))), lambda x: x["m"]).alias("models"))
    token = lambda n: F.concat(F.lit("p"), n.cast("string"))
    body = F.to_json(F.struct("models", F.when(F.col("page") < F.col("last"), token(F.col("page") + 1)).alias("nextPageToken")))
    return grouped.select("catalog", F.when(F.col("page") == 0, F.lit("")).otherwise(token(F.col("page"))).alias("token"), F.lit(200).alias("status"), body.alias("body"), "page", "last")
