"""Page indexes and page texts behind a JSON API, as a data source and as a crawl.

What speaks to the server is a transport, a function from parameters to the decoded answer,
named as ``module:function`` so that every task can import it.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "index string, title string, pageid bigint, quality int"
#: Answers that are worth asking for again.
AGAIN = (429, 500, 502, 503, 504)


def over_http(params: dict, tries: int = 5, wait: float = 2.0) -> dict:
    """The answer of the server that ``endpoint`` names; waits longer after each refusal."""
    endpoint = params["endpoint"]
    query = urllib.parse.urlencode({"format": "json", **{k: v for k, v in params.items() if k != "endpoint"}})
    for attempt in range(tries):
        try:
            with urllib.request.urlopen(f"{endpoint}?{query}", timeout=30) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as refused:
            if refused.code not in AGAIN or attempt + 1 == tries:
                raise
            time.sleep(wait * 2**attempt)
    raise AssertionError("unreachable")


def transport(name: str) -> Callable[[dict], dict]:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def answered(fetch: Callable[[dict], dict], params: dict) -> dict:
    """The answer, which must not be an error."""
    got = fetch(params)
    if "error" in got:
        raise RuntimeError(f"the API says: {got['error']}")
    return got


def index_pages(fetch: Callable[[dict], dict], index: str, floor: int, token: dict | None = None, extra: dict | None = None) -> Iterator[tuple[list[tuple], dict]]:
    """(rows, token) of each answer about an index: its pages of at least floor, and the token that asks for the next, empty at the end."""
    while token is None or token:
        got = answered(fetch, {"action": "query", "generator": "proofreadpagesinindex", "gprppiititle": index, "prop": "proofread", **(extra or {}), **(token or {})})
        rows = [(index, p["title"], p["pageid"], q) for p in got.get("query", {}).get("pages", {}).values() if (q := p.get("proofread", {}).get("quality")) is not None and q >= floor]
        token = got.get("continue", {})
        yield rows, token


class _OfIndex(InputPartition):
    def __init__(self, index: str):
        self.index = index


class PageIndex(DataSource):
    """``spark.read.format("page_index")``: (index, title, pageid, quality) of the pages of indexes.

    Options: indexes, a JSON list of titles, each a partition; min_quality, 3 if not given,
    pages without a quality never come; transport; endpoint.  As a stream, each micro-batch is
    one answer, and the offset holds the API's own continuation token, so a restart asks
    for what was not yet taken in.
    """

    @classmethod
    def name(cls) -> str:
        return "page_index"

    def schema(self) -> str:
        return SCHEMA

    def _settings(self) -> tuple[list[str], int, str, dict]:
        o = self.options
        return json.loads(o.get("indexes", "[]")), int(o.get("min_quality", "3")), o.get("transport", "quern.sources.api:over_http"), {"endpoint": o["endpoint"]} if "endpoint" in o else {}

    def reader(self, schema) -> DataSourceReader:
        return _Reader(*self._settings())

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _StreamReader(*self._settings())


class _Reader(DataSourceReader):
    def __init__(self, indexes: list[str], floor: int, fetch: str, extra: dict):
        self.indexes, self.floor, self.fetch, self.extra = indexes, floor, fetch, extra

    def partitions(self) -> list[InputPartition]:
        return [_OfIndex(x) for x in self.indexes]

    def read(self, partition: _OfIndex) -> Iterator[tuple]:
        for rows, _ in index_pages(transport(self.fetch), partition.index, self.floor, extra=self.extra):
            yield from rows


class _StreamReader(SimpleDataSourceStreamReader):
    def __init__(self, indexes: list[str], floor: int, fetch: str, extra: dict):
        self.indexes, self.floor, self.fetch, self.extra = indexes, floor, fetch, extra

    def initialOffset(self) -> dict:  # noqa: N802
        return {"at": 0, "token": None}

    def _next(self, offset: dict) -> tuple[list[tuple], dict]:
        if offset["at"] >= len(self.indexes):
            return [], offset
        rows, token = next(index_pages(transport(self.fetch), self.indexes[offset["at"]], self.floor, offset["token"], self.extra))
        return rows, {"at": offset["at"], "token": token} if token else {"at": offset["at"] + 1, "token": None}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._next(start)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        while start != end:
            rows, start = self._next(start)
            yield from rows


def crawl(titles: DataFrame, fetch: str, done: DataFrame | None = None, title: str = "title", **extra: str) -> DataFrame:
    """(title, text, revid, error) of the pages with these titles that are not in done (title).

    A page that cannot be had is a row with its error, so one failure neither ends the crawl
    nor is lost.  Each title is asked for once, whatever it repeats.
    """
    wanted = titles.select(title).where(f"`{title}` is not null").distinct()
    if done is not None:
        wanted = wanted.join(done.select(title), title, "left_anti")
    schema = pa.schema([("title", pa.string()), ("text", pa.string()), ("revid", pa.int64()), ("error", pa.string())])

    def one(name: str, ask: Callable[[dict], dict]) -> tuple:
        try:
            got = answered(ask, {"action": "query", "titles": name, "prop": "revisions", "rvprop": "content|ids", "rvslots": "main", **extra})
            revision = next(iter(got["query"]["pages"].values()))["revisions"][0]
            return name, revision["slots"]["main"]["*"], revision["revid"], None
        except Exception as error:  # noqa: BLE001  whatever it is, it becomes a row
            return name, None, None, f"{type(error).__name__}: {error}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = transport(fetch)
        for batch in batches:
            rows = [one(x, ask) for x in batch.column(0).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return wanted.mapInArrow(run, "title string, text string, revid bigint, error string")
