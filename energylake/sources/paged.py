"""A dataset that is served in pages, as a Spark data source.

Each task pulls its own run of pages, so a pull is as parallel as the service
allows, and a lost task asks for its pages again.  Read as a stream, the
checkpoint holds the row reached, which makes a pull resumable.

    spark.dataSource.register(paged_source(HttpPages(url)))
    spark.read.format("paged").option("offset", 5000).load()
"""

from __future__ import annotations

import json
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, InputPartition)

from energylake.fixed_values import PAGE_SIZE

# the reader classes travel whole, so executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES_PER_TASK = 100
TEXT_ROWS = "value string"


class Pages(Protocol):
    """What a paged service offers; instances travel to the executors."""

    def total(self) -> int:
        """Rows available now."""

    def page(self, start: int, size: int) -> Iterable[tuple]:
        """Up to ``size`` rows from row ``start`` on."""


class HttpPages:
    """REST dataset answering ``?size=&from=`` with ``{"total": n, "results": [...]}``.

    A row is the record's JSON text, untouched.  A request that keeps failing fails
    the task, which Spark repeats; no page is ever skipped.
    """

    def __init__(self, url: str, timeout: float = 30.0, retries: int = 3, wait: float = 2.0,
                 opener=urllib.request.urlopen):
        self.url, self.timeout, self.retries, self.wait = url, timeout, retries, wait
        self.opener = opener

    def total(self) -> int:
        reply = self._get({"size": 1})
        if reply.get("total") is None:
            raise ValueError(f"{self.url} does not say how many rows it has")
        return int(reply["total"])

    def page(self, start: int, size: int) -> Iterator[tuple]:
        reply = self._get({"size": size, "from": start, "format": "json"})
        for record in reply.get("results", []):
            yield (json.dumps(record, ensure_ascii=False),)

    def _get(self, params: dict) -> dict:
        address = f"{self.url}?{urllib.parse.urlencode(params)}"
        for attempt in range(self.retries + 1):
            try:
                with self.opener(address, timeout=self.timeout) as reply:
                    return json.load(reply)
            except (urllib.error.URLError, TimeoutError):
                if attempt == self.retries:
                    raise
                time.sleep(self.wait * 2 ** attempt)


@dataclass
class PageRun(InputPartition):
    """Rows start..stop, to be asked for page by page."""

    start: int
    stop: int
    size: int


def page_runs(start: int, stop: int, size: int, pages: int) -> list[PageRun]:
    """Runs of whole pages; the last page of the last run may be short."""
    step = size * pages
    return [PageRun(a, min(a + step, stop), size) for a in range(start, stop, step)]


def _pull(pages: Pages, run: PageRun) -> Iterator:
    """Rows of a run; a page with fewer rows than planned fails it, as rows would be lost."""
    for start in range(run.start, run.stop, run.size):
        wanted, got = min(run.size, run.stop - start), 0
        for row in pages.page(start, wanted):
            got += row.num_rows if isinstance(row, pa.RecordBatch) else 1
            yield row
        if got < wanted:
            raise ValueError(f"{got} rows instead of {wanted} from row {start} on")


def paged_source(pages: Pages, schema: str = TEXT_ROWS, name: str = "paged") -> type[DataSource]:
    """Data source class over ``pages``, to be registered with the session.

    Options: ``offset`` first row, ``limit`` most rows, ``page_size``,
    ``pages_per_task``.
    """

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(self._settings())

        def streamReader(self, schema) -> DataSourceStreamReader:
            return PagedStream(self._settings())

        def _settings(self) -> dict:
            limit = self.options.get("limit")
            return {"offset": int(self.options.get("offset", 0)),
                    "limit": None if limit is None else int(limit),
                    "size": int(self.options.get("page_size", PAGE_SIZE)),
                    "pages": int(self.options.get("pages_per_task", PAGES_PER_TASK))}

    def last_row(settings: dict) -> int:
        available, limit = pages.total(), settings["limit"]
        return available if limit is None else min(available, settings["offset"] + limit)

    class PagedReader(DataSourceReader):
        def __init__(self, settings: dict):
            self.settings = settings

        def partitions(self) -> list[PageRun]:
            s = self.settings
            return (page_runs(s["offset"], last_row(s), s["size"], s["pages"])
                    or [PageRun(0, 0, s["size"])])

        def read(self, partition: PageRun) -> Iterator:
            return _pull(pages, partition)

    class PagedStream(DataSourceStreamReader):
        def __init__(self, settings: dict):
            self.settings = settings

        def initialOffset(self) -> dict:
            return {"row": self.settings["offset"]}

        def latestOffset(self) -> dict:
            return {"row": max(self.settings["offset"], last_row(self.settings))}

        def partitions(self, start: dict, end: dict) -> list[PageRun]:
            s = self.settings
            return page_runs(start["row"], end["row"], s["size"], s["pages"])

        def read(self, partition: PageRun) -> Iterator:
            return _pull(pages, partition)

    return PagedSource
