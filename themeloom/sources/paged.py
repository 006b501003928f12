"""A Spark data source over paged review feeds, in batches and as a stream: one partition for each country."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
)

from themeloom.plans.session import workers_find_package
from themeloom.sources.shared import open_folder

SCHEMA = "seq bigint, id string, rating int, content string, date timestamp, app_version string, title string, country string"
_FIELDS = ("id", "rating", "content", "date", "app_version", "title")


class PagePartition(InputPartition):
    """Pages first to last - 1 of a country; all of them if last is None."""

    def __init__(self, country: str, first: int = 0, last: int | None = None, token: str | None = None):
        self.country, self.first, self.last, self.token = country, first, last, token


def _utc(at: datetime | None) -> datetime | None:
    """Naive times are UTC."""
    return at if at is None or at.tzinfo else at.replace(tzinfo=UTC)


class Pages:
    """How a feed is asked: client(country, token, **args) -> (rows, next token), newest rows first.

    A country ends at its `cap` of rows, at the first row before `cutoff` (an ISO time), at an empty page or at a null token;
    `delay` seconds pass between two pages. Rows are dicts of SCHEMA but seq and country; a null date never ends a feed.
    """

    def __init__(self, options: dict):
        self.module, _, self.name = options["client"].partition(":")
        self.args = json.loads(options.get("args", "{}"))
        self.countries = [c.strip() for c in options.get("countries", "us").split(",")]
        self.most, self.delay = int(options.get("cap", 500)), float(options.get("delay", 0))
        self.cutoff = _utc(datetime.fromisoformat(options["cutoff"])) if options.get("cutoff") else None

    def client(self) -> Callable:
        return getattr(importlib.import_module(self.module), self.name)

    def page(self, country: str, token: str | None, seq: int) -> dict:
        """The page at a token: its rows that count, the next token, and whether the feed ends with it."""
        rows, after = self.client()(country, token, **self.args)
        kept, ended = [], not rows or after is None
        for row in rows:
            date = _utc(row.get("date"))
            if seq + len(kept) >= self.most or (self.cutoff and date and date < self.cutoff):
                ended = True
                break
            kept.append(row)
        ended = ended or seq + len(kept) >= self.most
        return {"rows": kept, "after": None if ended else after, "ended": ended, "seq": seq}


def _tuples(page: dict, country: str) -> Iterator[tuple]:
    for k, row in enumerate(page["rows"]):
        yield (page["seq"] + k, *(_utc(row.get(c)) if c == "date" else row.get(c) for c in _FIELDS), country)


class PagedReader(DataSourceReader):
    """Whole feeds. `date >= x` and `date > x` end the paging, equality with countries leaves the others unasked."""

    def __init__(self, options: dict):
        self.pages = Pages(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Pages are newest first, so a least date is a cutoff; Spark still tests it, as dates may be null or out of order."""
        for f in filters:
            if isinstance(f, GreaterThan | GreaterThanOrEqual) and f.attribute == ("date",) and isinstance(f.value, datetime):
                least = _utc(f.value)
                self.pages.cutoff = max(self.pages.cutoff or least, least)
                yield f
            elif isinstance(f, EqualTo | In) and f.attribute == ("country",):
                wanted = [f.value] if isinstance(f, EqualTo) else list(f.value)
                self.pages.countries = [c for c in self.pages.countries if c in wanted]
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [PagePartition(c) for c in self.pages.countries]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        if partition is None or not hasattr(partition, "country"):
            return  # no country is left
        token, seq = None, 0
        while True:
            page = self.pages.page(partition.country, token, seq)
            yield from _tuples(page, partition.country)
            if page["ended"]:
                return
            token, seq = page["after"], seq + len(page["rows"])
            time.sleep(self.pages.delay)


class PageLog:
    """Fetched pages as files, one for each page of a country, in a folder that driver and executors share."""

    def __init__(self, uri: str):
        self.store, self.root = open_folder(uri)

    def _path(self, country: str, number: int) -> str:
        return f"{self.root}/{country}/{number:09d}.json"

    def numbers(self, country: str) -> list[int]:
        held = self.store.get_file_info(fs.FileSelector(f"{self.root}/{country}", allow_not_found=True))
        return sorted(int(x.base_name[:9]) for x in held if x.base_name.endswith(".json"))

    def get(self, country: str, number: int) -> dict | None:
        path = self._path(country, number)
        if self.store.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.store.open_input_stream(path) as f:
            page = json.loads(f.read())
        for row in page["rows"]:
            row["date"] = row.get("date") and datetime.fromisoformat(row["date"])
        return page

    def put(self, country: str, number: int, page: dict) -> None:
        """The file appears whole or not at all."""
        self.store.create_dir(f"{self.root}/{country}")
        path = self._path(country, number)
        part = f"{path}.{time.time_ns()}"
        with self.store.open_output_stream(part) as f:
            f.write(json.dumps(page, default=datetime.isoformat).encode())
        self.store.move(part, path)

    def drop(self, country: str, number: int) -> None:
        self.store.delete_file(self._path(country, number))


class PagedStreamReader(DataSourceStreamReader):
    """A page of each country for each batch. Offsets hold the number of pages and the token of the next one.

    Executors fetch the pages and write each to the log (option `log`, a folder that all share, named for one query)
    before they hand on its rows. A task or batch that runs again, also after a restart, reads the log and asks for no page
    twice. Committed pages are deleted but for the newest, which knows how to go on.
    """

    def __init__(self, options: dict):
        self.pages, self.uri = Pages(options), options["log"]

    def initialOffset(self) -> dict:
        return {c: {"pages": 0, "token": None} for c in self.pages.countries}

    def latestOffset(self) -> dict:
        log, out = PageLog(self.uri), {}
        for c in self.pages.countries:
            held = log.numbers(c)
            newest = log.get(c, held[-1]) if held else {"ended": False, "after": None}
            out[c] = {"pages": (held[-1] + 1 if held else 0) + (not newest["ended"]), "token": newest["after"]}
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        asked = [(c, start.get(c, {"pages": 0})["pages"], end[c]) for c in end]
        return [PagePartition(c, first, last["pages"], last["token"]) for c, first, last in asked if first < last["pages"]]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        log, country = PageLog(self.uri), partition.country
        for number in range(partition.first, partition.last):
            page = log.get(country, number)
            if page is None:
                before = log.get(country, number - 1) if number else {"rows": [], "after": None, "ended": False, "seq": 0}
                if before is None:
                    raise RuntimeError(f"page {number - 1} of {country} is gone from {self.uri}")
                page = self.pages.page(country, before["after"], before["seq"] + len(before["rows"]))
                log.put(country, number, page)
            yield from _tuples(page, country)

    def commit(self, end: dict) -> None:
        log = PageLog(self.uri)
        for c in end:
            for number in log.numbers(c):
                if number < end[c]["pages"] - 1:
                    log.drop(c, number)


class PagedFeed(DataSource):
    """spark.read.format("paged_feed").option("client", "module:function").option("countries", "us,gb"); also readStream."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> PagedStreamReader:
        return PagedStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make `paged_feed` known to a session, with filters pushed down to it."""
    workers_find_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedFeed)
