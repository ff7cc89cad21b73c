"""A data source over landed pages of a list that is newest first: saved tracks, saved albums, followed artists.

A page is a file ``page-<number>-<oldest>-<newest>.json`` with ``{"items": [...]}``; the bounds in its name are the added_at of its items in microseconds since 1970, so a reader knows without opening a page whether it may hold
anything newer than a cursor.  Each task reads a run of pages.  In a batch, the option ``since`` or (with the option ``pushdown``) a filter on added_at skips older pages; in a
stream the offset is the cursor: each batch takes what is newer than the last one's newest item, and pages that end before it are never opened.

Rows are page, place (from 0), added_at and item (the item's JSON, for ``landed.SCHEMAS`` or a variant).  Items without a time that can be read, and pages that aren't JSON, give no rows.  ``path`` must be one that pyarrow's file systems
open, on the driver and the executors alike.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_NAME = re.compile(r"page-(\d+)-(-?\d+)-(-?\d+)\.json$")
#: Pages that one task reads.
PAGES = 64


def micros(at: datetime) -> int:
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return (at - _EPOCH) // timedelta(microseconds=1)


def instant(text: object) -> datetime | None:
    try:
        at = datetime.fromisoformat(str(text).replace("Z", "+00:00"))
    except ValueError:
        return None
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def page_name(number: int, times: list[datetime]) -> str:
    """The name under which a page is landed."""
    return f"page-{number:08d}-{micros(min(times))}-{micros(max(times))}.json"


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[int, int, str]]:
    """Number, newest and name of every page, in the order of numbers; from the listing alone."""
    from pyarrow import fs

    system, root = file_system(path)
    found = ((_NAME.search(i.path), i.path) for i in system.get_file_info(fs.FileSelector(root, allow_not_found=True)))
    return sorted((int(m[1]), int(m[3]), name) for m, name in found if m)


@dataclass
class Run(InputPartition):
    """Pages of one task, and the bounds of the items that count: after ``low``, up to ``high``."""

    names: list[tuple[int, str]]
    low: int | None = None
    high: int | None = None


def opened(path: str, run: Run) -> Iterator[tuple]:
    system, _ = file_system(path)
    for number, name in run.names:
        with system.open_input_stream(name) as file:
            try:
                items = json.loads(file.read())["items"]
            except (ValueError, KeyError, TypeError):
                continue
        for place, item in enumerate(items if isinstance(items, list) else []):
            at = instant(item.get("added_at")) if isinstance(item, dict) else None
            if at is not None and (run.low is None or micros(at) > run.low) and (run.high is None or micros(at) <= run.high):
                yield number, place, at, json.dumps(item, ensure_ascii=False)


def runs(pages: list[tuple[int, int, str]], low: int | None, high: int | None, size: int) -> list[Run]:
    wanted = [(number, name) for number, newest, name in pages if low is None or newest > low]
    return [Run(wanted[k : k + size], low, high) for k in range(0, len(wanted), size)] or [Run([])]


class PagesReader(DataSourceReader):
    def __init__(self, path: str, since: int | None, size: int):
        self.path, self.since, self.size = path, since, size

    def partitions(self) -> list[Run]:
        return runs(listed(self.path), self.since, None, self.size)

    def read(self, partition: Run) -> Iterator[tuple]:
        return opened(self.path, partition)


class FilteredReader(PagesReader):
    """Takes bounds from filters on added_at, too."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("added_at",):
                low = micros(f.value) - isinstance(f, GreaterThanOrEqual)
                self.since = low if self.since is None else max(self.since, low)
            else:
                yield f


class PagesStream(DataSourceStreamReader):
    def __init__(self, path: str, since: int | None, size: int):
        self.path, self.since, self.size = path, since, size

    def initialOffset(self) -> dict:
        return {"newest": self.since}

    def latestOffset(self) -> dict:
        known = [newest for _, newest, _ in listed(self.path)] + ([] if self.since is None else [self.since])
        return {"newest": max(known, default=None)}

    def partitions(self, start: dict, end: dict) -> list[Run]:
        return runs(listed(self.path), start["newest"], end["newest"], self.size)

    def read(self, partition: Run) -> Iterator[tuple]:
        return opened(self.path, partition)


class LandedPages(DataSource):
    """Options: path, since (an ISO time; what is not newer is left out), pages (of one task) and pushdown (true: filters on added_at skip pages; Spark wants
    spark.sql.python.filterPushdown.enabled for it)."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "page long, place int, added_at timestamp, item string"

    def _asked(self) -> tuple[str, int | None, int]:
        since = self.options.get("since")
        at = None if since is None else instant(since)
        if since is not None and at is None:
            raise ValueError(f"since is not a time: {since!r}")
        return self.options["path"], None if at is None else micros(at), int(self.options.get("pages", PAGES))

    def reader(self, schema) -> PagesReader:
        return (FilteredReader if self.options.get("pushdown", "false").lower() == "true" else PagesReader)(*self._asked())

    def streamReader(self, schema) -> PagesStream:
        return PagesStream(*self._asked())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedPages)
