"""A list that is served in pages, as a Spark data source. What fetches a page is a parameter."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from importlib import import_module

from pyspark.sql.datasource import DataSource, DataSourceReader, SimpleDataSourceStreamReader

#: So many empty pages in a row end a list.
EMPTY_PAGES = 3
#: Attempts at a page, and seconds before the first repetition; each further one waits as much longer.
ATTEMPTS, PAUSE = 3, 2.0


def attempt(fetch: Callable, *asked, attempts: int = ATTEMPTS, pause: float = PAUSE):
    """What fetch gives for what is asked, tried again after OSError; None if every attempt fails."""
    for n in range(1, attempts + 1):
        try:
            return fetch(*asked)
        except OSError:
            if n < attempts:
                time.sleep(pause * n)
    return None


def pages(fetch: Callable[[int, int], str | None], start: int = 0, size: int = 20, has_items: Callable[[str], bool] = lambda html: "<li" in html, attempts: int = ATTEMPTS, pause: float = PAUSE) -> Iterator[tuple[int, str]]:
    """(start, html) of each page with items; ends after three empty pages in a row, or a page without items."""
    empty = 0
    while empty < EMPTY_PAGES:
        html = attempt(fetch, start, size, attempts=attempts, pause=pause)
        if html and html.strip():
            if not has_items(html):
                return
            empty = 0
            yield start, html
        else:
            empty += 1
        start += size


class PagedList(DataSource):
    """format("paged"): options fetch ("module:function" of (start, size), importable on executors), start, size, pause.

    A list's end is known only by walking it, so one task reads it, a page at a time. As a stream, it is walked
    `pages_per_batch` pages at a time (10), from where the checkpoint says.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page_id long, html string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return PagedStreamReader(dict(self.options))


def fetcher(options: dict[str, str]) -> Callable[[int, int], str | None]:
    module, _, function = options["fetch"].partition(":")
    return getattr(import_module(module), function)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def read(self, partition) -> Iterator[tuple]:
        yield from pages(fetcher(self.options), int(self.options.get("start", 0)), int(self.options.get("size", 20)), pause=float(self.options.get("pause", PAUSE)))


class PagedStreamReader(SimpleDataSourceStreamReader):
    """A list as a stream. An offset is where the next page starts and how many empty pages in a row came before it.

    It ends as `pages` does: after three empty pages in a row, or at a page without items; from there on the offset stays, and
    a restarted stream asks for nothing. A batch that runs again fetches its pages again.
    """

    def __init__(self, options: dict[str, str], has_items: Callable[[str], bool] = lambda html: "<li" in html):
        self.options, self.has_items = options, has_items
        self.size, self.most = int(options.get("size", 20)), int(options.get("pages_per_batch", 10))

    def page(self, at: int) -> str | None:
        return attempt(fetcher(self.options), at, self.size, pause=float(self.options.get("pause", PAUSE)))

    def initialOffset(self) -> dict[str, int]:
        return {"start": int(self.options.get("start", 0)), "empty": 0}

    def read(self, start: dict[str, int]) -> tuple[Iterator[tuple], dict[str, int]]:
        at, empty, rows = start["start"], start["empty"], []
        for _ in range(self.most):
            if empty >= EMPTY_PAGES:
                break
            html = self.page(at)
            if html and html.strip():
                if not self.has_items(html):
                    empty = EMPTY_PAGES
                    break
                rows.append((at, html))
                empty = 0
            else:
                empty += 1
            at += self.size
        return iter(rows), {"start": at, "empty": empty}

    def readBetweenOffsets(self, start: dict[str, int], end: dict[str, int]) -> Iterator[tuple]:
        for at in range(start["start"], end["start"], self.size):
            html = self.page(at)
            if html and html.strip() and self.has_items(html):
                yield at, html

    def commit(self, end: dict[str, int]) -> None:
        """Nothing is held for a batch that is done."""
