"""Paged web APIs as a Spark data source, for one read or as a stream that goes on where it stopped.

The function named by the option ``fetch`` ("package.module:function") takes (query, state) and
returns a page, so transport, credentials and politeness stay with the caller. ``style`` says how an
API turns pages: by offset, by cursor or by number. All queries share one budget of requests, and
one set of keys: an item that two queries find comes once, as the first of them found it.

A read has one partition a query. The stream keeps where each query stands, cursors included, in its
offsets and so in the checkpoint; it fetches on the driver, at most ``budget`` pages a trigger.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

START = {"offset": {"offset": 0}, "cursor": {"cursor": None}, "number": {"page": 1}}
#: Places of a query's items lie between this many times its number and the next.
PLACES = 1 << 40


def turn(fetch: Callable, style: str, query: str, state: dict, size: int) -> tuple[list[dict], dict | None]:
    """The items of a page, and where the next one is; None behind the last."""
    if style == "offset":
        items = fetch(query, {"offset": state["offset"], "limit": size})["items"]
        return items, {"offset": state["offset"] + len(items)} if len(items) >= size else None
    page = fetch(query, state)
    items = page["items"]
    if style == "cursor":
        return items, {"cursor": page["cursor"]} if items and page.get("cursor") else None
    return items, {"page": state["page"] + 1} if items else None


def item_key(item: dict, names: list[str]) -> str | None:
    """The first of these fields that is filled."""
    return next((str(item[n]) for n in names if item.get(n) not in (None, "")), None)


def shares(budget: int, queries: int) -> list[int]:
    """Requests of each query out of a budget for all: as many for each, one at least, until it is used up."""
    each = max(1, budget // max(1, queries))
    return [max(0, min(each, budget - i * each)) for i in range(queries)]


class _Settings:
    def __init__(self, options: dict):
        o = {k.lower(): v for k, v in options.items()}
        module, _, name = o["fetch"].partition(":")
        self.fetch_name, self.queries, self.style = (module, name), json.loads(o["queries"]), o.get("style", "offset")
        self.size, self.budget, self.keys = int(o.get("size", 50)), int(o.get("budget", 20 * max(1, len(self.queries)))), json.loads(o.get("keys", '["id", "link"]'))

    def fetch(self) -> Callable:
        module, name = self.fetch_name
        return getattr(importlib.import_module(module), name)

    def row(self, number: int, place: int, item: dict) -> tuple:
        return self.queries[number], number * PLACES + place, item_key(item, self.keys), json.dumps(item, ensure_ascii=False)


class _Query(InputPartition):
    def __init__(self, number: int, requests: int):
        self.number, self.requests = number, requests


class _Reader(DataSourceReader):
    def __init__(self, settings: _Settings):
        self.settings = settings

    def partitions(self):
        return [_Query(i, n) for i, n in enumerate(shares(self.settings.budget, len(self.settings.queries))) if n]

    def read(self, partition):
        s, fetch, place = self.settings, self.settings.fetch(), 0
        state = START[s.style]
        for _ in range(partition.requests):
            items, state = turn(fetch, s.style, s.queries[partition.number], state, s.size)
            for item in items:
                yield s.row(partition.number, place, item)
                place += 1
            if state is None:
                return


class _Stream(SimpleDataSourceStreamReader):
    """Offsets: of each query where its next page is (null: it has no more) and how many items came."""

    def __init__(self, settings: _Settings):
        self.settings = settings

    def initialOffset(self):
        return {"at": [START[self.settings.style] for _ in self.settings.queries], "items": [0] * len(self.settings.queries)}

    def _walk(self, start: dict, end: dict | None) -> tuple[list[tuple], dict]:
        """Pages from ``start`` on: to ``end`` if it is given, else while the budget lasts, a page of
        each query in turn."""
        s, fetch, rows, used = self.settings, self.settings.fetch(), [], 0
        at, counts = list(start["at"]), list(start["items"])
        moved = True
        while moved:
            moved = False
            for i, query in enumerate(s.queries):
                if at[i] is None or (used >= s.budget if end is None else counts[i] >= end["items"][i] and at[i] == end["at"][i]):
                    continue
                items, at[i] = turn(fetch, s.style, query, at[i], s.size)
                rows += [s.row(i, counts[i] + k, item) for k, item in enumerate(items)]
                counts[i] += len(items)
                used, moved = used + 1, True
        return rows, {"at": at, "items": counts}

    def read(self, start: dict):
        rows, end = self._walk(start, None)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._walk(start, end)[0])

    def commit(self, end: dict) -> None:
        """The checkpoint has the offset; there is nothing to tell the API."""


class PagedJson(DataSource):
    @classmethod
    def name(cls):
        return "paged_json"

    def schema(self):
        return "query string, place long, item_key string, payload string"

    def reader(self, schema):
        return _Reader(_Settings(dict(self.options)))

    def simpleStreamReader(self, schema):
        return _Stream(_Settings(dict(self.options)))


def read_paged(spark: SparkSession, most: int | None = None, **options: str) -> DataFrame:
    """The items of all queries (query, item_key, payload), each once; items without a key are left
    out. ``most``: only so many, in the order of the queries."""
    spark.dataSource.register(PagedJson)
    found = spark.read.format("paged_json").options(**options).load().filter("item_key IS NOT NULL")
    first = found.groupBy("item_key").agg(F.min(F.struct("place", "query", "payload")).alias("at"))
    rows = first.select("at.place", "at.query", "item_key", "at.payload")
    return (rows if most is None else rows.orderBy("place").limit(most)).select("query", "item_key", "payload")


def stream_paged(spark: SparkSession, **options: str) -> DataFrame:
    """The same as a stream. Its state is the keys that have come."""
    spark.dataSource.register(PagedJson)
    found = spark.readStream.format("paged_json").options(**options).load().filter("item_key IS NOT NULL")
    return found.dropDuplicates(["item_key"]).select("query", "item_key", "payload")


def split_observed(item: dict, volatile: list[str], dropped: list[str]) -> dict:
    """A payload with fields that change from visit to visit apart from the stable ones."""
    return {"job": {k: v for k, v in item.items() if k not in volatile and k not in dropped}, "observed": {k: item[k] for k in volatile if k in item}}
