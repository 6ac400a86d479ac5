"""A paged API read by key ranges, as a Spark data source that takes filters.

Pages are asked for by the last key seen instead of an offset: the next page starts behind (date, id)
of the record before. A page may be shorter than asked for, as servers cap them; only an empty one ends a
range. Time ranges are read side by side, the first and the last of them open, so together they hold every
dated record. A filter on ``event_time`` reaches the request as a bound, and ranges that it leaves
without a time aren't opened.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
)

from ledgerflow.functions.text import to_utc_datetime, to_utc_text
from ledgerflow.sources.paged import PAGE_ORDER, FetchPage, RequestError

FORMAT = "keyset_transactions"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class KeyRange(InputPartition):
    """Records from one time up to, not including, another; None is open."""

    def __init__(self, start: str | None, end: str | None) -> None:
        super().__init__((start, end))
        self.start, self.end = start, end


class KeysetSource(DataSource):
    fetch_page: FetchPage

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "raw_payload string, event_time timestamp_ntz"

    def reader(self, schema) -> DataSourceReader:
        return KeysetReader(type(self).fetch_page, self.options)


class KeysetReader(DataSourceReader):
    def __init__(self, fetch_page: FetchPage, options: dict[str, str]) -> None:
        self.fetch_page = fetch_page
        self.page_size = int(options.get("page_size", 1000))
        self.splits = [text for text in options.get("splits", "").split(",") if text]
        self.since: datetime | None = None
        if self.page_size < 1:
            raise ValueError("page_size must be at least 1")

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take lower bounds on the time. All filters are also left to Spark, whose answer is exact."""
        for item in filters:
            if isinstance(item, (GreaterThan, GreaterThanOrEqual)) and item.attribute == ("event_time",):
                bound = item.value.replace(tzinfo=None, microsecond=0)
                self.since = max(filter(None, (self.since, bound)))
            yield item

    def partitions(self) -> list[InputPartition]:
        bounds = [None, *self.splits, None]
        ranges = [KeyRange(start, end) for start, end in zip(bounds[:-1], bounds[1:])]
        if self.since is None:
            return ranges
        open_ranges = [r for r in ranges if r.end is None or to_utc_datetime(r.end) > self.since]
        first = open_ranges[0]
        return [KeyRange(to_utc_text(self.since), first.end), *open_ranges[1:]]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        after: tuple[str, str] | None = None
        while records := self.fetch_page(keyset_params(partition, after, self.page_size)):
            last = records[-1]
            key = (last["transaction_date"], last["transaction_id"])
            if after is not None and (_time(key[0]), key[1]) <= (_time(after[0]), after[1]):
                raise RequestError(f"the source sent {key} behind {after}: it doesn't page by key")
            after = key
            texts = [json.dumps(record, sort_keys=True, ensure_ascii=False) for record in records]
            times = [_time(record.get("transaction_date")) for record in records]
            yield pa.RecordBatch.from_pydict(
                {"raw_payload": pa.array(texts, pa.string()), "event_time": pa.array(times, pa.timestamp("us"))}
            )


def _time(text: Any) -> datetime | None:
    try:
        return to_utc_datetime(text)
    except (TypeError, ValueError):
        return None


def keyset_params(part: KeyRange, after: tuple[str, str] | None, page_size: int) -> dict[str, Any]:
    """A request for what follows a key in a range; keys are compared as (date, id)."""
    params: dict[str, Any] = {"limit": page_size, "order": PAGE_ORDER}
    bounds = []
    if part.start:
        bounds.append(f"transaction_date.gte.{part.start}")
    if part.end:
        bounds.append(f"transaction_date.lt.{part.end}")
    if after:
        day, key = after
        bounds.append(f"or(transaction_date.gt.{day},and(transaction_date.eq.{day},transaction_id.gt.{key}))")
    if bounds:
        params["and"] = f"({','.join(bounds)})"
    return params


def time_splits(start: str, end: str, ranges: int) -> list[str]:
    """Times that cut a span into equal ranges. Records outside it are in the first and the last one."""
    first, last = to_utc_datetime(start), to_utc_datetime(end)
    step = (last - first) / ranges
    cuts = [first + step * k for k in range(1, ranges)]
    return sorted({to_utc_text(cut - timedelta(microseconds=cut.microsecond)) for cut in cuts})


def read_keyset(
    spark: SparkSession, fetch_page: Callable[[dict], list[dict]], *, splits: list[str] = (), page_size: int = 1000
) -> DataFrame:
    """``raw_payload`` and ``event_time`` of every dated record; a filter on the time is part of the requests.

    Spark offers filters to Python sources only if asked to, which is set for the session.
    """
    spark.conf.set(PUSHDOWN, "true")
    source = type("InjectedKeysetSource", (KeysetSource,), {"fetch_page": staticmethod(fetch_page)})
    spark.dataSource.register(source)
    reader = spark.read.format(FORMAT).option("page_size", page_size).option("splits", ",".join(splits))
    return reader.load()
