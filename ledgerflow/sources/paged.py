"""A paged API as a Spark data source."""

from __future__ import annotations

import http.client
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerflow.sources.json_records import json_records

FORMAT = "paged_transactions"
# Pages are ordered by a unique key, so no record moves between pages of one scan.
PAGE_ORDER = "transaction_date.asc,transaction_id.asc"

Params = dict[str, Any]
FetchPage = Callable[[Params], list[dict[str, Any]]]


class AuthError(RuntimeError):
    """The source refused the credentials. Never retried, never answered by a fallback."""


class TransientError(RuntimeError):
    """A retryable failure that lasted through all retries."""


class RequestError(RuntimeError):
    """The request failed in another way, such as an unreachable host or a rejected query."""


def page_params(page: int, page_size: int, watermark: str | None) -> Params:
    params: Params = {"limit": page_size, "offset": page * page_size, "order": PAGE_ORDER}
    if watermark:
        params["transaction_date"] = f"gte.{watermark}"
    return params


class PagedSource(DataSource):
    """Reads pages side by side when the number of pages is unknown.

    Each of ``parallelism`` readers takes every ``parallelism``-th page and stops at the first
    short or empty one. Pages behind the end are empty, so every reader ends there, and the
    price of not knowing the end is one extra request per reader.
    """

    fetch_page: FetchPage

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "raw_payload string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(type(self).fetch_page, self.options)


class PagedReader(DataSourceReader):
    def __init__(self, fetch_page: FetchPage, options: dict[str, str]) -> None:
        self.fetch_page = fetch_page
        self.page_size = int(options.get("page_size", 1000))
        self.parallelism = int(options.get("parallelism", 1))
        self.max_pages = int(options["max_pages"]) if "max_pages" in options else None
        self.watermark = options.get("watermark")
        if self.page_size < 1 or self.parallelism < 1:
            raise ValueError("page_size and parallelism must be at least 1")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(first) for first in range(self.parallelism)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        page = partition.value
        while self.max_pages is None or page < self.max_pages:
            records = self.fetch_page(page_params(page, self.page_size, self.watermark))
            if records:
                texts = [json.dumps(record, sort_keys=True, ensure_ascii=False) for record in records]
                yield pa.RecordBatch.from_pydict({"raw_payload": pa.array(texts, pa.string())})
            if len(records) < self.page_size:
                self._require_end(page, len(records))
                return
            page += self.parallelism

    def _require_end(self, page: int, count: int) -> None:
        """A short page ends an unlimited scan only if nothing follows it; a server may cap its pages."""
        if not count or self.max_pages is not None:
            return
        params = dict(page_params(page, self.page_size, self.watermark))
        params["offset"] = type(params["offset"])(int(params["offset"]) + count)
        if self.fetch_page(params):
            raise ValueError(
                f"the source sent {count} records where {self.page_size} were asked for, and has more; "
                "set page_size to what it sends"
            )


def read_paged(
    spark: SparkSession,
    fetch_page: FetchPage,
    *,
    watermark: str | None = None,
    page_size: int = 1000,
    parallelism: int = 1,
    max_pages: int | None = None,
) -> DataFrame:
    """Scan a paged source. ``fetch_page`` travels to the executors, so it must be picklable."""
    source = type("InjectedPagedSource", (PagedSource,), {"fetch_page": staticmethod(fetch_page)})
    spark.dataSource.register(source)
    reader = spark.read.format(FORMAT).option("page_size", page_size).option("parallelism", parallelism)
    if watermark:
        reader = reader.option("watermark", watermark)
    if max_pages is not None:
        reader = reader.option("max_pages", max_pages)
    return json_records(reader.load())


class HttpPages:
    """Fetches pages over HTTP with bounded retries; ``send`` and ``sleep`` can be replaced."""

    def __init__(
        self,
        base_url: str,
        api_key: str | None = None,
        *,
        timeout_seconds: int = 15,
        max_retries: int = 3,
        send: Callable[[str, dict[str, str], int], tuple[int, str]] | None = None,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        self.url = f"{base_url.rstrip('/')}/transactions"
        self.headers = {"apikey": api_key, "Authorization": f"Bearer {api_key}"} if api_key else {}
        self.timeout_seconds = timeout_seconds
        self.max_retries = max_retries
        self.send = send or _send
        self.sleep = sleep

    def __call__(self, params: Params) -> list[dict[str, Any]]:
        url = f"{self.url}?{urllib.parse.urlencode(params)}"
        for attempt in range(self.max_retries + 1):
            if attempt:
                self.sleep(min(2 ** (attempt - 1), 8))
            try:
                status, body = self.send(url, self.headers, self.timeout_seconds)
            except TimeoutError:
                problem = "timed out"
                continue
            if status in (401, 403):
                raise AuthError(f"authentication failed with HTTP {status}")
            if status == 429 or status >= 500:
                problem = f"answered HTTP {status}"
                continue
            if status >= 400:
                raise RequestError(f"request rejected with HTTP {status}")
            try:
                records = json.loads(body)
            except json.JSONDecodeError as exc:
                raise RequestError("the source answered with something else than JSON") from exc
            if not isinstance(records, list):
                raise ValueError("a page must be a JSON array")
            return records
        raise TransientError(f"source {problem} after {self.max_retries} retries")


def _send(url: str, headers: dict[str, str], timeout: int) -> tuple[int, str]:
    request = urllib.request.Request(url, headers=headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.status, response.read().decode("utf-8")
    except urllib.error.HTTPError as exc:
        return exc.code, ""
    except urllib.error.URLError as exc:
        if isinstance(exc.reason, TimeoutError):
            raise exc.reason from exc
        raise RequestError(f"request failed: {exc.reason}") from exc
    except (http.client.HTTPException, ConnectionError, UnicodeDecodeError) as exc:
        raise RequestError(f"the answer broke off or can't be read: {type(exc).__name__}") from exc
