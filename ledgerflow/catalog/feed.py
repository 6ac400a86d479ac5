"""A transactions feed derived from the ``events`` table, every row of it.

The feed holds valid rows, one kind of defect per rule, and replayed rows that differ in the id
only. Remainders of the event id choose the defects; none of them drops rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.text import to_utc_datetime
from ledgerflow.schema import CURRENCIES, FIELDS, MERCHANT_CATEGORIES
from ledgerflow.session import scratch_path, spread_small_input
from ledgerflow.sources.csv_files import as_raw_records
from ledgerflow.sources.paged import TransientError

COUNTRIES = ("US", "DE", "GB", "CH", "JP", "AU", "CA")
# Fields of the API form of a record that are sent as null or left out, by the value of k.
API_NULLS = {13: "status", 19: "transaction_date", 23: "amount", 29: "country_code", 31: "transaction_id"}
API_MISSING = {17: "merchant_name", 37: "amount"}
# Rows of a file of ordered_events at most; a reader holds those of one file.
KEYS_A_FILE = 100_000


def _pick(values: tuple[str, ...], place: Column) -> Column:
    listed = F.array(*[F.lit(value) for value in values])
    return F.element_at(listed, (place % len(values) + 1).cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread_small_input(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return rows.withColumnsRenamed({"event_id": "e"}).withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )


def _text_fields() -> dict[str, Column]:
    e, k = F.col("e"), F.col("k")

    def defect(divisor: int, remainder: int) -> Column:
        return e % divisor == remainder

    iso = F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " ", "T")
    return {
        "account_id": F.when(defect(211, 1), F.concat(F.lit("ACCT"), F.col("user_id"))).otherwise(
            F.concat(F.lit("ACC-"), F.lpad(F.col("user_id").cast("string"), 4, "0"))
        ),
        "transaction_date": F.when(defect(223, 2), iso)
        .when(defect(227, 3), F.lit("2024-02-31T10:30:00Z"))
        .when(e % 3 == 0, F.concat(iso, F.lit("+00:00")))
        .otherwise(F.concat(iso, F.lit("Z"))),
        "amount": F.when(defect(229, 4), F.lit("0"))
        .when(defect(233, 5), F.lit("12.345"))
        .when(defect(239, 6), F.lit("abc"))
        .when(defect(241, 7), F.lit(""))
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string")),
        "currency": F.when(defect(251, 8), F.lit("eur")).otherwise(_pick(CURRENCIES, k)),
        "transaction_type": F.when(e % 4 == 0, F.lit("credit")).otherwise(F.lit("debit")),
        "merchant_name": F.when(defect(257, 9), F.lit("   ")).otherwise(F.concat(F.lit("Merchant "), k)),
        "merchant_category": _pick(MERCHANT_CATEGORIES, k),
        "status": F.when(F.col("event_type") == "signup", F.lit("pending"))
        .when(F.col("event_type") == "error", F.lit("failed"))
        .otherwise(F.lit("completed")),
        "country_code": F.when(defect(263, 10), F.lit("XX")).otherwise(_pick(COUNTRIES, k)),
    }


def feed(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ten text columns, plus the source columns named in ``keep``."""
    texts = _text_fields()

    def record(prefix: str) -> Column:
        fields = {"transaction_id": F.concat(F.lit(prefix), F.col("e")), **texts}
        return F.struct(*[fields[name].alias(name) for name in FIELDS])

    own, replay = record("TXN-"), record("TXN-R")
    records = F.when(F.col("e") % 50 == 0, F.array(own, replay)).otherwise(F.array(own))
    return events(spark, sf_dir).select(F.inline(records), *keep)


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw_records(feed(spark, sf_dir))


def padded_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a careless export writes it: padded upper-case headers and padded values."""
    return feed(spark, sf_dir).select(
        *[F.concat(F.lit("  "), F.col(name), F.lit("\t ")).alias(f" {name.upper()} ") for name in FIELDS]
    )


def arrival_days(k: Column) -> Column:
    """A record arrives 0 to 4 days after its event."""
    return F.floor(k / 20).cast("int")


def first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What had arrived before 2024-01-25; the second batch reads the whole feed."""
    arrived = F.col("ts") + F.make_dt_interval(arrival_days(F.col("k")))
    cut = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    return as_raw_records(feed(spark, sf_dir, ("k", "ts")).filter(arrived < cut).drop("k", "ts"))


def api_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per event, with the numeric id, nulls, missing fields and an extra field."""
    fields = {"transaction_id": F.concat(F.lit("TXN-"), F.col("e")), **_text_fields()}
    is_null = {field: F.col("k") == k for k, field in API_NULLS.items()}
    is_missing = {field: F.col("k") == k for k, field in API_MISSING.items()}

    def part(name: str) -> Column:
        text = fields[name]
        quoted = F.concat(F.lit('"'), text, F.lit('"'))
        if name == "amount":
            quoted = F.when(text.rlike("^[0-9.]+$"), text).otherwise(quoted)
        value = F.when(is_null.get(name, F.lit(False)), F.lit("null")).otherwise(quoted)
        written = F.concat(F.lit(f'"{name}":'), value)
        return F.when(~is_missing.get(name, F.lit(False)), written)

    extra = F.when(F.col("e") % 271 == 11, F.lit('"reviewer_note":"check"'))
    identity = F.concat(F.lit('"id":'), F.col("e"))
    body = F.concat_ws(",", *[part(name) for name in FIELDS], identity, extra)
    return events(spark, sf_dir).select("e", F.concat(F.lit("{"), body, F.lit("}")).alias("raw_payload"))


class EventPages:
    """Serves the ``events`` table page by page, the way an API over it would, from a date on if asked."""

    def __init__(self, sf_dir: str) -> None:
        self.path = f"{sf_dir}/events.parquet"
        self.held: tuple[Any, Any] = (None, None)
        self.sizes: dict[Any, int] = {}

    def _rows(self, table: pq.ParquetFile, group: int, since: str | None):
        """A row group; the last one is held, since a reader's next page is mostly in it."""
        if self.held[0] != (group, since):
            rows = table.read_row_group(group, ["event_id", "ts", "user_id", "value"])
            if since:
                bound = to_utc_datetime(since).replace(tzinfo=None)
                rows = rows.filter(pc.greater_equal(rows["ts"], pa.scalar(bound, rows.schema.field("ts").type)))
            self.held = ((group, since), rows)
            self.sizes[group, since] = rows.num_rows
        return self.held[1]

    def __call__(self, params: dict[str, Any]) -> list[dict[str, Any]]:
        start, stop = params["offset"], params["offset"] + params["limit"]
        since = params.get("transaction_date", "").removeprefix("gte.") or None
        records, seen = [], 0
        table = pq.ParquetFile(self.path)
        for group in range(table.num_row_groups):
            if (group, since) not in self.sizes:
                self._rows(table, group, since)
            rows = self.sizes[group, since]
            if seen < stop and seen + rows > start:
                first = max(start - seen, 0)
                records += self._rows(table, group, since).slice(first, min(stop - seen, rows) - first).to_pylist()
            seen += rows
        return [_api_record(row) for row in records]


def ordered_events(spark: SparkSession, sf_dir: str) -> str:
    """A copy of the dated ``events`` in the order of their keys, in small files: what an API has as its index."""
    path = scratch_path(spark, "event-keys")
    names = ["event_id", "ts", "user_id", "value"]
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").filter("ts IS NOT NULL")
    second = F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " ", "T")
    key = F.concat(second, F.lit(" TXN-"), F.coalesce(F.col("event_id").cast("string"), F.lit("None")))
    place = F.struct("_metadata.file_path", "_metadata.row_index")  # records of one key keep their order
    ordered = rows.select(*names, key.alias("key"), place.alias("place")).repartitionByRange("key")
    ordered = ordered.sortWithinPartitions("key", "place").drop("place")
    ordered.write.option("maxRecordsPerFile", KEYS_A_FILE).parquet(path)
    return path


class CappedPages:
    """Serves ``ordered_events`` by key, never more than ``cap`` records a page whatever is asked for.

    The files' footers have their first and last keys, so a request opens the one its page begins in, and
    others only if the page goes on there. The file opened last is held for the next request.
    """

    def __init__(self, path: str, cap: int) -> None:
        self.path, self.cap = path, cap
        self.groups: list[tuple[str, str, str, int]] | None = None
        self.held: tuple[Any, Any] = (None, None)

    def _listed(self) -> list[tuple[str, str, str, int]]:
        """First key, last key, file and number of each row group, in the order of the keys."""
        if self.groups is None:
            self.store, folder = fs.FileSystem.from_uri(self.path) if ":/" in self.path else (fs.LocalFileSystem(), self.path)
            found = []
            for info in self.store.get_file_info(fs.FileSelector(folder)):
                if info.base_name.endswith(".parquet"):
                    with pq.ParquetFile(info.path, filesystem=self.store) as table:
                        place = table.schema_arrow.get_field_index("key")
                        for group in range(table.num_row_groups):
                            keys = table.metadata.row_group(group).column(place).statistics
                            found.append((keys.min, keys.max, info.path, group))
            self.groups = sorted(found)
        return self.groups

    def _rows(self, path: str, group: int) -> pa.Table:
        if self.held[0] != (path, group):
            self.held = (None, None)
            with pq.ParquetFile(path, filesystem=self.store) as table:
                self.held = ((path, group), table.read_row_group(group).combine_chunks())
        return self.held[1]

    def __call__(self, params: dict[str, Any]) -> list[dict[str, Any]]:
        bounds = params.get("and", "")
        low, high, after = (re.search(pattern, bounds) for pattern in (r"e\.gte\.([^,)]+)", r"e\.lt\.([^,)]+)", AFTER))
        # A second is less than each of its keys, and a key with something behind it is greater than that key.
        start = f"{_second(after[1])} {after[2]}\0" if after else _second(low[1] if low else "1970-01-01T00:00:00Z")
        end, most = _second(high[1]) if high else None, min(self.cap, params["limit"])
        records: list[dict[str, Any]] = []
        groups = self._listed()
        for first, _, path, group in groups[bisect_left(groups, start, key=lambda g: g[1]) :]:
            if len(records) == most or (end and first >= end):
                break
            rows = self._rows(path, group)
            keys = rows["key"].chunk(0)
            begin = bisect_left(range(len(keys)), start, key=lambda i: keys[i].as_py())
            stop = bisect_left(range(len(keys)), end, key=lambda i: keys[i].as_py()) if end else len(keys)
            size = min(stop - begin, most - len(records))
            if size > 0:
                records += map(_api_record, rows.slice(begin, size).to_pylist())
        return records


AFTER = r"transaction_date\.eq\.([^,)]+),transaction_id\.gt\.([^,)]+)"


def _second(text: str) -> str:
    return to_utc_datetime(text).isoformat()


def _api_record(row: dict[str, Any]) -> dict[str, Any]:
    """Only fields with one fixed value differ from a record a real API would send."""
    return {
        "id": row["event_id"],
        "transaction_id": f"TXN-{row['event_id']}",
        "account_id": f"ACC-{row['user_id']:04d}",
        "transaction_date": row["ts"].strftime("%Y-%m-%dT%H:%M:%S+00:00"),
        "amount": round(row["value"], 2),
        "currency": "EUR",
        "transaction_type": "debit",
        "merchant_name": "Merchant",
        "merchant_category": "retail",
        "status": "completed",
        "country_code": "SE",
    }


class UnavailablePages:
    """A source that stays down."""

    def __call__(self, params: dict[str, Any]) -> list[dict[str, Any]]:
        raise TransientError("source answered HTTP 503 after 3 retries")
