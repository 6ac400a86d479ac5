"""Volume and freshness gates, paging by key with filters, run audit, epochs of a stream."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerflow.catalog import feed
from ledgerflow.operators.gates import freshness_gate, volume_gate
from ledgerflow.plans import ingest as ingestion
from ledgerflow.plans.ingest import read_log, run_ingestion
from ledgerflow.plans.settings import Settings
from ledgerflow.plans.store import TableStore
from ledgerflow.schema import BRONZE, RUN_AUDIT
from ledgerflow.sources.keyset import read_keyset, time_splits
from ledgerflow.streaming.micro_batch import ingest_micro_batch
from tests.conftest import BASE


def verdicts(spark, *volumes):
    rows = spark.createDataFrame(list(enumerate(volumes)), "day int, n int").withColumn("source", F.lit("csv"))
    return [row["verdict"] for row in volume_gate(rows, ["source"], "day", "n").orderBy("day").collect()]


def test_a_thin_day_is_blocked_and_spoils_no_baseline(spark):
    found = verdicts(spark, 100, 102, 98, 101, 99, 20, 100, 84, 60, 0)
    assert found == ["no_baseline"] * 3 + ["pass", "pass", "block", "pass", "warn", "block", "block"]
    assert verdicts(spark, 100, 100, 100, 96, 500, 0)[3:] == ["pass", "pass", "block"]
    assert verdicts(spark) == []


def test_series_are_judged_apart(spark):
    rows = [(s, day, n) for s, n in (("a", 10), ("b", 1000)) for day in range(6)]
    judged = volume_gate(spark.createDataFrame(rows, "s string, day int, n int"), ["s"], "day", "n").collect()
    assert {row["verdict"] for row in judged} == {"no_baseline", "pass"}


def test_freshness(spark):
    now = datetime(2024, 4, 1)
    rows = [(h, None if h is None else now - timedelta(hours=h)) for h in (1, 30, 80, None)]
    states = spark.createDataFrame(rows, "h int, latest timestamp_ntz")
    judged = freshness_gate(states, "latest", F.lit("2024-04-01 00:00:00").cast("timestamp_ntz"), 24, 72).collect()
    assert [(row["age_hours"], row["verdict"]) for row in judged] == [(1, "pass"), (30, "warn"), (80, "block"), (None, "block")]


class Server:
    """Pages of made-up records by key, at most 3 each; every request is noted in a file."""

    def __init__(self, notes, records):
        self.notes, self.records = str(notes), records

    def __call__(self, params):
        import re
        import uuid

        with open(f"{self.notes}/{uuid.uuid4().hex}", "w") as file:
            json.dump(params, file)
        bounds = params.get("and", "")
        low, high, after = (
            re.search(p, bounds) for p in (r"\.gte\.([^,)]+)", r"\.lt\.([^,)]+)", r"\.eq\.([^,)]+),transaction_id\.gt\.([^,)]+)")
        )
        key = lambda r: (r["transaction_date"], r["transaction_id"])
        rows = [
            r
            for r in sorted(self.records, key=key)
            if (not low or r["transaction_date"] >= low[1])
            and (not high or r["transaction_date"] < high[1])
            and (not after or key(r) > (after[1], after[2]))
        ]
        return rows[: min(3, params["limit"])]


def noted(notes):
    return [json.loads((notes / name).read_text()) for name in os.listdir(notes)]


@pytest.fixture
def server(tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    days = [f"2024-03-{day:02d}T10:00:00Z" for day in range(1, 29)]
    records = [{**BASE, "transaction_id": f"TXN-{n}", "transaction_date": days[n % 28]} for n in range(70)]
    records += [{**BASE, "transaction_id": f"TXN-S{n}", "transaction_date": days[5]} for n in range(10)]  # one time, many pages
    return Server(notes, records), notes


def test_a_capping_server_is_read_whole(spark, server):
    fetch, _ = server
    for splits in ([], ["2024-03-10T00:00:00Z"], time_splits("2024-03-05T00:00:00Z", "2024-03-20T00:00:00Z", 4)):
        found = read_keyset(spark, fetch, splits=splits, page_size=50)
        ids = [json.loads(row["raw_payload"])["transaction_id"] for row in found.collect()]
        assert len(ids) == 80 and set(ids) == {r["transaction_id"] for r in fetch.records}


def test_a_filter_reaches_the_requests(spark, server):
    fetch, notes = server
    splits = ["2024-03-10T00:00:00Z", "2024-03-20T00:00:00Z"]
    rows = read_keyset(spark, fetch, splits=splits, page_size=50)
    recent = rows.filter(F.col("event_time") >= F.lit("2024-03-22 10:00:00").cast("timestamp_ntz"))
    assert recent.count() == sum(r["transaction_date"] >= "2024-03-22T10:00:00Z" for r in fetch.records)
    asked = noted(notes)
    assert asked and all("transaction_date.gte.2024-03-22T10:00:00Z" in params["and"] for params in asked)
    late = rows.filter(F.col("event_time") > F.lit("2024-03-28 10:00:00").cast("timestamp_ntz"))
    assert late.count() == 0


def test_a_server_that_ignores_keys_is_refused(spark):
    record = {**BASE, "transaction_id": "TXN-1"}
    with pytest.raises(Exception, match="doesn't page by key"):
        read_keyset(spark, lambda params: [record]).collect()


def events_at(spark, path, seconds):
    start = datetime(2024, 1, 1)
    rows = [(n, s if s is None else start + timedelta(seconds=s), n % 7, n / 4) for n, s in enumerate(seconds)]
    schema = "event_id long, ts timestamp_ntz, user_id long, value double"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/events.parquet")
    return feed.ordered_events(spark, str(path))


def test_a_page_by_key_costs_no_pass_over_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "KEYS_A_FILE", 50)
    pages = feed.CappedPages(events_at(spark, tmp_path, [n * 37 % 1000 for n in range(1000)]), 7)
    read, read_group = [], feed.pq.ParquetFile.read_row_group

    def noted(table, group, *args, **kwargs):
        rows = read_group(table, group, *args, **kwargs)
        read.append(rows.num_rows)
        return rows

    monkeypatch.setattr(feed.pq.ParquetFile, "read_row_group", noted)
    found, bounds = [], ""
    while records := pages({"limit": 100, "and": bounds}):
        assert len(records) == 7 or len(found) + len(records) == 1000
        found += [(r["transaction_date"], r["transaction_id"]) for r in records]
        day, key = found[-1]
        bounds = f"(or(transaction_date.gt.{day},and(transaction_date.eq.{day},transaction_id.gt.{key})))"
    assert found == sorted(found) and len(set(found)) == 1000
    assert sum(read) == 1000 and max(read) <= 50  # 143 pages


def test_pages_by_key_hold_every_dated_event(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "KEYS_A_FILE", 4)
    seconds = [*range(40), *[20] * 30, None, 86_400, 86_400, 40 * 86_400, None]  # one second, several files
    pages = feed.CappedPages(events_at(spark, tmp_path, seconds), 5)
    splits = ["2024-01-01T00:00:10Z", "2024-01-01T00:00:20Z", "2024-01-01T00:00:21Z", "2024-01-10T00:00:00Z"]
    dated = [n for n, s in enumerate(seconds) if s is not None]
    for cuts in ([], splits):
        rows = read_keyset(spark, pages, splits=cuts, page_size=9).collect()
        assert sorted(json.loads(row["raw_payload"])["id"] for row in rows) == dated
    late = read_keyset(spark, pages, splits=splits).filter("event_time >= timestamp_ntz'2024-01-01 00:00:20'")
    assert late.count() == sum(s is not None and s >= 20 for s in seconds)
    (tmp_path / "none").mkdir()
    assert feed.CappedPages(events_at(spark, tmp_path / "none", [None]), 5)({"limit": 9}) == []


def test_splits_are_within_the_span():
    assert time_splits("2024-03-01T00:00:00Z", "2024-03-03T00:00:00Z", 2) == ["2024-03-02T00:00:00Z"]
    assert time_splits("2024-03-01T00:00:00Z", "2024-03-01T00:00:00Z", 3) == ["2024-03-01T00:00:00Z"]


def test_each_run_leaves_an_audit_row(spark, write_csv, tmp_path, monkeypatch):
    settings = Settings(csv_path=write_csv({}, {"transaction_id": "TXN-2", "status": "odd"}), store_path=f"{tmp_path}/s", output_path=f"{tmp_path}/o", source="csv")
    monkeypatch.setattr(ingestion, "MOST_PARTS", 2)
    for n in range(4):
        run_ingestion(spark, settings, "incremental" if n else "full", export=False, batch_id=f"b{n}", ingestion_timestamp=f"2024-04-0{n + 1}T00:00:00Z")
    rows = read_log(TableStore(spark, settings.store_path), RUN_AUDIT).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["mode"], r["records_read"], r["records_inserted"]) for r in rows] == [
        ("b0", "full", 2, 1), ("b1", "incremental", 2, 0), ("b2", "incremental", 2, 0), ("b3", "incremental", 2, 0)
    ]
    assert {str(r["first_event"]) for r in rows} == {str(r["last_event"]) for r in rows} == {"2024-03-30 10:00:00"}


def test_a_replayed_epoch_is_skipped(spark, tmp_path):
    settings = Settings(csv_path="", store_path=f"{tmp_path}/s", output_path=f"{tmp_path}/o", source="csv")
    said = []
    ingest = ingest_micro_batch(spark, settings, said.append, "orders")
    store = TableStore(spark, settings.store_path)

    def lines(*changes):
        return spark.createDataFrame([(json.dumps({**BASE, **change}),) for change in changes], "value string")

    ingest(lines({}), 0)
    version = store.version()
    ingest(lines({}, {"transaction_id": "TXN-2"}), 0)
    assert store.version() == version and len(said) == 1
    ingest(lines({"transaction_id": "TXN-3"}), 1)
    ingest_micro_batch(spark, settings, said.append, "returns")(lines({"transaction_id": "TXN-4"}), 0)
    assert len(said) == 3 and store.read(BRONZE).count() == 3
