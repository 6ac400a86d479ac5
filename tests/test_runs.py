"""Stored tables: ingestion, corrections, failures, whole runs, streaming."""

import json
import os

import pytest

from ledgerflow.operators.quality import QualityError
from ledgerflow.plans import run as runs
from ledgerflow.plans.ingest import LOG_KEYS, read_log, run_ingestion
from ledgerflow.plans.run import prove_incremental, run_pipeline, run_transform
from ledgerflow.plans.settings import Settings
from ledgerflow.plans.store import CommitConflict, TableStore
from ledgerflow.schema import BRONZE, CONTROL, GOLD, QUARANTINE
from ledgerflow.sources.landing import append_records
from ledgerflow.streaming.micro_batch import stream_json_files
from tests.conftest import BASE


@pytest.fixture
def job(tmp_path, contract_file):
    """Settings over one store; each call may name another CSV."""

    def make(csv_path="", **changes):
        paths = {"store_path": str(tmp_path / "store"), "output_path": str(tmp_path / "out")}
        return Settings(csv_path=csv_path, contract_path=contract_file, source="csv", **paths, **changes)

    return make


def stored(spark, settings, table=BRONZE):
    store = TableStore(spark, settings.store_path)
    return read_log(store, table) if table in LOG_KEYS else store.read(table)


def bronze_rows(spark, settings):
    rows = stored(spark, settings).orderBy("transaction_id").collect()
    return [(r["transaction_id"], str(r["transaction_date"])[:10], r["duplicate_rank"]) for r in rows]


def report(settings, name):
    with open(os.path.join(settings.output_path, name), encoding="utf-8") as file:
        return json.load(file)


def ingest(spark, settings, mode="full", **options):
    return run_ingestion(spark, settings, mode, export=False, **options)


FIRST = (
    {"transaction_id": "TXN-1"},
    {"transaction_id": "TXN-2"},
    {"transaction_id": "TXN-3", "transaction_date": "2024-03-29T08:00:00Z"},
    {"transaction_id": "TXN-4", "status": "odd"},
    {"transaction_id": "TXN-5", "transaction_date": "unknown"},
)


def test_first_load(spark, job, write_csv):
    settings = job(write_csv(*FIRST))
    summary = ingest(spark, settings, watermark_output=settings.output_path + "/watermark.json")
    counts = ("records_read", "valid_records", "inserted_valid_records", "quarantined_records", "duplicate_records")
    assert [summary[name] for name in counts] == [5, 3, 3, 2, 1]
    assert summary["canonical_valid_records"] == 2 and summary["watermark"] == "2024-03-30T10:00:00Z"
    assert bronze_rows(spark, settings) == [("TXN-1", "2024-03-30", 1), ("TXN-2", "2024-03-30", 2), ("TXN-3", "2024-03-29", 1)]
    assert report(settings, "watermark.json")["last_successful_watermark"] == "2024-03-30T10:00:00Z"
    assert report(settings, "run_summary.json")["resolved_source"] == "csv"
    quarantined = {row["transaction_id"]: row for row in stored(spark, settings, QUARANTINE).collect()}
    assert set(quarantined) == {"TXN-4", "TXN-5"}
    assert quarantined["TXN-5"]["event_date"] is None
    assert json.loads(quarantined["TXN-4"]["raw_payload"])["status"] == "odd"


def test_replay_changes_nothing(spark, job, write_csv):
    settings = job(write_csv(*FIRST))
    ingest(spark, settings)
    before = bronze_rows(spark, settings)
    for mode in ("full", "incremental", "incremental"):
        summary = ingest(spark, settings, mode)
        assert summary["inserted_valid_records"] == 0
        assert summary["watermark"] == "2024-03-30T10:00:00Z"
    assert summary["effective_lower_bound"] == "2024-03-28T10:00:00Z"
    assert bronze_rows(spark, settings) == before
    assert stored(spark, settings, QUARANTINE).count() == 2
    assert stored(spark, settings, CONTROL).count() == 1


def test_incremental_reads_the_lookback_and_only_it(spark, job, write_csv):
    settings = job(write_csv(*FIRST))
    ingest(spark, settings)
    late = (
        {"transaction_id": "TXN-6", "transaction_date": "2024-03-28T10:00:00Z"},
        {"transaction_id": "TXN-7", "transaction_date": "2024-03-28T09:59:59Z"},
        {"transaction_id": "TXN-8", "transaction_date": "2024-04-02T00:00:00+00:00"},
    )
    summary = ingest(spark, job(write_csv(*FIRST, *late)), "incremental")
    assert summary["inserted_valid_records"] == 2 and summary["records_read"] == 7
    assert [row[0] for row in bronze_rows(spark, settings)] == ["TXN-1", "TXN-2", "TXN-3", "TXN-6", "TXN-8"]
    assert summary["watermark"] == "2024-04-02T00:00:00Z"


def test_a_correction_moves_a_row_to_another_date(spark, job, write_csv):
    settings = job(write_csv(*FIRST))
    run_pipeline(spark, settings, "full", now="2024-04-01T00:00:00Z", export=False)
    # The only row of the 29th moves to the 30th; the canonical copy of the 30th changes too.
    fixed = ({"transaction_id": "TXN-3"}, {"transaction_id": "TXN-1", "amount": "99.00"})
    ingest(spark, job(write_csv(*fixed)), "full")
    assert bronze_rows(spark, settings) == [("TXN-1", "2024-03-30", 1), ("TXN-2", "2024-03-30", 1), ("TXN-3", "2024-03-30", 2)]
    run_transform(spark, settings, export=False)
    gold = stored(spark, settings, GOLD).collect()
    assert [(str(r["transaction_date"]), str(r["total_debit_amount"])) for r in gold] == [("2024-03-30", "111.34")]
    assert len(bronze_rows(spark, settings)) == 3


def test_ids_repeated_in_a_batch_are_resolved_and_reported(spark, job, write_csv):
    repeated = ({"transaction_id": "TXN-1"}, {"transaction_id": "TXN-1", "transaction_date": "2024-03-31T00:00:00Z"})
    settings = job(write_csv(*repeated))
    summary = ingest(spark, settings)
    assert (summary["batch_id_collisions"], summary["valid_records"], summary["inserted_valid_records"]) == (1, 2, 1)
    assert bronze_rows(spark, settings) == [("TXN-1", "2024-03-31", 1)]


def test_hot_groups_in_the_store(spark, job, write_csv):
    copies = [{"transaction_id": f"TXN-{n:04d}"} for n in range(400)]
    others = [{"transaction_id": f"TXN-B{n:04d}", "amount": f"{n + 1}.00"} for n in range(200)]
    settings = job(write_csv(*copies, *others))
    summary = ingest(spark, settings, hot_rows=50)
    assert summary["duplicate_records"] == 399
    ranks = {row[0]: row[2] for row in bronze_rows(spark, settings)}
    assert all(ranks[f"TXN-{n:04d}"] == n + 1 for n in range(400))


def test_empty_batch(spark, job, write_csv):
    settings = job(write_csv())
    summary = run_pipeline(spark, settings, "incremental", export=False)
    assert summary["incremental_ingestion"]["records_read"] == 0
    assert summary["incremental_ingestion"]["watermark"] is None
    assert summary["transform"]["daily_summary_rows"] == 0
    assert stored(spark, settings).count() == 0


def test_whole_run_with_reports_and_exports(spark, job, write_csv):
    settings = job(write_csv(*FIRST))
    summary = run_pipeline(spark, settings, "full", now="2024-04-01T10:00:00Z")
    assert summary["full_ingestion"]["inserted_valid_records"] == 3
    assert summary["incremental_simulation"]["inserted_valid_records"] == 0
    assert summary["final_transform"]["daily_summary_rows"] == 2
    metrics = report(settings, "metrics.json")
    assert (metrics["quarantine_rate"], metrics["duplicate_rate"], metrics["watermark_age_hours"]) == (0.4, 0.3333, 48.0)
    assert metrics["warnings"] == [] and metrics["assertions_passed"] and metrics["dbt_tests_passed"]
    assert report(settings, "data_profile.json")["row_counts"]["quarantined_records"] == 2
    assert report(settings, "data_quality_assertions.json")["passed"] is True
    for name in ("watermark_run1.json", "watermark_run2.json"):
        assert report(settings, name)["last_run_status"] == "success"
    exports = {
        "valid_transactions": ("transaction_id", 3),
        "quarantine_records": ("quarantine_id", 2),
        "duplicate_records": ("transaction_id", 1),
        "daily_account_summary": ("account_id", 2),
    }
    for name, (first_column, count) in exports.items():
        rows = spark.read.options(header=True, escape='"').csv(f"{settings.output_path}/{name}")
        assert (rows.columns[0], rows.count()) == (first_column, count)
    exported = spark.read.options(header=True).csv(f"{settings.output_path}/valid_transactions")
    assert exported.orderBy("transaction_id").first()["transaction_date"] == "2024-03-30 10:00:00"


def test_new_rows_are_proven(spark, job, write_csv, make_raw):
    settings = job(write_csv(*FIRST))
    ingest(spark, settings)
    april = [
        {"transaction_id": f"TXN-N{day}", "transaction_date": f"2024-04-0{day}T15:45:00Z", "amount": f"{day}.50"}
        for day in (1, 2, 3)
    ]
    landing = settings.output_path + "/landing"
    append_records(make_raw(*april), landing)
    summary = ingest(spark, job(landing), "incremental")
    ids = ["TXN-N1", "TXN-N2", "TXN-N3"]
    assert prove_incremental(spark, settings, ids, summary, "2024-04-03T15:45:00Z")["passed"]
    with pytest.raises(QualityError):
        prove_incremental(spark, settings, ids, summary, "2024-04-04T00:00:00Z")


def test_a_failed_check_publishes_nothing(spark, job, write_csv, monkeypatch):
    settings = job(write_csv(*FIRST))
    run_pipeline(spark, settings, "full", export=False)
    store = TableStore(spark, settings.store_path)
    version, before = store.version(), bronze_rows(spark, settings)

    real = runs.daily_summary
    monkeypatch.setattr(runs, "daily_summary", lambda rows, at: real(rows.filter("transaction_id <> 'TXN-9'"), at))
    new = {"transaction_id": "TXN-9", "transaction_date": "2024-04-05T00:00:00Z"}
    with pytest.raises(QualityError, match="gold_matches_completed_non_duplicate_bronze"):
        run_pipeline(spark, job(write_csv(*FIRST, new)), "incremental", export=False)
    assert store.version() == version
    assert bronze_rows(spark, settings) == before
    assert report(settings, "data_quality_assertions.json")["passed"] is False

    monkeypatch.undo()
    summary = run_pipeline(spark, job(write_csv(*FIRST, new)), "incremental", export=False)
    assert summary["incremental_ingestion"]["previous_watermark"] == "2024-03-30T10:00:00Z"
    assert summary["incremental_ingestion"]["inserted_valid_records"] == 1
    dropped = store.drop_unreferenced_runs()
    assert dropped
    assert len(bronze_rows(spark, settings)) == 4 and stored(spark, settings, GOLD).count() == 3


def test_only_touched_dates_are_rewritten(spark, job, write_csv):
    settings = job(write_csv(*FIRST))
    run_pipeline(spark, settings, "full", export=False)
    store = TableStore(spark, settings.store_path)
    before = store.snapshot()
    new = {"transaction_id": "TXN-9", "transaction_date": "2024-04-05T00:00:00Z"}
    summary = run_pipeline(spark, job(write_csv(new)), "incremental", export=False)
    after = store.snapshot()
    assert summary["transform"]["rebuilt_dates"] == 1
    for table in (BRONZE, GOLD):
        assert {key for key in after[table] if after[table][key] != before[table].get(key)} == {"2024-04-05"}


def test_two_writers_cannot_both_publish(spark, job, write_csv):
    settings = job(write_csv(*FIRST))
    store = TableStore(spark, settings.store_path)
    first, second = store.begin(), store.begin()
    first.commit()
    with pytest.raises(CommitConflict):
        second.commit()


def test_unknown_mode(spark, job, write_csv):
    with pytest.raises(ValueError):
        ingest(spark, job(write_csv()), "partial")


def test_stream_of_files(spark, job, tmp_path):
    inbox, settings = tmp_path / "inbox", job()
    inbox.mkdir()

    def drop(name, *changes):
        (inbox / name).write_text("".join(json.dumps({**BASE, **change}) + "\n" for change in changes))

    def run():
        summaries = []
        query = stream_json_files(spark, str(inbox), settings, str(tmp_path / "checkpoint"), summaries.append)
        query.awaitTermination()
        assert query.exception() is None
        return summaries

    drop("1.json", {"transaction_id": "TXN-1"}, {"transaction_id": "TXN-2", "amount": 3.5})
    assert [s["inserted_valid_records"] for s in run()] == [2]
    drop("2.json", {"transaction_id": "TXN-1"}, {"transaction_id": "TXN-3", "amount": 4, "transaction_date": "2023-01-01T00:00:00Z"})
    assert [s["inserted_valid_records"] for s in run()] == [1]
    assert run() == []
    assert [row[0] for row in bronze_rows(spark, settings)] == ["TXN-1", "TXN-2", "TXN-3"]
    assert stored(spark, settings, GOLD).count() == 2
