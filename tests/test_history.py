"""Appended state: the quarantine log, the index of ids, group history, snapshot differences, dated landing."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import history
from ledgerflow.operators.history import latest_per_key
from ledgerflow.operators.profile import build_profile, profile_report
from ledgerflow.operators.validate import invalid_by_kind
from ledgerflow.plans import ingest as ingestion
from ledgerflow.plans.ingest import LOG_KEYS, read_log, run_ingestion, stored_dates
from ledgerflow.plans.run import run_pipeline, silver_changes, write_profile
from ledgerflow.plans.settings import Settings
from ledgerflow.plans.store import DELTA, NULL_DATE, TableStore
from ledgerflow.schema import BRONZE, GOLD, GROUP_HISTORY, ID_DATES, PROFILE, QUARANTINE
from ledgerflow.sources.dated_landing import land_by_date, landed_folders, read_landed


@pytest.fixture
def job(tmp_path):
    def make(csv_path="", **changes):
        return Settings(csv_path=csv_path, store_path=f"{tmp_path}/store", output_path=f"{tmp_path}/out", source="csv", **changes)

    return make


def ingest(spark, settings, mode="full", **options):
    return run_ingestion(spark, settings, mode, export=False, **options)


def files_of(settings, table):
    found = {}
    for folder, _, names in os.walk(f"{settings.store_path}/{table}"):
        found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names})
    return found


def spoil(settings, table, part):
    """Overwrite the data files of a table's folder, so that reading one fails."""
    spoiled = 0
    for path in files_of(settings, table):
        if part in path and path.endswith(".parquet"):
            with open(path, "wb") as file:
                file.write(b"not parquet")
            os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
            spoiled += 1
    assert spoiled


DAYS = tuple({"transaction_id": f"TXN-{day}", "transaction_date": f"2024-03-{day}T08:00:00Z"} for day in range(10, 20))
BAD = ({"transaction_id": "TXN-B1", "status": "odd"}, {"transaction_id": "TXN-B2", "transaction_date": "unknown"})


def test_newest_row_of_a_log(spark):
    log = spark.createDataFrame([("a", 1, "1"), ("a", None, "2"), ("b", 3, "1")], "k string, v int, delta string")
    assert sorted(map(tuple, history.latest_per_key(log, ["k"], "delta").collect())) == [("a", None), ("b", 3)]


def test_quarantine_is_only_appended_to(spark, job, write_csv, monkeypatch):
    settings = job(write_csv(*DAYS, *BAD))
    ingest(spark, settings, batch_id="one")
    before = files_of(settings, QUARANTINE)
    ingest(spark, settings, "incremental", batch_id="two")
    after = files_of(settings, QUARANTINE)
    assert before.items() < after.items()  # the unreadable date, read again in every run, included
    store = TableStore(spark, settings.store_path)
    assert store.read(QUARANTINE).count() == 4  # both came again
    newest = {row["transaction_id"]: row["batch_id"] for row in read_log(store, QUARANTINE).collect()}
    assert newest == {"TXN-B1": "two", "TXN-B2": "two"}

    monkeypatch.setattr(ingestion, "MOST_PARTS", 2)
    ingest(spark, settings, "full", batch_id="three")
    assert [e for e in store.snapshot()[QUARANTINE].values() if e["rows"]][0]["rows"] == 2
    assert {row["batch_id"] for row in store.read(QUARANTINE).collect()} == {"three"}
    assert store.drop_unreferenced_runs() and read_log(store, QUARANTINE).count() == 2


@pytest.mark.parametrize("listed", [0, 1000])
def test_an_increment_reads_no_untouched_bronze(spark, job, write_csv, monkeypatch, listed):
    monkeypatch.setattr(ingestion, "LISTED_IDS", listed)
    settings = job(write_csv(*DAYS))
    ingest(spark, settings)
    for day in range(10, 17):
        spoil(settings, BRONZE, f"event_date=2024-03-{day}")
    moved = {"transaction_id": "TXN-17", "transaction_date": "2024-03-19T09:00:00Z"}
    new = {"transaction_id": "TXN-N", "transaction_date": "2024-03-20T09:00:00Z"}
    summary = ingest(spark, job(write_csv(moved, new)), "incremental")
    assert (summary["inserted_valid_records"], summary["valid_records"]) == (1, 2)
    store = TableStore(spark, settings.store_path)
    snapshot = store.snapshot()[BRONZE]
    assert (snapshot["2024-03-17"]["rows"], snapshot["2024-03-19"]["rows"], snapshot["2024-03-20"]["rows"]) == (0, 2, 1)
    dates = {row["transaction_id"]: str(row["event_date"]) for row in read_log(store, ID_DATES).collect()}
    assert len(dates) == 11 and dates["TXN-17"] == "2024-03-19" and dates["TXN-10"] == "2024-03-10"
    assert sum(entry["rows"] for entry in store.snapshot()[ID_DATES].values()) == 12  # only new and moved ids were added


def test_index_files_have_bloom_filters_and_known_ids_add_nothing(spark, job, write_csv):
    settings = job(write_csv(*DAYS))
    ingest(spark, settings)
    before = files_of(settings, ID_DATES)
    ingest(spark, settings)
    assert TableStore(spark, settings.store_path).begin().rows_in(ID_DATES) == len(DAYS)
    import pyarrow.parquet as pq

    (path,) = [p for p in before if p.endswith(".parquet") and pq.ParquetFile(p).metadata.num_rows]
    with open(path, "rb") as file:
        size = len(file.read())
    assert size > 1024 * 1024 // 4  # a Bloom filter of the default size is most of so small a file


def test_a_store_without_an_index_gets_one(spark, job, write_csv):
    settings = job(write_csv(*DAYS))
    ingest(spark, settings)
    change = TableStore(spark, settings.store_path).begin()
    change.pending[ID_DATES] = {}
    batch = change.read(BRONZE, ["2024-03-10"])
    assert [str(row["event_date"]) for row in stored_dates(change, batch, 1).collect()] == ["2024-03-10"]
    assert change.rows_in(ID_DATES) == len(DAYS)


def test_repeated_ids_take_the_latest_event(spark):
    rows = [("a", 1, "x", 10), ("a", 2, "y", 11), ("b", 1, "x", 10)]
    batch = spark.createDataFrame(rows, "transaction_id string, transaction_date int, natural_key_hash string, event_date int")
    stored = spark.createDataFrame([("a", 10)], "transaction_id string, event_date int")
    matched = history.match_ids(batch, stored)
    assert sorted(map(tuple, matched.collect()), key=str) == [("a", 2, 11, 10), ("b", 1, 10, None)]
    assert [tuple(row) for row in history.moved_ids(matched).collect()] == [("a", 10, 11)]


def test_first_and_last_sight_of_a_group(spark, job, write_csv):
    copies = ({"transaction_id": "TXN-1"}, {"transaction_id": "TXN-2"})
    settings = job(write_csv(*copies))
    third = job(write_csv(*copies, {"transaction_id": "TXN-3"}, name="more.csv"))
    ingest(spark, settings, ingestion_timestamp="2024-04-01T00:00:00Z")
    ingest(spark, third, ingestion_timestamp="2024-04-02T00:00:00Z")
    other = {"transaction_id": "TXN-9", "amount": "7.00"}
    ingest(spark, job(write_csv(other, name="other.csv")), ingestion_timestamp="2024-04-03T00:00:00Z")
    (row,) = TableStore(spark, settings.store_path).read(GROUP_HISTORY).collect()
    assert (row["group_rows"], str(row["first_seen"]), str(row["last_seen"])) == (3, "2024-04-01 00:00:00", "2024-04-02 00:00:00")


def test_differences_of_two_versions(spark):
    before = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", 3, "y")], "k string, v int, w string")
    after = spark.createDataFrame([("a", 1, None), ("b", 2, None), ("d", 3, "y")], "k string, v int, w string")
    found = sorted(map(tuple, history.snapshot_changes(before, after, "k").collect()))
    assert found == [("changed", "b", 2, None), ("inserted", "d", 3, "y"), ("removed", "c", 3, "y")]
    assert history.snapshot_changes(after, after, "k").count() == 0


def test_silver_changes_of_a_correction(spark, job, write_csv):
    copies = ({"transaction_id": "TXN-1"}, {"transaction_id": "TXN-2"}, {"transaction_id": "TXN-3", "amount": "5.00"})
    settings = job(write_csv(*copies, *DAYS))
    ingest(spark, settings)
    # TXN-1 moves away, so its copy becomes canonical; TXN-3 becomes a copy of TXN-2.
    fixed = ({"transaction_id": "TXN-1", "transaction_date": "2024-03-31T00:00:00Z"}, {"transaction_id": "TXN-3"})
    ingest(spark, job(write_csv(*fixed)))
    store = TableStore(spark, settings.store_path)
    found = {(r["transaction_id"], r["change"]) for r in silver_changes(store, 1, 2).collect()}
    assert found == {("TXN-1", "changed"), ("TXN-2", "inserted"), ("TXN-3", "removed")}
    assert silver_changes(store, 2, 2).count() == 0
    for day in range(10, 20):
        spoil(settings, BRONZE, f"event_date=2024-03-{day}")
    assert silver_changes(store, 1, 2).count() == 3  # dates without a change aren't read


def test_dated_landing_opens_only_the_dates_it_needs(spark, make_raw, tmp_path):
    path = str(tmp_path / "landing")
    assert land_by_date(make_raw(*DAYS, *BAD), path, "one")[-1] == f"event_date={NULL_DATE}"
    land_by_date(make_raw({"transaction_id": "TXN-X", "transaction_date": "2024-03-19T23:00:00Z"}), path, "two")
    assert read_landed(spark, path).count() == 13
    for folder in landed_folders(spark, path, None):
        if "=2024-03-1" in folder and folder[-2:] < "18":
            for name in os.listdir(f"{folder}/batch=one"):
                os.remove(f"{folder}/batch=one/{name}")  # crc files too
            with open(f"{folder}/batch=one/part-0.parquet", "wb") as file:
                file.write(b"not parquet")
    rows = read_landed(spark, path, "2024-03-18T09:00:00Z")
    assert sorted(row["transaction_id"] for row in rows.collect()) == ["TXN-19", "TXN-B1", "TXN-B2", "TXN-X"]
    assert not [file for file in rows.inputFiles() if "event_date=2024-03-17" in file]

    land_by_date(make_raw({"transaction_id": "TXN-Y", "transaction_date": "2024-03-18T23:00:00Z"}), path, "two")
    again = read_landed(spark, path, "2024-03-18T09:00:00Z")
    assert sorted(row["transaction_id"] for row in again.collect()) == ["TXN-19", "TXN-B1", "TXN-B2", "TXN-Y"]
    with pytest.raises(ValueError):
        land_by_date(make_raw(*BAD), path, "../up")
    assert read_landed(spark, str(tmp_path / "none")).count() == 0


def test_a_batch_of_one_day_is_written_in_bounded_shares(spark, make_raw, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerflow.sources.dated_landing.MOST_SHUFFLED", 20)
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    path = str(tmp_path / "landing")
    rows = [{"transaction_id": f"TXN-{n}", "transaction_date": "2024-03-18T23:00:00Z"} for n in range(4000)]
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        land_by_date(make_raw(*rows).coalesce(1), path, "one")
    finally:
        for name in sizes:
            spark.conf.unset(name)
    landed = read_landed(spark, path)
    assert landed.select("transaction_id").distinct().count() == landed.count() == 4000
    shares = [r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()]
    assert len(shares) >= 8 and max(shares) <= 1000


def test_runs_read_a_dated_landing(spark, job, make_raw, tmp_path):
    path = str(tmp_path / "landing")
    land_by_date(make_raw(*DAYS, *BAD), path, "one")
    settings = job(landing_path=path)
    first = ingest(spark, settings)
    assert (first["records_read"], first["valid_records"], first["quarantined_records"]) == (12, 10, 2)
    land_by_date(make_raw({"transaction_id": "TXN-Z", "transaction_date": "2024-03-30T12:00:00Z"}), path, "two")
    second = ingest(spark, settings, "incremental")
    assert second["inserted_valid_records"] == 1 and second["watermark"] == "2024-03-30T12:00:00Z"
    assert second["records_read"] == 1 + 3 + 2  # from the lookback on, the unreadable date, and the odd status


def test_profile_is_kept_with_the_store(spark, job, write_csv):
    settings = job(write_csv(*DAYS, *BAD, {"transaction_id": "TXN-C", "transaction_date": "2024-03-19T08:00:00Z"}))
    run_pipeline(spark, settings, "incremental", export=False)
    moved = {"transaction_id": "TXN-17", "transaction_date": "2024-03-20T09:00:00Z", "account_id": "ACC-0002"}
    settings = job(write_csv(moved))
    run_pipeline(spark, settings, "incremental", export=False)
    store = TableStore(spark, settings.store_path)
    snapshot = store.snapshot()
    runs = {key: int(entry["run"].split("-")[0]) for key, entry in snapshot[PROFILE].items()}
    assert {key for key, run in runs.items() if run == 2} == {"2024-03-17", "2024-03-20"}  # the others stay as they were
    quarantine = latest_per_key(store.read(QUARANTINE), [LOG_KEYS[QUARANTINE]], DELTA)
    expected = profile_report(build_profile(store.read(BRONZE), quarantine, store.read(GOLD), invalid_by_kind))
    assert write_profile(spark, settings) == expected
    assert expected["row_counts"]["valid_records"] == 11 and expected["account_count"] == 2

    old = {**snapshot, PROFILE: {key: entry for key, entry in snapshot[PROFILE].items() if key > "2024-03-15"}}
    store.commit(3, old)  # a store whose older dates have no state yet
    assert write_profile(spark, settings) == expected

    store.commit(4, snapshot)
    spoil(settings, BRONZE, "event_date=")
    assert write_profile(spark, replace(settings, exact_account_count=False)) == expected  # without a look at bronze
