"""Gold transformation and whole runs."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.text import now_utc_text, to_utc_datetime
from ledgerflow.operators.gold import daily_summary, staging_view
from ledgerflow.operators.history import latest_per_key, snapshot_changes
from ledgerflow.operators.metrics import SUMMARY_SCHEMA, run_metrics, timed_step
from ledgerflow.operators.profile import account_count, profile_report
from ledgerflow.operators.profile_state import profile_from_state, profile_state
from ledgerflow.operators.quality import (
    QualityError,
    control_totals,
    gold_assertions,
    gold_model_checks,
    run_assertions,
    staging_checks,
)
from ledgerflow.operators.validate import invalid_by_kind, invalid_by_rule
from ledgerflow.plans.ingest import LOG_KEYS, export_bronze, ingest_into, settings_contract
from ledgerflow.plans.settings import Settings
from ledgerflow.plans.store import DELTA, Change, Dates, TableStore, run_number
from ledgerflow.schema import BRONZE, FIELDS, GOLD, PROFILE, QUARANTINE
from ledgerflow.session import write_json_report
from ledgerflow.sources.exports import export_table


def stale_dates(snapshot: dict[str, Dates], table: str) -> list[str]:
    """Dates whose bronze is newer than the table derived from it."""
    derived = snapshot[table]
    return [key for key, entry in snapshot[BRONZE].items() if run_number(derived.get(key)) < run_number(entry)]


def transform_into(
    change: Change, settings: Settings, *, updated_at: str | None = None, check_whole_table: bool = False
) -> dict[str, Any]:
    """Rebuild gold and the profile of stale dates in an open change, then run all quality checks on gold.

    Gold rows, keys and their reconciliation with bronze never cross a date, so the checks read
    the rebuilt dates; ``check_whole_table`` reads every date. A failed check raises before
    anything is published.
    """
    durations: dict[str, float] = {}
    dates = stale_dates(change.pending, GOLD)
    with timed_step(durations, "build"):
        if dates:
            gold = daily_summary(change.read(BRONZE, dates), updated_at or now_utc_text())
            change.stage(GOLD, gold.hint("rebalance", "transaction_date"), dates)
    with timed_step(durations, "profile"):
        unprofiled = stale_dates(change.pending, PROFILE)
        if unprofiled:
            change.stage(PROFILE, profile_state(change.read(BRONZE, unprofiled)), unprofiled)
    checked = None if check_whole_table else dates
    bronze, gold = change.read(BRONZE, checked), change.read(GOLD, checked)
    with timed_step(durations, "model_tests"):
        run_assertions(staging_checks(staging_view(bronze)).unionByName(gold_model_checks(gold)))
    with timed_step(durations, "assertions"):
        report = gold_assertions(gold, bronze).unionByName(control_totals(gold, bronze))
        result = run_assertions(report, f"{settings.output_path}/data_quality_assertions.json")
    return {
        "daily_summary_rows": change.rows_in(GOLD),
        "rebuilt_dates": len(dates),
        "assertions_passed": result["passed"],
        "dbt_tests_passed": True,
        "durations_seconds": durations,
    }


def run_transform(spark: SparkSession, settings: Settings, *, export: bool = True, **options: Any) -> dict[str, Any]:
    change = TableStore(spark, settings.store_path).begin()
    summary = transform_into(change, settings, **options)
    change.commit()
    if export:
        export_table(change.read(GOLD), GOLD, f"{settings.output_path}/daily_account_summary")
    return summary


def pipeline_metrics(spark: SparkSession, summary: dict[str, Any], now: str) -> dict[str, Any]:
    """Metrics of a whole run as a report."""
    full = summary["mode"] == "full"
    ingestion = summary["full_ingestion" if full else "incremental_ingestion"]
    transform = summary["final_transform" if full else "transform"]
    merged = {**ingestion, **transform, "mode": summary["mode"]}
    watermark = merged.get("watermark")
    merged["watermark"] = to_utc_datetime(watermark) if watermark else None
    names = spark.createDataFrame([], SUMMARY_SCHEMA).columns
    row = spark.createDataFrame([tuple(merged.get(name) for name in names)], SUMMARY_SCHEMA)
    metrics = run_metrics(row, now).first().asDict()
    return {**metrics, "durations_seconds": summary["durations_seconds"]}


def write_profile(spark: SparkSession, settings: Settings) -> dict[str, Any]:
    """The report, whose rules are named without values, and a folder of the counts by full message.

    It is made from the stored state of each date. Of bronze it reads the accounts, if they are to be
    counted exactly, and dates whose state is older than their rows.
    """
    store = TableStore(spark, settings.store_path)
    snapshot = store.snapshot()
    quarantine, gold = (store.read_from(snapshot, table, None) for table in (QUARANTINE, GOLD))
    stale = stale_dates(snapshot, PROFILE)
    state = store.read_from(snapshot, PROFILE, snapshot[PROFILE].keys() - set(stale))
    if stale:
        state = state.unionByName(profile_state(store.read_from(snapshot, BRONZE, stale)))
    accounts = account_count(store.read_from(snapshot, BRONZE, None)) if settings.exact_account_count else None
    quarantine = latest_per_key(quarantine, [LOG_KEYS[QUARANTINE]], DELTA)
    by_rule = invalid_by_rule(quarantine)  # with the values found, so as long as the data has them
    by_rule.write.mode("overwrite").json(f"{settings.output_path}/invalid_count_by_rule")
    report = profile_report(profile_from_state(state, quarantine, gold, accounts, invalid_by_kind))
    write_json_report(spark, report, f"{settings.output_path}/data_profile.json")
    return report


def run_pipeline(
    spark: SparkSession,
    settings: Settings,
    mode: str = "full",
    *,
    now: str | None = None,
    export: bool = True,
    **options: Any,
) -> dict[str, Any]:
    """One incremental pass, or a full pass followed by an incremental one that proves idempotency.

    Bronze, quarantine, gold and the watermark of a pass are published together, after its checks.
    """
    durations: dict[str, float] = {}
    summary: dict[str, Any] = {"mode": mode, "durations_seconds": durations}
    contract = settings_contract(spark, settings)
    store = TableStore(spark, settings.store_path)

    def one_pass(pass_mode: str, ingestion: str, transform: str, report: str) -> Change:
        change = store.begin()
        with timed_step(durations, ingestion):
            summary[ingestion] = ingest_into(change, settings, pass_mode, contract=contract, **options)
        with timed_step(durations, transform):
            summary[transform] = transform_into(change, settings, updated_at=now)
        change.commit()
        write_json_report(spark, summary[ingestion]["watermark_state"], f"{settings.output_path}/{report}")
        return change

    if mode == "full":
        one_pass("full", "full_ingestion", "initial_transform", "watermark_run1.json")
        change = one_pass("incremental", "incremental_simulation", "final_transform", "watermark_run2.json")
    else:
        change = one_pass("incremental", "incremental_ingestion", "transform", "watermark_run2.json")
    if export:
        with timed_step(durations, "exports"):
            export_bronze(change, settings)
            export_table(change.read(GOLD), GOLD, f"{settings.output_path}/daily_account_summary")
    write_json_report(spark, summary, f"{settings.output_path}/run_summary.json")
    metrics = pipeline_metrics(spark, summary, now or now_utc_text())
    write_json_report(spark, metrics, f"{settings.output_path}/metrics.json")
    write_profile(spark, settings)
    return summary


def silver_changes(store: TableStore, before: int, after: int) -> DataFrame:
    """Clean rows (valid, canonical) that were inserted, changed or removed between two published versions.

    Only dates that a run rewrote in between are read, on both sides: a row that moves to another date
    touches both.
    """
    old, new = store.snapshot(before), store.snapshot(after)
    dates = {key for key in {*old[BRONZE], *new[BRONZE]} if old[BRONZE].get(key) != new[BRONZE].get(key)}
    versions = [store.read_from(snapshot, BRONZE, dates) for snapshot in (old, new)]
    clean = [rows.filter(~F.col("is_duplicate")).select(*FIELDS) for rows in versions]
    return snapshot_changes(*clean, "transaction_id")


def prove_incremental(
    spark: SparkSession,
    settings: Settings,
    new_ids: list[str] | DataFrame,
    summary: dict[str, Any],
    expected_watermark: str,
) -> dict[str, Any]:
    """Check that a run inserted exactly the given new ids and reached the given watermark.

    A short list of ids is repeated in the proof. A table of them, in ``transaction_id``, only counts.
    """
    listed = {"new_transaction_ids": new_ids} if isinstance(new_ids, list) else {}
    if isinstance(new_ids, list):
        new_ids = spark.createDataFrame([(key,) for key in new_ids], "transaction_id string")
    new_ids = new_ids.select("transaction_id").distinct()
    bronze = TableStore(spark, settings.store_path).read(BRONZE)
    persisted = bronze.join(new_ids, "transaction_id", "left_semi").count()
    expected = new_ids.count()
    proof = {
        **listed,
        "expected_inserted_valid_records": expected,
        "actual_inserted_valid_records": summary["inserted_valid_records"],
        "persisted_new_records": persisted,
        "expected_watermark": expected_watermark,
        "actual_watermark": summary["watermark"],
    }
    proof["passed"] = (
        summary["inserted_valid_records"] == persisted == expected
        and summary["watermark"] == expected_watermark
    )
    if not proof["passed"]:
        raise QualityError(f"incremental run differs from expectation: {proof}")
    return proof
