"""Ingestion: load, validate, quarantine, merge into bronze, move the watermark."""

from __future__ import annotations

import math
import uuid
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.text import now_utc_text, to_utc_datetime, utc_date
from ledgerflow.operators.contract import Contract, load_contract
from ledgerflow.operators.duplicates import (
    HOT_GROUP_ROWS,
    duplicate_rows,
    find_hot_groups,
    natural_key_hash,
    rank_duplicates,
)
from ledgerflow.operators.history import groups_seen, latest_per_key, match_ids, merge_groups_seen
from ledgerflow.operators.merge import resolve_id_collisions, upsert_by_key
from ledgerflow.operators.metrics import timed_step
from ledgerflow.operators.validate import quarantine_rows, validate, with_audit_columns
from ledgerflow.operators.watermark import (
    PIPELINE_NAME,
    advance_watermark,
    control_row,
    control_state,
    stored_bounds,
)
from ledgerflow.plans.settings import Settings
from ledgerflow.plans.store import DELTA, TABLES, Change, TableStore, date_key
from ledgerflow.schema import (
    AUDIT_SCHEMA,
    BRONZE,
    BUSINESS_SCHEMA,
    CONTROL,
    DUPLICATES,
    GROUP_HISTORY,
    ID_DATES,
    QUARANTINE,
    RUN_AUDIT,
    RUN_AUDIT_SCHEMA,
    default_contract,
)
from ledgerflow.session import delete_path, scratch_path, write_json_report
from ledgerflow.sources.exports import export_table
from ledgerflow.sources.paged import FetchPage
from ledgerflow.sources.select import LoadedTransactions, land, load_transactions

ROWS_PER_FILE = 2_000_000
MODES = ("full", "incremental")
# Columns of a batch before it is ranked.
BATCH_COLUMNS = [*BUSINESS_SCHEMA.names, *AUDIT_SCHEMA.names, "natural_key_hash", "event_date"]
# What is appended to: its key. A log of more appended parts is rewritten as one.
LOG_KEYS = {QUARANTINE: "quarantine_id", ID_DATES: "transaction_id", RUN_AUDIT: "batch_id"}
MOST_PARTS = 16
# A batch of so few ids names them to the scan, which then skips row groups by their Bloom filters.
LISTED_IDS = 1000
BLOOM_FILTER = {"parquet.bloom.filter.enabled#transaction_id": "true"}


def stage_validated(raw: DataFrame, contract: Contract | None, path: str) -> tuple[DataFrame, dict[str, Any]]:
    """Validate once and write the outcome; valid and invalid rows land in separate folders.

    Counts and times are observed in the tasks that write, so the files aren't read for them. Those tasks
    are the last ones of their job, of which Spark counts one success each, however often one is tried.
    """
    validated = validate(raw, contract)
    is_valid = F.col("is_valid")
    rows = validated.withColumns(
        {
            "natural_key_hash": F.when(is_valid, natural_key_hash()),
            "event_date": utc_date(F.col("transaction_date")),
        }
    )
    seen = Observation()
    event_time = F.when(is_valid, F.col("transaction_date"))
    watched = rows.observe(
        seen,
        F.count_if(is_valid).alias("valid"),
        F.count_if(~is_valid).alias("invalid"),
        F.min(event_time).alias("first_event"),
        F.max(event_time).alias("last_event"),
    )
    watched.write.partitionBy("is_valid").parquet(path)
    return raw.sparkSession.read.schema(rows.schema).parquet(path), seen.get


def read_log(tables: Change | TableStore, table: str) -> DataFrame:
    """The newest row of each key of an appended table."""
    return latest_per_key(tables.read(table), [LOG_KEYS[table]], DELTA)


def append_to_log(change: Change, table: str, rows: DataFrame, options: dict[str, str] | None = None) -> None:
    """Add a run's rows to a log. No written file is touched until the log is rewritten as a whole."""
    parts = [key for key, entry in change.pending[table].items() if entry["rows"]]
    names = [name for name in TABLES[table].schema.names if name != DELTA]
    own = F.lit(f"{change.number:09d}").alias(DELTA)
    rewritten: list[str] = []
    rows = rows.select(*names, own)
    if len(parts) >= MOST_PARTS:
        rows = latest_per_key(change.read(table).unionByName(rows), [LOG_KEYS[table]], DELTA).select(*names, own)
        rewritten = parts
    change.stage(table, rows.sortWithinPartitions(LOG_KEYS[table]), rewritten, options=options)


def stored_dates(change: Change, batch: DataFrame, batch_rows: int) -> DataFrame:
    """transaction_id and event_date of stored ids, from the index alone: no bronze is read.

    A store written before there was an index gets one from bronze first.
    """
    if change.rows_in(BRONZE) and not change.rows_in(ID_DATES):
        known = change.read(BRONZE).select("transaction_id", "event_date", F.lit("0").alias(DELTA))
        change.stage(ID_DATES, known.sortWithinPartitions("transaction_id"), options=BLOOM_FILTER)
    log = change.read(ID_DATES)
    if batch_rows <= LISTED_IDS:
        listed = [row[0] for row in batch.select("transaction_id").distinct().collect()]
        log = log.filter(F.col("transaction_id").isin(listed))
    return latest_per_key(log, ["transaction_id"], DELTA)


def merge_bronze(change: Change, batch: DataFrame, matched: DataFrame, pairs: list, hot_rows: int = HOT_GROUP_ROWS) -> None:
    """Upsert a batch with unique ids into bronze, re-rank the dates it touches, and index its ids.

    A natural key holds the timestamp, so its group never spans two dates: only touched dates are
    read, ranked and written. Ids stored under another date (a corrected date) touch that date too;
    ``matched`` (see :func:`match_ids`) and its counts by dates, ``pairs``, name them.
    """
    if not pairs:
        return
    rows_by_date: dict = {}
    for row in pairs:
        rows_by_date[row["event_date"]] = rows_by_date.get(row["event_date"], 0) + row["ids"]
    left = {row["stored_date"] for row in pairs if row["stored_date"] not in (None, row["event_date"])}
    touched = {date_key(day) for day in (*rows_by_date, *left)}
    existing = change.read(BRONZE, touched).select(*BATCH_COLUMNS)
    merged = upsert_by_key(existing, batch.select(*BATCH_COLUMNS), ["transaction_id"])

    stored_rows = {key: entry["rows"] for key, entry in change.pending[BRONZE].items()}
    rows_of = {day: rows_by_date.get(day, 0) + stored_rows.get(date_key(day), 0) for day in {*rows_by_date, *left}}
    sizes = [(day, max(1, math.ceil(rows / ROWS_PER_FILE))) for day, rows in rows_of.items()]
    spark = batch.sparkSession
    files = spark.createDataFrame(sizes, "event_date date, files int")
    folders = [scratch_path(spark, name) for name in ("hot-list", "merged", "hot-groups")]
    try:
        hot = None
        if max(rows_of.values()) > hot_rows:  # else no group can be larger
            # Both inputs unmerged: slightly more rows than the result, but no join to look for hot keys.
            keys = ["transaction_date", "natural_key_hash"]
            both = existing.select(*keys).unionAll(batch.select(*keys))
            hot = land(find_hot_groups(both, max(rows_of.values()), hot_rows), folders[0])
            if hot.isEmpty():
                hot = None
            else:  # hot and other rows are ranked apart; the merge is written so that it runs once
                merged = land(merged, folders[1])
        ranked = rank_duplicates(merged, hot, files, hot_rows, folders[2])
        change.stage(BRONZE, ranked, touched, {"duplicates": F.count_if("is_duplicate")})
    finally:
        for folder in folders:
            delete_path(spark, folder)
    new = matched.filter("stored_date IS NULL OR stored_date <> event_date")
    append_to_log(change, ID_DATES, new, BLOOM_FILTER)
    seen = groups_seen(change.read(BRONZE, touched))
    change.stage(GROUP_HISTORY, merge_groups_seen(change.read(GROUP_HISTORY, touched), seen), touched)


def ingest_into(
    change: Change,
    settings: Settings,
    mode: str,
    *,
    contract: Contract | None,
    fetch_page: FetchPage | None = None,
    loaded: LoadedTransactions | None = None,
    batch_id: str | None = None,
    ingestion_timestamp: str | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
) -> dict[str, Any]:
    """Stage one batch into an open change. The driver holds counts and dates only."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = change.store.spark
    durations: dict[str, float] = {}
    audit = {
        "source": settings.source,
        "batch_id": batch_id or str(uuid.uuid4()),
        "ingestion_timestamp": ingestion_timestamp or now_utc_text(),
    }
    control = change.read(CONTROL)
    previous, bound = stored_bounds(control, settings.source, settings.watermark_lookback_days)
    lower_bound = bound if mode == "incremental" else None
    folders = {name: scratch_path(spark, name) for name in ("validated", "matched", "unique-ids")}
    landed: list[str] = []
    try:
        with timed_step(durations, "source_load"):
            loaded = loaded or load_transactions(spark, settings, lower_bound, fetch_page)
            landed = [loaded.landed_path] if loaded.landed_path else []
        with timed_step(durations, "validation"):
            staged, seen = stage_validated(loaded.rows, contract, folders["validated"])
        valid_count, invalid_count = seen["valid"], seen["invalid"]

        with timed_step(durations, "duplicate_detection"):
            batch = with_audit_columns(staged.filter("is_valid"), **audit)
            # One shuffle by id finds repeated ids, the dates of the batch and the dates that ids leave.
            matched = land(match_ids(batch, stored_dates(change, batch, valid_count)), folders["matched"])
            pairs = matched.groupBy("event_date", "stored_date").agg(
                F.count(F.lit(1)).alias("ids"), F.sum("copies").alias("rows")
            )
            pairs = pairs.collect()
            collisions = sum(row["rows"] - row["ids"] for row in pairs)
            if collisions:
                batch = land(resolve_id_collisions(batch), folders["unique-ids"])
        with timed_step(durations, "storage"):
            merge_bronze(change, batch, matched, pairs, hot_rows)
            if invalid_count:
                append_to_log(change, QUARANTINE, quarantine_rows(staged, **audit))
            duplicates = change.rows_in(BRONZE, "duplicates")
            state = control_row(
                spark,
                {
                    "source": settings.source,
                    "last_successful_watermark": seen["last_event"],
                    "lookback_days": settings.watermark_lookback_days,
                    "last_run_batch_id": audit["batch_id"],
                    "last_run_status": "success",
                    "records_read": valid_count + invalid_count,
                    "records_valid": valid_count,
                    "records_quarantined": invalid_count,
                    "records_duplicated": duplicates,
                    "updated_at": audit["ingestion_timestamp"],
                },
            )
            change.stage(CONTROL, advance_watermark(change.read(CONTROL), state))
            inserted = sum(row["ids"] for row in pairs if row["stored_date"] is None)
            audited = {
                "batch_id": audit["batch_id"],
                "source": settings.source,
                "mode": mode,
                "ingested_at": to_utc_datetime(audit["ingestion_timestamp"]),
                "records_read": valid_count + invalid_count,
                "records_valid": valid_count,
                "records_quarantined": invalid_count,
                "records_inserted": inserted,
                "first_event": seen["first_event"],
                "last_event": seen["last_event"],
            }
            append_to_log(change, RUN_AUDIT, spark.createDataFrame([audited], RUN_AUDIT_SCHEMA))
            own = (F.col("pipeline_name") == PIPELINE_NAME) & (F.col("source") == settings.source)
            watermark_state = control_state(change.read(CONTROL).filter(own).first())
    finally:
        for path in (*folders.values(), *landed):
            delete_path(spark, path)
    table_rows = change.rows_in(BRONZE)
    return {
        "batch_id": audit["batch_id"],
        "mode": mode,
        "source": settings.source,
        "resolved_source": loaded.resolved_source,
        "previous_watermark": previous,
        "effective_lower_bound": lower_bound,
        "ingestion_timestamp": audit["ingestion_timestamp"],
        "records_read": valid_count + invalid_count,
        "valid_records": valid_count,
        "inserted_valid_records": inserted,
        "quarantined_records": invalid_count,
        "duplicate_records": duplicates,
        "canonical_valid_records": table_rows - duplicates,
        "table_valid_records": table_rows,
        "batch_id_collisions": collisions,
        "watermark": watermark_state["last_successful_watermark"],
        "watermark_state": watermark_state,
        "durations_seconds": durations,
    }


def export_bronze(change: Change, settings: Settings) -> None:
    bronze = change.read(BRONZE)
    out = settings.output_path
    export_table(bronze, BRONZE, f"{out}/valid_transactions")
    export_table(read_log(change, QUARANTINE), QUARANTINE, f"{out}/quarantine_records")
    export_table(duplicate_rows(bronze), DUPLICATES, f"{out}/duplicate_records")


def settings_contract(spark: SparkSession, settings: Settings) -> Contract:
    """The contract the settings name, else the built-in one."""
    return load_contract(spark, settings.contract_path) if settings.contract_path else Contract(default_contract())


def run_ingestion(
    spark: SparkSession,
    settings: Settings,
    mode: str = "full",
    *,
    watermark_output: str | None = None,
    export: bool = True,
    **options: Any,
) -> dict[str, Any]:
    """Ingest one batch, publish it with its watermark, and write the bronze exports and reports."""
    change = TableStore(spark, settings.store_path).begin()
    contract = settings_contract(spark, settings)
    summary = ingest_into(change, settings, mode, contract=contract, **options)
    change.commit()
    if export:
        with timed_step(summary["durations_seconds"], "exports"):
            export_bronze(change, settings)
    if watermark_output:
        write_json_report(spark, summary["watermark_state"], watermark_output)
    write_json_report(spark, summary, f"{settings.output_path}/run_summary.json")
    return summary
