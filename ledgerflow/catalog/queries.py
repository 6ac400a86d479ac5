"""Registered queries: each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.catalog.feed import (
    CappedPages,
    EventPages,
    UnavailablePages,
    api_payloads,
    events,
    feed,
    first_batch,
    ordered_events,
    padded_feed,
    raw_feed,
)
from ledgerflow.functions.text import format_utc, utc_date
from ledgerflow.operators.contract import Contract, load_contract
from ledgerflow.operators.duplicates import (
    canonical_rows,
    duplicate_groups,
    duplicate_rows,
    find_hot_groups,
    flag_duplicates,
    rank_duplicates,
    with_natural_key,
)
from ledgerflow.operators.gates import volume_gate as judge_volume
from ledgerflow.operators.gold import (
    category_totals,
    completed_canonical,
    completed_rows,
    daily_summary,
    multi_currency_days,
    staging_view,
    summarize,
    summarize_with_join,
)
from ledgerflow.operators.merge import resolve_id_collisions, unseen_rows, upsert_by_key
from ledgerflow.operators.metrics import run_metrics
from ledgerflow.operators.profile import (
    account_count,
    bronze_summary,
    build_profile,
    profile_report,
    value_distribution,
)
from ledgerflow.operators.profile_state import COUNTS as STATE_COUNTS
from ledgerflow.operators.profile_state import profile_from_state as profile_of_state
from ledgerflow.operators.profile_state import profile_state, replace_dates
from ledgerflow.operators.quality import (
    accepted_values,
    check_equal,
    check_rows,
    expression_is_true,
    gold_assertions,
    gold_model_checks,
    multiset_difference,
    not_null,
    repeated_keys,
    staging_checks,
)
from ledgerflow.operators.reconcile import unreconciled_days
from ledgerflow.operators.validate import (
    invalid_by_kind,
    invalid_by_rule,
    quarantine_rows,
    valid_rows,
    validate,
    with_audit_columns,
)
from ledgerflow.operators.watermark import advance_watermark, lookback, rows_since
from ledgerflow.operators.history import match_ids, moved_ids
from ledgerflow.plans.ingest import read_log, run_ingestion, stored_dates
from ledgerflow.plans.run import prove_incremental, run_pipeline, run_transform
from ledgerflow.plans.run import silver_changes as changes_of_silver
from ledgerflow.plans.settings import Settings
from ledgerflow.plans.store import TableStore
from ledgerflow.schema import (
    BRONZE,
    BRONZE_SCHEMA,
    BUSINESS_SCHEMA,
    CONTROL,
    CONTROL_SCHEMA,
    FIELDS,
    GOLD,
    GOLD_COMPARED,
    GROUP_HISTORY,
    MONEY,
    PROFILE,
    QUARANTINE,
    RUN_AUDIT,
    default_contract,
)
from ledgerflow.session import scratch_path, write_json_report, write_text
from ledgerflow.sources.csv_files import as_raw_records, normalize_columns, read_csv
from ledgerflow.sources.dated_landing import land_by_date, read_landed
from ledgerflow.sources.exports import export_table
from ledgerflow.sources.json_records import json_records
from ledgerflow.sources.keyset import read_keyset, time_splits
from ledgerflow.sources.landing import append_records
from ledgerflow.sources.paged import read_paged
from ledgerflow.sources.sample import sample_summary
from ledgerflow.sources.select import land, load_transactions

from ledgerflow.streaming.micro_batch import ingest_micro_batch

Query = Callable[[SparkSession, str], DataFrame]
LOOKBACK_DAYS = 2
RUN_TIME = "2024-02-01T00:00:00Z"
BATCH_1 = {"source": "csv", "batch_id": "batch-1", "ingestion_timestamp": "2024-01-25T00:00:00Z"}
BATCH_2 = {"source": "csv", "batch_id": "batch-2", "ingestion_timestamp": RUN_TIME}
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps it apart from an operator."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def _contract() -> Contract:
    return Contract(default_contract())


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(raw_feed(spark, sf_dir))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_duplicates(with_audit_columns(valid_rows(_validated(spark, sf_dir)), **BATCH_1))


def _stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written once, for queries that read it several times."""
    return _written(_bronze(spark, sf_dir))


def _written(rows: DataFrame) -> DataFrame:
    return land(rows, scratch_path(rows.sparkSession, "stage"))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(raw_feed(spark, sf_dir), _contract())
    return quarantine_rows(checked, **BATCH_1)


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """One-row results side by side, through one long union rather than a product."""
    cells = [
        part.select(F.inline(F.array(*[_cell(name, part) for name in part.columns]))) for part in parts
    ]
    names = [name for part in parts for name in part.columns]
    long = reduce(DataFrame.unionByName, cells)
    return long.groupBy().agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])


def _cell(name: str, part: DataFrame):
    return F.struct(F.lit(name).alias("name"), F.col(name).cast("bigint").alias("value"))


# --- sources and validation -------------------------------------------------------------------


@query
def normalize_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(padded_feed(spark, sf_dir))


@query
def validate_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select(
        "transaction_id",
        "is_valid",
        F.array_join("errors", "; ").alias("error_reason"),
        F.size("errors").cast("bigint").alias("error_count"),
    )


@query
def contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(raw_feed(spark, sf_dir), _contract())
    return checked.filter(~F.col("is_valid")).select(
        "transaction_id",
        F.array_join("errors", "; ").alias("error_reason"),
        F.size("errors").cast("bigint").alias("error_count"),
    )


@query
def contract_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract written as a JSON document, loaded from it and applied."""
    path = f"{scratch_path(spark, 'contract')}/transactions_schema.json"
    write_text(spark, path, json.dumps(default_contract(), default=float))
    checked = validate(raw_feed(spark, sf_dir), load_contract(spark, path))
    reason = F.array_join("errors", "; ").alias("error_reason")
    return checked.filter(~F.col("is_valid")).select("transaction_id", reason)


@query
def api_record_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records with nulls, missing fields and an extra field, checked by rules and contract."""
    checked = validate(json_records(api_payloads(spark, sf_dir).drop("e")), _contract())
    return checked.filter(~F.col("is_valid")).select(
        F.get_json_object("raw_payload", "$.id").cast("bigint").alias("id"),
        "transaction_id",
        F.array_join("errors", "; ").alias("error_reason"),
        F.size("errors").cast("bigint").alias("error_count"),
    )


@query
def valid_rows_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(_validated(spark, sf_dir))


@query
def quarantine_rows_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir).drop("errors", "event_date").withColumn(
        "error_count", F.col("error_count").cast("bigint")
    )


@query
def invalid_by_rule_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_by_rule(_quarantine(spark, sf_dir))


@query
def rows_with_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = with_audit_columns(valid_rows(_validated(spark, sf_dir)), **BATCH_1)
    return enriched.select("transaction_id", "source", "batch_id", "ingestion_timestamp")


@query
def paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_paged(
        spark, EventPages(sf_dir), page_size=2000, parallelism=spark.sparkContext.defaultParallelism
    )
    return pages.select(
        F.col("id").cast("bigint").alias("id"),
        "transaction_id",
        "account_id",
        "transaction_date",
        F.col("amount").cast(MONEY).alias("amount"),
    )


@query
def paged_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A paged scan whose lower bound the server applies."""
    cores = spark.sparkContext.defaultParallelism
    bound = "2024-01-20T12:00:00Z"
    pages = read_paged(spark, EventPages(sf_dir), watermark=bound, page_size=2000, parallelism=cores)
    return pages.select("transaction_id", "transaction_date")


@query
def source_sample_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of a source against the contract; the page size is the feature."""
    page = read_paged(spark, EventPages(sf_dir), page_size=5, max_pages=1)
    return sample_summary(page, _contract()).withColumn(
        "sample_transaction_ids", F.array_join("sample_transaction_ids", ",")
    )


def _feed_csv(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "feed-csv")
    rows.write.options(header=True, escape='"', emptyValue="").csv(path)
    return path


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV with careless headers, read back as normalised text."""
    return read_csv(spark, _feed_csv(spark, padded_feed(spark, sf_dir))).select(*FIELDS)


@query
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An API that stays down is answered by the CSV snapshot."""
    path = _feed_csv(spark, feed(spark, sf_dir))
    settings = Settings(csv_path=path, store_path="", output_path="", source="api", api_base_url="-")
    loaded = load_transactions(spark, settings, "2024-01-20T00:00:00Z", UnavailablePages())
    return loaded.rows.groupBy("status").agg(
        F.lit(loaded.resolved_source).alias("resolved_source"), F.count(F.lit(1)).alias("records_read")
    )


@query
def landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of checked records to one landing folder."""
    path = scratch_path(spark, "landing")
    clean = as_raw_records(valid_rows(_validated(spark, sf_dir)).select(*_as_text()))
    by_type = F.col("transaction_type") == "credit"
    appended = [append_records(clean.filter(part), path, _contract()) for part in (by_type, ~by_type)]
    landed = read_csv(spark, path).groupBy("transaction_type").agg(F.count(F.lit(1)).alias("records"))
    return landed.withColumn("appended", F.lit(sum(appended)).cast("bigint"))


def _as_text() -> list:
    typed = {"transaction_date": format_utc(F.col("transaction_date")), "amount": F.col("amount").cast("string")}
    return [typed.get(name, F.col(name)).alias(name) for name in FIELDS]


@query
def landing_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches landed by date, then the dates from a watermark on."""
    path = scratch_path(spark, "dated-landing")
    raw = raw_feed(spark, sf_dir)
    for batch, part in (("credits", F.col("transaction_type") == "credit"), ("others", F.col("transaction_type") != "credit")):
        land_by_date(raw.filter(part), path, batch)
    return read_landed(spark, path, "2024-01-20T12:00:00Z").select("transaction_id", "transaction_date")


# --- watermark --------------------------------------------------------------------------------


@query
def watermark_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_since(raw_feed(spark, sf_dir), "2024-01-20T12:00:00Z").select("transaction_id", "transaction_date")


def _control(batch: DataFrame, audit: dict) -> DataFrame:
    """The control row of one validated batch."""
    counts = batch.agg(
        F.max(F.when(F.col("is_valid"), F.col("transaction_date"))).alias("last_successful_watermark"),
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("is_valid").alias("records_valid"),
        F.count_if(~F.col("is_valid")).alias("records_quarantined"),
    )
    constants = {
        "pipeline_name": F.lit("transactions_ingestion"),
        "source": F.lit(audit["source"]),
        "lookback_days": F.lit(LOOKBACK_DAYS),
        "last_run_batch_id": F.lit(audit["batch_id"]),
        "last_run_status": F.lit("success"),
        "records_duplicated": F.lit(0).cast("bigint"),
        "updated_at": F.lit(audit["ingestion_timestamp"].rstrip("Z").replace("T", " ")).cast("timestamp_ntz"),
    }
    return counts.withColumns(constants).select(*CONTROL_SCHEMA.names)


def _second_batch(spark: SparkSession, sf_dir: str, control: DataFrame) -> DataFrame:
    """The whole feed from the first batch's watermark minus the lookback on."""
    lower = control.select(lookback(F.col("last_successful_watermark"), LOOKBACK_DAYS)).scalar()
    return rows_since(raw_feed(spark, sf_dir), lower)


@query
def effective_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = _control(validate(first_batch(spark, sf_dir)), BATCH_1)
    bound = lookback(F.col("last_successful_watermark"), LOOKBACK_DAYS)
    return control.select(
        format_utc(F.col("last_successful_watermark")).alias("watermark"),
        format_utc(bound).alias("effective_lower_bound"),
    )


@query
def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows after two batches; a third, old batch would not move the watermark back."""
    control = _control(validate(first_batch(spark, sf_dir)), BATCH_1)
    second = _control(validate(_second_batch(spark, sf_dir, control)), BATCH_2)
    old = _control(validate(first_batch(spark, sf_dir)), BATCH_2)
    state = advance_watermark(advance_watermark(control, second), old)
    return state.select(
        "pipeline_name", "source", "last_successful_watermark", "last_run_batch_id", "records_read", "records_valid"
    )


# --- duplicates -------------------------------------------------------------------------------


@query
def natural_key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_natural_key(valid_rows(_validated(spark, sf_dir))).select("transaction_id", "natural_key_hash")


@query
def dup_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).select(
        "transaction_id", "duplicate_group_id", "duplicate_rank", "is_duplicate"
    )


@query
def dup_ranked_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking when keys are too large for one task: one key per status holds all its rows."""
    rows = valid_rows(_validated(spark, sf_dir))
    fixed = rows.select("transaction_id", "status").withColumns(
        {
            "account_id": F.lit("ACC-0001"),
            "transaction_date": F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"),
            "amount": F.lit("1.00").cast(MONEY),
            **{name: F.lit("same") for name in FIELDS[4:8]},
            "country_code": F.lit("SE"),
        }
    )
    keyed = _written(with_natural_key(fixed.select(*FIELDS)))
    hot = _written(find_hot_groups(keyed, keyed.count(), hot_rows=1000))
    ranked = rank_duplicates(keyed, hot, rows_per_piece=1000)
    return ranked.select("transaction_id", "duplicate_rank", "is_duplicate")


@query
def dup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_rows(_bronze(spark, sf_dir))


@query
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(valid_rows(_validated(spark, sf_dir)))


# --- merges -----------------------------------------------------------------------------------


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows of the first batch and of the incremental second one."""
    first = _written(validate(first_batch(spark, sf_dir)))
    second = _written(validate(_second_batch(spark, sf_dir, _control(first, BATCH_1))))
    return (
        with_audit_columns(valid_rows(first), **BATCH_1),
        with_audit_columns(valid_rows(second), **BATCH_2),
    )


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _batches(spark, sf_dir)
    return upsert_by_key(first, second, ["transaction_id"])


@query
def upsert_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("transaction_id", "transaction_date", "amount", "batch_id")


@query
def inserted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _batches(spark, sf_dir)
    return unseen_rows(second, first, ["transaction_id"]).select("transaction_id", "transaction_date")


@query
def id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per id of a batch that sends ids repeatedly: each account's rows share one id."""
    rows = valid_rows(_validated(spark, sf_dir))
    shared = rows.withColumn("transaction_id", F.concat(F.lit("TXN-"), F.substring("account_id", 5, 4)))
    kept = resolve_id_collisions(with_natural_key(shared))
    return kept.select("transaction_id", "transaction_date", "amount", "natural_key_hash")


@query
def quarantine_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine after two batches: a row seen again is replaced, not repeated."""
    checked = _written(validate(first_batch(spark, sf_dir)))
    first = quarantine_rows(checked, **BATCH_1)
    again = _written(validate(_second_batch(spark, sf_dir, _control(checked, BATCH_1))))
    second = quarantine_rows(again, **BATCH_2)
    return upsert_by_key(first, second, ["quarantine_id"]).select(
        "quarantine_id", "transaction_id", "error_reason", "batch_id"
    )


@query
def incremental_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_duplicates(_merged(spark, sf_dir)).select(
        "transaction_id", "transaction_date", "batch_id", "duplicate_rank", "is_duplicate"
    )


@query
def correction_moves_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rows come again under their id, a day later; then everything is ranked again."""
    rows = valid_rows(_validated(spark, sf_dir))
    later = F.col("transaction_date") + F.make_dt_interval(F.lit(1))
    corrected = rows.filter("status = 'failed'").withColumn("transaction_date", later)
    merged = upsert_by_key(rows, corrected, ["transaction_id"])
    return flag_duplicates(merged).select("transaction_id", "transaction_date", "duplicate_rank")


# --- gold -------------------------------------------------------------------------------------


@query
def stg_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_view(_bronze(spark, sf_dir))


@query
def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text to the account/day summary; without ranks to store, duplicates are a distinct."""
    return summarize(completed_rows(canonical_rows(valid_rows(_validated(spark, sf_dir)))))


@query
def gold_from_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_summary(_bronze(spark, sf_dir))


@query
def gold_daily_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize_with_join(completed_canonical(_stored_bronze(spark, sf_dir)))


@query
def category_totals_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_totals(completed_canonical(_bronze(spark, sf_dir))).withColumn(
        "category_rank", F.col("category_rank").cast("bigint")
    )


@query
def gold_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_summary(_bronze(spark, sf_dir)).groupBy("top_category").agg(
        F.count(F.lit(1)).alias("account_days"), F.sum("total_debit_amount").cast(MONEY).alias("debit_amount")
    )


@query
def gold_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_summary(_bronze(spark, sf_dir)).groupBy("currencies").agg(
        F.count(F.lit(1)).alias("account_days"), F.sum("distinct_merchants").alias("merchants")
    )


# --- quality ----------------------------------------------------------------------------------


def _tampered(gold: DataFrame) -> DataFrame:
    """Gold with a wrong net amount on the first day of the month."""
    first_day = F.col("transaction_date") == F.lit("2024-01-01").cast("date")
    wrong = (F.col("net_amount") + 1).cast(MONEY)
    return gold.withColumn("net_amount", F.when(first_day, wrong).otherwise(F.col("net_amount")))


@query
def dq_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_checks(staging_view(_stored_bronze(spark, sf_dir)))


@query
def dq_gold_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_model_checks(daily_summary(_bronze(spark, sf_dir)))


@query
def dq_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _stored_bronze(spark, sf_dir)
    return gold_assertions(daily_summary(bronze), bronze)


@query
def dq_gold_tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _stored_bronze(spark, sf_dir)
    return gold_assertions(_tampered(daily_summary(bronze)), bronze)


@query
def dq_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return repeated_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def dq_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules on a table that breaks some of them."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rules = [
        not_null("o_orderkey"),
        accepted_values("o_orderstatus", ["O", "F"]),
        expression_is_true("o_totalprice_at_least_1000", "o_totalprice >= 1000"),
    ]
    return check_rows(orders, rules)


@query
def gold_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampered gold against recomputed gold: the rows that differ, with their sign."""
    bronze = _stored_bronze(spark, sf_dir)
    actual = _tampered(daily_summary(bronze))
    return multiset_difference(actual, daily_summary(bronze))


@query
def gold_control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampered gold against totals of bronze that aren't computed like gold: the account days that differ."""
    bronze = _stored_bronze(spark, sf_dir)
    return unreconciled_days(_tampered(daily_summary(bronze)), bronze)


@query
def multiset_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against distinct order lines: the surplus is what repeats."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return check_equal(lines, lines.distinct(), "lines_are_distinct")


# --- profile and metrics ----------------------------------------------------------------------


@query
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _stored_bronze(spark, sf_dir)
    quarantined = _quarantine(spark, sf_dir).agg(F.count(F.lit(1)).alias("quarantined_records"))
    gold = daily_summary(bronze).agg(F.count(F.lit(1)).alias("gold_daily_summary_rows"))
    counts = bronze_summary(bronze).drop("min_transaction_date", "max_transaction_date")
    return _one_row([counts, quarantined, gold])


@query
def profile_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = bronze_summary(_bronze(spark, sf_dir))
    return summary.select("min_transaction_date", "max_transaction_date")


@query
def profile_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_distribution(_bronze(spark, sf_dir))


@query
def profile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _stored_bronze(spark, sf_dir)
    days = multi_currency_days(bronze).agg(F.count(F.lit(1)).alias("multi_currency_account_dates"))
    groups = bronze_summary(bronze).select("duplicate_group_count")
    return _one_row([account_count(bronze), groups, days])


@query
def multi_currency_days_(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = multi_currency_days(_bronze(spark, sf_dir))
    return days.withColumn("currency_count", F.col("currency_count").cast("bigint"))


@query
def data_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _stored_bronze(spark, sf_dir)
    return build_profile(bronze, _quarantine(spark, sf_dir), daily_summary(bronze))


@query
def profile_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile from state per date, of which the second batch made only the dates it touched anew."""
    before = _written(flag_duplicates(valid_rows(validate(first_batch(spark, sf_dir), _contract()))))
    bronze = _stored_bronze(spark, sf_dir)
    day = utc_date(F.col("transaction_date")).alias("event_date")
    new = bronze.join(before.select("transaction_id"), "transaction_id", "left_anti")
    touched = new.select(day).distinct()
    fresh = profile_state(bronze.withColumn("event_date", day).join(touched, "event_date", "left_semi").drop("event_date"))
    state = _written(replace_dates(_written(profile_state(before)), fresh, touched))
    return profile_of_state(state, _quarantine(spark, sf_dir), daily_summary(bronze), account_count(bronze))


@query
def report_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row counts of the profile report, written as JSON and read again."""
    bronze = _stored_bronze(spark, sf_dir)
    profile = build_profile(bronze, _quarantine(spark, sf_dir), daily_summary(bronze), invalid_by_kind)
    path = f"{scratch_path(spark, 'report')}/data_profile.json"
    write_json_report(spark, profile_report(profile), path)
    return spark.read.option("multiLine", True).json(path).select("row_counts.*")


@query
def invalid_by_kind_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_by_kind(_quarantine(spark, sf_dir))


@query
def batch_max_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = _control(_validated(spark, sf_dir), BATCH_1)
    return control.select(format_utc(F.col("last_successful_watermark")).alias("watermark"))


def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _written(_validated(spark, sf_dir))
    counts = checked.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("quarantined_records"),
        F.unix_seconds(F.max(F.when(F.col("is_valid"), F.col("transaction_date"))).cast("timestamp")).alias("latest"),
    )
    bronze = _written(flag_duplicates(valid_rows(checked)))
    table = bronze.agg(
        F.count_if("is_duplicate").alias("duplicate_records"),
        F.count_if(~F.col("is_duplicate")).alias("canonical_valid_records"),
        F.count(F.lit(1)).alias("table_valid_records"),
    )
    gold = daily_summary(bronze).agg(F.count(F.lit(1)).alias("daily_summary_rows"))
    return _one_row([counts, table, gold]).withColumns(
        {
            "mode": F.lit("full"),
            "source": F.lit("csv"),
            "batch_id": F.lit("batch-1"),
            "watermark": F.timestamp_seconds("latest").cast("timestamp_ntz"),
            "dbt_tests_passed": F.lit(True),
            "assertions_passed": F.lit(True),
        }
    )


METRIC_COLUMNS = [
    "records_read", "valid_records", "quarantined_records", "duplicate_records", "canonical_valid_records",
    "daily_summary_rows", "quarantine_rate", "duplicate_rate", "watermark", "watermark_age_hours", "warnings",
]


@query
def run_metrics_(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = run_metrics(_run_summary(spark, sf_dir), RUN_TIME)
    return metrics.select(*METRIC_COLUMNS).withColumn("warnings", F.array_join("warnings", ","))


@query
def metric_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings per arrival date of order lines, with returned lines as the doubtful ones."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    by_flag = lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.col("l_quantity") > 5).alias("valid_records"),
        F.count_if(F.col("l_quantity") <= 5).alias("quarantined_records"),
        F.count_if(F.col("l_discount") > 0.08).alias("duplicate_records"),
    )
    rows = by_flag.withColumns(
        {
            "table_valid_records": F.col("valid_records"),
            "watermark": F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"),
            "dbt_tests_passed": F.col("l_returnflag") != "R",
            "assertions_passed": F.col("l_linestatus") != "O",
        }
    )
    return run_metrics(rows, RUN_TIME).select(
        "l_returnflag",
        "l_linestatus",
        "quarantine_rate",
        "duplicate_rate",
        "watermark_age_hours",
        F.array_join("warnings", ",").alias("warnings"),
    )


# --- stored tables ----------------------------------------------------------------------------


def _two_stored_batches(spark: SparkSession, sf_dir: str, transform: bool) -> TableStore:
    return TableStore(spark, _run_batches(spark, sf_dir, transform)[0].store_path)


def _run_batches(spark: SparkSession, sf_dir: str, transform: bool) -> tuple[Settings, dict]:
    """Both batches through files, store and watermark, as a scheduled job would run them."""
    root = scratch_path(spark, "store")
    first = _feed_csv(spark, first_batch(spark, sf_dir).select(*FIELDS))
    whole = _feed_csv(spark, feed(spark, sf_dir))

    def settings(path: str) -> Settings:
        return Settings(csv_path=path, store_path=f"{root}/tables", output_path=f"{root}/out", source="csv")

    for path, mode, audit in ((first, "full", BATCH_1), (whole, "incremental", BATCH_2)):
        summary = run_ingestion(
            spark,
            settings(path),
            mode,
            export=False,
            batch_id=audit["batch_id"],
            ingestion_timestamp=audit["ingestion_timestamp"],
        )
        if transform:
            run_transform(spark, settings(path), export=False, updated_at=audit["ingestion_timestamp"])
    return settings(whole), summary


@query
def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_stored_batches(spark, sf_dir, transform=False).read(BRONZE).select(
        "transaction_id", "transaction_date", "batch_id", "duplicate_rank", "is_duplicate"
    )


@query
def stored_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_log(_two_stored_batches(spark, sf_dir, transform=False), QUARANTINE)
    return table.drop("errors", "ingestion_timestamp").withColumn(
        "error_count", F.col("error_count").cast("bigint")
    )


@query
def stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_stored_batches(spark, sf_dir, transform=True).read(GOLD).select(*GOLD_COMPARED)


@query
def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each date as two batches leave them in the store."""
    return _two_stored_batches(spark, sf_dir, transform=True).read(PROFILE).select("event_date", *STATE_COUNTS)


@query
def stored_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = _two_stored_batches(spark, sf_dir, transform=False).read(CONTROL)
    return control.withColumn("lookback_days", F.col("lookback_days").cast("bigint"))


@query
def quarantine_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of each quarantined record in the append-only log of two batches."""
    log = _two_stored_batches(spark, sf_dir, transform=False).read(QUARANTINE)
    return log.groupBy("quarantine_id").agg(
        F.count(F.lit(1)).alias("attempts"), F.max_by("batch_id", "delta").alias("latest_batch")
    )


@query
def dup_group_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each duplicate group was first and last ingested, over two batches."""
    return _two_stored_batches(spark, sf_dir, transform=False).read(GROUP_HISTORY)


def _stored_feed(spark: SparkSession, sf_dir: str) -> Settings:
    """The whole feed through a CSV file into a new store."""
    root = scratch_path(spark, "store")
    path = _feed_csv(spark, feed(spark, sf_dir))
    settings = Settings(csv_path=path, store_path=f"{root}/tables", output_path=f"{root}/out", source="csv")
    times = {"batch_id": "batch-1", "ingestion_timestamp": BATCH_1["ingestion_timestamp"]}
    run_ingestion(spark, settings, export=False, **times)
    return settings


def _corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rows, but for replays, as completed ones a day later."""
    rows = valid_rows(_validated(spark, sf_dir)).filter("status = 'failed' AND transaction_id NOT LIKE 'TXN-R%'")
    later = F.col("transaction_date") + F.make_dt_interval(F.lit(1))
    return rows.withColumns({"transaction_date": later, "status": F.lit("completed")})


@query
def moved_ids_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a correction that are stored under another date, found in the index of ids."""
    change = TableStore(spark, _stored_feed(spark, sf_dir).store_path).begin()
    batch = _written(with_natural_key(_corrected(spark, sf_dir)).withColumn("event_date", F.to_date("transaction_date")))
    return moved_ids(match_ids(batch, stored_dates(change, batch, batch.count())))


@query
def silver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows that a correction inserts, changes or removes: copies of a corrected row become canonical."""
    settings = _stored_feed(spark, sf_dir)
    path = _feed_csv(spark, _corrected(spark, sf_dir).select(*_as_text()))
    times = {"batch_id": "batch-2", "ingestion_timestamp": RUN_TIME}
    run_ingestion(spark, replace(settings, csv_path=path), export=False, **times)
    return changes_of_silver(TableStore(spark, settings.store_path), 1, 2)


@query
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of two runs read and wrote, as observed while it did."""
    return read_log(_two_stored_batches(spark, sf_dir, transform=False), RUN_AUDIT)


@query
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs of JSON records, the first one delivered twice: what each delivery read and inserted."""
    root = scratch_path(spark, "stream")
    settings = Settings(csv_path="", store_path=f"{root}/tables", output_path=f"{root}/out", source="csv")
    lines = _written(api_payloads(spark, sf_dir).withColumnRenamed("raw_payload", "value"))
    rows = []
    for delivery, (epoch, part) in enumerate(((0, lines.filter("e % 2 = 0")), (0, lines.filter("e % 2 = 0")), (1, lines))):
        said: list[dict] = []
        ingest_micro_batch(spark, settings, said.append)(part.select("value"), epoch)
        read, inserted = (said[0][name] if said else 0 for name in ("records_read", "inserted_valid_records"))
        rows.append((delivery, epoch, read, inserted))
    return spark.createDataFrame(rows, "delivery bigint, epoch bigint, records_read bigint, inserted_valid_records bigint")


@query
def volume_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per day and kind of event against the days before, with one day mostly missing."""
    lost = (F.to_date("ts") == F.lit("2024-01-20").cast("date")) & (F.col("k") >= 20)
    daily = events(spark, sf_dir).filter(~lost).groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("records")
    )
    judged = judge_volume(daily, ["event_type"], "day", "records")
    return judged.select("event_type", "day", "records", "expected", "verdict")


@query
def paged_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time ranges of a source that caps its pages, whose lower bound is a filter of the query."""
    splits = time_splits("2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z", spark.sparkContext.defaultParallelism)
    pages = read_keyset(spark, CappedPages(ordered_events(spark, sf_dir), 700), splits=splits, page_size=2000)
    recent = pages.filter(F.col("event_time") >= F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))
    return json_records(recent).select("transaction_id", "transaction_date")


@query
def keyset_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All time ranges of a source that caps its pages."""
    splits = time_splits("2024-01-05T00:00:00Z", "2024-01-25T00:00:00Z", spark.sparkContext.defaultParallelism)
    pages = json_records(read_keyset(spark, CappedPages(ordered_events(spark, sf_dir), 700), splits=splits, page_size=2000))
    return pages.select("transaction_id", "transaction_date", F.col("amount").cast(MONEY).alias("amount"))


@query
def incremental_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second stored batch against the ids and the watermark that the feed lets expect."""
    settings, summary = _run_batches(spark, sf_dir, transform=False)
    first, second = _batches(spark, sf_dir)
    new_ids = _written(unseen_rows(second, first, ["transaction_id"]).select("transaction_id"))
    latest = second.select(format_utc(F.max("transaction_date"))).first()[0]
    proof = prove_incremental(spark, settings, new_ids, summary, latest)
    names = ["expected_inserted_valid_records", "actual_inserted_valid_records", "persisted_new_records"]
    schema = ", ".join(f"{name} bigint" for name in names) + ", actual_watermark string, passed boolean"
    return spark.createDataFrame([tuple(proof[n] for n in (*names, "actual_watermark", "passed"))], schema)


@query
def step_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timed steps of an ingestion of the first batch."""
    root = scratch_path(spark, "store")
    path = _feed_csv(spark, first_batch(spark, sf_dir).select(*FIELDS))
    settings = Settings(csv_path=path, store_path=f"{root}/tables", output_path=f"{root}/out", source="csv")
    summary = run_ingestion(spark, settings, export=False)
    rows = [(step, taken >= 0, summary["records_read"]) for step, taken in summary["durations_seconds"].items()]
    return spark.createDataFrame(rows, "step string, was_timed boolean, records_read bigint")


@query
def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run with its incremental proof pass; one row of counts per pass."""
    root = scratch_path(spark, "run")
    path = _feed_csv(spark, feed(spark, sf_dir))
    settings = Settings(csv_path=path, store_path=f"{root}/tables", output_path=f"{root}/out", source="csv")
    summary = run_pipeline(spark, settings, "full", now=RUN_TIME, export=False)
    names = ["records_read", "valid_records", "inserted_valid_records", "quarantined_records", "duplicate_records"]
    names += ["canonical_valid_records", "watermark"]
    passes = [("full_ingestion", "initial_transform"), ("incremental_simulation", "final_transform")]
    rows = [
        (ingestion, *[summary[ingestion][name] for name in names], summary[transform]["daily_summary_rows"])
        for ingestion, transform in passes
    ]
    schema = "step string, " + ", ".join(f"{name} bigint" for name in names[:-1])
    return spark.createDataFrame(rows, f"{schema}, watermark string, daily_summary_rows bigint")


@query
def csv_roundtrip_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze exported as ordered CSV and read back."""
    path = scratch_path(spark, "export")
    export_table(_bronze(spark, sf_dir), BRONZE, path)
    exported = spark.read.options(header=True, escape='"').schema(BRONZE_SCHEMA).csv(path)
    return exported.select(*BUSINESS_SCHEMA.names, "is_duplicate", "duplicate_rank")
