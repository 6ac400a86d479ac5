"""Watermark, metrics, settings and profile."""

from datetime import datetime

import pytest

from ledgerflow.operators.metrics import SUMMARY_SCHEMA, run_metrics, timed_step
from ledgerflow.operators.profile import build_profile, profile_report, value_distribution
from ledgerflow.operators.profile_state import profile_from_state, profile_state, replace_dates
from ledgerflow.operators.duplicates import flag_duplicates
from ledgerflow.operators.gold import daily_summary
from ledgerflow.operators.contract import Contract
from ledgerflow.operators.validate import invalid_by_kind, invalid_by_rule, quarantine_rows, valid_rows, validate
from ledgerflow.operators.watermark import (
    advance_watermark,
    control_row,
    control_state,
    stored_bounds,
)
from ledgerflow.functions.text import to_utc_datetime
from ledgerflow.plans.settings import Settings, settings_from
from ledgerflow.schema import CONTROL_SCHEMA, default_contract


@pytest.mark.parametrize("text", ["2024-03-30", "2024-03-30T10:00:00+01:00", "soon"])
def test_timestamp_parameters_are_strict(text):
    with pytest.raises(ValueError):
        to_utc_datetime(text)


def state(spark, source="csv", watermark="2024-03-30T10:00:00Z", batch_id="b1"):
    counts = {"records_read": 10, "records_valid": 8, "records_quarantined": 2, "records_duplicated": 1}
    values = {"source": source, "last_successful_watermark": watermark, "last_run_batch_id": batch_id}
    rest = {"lookback_days": 2, "last_run_status": "success", "updated_at": "2024-04-01T00:00:00Z"}
    return control_row(spark, {**values, **counts, **rest})


def test_control_rows_are_replaced_by_key(spark):
    control = spark.createDataFrame([], CONTROL_SCHEMA)
    assert stored_bounds(control, "csv", 2) == (None, None)
    control = advance_watermark(control, state(spark))
    control = advance_watermark(control, state(spark, source="api", watermark=None))
    control = advance_watermark(control, state(spark, watermark="2024-03-29T00:00:00Z", batch_id="b2"))
    assert control.schema.names == CONTROL_SCHEMA.names
    assert stored_bounds(control, "csv", 2) == ("2024-03-30T10:00:00Z", "2024-03-28T10:00:00Z")
    assert stored_bounds(control, "csv", 0) == ("2024-03-30T10:00:00Z", "2024-03-30T10:00:00Z")
    assert stored_bounds(control, "api", 2) == stored_bounds(control, "ftp", 2) == (None, None)
    rows = {row["source"]: control_state(row) for row in control.collect()}
    assert len(rows) == 2
    assert rows["csv"]["last_run_batch_id"] == "b2"
    assert rows["csv"]["updated_at"] == "2024-04-01T00:00:00Z"
    assert rows["api"]["last_successful_watermark"] is None
    with pytest.raises(ValueError, match="no columns"):
        control_row(spark, {"sourse": "csv"})


def test_watermark_never_goes_back(spark):
    def after(*marks):
        control = spark.createDataFrame([], CONTROL_SCHEMA)
        for mark in marks:
            control = advance_watermark(control, state(spark, watermark=mark))
        return stored_bounds(control, "csv", 1)[0]

    assert after("2024-03-30T10:00:00Z", "2024-03-29T10:00:00Z") == "2024-03-30T10:00:00Z"
    assert after("2024-03-30T10:00:00Z", "2024-04-01T00:00:00+00:00") == "2024-04-01T00:00:00Z"
    assert after(None, "2024-04-01 00:00:00") == "2024-04-01T00:00:00Z"
    assert after("2024-03-30T10:00:00Z", None) == "2024-03-30T10:00:00Z"
    assert after(None, None) is None


def metrics(spark, read, valid, quarantined, duplicates, tests=True, assertions=True, watermark=None):
    row = ("full", "csv", "b", read, valid, quarantined, duplicates, valid - duplicates, 0, None, watermark, tests, assertions)
    return run_metrics(spark.createDataFrame([row], SUMMARY_SCHEMA), "2024-03-31T00:35:29Z").first()


def test_rates_and_age(spark):
    row = metrics(spark, 352, 349, 3, 5, watermark=datetime(2024, 3, 30, 22, 35, 29))
    assert (row["quarantine_rate"], row["duplicate_rate"], row["warnings"]) == (0.0085, 0.0143, [])
    assert (row["watermark"], row["watermark_age_hours"]) == ("2024-03-30T22:35:29Z", 2.0)


def test_warnings_in_order(spark):
    assert metrics(spark, 100, 80, 20, 10, False, False)["warnings"] == [
        "quarantine_rate_above_5_percent",
        "duplicate_rate_above_5_percent",
        "dbt_tests_failed",
        "data_quality_assertions_failed",
    ]


def test_few_rows_or_the_threshold_itself_do_not_warn(spark):
    assert metrics(spark, 49, 40, 20, 10)["warnings"] == []
    assert metrics(spark, 100, 100, 5, 5)["warnings"] == []
    empty = metrics(spark, 0, 0, 0, 0)
    assert (empty["quarantine_rate"], empty["duplicate_rate"], empty["watermark_age_hours"]) == (0.0, 0.0, None)


def test_timed_step_records_failures_too():
    durations = {}
    with pytest.raises(KeyError), timed_step(durations, "step"):
        raise KeyError
    assert durations["step"] >= 0


def test_settings_checks():
    paths = {"csv_path": "c", "store_path": "s", "output_path": "o"}
    assert Settings(**paths).allow_csv_fallback is True
    assert Settings(**paths, source="csv").allow_csv_fallback is False
    assert Settings(**paths, source="csv", allow_csv_fallback=True).allow_csv_fallback is True
    for wrong in ({"source": "ftp"}, {"page_limit": 0}, {"watermark_lookback_days": -1}, {"api_parallelism": 0}):
        with pytest.raises(ValueError, match=next(iter(wrong)).split("_")[0]):
            Settings(**paths, **wrong)


def test_settings_from_text():
    settings = settings_from({"source": " CSV ", "page_limit": "7", "allow_csv_fallback": "Yes", "api_key": ""})
    assert (settings.source, settings.page_limit, settings.allow_csv_fallback, settings.api_key) == ("csv", 7, True, None)
    assert settings_from({}).watermark_lookback_days == 2
    with pytest.raises(ValueError, match="page_limit"):
        settings_from({"page_limit": "many"})


def test_profile(spark, make_raw):
    checked = validate(
        make_raw(
            {"transaction_id": "TXN-1"},
            {"transaction_id": "TXN-2"},
            {"transaction_id": "TXN-3", "currency": "USD", "transaction_type": "credit", "transaction_date": "2024-03-30T12:00:00Z"},
            {"transaction_id": "TXN-4", "status": "x", "amount": "0"},
            {"transaction_id": "TXN-5", "amount": "0"},
        )
    )
    bronze = flag_duplicates(valid_rows(checked))
    quarantine = quarantine_rows(checked, source="csv", batch_id="b", ingestion_timestamp="2024-04-01T00:00:00Z")
    report = profile_report(build_profile(bronze, quarantine, daily_summary(bronze)))
    status = "status must be one of ['completed', 'failed', 'pending', 'reversed']"
    assert report == {
        "row_counts": {
            "valid_records": 3,
            "canonical_valid_records": 2,
            "duplicate_records": 1,
            "quarantined_records": 2,
            "gold_daily_summary_rows": 1,
        },
        "date_range": {
            "min_transaction_date": "2024-03-30T10:00:00Z",
            "max_transaction_date": "2024-03-30T12:00:00Z",
        },
        "account_count": 1,
        "duplicate_group_count": 1,
        "multi_currency_account_dates": 1,
        "status_distribution": {"completed": 3},
        "currency_distribution": {"EUR": 2, "USD": 1},
        "transaction_type_distribution": {"credit": 1, "debit": 2},
        "invalid_count_by_rule": {"amount must be greater than zero": 2, status: 1},
    }


def test_rules_of_the_report_are_as_many_as_rules_not_values(spark, make_raw):
    """Values that look like endings of messages, and names of extra fields, make no rules of their own."""
    odd = ["x", "' is not one of [1]", "a\nb", "' is less than the minimum of 7", "does not match 'q'"]
    wrong = [{"transaction_id": f"TXN-{n}", "account_id": value, "currency": value} for n, value in enumerate(odd)]
    wrong += [{"transaction_id": f"TXN-E{n}", f"extra{n}": "1"} for n in range(4)]
    checked = validate(make_raw(*wrong), Contract(default_contract()))
    quarantine = quarantine_rows(checked, source="csv", batch_id="b", ingestion_timestamp="2024-04-01T00:00:00Z")
    quarantine = spark.createDataFrame(quarantine.collect(), quarantine.schema)
    assert invalid_by_rule(quarantine).count() > 12
    found = dict(invalid_by_kind(quarantine).collect())
    assert found.pop("unexpected fields") == 4 and found.pop("record violates schema: additional properties") == 4
    schema_rules = sorted(rule for rule in found if "violates schema" in rule)
    assert [rule.split(" violates schema: ")[0] for rule in schema_rules] == ["account_id", "currency"]
    assert schema_rules[0].startswith("account_id violates schema: does not match ")
    assert schema_rules[1].startswith("currency violates schema: is not one of [")
    assert len(found) == 4 and set(found.values()) == {5}


def test_profile_of_empty_tables(spark, make_raw):
    bronze = flag_duplicates(valid_rows(validate(make_raw({"status": "x"}))))
    empty = quarantine_rows(validate(make_raw({})), source="csv", batch_id="b", ingestion_timestamp="2024-04-01T00:00:00Z")
    report = profile_report(build_profile(bronze, empty, daily_summary(bronze)))
    assert report["date_range"] == {"min_transaction_date": None, "max_transaction_date": None}
    assert report["row_counts"]["valid_records"] == 0 and report["status_distribution"] == {}


def test_distribution_keeps_null_values(spark):
    rows = spark.createDataFrame([("a", None), (None, "x")], "p string, q string")
    found = sorted((r["column_name"], r["value"] or "-", r["row_count"]) for r in value_distribution(rows, ("p", "q")).collect())
    assert found == [("p", "-", 1), ("p", "a", 1), ("q", "-", 1), ("q", "x", 1)]


def test_profile_state_follows_touched_dates(spark, make_raw):
    def bronze_of(*rows):
        return flag_duplicates(valid_rows(validate(make_raw(*rows))))

    kept = [{"transaction_id": f"TXN-{i}", "account_id": f"ACC-{i}"} for i in range(1, 4)]
    moved = {"transaction_id": "TXN-4", "currency": "USD", "transaction_date": "2024-03-30T12:00:00Z"}
    gone = {"transaction_id": "TXN-5", "transaction_date": "2024-03-28T12:00:00Z"}
    before = bronze_of(*kept, moved, gone)
    after = bronze_of(*kept, moved | {"currency": "GBP"}, gone | {"transaction_date": "2024-03-30T13:00:00Z"})
    touched = spark.sql("SELECT explode(array(DATE'2024-03-30', DATE'2024-03-28')) AS event_date")
    later = after.filter("transaction_date >= TIMESTAMP'2024-03-29'")
    state = replace_dates(profile_state(before), profile_state(later), touched)
    assert {str(r.event_date) for r in state.collect()} == {str(r.event_date) for r in profile_state(after).collect()}
    assert "2024-03-28" not in {str(r.event_date) for r in state.collect()}
    quarantine = before.limit(0).selectExpr("CAST(NULL AS ARRAY<STRING>) AS errors")
    gold = daily_summary(after)
    expected = sorted(map(tuple, build_profile(after, quarantine, gold).collect()))
    assert sorted(map(tuple, profile_from_state(state, quarantine, gold).collect())) == expected  # few accounts: exact
    empty = profile_from_state(profile_state(after.limit(0)), quarantine, gold.limit(0)).collect()
    assert {r.value for r in empty if r.section in ("row_counts", "scalars")} == {"0"}
