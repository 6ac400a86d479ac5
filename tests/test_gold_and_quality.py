import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.duplicates import flag_duplicates
from ledgerflow.operators.gold import (
    category_totals,
    completed_canonical,
    daily_summary,
    staging_view,
    summarize,
    summarize_with_join,
)
from ledgerflow.operators.quality import (
    QualityError,
    accepted_values,
    check_equal,
    check_rows,
    check_unique,
    expression_is_true,
    gold_assertions,
    gold_model_checks,
    multiset_difference,
    not_null,
    run_assertions,
    staging_checks,
)
from ledgerflow.operators.validate import valid_rows, validate


@pytest.fixture
def bronze(make_raw):
    def make(*changes):
        changes = [{"transaction_id": f"TXN-{n}", **change} for n, change in enumerate(changes)]
        return flag_duplicates(valid_rows(validate(make_raw(*changes))))

    return make


MIXED = (
    {"amount": "10.00"},
    {"amount": "10.00"},
    {"amount": "20.00", "status": "pending"},
    {"amount": "5.00", "transaction_type": "credit", "merchant_name": "Employer"},
)


def test_only_completed_canonical_rows_count(bronze):
    rows = daily_summary(bronze(*MIXED), "2024-04-01T00:00:00Z").collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert str(row.pop("updated_at")) == "2024-04-01 00:00:00"
    assert row == {
        "account_id": "ACC-1001",
        "transaction_date": date(2024, 3, 30),
        "total_debit_amount": Decimal("10.00"),
        "total_credit_amount": Decimal("5.00"),
        "net_amount": Decimal("-5.00"),
        "transaction_count": 2,
        "distinct_merchants": 2,
        "top_category": "groceries",
        "currencies": "EUR",
    }


def test_top_category_ties_go_to_the_smaller_name(bronze):
    row = daily_summary(
        bronze(
            {"amount": "20.00", "merchant_category": "travel"},
            {"amount": "12.00", "merchant_category": "groceries"},
            {"amount": "8.00", "merchant_category": "groceries", "merchant_name": "Other"},
            {"amount": "15.00", "merchant_category": "electronics"},
            {"amount": "999.00", "merchant_category": "payroll", "transaction_type": "credit"},
        )
    ).first()
    assert (row["top_category"], str(row["total_debit_amount"])) == ("groceries", "55.00")


def test_one_cent_outweighs_the_name(bronze):
    row = daily_summary(
        bronze(
            {"amount": "20.01", "merchant_category": "travel"},
            {"amount": "20.00", "merchant_category": "e-commerce"},
        )
    ).first()
    assert row["top_category"] == "travel"


def test_credit_only_day_has_no_top_category(bronze):
    row = daily_summary(bronze({"amount": "100", "transaction_type": "credit"})).first()
    assert (str(row["total_debit_amount"]), str(row["net_amount"]), row["top_category"]) == ("0.00", "100.00", None)


def test_currencies_are_sorted_and_days_are_utc(bronze):
    rows = daily_summary(
        bronze(
            {"currency": "USD", "transaction_date": "2024-03-30T23:59:59Z"},
            {"currency": "AUD", "transaction_date": "2024-03-30T00:00:00+00:00"},
            {"currency": "USD", "transaction_date": "2024-03-31T00:00:00Z"},
        )
    ).orderBy("transaction_date")
    assert [(r["transaction_date"].day, r["currencies"]) for r in rows.collect()] == [(30, "AUD,USD"), (31, "USD")]


def test_large_amounts_stay_exact(bronze):
    rows = bronze({"amount": "9999999999999998.99"}, {"amount": "1.00", "merchant_name": "Other"})
    assert str(daily_summary(rows).first()["total_debit_amount"]) == "9999999999999999.99"


def test_merchant_seen_in_two_categories_counts_once(bronze):
    rows = bronze({"merchant_category": "travel"}, {"merchant_category": "retail"}, {"merchant_name": "Other"})
    assert daily_summary(rows).first()["distinct_merchants"] == 2


def test_unknown_values_stop_the_job(bronze):
    rows = completed_canonical(bronze({}))
    with pytest.raises(Exception, match="unknown currency: EUR"):
        summarize(rows, currencies=["USD"]).collect()


def test_join_form_agrees(bronze):
    rows = completed_canonical(bronze(*MIXED, {"account_id": "ACC-2002", "currency": "USD"}))
    assert summarize(rows).exceptAll(summarize_with_join(rows)).count() == 0
    assert category_totals(rows).filter("category_rank = 1").count() == 2


def test_empty_input(bronze):
    assert daily_summary(bronze({"status": "failed"})).count() == 0


def failed(report):
    return {row["name"]: row["failed_rows"] for row in report.collect() if row["failed_rows"]}


def test_all_checks_pass_on_rebuilt_gold(bronze, tmp_path):
    rows = bronze(*MIXED)
    gold = daily_summary(rows, "2024-04-01T00:00:00Z")
    assert failed(staging_checks(staging_view(rows))) == {}
    assert failed(gold_model_checks(gold)) == {}
    path = tmp_path / "report.json"
    result = run_assertions(gold_assertions(gold, rows), str(path))
    assert result["passed"] and len(result["assertions"]) == 6
    assert json.loads(path.read_text()) == result


def test_tampered_gold_is_reported_before_it_raises(bronze, tmp_path):
    rows = bronze(*MIXED)
    gold = daily_summary(rows).withColumn("net_amount", F.lit(999).cast("decimal(18,2)"))
    path = tmp_path / "report.json"
    with pytest.raises(QualityError) as error:
        run_assertions(gold_assertions(gold, rows), str(path))
    names = ["gold_net_amount_matches_credit_minus_debit", "gold_matches_completed_non_duplicate_bronze"]
    assert all(name in str(error.value) for name in names)
    report = {a["name"]: a["failed_rows"] for a in json.loads(path.read_text())["assertions"]}
    assert report[names[0]] == 1 and report[names[1]] == 2


def test_row_rules_let_null_pass(spark):
    table = spark.createDataFrame([(1, "a"), (None, None), (3, "z"), (3, "z")], "n int, s string")
    rules = [not_null("n"), accepted_values("s", ["a"]), expression_is_true("small", "n < 3")]
    found = {row["name"]: row["failed_rows"] for row in check_rows(table, rules).collect()}
    assert found == {"n_not_null": 1, "s_accepted_values": 2, "small": 2}
    assert check_unique(table, ["n", "s"], "key").first()["failed_rows"] == 1


def test_multiset_difference_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "n int")
    right = spark.createDataFrame([(1,), (3,), (None,)], "n int")
    found = {row["n"]: row["surplus"] for row in multiset_difference(left, right).collect()}
    assert found == {1: 1, 2: 1, 3: -1}
    assert check_equal(left, right, "same").first()["failed_rows"] == 3
    assert check_equal(left, left, "same").first()["failed_rows"] == 0
