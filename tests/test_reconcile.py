"""Control totals find defects of the summary that a second run of it would repeat."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.duplicates import flag_duplicates
from ledgerflow.operators.gold import daily_summary
from ledgerflow.operators.reconcile import unreconciled_days
from ledgerflow.operators.validate import valid_rows, validate


@pytest.fixture
def bronze(make_raw):
    rows = [
        {"transaction_id": "TXN-1"},
        {"transaction_id": "TXN-2"},  # a copy
        {"transaction_id": "TXN-3", "amount": "5.50", "currency": "USD", "merchant_name": "Other"},
        {"transaction_id": "TXN-4", "amount": "7.00", "transaction_type": "credit"},
        {"transaction_id": "TXN-5", "amount": "9.00", "status": "failed"},
        {"transaction_id": "TXN-6", "account_id": "ACC-1002", "transaction_date": "2024-03-29T00:00:00Z"},
        {"transaction_id": "TXN-7", "account_id": "ACC-1003", "status": "pending"},
    ]
    return flag_duplicates(valid_rows(validate(make_raw(*rows))))


def test_gold_is_borne_out(bronze):
    assert unreconciled_days(daily_summary(bronze), bronze).count() == 0


@pytest.mark.parametrize(
    "defect, differing",
    [
        ({"total_debit_amount": "total_debit_amount + 1"}, "debit_cents"),
        ({"net_amount": "-net_amount"}, "net_cents"),
        ({"distinct_merchants": "9"}, "merchants"),
        ({"currencies": "'EUR'"}, "currency_digest"),
        ({"transaction_count": "4", "total_credit_amount": "0"}, "transactions,credit_cents"),
    ],
)
def test_a_defect_of_the_summary_is_caught(bronze, defect, differing):
    gold = daily_summary(bronze).filter("account_id = 'ACC-1001'")
    others = daily_summary(bronze).filter("account_id <> 'ACC-1001'")
    wrong = gold.withColumns({k: F.expr(v).cast(gold.schema[k].dataType) for k, v in defect.items()}).unionByName(others)
    (row,) = unreconciled_days(wrong, bronze).collect()
    assert (row["account_id"], row["gold_rows"], row["bronze_rows"], row["differing"]) == ("ACC-1001", 1, 1, differing)


def test_missing_additional_and_repeated_days(bronze):
    gold = daily_summary(bronze)
    lacking = unreconciled_days(gold.filter("account_id <> 'ACC-1002'"), bronze).collect()
    assert [(r["account_id"], r["gold_rows"], r["bronze_rows"]) for r in lacking] == [("ACC-1002", 0, 1)]
    twice = unreconciled_days(gold.unionByName(gold.filter("account_id = 'ACC-1002'")), bronze).collect()
    assert [(r["account_id"], r["gold_rows"], r["differing"]) for r in twice] == [("ACC-1002", 2, "")]
    alien = gold.withColumn("account_id", F.lit("ACC-9999")).limit(1)
    extra = unreconciled_days(gold.unionByName(alien), bronze).collect()
    assert [(r["account_id"], r["gold_rows"], r["bronze_rows"]) for r in extra] == [("ACC-9999", 1, 0)]
    assert unreconciled_days(gold.limit(0), bronze.limit(0)).count() == 0
