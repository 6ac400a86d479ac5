"""Invariants over generated batches."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators.contract import Contract
from ledgerflow.operators.duplicates import flag_duplicates, rank_duplicates, with_natural_key
from ledgerflow.operators.gold import completed_canonical, summarize, summarize_with_join
from ledgerflow.operators.merge import upsert_by_key
from ledgerflow.operators.quality import multiset_difference
from ledgerflow.operators.validate import valid_rows, validate
from ledgerflow.schema import CURRENCIES, MERCHANT_CATEGORIES, STATUSES, default_contract
from ledgerflow.sources.json_records import json_records
from tests.conftest import BASE

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

records = st.lists(
    st.fixed_dictionaries(
        {
            "account_id": st.sampled_from(["ACC-1001", "ACC-1002"]),
            "transaction_date": st.sampled_from(["2024-03-30T10:00:00Z", "2024-03-31T10:00:00+00:00"]),
            "amount": st.sampled_from(["1.00", "1.0", "2.50", "2.51"]),
            "currency": st.sampled_from(CURRENCIES[:3]),
            "transaction_type": st.sampled_from(["debit", "credit"]),
            "merchant_category": st.sampled_from(MERCHANT_CATEGORIES[:4]),
            "status": st.sampled_from(STATUSES[:2]),
        }
    ),
    min_size=1,
    max_size=40,
)
anything = st.one_of(
    st.none(), st.text(max_size=12), st.integers(), st.booleans(), st.floats(allow_nan=False, allow_infinity=False)
)
odd_records = st.lists(
    st.dictionaries(st.sampled_from([*BASE, "id", "note"]), anything, max_size=12), min_size=1, max_size=25
)


def raw(spark, dicts):
    lines = [(json.dumps(record, sort_keys=True),) for record in dicts]
    return json_records(spark.createDataFrame(lines, "raw_payload string"))


def numbered(changes, prefix="TXN-"):
    return [{**BASE, **change, "transaction_id": f"{prefix}{n}"} for n, change in enumerate(changes)]


def same(left, right):
    return multiset_difference(left, right).count() == 0


@FEW
@given(odd_records)
def test_any_record_is_valid_or_explained(spark, dicts):
    rows = validate(raw(spark, dicts), Contract(default_contract())).collect()
    assert len(rows) == len(dicts)
    for row in rows:
        assert row["is_valid"] == (not row["errors"])
        assert (row["raw_payload"] is None) == row["is_valid"]


@FEW
@given(records)
def test_one_canonical_row_per_key(spark, changes):
    ranked = flag_duplicates(valid_rows(validate(raw(spark, numbered(changes)))))
    per_key = ranked.groupBy("natural_key_hash").agg(
        F.count_if(~F.col("is_duplicate")).alias("canonical"),
        F.max("duplicate_rank").alias("last"),
        F.count(F.lit(1)).alias("rows"),
    )
    assert per_key.filter("canonical <> 1 OR last <> rows").count() == 0


@FEW
@given(records)
def test_ranks_by_position_equal_ranks_by_window(spark, changes):
    keyed = with_natural_key(valid_rows(validate(raw(spark, numbered(changes)))))
    every_key = keyed.select("natural_key_hash").distinct().withColumn("rows", F.lit(1))
    assert same(rank_duplicates(keyed, every_key, rows_per_piece=5), rank_duplicates(keyed))


@FEW
@given(records)
def test_both_summary_forms_agree(spark, changes):
    rows = completed_canonical(flag_duplicates(valid_rows(validate(raw(spark, numbered(changes))))))
    assert same(summarize(rows), summarize_with_join(rows))


@FEW
@given(records, records)
def test_disjoint_batches_commute_and_replays_are_idle(spark, first, second):
    a = valid_rows(validate(raw(spark, numbered(first, "TXN-A"))))
    b = valid_rows(validate(raw(spark, numbered(second, "TXN-B"))))
    key = ["transaction_id"]
    both = upsert_by_key(a, b, key)
    assert same(flag_duplicates(both), flag_duplicates(upsert_by_key(b, a, key)))
    assert same(upsert_by_key(both, b, key), both)
