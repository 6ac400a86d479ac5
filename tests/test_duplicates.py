from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import duplicates
from ledgerflow.operators.duplicates import (
    canonical_rows,
    duplicate_groups,
    duplicate_rows,
    find_hot_groups,
    flag_duplicates,
    rank_duplicates,
    ranked_by_position,
    with_natural_key,
)
from ledgerflow.operators.merge import resolve_id_collisions
from ledgerflow.operators.validate import valid_rows, validate, with_audit_columns
from ledgerflow.schema import BUSINESS_SCHEMA, FIELDS, NATURAL_KEY


def ranks(rows):
    return {row["transaction_id"]: row["duplicate_rank"] for row in rows.collect()}


def transactions(spark, ids, amount="amounts", **columns):
    """Rows that differ in the id, and in the amount unless one is given."""
    values = {
        "account_id": "ACC-0001",
        "transaction_date": datetime(2024, 1, 1, 10),
        "currency": "EUR",
        "transaction_type": "debit",
        "merchant_name": "Shop",
        "merchant_category": "retail",
        "status": "completed",
        "country_code": "SE",
        **columns,
    }
    rows = []
    for number, key in enumerate(ids, start=1):
        money = Decimal(number) if amount == "amounts" else Decimal(amount)
        rows.append(tuple({**values, "transaction_id": key, "amount": money}[field] for field in FIELDS))
    return spark.createDataFrame(rows, BUSINESS_SCHEMA)


def test_the_id_is_not_part_of_the_key(make_raw):
    rows = flag_duplicates(valid_rows(validate(make_raw({"transaction_id": "TXN-2"}, {"transaction_id": "TXN-1"}))))
    assert ranks(rows) == {"TXN-1": 1, "TXN-2": 2}
    assert rows.filter("is_duplicate").first()["transaction_id"] == "TXN-2"
    assert rows.select("duplicate_group_id").distinct().count() == 1


@pytest.mark.parametrize("field", NATURAL_KEY)
def test_every_other_field_is_part_of_the_key(make_raw, field):
    other = {
        "account_id": "ACC-2002",
        "transaction_date": "2024-03-30T10:00:01Z",
        "amount": "12.35",
        "currency": "USD",
        "transaction_type": "credit",
        "merchant_name": "corner shop",
        "merchant_category": "retail",
        "status": "pending",
        "country_code": "NO",
    }
    rows = valid_rows(validate(make_raw({}, {"transaction_id": "TXN-2", field: other[field]})))
    assert set(ranks(flag_duplicates(rows)).values()) == {1}


def test_amounts_compare_by_value(make_raw):
    rows = valid_rows(validate(make_raw({"amount": 12.5}, {"transaction_id": "TXN-2", "amount": "12.50"})))
    assert ranks(flag_duplicates(rows)) == {"TXN-1": 1, "TXN-2": 2}


def test_ids_rank_in_string_order(spark):
    rows = transactions(spark, ["TXN-9", "TXN-10", "TXN-100", "TXN-A"], amount="5")
    assert ranks(flag_duplicates(rows)) == {"TXN-10": 1, "TXN-100": 2, "TXN-9": 3, "TXN-A": 4}


def skewed(spark):
    """A third of 3,000 rows share one key, 300 another, the rest are pairs."""
    number = F.col("id")
    merchant = F.when(number < 1000, "hot").when(number < 1300, "warm").otherwise(F.floor(number / 2).cast("string"))
    fixed = transactions(spark, ["TXN-0"], amount="5").drop("transaction_id", "merchant_name").first().asDict()
    shuffled = F.concat(F.lit("TXN-"), F.upper(F.substring(F.md5(number.cast("string")), 1, 8)), number)
    columns = {"transaction_id": shuffled, "merchant_name": F.concat(F.lit("M "), merchant)}
    columns |= {name: F.lit(value).cast(BUSINESS_SCHEMA[name].dataType) for name, value in fixed.items()}
    return spark.range(3000).select(*[columns[name].alias(name) for name in FIELDS])


def test_hot_groups_are_found(spark):
    keyed = with_natural_key(skewed(spark))
    found = dict(find_hot_groups(keyed, 3000, hot_rows=200).collect())
    sizes = {row["natural_key_hash"]: row["count"] for row in keyed.groupBy("natural_key_hash").count().collect()}
    assert sorted(found.values()) == [300, 1000]
    assert all(sizes[key] == rows for key, rows in found.items())
    assert find_hot_groups(keyed, 3000, hot_rows=5000).isEmpty()


@pytest.mark.parametrize("most_items", [1_000_000, 2_000])
def test_every_hot_group_is_found_and_split_however_many(spark, monkeypatch, tmp_path, most_items):
    """1,500 equal groups above the limit on one date among single rows, by sketches and by counting."""
    monkeypatch.setattr(duplicates, "MOST_SKETCH_ITEMS", most_items)
    number = F.col("id")
    key = F.when(number < 6000, F.md5((number % 1500).cast("string"))).otherwise(F.sha2(number.cast("string"), 256))
    day = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    rows = spark.range(9000, numPartitions=5).select(
        F.concat(F.lit("TXN-"), number).alias("transaction_id"), day.alias("transaction_date"), key.alias("natural_key_hash")
    )
    rows.write.parquet(str(tmp_path / "keyed"))
    keyed = spark.read.parquet(str(tmp_path / "keyed"))
    find_hot_groups(keyed, 9000, hot_rows=3).write.parquet(str(tmp_path / "hot"))
    hot = spark.read.parquet(str(tmp_path / "hot"))
    assert hot.count() == 1500 and hot.agg(F.min("rows")).first()[0] >= 4
    ranked = rank_duplicates(keyed, hot, rows_per_piece=600, scratch=str(tmp_path / "sorted"))
    assert spark.read.parquet(str(tmp_path / "sorted")).count() == 6000
    assert ranks(ranked) == ranks(rank_duplicates(keyed))


def test_flagging_runs_nothing_before_an_action(spark):
    rows = skewed(spark)
    spark.sparkContext.setJobGroup("flagging", "")
    flag_duplicates(rows)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("flagging")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_groups_are_ranked_exactly_in_pieces(spark, tmp_path):
    keyed = with_natural_key(skewed(spark))
    hot = find_hot_groups(keyed, 3000, hot_rows=200)
    assert ranks(rank_duplicates(keyed, hot, rows_per_piece=100)) == ranks(rank_duplicates(keyed))
    rows = keyed.join(hot, "natural_key_hash", "left_semi")
    assert ranked_by_position(rows, 13, str(tmp_path / "sorted")).count() == 1300
    pieces = spark.read.parquet(str(tmp_path / "sorted")).groupBy(F.shiftright("place", 33)).count()
    assert pieces.agg(F.max("count")).first()[0] < 200


def test_layout_for_a_dated_write_keeps_ranks(spark, tmp_path):
    dated = with_natural_key(skewed(spark)).withColumn("event_date", F.col("transaction_date").cast("date"))
    dated.write.parquet(str(tmp_path / "keyed"))
    keyed = spark.read.parquet(str(tmp_path / "keyed"))
    hot = find_hot_groups(keyed, 3000, hot_rows=200)
    files = spark.createDataFrame(keyed.select("event_date", F.lit(7)).distinct().collect(), "event_date date, files int")
    laid_out = rank_duplicates(keyed, hot, files)
    assert ranks(laid_out) == ranks(rank_duplicates(keyed))
    plan = rank_duplicates(keyed, None, files)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    assert plan.count("Exchange hashpartitioning") == 1  # it serves the window and the write


def test_canonical_rows_equal_rank_one(spark):
    rows = skewed(spark)
    first = flag_duplicates(rows).filter("duplicate_rank = 1").select(*NATURAL_KEY)
    assert canonical_rows(rows).exceptAll(first).count() == 0
    assert canonical_rows(rows).count() == first.count()


def test_groups_and_duplicate_table(spark):
    rows = transactions(spark, ["TXN-1", "TXN-2", "TXN-3"], amount="5").unionAll(transactions(spark, ["TXN-4"]))
    group = duplicate_groups(rows).collect()
    assert [(g["group_rows"], g["canonical_transaction_id"]) for g in group] == [(3, "TXN-1")]
    audit = {"source": "csv", "batch_id": "b", "ingestion_timestamp": "2024-01-01T00:00:00Z"}
    table = duplicate_rows(flag_duplicates(with_audit_columns(rows, **audit)))
    assert ranks(table) == {"TXN-2": 2, "TXN-3": 3}
    assert "is_duplicate" not in table.columns


def test_id_collisions_keep_the_latest_event(spark):
    early = transactions(spark, ["TXN-1"])
    late = transactions(spark, ["TXN-1", "TXN-2"], transaction_date=datetime(2024, 1, 2))
    kept = resolve_id_collisions(with_natural_key(early.unionAll(late)))
    assert {(r["transaction_id"], r["transaction_date"].day) for r in kept.collect()} == {("TXN-1", 2), ("TXN-2", 2)}
