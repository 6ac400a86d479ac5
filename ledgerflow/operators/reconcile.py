"""Control totals of gold, taken from bronze by a route of their own.

Gold is checked against totals that share nothing with the way it is built: no category or merchant cells,
no currency bits, no maxima. Each account day has a row count, two signed sums in cents and two order-free
digests, the exclusive or of hashes of its distinct merchants and currencies. The same totals are read off
the gold rows, and the two sides are subtracted in one aggregation. A defect in the summary can't hide by
being made twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["account_id", "transaction_date"]
TOTALS = ["transactions", "debit_cents", "credit_cents", "net_cents", "merchants", "currency_digest"]


def _cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def bronze_totals(bronze: DataFrame) -> DataFrame:
    """Totals per account day of the first row of each duplicate group that is completed.

    Distinct values are found by a grouping of their own before they are folded, so a merchant with any
    number of rows counts once without a set being held.
    """
    rows = bronze.filter("duplicate_rank = 1 AND status = 'completed'").select(
        "account_id",
        F.to_date("transaction_date").alias("transaction_date"),
        "merchant_name",
        "currency",
        F.when(F.col("transaction_type") == "debit", _cents(F.col("amount"))).otherwise(0).alias("debit"),
        F.when(F.col("transaction_type") == "credit", _cents(F.col("amount"))).otherwise(0).alias("credit"),
    )
    sums = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("debit").alias("debit_cents"),
        F.sum("credit").alias("credit_cents"),
        (F.sum("credit") - F.sum("debit")).alias("net_cents"),
    )
    merchants = rows.select(*KEYS, "merchant_name").distinct().groupBy(*KEYS).agg(F.count(F.lit(1)).alias("merchants"))
    currencies = rows.select(*KEYS, "currency").distinct().groupBy(*KEYS).agg(
        F.bit_xor(F.xxhash64("currency")).alias("currency_digest")
    )
    return sums.join(merchants, KEYS).join(currencies, KEYS)


def gold_totals(gold: DataFrame) -> DataFrame:
    """The same totals as the gold rows state them."""
    hashes = F.transform(F.split("currencies", ","), lambda code: F.xxhash64(code))
    digest = F.aggregate(hashes, F.lit(0).cast("bigint"), lambda total, h: total.bitwiseXOR(h))
    return gold.select(
        *KEYS,
        F.col("transaction_count").alias("transactions"),
        _cents(F.col("total_debit_amount")).alias("debit_cents"),
        _cents(F.col("total_credit_amount")).alias("credit_cents"),
        _cents(F.col("net_amount")).alias("net_cents"),
        F.col("distinct_merchants").alias("merchants"),
        digest.alias("currency_digest"),
    )


def unreconciled_days(gold: DataFrame, bronze: DataFrame) -> DataFrame:
    """Account days whose gold isn't borne out by bronze: the key, which totals differ, and on which side a row is."""
    actual = gold_totals(gold).withColumn("_gold", F.lit(1))
    expected = bronze_totals(bronze).withColumn("_gold", F.lit(0))
    both = actual.unionByName(expected)

    def side(name: str, which: int) -> Column:
        return F.max(F.when(F.col("_gold") == which, F.col(name)))

    folded = both.groupBy(*KEYS).agg(
        F.sum("_gold").alias("gold_rows"),
        F.sum(1 - F.col("_gold")).alias("bronze_rows"),
        *[(~side(name, 1).eqNullSafe(side(name, 0))).alias(name) for name in TOTALS],
    )
    differing = F.array_join(F.array_compact(F.array(*[F.when(F.col(name), F.lit(name)) for name in TOTALS])), ",")
    found = folded.filter((F.col("gold_rows") != 1) | (F.col("bronze_rows") != 1) | (differing != ""))
    return found.select(*KEYS, "gold_rows", "bronze_rows", differing.alias("differing"))
