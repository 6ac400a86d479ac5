"""The daily account summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.text import utc_date, utc_literal
from ledgerflow.schema import CURRENCIES, GOLD_COMPARED, MERCHANT_CATEGORIES, MONEY, STAGING_COLUMNS

ACCOUNT_DAY = ["account_id", "transaction_date"]


def staging_view(bronze: DataFrame) -> DataFrame:
    return bronze.select(*STAGING_COLUMNS)


def completed_rows(rows: DataFrame) -> DataFrame:
    """Completed rows as the summary needs them; the timestamp becomes its UTC date."""
    return rows.filter(F.col("status") == "completed").select(
        "account_id",
        utc_date(F.col("transaction_date")).alias("transaction_date"),
        "amount",
        "currency",
        "transaction_type",
        "merchant_name",
        "merchant_category",
    )


def completed_canonical(bronze: DataFrame) -> DataFrame:
    return completed_rows(bronze.filter(~F.col("is_duplicate")))


def _amount_of(transaction_type: str) -> Column:
    return F.when(F.col("transaction_type") == transaction_type, F.col("amount"))


def _money(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast(MONEY)


def _code(column: str, codes: dict[str, int]) -> Column:
    """The number that stands for a value of a fixed list; a value outside it stops the job."""
    code = reduce(lambda chain, item: chain.when(F.col(column) == item[0], item[1]), codes.items(), F)
    return code.otherwise(F.raise_error(F.concat(F.lit(f"unknown {column}: "), F.col(column))).cast("int"))


def _name(code: Column, codes: dict[str, int]) -> Column:
    return reduce(lambda chain, item: chain.when(code == item[1], item[0]), codes.items(), F)


def _bits(names: Sequence[str]) -> dict[str, int]:
    return {name: 1 << place for place, name in enumerate(sorted(names))}


def _from_cents(total: Column) -> Column:
    return (F.coalesce(total, F.lit(0)).cast("decimal(20,0)") / 100).cast(MONEY)


def summarize(
    completed: DataFrame,
    currencies: Sequence[str] = CURRENCIES,
    categories: Sequence[str] = MERCHANT_CATEGORIES,
) -> DataFrame:
    """Account/day totals in one scan.

    The first aggregation groups every row by category and by merchant at once. Both are partial
    in the map tasks and spread a busy account/day over its categories and merchants; merchants
    are then counted, never gathered into a set. The second aggregation sees at most one row per
    category or merchant of a task's share.

    All state is fixed-width numbers, so both aggregate by hash without sorting: money in cents,
    the currencies of a day as bits, and the top category as the largest of spend followed by
    place, where a smaller name has the larger place and so wins a tie.
    """
    bits = _bits(currencies)
    places = {name: place for place, name in enumerate(sorted(categories, reverse=True))}
    rows = completed.withColumns(
        {
            "amount": (F.col("amount") * 100).cast("bigint"),
            "currency_bit": _code("currency", bits),
        }
    )
    parts = rows.groupingSets(
        [[*ACCOUNT_DAY, "merchant_category"], [*ACCOUNT_DAY, "merchant_name"]],
        *ACCOUNT_DAY,
        "merchant_category",
        "merchant_name",
    ).agg(
        (F.grouping("merchant_name") == 1).alias("is_category"),
        F.sum(_amount_of("debit")).alias("debit"),
        F.sum(_amount_of("credit")).alias("credit"),
        F.count(F.lit(1)).alias("rows"),
        F.bit_or("currency_bit").alias("currency_bits"),
    )
    is_category = F.col("is_category")
    spend = F.col("debit").cast("decimal(30,0)") * 100 + _code("merchant_category", places)
    daily = parts.groupBy(*ACCOUNT_DAY).agg(
        F.sum(F.when(is_category, F.col("debit"))).alias("debit"),
        F.sum(F.when(is_category, F.col("credit"))).alias("credit"),
        F.sum(F.when(is_category, F.col("rows"))).alias("transaction_count"),
        F.count_if(~is_category).alias("distinct_merchants"),
        F.max(F.when(is_category, spend)).alias("top_spend"),
        F.bit_or("currency_bits").alias("currency_bits"),
    )
    held = [F.when(F.col("currency_bits").bitwiseAND(bit) != 0, name) for name, bit in bits.items()]
    return daily.select(
        *ACCOUNT_DAY,
        _from_cents(F.col("debit")).alias("total_debit_amount"),
        _from_cents(F.col("credit")).alias("total_credit_amount"),
        "transaction_count",
        "distinct_merchants",
        _name(F.col("top_spend") % 100, places).alias("top_category"),
        F.concat_ws(",", *held).alias("currencies"),
    ).select("*", _net().alias("net_amount")).select(*GOLD_COMPARED)


def _net() -> Column:
    return (F.col("total_credit_amount") - F.col("total_debit_amount")).cast(MONEY)


def daily_summary(bronze: DataFrame, updated_at: str | None = None) -> DataFrame:
    gold = summarize(completed_canonical(bronze))
    return gold if updated_at is None else gold.withColumn("updated_at", utc_literal(updated_at))


def category_totals(completed: DataFrame) -> DataFrame:
    """Debit spend per category, ranked within the account/day; ties go to the smaller name."""
    by_spend = Window.partitionBy(*ACCOUNT_DAY).orderBy(F.desc("category_amount"), "merchant_category")
    return (
        completed.filter(F.col("transaction_type") == "debit")
        .groupBy(*ACCOUNT_DAY, "merchant_category")
        .agg(F.sum("amount").cast(MONEY).alias("category_amount"))
        .withColumn("category_rank", F.row_number().over(by_spend))
    )


def daily_totals(completed: DataFrame) -> DataFrame:
    """Account/day totals without the top category."""
    return (
        completed.groupBy(*ACCOUNT_DAY)
        .agg(
            _money(F.sum(_amount_of("debit"))).alias("total_debit_amount"),
            _money(F.sum(_amount_of("credit"))).alias("total_credit_amount"),
            F.count(F.lit(1)).alias("transaction_count"),
            F.count_distinct("merchant_name").alias("distinct_merchants"),
            F.array_join(F.array_sort(F.collect_set("currency")), ",").alias("currencies"),
        )
        .withColumn("net_amount", _net())
    )


def summarize_with_join(completed: DataFrame) -> DataFrame:
    """The same summary as totals left-joined to the top-ranked category.

    It reads its input twice; :func:`summarize` is the one to use. It stands as an independent
    second form for checks.
    """
    top = (
        category_totals(completed)
        .filter("category_rank = 1")
        .select(*ACCOUNT_DAY, F.col("merchant_category").alias("top_category"))
    )
    return daily_totals(completed).join(top, ACCOUNT_DAY, "left").select(*GOLD_COMPARED)


def multi_currency_days(bronze: DataFrame, currencies: Sequence[str] = CURRENCIES) -> DataFrame:
    """Account/days with more than one currency, with their number."""
    held = completed_canonical(bronze).groupBy(*ACCOUNT_DAY).agg(
        F.bit_or(_code("currency", _bits(currencies))).alias("currency_bits")
    )
    return held.select(*ACCOUNT_DAY, F.bit_count("currency_bits").alias("currency_count")).filter(
        "currency_count > 1"
    )
