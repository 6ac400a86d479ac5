"""The profile of bronze as mergeable state: one row per date, so that a run looks at the dates it touches only.

Duplicate groups and account/days never cross a date, so all counts of the profile add up over dates, and
the distributions do too. Distinct accounts don't: each date holds a sketch of them, whose union is an
estimate (about 2 % off, never more bytes than a few thousand a date). Who needs them exactly passes a count.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import format_utc, utc_date
from ledgerflow.operators.profile import DISTRIBUTED, profile_rows
from ledgerflow.operators.validate import invalid_by_rule
from ledgerflow.schema import ALLOWED_VALUES, CURRENCIES

COUNTS = (
    "valid_records",
    "canonical_valid_records",
    "duplicate_records",
    "duplicate_group_count",
    "multi_currency_account_dates",
)


def profile_state(bronze: DataFrame) -> DataFrame:
    """One row per date of bronze, in one scan: counts, range, counts of each value and a sketch of accounts.

    Rows are added up per account and date first, within the map tasks, then per date; a value that isn't
    in its list, of which bronze has none, is in no distribution.
    """
    values = [(column, value) for column in DISTRIBUTED for value in sorted(ALLOWED_VALUES[column])]
    counted = F.col("status").eqNullSafe("completed") & ~F.col("is_duplicate")
    bit = reduce(lambda code, item: code.when(F.col("currency") == item[1], 1 << item[0]), enumerate(sorted(CURRENCIES)), F)
    per_account = bronze.groupBy(utc_date(F.col("transaction_date")).alias("event_date"), "account_id").agg(
        F.count(F.lit(1)).alias("valid_records"),
        F.count_if(~F.col("is_duplicate")).alias("canonical_valid_records"),
        F.count_if("is_duplicate").alias("duplicate_records"),
        F.count_if(F.col("duplicate_rank") == 2).alias("duplicate_group_count"),
        F.bit_or(F.when(counted, bit)).alias("currencies"),
        F.min("transaction_date").alias("first_event"),
        F.max("transaction_date").alias("last_event"),
        *[F.count_if(F.col(column) == value).alias(f"{column}={value}") for column, value in values],
    )
    spread = F.array(
        *[
            F.struct(F.lit(column).alias("column_name"), F.lit(value).alias("value"), F.sum(f"{column}={value}").alias("row_count"))
            for column, value in values
        ]
    )
    return per_account.groupBy("event_date").agg(
        *[F.sum(name).alias(name) for name in COUNTS[:-1]],
        F.count_if(F.bit_count("currencies") > 1).alias("multi_currency_account_dates"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.hll_sketch_agg("account_id").alias("accounts"),
        spread.alias("distributions"),
    )


def replace_dates(known: DataFrame, fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """State after a run: the touched dates (`event_date`, each once) as they are now, all others as they were.

    A touched date that has no row any more has no state either.
    """
    return known.join(touched, "event_date", "left_anti").unionByName(fresh.join(touched, "event_date", "left_semi"))


def profile_from_state(
    state: DataFrame,
    quarantine: DataFrame,
    gold: DataFrame,
    accounts: DataFrame | None = None,
    rules: Callable[[DataFrame], DataFrame] = invalid_by_rule,
) -> DataFrame:
    """The profile as `build_profile` gives it, without a look at bronze.

    `accounts`, one row with `account_count`, is the exact number of accounts; else it is estimated.
    """
    summary = state.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTS],
        format_utc(F.min("first_event")).alias("min_transaction_date"),
        format_utc(F.max("last_event")).alias("max_transaction_date"),
    )
    if accounts is None:
        estimate = F.hll_sketch_estimate(F.hll_union_agg("accounts"))
        accounts = state.agg(F.coalesce(estimate, F.lit(0)).alias("account_count"))
    values = state.select(F.inline("distributions")).groupBy("column_name", "value").agg(F.sum("row_count").alias("row_count"))
    days = summary.select("multi_currency_account_dates")
    return profile_rows(summary, accounts, days, values.filter("row_count > 0"), quarantine, gold, rules)
