"""Table profile: counts, ranges and distributions, one scan per table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import format_utc
from ledgerflow.operators.gold import multi_currency_days
from ledgerflow.operators.validate import invalid_by_rule

DISTRIBUTED = ("status", "currency", "transaction_type")


def value_distribution(rows: DataFrame, columns: tuple[str, ...] = DISTRIBUTED) -> DataFrame:
    """``(column_name, value, row_count)`` of several columns in one pass with partial counts."""
    counted = rows.groupingSets([[name] for name in columns], *columns).agg(
        F.grouping_id(*columns).alias("set"), F.count(F.lit(1)).alias("row_count")
    )
    # In the grouping id, the bit of the column that is grouped by is the only one not set.
    full = (1 << len(columns)) - 1
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for place, column in enumerate(columns):
        is_set = F.col("set") == (full & ~(1 << (len(columns) - 1 - place)))
        name = F.when(is_set, F.lit(column)).otherwise(name)
        value = F.when(is_set, F.col(column).cast("string")).otherwise(value)
    return counted.select(name.alias("column_name"), value.alias("value"), "row_count")


def bronze_summary(bronze: DataFrame) -> DataFrame:
    """One row. Each duplicate group has exactly one row of rank 2, which counts the groups."""
    return bronze.agg(
        F.count(F.lit(1)).alias("valid_records"),
        F.count_if(~F.col("is_duplicate")).alias("canonical_valid_records"),
        F.count_if("is_duplicate").alias("duplicate_records"),
        F.count_if(F.col("duplicate_rank") == 2).alias("duplicate_group_count"),
        format_utc(F.min("transaction_date")).alias("min_transaction_date"),
        format_utc(F.max("transaction_date")).alias("max_transaction_date"),
    )


def account_count(bronze: DataFrame, approximate: bool = False) -> DataFrame:
    counted = F.approx_count_distinct("account_id") if approximate else F.count_distinct("account_id")
    return bronze.agg(counted.alias("account_count"))


def _row_count(table: DataFrame, name: str) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias(name))


def _long(section: str | Column, key: str | Column, value: Column) -> list[Column]:
    section = F.lit(section) if isinstance(section, str) else section
    key = F.lit(key) if isinstance(key, str) else key
    return [section.alias("section"), key.alias("key"), value.cast("string").alias("value")]


def _unpivot(one_row: DataFrame, sections: dict[str, str]) -> DataFrame:
    cells = F.array(*[F.struct(*_long(section, key, F.col(key))) for key, section in sections.items()])
    return one_row.select(F.inline(cells))


def build_profile(
    bronze: DataFrame,
    quarantine: DataFrame,
    gold: DataFrame,
    rules: Callable[[DataFrame], DataFrame] = invalid_by_rule,
) -> DataFrame:
    """The profile as rows ``(section, key, value)``; ``rules`` counts the failures of quarantine."""
    days = _row_count(multi_currency_days(bronze), "multi_currency_account_dates")
    return profile_rows(
        bronze_summary(bronze), account_count(bronze), days, value_distribution(bronze), quarantine, gold, rules
    )


def profile_rows(
    summary: DataFrame,
    accounts: DataFrame,
    days: DataFrame,
    distribution: DataFrame,
    quarantine: DataFrame,
    gold: DataFrame,
    rules: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The rows of the profile from its parts."""
    parts = [
        _unpivot(
            summary,
            {
                "valid_records": "row_counts",
                "canonical_valid_records": "row_counts",
                "duplicate_records": "row_counts",
                "min_transaction_date": "date_range",
                "max_transaction_date": "date_range",
                "duplicate_group_count": "scalars",
            },
        ),
        _unpivot(accounts, {"account_count": "scalars"}),
        _unpivot(_row_count(quarantine, "quarantined_records"), {"quarantined_records": "row_counts"}),
        _unpivot(_row_count(gold, "gold_daily_summary_rows"), {"gold_daily_summary_rows": "row_counts"}),
        _unpivot(days, {"multi_currency_account_dates": "scalars"}),
        distribution.select(
            *_long(F.concat("column_name", F.lit("_distribution")), F.col("value"), F.col("row_count"))
        ),
        rules(quarantine).select(*_long("invalid_count_by_rule", F.col("rule"), F.col("failures"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_report(profile: DataFrame) -> dict[str, Any]:
    """The profile as a nested report.

    Built with ``invalid_by_kind``, its size follows the rules and value lists, not the data.
    """
    report: dict[str, Any] = {f"{column}_distribution": {} for column in DISTRIBUTED}
    report |= {"row_counts": {}, "date_range": {}, "invalid_count_by_rule": {}}
    for section, key, value in profile.collect():
        if section == "scalars":
            report[key] = int(value)
        elif section == "date_range":
            report[section][key] = value
        else:
            report[section][key] = int(value)
    return report
