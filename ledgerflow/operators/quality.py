"""Data-quality rules and their report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.gold import ACCOUNT_DAY, daily_summary
from ledgerflow.operators.reconcile import unreconciled_days
from ledgerflow.schema import ALLOWED_VALUES, GOLD_COMPARED, GOLD_SCHEMA, MONEY
from ledgerflow.session import write_json_report


class QualityError(AssertionError):
    """Raised after the report is written, naming every failed rule."""


@dataclass(frozen=True)
class RowRule:
    """``violated`` is true for a failing row; NULL passes."""

    name: str
    violated: Column


def not_null(column: str, prefix: str = "") -> RowRule:
    return RowRule(f"{prefix}{column}_not_null", F.col(column).isNull())


def accepted_values(column: str, values: Sequence[Any], prefix: str = "") -> RowRule:
    return RowRule(f"{prefix}{column}_accepted_values", ~F.col(column).isin(*values))


def expression_is_true(name: str, expression: str | Column) -> RowRule:
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return RowRule(name, ~condition)


def check_rows(table: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Failing rows per rule, all rules of a table in one scan: ``(name, failed_rows)``."""
    totals = table.agg(*[F.count_if(rule.violated).alias(f"r{i}") for i, rule in enumerate(rules)])
    results = F.array(
        *[F.struct(F.lit(rule.name).alias("name"), F.col(f"r{i}").alias("failed_rows")) for i, rule in enumerate(rules)]
    )
    return totals.select(F.inline(results))


def repeated_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Counting combines in the map tasks, so hot keys are cheap."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def check_unique(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _counted(repeated_keys(table, keys), name)


def _counted(failing: DataFrame, name: str) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failed_rows")).select(F.lit(name).alias("name"), "failed_rows")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with ``surplus`` = copies in left minus copies in right.

    A signed union needs one shuffle where two EXCEPT ALL need four, and it combines copies first.
    """
    columns = left.columns
    signed = left.withColumn("_sign", F.lit(1)).unionAll(right.select(*columns).withColumn("_sign", F.lit(-1)))
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("surplus")).filter("surplus <> 0")


def check_equal(actual: DataFrame, expected: DataFrame, name: str) -> DataFrame:
    """Size of the symmetric multiset difference."""
    failed = multiset_difference(actual, expected).agg(
        F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("failed_rows")
    )
    return failed.select(F.lit(name).alias("name"), "failed_rows")


def _report(parts: Sequence[DataFrame]) -> DataFrame:
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("passed", F.col("failed_rows") == 0)


def staging_checks(staging: DataFrame) -> DataFrame:
    required = [
        "transaction_id", "account_id", "transaction_date", "currency", "transaction_type", "status", "is_duplicate"
    ]
    limited = ["currency", "transaction_type", "status"]
    rules = [not_null(column, "stg_") for column in required]
    rules += [accepted_values(column, ALLOWED_VALUES[column], "stg_") for column in limited]
    rules.append(accepted_values("is_duplicate", [True, False], "stg_"))
    return _report(
        [check_rows(staging, rules), check_unique(staging, ["transaction_id"], "stg_transaction_id_unique")]
    )


def gold_model_checks(gold: DataFrame) -> DataFrame:
    """Tests declared on the summary table."""
    required = [name for name in GOLD_SCHEMA.names if name not in ("top_category", "currencies", "updated_at")]
    required += [name for name in ("currencies", "updated_at") if name in gold.columns]
    rules = [not_null(column, "model_") for column in required]
    rules.append(expression_is_true("model_transaction_count_at_least_one", "transaction_count >= 1"))
    return _report([check_rows(gold, rules), check_unique(gold, ACCOUNT_DAY, "model_account_date_unique")])


def gold_assertions(gold: DataFrame, bronze: DataFrame) -> DataFrame:
    """Six assertions on the summary, the last one a full reconciliation with bronze."""
    rules = [
        RowRule("gold_account_id_not_null", F.col("account_id").isNull()),
        RowRule("gold_transaction_date_not_null", F.col("transaction_date").isNull()),
        RowRule("gold_transaction_count_positive", F.col("transaction_count") < 1),
        RowRule(
            "gold_net_amount_matches_credit_minus_debit",
            F.col("net_amount") != (F.col("total_credit_amount") - F.col("total_debit_amount")).cast(MONEY),
        ),
    ]
    return _report(
        [
            check_rows(gold, rules),
            check_unique(gold, ACCOUNT_DAY, "gold_account_date_unique"),
            check_equal(
                gold.select(*GOLD_COMPARED),
                daily_summary(bronze),
                "gold_matches_completed_non_duplicate_bronze",
            ),
        ]
    )


def control_totals(gold: DataFrame, bronze: DataFrame) -> DataFrame:
    """Account days whose gold isn't borne out by totals computed another way than gold is."""
    return _report([_counted(unreconciled_days(gold, bronze), "gold_control_totals_match_bronze")])


def run_assertions(report: DataFrame, output_path: str | None = None) -> dict[str, Any]:
    """Evaluate a report (one row per rule), write it, then raise if a rule failed."""
    rows = [row.asDict() for row in report.collect()]
    result = {"passed": all(row["passed"] for row in rows), "assertions": rows}
    if output_path is not None:
        write_json_report(report.sparkSession, result, output_path)
    failed = [row["name"] for row in rows if not row["passed"]]
    if failed:
        raise QualityError(f"Data quality assertions failed: {', '.join(failed)}")
    return result
