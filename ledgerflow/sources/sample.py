"""Check of one small page of a source against the contract."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.contract import Contract
from ledgerflow.operators.validate import validate
from ledgerflow.sources.paged import FetchPage, read_paged


def sample_summary(sample: DataFrame, contract: Contract | None) -> DataFrame:
    """One row for a bounded sample: counts, verdict and the sampled ids."""
    return validate(sample, contract).agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("quarantined_records"),
        F.array_sort(F.collect_list("transaction_id")).alias("sample_transaction_ids"),
    )


def check_source_sample(
    spark: SparkSession, fetch_page: FetchPage, contract: Contract | None = None, limit: int = 5
) -> dict[str, Any]:
    """Read one page of ``limit`` records; raise if it is empty or holds an invalid record."""
    page = read_paged(spark, fetch_page, page_size=limit, max_pages=1).limit(limit)
    summary = sample_summary(page, contract).first().asDict()
    if summary["records_read"] == 0:
        raise RuntimeError("the source returned no records")
    summary["passed"] = summary["quarantined_records"] == 0
    if not summary["passed"]:
        raise RuntimeError(f"source sample failed validation: {json.dumps(summary, sort_keys=True)}")
    return summary
