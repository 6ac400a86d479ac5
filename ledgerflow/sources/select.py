"""Choice of source, with a fallback for an unreachable API."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ledgerflow.plans.settings import Settings
from ledgerflow.session import delete_path, scratch_path
from ledgerflow.sources.csv_files import load_csv_transactions
from ledgerflow.sources.dated_landing import read_landed
from ledgerflow.sources.paged import FetchPage, HttpPages, RequestError, TransientError, read_paged

LOGGER = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadedTransactions:
    """``landed_path`` names the copy in the shared folder, where one was made."""

    rows: DataFrame
    resolved_source: str
    landed_path: str | None = None


def land(rows: DataFrame, path: str) -> DataFrame:
    """Write rows and read them back: errors surface here, lineage ends here."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _may_fall_back(error: Exception) -> bool:
    """Errors raised in a reader arrive as text, where the class name tells them apart."""
    if isinstance(error, (TransientError, RequestError)):
        return True
    kinds = (TransientError.__name__, RequestError.__name__)
    return isinstance(error, PySparkException) and any(f"{kind}:" in str(error) for kind in kinds)


def load_transactions(
    spark: SparkSession,
    settings: Settings,
    watermark: str | None = None,
    fetch_page: FetchPage | None = None,
) -> LoadedTransactions:
    """Raw records from the configured source.

    Reads are lazy, so API records are landed inside the ``try``: a failing page raises here,
    where the fallback can answer it, not in a later step.
    """
    if settings.source == "csv":
        return LoadedTransactions(_csv(spark, settings, watermark), "csv")
    path = scratch_path(spark, "landing")
    try:
        fetch = fetch_page or HttpPages(settings.api_base_url, settings.api_key)
        rows = read_paged(
            spark,
            fetch,
            watermark=watermark,
            page_size=settings.page_limit,
            parallelism=settings.api_parallelism,
        )
        return LoadedTransactions(land(rows, path), "api", path)
    except Exception as error:
        delete_path(spark, path)
        if not settings.allow_csv_fallback or not _may_fall_back(error):
            raise
        LOGGER.warning("the paged source gave no data (%s); reading the CSV files instead", type(error).__name__)
        return LoadedTransactions(_csv(spark, settings, watermark), "csv_fallback")


def _csv(spark: SparkSession, settings: Settings, watermark: str | None) -> DataFrame:
    if settings.landing_path:
        return read_landed(spark, settings.landing_path, watermark)
    return load_csv_transactions(spark, settings.csv_path, watermark, multi_line=settings.csv_multi_line)
