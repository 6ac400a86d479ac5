"""Ordered CSV exports of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerflow.schema import BRONZE, BRONZE_SCHEMA, DUPLICATES, DUPLICATES_COLUMNS, GOLD, GOLD_SCHEMA, QUARANTINE
from ledgerflow.schema import QUARANTINE_SCHEMA

EXPORT_COLUMNS = {
    BRONZE: BRONZE_SCHEMA.names,
    QUARANTINE: QUARANTINE_SCHEMA.names,
    DUPLICATES: DUPLICATES_COLUMNS,
    GOLD: GOLD_SCHEMA.names,
}


def export_table(table: DataFrame, name: str, path: str) -> None:
    """CSV part files whose concatenation is ordered by the first two columns."""
    if name not in EXPORT_COLUMNS:
        raise ValueError(f"no export is defined for {name!r}")
    columns = [column for column in EXPORT_COLUMNS[name] if column in table.columns]
    ordered = table.select(*columns).orderBy(*columns[:2])
    ordered.write.mode("overwrite").options(
        header=True, escape='"', emptyValue="", timestampNTZFormat="yyyy-MM-dd HH:mm:ss"
    ).csv(path)
