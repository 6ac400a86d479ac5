"""Incremental ingestion of files as they arrive.

Each micro-batch goes through the batch ingestion: late rows are merged by id like any other, so
no streaming watermark drops them. The last epoch of a stream is a row of the control table, published
with the epoch's data, so an epoch that Spark delivers again, after a failure between the publication and its
own checkpoint, is skipped instead of merged a second time.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.operators.watermark import advance_watermark, control_row
from ledgerflow.plans.ingest import ingest_into, settings_contract
from ledgerflow.plans.run import transform_into
from ledgerflow.plans.settings import Settings
from ledgerflow.plans.store import TableStore
from ledgerflow.schema import CONTROL
from ledgerflow.sources.json_records import json_records
from ledgerflow.sources.select import LoadedTransactions


def last_epoch(control: DataFrame, stream: str) -> int:
    """The newest published epoch of a stream, -1 before the first."""
    row = control.filter(F.col("pipeline_name") == f"stream:{stream}").select("last_run_batch_id").first()
    return int(row[0]) if row else -1


def ingest_micro_batch(
    spark: SparkSession,
    settings: Settings,
    report: Callable[[dict[str, Any]], None] | None = None,
    stream: str = "files",
) -> Callable[[DataFrame, int], None]:
    """The function of ``foreachBatch``. ``stream`` names the stream's epochs, which start at 0 with its checkpoint."""
    contract = settings_contract(spark, settings)

    def ingest(lines: DataFrame, epoch: int) -> None:
        change = TableStore(spark, settings.store_path).begin()
        if epoch <= last_epoch(change.read(CONTROL), stream):
            return
        ledger = {"pipeline_name": f"stream:{stream}", "source": settings.source, "last_run_batch_id": str(epoch)}
        change.stage(CONTROL, advance_watermark(change.read(CONTROL), control_row(spark, ledger)))
        loaded = LoadedTransactions(json_records(lines, "value"), "stream")
        summary = ingest_into(
            change, settings, "incremental", contract=contract, loaded=loaded, batch_id=f"{stream}-{epoch}"
        )
        transform_into(change, settings)
        change.commit()
        if report:
            report(summary)

    return ingest


def stream_json_files(
    spark: SparkSession,
    path: str,
    settings: Settings,
    checkpoint: str,
    report: Callable[[dict[str, Any]], None] | None = None,
) -> StreamingQuery:
    """Ingest the JSON-lines files that are there and have not been ingested, then stop; the checkpoint names the stream."""
    lines = spark.readStream.text(path)
    return (
        lines.writeStream.foreachBatch(ingest_micro_batch(spark, settings, report, checkpoint.rstrip("/").split("/")[-1]))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
