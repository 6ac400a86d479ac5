"""All-or-nothing append to a landing folder of CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.contract import Contract
from ledgerflow.operators.validate import validate
from ledgerflow.schema import FIELDS
from ledgerflow.session import path_exists
from ledgerflow.sources.csv_files import normalized_names


class RejectedBatch(ValueError):
    """A record of the batch is invalid, so none was appended."""


def append_records(raw: DataFrame, path: str, contract: Contract | None = None) -> int:
    """Validate every record, then append the text values under the target's own header; its other cells stay empty."""
    spark = raw.sparkSession
    checked = validate(raw, contract)
    counts = checked.agg(F.count(F.lit(1)).alias("read"), F.count_if(~F.col("is_valid")).alias("bad")).first()
    if counts["bad"]:
        example = checked.filter(~F.col("is_valid")).select("transaction_id", "errors").first()
        raise RejectedBatch(
            f"{counts['bad']} of {counts['read']} records are invalid, such as "
            f"{example['transaction_id']}: {'; '.join(example['errors'])}"
        )
    cells = [F.col(name) for name in FIELDS]
    if path_exists(spark, path):
        header = spark.read.option("header", True).csv(path).columns
        names = normalized_names(header)
        lacking = sorted(set(FIELDS) - set(names))
        if lacking:
            raise ValueError(f"the landing folder has no column for {', '.join(lacking)}")
        empty = F.lit(None).cast("string")
        cells = [(F.col(new) if new in FIELDS else empty).alias(old) for old, new in zip(header, names)]
    raw.select(*cells).write.mode("append").option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)
    return counts["read"]
