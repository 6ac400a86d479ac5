"""Landing by event date, so that an incremental read opens the dates it needs and no others.

Batches are written as Parquet to ``event_date=<date>/batch=<id>``; records with an unreadable date go to
the folder of the null date. A reader lists the date folders, one name per date, and opens those at or
after its bound and that of the null date: files of older dates are neither listed nor read. The bound
itself is then applied row by row.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.text import parse_utc, utc_date
from ledgerflow.operators.watermark import rows_since, strict_watermark
from ledgerflow.schema import FIELDS, METADATA_FIELDS
from ledgerflow.session import delete_path, list_names, path_exists, rename_path, scratch_path

NULL_DATE = "__HIVE_DEFAULT_PARTITION__"
# Parts that the rows of a date are dealt to, so that a batch of one day isn't one task's either.
PARTS_A_DATE = 16
# At most so many shuffle partitions are written to without sorting rows in memory.
MOST_SHUFFLED = 200
BATCH_NAME = re.compile(r"[A-Za-z0-9._-]+")
RAW_TYPE = T.StructType(
    [
        *(T.StructField(name, T.StringType()) for name in (*FIELDS, *METADATA_FIELDS)),
        T.StructField("field_names", T.ArrayType(T.StringType())),
        T.StructField("raw_payload", T.StringType()),
    ]
)


def land_by_date(raw: DataFrame, path: str, batch: str) -> list[str]:
    """Add a batch of raw records; returns the names of its date folders.

    The batch is written aside first and then moved in, one folder a date, so a reader never sees a part
    of a file. Landing a batch again replaces it. A task sorts the rows it writes by date; they are dealt
    out by date before, in shares that Spark bounds in bytes, so what a task sorts doesn't grow with the batch.
    """
    if not BATCH_NAME.fullmatch(batch):
        raise ValueError("a batch is named with letters, digits, dots, dashes and underscores")
    spark = raw.sparkSession
    aside = scratch_path(spark, "landing")
    dated = raw.select(*RAW_TYPE.names).withColumn("event_date", utc_date(parse_utc(F.col("transaction_date"))))
    try:
        part = F.pmod(F.xxhash64("raw_payload"), F.lit(PARTS_A_DATE))
        shares = dated.withColumn("part", part).hint("rebalance", MOST_SHUFFLED, "event_date", "part").drop("part")
        shares.write.partitionBy("event_date").parquet(aside)
        names = [name for name in list_names(spark, aside) if name.startswith("event_date=")]
        for name in list_names(spark, path):
            if path_exists(spark, f"{path}/{name}/batch={batch}"):
                delete_path(spark, f"{path}/{name}/batch={batch}")
        for name in names:
            _move(spark, f"{aside}/{name}", f"{path}/{name}", f"batch={batch}")
    finally:
        delete_path(spark, aside)
    return names


def _move(spark: SparkSession, source: str, folder: str, name: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    if not rename_path(spark, source, f"{folder}/{name}"):
        raise OSError(f"can't move a landed folder to {folder}/{name}")


def landed_folders(spark: SparkSession, path: str, since: date | None) -> list[str]:
    """Date folders at or after a date, and that of unreadable dates."""
    names = [name for name in list_names(spark, path) if name.startswith("event_date=")]
    wanted = [n for n in names if since is None or n.endswith(NULL_DATE) or n.split("=")[1] >= since.isoformat()]
    return [f"{path}/{name}" for name in wanted]


def read_landed(spark: SparkSession, path: str, watermark: str | None = None) -> DataFrame:
    """Raw records at or after the watermark, and those with an unreadable date."""
    since = strict_watermark(watermark).date() if watermark else None
    folders = landed_folders(spark, path, since)
    if not folders:
        return spark.createDataFrame([], RAW_TYPE)
    rows = spark.read.schema(RAW_TYPE).option("basePath", path).parquet(*folders).select(*RAW_TYPE.names)
    return rows_since(rows, watermark)
