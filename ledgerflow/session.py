"""Spark session, shared scratch folder and small driver-side files."""

from __future__ import annotations

import json
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_spark(app_name: str = "ledgerflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without the setting falls back to the machine's temporary
    folder; on a cluster that would lose data with a node, so it is refused.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return f"{tempfile.gettempdir()}/ledgerflow"
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def spread_small_input(rows: DataFrame) -> DataFrame:
    """Rows of a few input splits, such as one small file, spread over the cores.

    Work per row outweighs the exchange there. Input with splits for a fair share of the cores,
    which is any large input, is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() * 4 <= cores else rows


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, path)
    return bool(fs.exists(hadoop_path))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _hadoop_path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def read_text(spark: SparkSession, path: str) -> str:
    """One small file, such as a contract or a pointer, read whole on the driver."""
    fs, hadoop_path = _hadoop_path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, hadoop_path = _hadoop_path(spark, path)
    stream = fs.create(hadoop_path, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def rename_path(spark: SparkSession, source: str, target: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, source)
    return bool(fs.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(target)))


def write_json_report(spark: SparkSession, report: dict[str, Any], path: str) -> None:
    write_text(spark, path, json.dumps(report, indent=2, sort_keys=True, default=str))
