"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly into buckets of about `bucket_bytes`, by a seeded hash of the
record's place in the input, so equal records spread too. The bucket count follows the bytes. Pass
two brings each bucket into one task's memory, puts it into a defined order, and permutes it by a
Fisher-Yates shuffle seeded with the bucket's number. Buckets in order, each in its shuffled order,
are one random permutation of all records; it is cut into shards whose counts differ by one at most.

A lost task computes the same rows again: the place, the hash and each permutation are fixed by the
input. Null texts have no bytes; repeated rows and ids are records like any other; empty tables give
no rows; all columns of the records are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.tables import Scratch


@dataclass(frozen=True)
class Shuffle:
    shards: int = 40
    bucket_bytes: int = 16 << 20
    seed: int = 20240601


def record_size() -> F.Column:
    """Bytes of the text, and 16 for the record."""
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16


def shuffle_records(docs: DataFrame, scratch: Scratch, p: Shuffle = Shuffle()) -> DataFrame:
    """record, bucket and place: a random permutation of the records in order of bucket and place."""
    total = docs.select(F.sum(record_size())).first()[0] or 0
    buckets = max(1, -(-total // p.bucket_bytes))
    placed = docs.select(F.struct(*docs.columns).alias("record"), F.monotonically_increasing_id().alias("row"))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64(F.lit(p.seed), "row"), F.lit(buckets)))
    seed = p.seed

    def fisher_yates(rows: pa.Table) -> pa.Table:
        given = np.argsort(rows["row"].to_numpy())
        draw = np.random.default_rng([seed, rows["bucket"][0].as_py()])
        order = given[draw.permutation(rows.num_rows)]  # numpy's permutation is a Fisher-Yates shuffle
        columns = [rows["record"].take(pa.array(order)), rows["bucket"], pa.array(np.arange(rows.num_rows))]
        return pa.table(columns, names=["record", "bucket", "place"])

    schema = T.StructType([*placed.drop("row").schema.fields, T.StructField("place", T.LongType())])
    return scratch.put("buckets", placed.groupBy("bucket").applyInArrow(fisher_yates, schema))


def assign_shards(records: DataFrame, scratch: Scratch, shards: int) -> DataFrame:
    """The records with shard, and slot within it: gapless, and counts at most one apart."""
    counts = records.groupBy("bucket").agg(F.count("*").alias("n"))  # one row per bucket
    ordered = Window.orderBy("bucket")
    starts = counts.select(
        F.col("bucket").alias("b"),
        (F.sum("n").over(ordered) - F.col("n")).alias("start"),
        F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_all"),
    )
    # Stored, its size is known before the join is planned, so the records aren't shuffled in vain.
    starts = scratch.put("starts", starts)
    at = records.join(starts, F.col("bucket") == F.col("b")).withColumn("at", F.col("start") + F.col("place"))
    at = at.withColumn("shard", F.expr(f"int(at * {shards} div n_all)"))
    slot = F.expr(f"at - (shard * n_all + {shards - 1}) div {shards}")
    return at.select("record.*", "shard", slot.alias("slot"))


def shard_records(docs: DataFrame, scratch: Scratch, p: Shuffle = Shuffle()) -> DataFrame:
    """All columns of the records, with shard and slot; columns of those names are replaced."""
    return assign_shards(shuffle_records(docs.drop("shard", "slot"), scratch, p), scratch, p.shards)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its records in slot order."""
    spread = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
