"""Business duplicates: rows equal in every field but the id."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.money import amount_text
from ledgerflow.functions.text import format_utc, hash_of, utc_date
from ledgerflow.schema import DUPLICATES_COLUMNS, NATURAL_KEY
from ledgerflow.session import scratch_path

# A group up to this size is ranked by one task; a larger one is spread over several.
HOT_GROUP_ROWS = 1_000_000
# Sizes of a heavy-hitter sketch; Spark holds no larger one.
LEAST_SKETCH_ITEMS = 1024
MOST_SKETCH_ITEMS = 1_000_000
# monotonically_increasing_id: the partition above these bits, the row number below.
ROW_BITS = 33


def natural_key_hash() -> Column:
    """Hash of the natural key in canonical text.

    Only the merchant name is free text, so the separator cannot make two keys look alike.
    """
    typed = {
        "transaction_date": format_utc(F.col("transaction_date")),
        "amount": amount_text(F.col("amount")),
    }
    return hash_of(*[typed.get(field, F.col(field)) for field in NATURAL_KEY])


def with_natural_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("natural_key_hash", natural_key_hash())


def find_hot_groups(keyed: DataFrame, rows_of_date: int, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """``natural_key_hash`` and ``rows`` of every group of more than ``hot_rows`` rows.

    Heavy-hitter sketches cost no shuffle of the keys: each task sends one of bounded size per date,
    and they are merged in two steps. ``rows_of_date``, the most rows a date has, sets their size: a
    sketch of n items reports every group above 5.25 / n of its rows (n items fill at most three
    quarters of its table, and its error is 3.5 rows in the table's size), so none above ``hot_rows``
    is missed. ``rows`` is an estimate that is never too small. Groups are few: at most one per
    ``hot_rows`` rows. A date too large for Spark's largest sketch has its groups counted.
    """
    items = max(LEAST_SKETCH_ITEMS, 6 * math.ceil(rows_of_date / hot_rows))
    if items > MOST_SKETCH_ITEMS:
        counted = keyed.groupBy("natural_key_hash").agg(F.count(F.lit(1)).alias("rows"))
        return counted.filter(F.col("rows") > hot_rows)
    lane = F.spark_partition_id() % 64
    partial = (
        keyed.select(utc_date(F.col("transaction_date")).alias("event_date"), "natural_key_hash")
        .groupBy("event_date", lane.alias("lane"))
        .agg(F.expr(f"approx_top_k_accumulate(natural_key_hash, {items})").alias("sketch"))
    )
    merged = partial.groupBy("event_date").agg(F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch"))
    heavy = merged.select(F.expr(f"inline(approx_top_k_estimate(sketch, {items}))"))
    found = heavy.select(F.col("item").alias("natural_key_hash"), F.col("count").alias("rows"))
    return found.filter(F.col("rows") > hot_rows)


def rank_duplicates(
    keyed: DataFrame,
    hot_groups: DataFrame | None = None,
    files_per_date: DataFrame | None = None,
    rows_per_piece: int = HOT_GROUP_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """Rank the rows of each natural key by (transaction_date, transaction_id); rank 1 is canonical.

    Most groups are ranked by one window. ``hot_groups`` (from :func:`find_hot_groups`, stored, as
    they are read several times) are ranked by position instead, see :func:`ranked_by_position`.
    They are broadcast: at most one per ``rows_per_piece`` rows of the table.

    ``files_per_date`` (``event_date``, ``files``) asks for rows laid out for a write partitioned
    by ``event_date``: the one shuffle then serves the ranking and the file layout.
    """
    hot_total = None if hot_groups is None else hot_groups.agg(F.sum("rows")).first()[0]
    if hot_total:
        listed = F.broadcast(hot_groups.select("natural_key_hash"))
        hot, others = (
            keyed.join(listed, "natural_key_hash", how).select(*keyed.columns) for how in ("left_semi", "left_anti")
        )
        hot = ranked_by_position(hot, math.ceil(hot_total / rows_per_piece) + 1, scratch)
        ranked = _ranked_by_window(others, files_per_date).unionByName(hot)
    else:
        ranked = _ranked_by_window(keyed, files_per_date)
    return ranked.withColumns(
        {"is_duplicate": F.col("duplicate_rank") > 1, "duplicate_group_id": F.col("natural_key_hash")}
    )


def _ranked_by_window(keyed: DataFrame, files_per_date: DataFrame | None) -> DataFrame:
    group = ["natural_key_hash"]
    if files_per_date is not None:
        slot = F.pmod(F.xxhash64("natural_key_hash"), F.col("files"))
        keyed = keyed.join(F.broadcast(files_per_date), "event_date").withColumn("slot", slot)
        keyed = keyed.repartition("event_date", "slot")
        group = ["event_date", "slot", *group]
    in_order = Window.partitionBy(*group).orderBy("transaction_date", "transaction_id")
    return keyed.withColumn("duplicate_rank", F.row_number().over(in_order).cast("bigint")).drop("slot", "files")


def ranked_by_position(keyed: DataFrame, pieces: int, scratch: str | None = None) -> DataFrame:
    """Ranks of a few groups of any size, without putting a group into one task.

    The rows are range-partitioned and sorted by group and id, so a group spans as many
    partitions as its size needs. A row's position in the whole order is the size of the
    partitions before its own plus its number there, and its rank is its position counted from
    the first of its group. The sorted rows are written once: positions must come from one and
    the same order even if a task runs twice.
    """
    spark = keyed.sparkSession
    path = scratch or scratch_path(spark, "hot-groups")
    order = ["natural_key_hash", "transaction_date", "transaction_id"]
    in_order = keyed.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
    in_order.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*keyed.schema.fields, T.StructField("place", T.LongType())])
    rows = spark.read.schema(schema).parquet(path).withColumns(
        {
            "piece": F.shiftright("place", ROW_BITS),
            "number": F.col("place").bitwiseAND((1 << ROW_BITS) - 1),
        }
    )
    # One small row per partition and, below, one per hot group.
    sizes = rows.groupBy("piece").agg(F.count(F.lit(1)).alias("size")).orderBy("piece").collect()
    starts = [0, *accumulate(row["size"] for row in sizes)]
    before = spark.createDataFrame(
        [(row["piece"], start) for row, start in zip(sizes, starts)], "piece bigint, rows_before bigint"
    )
    placed = rows.join(F.broadcast(before), "piece").withColumn("position", F.col("rows_before") + F.col("number"))
    first = placed.groupBy("natural_key_hash").agg(F.min("position").alias("first_position"))
    rank = F.col("position") - F.col("first_position") + 1
    return placed.join(F.broadcast(first), "natural_key_hash").select(
        *keyed.columns, rank.alias("duplicate_rank")
    )


def flag_duplicates(rows: DataFrame) -> DataFrame:
    """Hash and rank by one window, as a plan that runs nothing yet.

    For rows that may hold a group too large for one task, store the keyed rows, find the hot groups
    and give both to :func:`rank_duplicates`, as an ingestion does.
    """
    return rank_duplicates(with_natural_key(rows))


def duplicate_rows(bronze: DataFrame) -> DataFrame:
    """The duplicates table: a projection of bronze, so it can never disagree with it."""
    return bronze.filter(F.col("duplicate_rank") > 1).select(*DUPLICATES_COLUMNS)


def canonical_rows(rows: DataFrame) -> DataFrame:
    """One row per natural key, without its id, for callers that need no ranks.

    Rows of a group differ only in the id, so this is a distinct: copies collapse in the map
    tasks and nothing is sorted.
    """
    return rows.select(*NATURAL_KEY).distinct()


def duplicate_groups(rows: DataFrame) -> DataFrame:
    """Natural keys held by more than one row, with their size and canonical id."""
    keyed = rows if "natural_key_hash" in rows.columns else with_natural_key(rows)
    return (
        keyed.groupBy(F.col("natural_key_hash").alias("duplicate_group_id"))
        .agg(
            F.count(F.lit(1)).alias("group_rows"),
            F.min("transaction_id").alias("canonical_transaction_id"),
        )
        .filter("group_rows > 1")
    )


