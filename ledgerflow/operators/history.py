"""State that is appended to: newest attempts, where ids are stored, what changed, when groups were seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(log: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The newest row of each key of an append-only log, without ``version``.

    A maximum, so attempts of one key are combined before the shuffle and none is sorted.
    """
    rest = [name for name in log.columns if name not in (*keys, version)]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("newest"))
    return newest.select(*[F.col(name) if name in keys else F.col(f"newest.{name}") for name in log.columns if name != version])


def match_ids(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Per id of a batch: how many rows it has, its latest event's date, and the date it is stored under.

    ``stored`` has ``transaction_id`` and ``event_date``, one row per id. Of a batch's rows with one id
    the latest event counts, then the largest natural key, as when they are resolved.
    """
    order = F.struct("transaction_date", "natural_key_hash", "event_date")
    ids = batch.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("copies"), F.max(order).alias("last"))
    dates = stored.select("transaction_id", F.col("event_date").alias("stored_date"))
    return ids.join(dates, "transaction_id", "left").select(
        "transaction_id", "copies", F.col("last.event_date").alias("event_date"), "stored_date"
    )


def moved_ids(matched: DataFrame) -> DataFrame:
    """Ids stored under another date than the batch's."""
    return matched.filter("stored_date <> event_date").select("transaction_id", "stored_date", "event_date")


def snapshot_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows that differ between two versions of a table with unique keys, as ``change`` and the row.

    An inserted or changed row is shown as it is after, a removed one as it was. Equal rows fall out in the
    join's own stage; nothing is compared by the driver.
    """
    columns = after.columns
    old = before.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = after.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
    change = (
        F.when(F.col("_old_key").isNull(), "inserted").when(F.col("_new_key").isNull(), "removed").otherwise("changed")
    )
    differ = both.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        change.alias("change"), F.coalesce("_new", "_old").alias("row")
    )
    return differ.select("change", "row.*")


def groups_seen(bronze: DataFrame) -> DataFrame:
    """Duplicate groups of bronze with the first and last ingestion among their rows."""
    return (
        bronze.groupBy("natural_key_hash", "event_date")
        .agg(
            F.count(F.lit(1)).alias("group_rows"),
            F.min("ingestion_timestamp").alias("first_seen"),
            F.max("ingestion_timestamp").alias("last_seen"),
        )
        .filter("group_rows > 1")
    )


def merge_groups_seen(known: DataFrame, seen: DataFrame) -> DataFrame:
    """History of groups after another look: the earliest and the latest sight, and the newest size.

    A row that is read again carries a new ingestion time, so only the kept history knows the first one. A
    group that is no more keeps its last state.
    """
    turns = known.withColumn("_turn", F.lit(0)).unionByName(seen.withColumn("_turn", F.lit(1)))
    return turns.groupBy("natural_key_hash", "event_date").agg(
        F.max_by("group_rows", "_turn").alias("group_rows"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
