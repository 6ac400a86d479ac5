"""Keyed merges expressed as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    The rank filter becomes a group limit before the shuffle, so a key repeated many times
    leaves one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")


def resolve_id_collisions(batch: DataFrame) -> DataFrame:
    """One row per transaction id: the latest event, then the largest natural key."""
    return keep_one_per_key(
        batch, ["transaction_id"], [F.desc("transaction_date"), F.desc("natural_key_hash")]
    )


def upsert_by_key(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` the batch does not name, plus the batch."""
    named = batch.select(*keys)
    return existing.join(named, list(keys), "left_anti").unionByName(batch)


def unseen_rows(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is not in ``existing``: what an upsert inserts."""
    return batch.join(existing.select(*keys), list(keys), "left_anti")
