"""Joins and running sums that no single key can hold up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key with more than one in so many rows is hot, so there are at most as many hot keys.
HOT_SHARE = 1000
#: Rows of a key summed in one piece.
PIECE_ROWS = 1 << 14


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], left: bool = False) -> DataFrame:
    """`rows` with the columns of `facts`, which has one row per key; with `left` also rows without one.

    The facts of hot keys, at most `HOT_SHARE` rows, are broadcast; all other rows are joined by a
    shuffle, in which no key has more than one in `HOT_SHARE` of them. `rows` is read several times, so
    it should be a stored table. Rows with a null key have no facts.
    """
    least = rows.count() // HOT_SHARE
    hot = rows.groupBy(*keys).count().where(F.col("count") > least).drop("count").dropna()
    hot_facts = hot.join(facts, keys, "left" if left else "inner")
    how = "left" if left else "inner"
    by_copy = rows.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(hot_facts), keys, how)
    by_shuffle = rows.join(F.broadcast(hot), keys, "left_anti").join(facts, keys, how)
    return by_copy.unionByName(by_shuffle)


def running(rows: DataFrame, key: str, place: str, sums: dict[str, tuple[Column, str]]) -> DataFrame:
    """`rows` with running aggregates along each key in the order of `place`, 0, 1, 2 and so on without gaps.

    `sums` maps a new column to what it adds up and how: "sum" or "bit_xor". Pieces of a key are summed
    on their own, then one row per piece carries the total over, so a key of any length is spread.
    """
    fold = {"sum": F.sum, "bit_xor": F.bit_xor}
    cut = rows.withColumn("_piece", F.floor(F.col(place) / PIECE_ROWS))
    inner = Window.partitionBy(key, "_piece").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(key, "_piece").agg(*(fold[how](value).alias(name) for name, (value, how) in sums.items()))
    carried = totals.select(
        key, "_piece", *(F.coalesce(fold[how](F.col(name)).over(before), F.lit(0)).alias(f"_{name}") for name, (_, how) in sums.items())
    )
    local = cut.withColumns({name: fold[how](value).over(inner) for name, (value, how) in sums.items()})
    joined = local.join(carried.where("_piece > 0"), [key, "_piece"], "left")
    whole = {}
    for name, (_, how) in sums.items():
        carry = F.coalesce(f"_{name}", F.lit(0))
        whole[name] = F.col(name) + carry if how == "sum" else F.col(name).bitwiseXOR(carry)
    return joined.withColumns(whole).drop("_piece", *(f"_{name}" for name in sums))
