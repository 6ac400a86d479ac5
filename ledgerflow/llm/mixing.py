"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources in code point order (null last) weigh 3, 1, 2, repeating, and share a multiple of all words.
No target goes above a multiple of its source's words; the excess is reshared by weight. A source
gives as many complete epochs as its target holds. The rest of the target is a weighted sample
without replacement: every document draws an exponential key divided by its quality weight, keys are
sorted within the source, and documents are taken while the running sum of words fits the budget.
The document that would go over it is left, and what is not taken fills the gap, from the largest
document that fits to the smallest, by key where sizes are equal. So a source never goes above its
target, and what it lacks is less than any document not taken.

The order is resolved from coarse to fine. Key ranges ("cells") are summed first, then those within the
one cell per source in which the budget ends; only the rows of one of these, a 4096th of a 4096th of a
source, are sorted. The gap is filled from counts by size: one row for each source and size. So no source,
however large, is sorted in one task, and texts aren't shuffled: a row is taken by comparing its own key
with its source's cut and with the few keys that fill the gap. Rows with one id, source and weight share a
key and are taken together.

Null texts have no words. Documents without words cost nothing and come with the epochs. Sources
without words have target 0. A null source is a source of its own, a null id is the empty id. An
empty table gives an empty result. Other columns are kept by `mix` and don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.quality_rules import repeated_lines
from ledgerflow.llm.tables import Scratch, measure_texts
from ledgerflow.llm.words import owners, word_spans


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)
    #: The mix's words for each word of all documents.
    share: float = 1.5
    #: Most words taken from a source for each of its words.
    most_epochs: int = 2
    #: Weight lost by a text all of whose lines repeat.
    repeat_loss: float = 0.75
    cells: int = 4096
    seed: str = "mix-1"


def _size_and_weight(data: np.ndarray, offsets: np.ndarray, loss: float) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and its quality weight: lines that repeat an earlier one lower it."""
    starts, _, first = word_spans(data, offsets)
    text = owners(first)
    lines = np.searchsorted(np.flatnonzero(data == 0x0A), starts)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (lines[1:] != lines[:-1]) | (text[1:] != text[:-1])
    worded = np.bincount(text[fresh], minlength=len(offsets) - 1)
    return np.diff(first), 1 - loss * repeated_lines(data, offsets, starts) / np.maximum(1, worded)


def with_keys(docs: DataFrame, p: Mix = Mix(), keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The columns `keep` of `docs`, and each document's size, key, cell and cell within the cell."""
    loss = p.repeat_loss

    def measure(data, offsets):
        size, weight = _size_and_weight(data, offsets, loss)
        return {"size": size, "weight": weight}

    drawn = F.md5(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    uniform = (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    columns = tuple(dict.fromkeys([*keep, "doc_id"]))
    measured = measure_texts(docs, measure, "size long, weight double", keep=columns)
    found = measured.withColumn("key", -F.log(uniform) / F.col("weight"))
    place = p.cells * (1 - F.exp(-F.col("key")))
    cell, inner = F.floor(place), F.floor(p.cells * (place - F.floor(place)))
    return found.select(*keep, "size", "key", cell.cast("int").alias("cell"), inner.cast("int").alias("inner"))


def targets(sizes: DataFrame, p: Mix = Mix()) -> DataFrame:
    """source, source_size and target, from one row per source with its source_size.

    Water-filling: sources are met in the order in which they reach their limit. One is limited if
    its share of what those before it leave is at least its limit.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(float(w)) for w in p.weights))
    place = (F.row_number().over(by_name) - 1) % len(p.weights)
    limit = F.col("source_size") * float(p.most_epochs)
    ranked = sizes.withColumns({"weight": F.get(weights, place), "limit": limit}).withColumns(
        {
            "all_words": F.sum("source_size").over(everything) * p.share,
            "all_weight": F.sum("weight").over(everything),
        }
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.col("all_words") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    left_weight = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    met = ranked.withColumn("limited", F.col("weight") * left_words >= F.col("limit") * left_weight)
    rest = F.col("all_words") - F.coalesce(F.sum(F.expr("CASE WHEN limited THEN limit END")).over(everything), F.lit(0.0))
    free = F.sum(F.expr("CASE WHEN NOT limited THEN weight END")).over(everything)
    shared = F.col("weight") * (rest / free)
    return met.select("source", "source_size", F.when(F.col("limited"), F.col("limit")).otherwise(shared).alias("target"))


def quotas(keyed: DataFrame, scratch: Scratch, p: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """One row per source: source_size, target, epochs and which keys come first; and the keys that fill gaps.

    `keyed` is a stored table of source, size, key, cell and inner of every document.
    """
    sizes = scratch.put("sizes", keyed.groupBy("source").agg(F.sum("size").alias("source_size")))
    # Without words there is nothing to repeat.
    epochs = F.when(
        F.col("source_size") > 0,
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(p.most_epochs)),
    ).otherwise(0)
    plan = targets(sizes, p).withColumn("epochs", epochs.cast("long"))
    plan = scratch.put("targets", plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    same = F.col("source").eqNullSafe(F.col("s"))

    ends = plan.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("start"), "budget")
    ends = scratch.put("ends-cell", _end_cells(keyed, ends, same, "cell"))
    inside = keyed.join(ends.select(F.col("s").alias("t"), F.col("end_cell").alias("c")), _same("source", "t") & (F.col("cell") == F.col("c")))
    ends = scratch.put("ends", _end_cells(inside.drop("t", "c"), ends, same, "inner"))
    within = (F.col("cell") == F.col("end_cell")) & (F.col("inner") == F.col("end_inner"))
    inside = keyed.join(ends, same & within).groupBy("s", "start", "budget", "key").agg(F.sum("size").alias("size"))
    running = F.sum("size").over(Window.partitionBy("s").orderBy("key"))
    reached = (
        inside.withColumn("upto", F.col("start") + running)
        .where(F.col("upto") <= F.col("budget"))
        .groupBy(F.col("s").alias("t"))
        .agg(F.max("key").alias("cut"), F.max("upto").alias("reached"))
    )
    cuts = ends.join(reached, _same("s", "t"), "left").select(
        "s",
        "end_cell",
        "end_inner",
        F.coalesce("cut", F.lit(-1.0)).alias("cut"),
        (F.col("budget") - F.coalesce("reached", "start")).alias("room"),
    )
    cuts = scratch.put("cuts", cuts)
    plan = plan.join(cuts, same, "left").select("source", "source_size", "target", "epochs", "end_cell", "end_inner", "cut")
    return plan, scratch.put("fills", _fills(keyed, cuts, scratch))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _end_cells(keyed: DataFrame, ends: DataFrame, same: Column, cell: str) -> DataFrame:
    """`ends` with the cell of each source in which its budget ends, and the words before it as `start`."""
    cells = keyed.groupBy("source", cell).agg(F.sum("size").alias("cell_size"))
    upto = Window.partitionBy("source").orderBy(cell)
    cells = cells.withColumn("before", F.sum("cell_size").over(upto) - F.col("cell_size"))
    begin = F.col("start") + F.col("before")
    found = cells.join(ends, same).where((begin <= F.col("budget")) & (F.col("budget") < begin + F.col("cell_size")))
    return found.select(*(c for c in ends.columns if c != "start"), begin.alias("start"), F.col(cell).alias(f"end_{cell}"))


def _fills(keyed: DataFrame, cuts: DataFrame, scratch: Scratch) -> DataFrame:
    """source and key of what fills the room below each budget: the largest that fits, again and again."""
    rest = keyed.where("size > 0").join(cuts, _same("source", "s")).where(~taken_by())
    units = rest.groupBy("s", "room", "key").agg(F.sum("size").alias("size")).where("size <= room")
    units = scratch.put("units", units)
    by_size = units.groupBy("s", "room", "size").agg(F.count("*").alias("n"))

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        room, picked = rows["room"].iloc[0], []
        for size, n in rows.sort_values("size", ascending=False)[["size", "n"]].itertuples(index=False):
            picked.append(min(n, int(room // size)))
            room -= picked[-1] * size
        rows = rows.sort_values("size", ascending=False).assign(picked=picked)
        return rows.loc[rows["picked"] > 0, ["s", "size", "picked"]]

    # At most one row per size up to the room, in one task per source.
    chosen = by_size.groupBy("s").applyInPandas(pick, T.StructType([cuts.schema["s"], *T._parse_datatype_string("size long, picked long").fields]))
    chosen = chosen.withColumnsRenamed({"s": "t", "size": "chosen_size"})
    first = units.join(chosen, _same("s", "t") & (F.col("size") == F.col("chosen_size")))
    part = F.pmod(F.xxhash64("key"), F.lit(64))  # the first of each part, then the first of all
    for keys in (["s", "size", part], ["s", "size"]):
        first = first.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("key"))).where("place <= picked")
    return first.select(F.col("s").alias("fill_source"), F.col("key").alias("fill_key"))


def taken_by() -> Column:
    """Whether a row's key comes before its source's cut."""
    at_cut = (F.col("inner") < F.col("end_inner")) | ((F.col("inner") == F.col("end_inner")) & (F.col("key") <= F.col("cut")))
    return (F.col("cell") < F.col("end_cell")) | ((F.col("cell") == F.col("end_cell")) & at_cut)


def _with_copies(keyed: DataFrame, plan: DataFrame, fills: DataFrame) -> DataFrame:
    """`keyed` with how often each row is taken, and its source's size and target."""
    joined = keyed.join(plan.withColumnRenamed("source", "_source"), _same("source", "_source"))
    joined = joined.join(fills, _same("source", "fill_source") & (F.col("key") == F.col("fill_key")), "left")
    chosen = F.coalesce(taken_by(), F.lit(False)) | F.col("fill_key").isNotNull()
    return joined.withColumn("copies", F.col("epochs") + chosen.cast("long"))


def take_counts(docs: DataFrame, scratch: Scratch, p: Mix = Mix()) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of each document."""
    keyed = scratch.put("keyed", with_keys(docs, p))
    plan, fills = quotas(keyed, scratch, p)
    return _with_copies(keyed, scratch.put("plan", plan), fills).select("doc_id", "source", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, scratch: Scratch, p: Mix = Mix()) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, with its columns."""
    keyed = scratch.put("keyed", with_keys(docs, p, keep=("source",)))
    plan, fills = quotas(keyed, scratch, p)
    plan = scratch.put("plan", plan)
    scratch.drop("keyed", "units")
    whole = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    rows = with_keys(whole, p, keep=("source", "row"))
    repeated = F.explode(F.array_repeat("row", F.col("copies").cast("int")))
    return _with_copies(rows, plan, fills).select(repeated.alias("row")).select("row.*")
