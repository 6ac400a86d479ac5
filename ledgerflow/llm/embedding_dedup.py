"""Near-duplicate vectors by a forest of random-projection trees with spill.

Every tree splits the space recursively: a node projects its vectors on a random direction and cuts at
their median. Vectors close to a cut go to both sides. A linked pair can be separated by a cut only if
it lies farther apart along the direction than twice the spill, which is rare, and then the other trees
still find it. The upper levels are fitted on one bounded sample; every vector is indexed. The vectors
of a label in a leaf are a cell. Cells of more rows than a block are split on by Spark, five levels a
pass, with cuts from a bounded sample of each, so the number of leaves follows the data.

Vectors are compared exactly, in double precision, with those of their cell. A cell that no cut makes
much smaller (vectors that lie about as close as links) is dealt out as pairs of blocks, so no task
holds more than two blocks, whatever the size. Pairs aren't
listed: a task adds up how many links each vector has, counting a pair only in the first leaf that its
vectors share, and joins what it links to the smallest id it finds there. Equal vectors of one label
are one class from the start and count as many links.

Vectors that are null, empty or zero or hold null or non-finite components, and rows without a label,
link with nothing; so do vectors of different lengths. Rows without an id have no component and stay.
Ties go to the smallest id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.components import components
from ledgerflow.llm.tables import Scratch


@dataclass(frozen=True)
class Forest:
    cosine: float = 0.98
    trees: int = 6
    #: Spill on either side of a cut, in standard deviations of a linked pair's distance along it.
    spill: float = 0.75
    #: Vectors that the upper levels are fitted on, and the least of them in a leaf there.
    sample: int = 8192
    least_sample: int = 64
    #: Vectors of a cell that its further cuts are fitted on, about.
    cell_sample: int = 2048
    #: A cut that puts more rows than this, for each row, on its two sides together isn't made.
    growth: float = 1.3
    #: Vectors of a block; a task compares two blocks.
    block: int = 1500
    seed: int = 3


#: Levels that a pass adds to a cell, and the most passes. A leaf's number holds the tree in bits 55 to
#: 57, the leaf of the upper levels in 13 more and six bits for each pass, zero where a cell wasn't split.
LEVELS = 5
PASSES = 7
UPPER_LEAVES = 1 << 12
TREE_SHIFT, UPPER_SHIFT = 55, 42

CELL = ["label", "size", "leaf"]


def _sides(along: np.ndarray, margin: float, p: Forest) -> tuple[float, np.ndarray, np.ndarray] | None:
    """The median and the rows on either side of it, unless the spill leaves little to gain."""
    cut = float(np.median(along))
    left, right = along <= cut + margin, along > cut - margin
    if left.sum() + right.sum() > p.growth * len(along):
        return None
    return cut, left, right


def fit_tree(points: np.ndarray, draw: np.random.Generator, margin: float, p: Forest) -> list[tuple]:
    """Nodes as (direction, cut, left, right); a child below zero is leaf -child - 1."""
    nodes: list[tuple] = []
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) >= 2 * p.least_sample and leaves < UPPER_LEAVES:
            direction = draw.standard_normal(points.shape[1])
            direction /= np.linalg.norm(direction)
            sides = _sides(points[rows] @ direction, margin, p)
            if sides:
                cut, left, right = sides
                at = len(nodes)
                nodes.append(())
                nodes[at] = (direction, cut, grow(rows[left]), grow(rows[right]))
                return at
        leaves += 1
        return -leaves

    root = grow(np.arange(len(points)))
    return nodes if root == 0 else []


def fit_cuts(along: np.ndarray, rows: int, margin: float, p: Forest) -> np.ndarray:
    """Cuts of a cell of `rows` rows in heap order, NaN where it isn't split, from its sample's projections."""
    cuts = np.full((1 << LEVELS) - 1, np.nan)
    scale = rows / max(1, len(along))

    def grow(chosen: np.ndarray, node: int, level: int) -> None:
        if level == LEVELS or len(chosen) < 4 or len(chosen) * scale <= p.block:
            return
        sides = _sides(along[chosen, level], margin, p)
        if sides:
            cuts[node] = sides[0]
            grow(chosen[sides[1]], 2 * node + 1, level + 1)
            grow(chosen[sides[2]], 2 * node + 2, level + 1)

    grow(np.arange(len(along)), 0, 0)
    return cuts


def descend(along: np.ndarray, cuts: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and nodes: every node without a cut that each row comes to."""
    rows, nodes = np.arange(len(along)), np.zeros(len(along), np.int64)
    ended = []
    for level in range(LEVELS):
        cut = cuts[rows, nodes]
        open_ = ~np.isnan(cut)
        ended.append((rows[~open_], nodes[~open_]))
        rows, nodes, cut = rows[open_], nodes[open_], cut[open_]
        place, wide = along[rows, level], margin[rows]
        left, right = place <= cut + wide, place > cut - wide
        rows = np.concatenate([rows[left], rows[right]])
        nodes = np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2])
    ended.append((rows, nodes))
    return np.concatenate([r for r, _ in ended]), np.concatenate([n for _, n in ended])


def leaves_of(points: np.ndarray, nodes: list[tuple], margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and leaf numbers: every leaf that each point falls into."""
    rows, leaves = [], []
    todo = [(0 if nodes else -1, np.arange(len(points)))]
    while todo:
        at, here = todo.pop()
        if at < 0:
            rows.append(here)
            leaves.append(np.full(len(here), -at - 1))
            continue
        direction, cut, left, right = nodes[at]
        along = points[here] @ direction
        todo += [(left, here[along <= cut + margin]), (right, here[along > cut - margin])]
    return np.concatenate(rows), np.concatenate(leaves)


def _unit(vectors: pa.Array, size: int) -> np.ndarray:
    rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _margin(size, p: Forest):
    return p.spill * np.sqrt(2 - 2 * p.cosine) / np.sqrt(size)


def classes_of(vectors: DataFrame) -> DataFrame:
    """rep, label, size (its length), copies, embedding and its hash, for each different vector of a label."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = usable & F.exists(numbers, lambda x: x != 0)
    rows = vectors.select("vec_id", "label", numbers.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False))
    )
    # One zero, so that vectors that differ in a zero's sign are equal.
    plain = F.transform("embedding", lambda x: x + F.lit(0.0))
    grouped = rows.groupBy("label", plain.alias("embedding")).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # An id may belong to several vectors; with the hash it names one.
    named = F.xxhash64("label", "embedding").alias("hash")
    return grouped.select("rep", named, "label", F.size("embedding").alias("size"), "copies", "embedding")


def _by_size(batch: pa.RecordBatch):
    """For each vector length in a batch: the length, its rows and their unit vectors."""
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes).tolist():
        part = batch.filter(pa.array(sizes == size))
        yield size, part, _unit(part.column("embedding"), size)


def _upper_leaves(classes: DataFrame, p: Forest) -> DataFrame:
    """label, size, leaf, rep and hash: each class in all its leaves of the upper levels."""
    sample = classes.orderBy(F.xxhash64("rep"), "rep", "hash").limit(p.sample).select("size", "embedding").toArrow()
    forest: dict[int, list] = {}
    for batch in sample.combine_chunks().to_batches():
        for size, _, points in _by_size(batch):
            draw = np.random.default_rng([p.seed, size])
            forest[size] = [fit_tree(points, draw, _margin(size, p), p) for _ in range(p.trees)]
    shared = classes.sparkSession.sparkContext.broadcast(forest)

    def index(batches):
        for batch in batches:
            for size, part, unit in _by_size(batch):
                for tree, nodes in enumerate(shared.value.get(size, [[]])):
                    row, leaf = leaves_of(unit, nodes, _margin(size, p))
                    kept = part.select(["label", "size", "rep", "hash"]).take(pa.array(row))
                    leaf = (tree << TREE_SHIFT) + (leaf << UPPER_SHIFT)
                    yield pa.RecordBatch.from_arrays(
                        [kept.column(0), kept.column(1), pa.array(leaf), kept.column(2), kept.column(3)],
                        [*CELL, "rep", "hash"],
                    )

    return classes.select("label", "size", "rep", "hash", "embedding").mapInArrow(index, _leaf_schema(classes))


def _leaf_schema(classes: DataFrame) -> str:
    return f"label {classes.schema['label'].dataType.simpleString()}, size int, leaf long, rep long, hash long"


def _projections(classes: DataFrame, step: int, p: Forest) -> DataFrame:
    """rep, hash, tree and the places of each class along the pass's directions of each tree."""

    def project(batches):
        directions: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for size, part, unit in _by_size(batch):
                for tree in range(p.trees):
                    if (size, tree) not in directions:
                        drawn = np.random.default_rng([p.seed, size, tree, step]).standard_normal((size, LEVELS))
                        directions[size, tree] = drawn / np.linalg.norm(drawn, axis=0)
                    along = unit @ directions[size, tree]
                    ends = pa.array(np.arange(0, along.size + 1, LEVELS, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("rep"),
                            part.column("hash"),
                            pa.array(np.full(len(unit), tree, np.int64)),
                            pa.ListArray.from_arrays(ends, pa.array(along.ravel())),
                        ],
                        ["rep", "hash", "tree", "along"],
                    )

    rows = classes.select("rep", "hash", "size", "embedding")
    return rows.mapInArrow(project, "rep long, hash long, tree long, along array<double>")


def _split_cells(state: DataFrame, projected: DataFrame, cuts: DataFrame, step: int, p: Forest) -> DataFrame:
    """The rows of `state` in the cells that `cuts` names, in their new leaves."""
    shift = 6 * (PASSES - 1 - step)

    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            along = batch.column("along").flatten().to_numpy(zero_copy_only=False).reshape(-1, LEVELS)
            cuts = batch.column("cuts").flatten().to_numpy(zero_copy_only=False).reshape(len(along), -1)
            row, node = descend(along, cuts, _margin(batch.column("size").to_numpy().astype(float), p))
            kept = batch.select(["label", "size", "leaf", "rep", "hash"]).take(pa.array(row))
            leaf = kept.column(2).to_numpy() + ((node + 1) << shift)
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array(leaf), kept.column(3), kept.column(4)], [*CELL, "rep", "hash"]
            )

    rows = state.join(cuts, CELL).join(projected, ["rep", "hash", "tree"])
    return rows.select(*CELL, "rep", "hash", "along", "cuts").mapInArrow(split, _leaf_schema(state))


def leaf_rows(classes: DataFrame, scratch: Scratch, p: Forest) -> DataFrame:
    """label, size, leaf, rep and hash: each class in all its leaves, of which few hold more than a block."""
    kind = classes.schema["label"].dataType.simpleString()
    state = scratch.put("leaves-0", _upper_leaves(classes, p))
    ended = []
    for step in range(PASSES):
        large = state.groupBy(CELL).agg(F.count("*").alias("n")).where(F.col("n") > p.block)
        large = scratch.put(f"large-{step}", large)
        if large.isEmpty():
            break
        state = state.withColumn("tree", F.shiftright("leaf", TREE_SHIFT))
        wanted = state.join(large, CELL, "left_semi").select("rep", "hash").distinct()
        projected = scratch.put(f"along-{step}", _projections(classes.join(wanted, ["rep", "hash"], "left_semi"), step, p))
        chance = F.pmod(F.xxhash64(F.lit(step), "leaf", "rep", "hash"), F.lit(1 << 30)) / F.lit(1 << 30)
        sample = state.join(large, CELL).where(chance * F.col("n") < p.cell_sample)
        sample = sample.join(projected, ["rep", "hash", "tree"]).select(*CELL, "n", "along")

        def fit(key, rows):
            along = rows["along"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, LEVELS)
            size = key[1].as_py()
            cuts = fit_cuts(along, rows["n"][0].as_py(), _margin(size, p), p)
            cell = rows.select(CELL).slice(0, 0 if np.isnan(cuts[0]) else 1)
            return cell.append_column("cuts", pa.array([cuts.tolist()] * cell.num_rows, pa.list_(pa.float64())))

        schema = f"label {kind}, size int, leaf long, cuts array<double>"
        cuts = scratch.put(f"cuts-{step}", sample.groupBy(CELL).applyInArrow(fit, schema))
        if cuts.isEmpty():
            break
        ended.append(state.join(cuts, CELL, "left_anti").select(*CELL, "rep", "hash"))
        state = scratch.put(f"leaves-{step + 1}", _split_cells(state, projected, cuts, step, p))
        scratch.drop(f"along-{step}")
    for part in ended:
        state = state.select(*CELL, "rep", "hash").unionByName(part)
    return state.select(*CELL, "rep", "hash")


def _compare(rows: pa.Table, p: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rep, links counted here and the smallest rep joined to, of one pair of blocks."""
    first, second = rows["i"][0].as_py(), rows["j"][0].as_py()
    rep, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
    own = rows["own"].to_numpy()
    unit = _unit(rows["embedding"].combine_chunks(), rows["size"][0].as_py())
    near = unit @ unit.T >= p.cosine
    if first != second:  # pairs within a block are another task's
        near &= own[:, None] != own[None, :]
    np.fill_diagonal(near, False)
    # Leaves before this one that two rows share: there the pair has been counted.
    lists = rows["leaves"].combine_chunks()
    here = rows["leaf"][0].as_py()
    at = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    every = lists.flatten().to_numpy()
    at, every = at[every < here], every[every < here]
    counted = near.astype(np.float64)
    if len(every):
        names, column = np.unique(every, return_inverse=True)
        table = np.zeros((len(lists), len(names)), np.float32)
        table[at, column] = 1
        counted[(table @ table.T) > 0] = 0
    links = (counted @ copies.astype(np.float64)).astype(np.int64)
    root = rep.copy()
    while True:  # the smallest id within reach, here
        low = np.where(near, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        low = np.minimum(root, low)
        if (low == root).all():
            break
        root = low
    linked = near.any(axis=1)
    return rep[linked], links[linked], root[linked]


def near_vectors(vectors: DataFrame, scratch: Scratch, p: Forest = Forest()) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of `vectors`."""
    classes = scratch.put("classes", classes_of(vectors))
    cells = leaf_rows(classes, scratch, p)
    lists = cells.groupBy("rep", "hash").agg(F.collect_list("leaf").alias("leaves"))  # few for each class
    indexed = scratch.put("indexed", classes.join(lists, ["rep", "hash"]))
    scratch.drop(*(f"leaves-{step}" for step in range(PASSES + 1)))
    indexed = indexed.withColumn("leaf", F.explode("leaves"))
    counts = indexed.groupBy(CELL).agg(F.ceil(F.count("*") / p.block).cast("int").alias("blocks"))
    leafy = indexed.join(counts, CELL)
    leafy = leafy.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = leafy.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})

    def compare(rows):
        rep, links, root = _compare(rows, p)
        return pa.table([pa.array(rep), pa.array(links), pa.array(root)], names=["rep", "links", "root"])

    keys = [*CELL, "i", "j"]
    found = dealt.select(*keys, "own", "rep", "copies", "embedding", "leaves").groupBy(*keys)
    found = scratch.put("found", found.applyInArrow(compare, "rep long, links long, root long"))
    scratch.drop("indexed")
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    named = groups.select(F.col("node").alias("rep"), "component")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.select("label", "embedding", "rep", "copies").join(linked, "rep", "left").join(named, "rep", "left")
    known = known.select(
        F.col("label").alias("l"),
        F.col("embedding").alias("e"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select("vec_id", "label", plain.alias("embedding"))
    joined = rows.join(known, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
