"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped candidates.

A document's set holds the hashes of its distinct five-word shingles (lower-cased A-Z; with fewer
words, the whole sequence). One hash of each shingle chooses a bin and competes for its minimum; bins
left empty copy a filled one that a hash of (bin, attempt) probes ("optimal densification"). Bins
are banded into buckets.

Documents with equal sets are one class from the start; only class representatives are banded. In
each bucket candidates are stars: one centre paired with the other members, so pairs grow with the
rows, not their square. Candidates whose signatures leave the threshold possible are confirmed on
full sets, which are made for candidates alone. Links join documents into groups; buckets that still
hold several groups get new centres once, those with the most links (the original of many copies).
Stars may leave pairs of a bucket untested, so the
members of all buckets that still hold several groups are then joined exactly: of each set only the
shingles in which a link's first common one can lie (commonest last, see `_prefix_pairs`) are matched.
The rows of a common shingle are dealt out as pairs of blocks, so a task holds two blocks of one at most.
An estimate rejects pairs of stars only: the exact join looks at them again.

Null and empty texts have no shingles and link with nothing. Rows with equal texts are one class.
Rows without an id can't be named by a link: their component is null and they stay. Rows that share an
id but not a text are told apart by their texts. Ties go to the smallest id. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.components import components
from ledgerflow.llm.tables import Scratch, measure_texts
from ledgerflow.llm.words import LOWER, mix, span_hashes, windows, word_spans


#: Rounds of stars before the exact join.
STAR_ROUNDS = 2
#: Hash buckets, as bits, whose counts order the shingles of the exact join.
ORDER_BITS = 20


@dataclass(frozen=True)
class MinHash:
    width: int = 5
    #: Least similarity of a link, in percent.
    percent: int = 75
    bands: int = 32
    rows: int = 4
    #: Least share of equal bins of a pair that is confirmed on full sets, in percent.
    estimate: int = 45
    #: Rows of a block of the exact join; a shingle of more rows is dealt out as pairs of blocks.
    block: int = 20_000
    seed: int = 5


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, in order within each text, and each text's first one."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    at, hashes = windows(words, first, width)
    text = np.searchsorted(first, at, side="right") - 1
    count = np.diff(first)
    for few in range(1, width):  # the whole sequence as one shingle
        short = np.flatnonzero(count == few)
        total = np.full(len(short), few, np.uint64)
        for k in range(few):
            total = mix(total * np.uint64(31) + words[first[short] + k])
        text, hashes = np.concatenate([text, short]), np.concatenate([hashes, total])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[fresh], hashes[fresh]
    return hashes, np.searchsorted(text, np.arange(len(offsets)))


def signatures(hashes: np.ndarray, first: np.ndarray, bins: int, seed: int) -> np.ndarray:
    """Densified one-permutation signature of each set; rows of empty sets are zero."""
    count = len(first) - 1
    text = np.repeat(np.arange(count), np.diff(first))
    mixed = mix(hashes + np.uint64(seed))
    cell = text * bins + (mixed % np.uint64(bins)).astype(np.int64)
    order = np.lexsort((mixed, cell))
    lead = np.ones(len(order), bool)
    lead[1:] = cell[order][1:] != cell[order][:-1]
    table = np.zeros(count * bins, np.uint64)
    full = np.zeros(count * bins, bool)
    table[cell[order][lead]] = mix(mixed[order][lead])
    full[cell[order][lead]] = True
    empty = np.flatnonzero(~full & np.repeat(np.diff(first) > 0, bins))
    values, attempt = table.copy(), 1
    while len(empty):
        probe = mix((empty % bins).astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(attempt))
        source = empty - empty % bins + (probe % np.uint64(bins)).astype(np.int64)
        hit = full[source]
        values[empty[hit]] = table[source[hit]]
        empty, attempt = empty[~hit], attempt + 1
    return (values >> np.uint64(32)).astype(np.uint32).reshape(count, bins)


def _blobs(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() if ok else None for row, ok in zip(rows, present)], pa.binary())


def describe(docs: DataFrame, p: MinHash) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set (d1, d2) and the signature."""

    def measure(data, offsets):
        hashes, first = shingle_sets(data, offsets, p.width)
        sizes = np.diff(first)
        sums = []
        for salt in (0x51ED270B, 0x2545F491):
            total = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(mix(hashes ^ np.uint64(salt)), out=total[1:])
            sums.append((total[first[1:]] - total[first[:-1]] + sizes.astype(np.uint64)).view(np.int64))
        found = signatures(hashes, first, p.bands * p.rows, p.seed)
        return {"n_shingles": sizes, "d1": sums[0], "d2": sums[1], "signature": _blobs(found, sizes > 0)}

    return measure_texts(docs, measure, "n_shingles long, d1 long, d2 long, signature binary")


def band_rows(reps: DataFrame, p: MinHash) -> DataFrame:
    """bucket and rep: one row for each band of each representative."""
    places = np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, p.rows + 1, dtype=np.uint64)

    def split(batches):
        for batch in batches:
            blobs = batch.column("signature").to_pylist()
            if not blobs:
                continue
            table = np.frombuffer(b"".join(blobs), np.uint32).reshape(len(blobs), p.bands, p.rows)
            keys = mix((table.astype(np.uint64) * places).sum(axis=2, dtype=np.uint64) + np.arange(p.bands, dtype=np.uint64))
            rep = np.repeat(batch.column("rep").to_numpy(), p.bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(rep)], ["bucket", "rep"])

    return reps.select("rep", "signature").mapInArrow(split, "bucket long, rep long")


def _possible(pairs: DataFrame, reps: DataFrame, p: MinHash) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures leave a link possible."""
    one = reps.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n"), F.col("signature").alias("s"))
    two = reps.select(F.col("rep").alias("b"), F.col("n_shingles").alias("m"), F.col("signature").alias("t"))
    sized = pairs.join(two, "b").join(one, "a")
    sized = sized.where(100 * F.least("n", "m") >= p.percent * F.greatest("n", "m")).select("a", "b", "s", "t")

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            s, t = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                for name in ("s", "t")
            )
            near = (s == t).sum(axis=1) * 100 >= p.estimate * s.shape[1]
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return sized.mapInArrow(compare, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, scratch: Scratch, name: str, many: bool, p: MinHash) -> DataFrame:
    """The pairs (a, b) that are similar enough by their full sets.

    `many` says that the pairs name a share of all documents, which grows with them: those ids are
    joined by a shuffle at any size. The later rounds' few ids are left to Spark's size check.
    """
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    if many:
        wanted = wanted.hint("merge")

    def measure(data, offsets):
        hashes, first = shingle_sets(data, offsets, p.width)
        sets = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
        return {"shingles": pa.array(sets, pa.binary())}

    sets = measure_texts(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), measure, "shingles binary")
    sets = scratch.put(f"sets-{name}", sets)
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t"))

    def compare(batches):
        for batch in batches:
            near = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (s, t))
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                near.append(100 * common >= p.percent * (len(both) - common) and common > 0)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    joined = pairs.join(two, "b").join(one, "a").select("a", "b", "s", "t")
    return joined.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, scratch: Scratch, p: MinHash = MinHash()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of `docs`."""
    described = scratch.put("described", describe(docs, p))
    filled = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = scratch.put("classes", filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    named = classes.select("d1", "d2", F.col("rep").alias("doc_id"))
    reps = filled.join(named, ["d1", "d2", "doc_id"], "left_semi").dropDuplicates(["d1", "d2", "doc_id"])
    reps = scratch.put("reps", reps.select(F.col("doc_id").alias("rep"), "n_shingles", "signature"))

    bands = band_rows(reps, p)
    shared = bands.groupBy(F.col("bucket").alias("k")).agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    shared = shared.where("low < high").select("k")
    buckets = scratch.put("buckets", bands.join(shared, F.col("bucket") == F.col("k"), "left_semi"))

    links = labels = tested = decided = None
    for step in range(STAR_ROUNDS):  # what they leave is joined exactly
        pairs = _star_pairs(buckets, labels, links, step, p)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.put(f"pairs-{step}", pairs)
        if pairs.isEmpty():
            break
        tested = pairs if tested is None else tested.union(pairs)
        near = scratch.put(f"near-{step}", _possible(pairs, reps, p))
        decided = near if decided is None else decided.union(near)
        found = scratch.put(f"links-{step}", _confirmed(near, docs, scratch, str(step), step == 0, p))
        scratch.drop(f"sets-{step}")
        if found.isEmpty():
            break
        links = found if links is None else links.union(found)
        labels = components(links, scratch, f"labels-{step}")

    open_ids = scratch.put("open", _open_members(buckets, labels))
    if not open_ids.isEmpty():
        pairs = _prefix_pairs(docs, open_ids, scratch, p)
        if decided is not None:
            pairs = pairs.join(decided, ["a", "b"], "left_anti")
        pairs = scratch.put("pairs-exact", pairs)
        found = scratch.put("links-exact", _confirmed(pairs, docs, scratch, "exact", True, p))
        scratch.drop("sets-exact", "open-sets")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = components(links, scratch, "labels-exact")

    grouped = classes.withColumn("component", F.col("rep"))
    if labels is not None:
        named = labels.select(F.col("node").alias("rep"), F.col("component").alias("low"))
        grouped = classes.join(named, "rep", "left").withColumn("component", F.coalesce("low", "rep"))
    grouped = scratch.put("grouped", grouped.where("n > 1 OR component != rep").select("d1", "d2", "component"))
    scratch.drop("buckets", "reps")
    rows = described.select("doc_id", "n_shingles", "d1", "d2").join(grouped, ["d1", "d2"], "left")
    mine = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), mine)
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _with_components(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """`buckets` with the group of each member so far."""
    if labels is None:
        return buckets.withColumn("component", F.col("rep"))
    known = labels.select(F.col("node").alias("rep"), F.col("component").alias("low"))
    return buckets.join(known, "rep", "left").withColumn("component", F.coalesce("low", "rep")).drop("low")


def _open_members(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id and component of the members of buckets that hold several groups; a star has tested buckets of two."""
    members = _with_components(buckets, labels)
    several = members.groupBy(F.col("bucket").alias("k")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")
    )
    several = several.where("low < high AND n > 2").select("k")
    left = members.join(several, F.col("bucket") == F.col("k"), "left_semi")
    return left.select(F.col("rep").alias("doc_id"), "component").distinct()


def _prefix_pairs(docs: DataFrame, members: DataFrame, scratch: Scratch, p: MinHash) -> DataFrame:
    """Pairs a < b of members in different groups: all that may link by their full sets.

    Shingles have one order for all sets, those in commoner hash buckets later. If the first common
    shingle of two sets of s and m shingles comes after i of the first set, they share at most s - i,
    and a link needs percent / (100 + percent) of s + m. That bounds m from above, and likewise s.
    So a text's shared template meets nothing unless it is itself enough for a link. Counts only
    steer the order: which pairs link doesn't depend on them.
    """
    percent = p.percent

    def measure(data, offsets):
        hashes, first = shingle_sets(data, offsets, p.width)
        return {"shingles": pa.array([hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())}

    texts = docs.select("doc_id", "text").join(members.hint("merge"), "doc_id")
    sets = scratch.put("open-sets", measure_texts(texts, measure, "shingles binary", keep=("doc_id", "component")))

    shift = np.uint64(64 - ORDER_BITS)

    def count(batches):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                np.add.at(total, (mix(np.frombuffer(blob.as_buffer(), np.uint64)) >> shift).astype(np.int64), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    cells = sets.select("shingles").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << ORDER_BITS, np.float32)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def prefixes(batches):
        for batch in batches:
            ids, groups = (batch.column(i).to_numpy() for i in (0, 1))
            for lo in range(0, batch.num_rows, 256):
                out = []
                for k in range(lo, min(lo + 256, batch.num_rows)):
                    items = np.frombuffer(batch.column(2)[k].as_buffer(), np.uint64)
                    size = len(items)
                    mixed = mix(items)
                    items = items[np.lexsort((mixed, shared.value[(mixed >> shift).astype(np.int64)]))]
                    most = (100 + percent) * (size - np.arange(size)) // percent - size
                    reach = int(np.searchsorted(-(100 * most), -percent * size, side="right"))
                    out.append((items[:reach].view(np.int64), most[:reach], reach, size, ids[k], groups[k]))
                if out:
                    tokens, mosts, reaches, *fixed = zip(*out)
                    wide = [np.repeat(np.array(column, np.int64), reaches) for column in fixed]
                    columns = [np.concatenate(tokens), np.concatenate(mosts).astype(np.int64), *wide]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["token", "most", "size", "rep", "component"])

    rows = sets.select("doc_id", "component", "shingles")
    rows = rows.mapInArrow(prefixes, "token long, most long, size long, rep long, component long")
    several = rows.groupBy(F.col("token").alias("t")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / p.block).alias("blocks")
    )
    rows = rows.join(several.where("low < high").select("t", "blocks"), F.col("token") == F.col("t"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = ["token", "i", "j"]
    rows = rows.select(
        "token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "most", "size", "rep", "component"
    )
    dealt = rows.repartition(*cell).sortWithinPartitions(*cell, "size")

    def meet(batches):
        rest = None
        for batch in batches:
            table = np.stack([column.to_numpy() for column in batch.columns])
            if rest is not None:
                table = np.concatenate([rest, table], axis=1)
            if not table.shape[1]:
                continue
            last = int(np.flatnonzero((table[:3] == table[:3, -1:]).all(axis=0))[0])
            yield from _cross_pairs(table[:, :last], percent)
            rest = table[:, last:]
        if rest is not None:
            yield from _cross_pairs(rest, percent)

    return dealt.mapInArrow(meet, "a long, b long").distinct()


def _cross_pairs(table: np.ndarray, percent: int):
    """Pairs of the prefix rows (token, i, j, own, most, size, rep, component; by cell and size) that may link.

    A cell holds the blocks i and j of a token's rows. Its largest group's rows meet those of the others
    only, and rows of one block meet where i is j.
    """
    edges = np.flatnonzero((np.diff(table[:3]) != 0).any(axis=0)) + 1
    for lo, hi in zip([0, *edges], [*edges, table.shape[1]]):
        _, first, second, block, most, size, rep, component = table[:, lo:hi]
        names, place, counts = np.unique(component, return_inverse=True, return_counts=True)
        if len(names) < 2:
            continue
        across = first[0] != second[0]
        own = np.flatnonzero(place != counts.argmax())
        begin = np.searchsorted(size, -(-percent * size[own] // 100))
        end = np.maximum(begin, np.searchsorted(size, most[own], side="right"))
        at = 0
        upto = np.cumsum(end - begin)
        while at < len(own):  # about a million comparisons at a time, or one row's
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + (1 << 20), side="right")))
            count = (end - begin)[at:to]
            x = np.repeat(own[at:to], count)
            y = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[at:to], count)
            good = (most[y] >= size[x]) & (component[x] != component[y]) & (rep[x] != rep[y])
            if across:
                good &= block[x] != block[y]
            x, y = rep[x[good]], rep[y[good]]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
            at = to


def _star_pairs(buckets: DataFrame, labels: DataFrame | None, links: DataFrame | None, step: int, p: MinHash) -> DataFrame:
    """Candidate pairs a < b: in each bucket with several groups, a centre and the members of other groups."""
    members = _with_components(buckets, labels)
    chance = F.xxhash64(F.lit(p.seed + step), "bucket", "rep")
    ranks = [F.col("rep"), chance] if step == 0 else [chance]
    if step % 2 == 1 and links is not None:  # the member with the most links first
        degrees = links.select(F.col("a").alias("rep")).union(links.select("b")).groupBy("rep")
        degrees = degrees.agg(F.count("*").alias("degree"))
        members = members.join(degrees, "rep", "left")
        ranks = [-F.coalesce("degree", F.lit(0))]
    centres = [F.min(F.struct(rank.alias("rank"), chance.alias("chance"), "rep", "component")).alias(f"centre{i}") for i, rank in enumerate(ranks)]
    stars = members.groupBy(F.col("bucket").alias("k")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), *centres
    )
    chosen = F.array(*(F.struct(f"centre{i}.rep", f"centre{i}.component") for i in range(len(ranks))))
    stars = stars.where("low < high").select("k", F.explode(chosen).alias("centre"))
    met = members.join(stars, F.col("bucket") == F.col("k")).where("component != centre.component")
    return met.select(F.least("rep", "centre.rep").alias("a"), F.greatest("rep", "centre.rep").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, scratch: Scratch, p: MinHash = MinHash()) -> DataFrame:
    """The rows of `docs` without all but one document of each group; of repeated rows one stays."""
    inner = Scratch(docs.sparkSession, "near-duplicates")
    try:
        found = scratch.put("found", near_duplicates(docs, inner, p))
    finally:
        inner.drop()
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = scratch.put("repeated", repeated)
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return left.join(repeated, "doc_id", "left_anti").select(docs.columns).union(once)
