"""Prefix trie of conversations by collapsing whole sequences.

Every conversation is known by the digest of its whole sequence of turns. Conversations with equal
digests collapse into one weighted sequence with the list of those that end there. Only sequences
give prefixes, and each prefix is a node of the trie. A sequence that is a proper prefix of another
one is no leaf: an anti-join against the nodes that have children drops it. Weighted prefixes are
then added up: members, leaves, and the characters that sharing saves.

What a subtree saves needs no walk. Every member counts its characters from the node on, and every
distinct node counts its own once. Each node is owned by its member with the smallest id; what one
sequence owns is the end of its path, so two sums per prefix give both counts, linear in the turns.

Digests are 128 bits: two words, each the exclusive or of a 64-bit hash of (place, SHA-256 of role and
text). So prefixes of a long sequence are digested in pieces, a turn's place comes from a range-sorted
table, and no conversation, node or list of members is held by one task; the SHA-256 of a list of
members is fed from joined pieces in order.

Turns are ordered by number, null first, then by role and text; equal rows are turns of their own. Null
roles and texts are empty. Rows without a conversation id are left out. An empty table has no nodes.
Columns other than conv_id, turn, role and text are ignored. A conversation without turns after being
rebuilt ends at the root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.hot_keys import join_facts, running
from ledgerflow.llm.tables import Scratch

NODE = ["depth", "h1", "h2"]
#: Ids joined into one piece of a member list.
LIST_PIECE = 512


def placed_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, place (from 1), digest of role and text, and chars of the text of every turn.

    Turns are sorted over all tasks. A turn's place is its row number in its sorted piece, less that of
    the conversation's first row there, plus the conversation's rows in earlier pieces.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = sorted_turns.select(
        "conv_id",
        F.monotonically_increasing_id().alias("row"),
        F.sha2(content, 256).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )
    rows = scratch.put("sorted", rows.withColumn("piece", F.shiftright("row", 33)))
    pieces = rows.groupBy("conv_id", "piece").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("skip", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    place = F.col("row") - F.col("first") + F.col("skip") + 1
    return rows.join(pieces, ["conv_id", "piece"]).select("conv_id", place.alias("place"), "digest", "chars")


def whole_conversations(turns: DataFrame) -> DataFrame:
    """Conversations as they are: `placed_turns` and a row of place 0 for each."""
    return turns.unionByName(_starts(turns))


def rebuilt_conversations(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """`placed_turns` with each conversation's first turns taken from the first one of its hundred.

    How many is a hash of the id, at most 5. A row of place 0 stands for each conversation.
    """
    turns = scratch.put("placed", turns)
    ids = scratch.put("ids", turns.select("conv_id").distinct())
    heads = turns.where("place <= 5").select(
        F.col("conv_id").alias("base"), F.col("place").alias("at"), "digest", "chars"
    )
    plan = ids.select("conv_id", _base(F.col("conv_id")).alias("base"), _head(F.col("conv_id")).alias("head"))
    copied = plan.join(heads, "base").where("at <= head").select("conv_id", F.col("at").alias("place"), "digest", "chars")
    bases = heads.groupBy(F.col("base")).agg(F.max("at").alias("held"))
    gaps = plan.join(bases, "base", "left").select(
        "conv_id", (F.coalesce("held", F.lit(0)) - F.col("head")).alias("gap")
    )
    gaps = gaps.where("gap < 0")
    own = join_facts(turns.where(F.col("place") > _head(F.col("conv_id"))), gaps, ["conv_id"], left=True)
    own = own.withColumn("place", F.col("place") + F.coalesce("gap", F.lit(0))).drop("gap")
    return copied.unionByName(own).unionByName(_starts(ids))


def _starts(ids: DataFrame) -> DataFrame:
    empty = F.lit(0).cast("long")
    return ids.select("conv_id").distinct().select(
        "conv_id", empty.alias("place"), F.lit("").alias("digest"), empty.alias("chars")
    )


def _base(conv_id: Column) -> Column:
    return conv_id - conv_id % 100


def _head(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 6


def sequences(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences with the smallest member, weight, length and digest; and every member's digest."""
    hashed = [F.when(F.col("place") == 0, F.lit(0).cast("long")).otherwise(_hash(lane)).alias(f"h{lane}") for lane in (1, 2)]
    rows = scratch.put("turns", turns.select("conv_id", "place", "chars", *hashed))
    members = rows.groupBy("conv_id").agg(
        F.max("place").alias("depth"),
        F.bit_xor("h1").alias("h1"),
        F.bit_xor("h2").alias("h2"),
        F.sum("chars").alias("all_chars"),
    )
    members = scratch.put("members", members)
    collapsed = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.first("all_chars").alias("all_chars")
    )
    return scratch.put("sequences", collapsed), members


def _hash(lane: int) -> Column:
    return F.xxhash64(F.lit(lane), "place", "digest")


def prefixes(found: DataFrame, scratch: Scratch) -> DataFrame:
    """Every prefix of every distinct sequence: its digest, its parent's, weight, chars from its last turn on."""
    # `sequences` has stored the turns; those of the smallest member stand for a sequence.
    rows = scratch.read("turns")
    chosen = found.select("conv_id", "weight", "all_chars")
    rows = join_facts(rows, chosen, ["conv_id"])
    added = running(
        rows,
        "conv_id",
        "place",
        {"p1": (F.col("h1"), "bit_xor"), "p2": (F.col("h2"), "bit_xor"), "upto": (F.col("chars"), "sum")},
    )
    return added.select(
        F.col("conv_id").alias("sequence"),
        F.col("place").alias("depth"),
        F.col("p1").alias("h1"),
        F.col("p2").alias("h2"),
        F.col("p1").bitwiseXOR(F.col("h1")).alias("parent_h1"),
        F.col("p2").bitwiseXOR(F.col("h2")).alias("parent_h2"),
        "weight",
        (F.col("all_chars") - F.col("upto") + F.col("chars")).alias("rest"),
    )


def prefix_trie(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` comes from `whole_conversations` or `rebuilt_conversations`. A node's turns are the first
    `depth` ones of conversation `conv_id`.
    """
    found, members = sequences(turns, scratch)
    paths = scratch.put("prefixes", prefixes(found, scratch))
    nodes = paths.groupBy(*NODE).agg(
        F.min(F.struct("sequence", "rest", "parent_h1", "parent_h2")).alias("own"),
        F.sum("weight").alias("n_convs"),
        F.sum(F.col("weight") * F.col("rest")).alias("all_chars"),
    )
    nodes = scratch.put(
        "nodes",
        nodes.select(
            *NODE,
            F.col("own.sequence").alias("conv_id"),
            F.col("own.rest").alias("own_rest"),
            F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("own.parent_h1").alias("h1"), F.col("own.parent_h2").alias("h2"))).alias("parent"),
            "n_convs",
            "all_chars",
        ),
    )
    children = nodes.where("parent IS NOT NULL").groupBy("parent.depth", "parent.h1", "parent.h2")
    children = scratch.put("children", children.agg(F.count("*").alias("n_children")))
    leaves = found.join(children, NODE, "left_anti").select(F.col("conv_id").alias("sequence"), F.lit(1).alias("leaf"))
    top = F.min(F.struct("depth", "own_rest")).alias("top")
    owned = nodes.groupBy(F.col("conv_id").alias("sequence")).agg(top)
    facts = leaves.join(owned, "sequence", "full").select(
        "sequence", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.col("top.depth").alias("top"), F.col("top.own_rest").alias("owned_rest")
    )
    facts = scratch.put("facts", facts)
    # A prefix above the part of its path that its sequence owns counts all of that part.
    through = join_facts(paths.select("sequence", *NODE), facts, ["sequence"])
    through = through.groupBy(*NODE).agg(
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(F.col("depth") < F.col("top"), F.col("owned_rest")).otherwise(0)).alias("others_rest"),
    )
    ends = member_lists(members, scratch)
    wide = nodes.join(through, NODE, "left").join(children, NODE, "left").join(ends, NODE, "left")
    wide = scratch.put(
        "wide",
        wide.select(
            *NODE,
            "conv_id",
            F.col("parent.depth").alias("pd"),
            F.col("parent.h1").alias("p1"),
            F.col("parent.h2").alias("p2"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"),
            (F.col("all_chars") - F.col("own_rest") - F.coalesce("others_rest", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        ),
    )
    parents = nodes.select(
        F.col("depth").alias("pd"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    named = join_facts(wide, parents, ["pd", "p1", "p2"], left=True)
    return named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def member_lists(members: DataFrame, scratch: Scratch) -> DataFrame:
    """The SHA-256 of each sequence's member ids, ascending and comma-joined.

    Ids are sorted over all tasks and joined in pieces; one task then feeds the pieces of a list in
    order to its hash and holds one batch at a time.
    """
    order = [*NODE, "conv_id"]
    rows = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    spans = _list_pieces(rows)
    spans = scratch.put("lists", spans)
    fed = spans.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return fed.mapInArrow(_list_hashes, "depth long, h1 long, h2 long, ends_sha256 string")


def _list_pieces(rows: DataFrame) -> DataFrame:
    """Runs of up to `LIST_PIECE` sorted ids of one list: the node, the first id and the joined ids."""

    def run(batches):
        for batch in batches:
            out, last = [], None
            for *node, conv_id in zip(*(column.to_pylist() for column in batch.columns)):
                if node != last or len(out[-1][1]) == LIST_PIECE:
                    out.append((node, []))
                    last = node
                out[-1][1].append(conv_id)
            yield pa.RecordBatch.from_pylist(
                [
                    {"depth": n[0], "h1": n[1], "h2": n[2], "first": ids[0], "ids": ",".join(map(str, ids))}
                    for n, ids in out
                ],
                schema=pa.schema([*((name, pa.int64()) for name in (*NODE, "first")), ("ids", pa.string())]),
            )

    return rows.mapInArrow(run, "depth long, h1 long, h2 long, first long, ids string")


def _list_hashes(batches):
    node, state = None, None
    schema = pa.schema([*((name, pa.int64()) for name in NODE), ("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for depth, h1, h2, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if (depth, h1, h2) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, h1, h2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*node, state.hexdigest())))], schema=schema)
