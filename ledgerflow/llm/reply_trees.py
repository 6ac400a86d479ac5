"""Chat formatting of reply trees, with DataFrame operations only.

A tree's messages name their parent. Self-joins by pointer doubling find each message's root, depth
and summed score in as many rounds as the depth has binary digits. Leaves are branches; each tree's
branches are ranked by summed score, ties by leaf id. The messages of the chosen branches are then
enumerated with the same doubling tables, and each path is formatted as one conversation.

Template: `<|im_start|>role`, a line break, the text, `<|im_end|>`, a line break. A control string in
a text gets a backslash after its first character, and one that already has backslashes there gets
one more; so no text holds a control string, and removing one backslash restores it. Line breaks and
backslashes in roles are escaped, too. The loss mask lists where assistant texts start and how long
they are, in code points of the formatted string.

Null roles and texts are empty. A null tree id is a tree of its own. A message without a parent, or
whose parent isn't in its tree, is a root. Of rows with equal tree and message ids one stays, the
first by role, text, parent and score. Messages that lead to no root, being under a cycle, are in no
path. An empty table gives no conversations. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.tables import Scratch

START, END = "<|im_start|>", "<|im_end|>\n"
#: What follows the first character of a control string.
_REST = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|/?s>|/?INST\]|</?SYS>>|unk>|pad>)"
ESCAPE = r"([<\[])(\\*)" + _REST
UNESCAPE = r"([<\[])\\(\\*)" + _REST


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\e")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\e"), F.lit("\\")))


def turns_as_messages(turns: DataFrame) -> DataFrame:
    """Rows by turn as a reply tree: every row answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select(
        F.col("conv_id").alias("tree_id"), F.row_number().over(order).cast("long").alias("message_id"), "role", "text"
    )
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return numbered.withColumns({"parent_id": parent, "score": F.lit(1.0)})


def choose_paths(messages: DataFrame, scratch: Scratch, branches: int = 1) -> DataFrame:
    """tree_id, leaf_id, rank, step (0 at the leaf), role and text of the best branches' messages."""
    spark = messages.sparkSession
    first = F.min(F.struct("role", "text", "parent_id", "score")).alias("m")
    nodes = scratch.put(
        "messages", messages.groupBy("tree_id", "message_id").agg(first).select("tree_id", "message_id", "m.*")
    )
    known = nodes.select(F.col("tree_id").alias("t"), F.col("message_id").alias("m"))
    linked = nodes.join(known, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("parent_id") == F.col("m")), "left")
    jumps = [
        scratch.put(
            "jump-0",
            linked.select(
                "tree_id",
                "message_id",
                F.col("m").alias("up"),
                F.coalesce("score", F.lit(0.0)).alias("total"),
            ),
        )
    ]
    most_rounds = max(1, nodes.count()).bit_length()
    while len(jumps) <= most_rounds and not jumps[-1].where("up IS NOT NULL").isEmpty():
        low = jumps[-1]
        high = low.select(
            F.col("tree_id").alias("t"), F.col("message_id").alias("m"), F.col("up").alias("up2"), F.col("total").alias("add")
        )
        moving, done = low.where("up IS NOT NULL"), low.where("up IS NULL")  # only the former are joined
        joined = moving.join(high, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("up") == F.col("m")), "left")
        total = F.col("total") + F.coalesce("add", F.lit(0.0))
        step = joined.select("tree_id", "message_id", F.col("up2").alias("up"), total.alias("total"))
        jumps.append(scratch.put(f"jump-{len(jumps)}", step.unionByName(done)))

    parents = nodes.where("parent_id IS NOT NULL").select(F.col("tree_id").alias("t"), F.col("parent_id").alias("m"))
    rooted = jumps[-1].where("up IS NULL")  # what is still on its way after so many rounds circles
    leaves = rooted.join(parents, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("message_id") == F.col("m")), "left_anti")
    best = Window.partitionBy("tree_id").orderBy(F.col("total").desc(), "message_id")
    ranked = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    paths = scratch.put(
        "paths-0",
        ranked.select("tree_id", F.col("message_id").alias("leaf_id"), "rank", "message_id", F.lit(0).cast("long").alias("step")),
    )
    for k, jump in enumerate(jumps[:-1]):
        ahead = jump.where("up IS NOT NULL").select(F.col("tree_id").alias("t"), F.col("message_id").alias("m"), "up")
        further = paths.join(ahead, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("message_id") == F.col("m")))
        moved = further.select("tree_id", "leaf_id", "rank", F.col("up").alias("message_id"), F.col("step") + F.lit(2**k))
        paths = scratch.put(f"paths-{k + 1}", paths.union(moved))
        scratch.drop(f"paths-{k}")
    texts = nodes.select(F.col("tree_id").alias("t"), F.col("message_id").alias("m"), "role", "text")
    found = paths.join(texts, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("message_id") == F.col("m")))
    return found.select("tree_id", "leaf_id", "rank", "step", "role", "text")


def format_paths(paths: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """tree_id, leaf_id, rank, formatted and loss_spans: one row per path."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    parts = paths.withColumns({"head": F.concat(F.lit(START), escape_role(role), F.lit("\n")), "body": escape(text)})
    parts = parts.withColumn("segment", F.concat("head", "body", F.lit(END)))
    down = Window.partitionBy("tree_id", "leaf_id", "rank").orderBy(F.col("step").desc())
    before = F.coalesce(F.sum(F.length("segment")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.struct((before + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    parts = parts.withColumn("span", F.when(role == trained_role, span))
    grouped = parts.groupBy("tree_id", "leaf_id", "rank").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("step")).alias("at"), "segment"))).alias("segments"),
        F.sort_array(F.collect_list("span")).alias("loss_spans"),
    )
    formatted = F.array_join(F.transform("segments", lambda s: s["segment"]), "")
    return grouped.select("tree_id", "leaf_id", "rank", formatted.alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of role and text."""
    pieces = F.split(formatted, END.replace("|", r"\|"))
    pieces = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda s: F.substr(s, F.lit(len(START) + 1)))

    def turn(piece: Column) -> Column:
        end = F.instr(piece, "\n")
        role = F.substr(piece, F.lit(1), end - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(piece, end + 1)).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    found = F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(found, "")


def sample_turns(spark: SparkSession) -> DataFrame:
    """A conversation whose texts are control strings of templates."""
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
