"""Substring dedup by content-defined chunks.

A gear hash rolls over a text's words (lower-cased A-Z): it doubles and adds the next word's code.
Where its low bits are zero a chunk ends, so cuts depend on the last few words alone and an insertion
shifts no later cut. Stretches without a cut are split at a fixed length. Runs of consecutive chunks
with just `least_words` words or more, seen from their first or their last chunk, are identified by a
96-bit digest. A run that one document with a smaller id holds as a whole is repeated; repeated runs that
overlap or touch form a repeated passage. The first document keeps a passage, later ones lose it.

A passage's first and last words may fall into chunks that reach beyond it, so a stretch is shorter
than the passage by about a chunk on either side; `least_words` and `least_passage` allow for that.

Runs are sorted by digest and document over all tasks, once. A task reads its piece in order and keeps
one digest and the first document that holds it; a digest whose rows go on from one piece into the next,
such as that of a line in every document, is carried over by one row a piece. So no digest is held up by
one task, and only repeated runs are shuffled again. Texts aren't shuffled. Null and empty texts have no
chunks. Rows without an id can't be ordered and are left alone; rows that share an id are one document.
An empty table gives no spans. Other columns are ignored by `repeated_spans` and kept by `drop_spans`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.tables import Scratch
from ledgerflow.llm.words import LOWER, mix, span_hashes, text_blocks, word_spans


@dataclass(frozen=True)
class Chunking:
    #: A chunk ends where so many low bits of the gear hash are below `cut_below`.
    gear_bits: int = 4
    cut_below: int = 4
    most_words: int = 16
    #: Words of the shortest run of chunks that is looked for.
    least_words: int = 20
    #: Words of the shortest stretch of repeated runs that counts as a passage.
    least_passage: int = 28


def cut_words(hashes: np.ndarray, first: np.ndarray, p: Chunking) -> np.ndarray:
    """First word of every chunk of every text."""
    gear = np.zeros(len(hashes), np.uint64)
    codes = hashes & np.uint64((1 << p.gear_bits) - 1)
    place = np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))
    for back in range(min(p.gear_bits, len(hashes))):  # words further back are shifted out of the low bits
        gear[back:] += np.where(place[back:] >= back, codes[: len(hashes) - back] << np.uint64(back), np.uint64(0))
    ends = np.flatnonzero((gear & np.uint64((1 << p.gear_bits) - 1)) < np.uint64(p.cut_below)) + 1
    starts = np.union1d(ends, first[:-1])
    starts = starts[starts < len(hashes)]
    sizes = np.diff(np.append(starts, len(hashes)))
    parts = -(-sizes // p.most_words)
    inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(starts, parts) + inner * p.most_words


def chunk_runs(at: np.ndarray, to: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last chunk of the shortest runs of `least` words from each chunk on and up to each chunk.

    They cover every longer run: what a run from a chunk on leaves at its end is in one up to the end.
    """
    begin = np.arange(len(at))
    last = np.searchsorted(to, at + least)
    inside = last < len(at)
    inside[inside] = text[last[inside]] == text[inside]
    begin, last = begin[inside], last[inside]
    more = np.setdiff1d(np.arange(len(at)), last)
    back = np.searchsorted(at, to[more] - least, side="right") - 1
    fits = (back >= 0) & (text[back] == text[more])
    return np.concatenate([begin, back[fits]]), np.concatenate([last, more[fits]])


def run_rows(docs: DataFrame, p: Chunking) -> DataFrame:
    """doc_id, word (the run's first), words and digest (d1, d2) of every run of chunks."""

    def split(batches):
        for part, data, offsets in text_blocks(batches):
            data = LOWER[data]
            starts, ends, first = word_spans(data, offsets)
            hashes = span_hashes(data, starts, ends)
            at = cut_words(hashes, first, p)
            to = np.append(at[1:], len(hashes))
            text = np.searchsorted(first, at, side="right") - 1
            begin, last = chunk_runs(at, to, text, p.least_words)
            digests = []
            for salt in (0x1F83D9AB, 0x5BE0CD19):
                total = np.zeros(len(at), np.uint64)
                for k in range(p.most_words):
                    inside = at + k < to
                    total[inside] = mix(total[inside] * np.uint64(0x100000001B3) + (hashes[at[inside] + k] ^ np.uint64(salt)))
                whole = np.zeros(len(begin), np.uint64)
                for k in range(int((last - begin).max(initial=-1)) + 1):
                    inside = begin + k <= last
                    whole[inside] = mix(whole[inside] * np.uint64(0x100000001B3) + total[begin[inside] + k])
                digests.append(whole.view(np.int64))
            digests[1] = digests[1].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(text[begin])),
                    pa.array((at[begin] - first[text[begin]]).astype(np.int32)),
                    pa.array((to[last] - at[begin]).astype(np.int16)),
                    *map(pa.array, digests),
                ],
                ["doc_id", "word", "words", "d1", "d2"],
            )

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    return rows.mapInArrow(split, "doc_id long, word int, words short, d1 long, d2 int")


def _mark(batches):
    """Runs that an earlier document in this sorted piece holds, all of its first digest, and its ends.

    The two rows of ends have a null doc_id: the digest of the first and of the last run, each with the
    first document that holds it. `open` marks rows of the first digest, of which earlier pieces may hold some.
    """
    piece = TaskContext.get().partitionId()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("word", pa.int32()), ("words", pa.int16()), ("first_doc_id", pa.int64())]
        + [("open", pa.bool_()), ("piece", pa.int32()), ("d1", pa.int64()), ("d2", pa.int32())]
    )

    def end(digest, first_doc, is_open):
        return {"first_doc_id": first_doc, "open": is_open, "piece": piece, "d1": digest[0], "d2": digest[1]}

    head = last = None
    first_doc, is_open = 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        doc_id, word, words, d1, d2 = (column.to_numpy() for column in batch.columns)
        fresh = np.ones(len(d1), bool)
        fresh[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        fresh[0] = (d1[0], d2[0]) != last
        begins = np.flatnonzero(fresh)
        holders = np.concatenate([[first_doc], doc_id[begins]])[np.cumsum(fresh)]
        opened = np.zeros(len(d1), bool)
        if head is None:
            head = ((int(d1[0]), int(d2[0])), int(doc_id[0]))
            opened[: begins[1] if len(begins) > 1 else len(d1)] = True
        elif is_open:
            opened[: begins[0] if len(begins) else len(d1)] = True
        is_open = bool(opened[-1])
        last, first_doc = (int(d1[-1]), int(d2[-1])), int(holders[-1])
        told = np.flatnonzero(opened | (doc_id > holders))
        none = pa.nulls(len(told), pa.int64())
        arrays = [pa.array(column[told]) for column in (doc_id, word, words, holders, opened)]
        arrays += [pa.array(np.full(len(told), piece, np.int32)), none, none.cast(pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)
    if head is not None:
        rows = [end(*head, True), end(last, first_doc, is_open)]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def repeated_runs(runs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, word, words and first_doc_id of every run that a document with a smaller id holds, too."""
    order = ["d1", "d2", "doc_id"]
    pieces = runs.select("doc_id", "word", "words", "d1", "d2").repartitionByRange(*order).sortWithinPartitions(*order)
    columns = "doc_id long, word int, words short, first_doc_id long, open boolean, piece int, d1 long, d2 int"
    marked = scratch.put("marked", pieces.mapInArrow(_mark, columns))
    ends = marked.where("doc_id IS NULL").orderBy("piece", F.col("open").desc()).collect()  # two rows a piece
    carried, digest, holder = [], None, None
    heads = {}
    for row in ends:
        heads.setdefault(row.piece, []).append(row)
    for piece, rows in sorted(heads.items()):
        # The first digest's row is the open one; a piece of a single digest has two.
        head, tail = rows
        inherits = (head.d1, head.d2) == digest
        if inherits:
            carried.append((piece, holder))
        if not tail.open or not inherits:
            digest, holder = (tail.d1, tail.d2), tail.first_doc_id
    carried = runs.sparkSession.createDataFrame(carried, "piece int, held_by long")
    known = marked.where("doc_id IS NOT NULL").join(F.broadcast(carried), "piece", "left")
    first = F.when(F.col("open"), F.coalesce("held_by", "first_doc_id")).otherwise(F.col("first_doc_id"))
    known = known.withColumn("first_doc_id", first).where("doc_id > first_doc_id")
    return known.select("doc_id", "word", "words", "first_doc_id")


def repeated_spans(docs: DataFrame, scratch: Scratch, p: Chunking = Chunking()) -> DataFrame:
    """doc_id, word, words and first_doc_id of every passage that an earlier document holds, too."""
    again = repeated_runs(run_rows(docs, p), scratch)
    order = Window.partitionBy("doc_id").orderBy("word", "words")
    before = F.max(F.col("word") + F.col("words")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = again.withColumn("apart", F.coalesce(before < F.col("word"), F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        runs.groupBy("doc_id", "run")
        .agg(
            F.min("word").cast("long").alias("word"),
            (F.max(F.col("word") + F.col("words")) - F.min("word")).cast("long").alias("words"),
            F.min("first_doc_id").alias("first_doc_id"),
        )
        .drop("run")
        .where(F.col("words") >= p.least_passage)
    )


def drop_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`docs` with the words of the spans cut out of `text`, all other columns as they are.

    A cut goes from a span's first word to the next word after it, so the white space left around it
    is that of the text. A document of which nothing is left keeps an empty text.
    """
    cuts = spans.groupBy(F.col("doc_id").alias("cut_id")).agg(
        F.sort_array(F.collect_list(F.struct("word", "words"))).alias("cuts")
    )
    others = [name for name in docs.columns if name != "text"]
    rows = docs.select("doc_id", "text", F.struct(*others).alias("rest"))
    # Documents with cuts are a share of all of them: joined by a shuffle at any size.
    wide = rows.join(cuts.hint("merge"), F.col("doc_id") == F.col("cut_id"), "left").select("rest", "text", "cuts")

    def cut(batches):
        for part, data, offsets in text_blocks(batches):
            rest, texts, lists = part.columns
            if lists.null_count < part.num_rows:
                starts, _, first = word_spans(data, offsets)
                new = texts.to_pylist()
                for i, spans_of in enumerate(lists.to_pylist()):
                    if spans_of:
                        new[i] = _without(data, offsets[i], offsets[i + 1], starts[first[i] : first[i + 1]], spans_of)
                texts = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays([rest, texts], ["rest", "text"])

    done = wide.mapInArrow(cut, wide.drop("cuts").schema)
    return done.select(*(F.col("text") if name == "text" else F.col("rest")[name].alias(name) for name in docs.columns))


def _without(data: np.ndarray, begin: int, end: int, starts: np.ndarray, spans: list[dict]) -> str:
    kept, at = [], begin
    for span in spans:
        after = span["word"] + span["words"]
        if span["word"] < len(starts):
            kept.append(data[at : starts[span["word"]]].tobytes())
            at = starts[after] if after < len(starts) else end
    kept.append(data[at:end].tobytes())
    return b"".join(kept).decode("utf-8", "replace")


def dedupe_substrings(docs: DataFrame, scratch: Scratch, p: Chunking = Chunking()) -> DataFrame:
    """`docs` without the passages that an earlier document holds, too."""
    return drop_spans(docs, scratch.put("spans", repeated_spans(docs, scratch, p)))
