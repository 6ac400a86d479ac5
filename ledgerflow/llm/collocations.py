"""Phrase collocations from stripes.

A stripe belongs to a prefix of words and counts the words that follow it. Tasks build stripes from
their texts, those of one prefix are merged elementwise, and the merged stripe gives three things:
how often each extension of the prefix occurs, the prefix total, and the largest extension, which
tells whether a longer phrase stands for the prefix. The stripe of the empty prefix counts single
words; its total is the number of all words.

Stripes are built level by level. A phrase can only be frequent if the phrases without its last and
without its first word are, so level k looks only at places where both are; a bitmap of hashes of the
frequent phrases of the level before says so. The bitmap has at most 2**27 bits (16 MiB), whatever the
data; where hashes meet, more is counted than needed and nothing is lost, as counts of the phrases
themselves decide. In a task, phrases are told apart by two 64-bit hashes, afterwards by their words.

The stripe of the empty prefix, and those of prefixes with more than one in `HOT_SHARE` of all words,
are cut into slices by the next word's hash, which spreads them over tasks. There are at most
`HOT_SHARE` such prefixes; their hashes are broadcast. A merging task reads its slices in sorted order
and holds one of them.

A-Z are lower-cased. Texts are cut at `.,;:!?` and 0x0A to 0x0D into pieces and those at spaces and
tabs into words; phrases lie within a piece. Null texts are empty, a null language is `und`. Repeated
rows count again. Phrases with equal scores are ordered by count, then by the phrase's bytes. An empty
table has no phrases. Columns other than lang and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.hot_keys import HOT_SHARE, join_facts
from ledgerflow.llm.tables import Scratch, hash_bitmap, in_bitmap
from ledgerflow.llm.words import LOWER, give_back, mix, owners, span_hashes, text_arrays, text_blocks, windows, word_spans

BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
IN_PHRASE_WORD = ~BREAKS
IN_PHRASE_WORD[[0x20, 0x09]] = False

#: Text bytes that a task counts at a time.
COUNTED_BYTES = 6 << 20
#: Most bits of a bitmap.
MOST_BITS = 1 << 27
#: The next words, joined by spaces, and their counts as 64-bit integers.
STRIPE = "lang string, prefix string, slice int, next string, n binary"


@dataclass(frozen=True)
class Phrases:
    most_words: int = 5
    least_count: int = 100
    #: A phrase goes if a longer one has so many percent of its occurrences.
    subsumed_percent: int = 100
    per_lang: int = 2000
    #: Slices of the stripe of the empty prefix and of hot prefixes.
    slices: int = 256


class _Pieces:
    """The words of a block of texts, in pieces, with the bytes of a phrase contiguous."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets, IN_PHRASE_WORD)
        breaks = np.concatenate([[0], np.cumsum(BREAKS[data])])
        self.text = owners(first)
        begins = np.ones(len(starts), bool)
        begins[1:] = (breaks[starts[1:]] != breaks[starts[:-1]]) | (self.text[1:] != self.text[:-1])
        self.first = np.append(np.flatnonzero(begins), len(starts))
        self.hashes = span_hashes(data, starts, ends)
        # One space after each word, nothing else between words.
        kept = np.zeros(len(data) + 1, np.int8)
        kept[starts] += 1
        kept[ends] -= 1
        kept = np.cumsum(kept[:-1], dtype=np.int8).astype(bool)
        spaces = ends[ends < len(data)]
        spaces = spaces[~kept[spaces]]  # elsewhere the next text begins with a word
        data[spaces], kept[spaces] = 0x20, True
        moved = np.concatenate([[0], np.cumsum(kept)])
        self.data, self.starts, self.ends = data[kept], moved[starts], moved[ends]

    def strings(self, begin: np.ndarray, end: np.ndarray) -> pa.Array:
        """The bytes from each place to the other, as texts."""
        sizes = end - begin
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = self.data[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], sizes)]
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
        return pa.Array.from_buffers(pa.string(), len(sizes), buffers)


def _runs(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return windows(hashes, first, width) if width > 1 else (np.arange(len(hashes)), mix(hashes))


def _lang_codes(langs: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Each row's language as a number, the languages, and a hash of each."""
    coded = langs.dictionary_encode()
    names = coded.dictionary.to_pylist()
    data = np.frombuffer("".join(names).encode(), np.uint8)
    ends = np.cumsum([len(name.encode()) for name in names], dtype=np.int64)
    hashes = span_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if names else np.zeros(0, np.uint64)
    return coded.indices.to_numpy(), names, hashes


def _stripes(docs: DataFrame, width: int, p: Phrases, shared) -> DataFrame:
    """Stripes of the prefixes of `width - 1` words, as far as a task's texts give them.

    From two words on `shared` has the bitmap of frequent phrases of a word less and the hot ones' hashes.
    """
    slices = np.uint64(p.slices)

    def build(batches):
        for part, data, offsets in text_blocks(batches, block=COUNTED_BYTES):
            codes, names, lang_hashes = _lang_codes(part.column(0))
            pieces = _Pieces(data, offsets)
            at, whole = _runs(pieces.hashes, pieces.first, width)
            lang = codes[pieces.text[at]]
            cut = np.ones(len(at), bool)
            if shared is not None:
                bitmap, hot = shared.value
                place, shorter = _runs(pieces.hashes, pieces.first, width - 1)
                shorter = mix(shorter ^ lang_hashes[codes[pieces.text[place]]])
                is_often, is_hot = np.zeros((2, len(pieces.hashes) + 1), bool)
                is_often[place[in_bitmap(bitmap, shorter)]] = True
                is_hot[place[np.isin(shorter, hot)]] = True
                both = is_often[at] & is_often[at + 1]
                at, whole, lang = at[both], whole[both], lang[both]
                cut = is_hot[at]
            if len(at):
                slice_of = np.where(cut, (pieces.hashes[at + width - 1] >> np.uint64(7)) % slices, np.uint64(0))
                yield _as_stripes(pieces, at, mix(whole ^ lang_hashes[lang]), lang, names, width, slice_of)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(build, STRIPE)


def _as_stripes(pieces: _Pieces, at, keys, lang, names, width: int, slice_of) -> pa.RecordBatch:
    """Counts of the phrases at the words `at`, one row for each prefix and slice."""
    one, counts = _distinct(keys, pieces, at, width)
    at, lang, cut = at[one], lang[one], slice_of[one]
    last = at + width - 1
    prefix = np.zeros(len(at), np.uint64)
    for k in range(width - 1):
        prefix = mix(prefix * np.uint64(0x100000001B3) + pieces.hashes[at + k])
    order = np.lexsort((cut, prefix, lang))
    at, last, lang, cut, prefix = at[order], last[order], lang[order], cut[order], prefix[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (lang[1:] != lang[:-1]) | (prefix[1:] != prefix[:-1]) | (cut[1:] != cut[:-1])
    rows = np.flatnonzero(fresh)
    begins = pieces.starts[at[rows]]
    prefix_ends = pieces.ends[last[rows] - 1] if width > 1 else begins
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()).take(pa.array(lang[rows])),
            pieces.strings(begins, prefix_ends),
            pa.array(cut[rows].astype(np.int32)),
            _joined(pieces.strings(pieces.starts[last], pieces.ends[last]), np.append(rows, len(at))),
            _packed(counts[order], np.append(rows, len(at))),
        ],
        ["lang", "prefix", "slice", "next", "n"],
    )


def _joined(words: pa.Array, at: np.ndarray) -> pa.Array:
    """The words from each place to the next one, with a space between."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), words), " ")


def _packed(counts: np.ndarray, at: np.ndarray) -> pa.Array:
    """The counts from each place to the next one, as bytes."""
    buffers = [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(counts.astype("<i8"))]
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, buffers)


def _unpacked(rows: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Next words and counts of all rows of stripes, and how many each row has."""
    data, offsets = text_arrays(rows.column(4))
    words = pc.split_pattern(rows.column(3), " ").flatten()
    return words, np.ascontiguousarray(data).view("<i8"), np.diff(offsets) // 8


def _distinct(keys, pieces: _Pieces, at, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct phrase and how often it occurs; a second hash tells equal keys apart."""
    second = np.zeros(len(at), np.uint64)
    for k in range(width):
        second = second * np.uint64(0xC6A4A7935BD1E995) + pieces.hashes[at + k]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if (second[order][1:][same] != second[order][:-1][same]).any():
        order = np.lexsort((second, keys))
        same = (keys[order][1:] == keys[order][:-1]) & (second[order][1:] == second[order][:-1])
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    return order[begins], np.diff(np.append(begins, len(order)))


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """lang, prefix, next and n of the entries of merged stripes with `least` occurrences; next "" has a slice's total."""
    key = ["lang", "prefix", "slice"]

    def merge(batches):
        held = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            closed, held = _merge_rows(rows)
            yield from _entries(closed, least)
        if held is not None:
            yield from _entries(held, least)
        give_back()

    dealt = stripes.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(merge, "lang string, prefix string, next string, n long")


def _merge_rows(rows: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
    """Sorted stripes merged elementwise: those before the last key, which may go on, and that one."""
    count = rows.num_rows
    if not count:
        return rows, None
    fresh = np.ones(count, bool)
    differs = [pc.not_equal(rows.column(i).slice(1), rows.column(i).slice(0, count - 1)).to_numpy(False) for i in range(3)]
    fresh[1:] = np.logical_or.reduce(differs)
    group = np.cumsum(fresh) - 1
    words, n, sizes = _unpacked(rows)
    entries = words.dictionary_encode()
    codes = (np.repeat(group, sizes).astype(np.int64) << 32) | entries.indices.to_numpy()
    keys, inverse = np.unique(codes, return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, inverse, n)
    at = np.searchsorted(keys, np.arange(group[-1] + 2, dtype=np.int64) << 32)
    one = pa.array(np.flatnonzero(fresh))
    whole = pa.RecordBatch.from_arrays(
        [
            *(rows.column(i).take(one) for i in range(3)),
            _joined(entries.dictionary.take(pa.array(keys & 0xFFFFFFFF)), at),
            _packed(totals, at),
        ],
        rows.schema.names,
    )
    last = whole.num_rows - 1
    held = pa.RecordBatch.from_arrays([column.take(pa.array([last])) for column in whole.columns], whole.schema.names)
    return whole.slice(0, last), held


def _entries(stripes: pa.RecordBatch, least: int):
    if not stripes.num_rows:
        return
    words, n, sizes = _unpacked(stripes)
    owner = np.repeat(np.arange(stripes.num_rows), sizes)
    totals = np.zeros(stripes.num_rows, np.int64)
    np.add.at(totals, owner, n)
    often = np.flatnonzero(n >= least)
    names = ["lang", "prefix", "next", "n"]
    rows = pa.array(owner[often])
    found = [stripes.column(0).take(rows), stripes.column(1).take(rows), words.take(pa.array(often)), pa.array(n[often])]
    yield pa.RecordBatch.from_arrays(found, names)
    empty = pa.array([""] * stripes.num_rows)
    yield pa.RecordBatch.from_arrays([stripes.column(0), stripes.column(1), empty, pa.array(totals)], names)


def _hashed(phrases: DataFrame, width: int) -> DataFrame:
    """`hash` of each (lang, phrase), as tasks that build stripes compute it."""

    def run(batches):
        for part, data, offsets in text_blocks(batches, "phrase"):
            codes, _, lang_hashes = _lang_codes(part.column(0))
            pieces = _Pieces(data, offsets)
            at, found = _runs(pieces.hashes, pieces.first, width)
            found = mix(found ^ lang_hashes[codes[pieces.text[at]]])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["hash"])

    return phrases.select("lang", "phrase").mapInArrow(run, "hash long")


def _hot(phrases: DataFrame, width: int, all_words: int) -> np.ndarray:
    """Hashes of the phrases with more than one in `HOT_SHARE` of all words, at most as many."""
    rows = _hashed(phrases.where(F.col("f") * HOT_SHARE > all_words), width).collect()
    return np.array([row.hash for row in rows], np.int64).view(np.uint64)


def count_phrases(docs: DataFrame, scratch: Scratch, p: Phrases = Phrases()) -> tuple[DataFrame, DataFrame]:
    """lang, words, prefix, next, phrase and f of every frequent phrase; and n of every language."""
    levels, shared = [], None
    for width in range(1, p.most_words + 1):
        entries = scratch.put(f"entries-{width}", merged(_stripes(docs, width, p, shared), p.least_count))
        if width == 1:
            totals = entries.where("next = ''").groupBy("lang").agg(F.sum("n").alias("n"))
            totals = scratch.put("totals", totals)
            all_words = totals.agg(F.sum("n")).first()[0] or 0
        phrase = F.col("next") if width == 1 else F.concat("prefix", F.lit(" "), "next")
        found = entries.where("next != ''").select(
            "lang", F.lit(width).alias("words"), "prefix", "next", phrase.alias("phrase"), F.col("n").alias("f")
        )
        levels.append(found)
        if width < p.most_words:
            if shared is not None:
                shared.unpersist()
            shared = docs.sparkSession.sparkContext.broadcast((hash_bitmap(_hashed(found, width), MOST_BITS), _hot(found, width, all_words)))
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.union(level)
    return scratch.put("phrases", whole), totals


def collocations(docs: DataFrame, scratch: Scratch, p: Phrases = Phrases()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases."""
    phrases, totals = count_phrases(docs, scratch, p)
    # The largest extension to the right comes from a phrase's own stripe, that to the left from
    # the stripes in which it ends an entry. A longer phrase can't occur more often than these.
    longer = phrases.where("words > 2")
    inside = longer.select("lang", F.col("prefix").alias("phrase"), "f").unionAll(
        longer.select("lang", F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)").alias("phrase"), "f")
    )
    largest = inside.groupBy("lang", "phrase").agg(F.max("f").alias("largest"))
    candidates = phrases.where("words >= 2").join(largest, ["lang", "phrase"], "left")
    kept = candidates.where(
        F.coalesce(100 * F.col("largest") < p.subsumed_percent * F.col("f"), F.lit(True))
    ).select("lang", "phrase", F.col("f").alias("a"), "words")
    k = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = kept.select("lang", "phrase", "a", k)
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = scratch.put("cuts", cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)")))
    counts = phrases.select("lang", "phrase", "f")
    cuts = join_facts(cuts, counts.toDF("lang", "left", "l"), ["lang", "left"])
    cuts = scratch.put("cuts-left", cuts)
    cuts = join_facts(cuts, counts.toDF("lang", "right", "r"), ["lang", "right"])
    # One row per language: left to Spark's check of its size.
    scored = cuts.join(totals, "lang").withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    rows = lowest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")
    return _best(scratch.put("scored", rows), p.per_lang)


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) without rounding: products have up to 38 digits."""
    product = (a * 1000).cast("decimal(19,0)") * n.cast("decimal(18,0)")
    return F.call_function("div", product, left.cast("decimal(18,0)") * right.cast("decimal(18,0)")).cast("long")


def _best(rows: DataFrame, most: int) -> DataFrame:
    """The first `most` rows of each language: the first of each of 64 parts, then those of all parts."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = rows.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    rows = rows.where(F.col("place") <= most)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = rows.withColumn("rank", rank).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
