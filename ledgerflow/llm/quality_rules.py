"""Quality rules: fixed limits on a text's shape, and a hashed n-gram likelihood ratio.

Every text is described by hashed word n-grams (one and two words, lower-cased A-Z). Two
multinomials over the hash buckets are estimated: one from all documents, one from trusted ones. A
text's score is the mean over its n-grams of log(p_target / p_corpus), so length doesn't matter. A
text is kept if it breaks no fixed limit and scores at least the threshold.

The threshold comes from the data: it is a low quantile of the scores of trusted texts that break no
limit, each scored without its own n-grams in the target counts. So it moves with the ratios, which
shrink as the buckets fill up. It is a multiple of a ten-thousandth, taken from counts of all trusted
scores, and so the same in every run.

All counts cover every n-gram of every document, trusted ones included. Tasks send bucket counts, not
n-grams, so what is shuffled, collected and broadcast is bounded by the bucket count.

Null and empty texts have no words and break the word limit; a text of one word has one n-gram.
Repeated rows are judged alike. Without any trusted text that passes the limits, or over an empty
table, only the limits decide. Columns other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.tables import Scratch, measure_texts, rows_named
from ledgerflow.llm.words import LOWER, owners, span_hashes, text_blocks, text_sums, windows, word_spans

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    #: Highest share of words, in percent, that lie in repeated windows.
    max_repeat_percent: int = 20
    window: int = 5
    bits: int = 18
    #: Counts added to every bucket of both multinomials.
    smoothing: float = 0.1
    #: Share of trusted texts that would score below the threshold.
    quantile: float = 0.01


#: Steps of a score in which the threshold is found; scores lie within +-50, so there are at most a million.
STEPS = 10_000


def shape(data: np.ndarray, offsets: np.ndarray, window: int = 5) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    starts, ends, first = word_spans(data, offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    return {
        "n_words": np.diff(first),
        "word_chars": text_sums(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": text_sums(SYMBOLS[data], offsets),
        "n_dup_lines": repeated_lines(data, offsets, starts),
        "n_repeat_words": repeated_words(data, starts, ends, first, window),
    }


def repeated_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of it."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.union1d(breaks + 1, offsets[:-1])
    starts = starts[starts < len(data)]
    text = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), offsets[text + 1])
    ends = np.where((ends > starts) & (data[np.maximum(ends - 1, 0)] == 0x0A), ends - 1, ends)
    worded = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, text = starts[worded], ends[worded], text[worded]
    hashes = span_hashes(data, starts, ends)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    again = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    return np.bincount(text[1:][again], minlength=len(offsets) - 1)


def repeated_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, window: int
) -> np.ndarray:
    """Words of each text inside windows that it holds twice or more."""
    at, hashes = windows(span_hashes(data, starts, ends), first, window)
    text = np.searchsorted(first, at, side="right") - 1
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(starts) + window, bool)
    for k in range(window):
        covered[at[twice] + k] = True
    return text_sums(covered[: len(starts)], first)


def ngram_buckets(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket and text of every one-word and two-word n-gram, repeats included."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    at, pairs = windows(words, first, 2)
    text = owners(first)
    shift = np.uint64(64 - bits)
    return (
        np.concatenate([words >> shift, pairs >> shift]).astype(np.int64),
        np.concatenate([text, text[at]]),
    )


def bucket_counts(docs: DataFrame, bits: int) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""

    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        for _, data, offsets in text_blocks(batches):
            total += np.bincount(ngram_buckets(data, offsets, bits)[0], minlength=1 << bits)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << bits, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def log_ratios(target: np.ndarray, corpus: np.ndarray, smoothing: float) -> np.ndarray:
    """log(p_target / p_corpus) of each bucket; zeros if either has no n-gram."""
    if not target.sum() or not corpus.sum():
        return np.zeros(len(corpus), np.float32)
    p, q = target + smoothing, corpus + smoothing
    return (np.log(p / p.sum()) - np.log(q / q.sum())).astype(np.float32)


def _base_failed(n_words, n_repeat_words, rules: Rules):
    """Of columns or of arrays."""
    return (n_words < rules.min_words) | (100 * n_repeat_words > rules.max_repeat_percent * n_words)


def threshold(trusted: DataFrame, target: np.ndarray, corpus: np.ndarray, rules: Rules) -> float:
    """The quantile of trusted scores, each without the text's own n-grams in `target`."""
    shared = trusted.sparkSession.sparkContext.broadcast((target, corpus))
    bits, smoothing, size = rules.bits, rules.smoothing, 1 << rules.bits

    def score(batches):
        target, corpus = shared.value
        below = np.log(corpus + smoothing) - np.log(corpus.sum() + smoothing * size)
        for _, data, offsets in text_blocks(batches):
            found = shape(data, offsets, rules.window)
            buckets, text = ngram_buckets(data, offsets, bits)
            keys, n = np.unique(text.astype(np.int64) << bits | buckets, return_counts=True)
            buckets, text = keys & (size - 1), keys >> bits
            own = np.bincount(text, weights=n, minlength=len(offsets) - 1)
            above = np.log(target[buckets] - n + smoothing) - np.log(target.sum() - own + smoothing * size)[text]
            total = np.bincount(text, weights=n * (above - below[buckets]), minlength=len(own))
            passed = ~_base_failed(found["n_words"], found["n_repeat_words"], rules)
            steps = np.floor(total[passed] / np.maximum(1, own[passed]) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(steps)], ["step"])

    steps = trusted.select("text").mapInArrow(score, "step long").groupBy("step").count().orderBy("step").toArrow()
    upto = np.cumsum(steps["count"].to_numpy())
    if not len(upto):
        return -np.inf
    return steps["step"][int(np.searchsorted(upto, rules.quantile * upto[-1], side="right"))].as_py() / STEPS


def judge(docs: DataFrame, trusted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the five counts, score, base_failed and kept of each document."""
    target, corpus = bucket_counts(trusted, rules.bits), bucket_counts(docs, rules.bits)
    lowest = threshold(trusted, target, corpus, rules)
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(target, corpus, rules.smoothing))
    window, bits = rules.window, rules.bits

    def measure(data, offsets):
        found = shape(data, offsets, window)
        buckets, text = ngram_buckets(data, offsets, bits)
        count = len(offsets) - 1
        total = np.bincount(text, weights=shared.value[buckets], minlength=count)
        return found | {"score": total / np.maximum(1, np.bincount(text, minlength=count))}

    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return (
        measure_texts(docs, measure, f"{counts}, score double")
        .withColumn("base_failed", _base_failed(F.col("n_words"), F.col("n_repeat_words"), rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(float(lowest))))
    )


def trusted_texts(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """All texts labelled as good, stored, as they are read twice."""
    good = labels.where("quality = 1").select("doc_id")
    return scratch.put("trusted", rows_named(docs.select("doc_id", "text"), good, "doc_id").select("text"))
