"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hash buckets of its words, its word pairs, its pairs with one word
between and its words cut to stems of 5 and 7 bytes, lower-cased A-Z. Stems are words without their
endings: in languages with many endings each form of a word is rare. FTRL-proximal learns from a bounded sample of labelled rows: each
coordinate has its own learning rate, and the L1 term leaves most weights exactly zero. What is
broadcast is the list of other weights, at most 2**bits of them. Every whole text is then scored in
place; no text is shuffled.

Null and empty texts have only the bias as evidence. Repeated rows get equal scores. Without
labelled rows of both classes, or over an empty table, every score is the prior, by default 0.5.
Columns other than doc_id and text are never read for a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.tables import held_out, labelled_texts, measure_texts
from ledgerflow.llm.words import (
    ALPHANUMERIC,
    LOWER,
    SMALL_BLOCK_BYTES,
    give_back,
    owners,
    span_hashes,
    text_blocks,
    windows,
    word_spans,
)


@dataclass(frozen=True)
class Ftrl:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    #: With stems and weight, chosen by cross-validation within the rows learned from.
    l1: float = 60.0
    l2: float = 0.1
    #: Weight of a toxic example against a clean one.
    toxic_weight: float = 8.0
    #: Examples learned from, in passes over the shuffled sample.
    steps: int = 40_000
    #: Most labelled documents learned from.
    most_labelled: int = 18_000
    #: Score of a text from which it counts as toxic.
    threshold: float = 0.7


#: Bytes of a stem; shorter words have none.
STEMS = (5, 7)


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text and the text of each, ordered by text."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, ALPHANUMERIC)
    words = span_hashes(data, starts, ends)
    text = owners(first)
    at, pairs = windows(words, first, 2)
    over, skips = windows(words, first, 3)
    skips = words[over] * np.uint64(0x9E3779B97F4A7C15) + words[over + 2] * np.uint64(0xD6E8FEB86659FD93)
    shift = np.uint64(64 - bits)
    buckets = [words >> shift, pairs >> shift, (skips * np.uint64(0xA0761D6478BD642F)) >> shift]
    texts = [text, text[at], text[over]]
    for size in STEMS:
        longer = ends - starts > size
        stems = span_hashes(data, starts, np.minimum(ends, starts + size))[longer]
        buckets.append((stems * np.uint64(0xD1342543DE82EF95)) >> shift)
        texts.append(text[longer])
    keys = np.unique((np.concatenate(texts) << bits) | np.concatenate(buckets).astype(np.int64))
    return keys & ((1 << bits) - 1), keys >> bits


def ftrl(rows: list[tuple[int, np.ndarray]], p: Ftrl) -> np.ndarray:
    """Weights, the bias last, learned from (label, buckets) in the order given.

    The classes' log odds are a fixed offset, so that rare classes don't start with gradients
    against every common word.
    """
    size = 1 << p.bits
    z, n = np.zeros(size), np.zeros(size)
    bias_z = bias_n = 0.0

    def weights(z, n, l1):
        shrunk = np.where(np.abs(z) <= l1, 0.0, z - np.sign(z) * l1)
        return -shrunk / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)

    share = sum(label for label, _ in rows) / len(rows)
    prior = np.log(share / (1 - share))
    for step in range(p.steps):
        label, at = rows[step % len(rows)]
        z_at, n_at = z[at], n[at]
        w, bias = weights(z_at, n_at, p.l1), float(weights(bias_z, bias_n, 0.0))
        gradient = 1 / (1 + np.exp(-np.clip(prior + w.sum() + bias, -35, 35))) - label
        gradient *= p.toxic_weight if label else 1.0
        square = gradient * gradient
        z[at] = z_at + gradient - (np.sqrt(n_at + square) - np.sqrt(n_at)) / p.alpha * w
        n[at] = n_at + square
        bias_z += gradient - (np.sqrt(bias_n + square) - np.sqrt(bias_n)) / p.alpha * bias
        bias_n += square
    return np.append(weights(z, n, p.l1), weights(bias_z, bias_n, 0.0) + prior)


def learn(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray]:
    """Buckets with a weight and their weights; bucket 2**bits is the bias.

    Features are made where the texts are. One task learns from the bounded sample of feature lists.
    """

    def describe(batches):
        for part, data, offsets in text_blocks(batches, block=SMALL_BLOCK_BYTES):
            buckets, text = features(data, offsets, p.bits)
            cuts = np.searchsorted(text, np.arange(len(offsets)))
            lists = [buckets[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(lists, pa.binary())],
                ["doc_id", "label", "buckets"],
            )

    def train(batches):
        rows = []
        for batch in batches:
            for doc_id, label, buckets in zip(*(column.to_pylist() for column in batch.columns)):
                rows.append((doc_id, label, np.frombuffer(buckets, "<i4")))
            del batch
        if len({label for _, label, _ in rows}) < 2:
            return
        rows.sort(key=lambda row: (row[0], row[2].tobytes()))
        order = np.random.default_rng(7).permutation(len(rows))
        weights = ftrl([rows[i][1:] for i in order], p)
        used = np.flatnonzero(weights)
        del rows
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["bucket", "weight"])
        give_back()

    sample = labelled_texts(docs, labels, "toxic", p.most_labelled).select("doc_id", "label", "text")
    described = sample.mapInArrow(describe, "doc_id long, label int, buckets binary")
    learned = described.repartition(1).mapInArrow(train, "bucket long, weight double").toArrow()
    return learned["bucket"].to_numpy(), learned["weight"].to_numpy()


def scorer(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], p: Ftrl = Ftrl()):
    """A function from the bytes of texts and their first bytes to their scores."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tables: list[np.ndarray] = []

    def score(data, offsets):
        if not tables:
            dense = np.zeros((1 << p.bits) + 1)
            dense[shared.value[0]] = shared.value[1]
            tables.append(dense)
        buckets, text = features(data, offsets, p.bits)
        total = np.bincount(text, weights=tables[0][buckets], minlength=len(offsets) - 1) + tables[0][-1]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    score = scorer(docs, learn(docs, labels, p), p)
    measured = lambda data, offsets: {"score": score(data, offsets)}
    scored = measure_texts(docs, measured, "score double", block=SMALL_BLOCK_BYTES)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
    )
