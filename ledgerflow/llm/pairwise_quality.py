"""Quality classifier: Bradley-Terry pairwise ranking of documents.

Every labelled-good text is taken to be preferred to every labelled-bad one. A text's strength is
linear in features of its shape. Over preference pairs, drawn by a seeded hash from a bounded sample
of labelled rows, the logistic loss of the strength difference is minimised; it depends on feature
differences alone, so it has no bias. The cut between good and bad is a quantile of the sample's
strengths: the share of bad labels in it. The score is a logistic function of the distance to it.

Features come from whole texts and are bounded in number; each text is read once, in place. Null
and empty texts have defined features (all counts zero). Repeated rows get equal scores. Without
labelled rows of both classes, or over an empty table, every score is 0.5. Columns other than doc_id
and text are never read for a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.quality_rules import SYMBOLS, shape
from ledgerflow.llm.tables import held_out, labelled_texts, measure_texts
from ledgerflow.llm.words import LOWER, owners, span_hashes, text_sums, word_spans

KINDS = {
    "upper": list(range(65, 91)),
    "lower": list(range(97, 123)),
    "digit": list(range(48, 58)),
    "stop": list(b".!?"),
    "pause": list(b",;:"),
    "bang": list(b"!"),
    "newline": [10],
    "other": [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".!?,;:"],
    "high": list(range(128, 256)),
}


@dataclass(frozen=True)
class BradleyTerry:
    pairs: int = 60_000
    steps: int = 300
    rate: float = 0.05
    l2: float = 1e-3
    #: Most labelled documents learned from.
    most_labelled: int = 12_000


def describe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text."""
    found = shape(data, offsets)
    starts, ends, first = word_spans(data, offsets)
    count = len(offsets) - 1
    words, length = found["n_words"], np.diff(offsets)
    per_word, per_byte = np.maximum(1, words), np.maximum(1, length)
    sizes, text = ends - starts, owners(first)
    hashes = span_hashes(LOWER[data], starts, ends)
    order = np.lexsort((hashes, text))
    again = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    follows = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    columns = [
        np.log1p(words),
        np.log1p(length),
        (words < 10).astype(float),
        (words < 40).astype(float),
        found["word_chars"] / per_word,
        found["n_symbols"] / per_word,
        np.minimum(1.0, 5 * found["n_symbols"] / per_word),
        found["n_dup_lines"] / np.maximum(1, text_sums(data == 10, offsets) + 1),
        np.minimum(1.0, found["n_dup_lines"]),
        found["n_repeat_words"] / per_word,
        (found["n_repeat_words"] > 0.1 * words).astype(float),
        np.bincount(text[order][1:][again], minlength=count) / per_word,
        np.bincount(text[1:][follows], minlength=count) / per_word,
        np.bincount(text, weights=(sizes <= 3), minlength=count) / per_word,
        np.bincount(text, weights=(sizes >= 15), minlength=count) / per_word,
        np.sqrt(np.bincount(text, weights=SYMBOLS[data[ends - 1]], minlength=count) / per_word),
    ]
    for bytes_of_kind in KINDS.values():
        flags = np.zeros(256, bool)
        flags[bytes_of_kind] = True
        share = text_sums(flags[data], offsets) / per_byte
        columns += [share, np.sqrt(share)]
    return np.column_stack(columns).astype(float)


def fit(features: np.ndarray, labels: np.ndarray, p: BradleyTerry = BradleyTerry()) -> dict:
    """Strength weights from preference pairs, and the cut between good and bad."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    centre, scale = features.mean(axis=0), features.std(axis=0)
    scale[scale < 1e-9] = 1.0
    x = np.clip((features - centre) / scale, -5, 5)
    draw = np.random.default_rng(11)
    difference = x[draw.choice(good, p.pairs)] - x[draw.choice(bad, p.pairs)]
    w, first, second = np.zeros(x.shape[1]), 0.0, 0.0
    for step in range(1, p.steps + 1):  # Adam on the mean logistic loss of the differences
        wrong = 1 / (1 + np.exp(np.clip(difference @ w, -35, 35)))
        gradient = -(difference * wrong[:, None]).mean(axis=0) + p.l2 * w
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        w -= p.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    strength = x @ w
    cut = float(np.quantile(strength, len(bad) / len(labels)))
    return {"centre": centre, "scale": scale, "weights": w, "cut": cut}


def learn(docs: DataFrame, labels: DataFrame, p: BradleyTerry = BradleyTerry()) -> dict | None:
    """The fitted ranking, or None without labelled rows of both classes."""
    sample = labelled_texts(docs, labels, "quality", p.most_labelled)
    measured = measure_texts(
        sample,
        lambda data, offsets: {"features": list(describe(data, offsets))},
        "features array<double>",
        keep=("doc_id", "label"),
    ).toArrow()  # a bounded number of short rows
    if measured.num_rows == 0:
        return None
    features = np.array(measured["features"].to_pylist())
    labelled = measured["label"].to_numpy()
    order = np.lexsort((*features.T[:2], measured["doc_id"].to_numpy()))
    return fit(features[order], labelled[order], p) if len(set(labelled.tolist())) > 1 else None


def strengths(features: np.ndarray, model: dict) -> np.ndarray:
    x = np.clip((features - model["centre"]) / model["scale"], -5, 5)
    return x @ model["weights"]


def score_quality(docs: DataFrame, labels: DataFrame, p: BradleyTerry = BradleyTerry()) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    model = learn(docs, labels, p)

    def measure(data, offsets):
        if model is None:
            return {"score": np.full(len(offsets) - 1, 0.5)}
        distance = strengths(describe(data, offsets), model) - model["cut"]
        return {"score": 1 / (1 + np.exp(-np.clip(distance, -35, 35)))}

    return measure_texts(docs, measure, "score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
