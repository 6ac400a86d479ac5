"""Repeated passages against a plain version of chunks, runs and stretches."""

import random

import numpy as np
import pytest

from ledgerflow.llm import substring_dedup
from ledgerflow.llm.tables import Scratch
from ledgerflow.llm.words import span_hashes

P = substring_dedup.Chunking()


def code(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0]) % (1 << P.gear_bits)


def chunks(words):
    """Bounds of each chunk, by rolling the gear hash word by word."""
    gear, cuts = 0, [0]
    for i, word in enumerate(words):
        gear = ((gear << 1) + code(word)) % (1 << P.gear_bits)
        if gear < P.cut_below and i + 1 < len(words):
            cuts.append(i + 1)
    out = []
    for begin, end in zip(cuts, [*cuts[1:], len(words)]):
        out += [(at, min(at + P.most_words, end)) for at in range(begin, end, P.most_words)]
    return out


def runs(words):
    """First word and words of every run: from each chunk on, and up to chunks that none of those ends with."""
    parts = chunks(words)
    found = {}
    for i in range(len(parts)):
        for j in range(i, len(parts)):
            if parts[j][1] - parts[i][0] >= P.least_words:
                found[i] = j
                break
    for j in set(range(len(parts))) - set(found.values()):
        for i in range(j, -1, -1):
            if parts[j][1] - parts[i][0] >= P.least_words:
                found.setdefault((i, j), j)
                break
    spans = [(key if isinstance(key, int) else key[0], j) for key, j in found.items()]
    return [(parts[i][0], parts[j][1], tuple(parts[k][0] - parts[i][0] for k in range(i, j + 1))) for i, j in spans]


def brute_force(docs):
    words = {}
    for doc_id, text in docs:
        if doc_id is not None and text is not None:
            words.setdefault(doc_id, []).append([w for w in text.lower().replace("\n", " ").split(" ") if w])
    holders, spots = {}, []
    for doc_id, texts in words.items():
        for text in texts:
            for begin, end, cuts in runs(text):
                key = (tuple(text[begin:end]), cuts)
                holders.setdefault(key, set()).add(doc_id)
                spots.append((doc_id, begin, end, key))
    out = []
    for doc_id in words:
        again = sorted((b, e, min(holders[key])) for d, b, e, key in spots if d == doc_id and min(holders[key]) < doc_id)
        merged = []
        for begin, end, first in again:
            if merged and begin <= merged[-1][1]:
                merged[-1] = [merged[-1][0], max(merged[-1][1], end), min(merged[-1][2], first)]
            else:
                merged.append([begin, end, first])
        out += [(doc_id, b, e - b, first) for b, e, first in merged if e - b >= P.least_passage]
    return sorted(out)


def prose(count, seed):
    draw = random.Random(seed)
    return [f"{draw.choice('abcdef')}{draw.randrange(400)}" for _ in range(count)]


@pytest.fixture(scope="module")
def docs():
    passages = [prose(length, 100 + length) for length in (15, 25, 35, 51, 60, 200)]
    draw, out = random.Random(1), []
    for doc_id in range(60):
        text = prose(draw.randint(0, 60), doc_id)
        for _ in range(draw.randint(0, 3)):
            text += draw.choice(passages) + prose(draw.randint(1, 30), 1000 * doc_id + len(text))
        out.append((doc_id, " ".join(text).upper() if doc_id % 7 == 0 else "  ".join(text)))
    line = " ".join(prose(40, 7))
    out += [(100 + i, f"{line}\nown {' '.join(prose(30, 500 + i))}") for i in range(80)]  # a line in most documents
    return [*out, (200, None), (201, ""), (None, line), (202, line), (202, line), (203, "same " * 300), (204, "same " * 300)]


@pytest.mark.parametrize("pieces", [1, 7, 64])
def test_spans_equal_brute_force_however_pieces_fall(spark, docs, pieces):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(pieces))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, d1 string, piece int")
        spans = substring_dedup.repeated_spans(frame.repartition(3), Scratch(spark, "test-spans")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, spans)) == brute_force(docs)


def test_cut_texts_lose_the_spans_and_keep_clashing_columns(spark, docs):
    names = "doc_id long, rest string, text string, cuts int, word int"
    frame = spark.createDataFrame([(i, "r", t, 1, 2) for i, t in docs], names)
    cut = substring_dedup.dedupe_substrings(frame, Scratch(spark, "test-spans"))
    assert cut.columns == frame.columns and cut.count() == frame.count()
    spans = {}
    for doc_id, word, words, _ in brute_force(docs):
        spans.setdefault(doc_id, set()).update(range(word, word + words))
    for row in cut.where("doc_id IS NOT NULL AND doc_id <> 202").collect():
        text = dict(docs)[row.doc_id]
        wanted = None if text is None else [w for i, w in enumerate(text.split()) if i not in spans.get(row.doc_id, ())]
        assert (row.text if row.text is None else row.text.split()) == wanted and (row.rest, row.cuts, row.word) == ("r", 1, 2)
