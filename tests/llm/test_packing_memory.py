"""What a packing task holds and passes on at once, and hashes of words longer than what is hashed together."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext

from ledgerflow.llm import packing, words
from ledgerflow.llm.queries import tokenizer_path
from ledgerflow.llm.tables import Scratch


class Tasks:
    """Stands in for a table and takes the function that its tasks would run."""

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        raise InterruptedError


def task(settings, monkeypatch):
    monkeypatch.setattr(TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    tasks = Tasks()
    with pytest.raises(InterruptedError):
        packing.pack(tasks, None, settings)
    return tasks.run


def texts_batch(texts):
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def assert_gapless(rows, most):
    places = {}
    for row in rows:
        places.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in places.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= most
    return places


def test_a_pool_is_held_once_and_leaves_in_small_batches(monkeypatch):
    from tokenizers import Tokenizer

    draw = random.Random(5)
    known = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(300)]
    texts = [" ".join(draw.choices(known, k=draw.randint(300, 1500))) for _ in range(900)]
    run = task(packing.Packing(tokenizer=tokenizer_path(), pool_tokens=1 << 20), monkeypatch)
    rows, before, most, largest = [], pa.total_allocated_bytes(), 0, 0
    for batch in run(iter([texts_batch(texts)])):
        most, largest = max(most, pa.total_allocated_bytes() - before), max(largest, batch.nbytes)
        rows += batch.to_pylist()
    assert sum(len(r["ids"]) for r in rows) > 6 << 20, "more than a pool of 4 MB of ids"
    assert largest < 3 << 19, "a batch of all pieces of a pool"
    assert most < 10 << 20, "copies of a pool's ids beside the texts, which are 5 MB"
    own = Tokenizer.from_file(tokenizer_path())
    for doc in range(0, 900, 100):
        pieces = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["piece"])
        wanted = np.array(own.encode(texts[doc], add_special_tokens=False).ids + [0], "<u4")
        assert b"".join(r["ids"] for r in pieces) == wanted.tobytes()
        assert [r["start"] for r in pieces] == [2048 * i for i in range(len(pieces))]
    places = assert_gapless(rows, 2048)
    room = {k: 2048 - sum(n for _, n in parts) for k, parts in places.items()}
    assert all(r["room"] == room[r["sequence_id"]] for r in rows)


def test_a_pool_of_tiny_pieces_is_bounded_too(monkeypatch):
    run = task(packing.Packing(tokenizer=tokenizer_path(), pool_pieces=3000), monkeypatch)
    rows = [r for batch in run(texts_batch([None, ""] * 1500) for _ in range(3)) for r in batch.to_pylist()]
    assert len(rows) == 9000 and all(r["ids"] == bytes(4) for r in rows)
    assert sorted(map(len, assert_gapless(rows, 2048).values())) == [952] * 3 + [2048] * 3


def test_the_second_level_gathers_lengths_without_ids(spark):
    text = " ".join(str(n) for n in range(170))
    docs = spark.createDataFrame([(n % 5, text) for n in range(20)] + [(None, None), (None, "x")], "doc_id long, text string")
    packed = packing.pack(docs.repartition(8), Scratch(spark, "test"), packing.Packing(tokenizer=tokenizer_path()))
    plan = packed._jdf.queryExecution().optimizedPlan().toString().split("\n")
    gathered = [plan[i + 1] for i, line in enumerate(plan) if "FlatMapGroupsInArrow" in line]
    assert len(gathered) == 1 and "length#" in gathered[0] and "ids#" not in gathered[0]
    rows = [r.asDict() for r in packed.collect()]
    assert len(rows) == 22 and sorted(r["length"] * 4 - len(r["ids"]) for r in rows) == [0] * 22
    assert len({bytes(r["ids"]) for r in rows}) == 3
    each = max(r["length"] for r in rows)
    assert len(assert_gapless(rows, 2048)) <= 20 // (2048 // each) + 1, "sequences of several tasks are filled up together"


def test_hashes_of_long_words_are_those_of_their_bytes():
    draw = np.random.default_rng(3)
    step, most = words.HASHED_BYTES, 2 * words.BLOCK_BYTES
    sizes = [1, 9, step - 1, step, step + 1, 2 * step + 5, most, most + 1]
    data = np.frombuffer(b" ".join(draw.integers(33, 256, n, np.uint8).tobytes() for n in sizes), np.uint8)
    starts, ends, _ = words.word_spans(data, np.array([0, len(data)]))
    found = words.span_hashes(data, starts, ends)
    for k, (a, b) in enumerate(zip(starts, ends)):
        alone = words.span_hashes(data[a:b], np.array([0]), np.array([b - a]))
        assert alone[0] == found[k]
        if b - a <= most:
            powers = np.full(b - a, words._BASE, np.uint64)
            powers[0] = 1
            total = (words._BYTE_CODES[data[a:b]] * np.cumprod(powers)).sum() + np.uint64(b - a)
            assert words.mix(np.array([total]))[0] == found[k]


def test_hashing_a_block_takes_little_beside_its_words():
    data = np.frombuffer(b"abcd " * (words.BLOCK_BYTES // 5), np.uint8)
    starts, ends, _ = words.word_spans(data, np.array([0, len(data)]))
    words.span_hashes(data[:100], starts[:20], ends[:20])  # the powers stay
    tracemalloc.start()
    words.span_hashes(data, starts, ends)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 12 << 20, "arrays over a whole block of text"
    assert sum(p.nbytes for p in words._powers()) < 8 << 20
