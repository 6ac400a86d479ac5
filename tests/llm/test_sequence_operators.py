"""Byte BPE, prefix trie and phrase stripes against plain-Python versions, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

from ledgerflow.llm import byte_bpe, collocations, hot_keys, prefix_trie
from ledgerflow.llm.queries import tokenizer_path
from ledgerflow.llm.tables import Scratch


@pytest.fixture(scope="module")
def vocabulary(spark):
    path = f"file://{tokenizer_path('byte_bpe_multi_50k.tiktoken')}"
    return byte_bpe.Vocabulary.load(spark, path, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encode(vocabulary):
    ranks = {token: rank for rank, token in enumerate(vocabulary.tokens()) if token}
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
    return library.encode_ordinary


def texts():
    draw = random.Random(3)
    some = ["".join(draw.choices("ab cdeé \n\t'sß中文١² \x1c\x85😀", k=draw.randint(1, 120))) for _ in range(200)]
    return [None, "", " ", "a", "don't  stop\n\n  x ", "ab" * 30_000, "é" * 9_999, "the " * 50_000, *some, some[0]]


def test_bpe_equals_the_library_and_decodes_to_the_text(spark, vocabulary, encode):
    rows = [(i, text, "x", b"y") for i, text in enumerate(texts())] + [(None, "null id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded binary")
    found = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, vocabulary), vocabulary).collect()
    assert len(found) == len(rows)
    for row, (doc_id, text, *_) in zip(sorted(found, key=lambda r: (r[0] is None, r[0])), rows):
        ids = [int.from_bytes(row.ids[k : k + 4], "little") for k in range(0, len(row.ids), 4)]
        assert row.doc_id == doc_id and ids == encode(text or "") and bytes(row.decoded) == (text or "").encode()


def test_bpe_takes_every_character_and_forgets(vocabulary, encode):
    encoder = byte_bpe.Encoder(vocabulary)
    points = [f"a{chr(c)}1{chr(c)} {chr(c)}x" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    ids, at = encoder.encode(points)
    assert all(ids[a:b].tolist() == encode(text) for text, a, b in zip(points, at[:-1], at[1:]))
    encoder.ids.extend([0] * byte_bpe.MOST_REMEMBERED_IDS)
    ids, at = encoder.encode(points[:10])
    assert ids.tolist() == [i for text in points[:10] for i in encode(text)] and len(encoder.ids) < 1000


def test_bpe_merges_a_lower_rank_that_a_merge_makes_first():
    # "ab" comes up first; "abc" has a lower rank than "ab" and must be merged before the next "ab".
    ranks = [b"abc", *(bytes([c]) for c in range(256)), b"ab", b"ca", b"bcab"]
    lines = "".join(f"{byte_bpe.base64.b64encode(token).decode()} {rank}\n" for rank, token in enumerate(ranks))
    vocabulary = byte_bpe.Vocabulary(lines, r"\S+")
    library = tiktoken.Encoding(
        "own", pat_str=r"\S+", mergeable_ranks={t: i for i, t in enumerate(ranks)}, special_tokens={}
    )
    encoder, draw = byte_bpe.Encoder(vocabulary), random.Random(5)
    for _ in range(500):
        text = "".join(draw.choices("abcd", k=draw.randint(1, 40)))
        assert encoder.merge([text.encode()])[0].tolist() == library.encode_ordinary(text)


def test_rank_queue_gives_ranks_in_order():
    draw, queue = random.Random(2), byte_bpe.RankQueue(262_144)
    wanted = defaultdict(list)
    for position in range(3_000):
        rank = draw.choice([0, 63, 64, 4095, 4096, 262_143, draw.randrange(262_144)])
        queue.push(rank, position)
        wanted[rank].append(position)
    assert [queue.pop() for _ in range(len(wanted))] == sorted(wanted.items()) and queue.pop() is None
    with pytest.raises(ValueError):
        byte_bpe.RankQueue(262_145)


def test_bpe_of_an_empty_table_and_of_unknown_ids(spark, vocabulary):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode_texts(docs, vocabulary).count() == 0
    odd = spark.createDataFrame([(1, None), (2, b"\xff\xff\xff\x7f")], "doc_id long, ids binary")
    assert byte_bpe.decode_ids(odd.where("doc_id = 1"), vocabulary).first().decoded == b""
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode_ids(odd, vocabulary).collect()


def trie(rows):
    """The nodes of rebuilt conversations, from rows (conv_id, turn, role, text)."""
    talks = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            talks[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: tuple(turn[2:] for turn in sorted(turns)) for c, turns in talks.items()}
    built = {}
    for c, own in said.items():
        head = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = said.get(base, ())[:head] + own[head:]
    members, kids, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in built.items():
        ends[turns].append(c)
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(c)
            if depth:
                kids[turns[: depth - 1]].add(turns[:depth])
    saved, leaves = Counter(), Counter()
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:depth]] += node not in kids
    return sorted(
        (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            len(kids[node]) if node in kids else 0,
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def conversations():
    draw, rows = random.Random(4), []
    for c in [*range(-120, 20), *range(100, 160), 250, 399, 1000]:
        for turn in range(draw.randint(1, 7)):
            rows.append((c, turn, draw.choice(["user", "assistant", None]), draw.choice(["", "é", "one", "two words", None])))
    rows += [(100, None, "user", "first"), (100, None, None, "before"), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    rows += [(None, 0, "user", "nobody"), (7, 9, "user", "long " * 20_000)]
    return rows


def rebuilt(spark, rows):
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "conv_id long, turn long, role string, text string, place long, depth string")
    scratch = Scratch(spark, "test-trie")
    turns = prefix_trie.rebuilt_conversations(prefix_trie.placed_turns(docs, scratch), scratch)
    return sorted(map(tuple, prefix_trie.prefix_trie(turns, scratch).collect()), key=lambda row: (row[0], row[1], row[7]))


def test_trie_equals_brute_force(spark):
    rows = conversations()
    assert rebuilt(spark, rows) == sorted(trie(rows), key=lambda row: (row[0], row[1], row[7]))
    assert rebuilt(spark, []) == []


def test_trie_spreads_long_conversations_and_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "PIECE_ROWS", 8)
    monkeypatch.setattr(hot_keys, "HOT_SHARE", 5)
    monkeypatch.setattr(prefix_trie, "LIST_PIECE", 3)
    rows = [(c, turn, "user", f"{turn % 3}") for c in (0, 3, 100, 101) for turn in range(100)]
    rows += [(c, 0, "user", "same") for c in range(200, 300)]
    assert rebuilt(spark, rows) == sorted(trie(rows), key=lambda row: (row[0], row[1], row[7]))


def test_trie_of_conversations_as_they_are(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "no")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    scratch = Scratch(spark, "test-trie")
    turns = prefix_trie.whole_conversations(prefix_trie.placed_turns(docs, scratch))
    found = {(r.conv_id, r.depth): r for r in prefix_trie.prefix_trie(turns, scratch).collect()}
    assert set(found) == {(1, 0), (1, 1), (1, 2), (3, 2)}
    assert found[1, 1].n_convs == 3 and found[1, 1].n_leaves == 2 and found[1, 1].saved_tokens == 4
    assert found[1, 1].ends_sha256 == hashlib.sha256(b"2").hexdigest()


def best(docs, least, most=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in often.items():
            inside = (q for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * often[q] >= 100 * a for q in inside):
                continue
            cut = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cut)
            rows.append((" ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, rank, *row) for rank, row in enumerate(rows[:most], 1)]
    return sorted(out)


def phrase_texts():
    draw = random.Random(6)
    vocabulary = ["the", "of", "Not", "é", "中文", "x-y", "a b", "\x1c", "", "longer"]
    out = [(None, "en"), ("", "en"), ("  \t ", None), ("one.two,three", "de")]
    for _ in range(400):
        words = draw.choices(vocabulary, k=draw.randint(1, 40))
        glue = draw.choice([" ", "  ", "\t", " \t "])
        out.append((glue.join(words) + draw.choice(["", ".", "\n", " \r\n"]) + "of the people", draw.choice(["en", "fr", None, "und"])))
    return [*out, out[-1], ("word " * 40_000, "en"), ("In spite of it. " * 30, "de")]


def mined(spark, docs, p):
    frame = spark.createDataFrame([(i, t, g, "x", 1) for i, (t, g) in enumerate(docs)], "doc_id long, text string, lang string, prefix string, n long")
    found = collocations.collocations(frame.repartition(5), Scratch(spark, "test-phrases"), p)
    return sorted(map(tuple, found.collect()))


def test_phrases_equal_brute_force(spark, monkeypatch):
    docs = phrase_texts()
    assert mined(spark, docs, collocations.Phrases(least_count=12)) == best(docs, 12)
    assert mined(spark, docs, collocations.Phrases(least_count=12, per_lang=7)) == best(docs, 12, 7)
    monkeypatch.setattr(hot_keys, "HOT_SHARE", 3)
    monkeypatch.setattr(collocations, "HOT_SHARE", 8)
    monkeypatch.setattr(collocations, "MOST_BITS", 8)  # a bitmap that is full loses nothing
    assert mined(spark, docs, collocations.Phrases(least_count=12, slices=2)) == best(docs, 12)


def test_phrases_of_an_empty_table(spark):
    assert mined(spark, [], collocations.Phrases()) == []


def test_phrase_score_is_exact(spark):
    rows = [(10**13 + 7, 10**16 + 3, 10**13 + 7, 10**13 + 9), (99_999_999_999_999, 99_999_999_999_999_999, 10**14, 10**14 - 1), (123, 4567, 89, 1011)]
    frame = spark.createDataFrame(rows, "a long, n long, l long, r long")
    found = [row[0] for row in frame.select(collocations.score(frame.a, frame.n, frame.l, frame.r)).collect()]
    assert found == [1000 * a * n // (left * right) for a, n, left, right in rows]


def test_join_facts_keeps_rows_with_and_without_facts(spark, monkeypatch):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2] * 50 + [3, 4, None])], "k long, i long")
    facts = spark.createDataFrame([(1, "a"), (3, "c"), (9, "z")], "k long, fact string")
    for share in (1, 3, 1000):
        monkeypatch.setattr(hot_keys, "HOT_SHARE", share)
        found = {r.i: r.fact for r in hot_keys.join_facts(rows, facts, ["k"], left=True).collect()}
        assert found == {i: {1: "a", 3: "c"}.get(k) for i, k in enumerate([1] * 50 + [2] * 50 + [3, 4, None])}
        assert hot_keys.join_facts(rows, facts, ["k"]).count() == 51
