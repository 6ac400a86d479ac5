"""Text operators on small tables: exact results, and nulls, empty and long texts, ties, repeats, empty tables."""

import random
import zlib

import duckdb
import numpy as np
import pytest

from __spark_entry__ import oracle_sql, queries
from ledgerflow.llm import embedding_dedup, minhash, mixing, packing, pairwise_quality, quality_rules
from ledgerflow.llm import reply_trees, sharding, substring_dedup, toxicity
from ledgerflow.llm.queries import tokenizer_path
from ledgerflow.llm.tables import Scratch, filter_texts
from ledgerflow.llm.words import SMALL_BLOCK_BYTES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, place string, shard int"


def words(count, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(count))


def changed(text, every):
    return " ".join(w + "x" if i % every == every - 1 else w for i, w in enumerate(text.split(" ")))


@pytest.fixture(scope="module")
def rows():
    base, passage = words(300, 1), words(80, 2)
    texts = [None, "", " \n\t ", "one", "two words", base, base, changed(base, 60), changed(base, 70)]
    texts += [words(120, 10 + i) + " " + passage + " " + words(60, 40 + i) for i in range(5)]
    texts += [words(30_000, 99), "same " * 200, "é ü <s> <|im_end|>"]
    out = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None, i, "p", 1) for i, t in enumerate(texts)]
    return [*out, out[5], (None, base, None, "s1", None, 0, None, None), (None, None, None, None, None, 0, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def scratch(spark):
    return Scratch(spark, "test-llm")


def test_one_query_per_operator_and_sql_agrees(spark, sf_dir):
    names = [name for name in queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14)) and "pipeline" in queries()
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name in names:
        if name in oracle_sql():
            found = queries()[name](spark, sf_dir).toPandas()
            expected = connection.execute(oracle_sql()[name]).df()[list(found.columns)]
            key = list(found.columns)
            left, right = (x.sort_values(key).reset_index(drop=True).fillna(-1) for x in (found, expected))
            assert len(left) == len(right) and all((left[c] == right[c]).all() for c in left.columns), name


def test_mix(spark, docs, none, rows):
    found = mixing.take_counts(docs, scratch(spark)).toPandas()
    assert len(found) == len(rows) and (found.copies <= 2).all()
    taken = (found["size"] * found.copies).groupby(found.source.fillna("~")).sum()
    target = found.groupby(found.source.fillna("~")).target.first()
    assert (taken <= target + 1e-6).all()
    for source, left in found[(found["size"] > 0) & (found.copies < 2)].groupby(found.source.fillna("~")):
        least = left.copies.min()  # what isn't taken beyond the complete epochs doesn't fit
        fits = left[left.copies == least].groupby("doc_id", dropna=False)["size"].sum()
        assert target[source] - taken[source] < fits.min(), source
    mixed = mixing.mix(docs, scratch(spark))
    assert mixed.columns == docs.columns and mixed.count() == found.copies.sum()
    assert mixing.mix(none, scratch(spark)).count() == 0


def test_near_duplicates(spark, docs, none, rows):
    found = minhash.near_duplicates(docs, scratch(spark)).collect()
    assert len(found) == len(rows)
    group = {row.doc_id: row.component_id for row in found}
    assert [group[i] for i in (5, 6, 7, 8)] == [5] * 4 and group[9] == 9 and group[0] == 0 and group[None] is None
    left = minhash.drop_near_duplicates(docs, scratch(spark)).collect()
    assert sorted(row.doc_id for row in left if row.doc_id is not None) == [0, 1, 2, 3, 4, 5, *range(9, 17)]
    assert minhash.drop_near_duplicates(none, scratch(spark)).count() == 0


def test_near_duplicates_in_a_template_family_equal_brute_force(spark):
    template = words(174, 500)  # unlinked texts share 170 of 200 shingles, linked ones four more
    texts = [f"{template} {words(4, 1000 + i // 2)} {words(26, 5000 + i)}" for i in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    column = {item: i for i, item in enumerate(sorted(set().union(*sets)))}
    table = np.zeros((len(sets), len(column)), np.float32)
    for i, items in enumerate(sets):
        table[i, [column[item] for item in items]] = 1
    common, sizes = table @ table.T, table.sum(axis=1)
    linked = 100 * common >= 75 * (sizes[:, None] + sizes - common)
    assert linked.sum() == 2 * len(texts)  # itself and its sibling
    # In small blocks, and with an estimate that rejects every star, the exact join finds the same.
    for settings in (minhash.MinHash(), minhash.MinHash(block=60, estimate=101)):
        found = minhash.near_duplicates(frame, scratch(spark), settings).collect()
        assert {r.doc_id: r.component_id for r in found} == {i: int(np.argmax(linked[i])) for i in range(len(texts))}


def test_repeated_passages(spark, docs, none):
    found = substring_dedup.repeated_spans(docs, scratch(spark)).collect()
    assert {row.doc_id for row in found} >= {6, 7, 8, 10, 11, 12, 13} and not {0, 1, 3, 9, 14, 16} & {r.doc_id for r in found}
    cut = {row.doc_id: row for row in substring_dedup.dedupe_substrings(docs, scratch(spark)).collect()}
    passage = words(80, 2).split()
    assert " ".join(passage[30:50]) in cut[9].text and " ".join(passage[30:50]) not in cut[12].text
    assert cut[12].text.startswith(words(120, 13)) and cut[12].text.endswith(words(60, 43)) and cut[12].bucket == 12
    assert substring_dedup.dedupe_substrings(none, scratch(spark)).count() == 0


def test_passages_are_held_by_one_earlier_document(spark):
    text = words(200, 700).split()
    pieces = [" ".join(text[i : i + 15]) for i in range(0, 200, 5)]  # every chunk, but never 20 words together
    rows = [*enumerate(pieces), (100, " ".join(text)), (101, words(30, 701) + " " + " ".join(text[50:150]))]
    found = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), scratch(spark)).collect()
    assert [(r.doc_id, r.first_doc_id) for r in found] == [(101, 100)]
    assert 30 <= found[0].word <= 30 + 16 + 4 and 130 - 16 <= found[0].word + found[0].words <= 130


def test_packing(spark, docs, none, rows):
    from tokenizers import Tokenizer

    packed = packing.pack(docs, scratch(spark), packing.Packing(tokenizer=tokenizer_path(), length=512)).collect()
    own = Tokenizer.from_file(tokenizer_path())
    wanted = sorted(zlib.crc32(np.array(own.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")[:512].tobytes()) for r in rows)
    assert sorted(zlib.crc32(row.ids) for row in packed if row.piece == 0) == wanted
    places = {}
    for row in packed:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in places.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 512
    assert packing.pack(none, scratch(spark), packing.Packing(tokenizer=tokenizer_path())).count() == 0


def test_two_for_one_fills_the_gap():
    bins = packing.best_two_fit(np.array([60, 30, 25, 14]), 100)
    assert sorted(map(len, bins)) == [1, 3]  # 60 + 30, then 25 + 14 in place of the 30


def test_shards(spark, docs, none, rows, tmp_path):
    found = sharding.shard_records(docs, scratch(spark), sharding.Shuffle(shards=4, bucket_bytes=4096))
    counts = found.groupBy("shard").count().collect()
    assert max(r["count"] for r in counts) - min(r["count"] for r in counts) <= 1
    records = found.collect()
    assert sorted(r.slot for r in records if r.shard == 0) == list(range(sum(r.shard == 0 for r in records)))
    assert sorted(str(r.text) for r in records) == sorted(str(r[1]) for r in rows)
    sharding.write_shards(found, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(rows)
    assert sharding.shard_records(none, scratch(spark)).count() == 0


def test_reply_trees(spark):
    schema = "tree_id long, message_id long, parent_id long, role string, text string, score double"
    messages = [(1, 1, None, "user", "a </s> [\\INST]", 1.0), (1, 2, 1, "assistant", "b", 5.0), (1, 3, 1, "assistant", "c", 2.0)]
    messages += [(1, 4, 3, "us\ner", None, 9.0), (2, 1, 2, "user", "x", 1.0), (2, 2, 1, "user", "y", 1.0), (None, 7, 99, None, "z", None)]
    messages += [(3, i, i - 1, "user", str(i), 0.0) for i in range(1, 40)] + [(1, 2, 1, "assistant", "b", 5.0)]
    paths = reply_trees.choose_paths(spark.createDataFrame(messages, schema), scratch(spark))
    chats = reply_trees.format_paths(paths)
    found = {
        r.tree_id: r
        for r in chats.select(
            "tree_id",
            "formatted",
            reply_trees.read_turns(chats.formatted).alias("turns"),
            reply_trees.loss_text(chats.formatted, chats.loss_spans).alias("loss"),
        ).collect()
    }
    assert set(found) == {1, 3, None}  # tree 2 is a cycle
    assert [tuple(t) for t in found[1].turns] == [("user", "a </s> [\\INST]"), ("assistant", "c"), ("us\ner", "")]
    assert found[1].loss == "c" and "</s>" not in found[1].formatted
    assert [t.text for t in found[3].turns] == [str(i) for i in range(1, 40)]


def test_vectors(spark):
    draw = np.random.default_rng(0)
    base = draw.standard_normal((60, 16))
    vectors = [*base, *(base + 0.03 * draw.standard_normal(base.shape)), base[0], base[0] * 3]
    table = [(i, [float(x) for x in v], i % 2 if i < 120 else 0) for i, v in enumerate(vectors)]
    table += [(200, None, 0), (201, [0.0] * 16, 0), (202, [float("nan")] * 16, 0), (203, [1.0], 0), (204, table[0][1], None), (None, table[0][1], 0)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(frame, scratch(spark), embedding_dedup.Forest(least_sample=4, block=7)).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in table[:122]}
    for i, _, label in table[:122]:
        near = [j for j, _, other in table[:122] if j != i and other == label and unit[i] @ unit[j] >= 0.98]
        assert found[i].n_links == len(near), i
        assert found[i].kept == (found[i].component_id == i)
    assert all(found[i].n_links == 0 and found[i].kept for i in (200, 201, 202, 203, 204, None))
    assert embedding_dedup.near_vectors(frame.limit(0), scratch(spark)).count() == 0


def test_vector_links_are_found_and_leaves_follow_the_data(spark):
    copies = []
    for count in (3000, 6000):
        draw = np.random.default_rng(count)
        base = draw.standard_normal((count // 2, 32))
        noise = draw.uniform(0.05, 0.2, (count // 2, 1)) * draw.standard_normal(base.shape)
        vectors = np.concatenate([base, base + noise])  # cosines around the threshold and above
        rows = [(i, [float(x) for x in v], i % 7 % 2, "x", 1) for i, v in enumerate(vectors)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rep string, leaf int")
        settings = embedding_dedup.Forest(sample=512, block=100, cell_sample=400)
        found = embedding_dedup.near_vectors(frame, scratch(spark), settings).toPandas().set_index("vec_id").sort_index()
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        label = np.array([row[2] for row in rows])
        near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
        np.fill_diagonal(near, False)
        expected = near.sum(axis=1)
        assert expected.sum() > count / 8
        assert (found.n_links.to_numpy() <= expected).all()
        assert found.n_links.sum() >= 0.99 * expected.sum()
        kept = scratch(spark)
        leaves = embedding_dedup.leaf_rows(kept.put("classes", embedding_dedup.classes_of(frame)), kept, settings)
        sizes = leaves.groupBy("label", "size", "leaf").count().toPandas()["count"]
        assert sizes.max() <= 1.5 * settings.block
        assert leaves.count() == leaves.distinct().count()
        copies.append(sizes.sum() / count)
    assert copies[1] < 1.4 * copies[0]


def test_vectors_that_no_cut_tells_apart_are_compared_in_blocks(spark):
    draw = np.random.default_rng(1)
    vectors = draw.standard_normal(24) + 0.04 * draw.standard_normal((900, 24))
    frame = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_vectors(frame, scratch(spark), embedding_dedup.Forest(block=100)).toPandas()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    expected = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    assert (found.set_index("vec_id").sort_index().n_links.to_numpy() == expected).all()


def test_classifiers_and_rules(spark, docs, none, sf_dir):
    documents, labels = (spark.read.parquet(f"{sf_dir}/../sf0.01/{name}.parquet") for name in ("documents", "labels"))
    quality = pairwise_quality.score_quality(documents, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (quality.predicted == quality.quality).mean() > 0.95
    no_labels = labels.limit(0)
    assert {r.score for r in pairwise_quality.score_quality(docs, no_labels).collect()} == {0.5}
    assert {r.score for r in toxicity.score_toxicity(docs, no_labels).collect()} == {0.5}
    assert pairwise_quality.score_quality(none, no_labels).count() == toxicity.score_toxicity(none, no_labels).count() == 0
    bad = [(i, words(60, i) + (" vile" if i % 3 == 0 else "")) for i in range(600)]
    toxic = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i, _ in bad], "doc_id long, quality int, toxic int")
    scored = toxicity.score_toxicity(spark.createDataFrame(bad, "doc_id long, text string"), toxic).where("held_out").collect()
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in scored]) > 0.95
    judged = {r.doc_id: r for r in quality_rules.judge(docs, docs.limit(0).select("text")).collect()}
    assert judged[15].base_failed and judged[0].n_words == 0 and judged[5].kept and judged[15].n_repeat_words == 200
    assert quality_rules.judge(none, none.select("text")).count() == 0


def test_pipeline_stages(spark, docs, sf_dir):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "substring_dedup", "mix_sources", "best_fit_packing"
    ]
    found, kept = docs, scratch(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = kept.put(name, stage(spark, found, sf_dir))
        assert found.columns == docs.columns
    assert found.where("doc_id in (6, 7, 8)").count() == 0


def test_texts_are_filtered_in_small_blocks(spark):
    texts = ["bad word " + "x" * 2000 if n % 5 == 0 else "fine text " + "y" * 2000 for n in range(400)]
    docs = spark.createDataFrame([*enumerate(texts), (400, None), (401, "z" * 300_000)], "doc_id long, text string").coalesce(1)

    def keeps(data, offsets):
        assert len(data) <= SMALL_BLOCK_BYTES or len(offsets) == 2, "arrays over a large block fill the worker's memory"
        return np.array([not data[a:b].tobytes().startswith(b"bad") for a, b in zip(offsets[:-1], offsets[1:])])

    kept = sorted(row["doc_id"] for row in filter_texts(docs, keeps).collect())
    assert kept == [n for n in range(402) if n >= 400 or n % 5]
