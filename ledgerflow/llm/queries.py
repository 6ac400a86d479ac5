"""Registered queries of the text operators over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (
    byte_bpe,
    collocations,
    embedding_dedup,
    minhash,
    mixing,
    packing,
    pairwise_quality,
    prefix_trie,
    quality_rules,
    reply_trees,
    sharding,
    substring_dedup,
    toxicity,
)
from ledgerflow.llm.tables import Scratch, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenizers keep a file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.take_counts(table(spark, sf_dir, "documents"), Scratch(spark, "op1"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op2"))


def op3_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage that a document shares with an earlier one."""
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"), Scratch(spark, "op4"))


def op5_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = reply_trees.turns_as_messages(turns.unionByName(reply_trees.sample_turns(spark)))
    scratch = Scratch(spark, "op5")
    chats = reply_trees.format_paths(reply_trees.choose_paths(messages, scratch))
    read = chats.select(
        F.col("tree_id").alias("conv_id"),
        "formatted",
        reply_trees.read_turns(F.col("formatted")).alias("turns"),
        reply_trees.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = packing.Packing(tokenizer=tokenizer_path())
    packed = packing.pack(table(spark, sf_dir, "documents"), Scratch(spark, "op6"), settings)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark, "op7"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = sharding.shard_records(records, Scratch(spark, "op9"))
    return sharded.select(
        "doc_id",
        sharding.record_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = quality_rules.trusted_texts(docs, table(spark, sf_dir, "labels"), Scratch(spark, "op10"))
    return quality_rules.judge(docs, trusted)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"file://{tokenizer_path('byte_bpe_multi_50k.tiktoken')}"
    vocabulary = byte_bpe.Vocabulary.load(spark, path, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_ids(byte_bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op12")
    placed = prefix_trie.placed_turns(table(spark, sf_dir, "conversations"), scratch)
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_conversations(placed, scratch), scratch)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), Scratch(spark, "op13"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_minhash": op2_minhash,
    "op3_pairwise_quality": op3_pairwise_quality,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_reply_trees": op5_reply_trees,
    "op6_best_two_fit": op6_best_two_fit,
    "op7_near_vectors": op7_near_vectors,
    "op8_toxicity": op8_toxicity,
    "op9_shards": op9_shards,
    "op10_quality_rules": op10_quality_rules,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
}
