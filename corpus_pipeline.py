"""Training corpus from raw documents: toxicity, near-dedup, substring dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread
as the next stage's documents. All stages but the last return the columns of the documents. Each works
on everything that the stage before it kept, with the operators' production parameters, and handles
nulls, repeated rows, extra columns and empty tables as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import minhash, mixing, packing, substring_dedup, toxicity
from ledgerflow.llm.queries import tokenizer_path
from ledgerflow.llm.tables import Scratch, filter_texts, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents whose score stays below the threshold."""
    settings = toxicity.Ftrl()
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), settings)
    score = toxicity.scorer(docs, model, settings)
    return filter_texts(docs, lambda data, offsets: score(data, offsets) < settings.threshold)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_near_duplicates(docs, scratch or Scratch(spark, "pipeline-near"))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents without passages of earlier ones; `n_chars`, where there is one, follows the text."""
    cut = substring_dedup.dedupe_substrings(docs, scratch or Scratch(spark, "pipeline-passages"))
    if "n_chars" not in docs.columns:
        return cut
    chars = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return cut.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs, scratch or Scratch(spark, "pipeline-mix"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Pieces of the documents with their ids and their place in a sequence."""
    settings = packing.Packing(tokenizer=tokenizer_path())
    return packing.pack(docs, scratch or Scratch(spark, "pipeline-pack"), settings)


STAGES = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("mix_sources", mixed),
    ("best_fit_packing", packed),
]

#: SQL can express neither the classifier nor the packing. Tests run the stages but the packing one after
#: another on a small table and check columns and dropped ids; they compare no whole result with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's scratch tables go once its result is written."""
    kept = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        scratch = Scratch(spark, f"pipeline-{name}")
        try:
            docs = kept.put(name, stage(spark, docs, sf_dir, scratch))
        finally:
            scratch.drop()
    return docs
