"""Tables, scratch tables in the shared folder, and per-text measures."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.words import BLOCK_BYTES, SMALL_BLOCK_BYTES, text_blocks
from ledgerflow.session import delete_path, scratch_path

#: Words, as Java and DuckDB patterns.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of a bitmap that is broadcast: at most 16 MiB.
MOST_BITS = 1 << 27


class Scratch:
    """Parquet tables of one run in the shared folder; a written table cuts the plan that made it.

    Tables that the result doesn't read are dropped by the operator. What the result reads stays
    until the owner of the result calls `drop()`, which removes the folder.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = scratch_path(spark, purpose)

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def read(self, name: str) -> DataFrame:
        """A table that was put before."""
        return self.spark.read.parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names or ("",):
            delete_path(self.spark, f"{self.root}/{name}".rstrip("/"))


def measure_texts(
    docs: DataFrame,
    measure: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray | pa.Array]],
    columns: str,
    keep: tuple[str, ...] = ("doc_id",),
    block: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns `keep` of each row and what `measure` finds in its text.

    `measure` gets the bytes of several texts, about `block` in all, and each text's first byte. It returns one array per
    name in `columns`, a schema string. Other columns of `docs` aren't read.
    """
    rows = docs.select(*keep, "text")
    schema = T.StructType([*rows.drop("text").schema.fields, *T._parse_datatype_string(columns).fields])
    names = [field.name for field in schema.fields[len(keep) :]]

    def run(batches):
        for part, data, offsets in text_blocks(batches, block=block):
            found = measure(data, offsets)
            kept = [part.column(i) for i, name in enumerate(part.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(found[name]) for name in names)], [*keep, *names])

    return rows.mapInArrow(run, schema)


def filter_texts(docs: DataFrame, keeps: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The rows whose text `keeps` accepts, with all their columns, in place and without a shuffle."""

    def run(batches):
        for part, data, offsets in text_blocks(batches, block=SMALL_BLOCK_BYTES):
            yield part.filter(pa.array(keeps(data, offsets)))

    return docs.mapInArrow(run, docs.schema)


def hash_bitmap(hashes: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits of the column `hash`, 16 or more for each row as far as `most_bits` allow, as bytes on the driver."""
    wanted = max(1 << 16, hashes.count() * 16)
    bits = min(most_bits, 1 << int(wanted - 1).bit_length())
    place = F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1
    segments = hashes.groupBy(F.bitmap_bucket_number(place).alias("segment")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    whole = np.zeros(bits // 8, np.uint8)
    for segment, part in segments.collect():
        begin = (segment - 1) * 4096
        whole[begin : begin + 4096] = np.frombuffer(bytes(part), np.uint8)[: len(whole) - begin]
    return whole


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes.astype(np.uint64) & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def rows_named(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in `names`. A bitmap of bounded size leaves out most others before the shuffle."""
    hashed = F.xxhash64(key).alias("hash")
    shared = rows.sparkSession.sparkContext.broadcast(hash_bitmap(names.select(hashed)))

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(shared.value, batch.column(0).to_numpy())))

    hashed_rows = rows.select(hashed, F.struct(*rows.columns).alias("row"))
    return hashed_rows.mapInArrow(keep, hashed_rows.schema).select("row.*").join(names.hint("merge"), key, "left_semi")


def held_out(doc_id: Column) -> Column:
    """Rows that no classifier learns from: crc32 of the id's text leaves remainder 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Texts of at most `most` labelled rows that aren't held out: doc_id, text, label.

    The sample is the rows first in a hash order of the ids, so it is the same in every run. It is
    bounded by `most`, which is why it may be broadcast to the documents. Rows without an id or a
    label teach nothing; a document with several labels gets the largest.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
