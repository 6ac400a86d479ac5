"""JSON record text to the raw record form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.schema import FIELDS, METADATA_FIELDS

_RECORD = T.StructType([T.StructField(name, T.StringType()) for name in (*FIELDS, *METADATA_FIELDS)])


def json_records(rows: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Values as text, untrimmed; the key list tells a missing field from an explicit null.

    The generator parses each record once. A plain projection would be merged into the rules
    that use its columns and parse the record again for each of them.
    """
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    parsed = F.struct(F.from_json(payload, _RECORD).alias("record"), keys.alias("field_names"))
    return rows.select(F.inline(F.array(parsed)), F.col(payload).alias("raw_payload")).select(
        "record.*", "field_names", "raw_payload"
    )
