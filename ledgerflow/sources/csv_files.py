"""CSV source: text columns only, header names normalised, nothing lost silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.text import strip_text
from ledgerflow.operators.watermark import rows_since
from ledgerflow.schema import FIELDS, METADATA_FIELDS
from ledgerflow.session import path_exists

MALFORMED = "_malformed_line"
EXTRA_CELLS = "extra_cells"
# Possessive and without alternation: Java's matcher would recurse once per character otherwise.
QUOTED_CELL = r'"[^"]*+(?:""[^"]*+)*+"'


def normalized_names(columns: list[str]) -> list[str]:
    names = [column.strip().lower() for column in columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"header names collide after normalisation: {repeated}")
    return names


def normalize_columns(rows: DataFrame) -> DataFrame:
    """Trimmed lower-case names and trimmed text values; names are not mapped to others."""
    names = normalized_names(rows.columns)
    return rows.select(*[strip_text(F.col(f"`{old}`")).alias(new) for old, new in zip(rows.columns, names)])


def as_raw_records(rows: DataFrame, extra_cells: str | None = None) -> DataFrame:
    """Text columns to the raw record form: ten fields, ``field_names`` and ``raw_payload``.

    ``extra_cells`` names a column that is not NULL where a line had more cells than the header.
    """
    names = [name for name in rows.columns if name != extra_cells]
    field_names = F.array(*[F.lit(name) for name in names])
    payload = F.to_json(F.struct(*[F.col(f"`{n}`") for n in sorted(names)]), {"ignoreNullFields": "false"})
    if extra_cells:
        overflow = F.col(extra_cells).isNotNull()
        field_names = F.when(overflow, F.array_append(field_names, EXTRA_CELLS)).otherwise(field_names)
        with_line = F.struct(*[F.col(f"`{n}`") for n in sorted([*names, extra_cells])])
        payload = F.when(overflow, F.to_json(with_line, {"ignoreNullFields": "false"})).otherwise(payload)
    known = (*FIELDS, *METADATA_FIELDS)
    missing = F.lit(None).cast("string")
    return rows.select(
        *[(F.col(field) if field in names else missing).alias(field) for field in known],
        field_names.alias("field_names"),
        payload.alias("raw_payload"),
    )


def files_with_line_breaks(spark: SparkSession, path: str) -> list[str]:
    """Files with a line of an odd number of quotes, where a record may go on in the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = spark.read.text(path).filter(quotes % 2 == 1).select("_metadata.file_path").distinct()
    return sorted(row["file_path"] for row in odd.collect())


def read_csv(spark: SparkSession, path: str, *, multi_line: bool | None = None) -> DataFrame:
    """Every column as text.

    Records with line breaks inside quotes need ``multi_line``, which reads a file in one task. By
    default the lines are looked through for them first, in parallel; only files that have any are
    read so, all others are split as usual. Pass False to save that pass where records are known to
    be lines, True to read all files in one task each.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no CSV files at {path}")
    broken = files_with_line_breaks(spark, path) if multi_line is None else []
    options = {
        "header": True,
        "escape": '"',
        "emptyValue": "",
        "encoding": "UTF-8",
    }
    header = spark.read.options(**options, multiLine=bool(multi_line or broken)).csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in (*header, MALFORMED)]

    def scan(multi_line: bool) -> DataFrame:
        return (
            spark.read.options(**options, multiLine=multi_line)
            .schema(T.StructType(fields))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED)
            .option("enforceSchema", False)
            .option("columnPruning", False)  # with it, a line is not compared with the whole header
            .csv(path)
        )

    lines = scan(bool(multi_line))
    if broken:  # the conditions on the file choose the files to read, before anything is read
        is_broken = F.col("_metadata.file_path").isin(broken)
        lines = lines.filter(~is_broken).unionAll(scan(True).filter(is_broken))
    # The reader gives NULL for an empty cell and for a missing one. Only lines that do not fit
    # the header can miss cells, and there the cells are counted.
    cells = F.size(F.split(F.regexp_replace(MALFORMED, QUOTED_CELL, ""), ",", -1))
    fits = F.col(MALFORMED).isNull()

    def cell(place: int, name: str) -> Column:
        return F.coalesce(strip_text(F.col(f"`{name}`")), F.when(fits | (cells > place), ""))

    names = normalized_names(header)
    return as_raw_records(
        lines.select(
            *[cell(place, old).alias(new) for place, (old, new) in enumerate(zip(header, names))],
            F.when(cells > len(header), F.col(MALFORMED)).alias(EXTRA_CELLS),
        ),
        extra_cells=EXTRA_CELLS,
    )


def load_csv_transactions(
    spark: SparkSession, path: str, watermark: str | None = None, *, multi_line: bool | None = None
) -> DataFrame:
    return rows_since(read_csv(spark, path, multi_line=multi_line), watermark)
