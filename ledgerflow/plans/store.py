"""Parquet tables in dated folders, published together through one small snapshot file.

A change writes only the date folders it touches, into a folder of its own run. Committing writes
the next snapshot file, which names the run that holds each date. Readers see all of a change or
nothing, what is being read is never overwritten, and a run that dies leaves files no snapshot
names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.schema import (
    BRONZE,
    BRONZE_SCHEMA,
    CONTROL,
    CONTROL_SCHEMA,
    GOLD,
    GOLD_SCHEMA,
    GROUP_HISTORY,
    GROUP_HISTORY_SCHEMA,
    ID_DATES,
    ID_DATES_SCHEMA,
    PROFILE,
    PROFILE_SCHEMA,
    QUARANTINE,
    QUARANTINE_STORE_SCHEMA,
    RUN_AUDIT,
    RUN_AUDIT_SCHEMA,
)
from ledgerflow.session import delete_path, list_names, path_exists, read_text, rename_path, write_text

NULL_DATE = "__HIVE_DEFAULT_PARTITION__"
_EVENT_DATE = T.StructField("event_date", T.DateType())
# Tables that runs only append to have a folder per run instead of one per date.
DELTA = "delta"
_DELTA = T.StructField(DELTA, T.StringType())


@dataclass(frozen=True)
class TableSpec:
    schema: T.StructType
    date_column: str | None


TABLES = {
    BRONZE: TableSpec(T.StructType([*BRONZE_SCHEMA.fields, _EVENT_DATE]), "event_date"),
    QUARANTINE: TableSpec(T.StructType([*QUARANTINE_STORE_SCHEMA.fields, _EVENT_DATE, _DELTA]), DELTA),
    RUN_AUDIT: TableSpec(T.StructType([*RUN_AUDIT_SCHEMA.fields, _DELTA]), DELTA),
    ID_DATES: TableSpec(T.StructType([*ID_DATES_SCHEMA.fields, _DELTA]), DELTA),
    GROUP_HISTORY: TableSpec(T.StructType([*GROUP_HISTORY_SCHEMA.fields, _EVENT_DATE]), "event_date"),
    GOLD: TableSpec(GOLD_SCHEMA, "transaction_date"),
    PROFILE: TableSpec(T.StructType([*PROFILE_SCHEMA.fields, _EVENT_DATE]), "event_date"),
    CONTROL: TableSpec(CONTROL_SCHEMA, None),
}

# Per table and date: the run that holds it and its counts. A date without rows has no folder.
Dates = dict[str, dict]


class CommitConflict(RuntimeError):
    """Another change was committed after this one began."""


def date_key(value: date | str | None) -> str:
    return NULL_DATE if value is None else str(value)


class TableStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _snapshot_path(self, version: int) -> str:
        return f"{self.root}/_snapshots/{version:09d}.json"

    def version(self) -> int:
        names = [n for n in list_names(self.spark, f"{self.root}/_snapshots") if n.endswith(".json")]
        return int(names[-1].removesuffix(".json")) if names else 0

    def snapshot(self, version: int | None = None) -> dict[str, Dates]:
        version = self.version() if version is None else version
        if version == 0:
            return {table: {} for table in TABLES}
        published = json.loads(read_text(self.spark, self._snapshot_path(version)))
        return {table: published.get(table, {}) for table in TABLES}

    def read(self, table: str, dates: Iterable[str] | None = None) -> DataFrame:
        return self.read_from(self.snapshot(), table, dates)

    def read_from(self, snapshot: dict[str, Dates], table: str, dates: Iterable[str] | None) -> DataFrame:
        """The named dates of a table, or all of them; an empty table when there are none."""
        spec = TABLES[table]
        entries = snapshot[table]
        wanted = entries.keys() if dates is None else entries.keys() & set(dates)
        folders = sorted(
            self._folder(table, key, entries[key]["run"]) for key in wanted if entries[key]["rows"]
        )
        if not folders:
            # Known to be empty when planned, so joins and unions with it fall away.
            return self.spark.createDataFrame([], spec.schema).filter(F.lit(False))
        reader = self.spark.read.schema(spec.schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*folders).select(*spec.schema.names)

    def _folder(self, table: str, key: str, run: str) -> str:
        run_folder = f"{self.root}/{table}/run={run}"
        column = TABLES[table].date_column
        return run_folder if column is None else f"{run_folder}/{column}={key}"

    def begin(self) -> Change:
        return Change(self)

    def commit(self, version: int, snapshot: dict[str, Dates]) -> None:
        """Publish by renaming a finished file to the next version's name."""
        target = self._snapshot_path(version)
        if path_exists(self.spark, target):
            raise CommitConflict(f"snapshot {version} is already published")
        draft = f"{self.root}/_snapshots/.{version:09d}-{uuid.uuid4().hex}"
        write_text(self.spark, draft, json.dumps(snapshot, sort_keys=True))
        if not rename_path(self.spark, draft, target):
            raise CommitConflict(f"snapshot {version} is already published")

    def drop_unreferenced_runs(self) -> list[str]:
        """Delete run folders the current snapshot does not name, once no reader needs them.

        Runs numbered above it belong to changes that are still open and stay.
        """
        version = self.version()
        snapshot = self.snapshot(version)
        dropped = []
        for table, dates in snapshot.items():
            live = {f"run={entry['run']}" for entry in dates.values()}
            for name in list_names(self.spark, f"{self.root}/{table}"):
                if name.startswith("run=") and name not in live and int(name[4:13]) <= version:
                    delete_path(self.spark, f"{self.root}/{table}/{name}")
                    dropped.append(f"{table}/{name}")
        return dropped


class Change:
    """Staged folders of one run. Reads through it see what it staged; nobody else does."""

    def __init__(self, store: TableStore) -> None:
        self.store = store
        self.base = store.version()
        self.pending = store.snapshot(self.base)
        self.number = self.base + 1
        self.run = f"{self.number:09d}-{uuid.uuid4().hex[:8]}"

    def read(self, table: str, dates: Iterable[str] | None = None) -> DataFrame:
        return self.store.read_from(self.pending, table, dates)

    def rows_in(self, table: str, count: str = "rows") -> int:
        """A table-wide count, summed over its dates without reading the table."""
        return sum(entry[count] for entry in self.pending[table].values())

    def stage(
        self,
        table: str,
        rows: DataFrame,
        touched: Iterable[str] = (),
        counts: dict[str, Column] | None = None,
        options: dict[str, str] | None = None,
    ) -> None:
        """Write the full new content of the touched dates; a touched date without rows is emptied.

        Per-date row counts (and ``counts``) are read back from the written files, so a retried
        task cannot distort them.
        """
        spec = TABLES[table]
        spark = self.store.spark
        step = len(list_names(spark, f"{self.store.root}/{table}"))
        run = f"{self.run}-{step}"
        folder = f"{self.store.root}/{table}/run={run}"
        writer = rows.select(*spec.schema.names).write.options(**(options or {}))
        if spec.date_column:
            writer = writer.partitionBy(spec.date_column)
        writer.parquet(folder)

        written = spark.read.schema(spec.schema).parquet(folder)
        wanted = {"rows": F.count(F.lit(1)), **(counts or {})}
        aggregates = [column.alias(name) for name, column in wanted.items()]
        if spec.date_column is None:
            found = {"": written.agg(*aggregates).first()}
        else:
            by_date = written.groupBy(spec.date_column).agg(*aggregates).collect()
            found = {date_key(row[spec.date_column]): row for row in by_date}
        for key in touched:
            self.pending[table][key] = {"run": run, **dict.fromkeys(wanted, 0)}
        for key, row in found.items():
            self.pending[table][key] = {"run": run, **{name: row[name] for name in wanted}}

    def commit(self) -> int:
        self.store.commit(self.number, self.pending)
        return self.number


def run_number(entry: dict | None) -> int:
    return int(entry["run"].split("-")[0]) if entry else 0
