"""Record validation: every rule is a column predicate, every violated rule adds one message."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.countries import assigned_country_codes
from ledgerflow.functions.money import Amount, parse_amount
from ledgerflow.functions.text import hash_of, is_blank, list_text, parse_utc, utc_literal
from ledgerflow.operators.contract import Contract, ContractField
from ledgerflow.schema import ALLOWED_VALUES, FIELDS, METADATA_FIELDS, QUARANTINE_STORE_SCHEMA

TRANSACTION_ID = r"\ATXN-[A-Z0-9]+\z"
ACCOUNT_ID = r"\AACC-[0-9]{4}\z"
# The parsed date, held in a column so that each row parses it once.
EVENT_TIME = "_event_time"
# The text of an explicit null: a rule on such a field sees this word.
NULL_TEXT = "None"
# The value in a contract message, between its field and what is wrong with it.
SHOWN_VALUE = r"(?s)^(\w+ violates schema:) .*['\)] (is |does not match )"


@dataclass(frozen=True)
class Record:
    """Expressions over one raw row: ten text columns, ``field_names`` and ``raw_payload``."""

    amount: Amount
    timestamp: Column
    unexpected: Column

    def text(self, field: str) -> Column:
        present = F.array_contains("field_names", field)
        return F.when(present, F.coalesce(F.col(field), F.lit(NULL_TEXT))).otherwise("")


def _record() -> Record:
    known = F.array(*[F.lit(name) for name in (*FIELDS, *METADATA_FIELDS)])
    return Record(
        amount=parse_amount(F.col("amount")),
        timestamp=F.col(EVENT_TIME),
        unexpected=F.sort_array(F.array_except("field_names", known)),
    )


def _is_listed(field: str, values: Sequence[str]) -> Column:
    """A long IN list as one parsed expression, which plans faster than one literal per value."""
    quoted = ", ".join("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" for value in values)
    return F.expr(f"{field} IN ({quoted})")


def _rules(record: Record, assigned: Column) -> list[Column]:
    """Messages in reporting order; NULL where the rule holds."""

    def given(field: str) -> Column:
        return record.text(field) != ""

    amount = record.amount
    messages = [
        F.when(
            F.size(record.unexpected) > 0,
            F.concat(F.lit("unexpected fields: "), list_text(record.unexpected)),
        )
    ]
    messages += [
        F.when(F.coalesce(F.col(field) == "", F.lit(True)), f"{field} is required") for field in FIELDS
    ]
    messages += [
        F.when(
            given("transaction_id") & ~record.text("transaction_id").rlike(TRANSACTION_ID),
            "transaction_id must match pattern TXN-[A-Z0-9]+",
        ),
        F.when(
            given("account_id") & ~record.text("account_id").rlike(ACCOUNT_ID),
            "account_id must match format ACC-NNNN",
        ),
        F.when(
            given("transaction_date") & record.timestamp.isNull(),
            "transaction_date must be a valid ISO 8601 UTC timestamp ending with Z or +00:00",
        ),
        F.when(F.col("amount") != "", _amount_message(amount)),
    ]
    messages += [
        F.when(
            given(field) & ~record.text(field).isin(*values), f"{field} must be one of {sorted(values)}"
        )
        for field, values in ALLOWED_VALUES.items()
    ]
    messages += [
        F.when(
            given("merchant_name") & is_blank(record.text("merchant_name")),
            "merchant_name must contain at least one non-whitespace character",
        ),
        F.when(
            given("country_code") & ~F.coalesce(assigned, F.lit(False)),
            "country_code must be an assigned ISO 3166-1 alpha-2 code",
        ),
    ]
    return messages


def _amount_message(amount: Amount) -> Column:
    return (
        F.when(~amount.number, "amount must be decimal")
        .when(~amount.positive, "amount must be greater than zero")
        .when(~amount.in_cents, "amount must be a multiple of 0.01")
        .when(amount.value.isNull(), "amount out of range")
    )


def _passes(record: Record, assigned: Column) -> Column:
    """All rules at once, without building messages; NULL fields fail."""
    checks = [
        F.size(record.unexpected) == 0,
        F.col("transaction_id").rlike(TRANSACTION_ID),
        F.col("account_id").rlike(ACCOUNT_ID),
        record.timestamp.isNotNull(),
        record.amount.valid,
        *[F.col(field).isin(*values) for field, values in ALLOWED_VALUES.items()],
        ~is_blank(F.col("merchant_name")),
        assigned,
    ]
    return F.coalesce(reduce(and_, checks), F.lit(False))


def _contract_fields(record: Record) -> dict[str, ContractField]:
    """The normalised record as the contract sees it: bad dates and empty values are absent."""
    fields = {}
    for field in FIELDS:
        text = record.text(field)
        fields[field] = ContractField(present=text != "", text=text)
    fields["transaction_date"] = ContractField(
        present=record.timestamp.isNotNull(),
        text=F.concat(F.substring("transaction_date", 1, 19), F.lit("Z")),
    )
    fields["amount"] = ContractField(
        present=F.coalesce(F.col("amount") != "", F.lit(False)),
        text=F.when(record.amount.number, record.amount.text).otherwise(F.col("amount")),
        is_number=record.amount.number,
        number=record.amount.wide,
    )
    return fields


def validate(
    raw: DataFrame,
    contract: Contract | None = None,
    countries: Sequence[str] | None = None,
) -> DataFrame:
    """One narrow projection: the ten typed columns, ``is_valid``, ``errors`` and ``raw_payload``.

    All rules run on every record and all messages are kept, contract messages last. Typed
    columns are meaningful where ``is_valid``; the payload is kept only where it is not.
    """
    record = _record()
    codes = assigned_country_codes() if countries is None else countries
    assigned = _is_listed("country_code", codes)
    messages = _rules(record, assigned)
    passes = _passes(record, assigned)
    if contract is not None:
        fields = _contract_fields(record)
        messages += contract.messages(fields, record.unexpected)
        passes = reduce(and_, [passes, *contract.extra_checks(fields)])
    typed = {"transaction_date": record.timestamp, "amount": record.amount.value}
    is_valid = F.col("is_valid")
    no_errors = F.array().cast("array<string>")
    # In steps, so that the verdict is computed once and messages only for rows that fail.
    checked = raw.withColumn(EVENT_TIME, parse_utc(F.col("transaction_date"))).withColumn("is_valid", passes)
    return checked.select(
        *[typed.get(field, F.col(field)).alias(field) for field in FIELDS],
        "is_valid",
        F.when(is_valid, no_errors).otherwise(F.array_compact(F.array(*messages))).alias("errors"),
        F.when(~is_valid, F.col("raw_payload")).alias("raw_payload"),
    )


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.filter("is_valid").select(*FIELDS)


def quarantine_rows(
    validated: DataFrame, *, source: str, batch_id: str, ingestion_timestamp: str
) -> DataFrame:
    """Invalid rows as quarantine rows; the same payload with the same errors has the same id.

    Copies of one record collapse here. Their rows are equal, so which copy stays is immaterial,
    and the partial aggregation keeps a record repeated without end out of a single task.
    """
    reason = F.array_join("errors", "; ")
    rows = validated.filter(~F.col("is_valid")).select(
        hash_of(F.col("raw_payload"), *[F.array_join("errors", "\u001f")]).alias("quarantine_id"),
        "transaction_id",
        "raw_payload",
        reason.alias("error_reason"),
        F.size("errors").alias("error_count"),
        utc_literal(ingestion_timestamp).alias("ingestion_timestamp"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(source).alias("source"),
        "errors",
        F.col("transaction_date").cast("date").alias("event_date"),
    )
    return rows.dropDuplicates(["quarantine_id"]).select(*QUARANTINE_STORE_SCHEMA.names, "event_date")


def with_audit_columns(
    rows: DataFrame, *, source: str, batch_id: str, ingestion_timestamp: str
) -> DataFrame:
    """Constants of the batch, given as parameters so that a retried task writes the same rows."""
    return rows.withColumns(
        {
            "source": F.lit(source),
            "batch_id": F.lit(batch_id),
            "ingestion_timestamp": utc_literal(ingestion_timestamp),
        }
    )


def invalid_by_rule(quarantine: DataFrame) -> DataFrame:
    """How often each message occurs, from the stored array rather than the display text.

    Messages that show a value or a field's name make as many rows as the data holds of them.
    """
    return _counted(quarantine.select(F.explode("errors").alias("rule")))


def invalid_by_kind(quarantine: DataFrame) -> DataFrame:
    """As :func:`invalid_by_rule` with values and names left out: as many rows as there are rules."""
    rule = F.col("rule")
    kind = (
        F.when(rule.startswith("unexpected fields: "), "unexpected fields")
        .when(rule.startswith("record violates schema: "), "record violates schema: additional properties")
        .otherwise(F.regexp_replace(rule, SHOWN_VALUE, "$1 $2"))
    )
    return _counted(quarantine.select(F.explode("errors").alias("rule")).select(kind.alias("rule")))


def _counted(rules: DataFrame) -> DataFrame:
    return rules.groupBy("rule").agg(F.count(F.lit(1)).alias("failures"))
