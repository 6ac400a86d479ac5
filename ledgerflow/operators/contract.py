"""A versioned contract document compiled to column predicates."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ledgerflow.schema import FIELDS, default_contract
from ledgerflow.session import read_text

_ANNOTATIONS = {"$schema", "$id", "title", "description", "$comment", "examples", "default"}
_RECORD_KEYWORDS = {"type", "required", "additionalProperties", "properties"}
_TYPES = {"string", "number", "integer", "boolean", "object", "array", "null"}
_LENGTHS = ("minLength", "maxLength")
_BOUNDS = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf")


@dataclass(frozen=True)
class ContractField:
    """A value as the contract sees it. Numbers carry their decimal next to their text."""

    present: Column
    text: Column
    is_number: Column | None = None
    number: Column | None = None


class Contract:
    """Draft-07 subset: the keywords a flat record of scalars needs.

    A keyword outside the subset is refused when the document is loaded, so no rule is ever
    skipped silently. ``format`` is an annotation.
    """

    def __init__(self, document: Any) -> None:
        if not isinstance(document, dict):
            raise ValueError("a contract must be a JSON object")
        self.document = document
        self.properties: dict[str, dict[str, Any]] = document.get("properties", {})
        self.required: list[str] = document.get("required", [])
        self.closed = document.get("additionalProperties", True) is False
        self._check()

    def _check(self) -> None:
        unknown = set(self.document) - _ANNOTATIONS - _RECORD_KEYWORDS
        if unknown:
            raise ValueError(f"unsupported contract keywords: {sorted(unknown)}")
        if self.document.get("type", "object") != "object":
            raise ValueError("a contract must describe an object")
        if not isinstance(self.required, list) or not all(isinstance(f, str) for f in self.required):
            raise ValueError("required must be a list of field names")
        if not isinstance(self.document.get("additionalProperties", True), bool):
            raise ValueError("additionalProperties must be true or false")
        if not isinstance(self.properties, dict):
            raise ValueError("properties must be an object")
        undeclared = (set(self.properties) | set(self.required)) - set(FIELDS)
        if undeclared:
            raise ValueError(f"the contract names unknown fields: {sorted(undeclared)}")
        for field, rules in self.properties.items():
            if not isinstance(rules, dict):
                raise ValueError(f"{field}: rules must be an object")
            for keyword, value in rules.items():
                self._check_keyword(field, keyword, value)

    @staticmethod
    def _check_keyword(field: str, keyword: str, value: Any) -> None:
        if keyword in _ANNOTATIONS or keyword == "format":
            return
        names = value if isinstance(value, list) else [value]
        well_formed = {
            "type": all(isinstance(name, str) and name in _TYPES for name in names),
            "enum": isinstance(value, list),
            "pattern": isinstance(value, str),
            **{key: isinstance(value, int) and value >= 0 for key in _LENGTHS},
            **{key: isinstance(value, (int, Decimal)) and not isinstance(value, bool) for key in _BOUNDS},
        }.get(keyword)
        if well_formed is None:
            raise ValueError(f"{field}: unsupported contract keyword {keyword}")
        if not well_formed or (keyword == "multipleOf" and value <= 0):
            raise ValueError(f"{field}: bad value for {keyword}: {value!r}")
        if keyword == "pattern":
            try:
                re.compile(value)
            except re.error as exc:
                raise ValueError(f"{field}: bad pattern {value!r}") from exc

    def messages(self, fields: dict[str, ContractField], unexpected: Column) -> list[Column]:
        """Messages ordered as (path, text): whole-record messages first, then field by field."""
        found = [
            F.when(~fields[name].present, f"{name} is required by schema") for name in sorted(self.required)
        ]
        if self.closed:
            found.append(self._additional_message(fields, unexpected))
        for field in sorted(self.properties):
            shown = _shown(fields[field])
            for ending, violated in self._violations(field, fields[field]):
                found.append(
                    F.when(violated, F.concat(F.lit(f"{field} violates schema: "), shown, F.lit(" " + ending)))
                )
        return found

    def _additional_message(self, fields: dict[str, ContractField], unexpected: Column) -> Column:
        outside = [name for name in FIELDS if name not in self.properties]
        present = F.array_compact(F.array(*[F.when(fields[n].present, F.lit(n)) for n in outside]))
        extra = F.array_sort(F.concat(unexpected, present.cast("array<string>")))
        verb = F.when(F.size(extra) == 1, F.lit(" was unexpected)")).otherwise(F.lit(" were unexpected)"))
        text = F.concat(
            F.lit("record violates schema: Additional properties are not allowed ('"),
            F.array_join(extra, "', '"),
            F.lit("'"),
            verb,
        )
        return F.when(F.size(extra) > 0, text)

    def _violations(self, field: str, value: ContractField) -> list[tuple[str, Column]]:
        return sorted(
            (
                found
                for keyword, rule in self.properties[field].items()
                if (found := _violation(keyword, rule, value)) is not None
            ),
            key=lambda item: item[0],
        )

    def extra_checks(self, fields: dict[str, ContractField]) -> list[Column]:
        """What a record that passes the fixed rules must still satisfy.

        Keywords equal to the default contract's follow from those rules, so they cost nothing
        on the rows that pass.
        """
        implied = default_contract()["properties"]
        checks = []
        for field, rules in self.properties.items():
            for keyword, rule in rules.items():
                if implied[field].get(keyword) == rule:
                    continue
                found = _violation(keyword, rule, fields[field])
                if found is not None:
                    checks.append(~F.coalesce(found[1], F.lit(False)))
        if self.closed and set(FIELDS) - set(self.properties):
            checks.append(F.lit(False))
        return checks


def _shown(value: ContractField) -> Column:
    quoted = F.concat(F.lit("'"), value.text, F.lit("'"))
    if value.is_number is None:
        return quoted
    return F.when(value.is_number, F.concat(F.lit("Decimal('"), value.text, F.lit("')"))).otherwise(quoted)


def _violation(keyword: str, rule: Any, value: ContractField) -> tuple[str, Column] | None:
    """The message ending and the predicate of one keyword, or None for an annotation."""
    if keyword in _ANNOTATIONS or keyword == "format":
        return None
    is_number = F.lit(False) if value.is_number is None else value.is_number
    number = F.lit(None).cast("decimal(38,18)") if value.number is None else value.number
    if keyword == "type":
        return _type_violation(rule, value.present, is_number, number)
    if keyword == "enum":
        texts = [option for option in rule if isinstance(option, str)]
        numbers = [option for option in rule if isinstance(option, (int, Decimal))]
        listed = F.when(is_number, _any_of(number, numbers)).otherwise(_any_of(value.text, texts))
        return f"is not one of {rule!r}", value.present & ~listed
    text = value.present & ~is_number
    if keyword == "pattern":
        # Unicode classes, as the pattern language of the contract has them.
        return f"does not match {rule!r}", text & ~value.text.rlike("(?U)" + rule)
    if keyword == "minLength":
        return "is too short", text & (F.char_length(value.text) < rule)
    if keyword == "maxLength":
        return "is too long", text & (F.char_length(value.text) > rule)
    numeric = value.present & is_number
    bound = F.lit(Decimal(rule))
    if keyword == "minimum":
        return f"is less than the minimum of {rule!r}", numeric & (number < bound)
    if keyword == "maximum":
        return f"is greater than the maximum of {rule!r}", numeric & (number > bound)
    if keyword == "exclusiveMinimum":
        return f"is less than or equal to the minimum of {rule!r}", numeric & (number <= bound)
    if keyword == "exclusiveMaximum":
        return f"is greater than or equal to the maximum of {rule!r}", numeric & (number >= bound)
    return f"is not a multiple of {rule!r}", numeric & (number % bound != 0)


def _any_of(column: Column, options: list[Any]) -> Column:
    return column.isin(*options) if options else F.lit(False)


def _type_violation(rule: Any, present: Column, is_number: Column, number: Column) -> tuple[str, Column]:
    names = rule if isinstance(rule, list) else [rule]
    matches = F.lit(False)
    if "string" in names:
        matches = matches | ~is_number
    if "number" in names:
        matches = matches | is_number
    if "integer" in names:
        matches = matches | (is_number & F.coalesce(F.round(number, 0) == number, F.lit(False)))
    shown = ", ".join(repr(name) for name in names)
    return f"is not of type {shown}", present & ~matches


def load_contract(spark: SparkSession, path: str) -> Contract:
    """Read a contract document once, on the driver, with exact decimals."""
    try:
        document = json.loads(read_text(spark, path), parse_float=Decimal)
    except json.JSONDecodeError as exc:
        raise ValueError(f"not a JSON document: {path}") from exc
    return Contract(document)
