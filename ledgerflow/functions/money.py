"""Exact decimal parsing of amount text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import strip_text

# An amount most rows look like: it needs no wide decimal arithmetic.
COMMON = r"\A[0-9]{1,16}(\.[0-9]{1,2})?\z"
NUMBER = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


@dataclass(frozen=True)
class Amount:
    """Expressions over one amount column; all are false or NULL for NULL text."""

    raw: Column
    text: Column
    number: Column
    positive: Column
    in_cents: Column
    wide: Column
    value: Column

    @property
    def valid(self) -> Column:
        return F.when(self.raw.rlike(COMMON), self.raw.rlike("[1-9]")).otherwise(
            self.number & self.positive & self.in_cents & self.value.isNotNull()
        )


def parse_amount(raw: Column) -> Amount:
    """Read an amount without rounding it.

    A direct cast to ``decimal(18,2)`` would turn 12.345 into 12.35, so the value goes through
    ``decimal(38,18)``; digits beyond that scale are checked in the text.
    """
    text = strip_text(raw)
    wide = text.try_cast("decimal(38,18)")
    # Digits after the point up to the last that isn't zero, less the exponent: beyond two, not whole cents.
    digits = F.regexp_extract(text, r"\A[+-]?([0-9]*\.?[0-9]*)", 1)
    significant = F.rtrim(digits, F.lit("0"))
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?[0-9]+)\z", 1).try_cast("int"), F.lit(0))
    places = F.when(digits.contains("."), F.length(F.substring_index(significant, ".", -1))).otherwise(
        F.length(significant) - F.length(digits)
    )
    long_tail = places - exponent > 2
    return Amount(
        raw=raw,
        text=text,
        number=text.rlike(NUMBER),
        positive=~text.startswith("-") & text.rlike(r"\A\+?[0.]*[1-9]"),
        in_cents=~long_tail & F.coalesce((F.round(wide, 2) == wide) & (wide != 0), F.lit(True)),
        wide=wide,
        value=F.when(raw.rlike(COMMON), raw.try_cast("decimal(18,2)")).otherwise(
            wide.try_cast("decimal(18,2)")
        ),
    )


def amount_text(amount: Column) -> Column:
    """Canonical text of a stored amount, always with two decimals."""
    return amount.cast("decimal(18,2)").cast("string")
