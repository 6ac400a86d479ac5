"""Text, timestamp and hash expressions."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as blank when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
UNIT_SEPARATOR = "\u001f"
ISO_UTC = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(Z|\+00:00)\z"


# Text that begins and ends with a printable ASCII character: nothing to strip.
STRIPPED = r"\A[!-~](.*[!-~])?\z"


def strip_text(text: Column) -> Column:
    """Blank characters off both ends; the pattern spares most values the slower trim."""
    return F.when(text.rlike(STRIPPED), text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def is_blank(text: Column) -> Column:
    return strip_text(text) == ""


def parse_utc(text: Column) -> Column:
    """Strict ``YYYY-MM-DDTHH:MM:SS`` with ``Z`` or ``+00:00``; NULL for anything else."""
    well_formed = text.rlike(ISO_UTC) & ~text.startswith("0000")
    return F.when(well_formed, F.substring(text, 1, 19).try_cast("timestamp_ntz"))


def format_utc(timestamp: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of a zone-less UTC timestamp, whatever the session zone is."""
    return F.concat(F.translate(F.substring(timestamp.cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def utc_date(timestamp: Column) -> Column:
    return timestamp.cast("date")


def hash_of(*columns: Column) -> Column:
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *columns), 256)


def list_text(values: Column) -> Column:
    """An array of names written as ``['a', 'b']``."""
    return F.concat(F.lit("['"), F.array_join(values, "', '"), F.lit("']"))


# A UTC second: date and time apart by T and marked as UTC, or apart by a space.
UTC_SECOND = re.compile(r"(\d{4}-\d\d-\d\d)(?:T(\d\d:\d\d:\d\d)(?:Z|\+00:00)| (\d\d:\d\d:\d\d))", re.ASCII)


def to_utc_datetime(value: str | datetime) -> datetime:
    """A driver-side timestamp parameter as a zone-less UTC datetime."""
    if isinstance(value, str):
        parts = UTC_SECOND.fullmatch(value)
        if parts is None:
            raise ValueError(f"not a UTC timestamp: {value!r}")
        return datetime.fromisoformat(f"{parts[1]}T{parts[2] or parts[3]}")
    return value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)


def to_utc_text(value: str | datetime | None) -> str | None:
    return None if value is None else to_utc_datetime(value).strftime("%Y-%m-%dT%H:%M:%SZ")


def utc_literal(value: str | datetime | None) -> Column:
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(to_utc_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def now_utc_text() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
