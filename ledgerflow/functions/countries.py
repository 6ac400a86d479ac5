"""Assigned ISO 3166-1 alpha-2 codes."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def assigned_country_codes() -> tuple[str, ...]:
    """The codes the JVM's locale data lists as assigned (about 250, fixed size)."""
    spark = SparkSession.active()
    return tuple(sorted(spark._jvm.java.util.Locale.getISOCountries()))
