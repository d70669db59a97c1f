"""Deterministic numbers from text, the same in every engine that has SHA-256."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash60(text: Column) -> Column:
    """First 60 bits of SHA-256 as a non-negative BIGINT."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def seeded(key: Column, seed: int) -> Column:
    """``hash60`` of the key and a seed."""
    return hash60(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def unit(hashed: Column) -> Column:
    """Map a 60-bit hash to [0, 1)."""
    return hashed / F.lit(float(1 << 60))


def fields_digest(*fields: Column) -> Column:
    """SHA-256 of several texts as bytes; a null differs from an empty text, and lengths keep the fields apart."""
    parts = [F.coalesce(F.concat(F.length(f), F.lit(":"), f), F.lit("-")) for f in (c.cast("string") for c in fields)]
    return F.unhex(F.sha2(F.concat(*parts), 256))
