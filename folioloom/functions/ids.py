"""Stable identifiers and the hash that samples and splits are dealt by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(value: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(value.cast("string"), 256), 1, length)


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix:part:..., with / and : in parts as _; null and empty parts left out."""
    clean = [F.nullif(F.translate(p.cast("string"), "/:", "__"), F.lit("")) for p in parts]
    return F.concat_ws(":", F.lit(prefix), *clean)


def seeded_digest(seed: int, key: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def unit_interval(seed: int, key: Column) -> Column:
    """A number from 0 to 1: the first 48 bits of the seeded digest."""
    return F.conv(F.substring(seeded_digest(seed, key), 1, 12), 16, 10).cast("long") / F.lit(float(16**12))
