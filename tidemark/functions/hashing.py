"""Portable deterministic hashing: the same value in any engine that has MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_digits(*parts: Column) -> Column:
    """The first eight hex digits of the MD5 of the parts joined by ``|``; in the order of ``stable_hash``, and cheaper."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8)


def stable_hash(*parts: Column) -> Column:
    """Non-negative 32-bit hash of the parts, as a long: ``stable_digits`` as a number."""
    return F.conv(stable_digits(*parts), 16, 10).cast("long")


def hash_bucket(modulus: int, *parts: Column) -> Column:
    return stable_hash(*parts) % modulus
