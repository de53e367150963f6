"""Deterministic per-row hashes (the reference's seeded numpy draws cannot be
reproduced; the contract here is "exact size, deterministic by key").

``md5('<seed>:' || key)`` gives the same hex string in Spark and DuckDB, so a
row's sampling order is engine-independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_hex(key: Column | str, seed: int = 42) -> Column:
    """32-char hex md5 of ``'<seed>:' || key``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def hash_bucket(hex_col: Column, digits: int = 5) -> Column:
    """Leading ``digits`` hex chars as an int in ``[0, 16**digits)``; it is a
    prefix of the hash, so ordering by (bucket, hash) equals ordering by hash."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long")


def hash_unit(key: Column | str, seed: int = 42, salt: str = "") -> Column:
    """A uniform draw in [0, 1) from the first 13 hex digits (52 bits)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(F.lit(f"{seed}:{salt}"), k.cast("string")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / float(16 ** 13)
