"""Deterministic hashing shared by sampling, splitting and candidate choice.

``md5`` of ``seed|part|part…`` and its first 32 bits as an integer: the same
value in Spark and in any SQL engine with ``md5``, and independent of how the
data is partitioned (unlike ``rand``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_key(seed: int, *parts) -> Column:
    cols = [F.lit(str(seed))]
    for p in parts:
        cols += [F.lit("|"), (F.col(p) if isinstance(p, str) else p).cast("string")]
    return F.concat(*cols)


def seeded_md5(seed: int, *parts) -> Column:
    return F.md5(seeded_key(seed, *parts))


def seeded_hash32(seed: int, *parts) -> Column:
    """Unsigned 32-bit integer from the md5 prefix (0 … 2^32-1) as BIGINT."""
    return F.conv(F.substring(seeded_md5(seed, *parts), 1, 8), 16, 10).cast("long")


def sql_seeded_md5(seed: int, *parts: str) -> str:
    inner = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5('{seed}|' || {inner})"


def sql_seeded_hash32(seed: int, *parts: str) -> str:
    return f"CAST(('0x' || substr({sql_seeded_md5(seed, *parts)}, 1, 8)) AS BIGINT)"
