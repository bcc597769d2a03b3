"""Seeded hashes that give the same value on every engine and every partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(seed: int, *keys: Column) -> Column:
    """32 bits of the MD5 of ``seed:key:...`` as a non-negative long.

    Keys count by their text; pass a timestamp as ``F.unix_micros``, since its text depends on the session's time zone.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
