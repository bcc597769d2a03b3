"""Fixed-length arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_left(values: Column, length: int, pad: int = 0) -> Column:
    """Keep the last ``length`` values, with ``pad`` in front of shorter lists."""
    fill = F.array_repeat(F.lit(pad), length)
    return F.slice(F.concat(fill, F.coalesce(values, F.slice(fill, 1, 0))), -length, length)


def pad_lists_left(lists: Column, length: int, width: int, pad: int = 0) -> Column:
    """Right-pad or cut every inner list to ``width``, then left-pad the outer list to ``length``."""
    row = F.array_repeat(F.lit(pad), width)
    fitted = F.transform(lists, lambda inner: F.slice(F.concat(inner, row), 1, width))
    fill = F.array_repeat(row, length)
    return F.slice(F.concat(fill, F.coalesce(fitted, F.slice(fill, 1, 0))), -length, length)
