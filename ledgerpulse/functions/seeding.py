"""Seeded pseudo-random order that depends only on a row's own key.

Unlike ``rand(seed)`` it does not change with partitioning or when a lost task
is run again. MD5 is used because other SQL engines have it too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_order(key: Column | str, seed: int) -> Column:
    """Uniform number in [0, 2^60) from ``seed`` and ``key``."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
