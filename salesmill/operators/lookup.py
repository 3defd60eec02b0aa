"""Left joins to a dimension, safe for keys that are often NULL or very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def look_up(left: DataFrame, dim: DataFrame, key: str, dim_key: str, keep: list[str], spread_by: list[str]) -> DataFrame:
    """Add `keep` of `dim` to every row of `left`; unmatched rows get NULL.

    `dim` holds each key once. No broadcast is forced: Spark broadcasts when the size it knows
    allows, and otherwise joins by shuffle, where adaptive execution splits a hot key's partition.
    Rows without a key match nothing, but would all be hashed to one task; they are hashed by
    `spread_by` instead. The second condition keeps such a made-up key from matching.
    """
    side = dim.select(F.col(dim_key).alias("_key"), *keep)
    hashed = F.coalesce(F.col(key).cast("bigint"), F.xxhash64(*spread_by))
    return left.join(side, (F.col("_key") == hashed) & F.col(key).isNotNull(), "left").drop("_key")
