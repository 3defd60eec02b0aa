"""A bounded bitmap of ids that a scan can test before it shuffles anything.

It only says "surely not" or "perhaps", so an exact join always follows. Its size never grows: on a
very large set it fills up and lets everything through, which costs a shuffle and loses nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from salesmill.llm.text import mix

BITS = 25  # 4 MB


def _place(ids: np.ndarray) -> np.ndarray:
    return mix(ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)


def perhaps_in(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = _place(ids.astype(np.int64))
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(ids: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a whole-number column; at most 2**BITS / 64 words reach the driver, 4 MB in all."""
    import pyarrow as pa

    def words(batches):
        for batch in batches:
            at = np.unique(_place(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            if len(word):
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                yield pa.record_batch({"word": word[first], "bits": np.bitwise_or.reduceat(bit, first).view(np.int64)})

    found = (
        ids.select(column).mapInArrow(words, "word long, bits long")
        .groupBy("word").agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bitmap.view(np.uint8)
