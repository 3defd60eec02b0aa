"""Words of many texts at once: byte arrays in, word positions and 64-bit hashes out.

The operators hand whole texts to Python in Arrow batches and work on slices of half a MB, so memory
depends on the slice and the longest single text. Words are found on UTF-8 bytes, which is exact for
classes that hold either all or none of the bytes from 0x80 on. Only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 20)) * _U(0x9E3779B97F4A7C15))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true inside the given inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Anything but the ASCII white space 0x20 and 0x09-0x0D.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ASCII digits and letters, and every other character.
WORD = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_BASE = 0x9E3779B97F4A7C15 | 5
_BYTES = seeded(256, 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse modulo 2**64."""
    if n > len(_powers.get("up", ())):
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base % (1 << 64), _U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=_U)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each run of bytes, by differences of one running polynomial."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


@dataclass
class Words:
    """Words of a run of texts; those of text i are numbered ptr[i] to ptr[i + 1]."""

    data: np.ndarray  # lower-cased bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray

    def hashes(self) -> np.ndarray:
        """One hash per word: equal words have equal hashes."""
        return span_hashes(self.data, self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts())


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins; a null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(texts: pa.Array, is_word: np.ndarray) -> Words:
    raw, offsets = raw_bytes(texts)
    data, inside = _LOWER[raw], is_word[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    full = np.flatnonzero(np.diff(offsets) > 0)
    before[offsets[full]] = False
    after[offsets[full + 1] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, ptr: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of `size` words inside one text begins, and its hash."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    factors = seeded(size, 2 + size) | _U(1)
    total = np.zeros(n, _U)
    for j in range(size):
        total += hashes[j : j + n] * factors[j]
    last = np.repeat(ptr[1:], np.diff(ptr))[:n]  # where the text of each word ends
    at = np.flatnonzero(np.arange(n) + size <= last)
    return at, mix(total[at])


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts together stay near `limit` bytes (one text at least)."""
    if not batch.num_rows:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset :][: batch.num_rows + 1].astype(np.int64)
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end




def bucket_of(doc_ids: np.ndarray, modulus: int) -> np.ndarray:
    """crc32 of each id written as text, modulo `modulus`."""
    import zlib

    return np.array([zlib.crc32(str(i).encode()) % modulus for i in doc_ids], np.int64)
