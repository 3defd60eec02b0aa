"""Packing documents into training windows: differencing (10) and best fit (9).

Every task packs what it reads, a block of documents at a time: no ids are shuffled, memory is bounded
by the block, and a task that runs again packs the same rows into the same windows. Only the last,
part-filled block of a task has less to choose from. Documents end with the id END; ids come from
`tokens`. Each id of each document lies in exactly one piece.

Differencing: of each document whole windows are cut off first, then pieces of PIECE ids and what is
left; these odd lengths let the loads come out close. The pieces of a block are divided over k windows by Karmarkar and Karp's multiway
differencing: the two partial partitions of greatest imbalance are merged, heavy windows onto light
ones, until one is left. k is the least number that could hold the block, and rises until no window
exceeds the capacity.

Best fit: documents longer than the capacity are split into whole windows and a rest; items go, longest
first, into the window with the least room that still fits, found in a segment tree over the room that
open windows have left.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesmill.llm.shipping import ship
from salesmill.llm.text import byte_slices
from salesmill.llm.tokens import END, encoder

CAPACITY = 2048
PIECE = 256
#: Windows of a block; its ids take CAPACITY * BLOCK_WINDOWS * 4 bytes, 1 MB here.
BLOCK_WINDOWS = 128
#: Ids a block leaves free in each window on average, so that the least k nearly always holds it.
SLACK = 6


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """A window 0 .. k-1 for each piece, by multiway differencing; loads come out near-equal."""
    n = len(sizes)
    if k == 1:
        return np.zeros(n, np.int64)
    # A node is a set of pieces that share a window: a piece (0 .. n-1), nothing (n), or two nodes.
    left, right = [], []
    heap = []
    for i in range(n):
        loads, nodes = np.zeros(k, np.int64), np.full(k, n)
        loads[0], nodes[0] = sizes[i], i
        heap.append((-int(sizes[i]), i, loads, nodes))
    heapq.heapify(heap)
    count, tie = n + 1, n
    while len(heap) > 1:
        _, _, loads_a, nodes_a = heapq.heappop(heap)
        _, _, loads_b, nodes_b = heapq.heappop(heap)
        loads = loads_a + loads_b[::-1]  # both are sorted, heaviest first
        left.append(nodes_a)
        right.append(nodes_b[::-1])
        order = np.argsort(-loads, kind="stable")
        nodes = (count + np.arange(k))[order]
        loads = loads[order]
        loads -= loads[-1]
        heapq.heappush(heap, (-int(loads[0]), tie, loads, nodes))
        count, tie = count + k, tie + 1
    window = np.zeros(count, np.int64)
    window[heap[0][3]] = np.arange(k)
    for m in range(len(left) - 1, -1, -1):
        own = window[n + 1 + m * k : n + 1 + (m + 1) * k]
        window[left[m]] = own
        window[right[m]] = own
    return window[:n]


def fill_evenly(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Divide pieces (each at most `capacity`) over as few near-equal windows as differencing needs."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, k)
        if np.bincount(window, sizes, k).max() <= capacity:
            return window
        k += 1


class Room:
    """Open windows by the room they have left: a segment tree over 0 .. capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = [0] * (2 * self.leaves)

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at //= 2

    def put(self, window: int, room: int) -> None:
        self.open[room].append(window)
        self._change(room, 1)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the window with the least room of at least `size`."""
        at = size + self.leaves
        if not self.count[at]:
            # Up until a right sibling holds a window, then down its left edge.
            while at > 1 and (at % 2 or not self.count[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._change(room, -1)
        return self.open[room].pop(), room


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A window for each item (each at most `capacity`): best fit, longest first."""
    window, room, opened = np.zeros(len(sizes), np.int64), Room(capacity), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = room.tightest(size)
        if found is None:
            found = opened, capacity
            opened += 1
        window[i] = found[0]
        if found[1] > size:
            room.put(found[0], found[1] - size)
    return window


def _documents(batches, path: str | None) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, ids with END) of every row, in order."""
    encode = encoder(path).encode
    for batch in batches:
        for part in byte_slices(batch, "text"):
            ids, cut = encode(part.column(1))
            for i, doc in enumerate(part.column(0).to_pylist()):
                yield doc, np.append(ids[cut[i] : cut[i + 1]], np.uint32(END))


class _Numbers:
    """Window numbers of one task, unlike those of any other."""

    def __init__(self):
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 32

    def take(self, n: int) -> int:
        first, self.next = self.next, self.next + n
        return first


_PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_evenly(docs: DataFrame, capacity: int = CAPACITY, piece: int = PIECE, block_windows: int = BLOCK_WINDOWS,
                vocabulary: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    A null or empty text is one id, END. Repeated rows are packed one by one; an empty table gives no
    rows; other columns are ignored. Window numbers depend on how Spark cuts the table into tasks.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = to_arrow_type(docs.schema["doc_id"].dataType)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        numbers = _Numbers()
        rows: list[tuple] = []  # pieces of the block without window: doc, start, length, crc, doc_tokens
        full: list[tuple] = []
        waiting = 0

        def emit():
            sizes = np.array([r[2] for r in rows], np.int64)
            out = []
            if len(rows):
                window = fill_evenly(sizes, capacity)
                order = np.argsort(window, kind="stable")
                ends = np.cumsum(sizes[order])
                starts = ends - sizes[order]
                first = np.flatnonzero(np.r_[True, np.diff(window[order]) > 0])
                base = np.repeat(starts[first], np.diff(np.append(first, len(order))))
                number = numbers.take(int(window.max()) + 1)
                out = [(*rows[i], number + int(window[i]), int(o)) for i, o in zip(order.tolist(), starts - base)]
            number = numbers.take(len(full))
            out += [(*r, number + j, 0) for j, r in enumerate(full)]
            rows.clear()
            full.clear()
            types = [arrow] + [pa.int64()] * 6
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for doc, ids in _documents(batches, vocabulary):
            n = len(ids)
            whole = n // capacity
            cuts = [*range(0, whole * capacity, capacity), *range(whole * capacity, n, piece), n]
            for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                row = (doc, a, b - a, zlib.crc32(ids[a:b]), n)
                if j < whole:
                    full.append(row)
                else:
                    rows.append(row)
                    waiting += b - a
            if waiting >= block_windows * (capacity - SLACK) - capacity // 2 or len(full) >= 64 * block_windows:
                yield emit()
                waiting = 0
        if rows or full:
            yield emit()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_PIECES}")


_MATRIX = (
    "sequence_id long, n_tokens long, doc_ids array<{}>, starts array<long>, cu_seqlens array<int>, "
    "input_ids binary, position_ids binary"
)


def pack_matrix(docs: DataFrame, capacity: int = CAPACITY, block_windows: int = 4 * BLOCK_WINDOWS,
                pad: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Packed windows ready for training, one row each.

    `input_ids` holds `capacity` unsigned little-endian 32-bit ids, padded with `pad` after n_tokens;
    `cu_seqlens` the cumulative lengths of the pieces from 0; `position_ids` a 32-bit position for each
    id that starts again at 0 with every piece, padding included; `doc_ids` and `starts` name each
    piece's document and its first id there, so documents can be put together again. Null, empty and
    repeated rows are packed like others; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = pa.schema([
        ("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(arrow)), ("starts", pa.list_(pa.int64())),
        ("cu_seqlens", pa.list_(pa.int32())), ("input_ids", pa.binary()), ("position_ids", pa.binary()),
    ])

    def run(batches):
        numbers = _Numbers()
        items: list[tuple] = []  # doc, start, ids
        waiting = 0

        def emit():
            sizes = np.array([len(i[2]) for i in items], np.int64)
            window = best_fit(sizes, capacity)
            order = np.argsort(window, kind="stable")
            cut = np.flatnonzero(np.r_[True, np.diff(window[order]) > 0, True])
            number = numbers.take(len(cut) - 1)
            rows = []
            for w, (a, b) in enumerate(zip(cut, cut[1:])):
                own = [items[i] for i in order[a:b]]
                ends = np.cumsum([0] + [len(i[2]) for i in own])
                ids, positions = np.full(capacity, pad, "<u4"), np.zeros(capacity, "<u4")
                for (_, _, part), at in zip(own, ends):
                    ids[at : at + len(part)] = part
                    positions[at : at + len(part)] = np.arange(len(part))
                positions[ends[-1] :] = np.arange(capacity - ends[-1])
                rows.append((
                    number + w, int(ends[-1]), [i[0] for i in own], [i[1] for i in own], ends.tolist(),
                    ids.tobytes(), positions.tobytes(),
                ))
            items.clear()
            for i in range(0, len(rows), 256):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 256]), schema)], schema=schema)

        for doc, ids in _documents(batches, vocabulary):
            items += [(doc, a, ids[a : a + capacity]) for a in range(0, len(ids), capacity)]
            waiting += len(ids)
            if waiting >= block_windows * capacity:
                yield from emit()
                waiting = 0
        if items:
            yield from emit()

    return docs.select("doc_id", "text").mapInArrow(run, _MATRIX.format(kind))


def write_matrix(packed: DataFrame, path: str) -> None:
    """Write packed windows as Parquet, one fixed-width binary row of ids for each."""
    packed.write.parquet(path)


def matrix_digest(packed: DataFrame) -> DataFrame:
    """The windows of pack_matrix with checksums in place of their binary columns."""
    return packed.select(
        "sequence_id", "n_tokens", "doc_ids", "starts", "cu_seqlens",
        F.crc32("input_ids").alias("ids_crc32"), F.crc32("position_ids").alias("positions_crc32"),
    )
