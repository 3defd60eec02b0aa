"""Cross-tokenizer alignment (12): sparse products of token incidence matrices, built by hand in numpy.

Two tokenizers cut one text. Each cut is a CSR matrix of its tokens by the text's bytes. The product
A * B^T, row by row as Gustavson does it, holds how many bytes two tokens share: the overlap links. Where the
last partner of one token and the first partner of the next differ, both cuts end, which gives the groups.
The tokens of the groups, each id once with its number, are two more matrices, and the rows of their product
are the shared-group links: ids that may stand for each other, and how often.

A task works on slices of texts and numbers the distinct id pairs of a block of them. Spark sums in how many
documents a pair occurs, finds the best of each A id, and brings both back to the blocks; the texts are cut
once. What is broadcast has one row per A id, at most the vocabulary. Products are formed in runs of at most
EXPANDED entries, so that memory follows the slice and the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesmill.llm.shipping import ship
from salesmill.llm.text import byte_slices, raw_bytes
from salesmill.llm.tokens import encoder, token_bytes
from salesmill.session import written

BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text whose distinct id pairs are numbered together.
BLOCK_BYTES = 1 << 22
EXPANDED = 1 << 21


@dataclass
class Csr:
    """Rows of a sparse matrix: row i has columns[ptr[i]:ptr[i + 1]], in order, with `values`."""

    ptr: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> Csr:
        """From entries sorted by row."""
        return Csr(np.searchsorted(rows, np.arange(shape[0] + 1)), columns, values, shape[1])

    @staticmethod
    def runs(ends: np.ndarray, width: int) -> Csr:
        """Row i covers the columns from the end of row i - 1 to its own."""
        return Csr(np.concatenate([[0], ends]), np.arange(width), np.ones(width, np.int64), width)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> Csr:
        by = np.argsort(self.columns, kind="stable")
        return Csr.of(self.columns[by], self.owner()[by], self.values[by], (self.width, len(self.ptr) - 1))

    def expanded(self, other: Csr, most: int = EXPANDED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (row, column, value) of this matrix times `other` before those of one place are added.

        Row i of the product is the sum of the rows of `other` that the entries of row i name. They come in
        row order, in runs of at most `most` entries (a single row of `other` may be longer).
        """
        owner = self.owner()
        sizes = np.diff(other.ptr)[self.columns]
        done = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(self.columns):
            to = max(at + 1, int(np.searchsorted(done, done[at] + most, side="right")) - 1)
            n = sizes[at:to]
            place = np.repeat(other.ptr[self.columns[at:to]] - (done[at:to] - done[at]), n) + np.arange(done[to] - done[at])
            yield np.repeat(owner[at:to], n), other.columns[place], np.repeat(self.values[at:to], n) * other.values[place]
            at = to

    def times(self, other: Csr) -> Csr:
        """The product: entries of one place are added."""
        rows, columns, values = zip(*self.expanded(other)) if len(self.columns) else ([], [], [])
        keys = np.concatenate([*[r * other.width + c for r, c in zip(rows, columns)], np.zeros(0, np.int64)])
        places, inverse = np.unique(keys, return_inverse=True)
        total = np.zeros(len(places), np.int64)
        np.add.at(total, inverse, np.concatenate([*values, np.zeros(0, np.int64)]))
        return Csr.of(places // other.width, places % other.width, total, (len(self.ptr) - 1, other.width))


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, shared bytes) for tokens that share bytes, in order. Both cut the same bytes."""
    if not len(ends_a):
        none = np.zeros(0, np.int64)
        return none, none, none
    width = int(ends_a[-1])
    a, b = Csr.runs(ends_a, width), Csr.runs(ends_b, width).transposed()
    parts = []
    for rows, columns, values in a.expanded(b):
        # Bytes stand in order, so entries of one place are neighbours.
        first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])]))
        parts.append((rows[first], columns[first], np.add.reduceat(values, first)))
    rows, columns, values = (np.concatenate(p) for p in zip(*parts))
    if len(parts) > 1:  # a pair may be cut by the end of a run
        first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])]))
        rows, columns, values = rows[first], columns[first], np.add.reduceat(values, first)
    return rows, columns, values


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and of B: runs of tokens that end together."""
    a, b, _ = overlap_links(ends_a, ends_b)
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turn = np.flatnonzero(a[1:] != a[:-1])  # the last link of each token of A but the last
    fresh = np.zeros(len(ends_a), np.int64)
    fresh[a[turn + 1]] = b[turn + 1] > b[turn]
    of_a = np.cumsum(fresh)
    of_b = np.empty(len(ends_b), np.int64)
    of_b[b] = of_a[a]
    return of_a, of_b


def _incidence(groups: np.ndarray, ids: np.ndarray, n_groups: int, vocabulary: int) -> Csr:
    """Groups by ids, with the number of tokens of that id in that group."""
    places, counts = np.unique(groups * vocabulary + ids, return_counts=True)
    return Csr.of(places // vocabulary, places % vocabulary, counts, (n_groups, vocabulary))


def id_pair_links(text_of: np.ndarray, in_a: Csr, in_b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, links): the id pairs that share groups of a text and how often; pair = id of A * width of B + id of B.

    The product runs over groups: each names its ids of A, and each of these takes the group's row of B. Pairs
    of a run are added before the next run.
    """
    group = in_a.owner()
    entries = Csr(np.arange(len(group) + 1), group, in_a.values, len(in_a.ptr) - 1)
    text, pair, links = (np.zeros(0, np.int64) for _ in range(3))
    for rows, columns, values in entries.expanded(in_b):
        text = np.concatenate([text, text_of[group[rows]]])
        pair = np.concatenate([pair, in_a.columns[rows] * in_b.width + columns])
        by = np.lexsort((pair, text))
        text, pair, links = text[by], pair[by], np.concatenate([links, values])[by]
        first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])]))
        text, pair, links = text[first], pair[first], np.add.reduceat(links, first)
    return text, pair, links


@cache
def _piece_model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray, np.ndarray]:
    """The model, the bytes of all its pieces in a row, and where each begins."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model, *_pool(pieces)


def _pool(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])


@cache
def _byte_pool(path: str) -> tuple[np.ndarray, np.ndarray]:
    return _pool(token_bytes(path))


def _spelled(ids: np.ndarray, pool: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of tokens in a row, and where each ends."""
    sizes = first[ids + 1] - first[ids]
    ends = np.cumsum(sizes)
    return pool[np.repeat(first[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], ends


@dataclass
class Aligned:
    """Tokens of texts that both tokenizers spell alike: id, text, group and last byte of each; groups run on over texts."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


def align(texts: pa.Array, byte_path: str, piece_path: str) -> Aligned:
    """Tokens and groups of all texts; a null or empty text has none, nor one that a tokenizer does not spell byte by byte."""
    texts = texts.cast(pa.large_string()).fill_null("")
    raw, offsets = raw_bytes(texts)
    sizes = np.diff(offsets)
    # A space before every text.
    lead = np.insert(raw, offsets[:-1], 0x20)
    starts = offsets[:-1] + np.arange(len(sizes))
    spaced = pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(np.append(starts, len(lead)).astype(np.int64)), pa.py_buffer(lead))
    ids_a, cut_a = encoder(byte_path).encode(spaced, special=False)
    ids_a = ids_a.astype(np.int64)
    model, pool, first = _piece_model(piece_path)
    lists = model.encode(texts.to_pylist(), num_threads=1)
    cut_b = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    ids_b = np.fromiter(chain.from_iterable(lists), np.int64, cut_b[-1])

    text_a = np.repeat(np.arange(len(sizes)), np.diff(cut_a))
    text_b = np.repeat(np.arange(len(sizes)), np.diff(cut_b))
    keep = sizes > 0
    pools = ((ids_a, text_a, *_byte_pool(byte_path)), (ids_b, text_b, pool, first))
    for ids, owner, own_pool, own_first in pools:
        keep &= np.bincount(owner, own_first[ids + 1] - own_first[ids], len(sizes)) == sizes + 1
    kept = np.flatnonzero(keep)
    want = lead[np.repeat(keep, sizes + 1)]
    wrong = np.zeros(len(want), bool)
    for ids, owner, own_pool, own_first in pools:
        wrong |= _spelled(ids[keep[owner]], own_pool, own_first)[0] != want
    if wrong.any():
        keep[kept[np.unique(np.repeat(np.arange(len(kept)), sizes[kept] + 1)[wrong])]] = False
    ids_a, text_a, ids_b, text_b = ids_a[keep[text_a]], text_a[keep[text_a]], ids_b[keep[text_b]], text_b[keep[text_b]]
    ends_a = _spelled(ids_a, *_byte_pool(byte_path))[1]
    ends_b = _spelled(ids_b, pool, first)[1]
    return Aligned(ids_a, ids_b, text_a, text_b, *groups_of(ends_a, ends_b), ends_a, ends_b)


@cache
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """`i,` for every i below n in a row, and where each begins."""
    return _pool([b"%d," % i for i in range(n)])


def written_groups(found: Aligned, n: int) -> list[bytes]:
    """Per text its groups as `a1,a2|b1;a3|b2,b3`; empty without tokens."""
    na, nb = len(found.ids_a), len(found.ids_b)
    if not na:
        return [b""] * n
    # A group's tokens of A, then those of B.
    at_a = np.arange(na) + np.searchsorted(found.group_b, found.group_a, side="left")
    at_b = np.arange(nb) + np.searchsorted(found.group_a, found.group_b, side="right")
    ids, text = np.empty(na + nb, np.int64), np.empty(na + nb, np.int64)
    ids[at_a], ids[at_b], text[at_a], text[at_b] = found.ids_a, found.ids_b, found.text_a, found.text_b
    line, ends = _spelled(ids, *_decimals(1 << int(ids.max()).bit_length()))
    for at, group, mark in ((at_a, found.group_a, b"|"), (at_b, found.group_b, b";")):
        line[ends[at[np.append(group[1:] != group[:-1], True)]] - 1] = mark[0]
    cut = np.concatenate([[0], ends])[np.searchsorted(text, np.arange(n + 1))].tolist()
    return [line[x : y - 1].tobytes() if y > x else b"" for x, y in zip(cut, cut[1:])]


_DOCS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def _links(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per document with the pairs it links as places in its block's list, and rows that are these lists.

    kind 0: a document; `pairs` and `times` are 32-bit numbers. kind 1: pair `place` of a block, with its ids
    and the number of documents of the block that link it.
    """
    kind = docs.schema["doc_id"].dataType
    arrow = pa.schema([
        ("kind", pa.int32()), ("block", pa.int64()), ("doc_id", to_arrow_type(kind)), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
        ("place", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n_docs", pa.int64()),
    ])

    def batch(block: int, what: int, columns: dict) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        columns = {"kind": np.full(n, what, np.int32), "block": np.full(n, block, np.int64), **columns}
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow]
        return pa.record_batch(arrays, schema=arrow)

    def run(batches):
        width = _piece_model(piece_path)[0].get_piece_size()
        vocabulary = len(_byte_pool(byte_path)[1]) - 1
        block = TaskContext.get().partitionId() << 32
        slices, size = [], 0  # (ids and figures of the slice's documents, text, pair, links)

        def finished():
            pairs = np.unique(np.concatenate([s[2] for s in slices]))
            n_docs = np.zeros(len(pairs), np.int64)
            for columns, text, pair, links in slices:
                place = np.searchsorted(pairs, pair)
                n_docs += np.bincount(place, minlength=len(pairs))
                n = len(columns["n_a"])
                cut = (4 * np.searchsorted(text, np.arange(n + 1))).tolist()
                places, times = place.astype("<u4").tobytes(), links.astype("<u4").tobytes()
                columns["pairs"] = [places[x:y] for x, y in zip(cut, cut[1:])]
                columns["times"] = [times[x:y] for x, y in zip(cut, cut[1:])]
                yield batch(block, 0, columns)
            if len(pairs):
                yield batch(block, 1, {"place": np.arange(len(pairs)), "a": pairs // width, "b": pairs % width, "n_docs": n_docs})

        for whole in batches:
            for part in byte_slices(whole, "text"):
                n = part.num_rows
                found = align(part.column(1), byte_path, piece_path)
                groups = int(found.group_a[-1]) + 1 if len(found.group_a) else 0
                text_of = np.zeros(groups, np.int64)
                text_of[found.group_a] = found.text_a
                links = id_pair_links(
                    text_of, _incidence(found.group_a, found.ids_a, groups, vocabulary),
                    _incidence(found.group_b, found.ids_b, groups, width))
                columns = {
                    "doc_id": part.column(0),
                    "n_a": np.bincount(found.text_a, minlength=n), "n_b": np.bincount(found.text_b, minlength=n),
                    "n_groups": np.bincount(text_of, minlength=n),
                    "n_links": np.bincount(links[0], links[2], n).astype(np.int64),
                    "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in written_groups(found, n)],
                }
                slices.append((columns, *links))
                size += part.column(1).nbytes
                if size >= BLOCK_BYTES:
                    yield from finished()
                    slices, size, block = [], 0, block + 1
        if slices:
            yield from finished()

    schema = f"kind int, block long, doc_id {kind.simpleString()}, {_DOCS}, place int, a int, b int, n_docs long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, n_docs, best): in how many documents two ids are linked; best marks the highest of its A id, ties included."""
    counts = written(links.where("kind = 1").groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs")), "pair-counts")
    # One row per id of the vocabulary.
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    return counts.join(F.broadcast(top), "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def aligned_documents(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per row of `docs`.

    Null and empty texts, and texts that one of the tokenizers does not spell byte by byte (its rules may
    change characters), have no tokens: zeros and ''. Repeated rows are documents of their own. Other columns
    are ignored. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    byte_path = byte_path or public_tokenizers.path(BYTE_VOCABULARY)
    piece_path = piece_path or public_tokenizers.path(PIECE_MODEL)
    kind = docs.schema["doc_id"].dataType
    links = written(_links(docs, byte_path, piece_path), "links")
    known = links.where("kind = 1").select("block", "place", "a", "b").join(pair_counts(links), ["a", "b"])
    known = known.select(F.col("block").alias("of_block"), "place", "n_docs", "best")
    shown = links.where("kind = 0").select("block", "doc_id", *[c.split()[0] for c in _DOCS.split(", ")])
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        counts = np.zeros(right.num_rows, np.int64)
        best = np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        counts[place] = right.column("n_docs").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        sums = []
        for pairs, times in zip(left.column("pairs"), left.column("times")):
            at, n = np.frombuffer(pairs.as_py(), "<u4"), np.frombuffer(times.as_py(), "<u4").astype(np.int64)
            sums.append((int((best[at] * n).sum()), int((counts[at] * n).sum())))
        return pa.table({
            "doc_id": left.column("doc_id"), **{c: left.column(c) for c in names},
            "n_best": pa.array([s[0] for s in sums], pa.int64()), "count_sum": pa.array([s[1] for s in sums], pa.int64()),
            "groups_sha256": left.column("groups_sha256"),
        })

    schema = f"doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return shown.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(counted, schema)
