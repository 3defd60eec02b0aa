"""Benchmark decontamination (6): which words of a document lie inside a benchmark's n-grams.

Every run of `size` consecutive words of a benchmark item is a window; an item of fewer words is one
window. The hashes of all windows are broadcast, as a sorted array, in blocks of at most BLOCK
windows (24 MB); hits of a scan are verified word by word. A benchmark of more windows takes one
scan per block, of the untouched texts; the driver holds one block at a time, blocks name windows by
number, and Spark merges what the scans found for a document and looks up the items of each window.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmill.llm.shipping import ship
from salesmill.llm.text import WORD, byte_slices, find_words, raw_bytes, windows
from salesmill.session import written

SIZE = 10
BLOCK = 1 << 20


@dataclass
class Windows:
    """Windows of a block: sorted hashes, for each its words and the items that hold it."""

    lengths: list[int]
    hashes: np.ndarray
    words: list[bytes]
    items: list[tuple]  # items, or the number of the window


def _item_windows(items: DataFrame, size: int) -> DataFrame:
    """(item, words, length): the distinct windows of each item; null and wordless items have none."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                words = find_words(part.column(1), WORD)
                out = []
                for i, item in enumerate(part.column(0).to_pylist()):
                    own = [words.word(j) for j in range(words.ptr[i], words.ptr[i + 1])]
                    n = min(size, len(own))
                    out += [(item, b" ".join(w), n) for w in {tuple(own[j : j + n]) for j in range(len(own) - n + 1)} if n]
                if out:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.binary(), pa.int32()))],
                                          ["item", "words", "length"])

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return rows.mapInArrow(run, "item string, words binary, length int").distinct()


def _numbered(windows_: DataFrame) -> DataFrame:
    """(item, words): each distinct window once, with a number in the place of its items."""
    return written(windows_.select("words").distinct().select(F.monotonically_increasing_id().alias("item"), "words"), "numbered-windows")


def _blocks(windows_: DataFrame, block: int):
    """Read the windows in blocks of about `block` at most, by the hash of their words."""
    parts = -(-windows_.count() // block) or 1
    for k in range(parts):
        rows = windows_.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == k).toArrow().to_pandas()
        grouped = rows.groupby("words")["item"].agg(lambda s: tuple(sorted(s)))
        words = [bytes(w) for w in grouped.index]
        found = find_words(pa.array([w.decode() for w in words], pa.string()), WORD)
        single, lengths = found.hashes(), found.counts()
        hashes = np.zeros(len(words), np.uint64)
        for n in np.unique(lengths):
            at, value = windows(single, found.ptr, int(n))
            first = np.isin(at, found.ptr[:-1][lengths == n])
            hashes[lengths == n] = value[first]
        order = np.argsort(hashes, kind="stable")
        yield Windows(
            sorted({int(n) for n in lengths}), hashes[order], [words[i] for i in order], [grouped.iloc[i] for i in order]
        )


def _find(block: Windows, texts: pa.Array):
    """Words of each text, and for each text its hit windows as (word, length, place in the block)."""
    words = find_words(texts, WORD)
    single = words.hashes()
    owner = words.owner()
    hits: dict[int, list[tuple[int, int, int]]] = {}
    for n in block.lengths if len(block.hashes) else ():
        at, value = windows(single, words.ptr, n)
        place = np.searchsorted(block.hashes, value)
        place[place == len(block.hashes)] = 0
        for i in np.flatnonzero(block.hashes[place] == value).tolist():
            start, p = int(at[i]), int(place[i])
            run = b" ".join([words.word(j) for j in range(start, start + n)])
            while p < len(block.hashes) and block.hashes[p] == value[i]:
                if block.words[p] == run:
                    text = int(owner[start])
                    hits.setdefault(text, []).append((start - int(words.ptr[text]), n, p))
                    break
                p += 1
    return words, hits


def _covered(spans) -> int:
    total, reached = 0, 0
    for start, end in sorted(spans):
        total += max(0, end - max(start, reached))
        reached = max(reached, end)
    return total


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    A null or empty text has no words and no hits; an empty benchmark hits nothing. Items that repeat
    an item_id count once, a missing item_id counts as "". Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    windows_ = written(_item_windows(benchmark, size), "windows")
    if windows_.count() <= block:
        return _one_scan(rows, next(_blocks(windows_, block)), kind)
    # Several blocks: every scan numbers the windows it hit, and the union is counted once.
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    numbered = _numbered(windows_)
    found = _scans(rows, numbered, block, kind)

    def merge(key, part):
        import pandas as pd

        first = part.iloc[0]
        spans = {(int(s), int(e)) for flat in part["spans"] for s, e in zip(flat[::2], flat[1::2])}
        return pd.DataFrame([{"row": first["row"], "doc_id": first["doc_id"], "n_words": first["n_words"], "n_hit": _covered(spans)}])

    # A group is one row of docs and has one row per block.
    counted = found.groupBy("row").applyInPandas(merge, f"row long, doc_id {kind}, n_words long, n_hit long")
    of_window = windows_.join(numbered.withColumnRenamed("item", "number"), "words").select("number", "item")
    hits = found.select("row", F.explode("items").alias("number")).distinct()
    items = hits.join(of_window, "number").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(items, "row", "left").withColumn("items", listed).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items",
    )


def _scans(rows: DataFrame, numbered: DataFrame, block: int, kind: str) -> DataFrame:
    """What the scans of all blocks found on (doc_id, text, row) rows: a row for each row and block."""
    found = None
    for one in _blocks(numbered, block):
        shared = rows.sparkSession.sparkContext.broadcast(one)
        scan = written(_spans(rows, shared, kind), "hits")
        shared.unpersist()
        found = scan if found is None else found.union(scan)
    return found


def _spans(rows: DataFrame, shared, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                words, hits = _find(shared.value, part.column(1))
                n = part.num_rows
                yield pa.record_batch([
                    part.column(2), part.column(0), pa.array(words.counts()),
                    pa.array([[x for s, k, _ in hits.get(i, ()) for x in (s, s + k)] for i in range(n)], pa.list_(pa.int64())),
                    pa.array([sorted({x for h in hits.get(i, ()) for x in shared.value.items[h[2]]}) for i in range(n)],
                             pa.list_(pa.int64())),
                ], ["row", "doc_id", "n_words", "spans", "items"])

    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_words long, spans array<long>, items array<long>")


def _one_scan(rows: DataFrame, block: Windows, kind: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)
    empty = _digest(())

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                words, hits = _find(shared.value, part.column(1))
                n = part.num_rows
                covered, items = np.zeros(n, np.int64), [[]] * n
                for i, found in hits.items():
                    covered[i] = _covered([(s, s + k) for s, k, _ in found])
                    items[i] = sorted({x for _, _, p in found for x in shared.value.items[p]})
                yield pa.record_batch([
                    part.column(0), pa.array(words.counts()), pa.array(covered), pa.array([len(x) for x in items], pa.int64()),
                    pa.array([_digest(x) if x else empty for x in items]), pa.array(covered > 0),
                    pa.array(items, pa.list_(pa.string())),
                ], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"])

    return rows.mapInArrow(run, f"doc_id {kind}, {_RESULT}")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """The rows of `docs`, all columns, in which no benchmark window occurs; a scan for each block."""
    spark = docs.sparkSession
    ship(spark)
    for one in _blocks(_numbered(_item_windows(benchmark, size)), block):
        docs = _without(docs, spark.sparkContext.broadcast(one))
    return docs


def _without(docs: DataFrame, shared) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                _, hits = _find(shared.value, part.column(part.schema.get_field_index("text")))
                keep = np.ones(part.num_rows, bool)
                keep[list(hits)] = False
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """The rows of `docs`, all columns, without the passages that benchmark windows cover.

    A passage goes from the first character of its first word to the last of its last. All passages are
    found in the text as it is and cut at once, however many blocks the benchmark has.
    """
    spark = docs.sparkSession
    ship(spark)
    numbered = _numbered(_item_windows(benchmark, size))
    if numbered.count() <= block:
        shared = spark.sparkContext.broadcast(next(_blocks(numbered, block)))

        def scan(batches):
            for batch in batches:
                for part in byte_slices(batch, "text"):
                    words, hits = _find(shared.value, part.column(part.schema.get_field_index("text")))
                    yield _cut(part, words, {i: [(s, s + n) for s, n, _ in found] for i, found in hits.items()})

        return docs.mapInArrow(scan, docs.schema)
    row, spans = _new_name("row", docs), _new_name("spans", docs)
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    scanned = rows.select(F.lit(None).cast("int").alias("doc_id"), "text", F.col(row).alias("row"))
    found = _scans(scanned, numbered, block, "int").where(F.size("spans") > 0)
    merged = found.groupBy(F.col("row").alias(row)).agg(F.flatten(F.collect_list("spans")).alias(spans))

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                lists = part.column(part.num_columns - 1).to_pylist()
                part = part.select(range(part.num_columns - 1))
                words = find_words(part.column(part.schema.get_field_index("text")), WORD)
                yield _cut(part, words, {i: list(zip(flat[::2], flat[1::2])) for i, flat in enumerate(lists) if flat})

    return rows.join(merged, row, "left").select(*docs.columns, spans).mapInArrow(run, docs.schema)


def _new_name(name: str, docs: DataFrame) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _cut(part: pa.RecordBatch, words, spans: dict[int, list[tuple[int, int]]]) -> pa.RecordBatch:
    """The batch without the given spans (first word, word after the last) of its texts."""
    if not spans:
        return part
    at = part.schema.get_field_index("text")
    begins = raw_bytes(part.column(at))[1]
    texts = part.column(at).to_pylist()
    for i, found in spans.items():
        raw, kept, reached = texts[i].encode(), [], 0
        first = int(words.ptr[i])
        for start, end in sorted(found):
            a = int(words.starts[first + start] - begins[i])
            b = int(words.ends[first + end - 1] - begins[i])
            kept.append(raw[reached : max(a, reached)])
            reached = max(reached, b)
        texts[i] = b"".join([*kept, raw[reached:]]).decode()
    return part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
