"""Similarity join on word shingles (7): signature trees inside blocks of shared rare shingles.

1. Every text becomes its set of shingle hashes; texts with equal sets are one class from here on,
   however many copies there are. A class has a key, a size and a bitmap of its shingles.
2. Shingles are counted over all texts. Frequent ones go last in the order in which a class lists its
   shingles, the rest are ordered by hash. Two sets whose Jaccard reaches the bound share one of
   their first n - ceil(bound * n) + 1 shingles, so a passage that many texts quote does not bring
   them together.
3. Classes that share such a shingle form a block, named by its smallest and largest class; shingles
   with the same name share a block, so a family of near copies meets in a few blocks, not in one for
   each shingle. A class without a partner of fitting size and position leaves the block.
4. First round: the trees of each block propose a forest of pairs; exact intersections of whole sets
   confirm or refuse them. Large blocks are cut into pages, and the representatives of the components
   found go on to the next round until a block's fit one page. Families are connected by then.
5. Last round: blocks that still hold two components are compared in full, page pair by page pair.
   Every pair of different components that the trees cannot exclude is tested exactly.

Nothing is capped: a block may have any number of pages. Equal shingles have equal 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from salesmill.llm.bitmap import bitmap_of, perhaps_in
from salesmill.llm.components import smallest_reachable
from salesmill.llm.shipping import ship
from salesmill.llm.sigtree import FANOUT, alike, bitmap, candidates, few_candidates
from salesmill.llm.text import NOT_SPACE, byte_slices, find_words, mix, seeded, windows
from salesmill.session import written

WORDS, PERCENT = 5, 75
#: Sets in one page of a block; a task holds two pages.
PAGE = 1000
#: Shingles that may count as frequent: 8 bytes each are sent to every task, 16 MB at most.
HOT_TABLE = 1 << 21
#: A shingle found more often than this is frequent, or than its double, four times, ... if the table is full.
LEAST_HOT = 8
#: Text whose shingles are counted together before they are sent on.
PACKED_BYTES = 2 << 20
#: Set keys a task remembers, some 8 MB.
SEEN = 1 << 16
#: Stands in for a missing doc_id inside the join.
NO_ID = -(1 << 63)


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has one, of all its words."""
    words = find_words(texts, NOT_SPACE)
    hashes = words.hashes()
    at, value = windows(hashes, words.ptr, size)
    cut = np.searchsorted(at, words.ptr)
    sets = [np.unique(value[cut[i] : cut[i + 1]]) for i in range(len(texts))]
    counts = words.counts()
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        run = hashes[words.ptr[i] : words.ptr[i + 1]]
        sets[i] = mix((run * (seeded(len(run), 90 + len(run)) | np.uint64(1))).sum(keepdims=True))
    return sets


def class_key(shingles: np.ndarray) -> int:
    """A key of the set: sums of two mixes of its members and its size, order-free."""
    one = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True)
    other = mix(shingles + np.uint64(77)).sum(keepdims=True)
    return int(mix(one + (other << np.uint64(7)) + np.uint64(len(shingles))).view(np.int64)[0])


def _per_slice(docs: DataFrame, text: str, make, schema: str) -> DataFrame:
    """Apply make(doc_ids, sets) -> arrays to slices of (doc_id, text) rows."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                ids = part.column(0).to_numpy(zero_copy_only=False)
                made = make(ids, shingle_sets(part.column(1)))
                if made is not None:
                    yield pa.record_batch(made)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema)


def classes_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, set_id, n, bits): the class of each row, null for a text without words."""

    def make(ids, sets):
        sizes = np.array([len(s) for s in sets], np.int64)
        keys = np.array([class_key(s) if len(s) else 0 for s in sets], np.int64)
        bits = pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())
        return {"doc_id": pa.array(ids), "set_id": pa.array(keys, mask=sizes == 0), "n": pa.array(sizes), "bits": bits}

    return _per_slice(docs, text, make, "doc_id long, set_id long, n long, bits binary")


def _frequent(docs: DataFrame, text: str, least_hot: int) -> tuple[np.ndarray, int]:
    """Sorted leading bits of all frequent shingles, and how many bits that are.

    Map tasks count in slices and send each bucket its values packed; buckets grow in number with
    the session's shuffle partitions. Only the order of shingles depends on the counts, so repeats
    inside a text and shingles that share their leading bits do no harm.
    """
    spark = docs.sparkSession
    bits = max(3, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())

    def pack(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", PACKED_BYTES):
                words = find_words(part.column(0), NOT_SPACE)
                found = windows(words.hashes(), words.ptr, WORDS)[1] >> np.uint64(32 - bits)
                found, times = np.unique(found, return_counts=True)
                there, first = np.unique((found >> np.uint64(32)).astype(np.int64), return_index=True)
                cut = np.append(first, len(found))
                low, times = found.astype(np.uint32), times.astype(np.uint32)
                yield pa.record_batch({
                    "bucket": pa.array(there, pa.int32()),
                    "low": pa.array([low[cut[i] : cut[i + 1]].tobytes() for i in range(len(there))], pa.binary()),
                    "times": pa.array([times[cut[i] : cut[i + 1]].tobytes() for i in range(len(there))], pa.binary()),
                })

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low = np.frombuffer(b"".join(rows["low"]), np.uint32)
        times = np.frombuffer(b"".join(rows["times"]), np.uint32).astype(np.int64)
        order = np.argsort(low)
        low, times = low[order], times[order]
        first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        total = np.add.reduceat(times, first)
        often = total > least_hot
        return pd.DataFrame({"lead": (np.int64(key[0]) << 32) | low[first[often]].astype(np.int64), "times": total[often]})

    packed = docs.select(F.col(text).alias("text")).mapInArrow(pack, "bucket int, low binary, times binary")
    counted = written(packed.groupBy("bucket").applyInPandas(count, "lead long, times long"), "frequent")
    doubled = F.floor(F.log2((F.col("times") - 1) / F.lit(least_hot))).cast("int")  # times > least_hot * 2**doubled
    sizes = {r[0]: r[1] for r in counted.groupBy(doubled).count().collect()}  # one row for each power of two
    power = 0
    while sum(n for p, n in sizes.items() if p >= power) > HOT_TABLE:
        power += 1
    leads = counted.where(doubled >= power).select("lead").toArrow()["lead"].to_numpy()
    return np.sort(leads).astype(np.uint64), bits


def _prefixes(docs: DataFrame, text: str, hot: np.ndarray, bits: int, percent: int) -> DataFrame:
    """(shingle, set_id, n, place, hot): the leading shingles of each set, frequent ones last.

    A task gives each of its sets once (of more than SEEN sets some again), so copies of a text are one for
    each task before anything is shuffled, however short the text is.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(hot)
    seen: set[int] = set()  # every task has its own, empty at first

    def make(ids, sets):
        known = frequent.value
        out = [[], [], [], [], []]
        for s in sets:
            if not len(s):
                continue
            key = class_key(s)
            if key in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(key)
            lead = s >> np.uint64(32 - bits)
            at = np.searchsorted(known, lead)
            at[at == len(known)] = 0
            often = known[at] == lead if len(known) else np.zeros(len(s), bool)
            length = len(s) - (percent * len(s) + 99) // 100 + 1
            chosen = np.argsort(often, kind="stable")[:length]
            rows = (s[chosen], np.full(length, key), np.full(length, len(s), np.int32),
                    np.arange(length, dtype=np.int32), often[chosen])
            for column, values in zip(out, rows):
                column.append(values)
        if out[0]:
            shingle, key, n, place, often = (np.concatenate(c) for c in out)
            return {"shingle": shingle.view(np.int64), "set_id": key, "n": n, "place": place, "hot": often}

    return _per_slice(docs, text, make, "shingle long, set_id long, n int, place int, hot boolean")


def _partnered(n: np.ndarray, place: np.ndarray, ends: np.ndarray, percent: int) -> np.ndarray:
    """Rows that may link with another row of their group, if their shingle is the first they share.

    At the first shingle two sets share, the rest of the smaller tail bounds their overlap.
    """
    keep = np.zeros(len(n), bool)
    at = np.arange(len(n))
    last = np.repeat(ends, np.diff(np.append(0, ends)))
    for step in range(1, int(np.diff(np.append(0, ends)).max(initial=0))):
        a = at[at + step < last]
        b = a + step
        rest = np.minimum(n[a] - place[a], n[b] - place[b])
        fits = (100 + percent) * rest >= percent * (n[a] + n[b])
        fits &= (100 * n[a] >= percent * n[b]) & (100 * n[b] >= percent * n[a])
        keep[a[fits]] = True
        keep[b[fits]] = True
    return keep


def _blocks(prefixes: DataFrame, percent: int) -> DataFrame:
    """(low, high, set_id): the classes that share a shingle, under the shingle's smallest and largest."""

    def group(batches):
        parts = [[b.column(i).to_numpy() for i in range(4)] for b in batches if b.num_rows]
        if not parts:
            return
        shingle, key, n, place = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((key, shingle))
        shingle, key, n, place = shingle[order], key[order], n[order].astype(np.int64), place[order].astype(np.int64)
        fresh = np.r_[True, (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])]  # copies give equal rows
        shingle, key, n, place = shingle[fresh], key[fresh], n[fresh], place[fresh]
        change = shingle[1:] != shingle[:-1]
        alone = np.r_[True, change] & np.r_[change, True]
        shingle, key, n, place = shingle[~alone], key[~alone], n[~alone], place[~alone]
        if not len(key):
            return
        ends = np.append(np.flatnonzero(shingle[1:] != shingle[:-1]) + 1, len(key))
        keep = _partnered(n, place, ends, percent)
        shingle, key = shingle[keep], key[keep]
        if not len(key):
            return
        first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        counts = np.diff(np.append(first, len(key)))
        low, high = np.minimum.reduceat(key, first), np.maximum.reduceat(key, first)
        rows = np.unique(np.stack([np.repeat(low, counts), np.repeat(high, counts), key], axis=1), axis=0)
        yield pa.record_batch({"low": rows[:, 0], "high": rows[:, 1], "set_id": rows[:, 2]})

    schema = "low long, high long, set_id long"
    rare = prefixes.where("not hot").select("shingle", "set_id", "n", "place").repartition("shingle")
    # Used twice below; unwritten, every text would be cut into shingles once more.
    often = written(prefixes.where("hot").select("shingle", "set_id").distinct(), "often")
    named = often.groupBy("shingle").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high")
    common = often.join(named, "shingle").select("low", "high", "set_id")
    return rare.mapInArrow(group, schema).union(common).distinct()


def _paged(members: DataFrame, page: int) -> DataFrame:
    """Add (pages, page): a block of more than `page` rows is cut by the hash of its classes."""
    large = members.groupBy("low", "high").count().where(F.col("count") > page)
    pages = F.coalesce(F.ceil(F.col("count") / F.lit(page)), F.lit(1)).cast("long")
    return (
        members.join(large, ["low", "high"], "left")
        .withColumn("pages", pages)
        .withColumn("page", F.expr("pmod(xxhash64(set_id, 11), pages)"))
        .drop("count")
    )


def _propose(members: DataFrame, keys: list[str], percent: int, spanning: bool) -> DataFrame:
    """Pairs (a, b) that the trees of each group of `members` (keys, set_id, n, bits, root) propose."""

    def pairs_of(group):
        ids, sizes, bits, roots = zip(*group)
        if len(ids) <= FANOUT:
            found = few_candidates(bits, sizes, percent, roots, spanning)
        else:
            lead = np.array([int.from_bytes(b[:4], "little") for b in bits])
            found = candidates(list(bits), np.array(sizes), lead, percent, np.array(roots), spanning)
        return [(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in found]

    def run(batches):
        # Rows come sorted by key; a group has two pages at most.
        key, group = None, []
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if row[: len(keys)] != key:
                    if len(group) > 1:
                        out += pairs_of(group)
                    key, group = row[: len(keys)], []
                group.append(row[len(keys) :])
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
        if len(group) > 1 and (out := pairs_of(group)):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    rows = members.select(*keys, "set_id", "n", "bits", "root").repartition(*keys)
    return rows.sortWithinPartitions(*keys, "set_id").mapInArrow(run, "a long, b long")


class _Verifier:
    """Tests proposed pairs on whole sets, which it scans out of the texts of the classes concerned."""

    def __init__(self, docs: DataFrame, text: str, first: DataFrame, percent: int):
        self.docs, self.text, self.first, self.percent = docs, text, first, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose Jaccard reaches the bound."""
        percent = self.percent
        pairs = written(pairs.distinct(), "pairs")
        asked = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        asked = written(self.first.join(asked, "set_id"), "asked")
        shared = self.docs.sparkSession.sparkContext.broadcast(bitmap_of(asked, "doc_id"))

        def sets_of(ids, sets):
            at = [i for i in np.flatnonzero(perhaps_in(shared.value, ids)) if len(sets[i])]
            if at:
                return {
                    "doc_id": pa.array(ids[at]),
                    "set_id": pa.array([class_key(sets[i]) for i in at], pa.int64()),
                    "shingles": pa.array([sets[i].tobytes() for i in at], pa.binary()),
                }

        def test(batches):
            for batch in batches:
                keep = [
                    alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                    for x, y in zip(batch.column(2), batch.column(3))
                ]
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        sets = _per_slice(self.docs, self.text, sets_of, "doc_id long, set_id long, shingles binary")
        # The bitmap lets others pass; this join is exact and leaves one text for each class.
        sets = sets.join(asked, ["set_id", "doc_id"], "left_semi").select("set_id", "shingles")
        sets = written(sets.dropDuplicates(["set_id"]), "sets")
        x = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return written(both.mapInArrow(test, "a long, b long").distinct(), "links")


def _with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the root of their component, by default themselves."""
    return members.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))


def _roots(links: DataFrame) -> DataFrame:
    return smallest_reachable(links).select(F.col("node").alias("set_id"), "root")


def _connect_families(blocks: DataFrame, classes: DataFrame, verifier: _Verifier, page: int) -> DataFrame:
    """Links that connect the families of each block, found on pages and then among representatives."""
    level, links, size = blocks, None, None
    while True:
        level = written(_paged(level, page), "pages")
        ready = level.join(classes, "set_id").withColumn("root", F.col("set_id"))
        found = verifier.links(_propose(ready, ["low", "high", "page"], verifier.percent, spanning=True))
        links = found if links is None else written(links.union(found), "all-links")
        large = level.where("pages > 1").select("low", "high", "set_id")
        left = large.count()
        if left == 0 or (size is not None and left > size // 2):
            return links  # one page for each block, or unlike sets that a further round would not join
        size = left
        level = _with_roots(large, _roots(links)).select("low", "high", F.col("root").alias("set_id")).distinct()


def _compare_rest(blocks: DataFrame, classes: DataFrame, roots: DataFrame, verifier: _Verifier, page: int) -> DataFrame:
    """Links between components that meet in a block, every pair of their classes compared."""
    members = _with_roots(blocks, roots)
    mixed = members.groupBy("low", "high").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y")
    members = written(members.join(mixed.select("low", "high"), ["low", "high"], "left_semi"), "mixed")
    paged = _paged(members, page)
    # A large component keeps to pages of its own, so pages of one component meet no other of it.
    own = paged.groupBy("low", "high", "root", "pages").count().where((F.col("pages") > 1) & (F.col("count") > page // 2))
    own = own.select("low", "high", "root", F.ceil(F.col("count") / F.lit(page)).cast("long").alias("own"))
    paged = paged.join(own, ["low", "high", "root"], "left").withColumn(
        "page",
        F.when(F.col("own").isNotNull(), F.xxhash64("root", F.expr("pmod(xxhash64(set_id, 13), own)")))
        .otherwise(F.col("page")),
    ).select("low", "high", "set_id", "root", "page")
    paged = written(paged, "paged")
    pages = paged.groupBy("low", "high", "page").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    p, q = pages.alias("p"), pages.alias("q")
    pairs = p.join(
        q,
        (F.col("p.low") == F.col("q.low")) & (F.col("p.high") == F.col("q.high")) & (F.col("p.page") <= F.col("q.page"))
        & ((F.col("p.x") != F.col("q.y")) | (F.col("p.y") != F.col("q.x"))),
    ).select(
        F.col("p.low").alias("low"), F.col("p.high").alias("high"),
        F.col("p.page").alias("one"), F.col("q.page").alias("other"),
    )
    sides = pairs.select("low", "high", "one", "other", F.col("one").alias("page")).union(
        pairs.where("one <> other").select("low", "high", "one", "other", F.col("other").alias("page"))
    )
    ready = sides.join(paged, ["low", "high", "page"]).join(classes, "set_id")
    return verifier.links(_propose(ready, ["low", "high", "one", "other"], verifier.percent, spanning=False))


def similar_documents(
    docs: DataFrame, text: str = "text", percent: int = PERCENT, page: int = PAGE, least_hot: int = LEAST_HOT
) -> DataFrame:
    """One row per row of `docs`: (doc_id, n_shingles, set_id, group_id, component_id).

    component_id is the smallest doc_id that links can reach, the row's own included; set_id is
    shared by texts of equal sets, group_id by texts that links connect. Null and empty texts have no shingles and link with nothing. Rows
    that repeat a doc_id give a row each. A row without doc_id joins its neighbours; its own
    component_id is null if no other has one. Other columns of `docs` are ignored.
    """
    ship(docs.sparkSession)
    found = written(classes_of(docs, text), "classes")
    hot, bits = _frequent(docs, text, least_hot)
    blocks = written(_blocks(_prefixes(docs, text, hot, bits, percent), percent), "blocks")

    first = found.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    wanted = blocks.select("set_id").distinct()
    first = written(first.join(wanted, "set_id", "left_semi"), "firsts")
    classes = written(
        found.join(first, ["set_id", "doc_id"], "left_semi").select("set_id", "n", "bits").dropDuplicates(["set_id"]), "signatures"
    )
    verifier = _Verifier(docs, text, first, percent)
    links = _connect_families(blocks, classes, verifier, page)
    late = _compare_rest(blocks, classes, _roots(links), verifier, page)
    roots = _roots(links.union(late))

    parts = written(_with_roots(found.select("doc_id", "set_id", "n"), roots), "parts")
    known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    least = parts.where("root is not null").groupBy("root").agg(F.min(known).alias("least"), F.count(F.lit(1)).alias("rows"))
    least = least.where("rows > 1")  # the others are their own component
    return parts.join(least, "root", "left").select(
        known.alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "set_id",
        F.col("root").alias("group_id"),
        F.when(F.col("rows").isNotNull(), F.col("least")).otherwise(known).alias("component_id"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, all columns, less near duplicates: of each group the smallest doc_id stays.

    Texts without words are in no group and all stay. A group of rows without doc_id keeps one of
    them; rows that repeat a doc_id and a set of shingles leave one. Only rows whose id may have to go
    are shuffled.
    """
    spark = docs.sparkSession
    found = written(similar_documents(docs, percent=percent).select("doc_id", "set_id", "group_id"), "groups")
    found = found.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    grouped = found.where("group_id is not null")
    best = F.min(F.struct(F.col("doc_id") == NO_ID, "doc_id", "set_id")).alias("best")
    keep = written(grouped.groupBy("group_id").agg(best).select("best.doc_id", "best.set_id"), "kept")
    leaving = grouped.join(keep, ["doc_id", "set_id"], "left_anti").select("doc_id")
    repeated = grouped.groupBy("doc_id").count().where("count > 1").select("doc_id")
    bitmap = spark.sparkContext.broadcast(bitmap_of(leaving.union(repeated), "doc_id"))

    def split(perhaps: bool):
        def run(batches):
            for batch in batches:
                for part in byte_slices(batch, "text"):
                    ids = part.column(part.schema.get_field_index("doc_id")).cast(pa.int64()).fill_null(NO_ID)
                    chosen = part.filter(pa.array(perhaps_in(bitmap.value, ids.to_numpy()) == perhaps))
                    if not perhaps:
                        yield chosen
                    elif chosen.num_rows:
                        sets = shingle_sets(chosen.column(chosen.schema.get_field_index("text")))
                        keys = pa.array([class_key(s) if len(s) else None for s in sets], pa.int64())
                        yield chosen.append_column("_set_id", keys)

        return run

    certain = docs.mapInArrow(split(False), docs.schema)
    rows = docs.mapInArrow(split(True), StructType([*docs.schema.fields, StructField("_set_id", LongType())]))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = rows.withColumn("_id", key)
    keep = keep.select(F.col("doc_id").alias("_id"), F.col("set_id").alias("_set_id"))
    chosen = rows.join(keep, ["_id", "_set_id"], "left_semi").dropDuplicates(["_id", "_set_id"])
    wordless = rows.where("_set_id is null")
    return certain.unionByName(chosen.select(*docs.columns)).unionByName(wordless.select(*docs.columns))
