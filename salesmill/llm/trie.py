"""Conversation prefix trie (13): sorted turn-id matrices in numpy over range shards of all conversations.

A conversation becomes its path, the 16-byte hashes of its turns in order. Spark deals paths into range
shards, by path and then by conversation, so that however many copies a path has they are split too. A
shard pads its paths to matrices of turn ids, BAND columns at a time, and lexsorts them; a long
conversation widens only the matrices of the few that share its beginning. Masks of changed columns,
OR-accumulated from left to right, mark where nodes start, and reduceat sums every depth.

Of each row only what it shares with the row before matters, so all figures of a node are sums over its
rows, and the parts of a node in several shards add up. Such nodes lie on the path of a shard's first or
last row. Their parts, few rows for each shard, are corrected at the seams (a first row does have a row
before it, a last row one after it) and added in Spark. Lists of ended conversations are hashed in
order; one that spans shards passes through one task as a stream of short pieces, since the digest of a
list cannot be computed in parts.

A shard holds about CELLS turns. One conversation is one row: its turns, 20 bytes each, are in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from salesmill.llm.shipping import ship
from salesmill.session import written

BAND = 16
CELLS = 1 << 19
#: Ids in one piece of a list of ended conversations.
PIECE = 512

_ID = 16
_FIGURES = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_SCHEMA = (
    "kind string, shard int, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, parent_conv_id long, key binary, parent_key binary, has_first boolean, has_last boolean, "
    "ends_last boolean, before long, upto long, piece long, ids string"
)


def turn_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as array of (turn, id, chars).

    A null role or text is empty; null turns come first; turns of one number are in the order of their
    hashes; rows without conv_id belong to no conversation; repeated rows are turns of their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", F.md5(name.cast("binary")).alias("id"), F.char_length(text).alias("chars")).alias("turn"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def with_lent_beginnings(paths: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Replace the first h turns of conversation c by those of c - c % every; h is crc32(c) % (most + 1).

    If that conversation is absent they are replaced by nothing. At most `every` rows ask one lender.
    """
    lenders = paths.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_lender"), F.slice("turns", 1, most).alias("_lent"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    own = F.slice("turns", h + 1, F.size("turns"))
    lent = F.when(F.col("_lent").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("_lent", F.lit(1), h))
    joined = paths.withColumn("_lender", F.col("conv_id") - F.col("conv_id") % every).join(lenders, "_lender", "left")
    return joined.select("conv_id", F.concat(lent, own).alias("turns"))


def _sorted_rows(ids: np.ndarray, first: np.ndarray, length: np.ndarray, conv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all rows by path, then conv; and how many turns each shares with the row before (-1: no row)."""
    n = len(conv)
    order = np.argsort(conv, kind="stable")
    starts = np.zeros(n, bool)  # where a group of rows begins that are equal so far
    starts[:1] = True
    shared = length[order].copy()  # rows never told apart from the one before share all
    shared[:1] = -1
    at = np.arange(n)
    base = 0
    while len(at):
        # Go on with groups of several rows of which one is longer than what was compared.
        group = np.cumsum(starts[at]) - 1
        more = np.bincount(group, length[order[at]] > base) > 0
        at = at[(more & (np.bincount(group) > 1))[group]]
        if not len(at):
            break
        rows = order[at]
        group = np.cumsum(starts[at]) - 1
        width = int(min(BAND, length[rows].max() - base))
        column = base + np.arange(width)
        inside = column < length[rows][:, None]
        matrix = np.full((len(rows), width), -1, np.int64)
        matrix[inside] = ids[(first[rows][:, None] + column)[inside]]
        by = np.lexsort((*matrix.T[::-1], group))
        matrix, rows = matrix[by], rows[by]
        order[at] = rows
        changed = np.zeros(matrix.shape, bool)
        changed[1:] = matrix[1:] != matrix[:-1]
        changed[starts[at], :] = False
        changed = np.logical_or.accumulate(changed, axis=1)
        new = changed[:, -1]
        starts[at[new]] = True
        shared[at[new]] = base + changed[new].argmax(axis=1)
        base += width
    # Lengths were taken in the first order.
    same = ~starts
    shared[same] = length[order][same]
    return order, shared


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


_NO_IDS = hashlib.sha256(b"").hexdigest()


def _prefix_keys(path: bytes) -> list[bytes]:
    """A digest for each beginning of a path, the empty one first."""
    state, keys = hashlib.blake2b(digest_size=16), []
    keys.append(state.digest())
    for i in range(0, len(path), _ID):
        state.update(path[i : i + _ID])
        keys.append(state.digest())
    return keys


def _dense(data: np.ndarray) -> np.ndarray:
    """Numbers for 16-byte ids, in their order."""
    pairs = data.view(">u8").reshape(-1, 2).astype(np.uint64)
    by = np.lexsort((pairs[:, 1], pairs[:, 0]))
    new = np.zeros(len(by), np.int64)
    new[1:] = (pairs[by][1:] != pairs[by][:-1]).any(axis=1)
    out = np.empty(len(by), np.int64)
    out[by] = np.cumsum(new)
    return out


def _shard_nodes(shard: int, conv: np.ndarray, data: np.ndarray, chars: np.ndarray, first: np.ndarray):
    """Rows of _SCHEMA, as dicts of columns, for the conversations of one shard; first[i] is where row i's turns begin."""
    ids, length = _dense(data), np.diff(first)
    order, shared = _sorted_rows(ids, first[:-1], length, conv)
    conv, length, first = conv[order], length[order], first[:-1][order]
    n = len(conv)
    total = np.concatenate([[0], np.cumsum(chars)])
    base = total[first]

    def upto(rows, depth):  # characters of the first `depth` turns
        return total[first[rows] + depth] - base[rows]

    leaf = np.ones(n, np.int64)  # the last row of a childless node
    leaf[:-1] = shared[1:] < length[:-1]
    def path(row: int) -> bytes:
        return data[first[row] * _ID : (first[row] + length[row]) * _ID].tobytes()

    keys = {False: _prefix_keys(path(0)), True: _prefix_keys(path(n - 1))}

    def key(row_first: bool, row_last: bool, depth: int) -> bytes | None:
        return keys[not row_first][depth] if row_first or row_last else None

    active, depth, parents = np.arange(n), 0, None
    while len(active):
        at = np.flatnonzero(shared[active] < depth)
        top = active[at]
        sizes = np.diff(np.append(at, len(active)))
        before = np.maximum(depth - 1, 0)
        saves = upto(active, np.maximum(shared[active], before)) - upto(active, before)
        figures = {
            "conv_id": np.minimum.reduceat(conv[active], at),
            "n_convs": sizes,
            "n_children": np.add.reduceat(((shared[active] <= depth) & (length[active] > depth)).astype(np.int64), at),
            "n_leaves": np.add.reduceat(leaf[active], at),
            "saved_tokens": np.add.reduceat(saves, at),
        }
        ended = np.add.reduceat((length[active] == depth).astype(np.int64), at)
        m = len(at)
        has_first, has_last = np.zeros(m, bool), np.zeros(m, bool)
        has_first[0] = top[0] == 0
        has_last[-1] = active[-1] == n - 1
        edge = has_first | has_last
        node_keys = [None] * m
        for j in {0, m - 1}:
            node_keys[j] = key(bool(has_first[j]), bool(has_last[j]), depth)
        out = {
            "kind": ["edge" if e else "node" for e in edge.tolist()],
            "shard": np.full(m, shard, np.int32), "depth": np.full(m, depth, np.int64), **figures,
            "ends_sha256": [
                _digest(conv[t : t + c]) if c and not e else None if e else _NO_IDS
                for t, c, e in zip(top.tolist(), ended.tolist(), edge.tolist())
            ],
            "key": node_keys, "has_first": has_first, "has_last": has_last, "ends_last": has_last & (length[-1] == depth),
            "before": upto(np.zeros(m, np.int64), min(before, length[0])), "upto": upto(np.zeros(m, np.int64), min(depth, length[0])),
        }
        if parents is not None:
            parent_top, parent_conv, parent_keys = parents
            mine = np.searchsorted(parent_top, top, side="right") - 1
            out["parent_conv_id"] = parent_conv[mine]
            out["parent_key"] = [parent_keys[k] for k in mine.tolist()]
        yield out
        for j in np.flatnonzero(edge & (ended > 0)).tolist():
            own = conv[top[j] : top[j] + ended[j]]
            cuts = range(0, len(own), PIECE)
            yield {
                "kind": ["ends"] * len(cuts), "shard": np.full(len(cuts), shard, np.int32), "key": [node_keys[j]] * len(cuts),
                "piece": np.arange(len(cuts)), "ids": [",".join(map(str, own[c : c + PIECE].tolist())) for c in cuts],
            }
        parents = top, figures["conv_id"], node_keys
        depth += 1
        active = active[length[active] >= depth]


_ARROW = pa.schema([
    (c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[c.split()[1]])
    for c in _SCHEMA.split(", ")
])


def _batch(columns: dict) -> pa.RecordBatch:
    n = len(columns["kind"])
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW]
    return pa.record_batch(arrays, schema=_ARROW)


def _all_nodes(batches):
    conv, paths, chars, lengths = [], [], [], []
    for batch in batches:
        conv.append(batch.column(0).to_numpy())
        path = batch.column(1).cast(pa.large_binary())
        ends = np.frombuffer(path.buffers()[1], np.int64)[path.offset : path.offset + len(path) + 1]
        if path.buffers()[2] is not None:
            paths.append(np.frombuffer(path.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy())
        lengths.append(np.diff(ends) // _ID)
        chars.append(batch.column(2).flatten().to_numpy().astype(np.int64))
    if not sum(map(len, conv)):
        return
    first = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
    data = np.concatenate([*paths, np.zeros(0, np.uint8)])
    for out in _shard_nodes(TaskContext.get().partitionId(), np.concatenate(conv), data, np.concatenate(chars), first):
        yield _batch(out)


def _list_digests(batches):
    """SHA-256 of the joined pieces of each key; pieces come sorted, a key's pieces in a row."""
    key, state, done = None, None, []
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], ["key", "ends_sha256"])
            done = []
    if state is not None:
        yield pa.record_batch([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def _joined_edges(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Whole nodes from their parts, one row per key, with the seams between shards mended."""
    span = edges.groupBy("key").agg(F.min("shard").alias("low"), F.max("shard").alias("high"))
    parts = edges.join(span, "key")
    goes_back = F.col("has_first") & (F.col("shard") > F.col("low"))
    seams = parts.groupBy("shard").agg(
        F.max(F.when(goes_back, F.col("depth"))).alias("common"),  # turns shared with the last row of the shard before
        F.max(F.when(goes_back, F.col("upto"))).alias("common_chars"),
        F.max(F.col("ends_last") & (F.col("high") > F.col("shard"))).alias("goes_on"),
    )

    def less(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    mended = parts.join(seams, "shard").select(
        "key", "depth", "parent_key", "conv_id", "n_convs",
        (F.col("n_children") - less(F.col("has_first") & (F.col("depth") < F.col("common")))).alias("n_children"),
        (F.col("n_leaves") - less(F.col("has_last") & F.col("goes_on"))).alias("n_leaves"),
        (F.col("saved_tokens") + F.when(F.col("has_first") & (F.col("depth") <= F.col("common")), F.col("common_chars") - F.col("before"))
         .otherwise(0)).alias("saved_tokens"),
    )
    sums = [F.sum(c).alias(c) for c in _FIGURES[1:]]
    whole = mended.groupBy("key").agg(
        F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *sums)
    sorted_ends = ends.select("key", "ids", "shard", "piece").repartition("key").sortWithinPartitions("key", "shard", "piece")
    lists = sorted_ends.select("key", "ids").mapInArrow(_list_digests, "key binary, ends_sha256 string")
    return whole.join(lists, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS)))


def prefix_trie(paths: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row per distinct beginning of the conversations in `paths` (conv_id, turns), which are distinct by conv_id:
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The root is the empty beginning; conversations without turns end there. An empty table has no nodes.
    """
    spark = paths.sparkSession
    ship(spark)
    turns = F.col("turns")
    rows = written(paths.select(
        "conv_id", F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), "")).alias("path"),
        F.transform(turns, lambda t: t["chars"]).alias("chars"),
    ), "trie-paths")
    n_turns = rows.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_turns // cells))
    found = written(rows.repartitionByRange(shards, "path", "conv_id").mapInArrow(_all_nodes, _SCHEMA), "trie-nodes")
    nodes, edges = found.where("kind = 'node'"), found.where("kind = 'edge'")
    whole = written(_joined_edges(edges, found.where("kind = 'ends'")), "trie-edges")
    names = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    # A shard's own copy of the names: the root's many children then have as many keys as there are shards.
    local = edges.select("shard", F.col("key").alias("parent_key")).join(names, "parent_key")
    out = ["conv_id", "depth", "parent_conv_id", *_FIGURES[1:], "ends_sha256"]
    known = nodes.where("parent_key is null").select(*out)
    beside = nodes.where("parent_key is not null").join(local, ["shard", "parent_key"]).withColumn("parent_conv_id", F.col("_parent"))
    upper = whole.join(names, "parent_key", "left").withColumn("parent_conv_id", F.col("_parent"))
    return known.unionByName(beside.select(*out)).unionByName(upper.select(*out))
