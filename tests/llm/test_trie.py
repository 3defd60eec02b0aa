"""The prefix trie against a plain version, over many shards, with copies, long and odd conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from salesmill.llm import trie
from salesmill.llm.trie import prefix_trie, turn_paths, with_lent_beginnings

TURN = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def in_order(turns):
    """Turns of one conversation, (turn, role, text), in order."""
    def name(t):
        role, text = t[1] or "", t[2] or ""
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()

    return [(t[1] or "", t[2] or "") for t in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, name(t)))]


def rebuilt(rows) -> dict:
    own = defaultdict(list)
    for conv, *turn in rows:
        if conv is not None:
            own[conv].append(tuple(turn))
    own = {c: in_order(t) for c, t in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[: h[c]] + w[h[c] :] for c, w in own.items()}


def brute_force(sequences: dict) -> list[tuple]:
    members = defaultdict(list)
    for c, w in sequences.items():
        for d in range(len(w) + 1):
            members[tuple(w[:d])].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(p) == len(path) + 1 for p in below),
            sum(all(len(sequences[c]) == len(p) for c in members[p]) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df) -> list[tuple]:
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def conversations(seed: int, n: int, alphabet: int, most: int, spread: int = 1):
    """Random conversations over few turns, so that beginnings meet; a third of them are one conversation."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        turns = [0] * 4 if c % 3 == 0 else [rng.randrange(alphabet) for _ in range(rng.randrange(most + 1))]
        rows += [(c * spread, t, "user" if t % 2 else "assistant", f"text {x}" + "y" * x) for t, x in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed, n, alphabet, most", [(1, 60, 2, 6), (2, 90, 3, 4), (3, 40, 1, 25)])
@pytest.mark.parametrize("cells", [5, 1000])
def test_against_a_plain_version(spark, seed, n, alphabet, most, cells):
    rows = conversations(seed, n, alphabet, most)
    paths = turn_paths(spark.createDataFrame(rows, TURN))
    want = rebuilt([])  # no lending here
    own = defaultdict(list)
    for c, *turn in rows:
        own[c].append(tuple(turn))
    want = brute_force({c: in_order(t) for c, t in own.items()})
    assert found(prefix_trie(paths, cells)) == want


def test_lent_beginnings(spark):
    rows = conversations(4, 150, 2, 6, spread=3)
    df = spark.createDataFrame(rows, TURN)
    sequences = rebuilt(rows)
    assert any(not w for w in sequences.values())  # a conversation may be left without turns
    assert found(prefix_trie(with_lent_beginnings(turn_paths(df)), 30)) == brute_force(sequences)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (2, 1, "user", "é" * 5), (2, 1, "user", "b"),
        (2, None, "user", "first"), (-7, 0, "user", "x" * 200_000), (100, 0, "a", "bc"), (101, 0, "ab", "c"), (2**40, 0, "user", "far"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURN + ", depth string, turns string")
    paths = turn_paths(df)
    own = defaultdict(list)
    for c, *turn in rows:
        if c is not None:
            own[c].append(tuple(turn))
    assert found(prefix_trie(paths)) == brute_force({c: in_order(t) for c, t in own.items()})
    assert prefix_trie(turn_paths(df.limit(0))).collect() == []


def test_long_conversations_with_one_beginning(spark):
    rows = [(c, t, "user", f"t{t}" if t < 500 else f"t{t} {c}") for c in (1, 2) for t in range(501)]
    rows += [(c, 0, "user", "t0") for c in range(3, 60)]
    got = found(prefix_trie(turn_paths(spark.createDataFrame(rows, TURN)), 100))
    by = {(r[0], r[1]): r for r in got}
    assert len(got) == 1 + 500 + 2
    assert by[(1, 500)][2:6] == (1, 2, 2, 2) and by[(2, 501)][2:5] == (1, 1, 0)
    assert by[(1, 1)][3] == 59 and by[(1, 1)][7] == hashlib.sha256(",".join(map(str, range(3, 60))).encode()).hexdigest()
    assert by[(1, 0)][6] == 58 * 2 + sum(len(f"t{t}") for t in range(1, 500))


def test_a_list_of_ended_conversations_may_span_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = [(c, 0, "user", "same") for c in range(400)]
    got = {r[1]: r for r in found(prefix_trie(turn_paths(spark.createDataFrame(rows, TURN)), 20))}
    assert got[1][3:6] == (400, 0, 1) and got[1][7] == hashlib.sha256(",".join(map(str, range(400))).encode()).hexdigest()
    assert got[0][4:7] == (1, 1, 399 * 4)


def test_sorted_rows_pad_only_what_shares_a_beginning():
    """One very long path among many short ones widens no matrix of theirs."""
    rng = np.random.default_rng(5)
    length = np.array([5000] + [3] * 3000)
    first = np.concatenate([[0], np.cumsum(length)])[:-1]
    ids = rng.integers(0, 4, int(length.sum()))
    widths = []
    real = np.lexsort

    def watch(keys):
        widths.append((len(keys) - 1) * len(keys[-1]))
        return real(keys)

    np.lexsort = watch
    try:
        order, shared = trie._sorted_rows(ids, first, length, np.arange(len(length)))
    finally:
        np.lexsort = real
    assert sum(widths) < 16 * 3001 + 5000
    paths = [tuple(ids[f : f + n]) for f, n in zip(first, length)]
    want = sorted(range(len(paths)), key=lambda i: (paths[i], i))
    assert order.tolist() == want
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert shared.tolist() == [-1] + [common(paths[a], paths[b]) for a, b in zip(want, want[1:])]
