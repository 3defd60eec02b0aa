"""Rendezvous shards against a plain version, few moves, weights, hot copies, odd rows."""

import hashlib
import math
import zlib
from collections import Counter

import pytest

from salesmill.llm import sharding
from salesmill.llm.sharding import SHARDS, moves, place, slots, write_shards
from salesmill.session import scratch_path
from tests.llm.conftest import ODD, prose


def number(key: str, shard: int) -> float:
    return (int(hashlib.md5(f"{key}/{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def home(key: str, weights: dict) -> int:
    return max(weights, key=lambda s: (weights[s] / -math.log(number(key, s)), -s))


def brute_force(rows, weights=SHARDS, new=16):
    placed = []
    for doc, text in rows:
        key, data = "" if doc is None else str(doc), (text or "").encode()
        shard, size, crc = home(key, weights), len(data) + 1, zlib.crc32(data)
        order = hashlib.md5(f"{key}/{size}/{crc}/0".encode()).hexdigest()
        placed.append((shard, order, doc, size, crc, home(key, {**weights, new: 1.0})))
    out, seen = [], Counter()
    for shard, _, doc, size, crc, grown in sorted(placed, key=lambda p: p[:2]):
        out.append((doc, size, crc, "key", shard, seen[shard], grown))
        seen[shard] += 1
    return out


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def test_slots_are_those_of_a_plain_version(documents):
    rows = [(i * 7, prose(i, 1 + i % 50)) for i in range(400)]
    assert found(slots(documents(rows))) == sorted(brute_force(rows), key=str)


def test_odd_rows(odd, none):
    assert found(slots(odd)) == sorted(brute_force([r[:2] for r in ODD]), key=str)
    assert slots(none).collect() == []


def test_ranges_do_not_change_slots(documents, setting):
    rows = [(i, "x") for i in range(300)]
    few = found(slots(documents(rows)))
    setting("spark.sql.shuffle.partitions", "70")
    assert found(slots(documents(rows))) == few


def test_copies_of_one_row_have_slots_of_their_own(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 10)
    rows = [(5, "ok")] * 95 + [(i, "text") for i in range(200)]
    got = found(slots(documents(rows)))
    assert Counter((r[0], r[4]) for r in got)[(5, home("5", SHARDS))] == 96 - (0 if rows.count((5, "text")) else 1)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r[4], []).append(r[5])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    own = [r[5] for r in got if r[0] == 5 and r[1] == 3]
    assert max(own) - min(own) > 94  # not one block: they stand in several places of the order


def test_a_new_shard_only_takes(documents):
    docs = documents([(i, "") for i in range(2000)])
    got = moves(docs, SHARDS, {**SHARDS, 16: 1.0}).collect()
    assert all(r.new_shard in (r.shard, 16) for r in got)
    moved = sum(r.n_rows for r in got if r.new_shard == 16)
    assert 60 < moved < 180  # 2000 / 17 = 118 expected
    gone = moves(docs, SHARDS, {s: w for s, w in SHARDS.items() if s != 3}).collect()
    assert all(r.shard == r.new_shard or r.shard == 3 for r in gone)


def test_weights_share_the_keys_and_a_change_moves_few(documents):
    docs = documents([(i, "") for i in range(3000)])
    weights = {0: 1.0, 1: 2.0, 5: 3.0}
    n = Counter(r.shard for r in place(docs, weights).collect())
    assert all(abs(n[s] / 3000 - w / 6) < 0.04 for s, w in weights.items())
    got = moves(docs, weights, {0: 1.0, 1: 2.5, 5: 3.0}).collect()
    assert all(r.shard == r.new_shard or r.new_shard == 1 for r in got)
    with pytest.raises(ValueError, match="above 0"):
        place(docs, {0: 0.0})


def test_written_shards_hold_every_text_in_slot_order(spark, odd, documents):
    path = scratch_path(spark, "shards")
    manifest = {r.shard: (r.n_rows, r.n_bytes) for r in write_shards(odd, path).collect()}
    want = brute_force([r[:2] for r in ODD])
    assert manifest == {s: (sum(r[4] == s for r in want), sum(r[1] for r in want if r[4] == s)) for s in {r[4] for r in want}}
    back = spark.read.parquet(path)
    assert sorted(str((r.doc_id, r.text, r.n)) for r in back.collect()) == sorted(str((*r[:2], "x")) for r in ODD)


def test_other_key_types(spark):
    texts = spark.createDataFrame([("a", "x"), (None, "y"), ("", "z")], "doc_id string, text string")
    assert found(slots(texts)) == sorted(brute_force([("a", "x"), (None, "y"), ("", "z")]), key=str)
