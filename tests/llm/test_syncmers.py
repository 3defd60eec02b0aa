import hashlib
import re

import pytest
from pyspark.sql import functions as F

from salesmill.llm.syncmers import anchors, fingerprints
from tests.llm.conftest import ODD, prose


def edited(rows):
    """(doc_id, n_chars, sha256 of the edited text), by the definition."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        out.append((doc, len(text), hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest()))
    return sorted(out, key=str)


def numbers(fingerprint):
    written = [int(x) for x in fingerprint.split()]
    assert len(set(written)) == len(written)
    return set(written)


def likeness(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def got(found):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str)


@pytest.mark.parametrize("n, partitions", [(1, 4), (2, 4), (150, 1), (150, 7)])
def test_edits_follow_descending_ids(documents, setting, n, partitions):
    setting("spark.sql.shuffle.partitions", partitions)
    rows = [(k * 37 % 1000, prose(k, 3 + k)) for k in range(n)]
    found = fingerprints(documents(rows, extra=True)).collect()
    assert got(found) == edited(rows)


def test_odd_rows(odd, none):
    rows = [r[:2] for r in ODD]
    found = fingerprints(odd).collect()
    assert got(found) == edited(rows)
    by_text = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    texts = dict((d, t) for d, t in rows)
    for r in found:
        by_text.setdefault(texts[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values()) and by_text[""] == {""}
    assert fingerprints(none).collect() == []


def test_likeness_follows_what_is_shared(documents):
    found = {r.doc_id: r for r in fingerprints(documents([(k, prose(k // 2, 900)) for k in range(8)])).collect()}
    for k, r in found.items():
        assert 0.35 <= r.near_edited <= 0.65 if k % 2 == 0 else r.near_edited > 0.3
        assert r.near_next == 1.0 if k % 2 else r.near_next < 0.3


def test_anchors_are_closed_and_free_of_context(documents):
    passage, other = prose(1, 60), prose(2, 40)
    rows = anchors(documents([(1, passage), (2, other + " " + passage), (3, "a b"), (4, None), (5, "abcdefghij k l m n")], extra=True)).collect()
    at = {}
    for r in rows:
        at.setdefault(r.doc_id, {})[r.position] = r.anchor
    shift = len(re.findall(r"\S{1,8}", other))
    inside = {p - shift: a for p, a in at[2].items() if p >= shift}
    assert inside == at[1] and len(at[1]) > 25
    assert list(at[3]) == [0] and 4 not in at and min(at[5]) >= 0


def test_choice_of_anchors_equals_the_definition(documents, spark):
    text = prose(3, 50)
    words = re.findall(r"\S{1,8}", text)
    pairs = [spark.range(1).select(F.xxhash64(F.xxhash64(F.lit(a)), F.xxhash64(F.lit(b)))).first()[0] for a, b in zip(words, words[1:])]
    expected = [i for i in range(len(words) - 3) if min(pairs[i : i + 3]) in (pairs[i], pairs[i + 2])]
    assert sorted(r.position for r in anchors(documents([(1, text)])).collect()) == expected


def test_no_python_in_the_plan(documents, tmp_path, spark):
    documents([(1, "a b c d e f"), (2, "x")]).write.parquet(str(tmp_path / "docs"))
    plan = fingerprints(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("EvalPython|InArrow|InPandas|PythonUDF|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("passage", [
    "吾輩は猫である名前はまだ無いどこで生れたかとんと見当がつかぬ何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している",
    "ประเทศไทยเป็นประเทศที่ตั้งอยู่ในเอเชียตะวันออกเฉียงใต้มีพรมแดนติดกับลาว",
    "function(a,b){return(a&&b)||document.getElementById('x').innerHTML.split(/,/g)}",
])
def test_unspaced_passages_keep_their_anchors_behind_any_prefix(documents, passage):
    rows = [(k, "甲乙丙丁戊己庚辛"[:k] + passage) for k in range(9)]
    at = {k: {} for k in range(9)}
    for r in anchors(documents(rows)).collect():
        at[r.doc_id][r.position] = r.anchor
    assert len(at[0]) > 20
    for k in range(1, 9):
        assert {p - k: a for p, a in at[k].items() if p >= k} == at[0]


def test_a_short_shared_passage_in_long_texts_shows(documents):
    passage = " ".join(f"q{k}" for k in range(60))
    first, second = (" ".join(f"{c}{k}" for k in range(5000)) for c in "ab")
    rows = [(2, first + " " + passage), (1, second[:7000] + " " + passage + second[7000:])]
    r = {r.doc_id: r for r in fingerprints(documents(rows)).collect()}[2]
    own, other = ({a.anchor: a.position for a in anchors(documents([row])).collect()} for row in rows)
    shared = {p - other[a] for a, p in own.items() if a in other}
    common = len(own.keys() & other.keys())
    assert len(shared) == 1 and common > 25
    assert r.aligned_next == common and r.near_next == common / len(own.keys() | other.keys())
    assert numbers(r.fingerprint) == set(own) and len(own) > 1280


def test_a_word_changed_in_a_long_text_shows(documents):
    words = [f"a{k}" for k in range(6000)]
    rows = [(2, " ".join(words)), (1, " ".join([*words[:3000], "changed", *words[3001:]]))]
    r = {r.doc_id: r for r in fingerprints(documents(rows)).collect()}[2]
    assert 0.99 < r.near_next < 1 and r.aligned_next > 3000


def test_likeness_is_that_of_the_fingerprints(odd, documents):
    """Recomputed from the two strings, for every row of odd, short, long and equal texts."""
    for docs, rows in ((odd, [r[:2] for r in ODD]), (documents([(k, prose(k // 3, 4 * k)) for k in range(60)]), None)):
        found = fingerprints(docs).collect()
        assert all(r.near_edited == likeness(numbers(r.fingerprint), numbers(r.edited_fingerprint)) for r in found)
        if rows is None:
            by_id = {r.doc_id: r for r in found}
            for k, r in by_id.items():
                assert r.near_next == likeness(numbers(r.fingerprint), numbers(by_id[(k - 1) % 60].fingerprint))
            assert any(r.aligned_edited for r in found)


def test_rows_without_id_are_dealt_over_tasks(spark, documents, setting):
    setting("spark.sql.shuffle.partitions", "4")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(None if k % 2 else k, prose(k, 12)) for k in range(400)]
    found = fingerprints(documents(rows)).collect()
    texts = [t for d, t in rows if d is None]
    assert sorted(r.n_chars for r in found) == sorted(len(t) for _, t in rows)
    from salesmill.llm.syncmers import _with_next

    dealt = _with_next(documents(rows))
    sizes = dealt.where("doc_id is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r[1] for r in sizes) < len(texts)
    order = {r.text: r.next_text for r in dealt.collect()}
    assert len(order) == len(rows) and sorted(order.values()) == sorted(order)  # one ring through all rows


def test_neighbours_do_not_depend_on_the_order_of_rows(spark, setting):
    """Rows come in another order whenever the table is read, as from several machines; enough for inexact quantiles."""

    def in_another_order(frames):
        import os

        for f in frames:
            yield f.sample(frac=1, random_state=int.from_bytes(os.urandom(4), "big"))

    setting("spark.sql.shuffle.partitions", 8)
    setting("spark.sql.execution.arrow.maxRecordsPerBatch", 1_000_000)
    made = spark.range(0, 240_000, 1, 2).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("doc_id"), F.concat(F.lit("abc def "), "id").alias("text"))
    rows = [tuple(r) for r in made.collect()]
    docs = made.mapInPandas(in_another_order, made.schema)
    assert got(fingerprints(docs).select("doc_id", "n_chars", "edited_sha256").collect()) == edited(rows)
