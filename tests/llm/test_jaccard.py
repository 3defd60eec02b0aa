import random
import re

import duckdb
import numpy as np
import pytest

from salesmill.llm.jaccard import keep_one, similar_documents
from salesmill.llm.oracle import ORACLE
from salesmill.llm.sigtree import alike, bitmap, candidates, few_candidates
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(rows):
    """Smallest reachable doc_id of each row, every pair compared."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def family(seed, size, words, edits):
    """Near copies of one text, some of them further apart than the bound."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(9999)}"
        out.append(" ".join(copy))
    return out


def corpus():
    texts = [t for k in range(6) for t in family(k, 12, 60 + 30 * k, 3 + 2 * k)]
    passage = prose(99, 50)
    texts += [prose(200 + k, 20 + k) + " " + passage for k in range(25)]  # share a passage, are not alike
    texts += ["a b", "A  b", "a b c", "", None, "x y z v w", "x y z v w", prose(0, 60)]
    return [(1000 - i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("page, least_hot", [(1000, 8), (7, 2)])
def test_equals_comparing_all_pairs(documents, page, least_hot):
    rows = corpus()
    found = similar_documents(documents(rows), page=page, least_hot=least_hot)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()]
    assert sorted(got) == sorted(components(rows))


def test_odd_rows(odd):
    from tests.llm.conftest import ODD

    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(odd).collect()]
    expected = components([r[:2] for r in ODD])
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_sql_equals_comparing_all_pairs(documents):
    rows = corpus() + [(7, prose(500, 30)), (None, prose(500, 30)), (None, prose(501, 30)), (8, " \t"), (9, "\u00e9 \u3000")]
    con = duckdb.connect()
    con.register("documents", documents(rows).toArrow())
    found = con.sql(ORACLE["op7_jaccard_join"]).fetchall()
    assert sorted(found, key=str) == sorted(components(rows), key=str)


def test_empty_table(none):
    assert similar_documents(none).collect() == []


def test_one_document_of_each_group_stays(documents):
    rows = corpus() + [(77, prose(500, 30)), (77, prose(500, 30)), (3, ""), (None, prose(501, 30)), (None, prose(501, 30))]
    kept = keep_one(documents(rows, extra=True))
    assert kept.columns == documents(rows, extra=True).columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    groups = {}
    for (doc, text), (_, n, component) in zip(rows, components(rows)):
        groups.setdefault((component, text if component is None else None) if n else (doc, text, len(groups)), []).append((doc, text))
    assert got == sorted((min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()), key=str)


def sets_of(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        base = rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64)
        for _ in range(rng.integers(1, 8)):
            copy = base.copy()
            lost = rng.integers(0, len(copy) // 4 + 1)
            copy[:lost] = rng.integers(0, 1 << 63, lost).astype(np.uint64)
            out.append(np.unique(copy))
    return out[:n]


def test_trees_miss_no_pair_and_a_forest_connects_as_much():
    sets = sets_of(300, 3)
    sizes = np.array([len(s) for s in sets])
    key = np.arange(len(sets))
    bits = [bitmap(s) for s in sets]
    real = {(i, j) for j in range(len(sets)) for i in range(j) if alike(sets[i], sets[j], 75)}
    found = candidates(bits, sizes, key, 75)
    assert real <= {tuple(sorted(p)) for p in found}
    assert len(found) == len({tuple(sorted(p)) for p in found}) < 4 * len(real) + 50
    assert {tuple(sorted(p)) for p in few_candidates(bits, sizes.tolist(), 75, key.tolist())} == {tuple(sorted(p)) for p in found}
    forest = few_candidates(bits, sizes.tolist(), 75, key.tolist(), spanning=True)
    assert len(forest) == len(candidates(bits, sizes, key, 75, spanning=True))
    forest = candidates(bits, sizes, key, 75, spanning=True)
    assert len(forest) < len(sets)
    known = np.where(key < 150, 0, key)
    apart = {tuple(sorted(p)) for p in candidates(bits, sizes, key, 75, groups=known)}
    assert {p for p in real if known[p[0]] != known[p[1]]} <= apart
    assert not any(known[i] == known[j] for i, j in apart)


def test_copies_of_a_short_text_are_one_row_of_a_task(spark, documents):
    from salesmill.llm import jaccard

    rows = [(k, "ok") for k in range(5000)] + [(9000 + k, prose(k, 30)) for k in range(20)]
    docs = documents(rows).repartition(4)
    sent = jaccard._prefixes(docs, "text", np.zeros(0, np.uint64), 8, 75)
    key = sent.groupBy("shingle").count().agg({"count": "max"}).first()[0]
    assert key <= 4
    found = {r.doc_id: r.component_id for r in jaccard.similar_documents(docs).collect()}
    assert all(found[k] == 0 for k in range(5000)) and all(found[9000 + k] == 9000 + k for k in range(20))


def test_frequent_shingles_are_cut_from_the_texts_once(documents):
    """Left in the plan are the pass over the texts for rare shingles and the grouping of these."""
    from salesmill.llm import jaccard

    docs = documents([(k, prose(k // 2, 40)) for k in range(20)])
    blocks = jaccard._blocks(jaccard._prefixes(docs, "text", np.zeros(0, np.uint64), 8, 75), 75)
    assert blocks._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
