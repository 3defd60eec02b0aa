import hashlib
import re

import duckdb
import pytest

from salesmill.llm import decontaminate as d
from salesmill.llm.oracle import ORACLE
from tests.llm.conftest import ODD, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected(docs, items):
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for item, other in items:
            w = words(other)
            n = min(10, len(w))
            for run in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else ():
                for i in range(len(own) - n + 1):
                    if tuple(own[i : i + n]) == run:
                        hit |= set(range(i, i + n))
                        found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


PASSAGE = prose(7, 30)
ITEMS = [(1, PASSAGE), (2, "Zwei kurze Wörter"), (10, PASSAGE.upper()), (10, "moon-light"), (3, None), (4, ""), (None, "one")]
DOCS = [
    (1, prose(1, 40) + " " + PASSAGE + "! " + prose(2, 20)), (2, "zwei, kurze WÖRTER zwei kurze wörter"), (3, PASSAGE[: len(PASSAGE) // 2]),
    (4, "moon light MOON"), (5, prose(3, 50)), (6, "one"), (6, "one"), (7, None), (8, "zwei kurze wörter " * 5),
]


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, words string")


def got(df):
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [d.BLOCK, 5])
def test_equals_brute_force(documents, items, block):
    assert got(d.find_contamination(documents(DOCS, extra=True), items(ITEMS), block=block)) == expected(DOCS, ITEMS)


def test_equals_sql(documents, items):
    con = duckdb.connect()
    con.register("documents", documents(DOCS).toArrow())
    con.register("benchmark", items(ITEMS).toArrow())
    found = con.sql(ORACLE["op6_decontaminate"]).fetchall()
    assert sorted(found, key=str) == expected(DOCS, ITEMS)


def test_odd_rows_and_empty_tables(odd, none, items):
    rows = [r[:2] for r in ODD]
    assert got(d.find_contamination(odd, items(ITEMS))) == expected(rows, ITEMS)
    assert got(d.find_contamination(odd, items([]))) == expected(rows, [])
    assert d.find_contamination(none, items(ITEMS)).collect() == []


def test_removes_documents_or_passages(documents, items):
    docs = documents(DOCS, extra=True)
    kept = d.remove_contaminated(docs, items(ITEMS), block=5)
    clean = [r[:2] for r in DOCS if not expected([r], ITEMS)[0][5]]
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)
    cut = d.remove_spans(docs, items([(1, PASSAGE)]))
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert words(texts[1]) == words(prose(1, 40)) + words(prose(2, 20)) and texts[2] == DOCS[1][1] and texts[7] is None


def test_passages_are_cut_the_same_in_any_number_of_blocks(documents, items):
    rows = [(k, prose(20 + k, 15) + " " + PASSAGE[:30 + 9 * k] + " " + prose(40 + k, 15) + " " + PASSAGE) for k in range(9)]
    docs = documents([*rows, *DOCS], extra=True)
    whole, cut = (d.remove_spans(docs, items(ITEMS[:4]), block=b) for b in (d.BLOCK, 3))
    assert cut.columns == docs.columns and cut.schema == docs.schema
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_one_block_at_a_time_and_windows_of_many_items(documents, items, monkeypatch):
    many = [(k, PASSAGE) for k in range(200)] + ITEMS
    held, blocks = [], d._blocks

    def watched(*args):
        for one in blocks(*args):
            held.append((len(held), max(len(x) for x in one.items) if one.items else 0))
            yield one
            scans.append(len(held))

    scans = []
    monkeypatch.setattr(d, "_blocks", watched)
    found = d.find_contamination(documents(DOCS), items(many), block=20)
    assert len(held) > 1 and scans == [k + 1 for k, _ in held] and max(n for _, n in held) == 1
    assert got(found) == expected(DOCS, many)
