"""Token alignment against a plain version with the tokenizers' own libraries; the products against dense ones."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from salesmill.llm import alignment
from salesmill.llm.alignment import BYTE_VOCABULARY, PIECE_MODEL, Csr, aligned_documents, groups_of, overlap_links
from tests.llm.conftest import ODD, prose

A, B = public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_MODEL)


def shown_bytes():
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute_force(rows) -> list[tuple]:
    """Counts by loops over token occurrences."""
    byte_of, tokenizer = shown_bytes(), Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        name = model.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if len(name) == 6 and name.startswith("<0x") else name.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc, text in rows:
        groups = []
        if text:
            ids_a, ids_b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
            bytes_a = [bytes(byte_of[c] for c in tokenizer.id_to_token(i)) for i in ids_a]
            bytes_b = [piece(i) for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
                x = y = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    to_x, to_y = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
                    groups.append((ids_a[x:to_x], ids_b[y:to_y]))
                    x, y = to_x, to_y
        links = Counter((a, b) for x, y in groups for a in x for b in y)
        counts.update(links.keys())
        docs.append((doc, groups, links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for doc, groups, links in docs:
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for (a, b), n in links.items() if counts[a, b] == best[a]), sum(n * counts[p] for p, n in links.items()),
            hashlib.sha256(line.encode()).hexdigest() if line else "",
        ))
    return sorted(out, key=str)


TEXTS = [
    "Hello world, it's 12345 tests.", "  two  spaces\tand\nlines\r\n\r\nmore ", "日本語のテキスト、漢字", "naïve café Ünïcödé — “quotes”", "😀😃 emoji 👩‍👩‍👧",
    "hello <|endoftext|> world", "<s> not special </s> <unk>", "ﬁ ligature ① ½", "a" * 700, "x▁y", "don't we'll I'VE", " nbsp　wide", "0",
    " leading", "tab\t", "Ελληνικά και Русский текст",
]


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def test_against_a_plain_version(documents):
    rows = list(enumerate(TEXTS)) + [(100 + i, prose(i, 80)) for i in range(60)]
    assert found(aligned_documents(documents(rows))) == brute_force(rows)


def test_many_blocks_give_the_same(documents, monkeypatch):
    rows = [(i, prose(i % 7, 30 + i)) for i in range(80)] + list(enumerate(TEXTS, 1000))
    whole = found(aligned_documents(documents(rows)))
    assert whole == brute_force(rows)
    seen = alignment.EXPANDED
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 200)
    assert found(aligned_documents(documents(rows))) == whole and seen == alignment.EXPANDED


def test_odd_rows(odd, none):
    assert found(aligned_documents(odd)) == brute_force([r[:2] for r in ODD])
    assert aligned_documents(none).collect() == []


@pytest.mark.parametrize("kind", ["string", "smallint", "decimal(12,2)", "int"])
def test_any_type_of_doc_id(spark, kind):
    docs = spark.createDataFrame([("7", "one text"), ("8", None)], "doc_id string, text string")
    got = aligned_documents(docs.selectExpr(f"cast(doc_id as {kind}) doc_id", "text"))
    assert dict(got.dtypes)["doc_id"] == kind and len(got.collect()) == 2


def test_products_are_those_of_dense_matrices():
    rng = np.random.default_rng(1)
    for _ in range(20):
        left, right = rng.integers(0, 3, (6, 9)) * (rng.random((6, 9)) < 0.4), rng.integers(0, 3, (9, 5)) * (rng.random((9, 5)) < 0.4)

        def sparse(m):
            r, c = np.nonzero(m)
            return Csr.of(r, c, m[r, c].astype(np.int64), m.shape)

        got = sparse(left).times(sparse(right))
        dense = np.zeros((6, 5), np.int64)
        dense[got.owner(), got.columns] = got.values
        assert (dense == left @ right).all()
        back = sparse(left).transposed()
        again = np.zeros((9, 6), np.int64)
        again[back.owner(), back.columns] = back.values
        assert (again == left.T).all()
        for most in (1, 3):
            parts = list(sparse(left).expanded(sparse(right), most))
            total = np.zeros((6, 5), np.int64)
            for r, c, v in parts:
                np.add.at(total, (r, c), v)
            assert (total == left @ right).all()


def test_overlaps_and_groups_by_hand(monkeypatch):
    a, b = np.array([2, 5, 6, 9]), np.array([3, 5, 7, 8, 9])
    for most in (1 << 21, 2):
        monkeypatch.setattr(Csr.expanded, "__defaults__", (most,))
        links = list(zip(*(x.tolist() for x in overlap_links(a, b))))
        assert links == [(0, 0, 2), (1, 0, 1), (1, 1, 2), (2, 2, 1), (3, 2, 1), (3, 3, 1), (3, 4, 1)]
        assert [g.tolist() for g in groups_of(a, b)] == [[0, 0, 1, 1], [0, 0, 1, 1, 1]]


def test_ids_of_texts_with_special_names():
    from salesmill.llm.tokens import encoder

    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext", "|> b <|endoftext|><|endoftext|>'s é", None, "plain"]
    for special in (True, False):
        tokenizer = Tokenizer.from_file(A)
        tokenizer.encode_special_tokens = not special
        ids, cut = encoder().encode(pa.array(texts), special)
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[x:y].tolist() for x, y in zip(cut, cut[1:])] == want
