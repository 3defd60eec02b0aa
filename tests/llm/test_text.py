import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from salesmill.llm.text import NOT_SPACE, WORD, byte_slices, find_words, windows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbZ9 .\t\n\x0bé日'-_"), max_size=30)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    for table, pattern in ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = find_words(pa.array(texts, pa.string()), table)
        found = [[words.word(j).decode() for j in range(a, b)] for a, b in zip(words.ptr, words.ptr[1:])]
        assert found == [re.findall(pattern, (t or "").translate(LOWER)) for t in texts]
        flat, hashes = [w for t in found for w in t], words.hashes()
        assert len(set(flat)) == len(set(hashes.tolist()))
        assert len(set(zip(flat, hashes.tolist()))) == len(set(flat))


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_windows_stay_inside_a_text(texts, size):
    words = find_words(pa.array(texts, pa.string()), NOT_SPACE)
    at, value = windows(words.hashes(), words.ptr, size)
    expected = [j for a, b in zip(words.ptr, words.ptr[1:]) for j in range(a, b - size + 1)]
    assert at.tolist() == expected
    runs = [tuple(words.word(j + k) for k in range(size)) for j in expected]
    assert len(set(runs)) == len(set(value.tolist()))


def test_slices_cover_a_batch_and_keep_long_texts_whole():
    batch = pa.record_batch({"id": pa.array(range(6)), "text": pa.array(["a" * 50, None, "", "b" * 500, "c", "d" * 90])})
    parts = list(byte_slices(batch.slice(1), "text", limit=100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == [1, 2, 3, 4, 5]
    assert max(p.num_rows for p in parts) < 5
    assert list(byte_slices(batch.slice(0, 0), "text")) == []


def test_equal_words_hash_alike_at_any_place():
    words = find_words(pa.array(["Alpha beta", "x " * 1000 + "alpha", "beta"]), NOT_SPACE)
    hashes = words.hashes()
    assert hashes[0] == hashes[words.ptr[2] - 1] and hashes[1] == hashes[-1]
    assert len(np.unique(hashes)) == 3
