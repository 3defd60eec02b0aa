from __future__ import annotations

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that operators use themselves.
CLASHING = (
    "set_id string, n string, bits string, row string, range string, guest string, sketch string, score string, "
    "n_words string, root string, base string, page string, grade string, features string, component_id string"
)


@pytest.fixture
def documents(spark):
    def make(rows, extra: bool = False):
        """Documents from (doc_id, text) or (doc_id, text, lang) rows, with clashing columns if `extra`."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        schema = DOCUMENT
        if extra:
            full = [(*r, *["x"] * 15) for r in full]
            schema += ", " + CLASHING
        return spark.createDataFrame(full, schema)

    return make


WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew potions under pale moonlight near old mills".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "s"]) for _ in range(n))


ODD = [
    (1, prose(1, 60)), (2, None), (3, ""), (4, " \n\t "), (None, prose(4, 40)), (5, prose(1, 60)), (5, prose(1, 60)),
    (6, "é" * 3), (7, "12 34 !!"), (8, prose(8, 40_000)), (9, "x" * 150_000), (10, "one"), (11, None, None), (12, "日本語 のテキスト", None),
]


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, repeated rows, clashing columns."""
    return documents(ODD, extra=True)


@pytest.fixture
def none(documents):
    return documents([], extra=True)
