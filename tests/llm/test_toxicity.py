import math
import re

import numpy as np
import pyarrow as pa
import pytest

from salesmill.llm import toxicity as t
from tests.llm.conftest import ODD, prose


def examples():
    rows, grades = [], []
    for k in range(240):
        grade = (0, 0, 0, 1, 2)[k % 5]
        bad = {0: [], 1: ["nasty"], 2: ["nasty", "vileness", "vilely"]}[grade]
        rows.append((k, prose(k, 30) + " " + " ".join(bad)))
        grades.append((k, grade))
    return rows, grades


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, grade int")


def test_learns_ordered_grades(documents, labels):
    rows, grades = examples()
    model = t.fit(documents(rows), labels([*grades, (0, None), (None, 2), (3, 0)]))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    new = [(1, "what a nasty thing"), (2, "nasty vileness"), (3, "a lazy dog"), (4, "NASTY, vilely!"), (5, None), (6, prose(9, 5000))]
    found = {r.doc_id: r for r in t.predict(documents(new, extra=True), model).collect()}
    assert {k: r.toxic for k, r in found.items()} == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False}
    assert found[3].severity < 0.3 < 0.6 < found[1].severity < found[2].severity <= 2
    for r in found.values():
        assert r.chances[0] >= r.chances[1] and abs(sum(r.chances) - r.severity) < 1e-12


def test_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(1)
    n, width = 60, 5
    owner, columns = np.repeat(np.arange(n), 2), rng.integers(0, width, 2 * n)
    grades = rng.integers(0, 3, n)
    weights, thresholds = t._train(owner, columns, grades, width, 2)

    def loss(w, th):
        score = np.bincount(owner, w[columns], minlength=n)
        full = np.concatenate([np.ones((n, 1)), 1 / (1 + np.exp(-(score[:, None] - th))), np.zeros((n, 1))], axis=1)
        return -np.log(full[np.arange(n), grades] - full[np.arange(n), grades + 1]).mean() + t.DECAY / 20 * (w**2).sum()

    best = loss(weights, thresholds)
    for _ in range(30):
        assert loss(weights + rng.normal(0, 0.2, width), thresholds) > best - 1e-4
        assert loss(weights, np.sort(thresholds + rng.normal(0, 0.2, 2))) > best - 1e-4


def strings(text):
    words = {w.lower() for w in re.findall(r"[^\W_]+", text or "")}
    return words | {(n, w[:n]) for w in words for n in t.LEADS if len(w) > n}


def test_features_and_severity_by_brute_force(documents, labels):
    rows, grades = examples()
    rows = [(d, x + (" kindly" if g == 0 and d % 2 else "")) for (d, x), (_, g) in zip(rows, grades)]
    model = t.fit(documents(rows), labels(grades))
    graded, clean = sum(g > 0 for _, g in grades), sum(g == 0 for _, g in grades)
    counts = {}
    for (_, text), (_, g) in zip(rows, grades):
        for f in strings(text):
            counts.setdefault(f, [0, 0])[g > 0] += 1
    chosen, share = set(), graded / (graded + clean)
    for f, (good, bad) in counts.items():
        toxic = bad >= t.LEAST_SHARE * graded and bad * clean >= t.LEAST_RATIO * graded * good
        kind = good >= t.LEAST_SHARE * clean and good * graded >= t.LEAST_RATIO * clean * bad
        each = [n * math.log(n / ((good + bad) * p)) for n, p in ((bad, share), (good, 1 - share)) if n]
        if (toxic or kind) and 2 * sum(each) >= t.LEAST_EVIDENCE:
            chosen.add(f)
    assert len(model.features) == len(chosen) and {"nasty", "vileness", "kindly"} <= chosen and "dog" not in chosen
    (kind, *_), _ = t.features(pa.array(["kin"]))  # the word alone; "kindly" has it as a beginning, another feature
    assert kind not in model.features
    both, _ = t.features(pa.array(["kindly"]))
    assert (model.weights[np.isin(model.features, both)] < 0).all() and np.isin(both, model.features).sum() == len(strings("kindly"))
    for text in ("nasty dog", "vilely nasty", "kindly", "", prose(3, 200)):
        owner, at = t.known_features(pa.array([text]), model.features)
        assert len(at) == len(strings(text) & chosen)
        (r,) = t.predict(documents([(1, text)]), model).collect()
        chances = [1 / (1 + math.exp(-(model.weights[at].sum() - x))) for x in model.thresholds]
        assert np.allclose(r.chances, chances) and math.isclose(r.severity, sum(chances), abs_tol=1e-9)


def test_nothing_to_learn(documents, labels, odd, none):
    for docs, rows in ((odd, []), (none, [(1, 1)]), (odd, [(1, 0), (5, 0)]), (odd, [(10, 1)])):
        found = t.predict(odd, t.fit(docs, labels(rows))).collect()
        assert len(found) == len(ODD) and not any(r.toxic for r in found)
    rows, grades = examples()
    model = t.fit(documents(rows), labels(grades), fit_rows=100)
    assert t.predict(none, model).collect() == [] and len(t.predict(odd, model).collect()) == len(ODD)


def test_features_are_words_and_their_first_letters():
    found, cut = t.features(pa.array(["Nasty nasty dog", None, "nast"]))
    assert cut.tolist() == [0, len(found) - 2, len(found) - 2, len(found)]
    assert len(set(found[: cut[1]].tolist())) == cut[1] == 2 + 2 + 0  # nasty, dog, nas*, nast*


def test_held_out_documents(spark):
    docs, labels_ = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    known = labels_.selectExpr("doc_id", "toxic AS grade")
    model = t.fit(docs, known.where("doc_id % 4 <> 0"))
    assert len(model.thresholds) == 1
    found = t.predict(docs.where("doc_id % 4 = 0"), model).join(known, "doc_id").groupBy("grade", "toxic").count().collect()
    n = {(r.grade, r.toxic): r["count"] for r in found}
    assert n[1, True] >= 0.88 * (n[1, True] + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.01 * n[0, False]
