import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from salesmill.llm import lm
from tests.llm.conftest import ODD, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def base(training, texts):
    c = collections.Counter(t for text in training for t in tokens(text))
    n, v = sum(c.values()), len(c)
    for text in texts:
        own = tokens(text)
        yield len(own), sum(c[t] > 0 for t in own), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own)


TRAINING = [(k, prose(k, 5 + k)) for k in range(60)] + [(60, None), (61, ""), (61, "")]
NEW = [(100, prose(500, 40)), (101, "never seen words the fox"), (102, None), (103, "fox"), (103, "fox"), (None, "THE Fox")]


@pytest.mark.parametrize("table", [lm.TABLE, 10])
def test_base_scores_equal_brute_force(documents, monkeypatch, table):
    monkeypatch.setattr(lm, "TABLE", table)
    model, counts = lm.fit(documents(TRAINING, extra=True))
    found = lm.score(documents(NEW, extra=True), model, counts).collect()
    expected = [(d, *b) for (d, _), b in zip(NEW, base([t for _, t in TRAINING], [t for _, t in NEW]))]
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=str)
    for g, e in zip(got, sorted(expected, key=str)):
        assert g[:4] == e[:4] and abs(g[4] - e[4]) < 1e-9 * max(1, abs(e[4]))
    assert all(r.score < 0 for r in found)


def test_probabilities_sum_to_one(documents):
    model, counts = lm.fit(documents(TRAINING))
    classes = 10.0 ** model.log_probabilities().astype(float)
    np.testing.assert_allclose(classes.sum(axis=1), 1, atol=1e-4)
    # Inside a class: all its words and one share for those never seen.
    rows = counts.select("word", "shape", "times").toPandas()
    own = model.classes.of(rows["word"].to_numpy().view(np.uint64), rows["shape"].to_numpy())
    for c in np.unique(own):
        share = (rows["times"].to_numpy()[own == c] + 1).sum() + 1
        assert abs(share / 10 ** model.class_total[c] - 1) < 1e-9


def test_training_beats_class_frequencies():
    rng = np.random.default_rng(3)
    cells = np.zeros(((lm.CLASSES + 1) ** 2, lm.CLASSES), np.int64)
    for last in range(20):  # the next class is mostly last + 1
        for before in range(20):
            cells[before * (lm.CLASSES + 1) + last, (last + 1) % 20] = 50
            cells[before * (lm.CLASSES + 1) + last, rng.integers(0, 20)] += 5
    params = lm.train(cells.ravel(), steps=400)
    model = lm.Model(None, *params, None, None, None, 0, 0)
    log = model.log_probabilities()
    frequency = cells.sum(axis=0) / cells.sum()
    plain = (cells * np.log10(np.maximum(frequency, 1e-12))).sum()
    assert (cells * log).sum() > 0.5 * plain


def test_contexts_begin_anew_with_each_text():
    classes, ptr = np.array([3, 4, 5, 6, 7]), np.array([0, 3, 4, 5])
    row = lambda a, b: a * (lm.CLASSES + 1) + b
    s = lm.CLASSES
    assert lm._contexts(classes, ptr).tolist() == [row(s, s), row(s, 3), row(3, 4), row(s, s), row(s, s)]
    hashes, shapes, cut = lm._tokens(pa.array(["a bc", ""]))
    assert cut.tolist() == [0, 3, 4] and hashes[2] == hashes[3] == lm.END and shapes.tolist() == [97, 99 + 256 * 98, 0, 0]


def test_odd_rows_and_empty_tables(odd, none):
    model, counts = lm.fit(odd)
    found = lm.score(odd, model, counts).collect()
    assert len(found) == len(ODD) and all(math.isfinite(r.score) for r in found)
    assert lm.score(none, model, counts).collect() == []
    model, counts = lm.fit(none)
    found = lm.score(odd, model, counts).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in found} == {(0, 0, 0.0, 0.0)} and len(found) == len(ODD)


def test_held_out_texts_are_likelier_than_by_frequency(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, counts = lm.fit(docs.where("doc_id % 7 <> 2"))
    total = lm.score(docs.where("doc_id % 7 = 2"), model, counts).agg({"score": "sum", "base_score": "sum"}).first()
    assert total["sum(score)"] > 0.97 * total["sum(base_score)"]


def test_classes_and_cells_grow_with_the_vocabulary(documents):
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(f"w{int(x)}" for x in rng.integers(0, 20_000, 400))) for k in range(200)]
    model, _ = lm.fit(documents(rows))
    assert model.vocabulary > 15_000 and model.classes.size == lm.class_count(model.vocabulary) > lm.CLASSES
    assert len(model.classes.words) == model.classes.size // 2 and len(model.target) == model.classes.size
    assert lm.class_count(10**7) > 2 * lm.class_count(10**6) > 4 * lm.class_count(10**5)


def test_training_reads_every_cell_by_its_count(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "BATCH", 64)
    learn = lm._sums
    monkeypatch.setattr(lm, "_sums", lambda at, values, n: seen.append(at) or learn(at, values, n))
    cells, times = np.arange(1000) * 131, np.arange(1000) % 90 + 1
    state = lm._begin(np.ones(lm.CLASSES), 1)
    lm._learn(state, np.full(lm.CLASSES, 1 / lm.CLASSES), cells, times, times.mean(), 1, 0.1, np.random.default_rng(1))
    wanted = np.concatenate([s[: -lm.NOISE] for s in seen[::3]])
    assert len(wanted) == np.ceil(times / times.mean()).sum() and set(wanted) == set(cells % lm.CLASSES)


def test_tasks_learn_what_one_process_learns(spark):
    n = lm.CLASSES
    cells = np.zeros(((n + 1) ** 2, n), np.int64)
    for last in range(20):
        for before in range(20):
            cells[before * (n + 1) + last, (last + 1) % 20] = 50
    used = np.flatnonzero(cells)
    rows = spark.createDataFrame([(int(c), int(cells.ravel()[c])) for c in used], "cell long, times long").repartition(4)
    params = lm.train_in_tasks(rows, cells.sum(axis=0), steps=400)
    log = lm.Model(None, *params, None, None, None, 0, 0).log_probabilities()
    frequency = cells.sum(axis=0) / cells.sum()
    assert (cells * log).sum() > 0.5 * (cells * np.log10(np.maximum(frequency, 1e-12))).sum()


def test_scores_equal_brute_force(documents, monkeypatch):
    """score is the sum over tokens of log10 of the class's normalised probability and the word's share in it."""
    monkeypatch.setattr(lm, "TABLE", 20)
    model, counts = lm.fit(documents(TRAINING))
    kept = {r.word: r.times for r in counts.collect()}
    n = model.classes.size

    def text_score(text):
        hashes, shapes, _ = lm._tokens(pa.array([text or ""]))
        own = model.classes.of(hashes, shapes).tolist()
        total, history = 0.0, [n, n]
        for c, h in zip(own, hashes.view(np.int64).tolist()):
            r = model.context[history[0]].astype(float) @ model.first + model.context[history[1]].astype(float) @ model.second
            scores = model.target.astype(float) @ r + model.bias
            total += (scores[c] - np.log(np.exp(scores).sum())) / math.log(10)
            total += math.log10(kept.get(h, 0) + 1) - model.class_total[c]
            history = [history[1], c]
        return total

    found = {r.doc_id: r.score for r in lm.score(documents(NEW), model, counts).collect()}
    assert all(abs(found[d] - text_score(t)) < 1e-3 * max(1, abs(found[d])) for d, t in NEW)


def test_norms_do_not_depend_on_the_table(documents):
    model, _ = lm.fit(documents(TRAINING))
    n = model.classes.size + 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n), indexing="ij"))
    want = model.log_norms()[i, j]
    small = lm.Norms(model, 16)
    for _ in range(2):
        np.testing.assert_allclose(lm.Norms(model).of(i, j), want, atol=1e-4)
        np.testing.assert_allclose(small.of(i, j), want, atol=1e-4)


def test_the_model_is_the_same_for_any_number_of_partitions(spark, documents, setting, monkeypatch):
    monkeypatch.setattr(lm, "HELD", 500)
    found = []
    for parts in ("2", "7"):
        setting("spark.sql.shuffle.partitions", parts)
        model, counts = lm.fit(documents(TRAINING).repartition(int(parts)))
        found.append({r.doc_id: r.score for r in lm.score(documents(NEW), model, counts).collect()})
    assert found[0] == found[1]


def test_places_are_those_of_a_binary_search():
    from salesmill.llm.lm import Places

    rng = np.random.default_rng(4)
    top = np.uint64(2**64 - 1)
    for n in (0, 1, 2, 5_000):
        hashes = np.unique(np.r_[rng.integers(0, 1 << 63, n, np.uint64) << np.uint64(1), rng.integers(0, 300, n // 2, np.uint64)])
        for table in (hashes, np.append(hashes, top)):
            wanted = np.r_[table, rng.integers(0, 1 << 63, 999, np.uint64), np.uint64(0), np.uint64(7), top]
            assert (Places(table).of(wanted) == np.searchsorted(table, wanted)).all()


def test_norms_are_kept_and_found_again():
    from salesmill.llm.lm import Norms

    rng = np.random.default_rng(6)
    n = 30
    state = lm._begin(np.full(n, 5.0), 1)
    model = lm.Model(lm.Classes(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << 16, np.int64), n), *state[:5],
                     np.zeros(n), np.zeros(0, np.uint64), np.zeros(0, np.int64), 1, 1)
    few, want = Norms(model, slots=64), model.log_norms()
    for _ in range(4):
        i, j = rng.integers(0, n + 1, 500), rng.integers(0, n + 1, 500)
        assert np.allclose(few.of(i, j), want[i, j], atol=1e-4)
    held = np.flatnonzero(few.key >= 0)
    i, j = np.divmod(few.key[held], n + 1)
    few.target = None  # what is kept is not computed again
    assert np.allclose(few.of(i, j), want[i, j], atol=1e-4)


def test_words_of_large_batches_are_found_in_slices(monkeypatch):
    from salesmill.llm import text

    monkeypatch.setattr(text, "_powers", {})
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[i % 7 :: 1 + i % 5]) for i in range(2_500)]
    classes = lm.Classes(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.arange(1 << 16) % 40, 40)
    found, times = lm._cells(pa.record_batch({"text": texts}), classes)
    assert sum(map(len, texts)) > 3 * text.SLICE_BYTES and len(text._powers["up"]) <= text.SLICE_BYTES + 1
    hashes, shapes, ptr = lm._tokens(pa.array(texts))
    own = classes.of(hashes, shapes)
    want = np.unique(lm._contexts(own, ptr, 40) * 40 + own, return_counts=True)
    assert (found == want[0]).all() and (times == want[1]).all() and times.sum() == len(hashes)
