import pyarrow as pa
import numpy as np

from salesmill.llm.langid import MAX_LANGS, fit, grams, identify, keep_identified
from tests.llm.conftest import ODD

SAMPLES = {
    "en": "the house of the river and that they were with which there from this",
    "de": "das haus an dem fluss und dass sie mit welchen dort von diesem nicht",
    "fr": "la maison de la rivière et que ils étaient avec lesquels là depuis",
}


def rows():
    out, k = [], 0
    for lang, text in SAMPLES.items():
        words = text.split()
        for i in range(30):
            out.append((k, " ".join(words[(i * 5 + j * 3) % len(words)] for j in range(8)), lang))
            k += 1
    return out


def test_learns_languages_and_their_share(documents):
    model = fit(documents(rows()).select("doc_id", "text", "lang"))
    assert model.langs == ["de", "en", "fr"]
    np.testing.assert_allclose(np.exp(model.prior), 1 / 3)
    np.testing.assert_allclose(np.exp(model.table.astype(float)).sum(axis=0), 1, rtol=1e-3)
    found = identify(documents([(1, "THE house, and that river!"), (2, "und das nicht"), (3, "avec la rivière")]), model)
    assert [(r.lang_pred, r.score > 0.9) for r in found.orderBy("doc_id").collect()] == [("en", True), ("de", True), ("fr", True)]


def test_held_out_accuracy(documents, spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit(table.where("doc_id % 4 <> 0").select("doc_id", "text", "lang"), fit_rows=300)
    found = identify(table.where("doc_id % 4 = 0"), model).join(table.select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred = lang").count() >= 0.97 * found.count()


def test_texts_without_a_letter_are_undetermined(odd):
    model = fit(odd.limit(0).select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang")))
    found = identify(odd, model).collect()
    assert len(found) == len(ODD)
    letters = {True: 0, False: 0}
    for r in found:
        letters[r.lang_pred == "und"] += 1
        assert (r.lang_pred == "und") == (r.score == 0.0) and 0 <= r.score <= 1
    assert letters[True] == sum(not any(c.isalpha() for c in t or "") for _, t, *_ in ODD)
    kept = keep_identified(odd, model)
    assert kept.columns == odd.columns and kept.count() == letters[False]


def test_no_labels_and_no_rows(none, odd):
    model = fit(none.select("doc_id", "text", "lang"))
    assert model.langs == []
    assert {r.lang_pred for r in identify(odd, model).collect()} == {"und"}
    assert identify(none, model).collect() == [] and MAX_LANGS > 0


def test_grams_stay_inside_a_text():
    one, owner, _ = grams(pa.array(["ab", "cd"]))
    alone = [set(grams(pa.array([t]))[0].tolist()) for t in ("ab", "cd")]
    assert [set(one[owner == i].tolist()) for i in (0, 1)] == alone


def test_predictions_by_brute_force(documents):
    """Naive Bayes over hashed n-grams, counted and scored text by text."""
    import math
    from collections import Counter

    from salesmill.llm.langid import BUCKETS, SMOOTHING

    def buckets(text):
        return Counter(grams(pa.array([text]))[0].tolist())

    train = rows()[:-12]  # the languages are not equally frequent
    counts, texts = {}, Counter()
    for _, text, lang in train:
        counts.setdefault(lang, Counter()).update(buckets(text))
        texts[lang] += 1
    asked = [(k, text[: 3 + k % 20]) for k, text, _ in rows()] + [(500, "la dem of"), (501, "x")]
    model = fit(documents(train).select("doc_id", "text", "lang"))
    found = {r.doc_id: r for r in identify(documents(asked), model).collect()}
    for k, text in asked:
        logs = {
            lang: math.log(texts[lang] / len(train))
            + sum(n * math.log((c[b] + SMOOTHING) / (c.total() + SMOOTHING * BUCKETS)) for b, n in buckets(text).items())
            for lang, c in counts.items()
        }
        top = max(logs.values())
        assert logs[found[k].lang_pred] > top - 1e-3
        assert math.isclose(found[k].score, 1 / sum(math.exp(x - top) for x in logs.values()), abs_tol=1e-3)
