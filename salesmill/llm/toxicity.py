"""Toxicity (3): cumulative-link ordinal regression on sparse text features.

A text's features are its distinct words and their first LEADS letters, hashed. One weight vector is
shared by all thresholds: P(grade > j) = sigmoid(x . w - t_j) with t_0 < t_1 < ..., and the expected
severity is the sum of these chances. Features that go with graded texts, or with texts of grade 0, in
the fitting sample take part, so words that prove nothing, however many a long text has, add nothing.

Features are counted by Spark over the sample. All that pass LEAST_SHARE, LEAST_RATIO and LEAST_EVIDENCE
are chosen: each is in a hundredth of the graded or of the clean texts, so there are at most 100 times as
many as a text of that kind has on average. They and the sparse rows of the sample (FIT_ROWS at most,
expected) go to the driver, which fits in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmill.llm.shipping import ship
from salesmill.llm.text import WORD, byte_slices, find_words, mix, span_hashes
from salesmill.session import written

LEADS = (3, 4, 5, 6, 7, 8)
FIT_ROWS = 20_000
#: A feature must be in this share of the graded texts of the sample, this many times as often as in
#: texts of grade 0, or the other way round, and its log-likelihood ratio against chance must reach this value.
LEAST_SHARE, LEAST_RATIO, LEAST_EVIDENCE = 0.01, 8.0, 16.0
STEPS, RATE, DECAY = 400, 0.1, 1e-3
#: A text is called toxic from this chance of a grade above 0 on.
LEAST_CHANCE = 0.3


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # one less than there are grades


def _all_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all texts and the text of each, repeats included, in no order."""
    words = find_words(texts, WORD)
    owner, hashes = words.owner(), [words.hashes()]
    owners = [owner]
    for lead in LEADS:
        long = words.ends - words.starts > lead
        starts = words.starts[long]
        hashes.append(span_hashes(words.data, starts, starts + lead) ^ np.uint64(lead))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of each text in a row, and where each text's begin."""
    hashes, owner = _all_features(texts)
    _, first = np.unique(mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    first = first[np.argsort(owner[first], kind="stable")]
    return hashes[first], np.searchsorted(owner[first], np.arange(len(texts) + 1))


def known_features(texts: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in `known`) of each text's distinct known features, by text; `known` is sorted."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, owner = _all_features(texts)
    mask = np.uint64((1 << 20) - 1)  # a small table tells most others apart before the search
    there = np.zeros(1 << 20, bool)
    there[(known & mask).astype(np.int64)] = True
    perhaps = np.flatnonzero(there[(hashes & mask).astype(np.int64)])
    at = np.searchsorted(known, hashes[perhaps])
    at[at == len(known)] = 0
    real = known[at] == hashes[perhaps]
    found = np.unique(owner[perhaps[real]] * len(known) + at[real])
    return found // len(known), found % len(known)


def _rows(sample: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(grade, size, features) of every text; with `known`, only those features, by their places."""
    shared = sample.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                found, cut = features(part.column(1))
                size = np.diff(cut)
                if shared.value is not None:
                    owner, found = known_features(part.column(1), shared.value)
                    cut = np.searchsorted(owner, np.arange(part.num_rows + 1))
                yield pa.record_batch([
                    part.column(0), pa.array(size),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(found.view(np.int64))),
                ], ["grade", "size", "features"])

    rows = sample.select(F.col("grade").cast("int"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "grade int, size long, features array<long>")


def _select(sample: DataFrame) -> np.ndarray:
    rows = _rows(sample, None)
    graded, clean = rows.agg(F.expr("count_if(grade > 0)"), F.expr("count_if(grade = 0)")).first()
    if not graded:
        return np.zeros(0, np.uint64)
    share = graded / (graded + clean)
    bad, good = F.col("bad"), F.col("all") - F.col("bad")

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / (F.col("all") * expected))).otherwise(0.0)

    def goes_with(n, total, other, others):
        return (n >= LEAST_SHARE * total) & (n * max(others, 1) >= LEAST_RATIO * total * other)

    counted = (
        rows.select((F.col("grade") > 0).cast("int").alias("bad"), F.explode("features").alias("feature"))
        .groupBy("feature").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("all"))
        .where(goes_with(bad, graded, good, clean) & (bad > 0) | goes_with(good, clean, bad, graded) & (good > 0))
        .where(2 * (part(bad, share) + part(good, 1 - share + 1e-9)) >= LEAST_EVIDENCE)
    )
    return np.sort(counted.select("feature").toArrow()["feature"].to_numpy().view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Train on the texts of `docs` (doc_id, text) that `labels` (doc_id, grade) names.

    Grades are whole numbers from 0. More labels than `fit_rows` give a sample by the hash of doc_id,
    of about that size, which is small enough to broadcast; its texts are whole. Null labels are left
    out, labels that repeat a doc_id count by their largest grade. Without texts above grade 0 nothing
    is toxic. A grade that no text has moves no weight.
    """
    ship(docs.sparkSession)
    named = labels.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    total = named.count()
    if total > fit_rows:
        named = named.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < F.lit(int((fit_rows << 20) / total)))
    known = written(docs.select("doc_id", "text").join(F.broadcast(named), "doc_id").select("grade", "text"), "sample")
    chosen = _select(known)
    found = _rows(known, chosen).toArrow().to_pandas()  # the sample's rows, only chosen features
    grades = found["grade"].to_numpy(np.int64)
    top = int(grades.max(initial=0))
    if not len(chosen) or not top:
        return Model(chosen[:0], np.zeros(0), np.full(max(top, 1), 20.0))
    sizes = np.array([len(f) for f in found["features"]])
    columns = np.concatenate([np.asarray(f, np.int64) for f in found["features"]])
    owner = np.repeat(np.arange(len(grades)), sizes)
    weights, thresholds = _train(owner, columns, grades, len(chosen), top)
    return Model(chosen, weights, thresholds)


def _train(owner, columns, grades, width: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood with weight decay, by Adam over the whole sample; thresholds keep their order
    because the gaps between them are exponentials."""
    above = grades[:, None] > np.arange(top)  # whether each threshold is passed
    params = [np.zeros(width), np.array([2.0]), np.zeros(top - 1)]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    n = len(grades)
    for step in range(1, STEPS + 1):
        weights, low, gaps = params
        thresholds = low + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(owner, weights[columns], minlength=n)
        chance = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -30, 30)))
        # P(grade = g) = P(> g - 1) - P(> g); its logarithm's slopes in the two bounding scores.
        full = np.concatenate([np.ones((n, 1)), chance, np.zeros((n, 1))], axis=1)
        mass = np.maximum(full[np.arange(n), grades] - full[np.arange(n), grades + 1], 1e-9)
        slope = full * (1 - full)
        up = np.zeros((n, top + 2))
        up[np.arange(n), grades] = slope[np.arange(n), grades] / mass
        up[np.arange(n), grades + 1] -= slope[np.arange(n), grades + 1] / mass
        each = up[:, 1 : top + 1] / n  # by threshold
        d_score, d_thresholds = each.sum(axis=1), -each.sum(axis=0)
        tail = np.cumsum(d_thresholds[::-1])[::-1]
        slopes = [
            np.bincount(columns, d_score[owner], minlength=width) - DECAY * weights / 10,
            np.array([tail[0]]), tail[1:] * np.exp(gaps),
        ]
        for p, m, v, d in zip(params, first, second, slopes):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights, low, gaps = params
    return weights, low + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def predict(docs: DataFrame, model: Model, least: float = LEAST_CHANCE) -> DataFrame:
    """(doc_id, severity, chances, toxic): expected grade, P(grade > j) for each j, and whether P(> 0)
    is at least `least`. One row per row of `docs`; a null or empty text has no features."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                m: Model = shared.value
                owner, at = known_features(part.column(1), m.features)
                score = np.bincount(owner, m.weights[at], minlength=part.num_rows)
                chance = 1 / (1 + np.exp(-np.clip(score[:, None] - m.thresholds, -30, 30)))
                yield pa.record_batch([
                    part.column(0), pa.array(chance.sum(axis=1)), pa.array(chance.tolist(), pa.list_(pa.float64())),
                    pa.array(chance[:, 0] >= least),
                ], ["doc_id", "severity", "chances", "toxic"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, severity double, chances array<double>, toxic boolean")
