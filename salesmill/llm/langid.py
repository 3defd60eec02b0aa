"""Language identification (4): multinomial naive Bayes over hashed character n-grams.

Training counts 1- to 4-grams of labelled texts, hashed into BUCKETS, per language; the counts of all
tasks are summed by Spark. The log-probability matrix (BUCKETS x languages, bounded by MAX_LANGS) is
broadcast. Scoring is a sparse product: each text is a row of hashed n-grams whose matrix rows are
added up in numpy. Only letters count, in lower case; any run of other characters is one space.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmill.llm.shipping import ship
from salesmill.llm.text import byte_slices, mix

BUCKETS = 1 << 16
LENGTHS = (1, 2, 3, 4)
#: Languages a model can hold; the matrix then has 64 MB at most.
MAX_LANGS = 256
#: Labelled rows that training reads, as an expected number; all of them if there are fewer.
FIT_ROWS = 40_000
SMOOTHING = 0.5
UNKNOWN = "und"
_folded: list[np.ndarray] = []


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray  # log-probability of each language
    table: np.ndarray  # log-probability of each bucket (row) in each language (column)


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is none."""
    if not _folded:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _folded.append(table)
    return _folded[0]


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and which texts have a letter."""
    strings = texts.fill_null("").to_pylist()
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(s) for s in strings], np.int64)
    owner = np.repeat(np.arange(len(strings)), sizes)
    folded = _letters()[points]
    # One space for each run of other characters inside a text; texts never run together.
    keep = folded > 0
    if len(keep):
        keep[1:] |= (folded[:-1] > 0) & (owner[1:] == owner[:-1])
    folded, owner = folded[keep].astype(np.uint64), owner[keep]
    has = np.zeros(len(strings), bool)
    has[owner[folded > 0]] = True
    buckets, owners = [], []
    key = np.zeros(len(folded), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        count = len(folded) - n + 1
        if count <= 0:
            break
        key = key[:count] * np.uint64(0x100000001B3) + folded[n - 1 :] + np.uint64(1)
        if n in LENGTHS:
            inside = owner[:count] == owner[n - 1 :]
            if n == 1:
                inside = inside & (folded > 0)
            hashed = mix(key[inside] + np.uint64(n << 56)) & np.uint64(BUCKETS - 1)
            buckets.append(hashed.astype(np.int64))
            owners.append(owner[:count][inside])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    return np.concatenate(buckets), np.concatenate(owners), has


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Train on (doc_id, text, lang) rows; rows without text or lang are left out.

    A corpus of more than `fit_rows` labelled rows gives a sample by the hash of doc_id, whole texts,
    of about that size. Returns a model without languages if there is nothing to learn from.
    """
    spark = labelled.sparkSession
    known = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    total = known.select("doc_id", "lang").count()
    if total > fit_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 20)) < F.lit(int((fit_rows << 20) / total)))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for part in byte_slices(batch, "text"):
                langs = np.array(part.column(2).to_pylist(), object)
                buckets, owner, _ = grams(part.column(1))
                for lang in np.unique(langs):
                    mine = langs == lang
                    found = np.bincount(buckets[mine[owner]], minlength=BUCKETS)
                    sums[lang] = sums.get(lang, 0) + found
                    rows[lang] = rows.get(lang, 0) + int(mine.sum())
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.record_batch({
                "lang": pa.array([lang] * (len(at) + 1)),
                "bucket": pa.array(np.r_[-1, at]),  # -1: texts of the language
                "times": pa.array(np.r_[rows[lang], found[at]]),
            })

    counted = known.mapInArrow(count, "lang string, bucket long, times long")
    counts = counted.groupBy("lang", "bucket").agg(F.sum("times").alias("times"))
    # A row for each language and bucket: bounded by the model, not by the corpus.
    found = counts.toArrow().to_pandas()
    langs = sorted(found["lang"].unique())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"{len(langs)} languages; a model holds {MAX_LANGS}")
    table = np.zeros((BUCKETS, len(langs)))
    prior = np.zeros(len(langs))
    for j, lang in enumerate(langs):
        mine = found[found["lang"] == lang]
        grams_ = mine[mine["bucket"] >= 0]
        table[grams_["bucket"].to_numpy(), j] = grams_["times"]
        prior[j] = mine.loc[mine["bucket"] < 0, "times"].sum()
    if langs:
        table += SMOOTHING
        table = np.log(table / table.sum(axis=0))
        prior = np.log(prior / prior.sum())
    return Model(langs, prior, table.astype(np.float32))


def score(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its probability; `und` and 0 without a letter."""
    if not model.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    buckets, owner, has = grams(texts)
    total = np.empty((len(texts), len(model.langs)))
    for j in range(len(model.langs)):
        total[:, j] = np.bincount(owner, model.table[buckets, j], minlength=len(texts)) + model.prior[j]
    best = total.argmax(axis=1)
    chance = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return [model.langs[b] if h else UNKNOWN for b, h in zip(best, has)], np.where(has, chance, 0.0)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for each row; a null, empty or letterless text is `und` with score 0.

    Ties between languages go to the one whose code sorts first. Other columns are ignored.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                langs, chance = score(shared.value, part.column(1))
                yield pa.record_batch([part.column(0), pa.array(langs, pa.string()), pa.array(chance)], ["k", "l", "s"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose language is known with at least this probability."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                langs, chance = score(shared.value, part.column(part.schema.get_field_index("text")))
                keep = (np.array(langs, object) != UNKNOWN) & (chance >= least)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
