"""Language-model scoring (8): a log-bilinear model trained with noise-contrastive estimation.

Words fall into classes, `class_count` of them: the most frequent words, half as many, are classes of
their own, the rest are told apart by their last two bytes. The model predicts a word's class from the
classes of the two words before it, and the word from its class:

    P(word | h) = P(class | h) * (c + 1) / (N_class + V_class + 1)

where c, N and V are training counts and the last 1 is the share of words never seen in that class.
P(class | h) is log-bilinear: each context position has a matrix that maps the embedding of its class,
their sum predicts the embedding of the next one. The sum over classes that normalises it is one
product of two matrices for all contexts at once.

It is trained on the counts of all class triples (cells) of the corpus, which stay in Spark, by telling
true triples from noise drawn by class frequency. In each of ROUNDS rounds every task goes over all of
its cells, each weighted by its count, from the same parameters; what the tasks arrive at is averaged
by the counts they saw. Small corpora are gone over more often, so that each has STEPS steps.

Counts of words cover all training texts and stay in Spark. The TABLE most frequent words travel to
the scoring tasks (4 MB); the counts of the others are joined, summed up before the shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from salesmill.llm.shipping import batches_of, ship
from salesmill.llm.text import NOT_SPACE, SLICE_BYTES, byte_slices, find_words, mix
from salesmill.session import written

#: The least number of classes; `class_count` has the number for a vocabulary.
CLASSES = 128
TABLE = 1 << 18
WIDTH, NOISE, BATCH, STEPS, ROUNDS = 24, 64, 2048, 1200, 4
#: Cells of a training block, near enough.
HELD = 1 << 19
END = np.uint64(0x5EED)
END_SHAPE = 0


def class_count(vocabulary: int) -> int:
    """160 classes for 10,000 words, 1,006 for a million, 2,524 for ten million, and so on without end."""
    return max(CLASSES, 2 * math.ceil(2 * vocabulary**0.4))


class Places:
    """Where values belong among sorted hashes, as np.searchsorted tells; the first bits of a hash nearly tell its place."""

    def __init__(self, hashes: np.ndarray):
        bits = min(max(2, len(hashes).bit_length()), 24)
        self.shift = np.uint64(64 - bits)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))
        self.first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        at = self.first[(wanted >> self.shift).view(np.int64)]
        below = np.flatnonzero(self.hashes[at] < wanted)
        while len(below):
            at[below] += 1
            below = below[self.hashes[at[below]] < wanted[below]]
        return at


@dataclass
class Classes:
    words: np.ndarray  # sorted hashes of the words that are classes of their own
    of_word: np.ndarray  # their classes
    of_shape: np.ndarray  # class of each of 65,536 pairs of last bytes
    size: int = CLASSES

    def of(self, hashes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        found = self.of_shape[shapes]
        if len(self.words):
            at = Places(self.words).of(hashes)
            at[at == len(self.words)] = 0
            found = np.where(self.words[at] == hashes, self.of_word[at], found)
        return found


@dataclass
class Model:
    classes: Classes
    context: np.ndarray  # embeddings of context classes, the start of a text last
    first: np.ndarray  # matrix of the word before the last
    second: np.ndarray  # matrix of the last word
    target: np.ndarray
    bias: np.ndarray
    class_total: np.ndarray  # log10(N_class + V_class + 1)
    table_words: np.ndarray
    table_counts: np.ndarray
    tokens: int
    vocabulary: int

    def log_norms(self) -> np.ndarray:
        """log of the sum over classes, for each last-but-one and last class of a context."""
        before = self.context @ self.first @ self.target.T
        last = self.context @ self.second @ self.target.T + self.bias
        high, top = before.max(axis=1, keepdims=True), last.max(axis=1, keepdims=True)
        total = np.exp(before - high) @ np.exp(last - top).T
        with np.errstate(divide="ignore"):
            norms = np.log(total) + high + top.T
        for i, j in np.argwhere(total < 1e-200):  # peaks too far apart for a product
            both = before[i] + last[j]
            norms[i, j] = both.max() + np.log(np.exp(both - both.max()).sum())
        return norms.astype(np.float32)

    def log_probabilities(self) -> np.ndarray:
        """log10 P(class | context) for all contexts: rows last-but-one * (classes + 1) + last."""
        n = len(self.target)
        before, last = self.context @ self.first, self.context @ self.second
        norms = self.log_norms()
        out = np.empty(((n + 1) ** 2, n), np.float32)
        for i in range(n + 1):
            scores = (before[i] + last) @ self.target.T + self.bias - norms[i][:, None]
            out[i * (n + 1) : (i + 1) * (n + 1)] = scores / np.log(10)
        return out


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of the tokens of all texts, each text followed by END, and where texts begin."""
    words = find_words(texts, NOT_SPACE)
    final = words.data[words.ends - 1].astype(np.int64)
    longer = words.ends - words.starts > 1
    shapes = final + 256 * np.where(longer, words.data[np.maximum(words.ends - 2, 0)], 0).astype(np.int64)
    ptr = words.ptr + np.arange(len(words.ptr))
    hashes, all_shapes = np.full(ptr[-1], END), np.full(ptr[-1], END_SHAPE, np.int64)
    inside = np.ones(ptr[-1], bool)
    inside[ptr[1:] - 1] = False
    hashes[inside], all_shapes[inside] = words.hashes(), shapes
    return hashes, all_shapes, ptr


def _context_pairs(classes: np.ndarray, ptr: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each token the classes of the token before the last and of the last; n where a text begins."""
    last, before = np.full(len(classes), n), np.full(len(classes), n)
    last[1:], before[2:] = classes[:-1], classes[:-2]
    begins = ptr[:-1]
    last[begins] = before[begins] = n
    second = begins + 1
    before[second[second < len(classes)]] = n
    return before, last


def _contexts(classes: np.ndarray, ptr: np.ndarray, n: int = CLASSES) -> np.ndarray:
    """For each token the row of its context in Model.log_probabilities."""
    before, last = _context_pairs(classes, ptr, n)
    return before * (n + 1) + last


def count_words(training: DataFrame) -> DataFrame:
    """(word, shape, times) over all texts; END is counted once for each text."""

    def run(batches):
        for batch in batches:
            words, shapes, times = [], [], []
            for part in byte_slices(batch, "text"):
                hashes, own, _ = _tokens(part.column(0))
                found, at, n = np.unique(hashes, return_index=True, return_counts=True)
                words.append(found)
                shapes.append(own[at])
                times.append(n)
            if words:
                word, shape, n = (np.concatenate(c) for c in (words, shapes, times))
                order = np.argsort(word, kind="stable")
                word, shape, n = word[order], shape[order], n[order]
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                yield pa.record_batch({
                    "word": word[first].view(np.int64), "shape": shape[first].astype(np.int32),
                    "times": np.add.reduceat(n, first),
                })

    counted = training.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "word long, shape int, times long")
    return counted.groupBy("word").agg(F.min("shape").alias("shape"), F.sum("times").alias("times"))


def _choose_classes(counts: DataFrame, vocabulary: int) -> Classes:
    size = class_count(vocabulary)
    top = counts.orderBy(F.desc("times"), "word").limit(size // 2).toPandas()
    single = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(single)
    known = counts.sparkSession.createDataFrame([(int(w),) for w in top["word"]], "word long")
    others = counts.join(F.broadcast(known), "word", "left_anti")
    shapes = others.groupBy("shape").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "shape")
    shapes = shapes.limit(size - size // 2 - 1).toPandas()["shape"].to_numpy(np.int64)
    of_shape = np.full(1 << 16, size - 1, np.int64)
    of_shape[shapes] = size // 2 + np.arange(len(shapes))
    return Classes(single[order], np.arange(len(single))[order], of_shape, size)


def _with_class(counts: DataFrame, classes: Classes) -> DataFrame:
    """Word counts with the class of each word; the tables joined have a row for each class at most."""
    spark = counts.sparkSession
    words = [(int(w), int(c)) for w, c in zip(classes.words.view(np.int64), classes.of_word)]
    shapes = [(int(s), int(classes.of_shape[s])) for s in np.flatnonzero(classes.of_shape < classes.size - 1)]
    rows = counts.join(F.broadcast(spark.createDataFrame(words, "word long, single int")), "word", "left")
    rows = rows.join(F.broadcast(spark.createDataFrame(shapes, "shape int, shaped int")), "shape", "left")
    return rows.withColumn("class", F.coalesce("single", "shaped", F.lit(classes.size - 1))).drop("single", "shaped")


def _cells(part: pa.RecordBatch, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """The (context, class) cells of the texts, sorted, and their counts. Words are found slice by slice: it takes
    many times the bytes of the texts to find them.
    """
    cells = []
    for few in byte_slices(part, "text"):
        hashes, shapes, ptr = _tokens(few.column(0))
        own = classes.of(hashes, shapes)
        cells.append(_contexts(own, ptr, classes.size) * classes.size + own)
    return np.unique(np.concatenate(cells), return_counts=True)


def _triples(training: DataFrame, classes: Classes) -> DataFrame:
    """(cell, times): counts of all (context, class) cells over the training texts, those that occur."""
    shared = training.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", 8 * SLICE_BYTES):
                found, times = _cells(part, shared.value)
                yield pa.record_batch({"cell": found, "times": times})

    rows = training.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "cell long, times long")
    return rows.groupBy("cell").agg(F.sum("times").alias("times"))


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the most frequent words, TABLE at most.

    Words are taken down to a count that leaves no more; eighths of a power of two give the steps.
    """
    step = F.floor(8 * F.log2("times")).cast("int")
    sizes = sorted((tuple(r) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)  # 500 at most
    least, taken = None, 0
    for at, n in sizes:
        if taken + n > TABLE:
            break
        least, taken = at, taken + n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = counts.where(step >= least).select("word", "times").toArrow()
    words, times = table["word"].to_numpy().view(np.uint64), table["times"].to_numpy()
    order = np.argsort(words)
    return words[order], times[order]


def _begin(frequency: np.ndarray, seed: int) -> list[np.ndarray]:
    """Parameters before training: embeddings, matrices, biases; then the squares of their gradients."""
    rng = np.random.default_rng(seed)
    n = len(frequency)
    params = [rng.normal(0, 0.1, (n + 1, WIDTH)), 0.5 * np.eye(WIDTH), np.eye(WIDTH), rng.normal(0, 0.1, (n, WIDTH)),
              np.log(frequency / frequency.sum())]
    return [p.astype(np.float32) for p in params] + [np.full(p.shape, 1e-8, np.float32) for p in params]


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of `values` by their place `at`, n places."""
    order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")  # short numbers are sorted by radix
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    out = np.zeros((n, *values.shape[1:]), values.dtype)
    out[at[first]] = np.add.reduceat(values.take(order, 0), first, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In the place of `x`."""
    np.clip(x, -30, 30, out=x)
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.divide(1, x, out=x)


def _learn(state: list[np.ndarray], noise: np.ndarray, cells: np.ndarray, times: np.ndarray, mean: float, passes: int, rate: float, rng) -> None:
    """Go over all cells `passes` times, in batches, and change `state`. A cell weighs its count; one of
    more than `mean` is dealt over several batches in equal shares.
    """
    context, first, second, target, bias = params = state[:5]
    n = len(target)
    copies = np.ceil(times / mean).astype(np.int64)
    entry, weight = np.repeat(cells, copies), np.repeat((times / copies / mean).astype(np.float32), copies)
    offset = np.log(NOISE * noise).astype(np.float32)
    share = np.cumsum(noise)
    scores = np.empty((BATCH, NOISE), np.float32)
    for _ in range(passes):
        order = rng.permutation(len(entry))
        for begin in range(0, len(order), BATCH):
            drawn = order[begin : begin + BATCH]
            w = weight[drawn][:, None]
            row, wanted = entry[drawn] // n, entry[drawn] % n
            i, j = row // (n + 1), row % (n + 1)
            ri, rj = context.take(i, 0), context.take(j, 0)
            predicted = ri @ first
            predicted += rj @ second
            false = np.minimum(np.searchsorted(share, rng.random(NOISE)), n - 1)
            true_target, false_target = target.take(wanted, 0), target[false]
            # Gradients of the log-likelihood that true triples are true and noise is noise.
            good = w[:, 0] * (1 - _sigmoid((predicted * true_target).sum(axis=1) + bias[wanted] - offset[wanted]))
            bad = np.matmul(predicted, false_target.T, out=scores[: len(drawn)])
            bad += bias[false]
            bad -= offset[false]
            _sigmoid(bad)
            bad *= -w
            d_predicted = good[:, None] * true_target
            d_predicted += bad @ false_target
            at = np.concatenate((wanted, false))
            d_target = _sums(at, np.concatenate((good[:, None] * predicted, bad.T @ predicted)), n)
            d_bias = _sums(at, np.concatenate((good, bad.sum(axis=0))), n)
            d_context = _sums(np.concatenate((i, j)), np.concatenate((d_predicted @ first.T, d_predicted @ second.T)), n + 1)
            for p, s, d in zip(params, state[5:], (d_context, ri.T @ d_predicted, rj.T @ d_predicted, d_target, d_bias)):
                d = d / np.float32(len(drawn))
                s += d * d
                p += np.float32(rate) * d / np.sqrt(s)


def _passes(cells: int, steps: int) -> int:
    """Passes of a round over so many cells, so that all rounds make `steps` steps at least."""
    return max(1, -(-steps // (ROUNDS * max(1, cells // BATCH))))


def _rate(round_: int) -> float:
    return 0.1 * (1 - 0.9 * round_ / ROUNDS)


def train(cells: np.ndarray, steps: int = STEPS, seed: int = 5) -> tuple[np.ndarray, ...]:
    """Embeddings, matrices and biases from an array of class-triple counts of CLASSES classes."""
    frequency = cells.reshape(-1, CLASSES).sum(axis=0) + 1.0
    state = _begin(frequency, seed)
    used = np.flatnonzero(cells)
    if len(used):
        for k in range(ROUNDS):
            _learn(state, frequency / frequency.sum(), used, cells[used], cells.sum() / len(used), _passes(len(used), steps), _rate(k),
                   np.random.default_rng((seed, k)))
    return tuple(state[:5])


def packed_cells(cells: DataFrame) -> tuple[DataFrame, int, int]:
    """(block, cells, times): (cell, times) rows in blocks of about HELD cells, sorted, as 64-bit numbers; their number and sum.

    A cell's block depends on its number and on how many cells there are, so training does not depend on the
    cluster.
    """
    count, total = cells.agg(F.count(F.lit(1)), F.coalesce(F.sum("times"), F.lit(0))).first()
    blocks = max(1, -(-count // HELD))

    def pack(key, rows):
        cell, times = rows["cell"].to_numpy(), rows["times"].to_numpy()
        order = np.argsort(cell)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "cells": [cell[order].tobytes()], "times": [times[order].tobytes()]})

    block = F.pmod(F.xxhash64("cell"), F.lit(blocks)).cast("int").alias("block")
    dealt = cells.select(block, "cell", "times").repartition(blocks, "block")  # a task for each block, more or less
    return dealt.groupBy("block").applyInArrow(pack, "block int, cells binary, times binary"), count, total


def train_in_tasks(cells: DataFrame, frequency: np.ndarray, steps: int = STEPS, seed: int = 5) -> tuple[np.ndarray, ...]:
    """The same from (cell, times) rows of any number, in Spark tasks; `frequency` is that of the classes.

    In each round every block learns from the round's parameters; the results are averaged by count.
    """
    spark = cells.sparkSession
    frequency = frequency + 1.0
    state, noise = _begin(frequency, seed), frequency / frequency.sum()
    blocks, count, total = packed_cells(cells)
    if not count:
        return tuple(state[:5])
    blocks = written(blocks, "blocks")
    mean, passes = total / count, _passes(count, steps)
    groups = max(1, math.isqrt(-(-count // HELD)))
    shapes = [p.shape for p in state]

    for k in range(ROUNDS):
        shared, rate = spark.sparkContext.broadcast(state), _rate(k)

        def run(batches, shared=shared, rate=rate, k=k):
            for batch in batches:
                for block, cell, times in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                    cell, times = np.frombuffer(cell.as_buffer(), np.int64), np.frombuffer(times.as_buffer(), np.int64)
                    own = [p.copy() for p in shared.value]
                    _learn(own, noise, cell, times, mean, passes, rate, np.random.default_rng((seed, k, block)))
                    seen = int(times.sum())
                    flat = np.concatenate([p.ravel() for p in own]).astype(np.float64) * seen
                    yield pa.record_batch({"part": pa.array([block % groups], pa.int32()), "block": pa.array([block], pa.int32()),
                                           "seen": pa.array([seen], pa.int64()), "state": pa.array([flat.tobytes()], pa.binary())})

        def add(batches):
            part, seen, flat = None, 0, 0.0
            for batch in batches:
                for p, n, one in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                    if p != part and seen:
                        yield _state(part, seen, flat)
                        seen, flat = 0, 0.0
                    part, seen, flat = p, seen + n, flat + np.frombuffer(one.as_buffer(), np.float64)
            if seen:
                yield _state(part, seen, flat)

        found = blocks.mapInArrow(run, "part int, block int, seen long, state binary").repartition(groups, "part").sortWithinPartitions("part", "block")
        with batches_of(spark, 1):
            sums = found.mapInArrow(add, "part int, seen long, state binary").collect()  # a row for each group
        sums.sort(key=lambda r: r.part)
        flat = sum(np.frombuffer(r.state, np.float64) for r in sums) / sum(r.seen for r in sums)
        cuts = np.cumsum([math.prod(x) for x in shapes])[:-1]
        state = [p.reshape(x).astype(np.float32) for p, x in zip(np.split(flat, cuts), shapes)]
        shared.unpersist()
    return tuple(state[:5])


def _state(part: int, seen: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"part": pa.array([part], pa.int32()), "seen": pa.array([seen], pa.int64()), "state": pa.array([flat.tobytes()], pa.binary())})


class Norms:
    """log of the sum over classes by context, found when a context first comes; a bounded table keeps them."""

    def __init__(self, model: Model, slots: int = 1 << 20):
        self.size, self.slots = model.classes.size, np.uint64(slots - 1)
        self.before, self.last = ((model.context @ x).astype(np.float32) for x in (model.first, model.second))
        self.target, self.bias = model.target.astype(np.float32), model.bias.astype(np.float32)
        self.key, self.value = np.full(slots, -1, np.int64), np.zeros(slots, np.float32)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        contexts = i * (self.size + 1) + j
        slot = self._slots(contexts)
        norms = self.value[slot]
        missed = np.flatnonzero(self.key[slot] != contexts)
        if not len(missed):
            return norms
        new, where = np.unique(contexts[missed], return_inverse=True)
        found = np.empty(len(new), np.float32)
        step = max(1, (1 << 20) // self.size)  # contexts whose scores are held at once
        for at in range(0, len(new), step):
            a, b = np.divmod(new[at : at + step], self.size + 1)
            scores = (self.before[a] + self.last[b]) @ self.target.T
            scores += self.bias
            top = scores.max(axis=1)
            scores -= top[:, None]
            found[at : at + step] = top + np.log(np.exp(scores, out=scores).sum(axis=1))
        slot = self._slots(new)
        self.key[slot], self.value[slot] = new, found
        norms[missed] = found[where]
        return norms

    def _slots(self, contexts: np.ndarray) -> np.ndarray:
        return (mix(contexts.view(np.uint64)) & self.slots).view(np.int64)


def fit(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the table of all word counts, from the `text` column (null: empty)."""
    ship(training.sparkSession)
    counts = written(count_words(training), "counts")
    tokens, vocabulary = counts.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count(F.lit(1))).first()
    classes = _choose_classes(counts, vocabulary)
    cells = written(_triples(training, classes), "cells")
    sizes = _with_class(counts, classes).groupBy("class").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("v"))
    class_total, frequency = np.zeros(classes.size), np.zeros(classes.size)
    for c, n, v in sizes.select("class", "n", "v").collect():  # a row for each class
        class_total[c], frequency[c] = np.log10(n + v + 1), n
    words, times = _most_frequent(counts)
    model = Model(classes, *train_in_tasks(cells, frequency), class_total, words, times, int(tokens), int(vocabulary))
    return model, counts


_SCORED = "row long, doc_id {}, n_tokens long, n_known long, base double, model double, rare array<long>"


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), log10, one row per row of `docs`.

    A null or empty text is the token END alone. Without training texts both scores are 0. Repeated
    rows give a row each; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    each = float(np.log10(model.tokens + model.vocabulary + 1))

    def run(batches):
        m: Model = shared.value
        size, norms = m.classes.size, Norms(m)
        before, last, target, bias = norms.before, norms.last, norms.target, norms.bias
        weight, places = np.log10(m.table_counts + 1.0), Places(m.table_words)
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch in batches:
            for part in byte_slices(batch, "text"):
                hashes, shapes, ptr = _tokens(part.column(1))
                own = m.classes.of(hashes, shapes)
                i, j = _context_pairs(own, ptr, size)
                fitted = np.einsum("ij,ij->i", before.take(i, 0) + last.take(j, 0), target.take(own, 0)) + bias[own] - norms.of(i, j)
                modelled = fitted / math.log(10) - m.class_total[own]
                at = places.of(hashes)
                at[at == len(m.table_words)] = 0
                known = m.table_words[at] == hashes if len(m.table_words) else np.zeros(len(hashes), bool)
                seen = np.where(known, weight[at] if len(weight) else 0.0, 0.0)
                rare = np.flatnonzero(~known)
                cut = np.searchsorted(rare, ptr)
                n = part.num_rows
                yield pa.record_batch([
                    pa.array(np.arange(row, row + n)), part.column(0), pa.array(np.diff(ptr)),
                    pa.array(np.add.reduceat(known.astype(np.int64), ptr[:-1])),
                    pa.array(np.add.reduceat(seen, ptr[:-1])), pa.array(np.add.reduceat(modelled + seen, ptr[:-1])),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(hashes[rare].view(np.int64))),
                ], ["row", "doc_id", "n_tokens", "n_known", "base", "model", "rare"])
                row += n

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scored = written(rows.mapInArrow(run, _SCORED.format(kind)), "scored")
    if not model.tokens:
        return scored.select("doc_id", "n_tokens", F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"),
                             F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    # Words outside the table: a row for each text and distinct word meets the word's count. Hot words
    # are inside the table, so no key of this join is large.
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("word", "row").agg(F.count(F.lit(1)).alias("n"))
    found = rare.join(counts.select("word", "times"), "word")
    late = found.groupBy("row").agg(
        F.sum("n").alias("late_known"), F.sum(F.col("n") * F.log10(F.col("times") + 1)).alias("late")
    )
    nothing = F.coalesce(F.col("late"), F.lit(0.0))
    return scored.drop("rare").join(late, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("n_known") + F.coalesce("late_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + nothing - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("model") + nothing).alias("score"),
    )
