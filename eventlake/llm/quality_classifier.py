"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A text's features are the n-grams it contains, each once: words, pairs of words, and runs of up to three word shapes
(capitals, digits, signs, whether the word repeats the one before). Indicators are hashed to ``2 ** BITS`` places, scaled
by the log ratio of their counts in the two classes, and divided by the square root of how many a text has. A
linear hinge-loss model is fitted to them by dual coordinate descent, both classes weighing the same.

The fit uses a bounded sample of labelled documents (``most``, chosen by a hash of the id), whose features go to
the driver; scoring reads every document whole and sends nothing but one weight per place.

Defined results: null and empty texts have no features and get the score of the bias. A null id is never labelled. A
document labelled both ways is not learned from; one labelled twice alike counts once. If only one class is
labelled, or none, all scores are 0.5. Repeated rows are scored alike. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.text import combine, crc_bucket, fold, mix, run_starts, slices, text_bytes, texts_of, word_bounds, word_hashes

BITS = 20
MOST_LABELLED = 8000


def _within(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many flagged bytes each word has."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int32)))
    return sums[end] - sums[start]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of the text and the place, for each distinct n-gram of each text; sorted by both."""
    data, offsets = text_bytes(texts)
    low = fold(data)
    start, end, per_text = word_bounds(low, offsets)
    number = np.repeat(np.arange(len(texts), dtype=np.int64), per_text)
    words = word_hashes(low, start, end)
    letters = (low >= 97) & (low <= 122) | (low >= 128)
    digits = (data >= 48) & (data <= 57)
    length = end - start
    n_upper = _within((data >= 65) & (data <= 90), start, end)
    n_digits, n_signs = _within(digits, start, end), _within(~letters & ~digits, start, end)
    again = ~run_starts(words) & ~run_starts(number)
    last = np.where(letters[end - 1] | digits[end - 1], 0, data[end - 1]) if len(end) else np.empty(0, np.uint8)
    shape = last.astype(np.uint64)
    parts = (n_upper > 0, n_upper * 2 > length, n_digits > 0, n_digits * 2 > length, again, n_signs == length)
    for part in (*parts, np.minimum(n_signs, 3) & 1, np.minimum(n_signs, 3) >> 1):
        shape = shape * np.uint64(2) + part.astype(np.uint64)
    shape = mix(shape + np.uint64(1 << 32))
    grams = [(words, number), (shape, number)]
    for run, column in ((2, words), (2, shape), (3, shape)):
        if len(column) >= run:
            whole = number[run - 1 :] == number[: len(number) - run + 1]
            grams.append((combine([column[j : len(column) - run + 1 + j] for j in range(run)])[whole], number[run - 1 :][whole]))
    place = np.concatenate([g for g, _ in grams]) & np.uint64((1 << BITS) - 1)
    found = np.unique((np.concatenate([n for _, n in grams]) << BITS) | place.astype(np.int64))
    return found >> BITS, found & ((1 << BITS) - 1)


@dataclass
class Model:
    """A weight per place (class ratio times support-vector weight) and a bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        number, place = features(texts)
        n = len(texts)
        sums = np.bincount(number, weights=self.weights[place], minlength=n)
        sizes = np.maximum(np.bincount(number, minlength=n), 1)
        return 1.0 / (1.0 + np.exp(-2.0 * np.clip(sums / np.sqrt(sizes) + self.bias, -300, 300)))


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, rounds: int = 30, alpha: float = 1.0) -> Model:
    """Class log-count ratios, then dual coordinate descent on the scaled indicators.

    ``rows`` are the places of each text, ``labels`` 0 or 1. Ends early once no dual variable moves.
    """
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(size, np.float32), 0.0)
    counts = [np.full(size, alpha), np.full(size, alpha)]
    for places, label in zip(rows, labels):
        counts[label][places] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    sign = np.where(labels == 1, 1.0, -1.0)
    bound = np.where(labels == 1, cost * len(labels) / (2 * (labels == 1).sum()), cost * len(labels) / (2 * (labels == 0).sum()))
    # values of a row are made when it is visited: they would be the largest thing here
    scale = [1.0 / np.sqrt(max(1, len(p))) for p in rows]
    squares = np.array([float(ratio[p] @ ratio[p]) * s * s for p, s in zip(rows, scale)]) + 1.0  # 1 for the bias
    weights, bias, dual = np.zeros(size), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            places = rows[i]
            values = ratio[places] * scale[i]
            gradient = sign[i] * (float(weights[places] @ values) + bias) - 1.0
            new = min(max(dual[i] - gradient / squares[i], 0.0), bound[i])
            step = (new - dual[i]) * sign[i]
            if step:
                weights[places] += step * values
                bias += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost:
            break
    return Model((weights * ratio).astype(np.float32), bias)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, fold_of: int = 3) -> DataFrame:
    """``doc_id, quality, text`` of about ``most`` labelled documents outside the held-out fold.

    The chosen labels are at most about ``most`` rows, so they are sent to the texts.
    """
    doc_id = F.col("doc_id").cast("long")
    known = labels.select(doc_id.alias("id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("id").isNotNull() & F.col("quality").isin(0, 1) & (crc_bucket(F.col("id"), fold_of) != 1))
    known = known.groupBy("id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    known = known.where(F.col("quality") == F.col("other")).drop("other")
    share = min(1.0, most / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = texts_of(docs)
    return texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["id"]).drop("id")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            number, place = features(batch.column("text"))
            begins = np.searchsorted(number, np.arange(batch.num_rows + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(begins), pa.array(place.astype(np.int32)))
            yield pa.record_batch([batch.column("doc_id"), batch.column("quality"), places], ["doc_id", "quality", "places"])


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, fold_of: int = 3) -> Model:
    """Fit on the sample; rows are put in order first, so that reruns agree."""
    sample = labelled_sample(docs, labels, most, fold_of).select("doc_id", "quality", "text")
    found = sample.mapInArrow(_features, "doc_id long, quality int, places array<int>").toArrow()
    order = np.argsort(found.column("doc_id").to_numpy(), kind="stable")
    places = found.column("places").combine_chunks()
    flat = places.flatten().to_numpy()
    ends = np.concatenate(([0], np.cumsum(places.value_lengths().to_numpy()))) if len(places) else np.zeros(1, int)
    rows = [flat[ends[i] : ends[i + 1]] for i in order]
    return fit(rows, found.column("quality").to_numpy()[order])


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in slices(whole, "text"):
                score = pa.array(model.scores(batch.column("text")))
                yield pa.record_batch([*(c for n, c in zip(batch.schema.names, batch.columns) if n != "text"), score],
                                      [*(n for n in batch.schema.names if n != "text"), "score"])

    return run


def score_documents(docs: DataFrame, model: Model, fold_of: int = 3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = texts_of(docs).mapInArrow(_score(sent), "doc_id long, score double")
    held_out = (crc_bucket(F.col("doc_id"), fold_of) == 1).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that score at least ``least``, all their columns as they were; only scores come back from Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = slices(pa.record_batch([texts], ["text"]), "text")
        return pa.array(np.concatenate([np.empty(0), *(sent.value.scores(p.column("text")) for p in parts)]))

    return docs.where(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) >= least)
