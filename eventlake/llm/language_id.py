"""Language of a text by its nearest centroid.

A text is a vector of letter n-grams (one to three letters, the border of a word counting as a sign), weighted by
``(1 + ln tf) * idf`` and scaled to length 1; n-grams share ``2 ** BITS`` buckets by a hash. Document frequencies cover all
learning texts. Each language has several centroids, found by a few rounds of clustering by cosine over a sample of its
learning texts: at most about ``most`` distinct texts per language (a parameter), picked by a hash, so that the sample is the
same in every run. A text gets the language of the centroid it has the largest cosine with.

A text that lies further from its nearest centroid than is usual is rejected: for each size class (number of
n-grams, by powers of two) the limit is the mean distance of the sample's texts to their own language plus ``REACH`` standard
deviations. ``lang_pred`` keeps the nearest language, ``rejected`` says that it should not be relied on.

Spark does the counting, the clustering and the scoring; the driver gets document frequencies (``2 ** BITS`` numbers) and
centroids (languages x CLUSTERS x ``2 ** BITS``). The ``most_langs`` commonest languages are learned, a bound of the model.

Defined results: null texts and texts without a letter are ``und`` with score 0, and are not learned from. Rows without
a language are not learned from but get one. Repeated rows are scored alike; in the sample a repeated text counts once. Long texts are
taken in portions, whole. Equal cosines go to the language first in code point order. Without any learning text
every text is ``und``. An empty table gives an empty result. Columns other than id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.text import crc_bucket, slices
from eventlake.session import fresh_path

UNKNOWN = "und"
BITS = 14
GRAMS = 3
CLUSTERS, ROUNDS, MOST, MOST_LANGS, REACH = 4, 4, 1500, 256, 5.0
FOLDS, HELD_OUT = 4, 2
_PORTION = 1 << 18
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_BLOCK = 64
_SIZES = 40  # size classes
_TASKS = 64  # at most as many tasks share the sample, so a centroid has as many partial sums


@cache
def letters() -> np.ndarray:
    """The folded letter of each code point, 0 for all that is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            table[i] = ord(c.lower()[0])
    return table


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur; an n-gram has a letter, and a border only at its ends."""
    size = 1 << BITS
    shift = np.uint64(64 - BITS)
    total = np.zeros(size, dtype=np.int64)
    for begin in range(0, len(text), _PORTION):
        end = min(begin + _PORTION, len(text))
        # one sign before and as many behind as n-grams that begin in this portion need
        signs = np.frombuffer(text[max(begin - 1, 0) : end + GRAMS - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        signs = letters()[signs]
        if begin == 0:
            signs = np.concatenate([np.zeros(1, np.uint32), signs])
        if end == len(text):
            signs = np.concatenate([signs, np.zeros(GRAMS, np.uint32)])
        n = end - begin + (end == len(text))  # n-grams begin at the sign before each of these
        letter = signs != 0
        wide = signs.astype(np.uint64)
        with np.errstate(over="ignore"):
            one = wide * _ODD[0]
            two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) + wide[1:] * _ODD[1]
            three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * _ODD[2] + wide[2:] * _ODD[0]
            hashes = [one * _ODD[1], two * _ODD[2], three * _ODD[1]]
        fine = [letter[:n], letter[:n] | letter[1 : n + 1], letter[1 : n + 1] & (letter[:n] | letter[2 : n + 2])]
        for h, good in zip(hashes, fine):
            total += np.bincount((h[:n][good] >> shift).astype(np.int64), minlength=size)
    return total


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Small blocks of rows with the counts of each text."""
    for whole in batches:
        for batch in slices(whole, "text"):
            for begin in range(0, batch.num_rows, _BLOCK):
                block = batch.slice(begin, _BLOCK)
                yield block, [gram_counts(text or "") for text in block.column("text").to_pylist()]


def size_class(counts: np.ndarray) -> np.ndarray:
    """0 for no n-gram, else one more than the binary logarithm of their number."""
    return np.minimum(np.frexp(counts.sum(axis=1).astype(np.float64))[1], _SIZES - 1)


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of ``(1 + ln tf) * idf`` with length 1; a row without n-grams stays zero."""
    weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    length = np.sqrt((weights * weights).sum(axis=1, keepdims=True))
    return weights / np.maximum(length, np.float32(1e-30))


@dataclass
class Model:
    """``centroids[i]`` belongs to ``langs[of[i]]``; ``limit`` is the distance a text of a size class may have."""

    langs: list[str]
    idf: np.ndarray
    of: np.ndarray
    centroids: np.ndarray
    limit: np.ndarray


def learning_rows(docs: DataFrame, learn: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(learn.alias("learn"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    return rows.where("learn AND lang IS NOT NULL").select("lang", "text")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket of a task: how many texts have it; bucket -1 counts the texts."""
    found, texts = np.zeros(1 << BITS, dtype=np.int64), 0
    for _, counts in _texts(batches):
        for c in counts:
            found += c > 0
            texts += bool(c.any())
    used = np.flatnonzero(found)
    buckets, values = np.append(used, -1), np.append(found[used], texts)
    yield pa.record_batch([pa.array(buckets, pa.int32()), pa.array(values, pa.int64())], ["bucket", "n"])


def inverse_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """idf per bucket over all rows, and the number of texts with a letter."""
    partial = rows.select("text").mapInArrow(_frequencies, "bucket int, n long")
    counts = {r["bucket"]: r["n"] for r in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = counts.pop(-1, 0)
    frequency = np.zeros(1 << BITS)
    frequency[list(counts)] = list(counts.values())
    return (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32), total


def sample(rows: DataFrame, most: int, most_langs: int) -> tuple[DataFrame, list[str]]:
    """``lang, text``: about ``most`` distinct texts of each of the commonest languages, or all of them if they are fewer."""
    common = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs).collect()
    if not common:
        return rows.limit(0), []
    share = F.create_map(*[F.lit(x) for r in common for x in (r["lang"], min(1.0, most / r["n"]))])
    at = F.pmod(F.xxhash64("lang", "text"), F.lit(1 << 32)) / float(1 << 32)
    picked = rows.where(at < F.try_element_at(share, "lang")).withColumn("digest", F.sha2("text", 256))
    # copies of a text are spread by number before one of them is taken
    return picked.dropDuplicates(["lang", "digest"]).select("lang", "text"), sorted(r["lang"] for r in common)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, counts in _texts(batches):
        rows = [i for i, c in enumerate(counts) if c.any()]
        used = [np.flatnonzero(counts[i]) for i in rows]
        yield pa.record_batch(
            [
                pa.array([block.column("lang")[i].as_py() for i in rows], pa.string()),
                pa.array([u.astype(np.int32).tobytes() for u in used], pa.binary()),
                pa.array([counts[i][u].tobytes() for i, u in zip(rows, used)], pa.binary()),
            ],
            ["lang", "buckets", "counts"],
        )


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, _BLOCK):
            block = batch.slice(begin, _BLOCK)
            counts = np.zeros((block.num_rows, 1 << BITS), dtype=np.int64)
            for i, (b, c) in enumerate(zip(block.column("buckets").to_pylist(), block.column("counts").to_pylist())):
                counts[i, np.frombuffer(b, np.int32)] = np.frombuffer(c, np.int64)
            yield block.column("lang").to_pylist(), counts


def _members(sent, measure: bool):
    """Sums of a task's members per centroid, or with ``measure`` the distances to the own language per size class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        number = {lang: i for i, lang in enumerate(model.langs)}
        sums: dict[int, np.ndarray] = {}
        spread = np.zeros((_SIZES, 3))
        for langs, counts in _dense(batches):
            rows = unit_rows(counts, model.idf)
            cosine = rows @ model.centroids.T
            own = np.array([number[x] for x in langs])[:, None] == model.of[None, :]
            cosine = np.where(own, cosine, -2)
            best = cosine.argmax(axis=1)
            if measure:
                away = 1 - cosine[np.arange(len(rows)), best].astype(np.float64)
                np.add.at(spread, size_class(counts), np.column_stack([np.ones(len(rows)), away, away * away]))
            else:
                for c in np.unique(best):
                    total = rows[best == c].sum(axis=0, dtype=np.float64)
                    sums[int(c)] = sums[int(c)] + total if int(c) in sums else total
        values = {int(s): spread[s] for s in np.flatnonzero(spread[:, 0])} if measure else sums
        yield pa.record_batch(
            [pa.array(list(values), pa.int32()), pa.array([v.tobytes() for v in values.values()], pa.binary())], ["key", "part"]
        )

    return run


def _add(group: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(p, np.float64) for p in group.column("part").to_pylist()], axis=0)
    return pa.table([group.column("key").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["key", "part"])


def _totals(vectors: DataFrame, model: Model, measure: bool) -> dict[int, np.ndarray]:
    """What ``_members`` gives, added up per key; a key has one row per task."""
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    partial = vectors.coalesce(_TASKS).mapInArrow(_members(sent, measure), "key int, part binary")
    rows = partial.groupBy("key").applyInArrow(_add, "key int, part binary").collect()
    return {r["key"]: np.frombuffer(r["part"], np.float64) for r in rows}


def _scaled(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-30)).astype(np.float32)


def first_centroids(vectors: DataFrame, model: Model, clusters: int) -> Model:
    """The texts of a language with the smallest hashes are its first centroids, in every run the same."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("buckets", "counts"), "buckets", "counts")
    seeds = vectors.withColumn("place", F.row_number().over(order)).where(F.col("place") <= clusters).collect()
    centroids, of = [], []
    for seed in sorted(seeds, key=lambda r: (r["lang"], r["place"])):
        counts = np.zeros((1, 1 << BITS), dtype=np.int64)
        counts[0, np.frombuffer(bytes(seed["buckets"]), np.int32)] = np.frombuffer(bytes(seed["counts"]), np.int64)
        centroids.append(unit_rows(counts, model.idf)[0])
        of.append(model.langs.index(seed["lang"]))
    width = 1 << BITS
    return Model(model.langs, model.idf, np.array(of, dtype=np.int64), np.array(centroids, np.float32).reshape(-1, width), model.limit)


def train(docs: DataFrame, learn: Column, clusters: int = CLUSTERS, rounds: int = ROUNDS, most: int = MOST,
          most_langs: int = MOST_LANGS, reach: float = REACH) -> Model:
    """Fit centroids to the rows of ``docs`` where ``learn`` holds and a language is given."""
    spark = docs.sparkSession
    rows = learning_rows(docs, learn)
    idf, _ = inverse_frequencies(rows)
    picked, langs = sample(rows, most, most_langs)
    model = Model(langs, idf, np.empty(0, np.int64), np.empty((0, 1 << BITS), np.float32), np.full(_SIZES, 2.0))
    if not langs:
        return model
    path = fresh_path(spark, "language-sample")
    picked.mapInArrow(_vectors, "lang string, buckets binary, counts binary").write.parquet(path)
    vectors = spark.read.parquet(path)
    model = first_centroids(vectors, model, clusters)
    for _ in range(rounds if len(model.of) else 0):
        for key, total in _totals(vectors, model, False).items():
            model.centroids[key] = _scaled(total[None, :])[0]
    spread = _totals(vectors, model, True) if len(model.of) else {}
    limit = 2.0
    for size in range(_SIZES - 1, -1, -1):
        # a class with few texts takes the limit of the next larger class with many, the classes above all of them that of the largest
        n, total, squares = spread[size] if size in spread else (0, 0, 0)
        if n >= 20:
            limit = total / n + reach * np.sqrt(max(squares / n - (total / n) ** 2, 0.0)) + 1e-3
            if np.all(model.limit[size + 1 :] == 2.0):
                model.limit[size + 1 :] = limit
        model.limit[size] = limit
    return model


def _predict(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for block, counts in _texts(batches):
            counts = np.array(counts).reshape(block.num_rows, 1 << BITS)
            known = counts.any(axis=1) & (len(model.of) > 0)
            lang = np.full(block.num_rows, UNKNOWN, dtype=object)
            score, rejected = np.zeros(block.num_rows), np.ones(block.num_rows, dtype=bool)
            if known.any():
                cosine = unit_rows(counts[known], model.idf) @ model.centroids.T
                best = cosine.argmax(axis=1)
                near = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0.0, 1.0)
                lang[known] = [model.langs[i] for i in model.of[best]]
                score[known], rejected[known] = near, 1 - near > model.limit[size_class(counts[known])]
            yield pa.record_batch(
                [block.column("doc_id"), block.column("held_out"), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return run


def held_out() -> Column:
    return crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(sent), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
