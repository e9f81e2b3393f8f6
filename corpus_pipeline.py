"""Documents to packed training sequences: five stages, each written as Parquet and read by the next.

A stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one before it kept. All but the last return the
columns of ``documents``. The result is one row per packed piece of a document, with its text.

In every stage an empty table gives an empty one, and further columns of any name are kept as they are until the last stage,
which leaves them out. A null text counts as an empty one and no text is cut, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import mixing, near_dedup, packing, quality_classifier, secret_scan
from eventlake.llm.queries import SEED, SHARE, WEIGHTS, table
from eventlake.llm.text import word_count
from eventlake.session import fresh_path

SIMILARITY = 0.8
# a word with the white space around it, or a text of white space alone, so that pieces put together give the text again
PIECE = (
    r"^[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
    r"|^[\x20\x09-\x0D]+"
)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, fitted to the labels of these documents.

    An empty text is judged by the model's bias. Repeated rows are judged alike; without labels of both classes all are kept.
    """
    labels = table(spark, sf_dir, "labels")
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, of repeated ids one row.

    Texts without words, empty ones and nulls are nobody's copies. Rows without an id are kept.
    """
    return near_dedup.keep_one(docs, SIMILARITY)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; null texts stay null, repeated rows stay."""
    clean = secret_scan.redact_documents(docs, fresh_path(spark, "secret-ledger"))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; null is a source of its own.

    Texts without words have size nothing, so the mix takes or leaves them freely. Repeated rows are taken one by one.
    """
    return mixing.mix_documents(docs, word_count(F.col("text")), WEIGHTS, SHARE, SEED)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins; each document ends with a mark, an empty word that counts as one.

    An empty or null text is that mark alone, a text of white space is one piece and the mark. Repeated rows are packed one by one.
    """
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(PIECE), F.lit(0))
    words = F.array_append(words, F.lit(""))
    rows = docs.select("doc_id", words.alias("words"))
    return packing.pack(rows.select("doc_id", "words", F.size("words").cast("long").alias("length")))


STAGES = [
    ("quality_classifier", keep_quality),
    ("near_dedup", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# a trained classifier and random rounding are not SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
