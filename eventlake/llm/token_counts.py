"""Token counts through a cache of digests.

A text is looked up by the digest of its content together with the digest of the tokenizer's file. Only
contents that the cache lacks are encoded, each once, and their counts are appended; then every document
takes its count from the cache. A new tokenizer file has a new digest, so old counts are never mixed in.

Content is normalised as far as counts allow: null becomes the empty text and bytes are UTF-8. Anything
more (case, white space, Unicode forms) would change the count.

Defined results: null and empty texts have 0 bytes and 0 tokens and are cached like any other. Repeated
rows are all kept and share one cache entry. An empty table appends nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.text import slices, texts_of
from eventlake.sources.tables import path_exists

CACHE = "tokenizer binary, digest binary, n_tokens long"
# The pre-tokenizer's pattern, a fixed value of the byte-level vocabularies (``public_tokenizers.PATTERN``).
PIECE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MEMO_PIECES = 300_000


def file_digest(path: str) -> bytes:
    """SHA-256 of a tokenizer file; it stands for the tokenizer's version."""
    with open(path, "rb") as handle:
        return hashlib.file_digest(handle, "sha256").digest()


class PieceCounter:
    """Counts tokens with the tokenizers library, remembering the counts of pieces it has seen.

    A byte-level tokenizer cuts a text into pieces and encodes each on its own, so a text's count is
    the sum over its pieces, and each distinct piece goes to the library once. That needs the library's cut:
    it is reproduced for texts of Latin letters and common signs; texts with a special token or any
    other character go to the library whole. Tokenizers of another kind always get whole texts.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        steps = str(self.tokenizer.pre_tokenizer)
        byte_level = steps.startswith("ByteLevel(") and "add_prefix_space=False" in steps and "use_regex=True" in steps
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        other = "|".join([r"[^\x09-\x0D\x20-\x7E\xA0-ɏ‐-‟•…]", *map(regex.escape, special)])
        self.needs_library = regex.compile(other)
        self.pieces = regex.compile(PIECE).findall
        self.by_piece = byte_level and self.tokenizer.normalizer is None
        self.memo: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if not self.by_piece or self.needs_library.search(text):
            return self.whole([text])[0]
        memo, total, new = self.memo, 0, Counter()
        for piece, times in Counter(self.pieces(text)).items():
            known = memo.get(piece)
            if known is None:
                new[piece] = times
            else:
                total += known * times
        if new:
            counts = self.whole(list(new))
            total += sum(map(int.__mul__, counts, new.values()))
            if len(memo) + len(new) > _MEMO_PIECES:
                memo.clear()
            if len(new) <= _MEMO_PIECES:
                memo.update(zip(new, counts))
        return total


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        counter = None
        for whole in batches:
            counter = counter or PieceCounter(path)
            for batch in slices(whole, "text"):
                counts = [counter.count(text) for text in batch.column("text").to_pylist()]
                yield pa.record_batch([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def cached_counts(spark, cache_path: str, version: bytes) -> DataFrame:
    """``digest, n_tokens`` stored for one tokenizer version; empty before the first append."""
    if path_exists(spark, cache_path):
        cache = spark.read.schema(CACHE).parquet(cache_path)
    else:
        cache = spark.createDataFrame([], CACHE)
    return cache.where(F.col("tokenizer") == F.lit(version)).select("digest", "n_tokens")


def append_misses(docs: DataFrame, cache_path: str, tokenizer_file: str) -> None:
    """Encode the distinct contents the cache lacks and append their counts.

    One document stands for all of the same content. Texts are dealt out by content and document, so
    thousands of copies of one text do not meet in a task. Two appends that run at once may both add
    an entry; counts are equal, and readers take one.
    """
    version = file_digest(tokenizer_file)
    texts = texts_of(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    chosen = texts.groupBy("digest").agg(F.min("doc_id").alias("chosen"))
    missing = chosen.join(cached_counts(docs.sparkSession, cache_path, version), "digest", "left_anti")
    same = (texts["digest"] == missing["digest"]) & texts["doc_id"].eqNullSafe(missing["chosen"])
    distinct = texts.join(missing, same, "left_semi").select("digest", "text")
    counts = distinct.mapInArrow(_encode(tokenizer_file), "digest binary, n_tokens long")
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counts.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path)


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_file: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, digest`` per document; fills the cache first."""
    append_misses(docs, cache_path, tokenizer_file)
    counts = cached_counts(docs.sparkSession, cache_path, file_digest(tokenizer_file))
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    keyed = texts_of(docs).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    return keyed.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), F.hex("digest").alias("digest")
    )
