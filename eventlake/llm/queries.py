"""Registered queries of this package: each operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    ctw,
    fill_in_middle,
    language_id,
    mixing,
    near_dedup,
    packing,
    pivot_index,
    quality_classifier,
    quality_rules,
    secret_scan,
    token_counts,
    url_filter,
    vector_codes,
)
from eventlake.llm.text import texts_of, word_count
from eventlake.session import configure, fresh_path

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [
    url_filter.Rule("org/", "allow"),
    url_filter.Rule("example.org/es/", "block"),
    url_filter.Rule("example.org/en/1", "block"),
    url_filter.Rule("com/fr/", "allow"),
    url_filter.Rule("com/de/", "block"),
]
WEIGHTS, SHARE, SEED = [3, 1, 2], 1.5, 20240131


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, with the session set up for batches of bounded size."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's length is its words and one end mark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (word_count(F.col("text")) + 1).alias("length"))
    return packing.pack(docs)


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = texts_of(table(spark, sf_dir, "documents"))
    found = secret_scan.scan_documents(texts, fresh_path(spark, "secret-ledger"))
    return secret_digest(found)


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of ``doc_id, spans``."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, secret_scan.BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return pivot_index.top_k(vectors, F.col("vec_id") % 20 == 0)


def quality_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.score_documents(docs, quality_classifier.train(docs, labels))


def quality_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        *quality_rules.LIMITS,
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"), 0.85).drop("node")


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        word_count(F.col("text")).alias("size"),
        F.lit(None).cast("string").alias("tag"),
    )
    rows = mixing.row_copies(mixing.plan_mix(sizes, WEIGHTS, SHARE, SEED))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken, "source", "copies")


def token_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, fresh_path(spark, "token-cache"), tokenizer_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def language_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs, ~language_id.held_out()))


def code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def fill_in_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fill_in_middle.write_store(table(spark, sf_dir, "documents"), fresh_path(spark, "text-frames"))
    return fill_in_middle.digests(fill_in_middle.transform(store))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": url_filters,
        "op2_best_fit_packing": best_fit_packing,
        "op3_lm_scoring": lm_scoring,
        "op4_secret_scans": secret_scans,
        "op5_exact_top_k": vector_search,
        "op6_quality_classifier": quality_classes,
        "op7_quality_rules": quality_filters,
        "op8_near_duplicates": near_duplicates,
        "op9_source_mixing": source_mixing,
        "op10_token_counts": token_counting,
        "op11_language_id": language_ids,
        "op12_code_compression": code_compression,
        "op13_fill_in_middle": fill_in_middles,
    }
