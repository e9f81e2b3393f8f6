"""Quality rules with thresholds learned per language and source from mergeable quantile sketches.

Fixed cutoffs are replaced by fences around what is usual in a group: the upper fence of a measure is the 75th
percentile plus its reach times the distance to the 25th, the lower fence the 25th less as much. Nothing else decides: a group
of short words has another fence than one of long words. Where half of a group is alike the distance counts as the measure's
slack, so that a group without any symbols does not drop a document for its first one. Percentiles come from
sketches: counts per bucket, where a value keeps its BITS leading binary digits, so a bucket is within one
part in ``2 ** (BITS - 1)`` of its values. Counts of buckets add up, so sketches of partitions, sources and languages merge
exactly, in any order. A group with fewer than MIN_ROWS documents takes the fences of its language, and a language
with fewer those of all documents. The fences are joined to the documents, which are then filtered.

All measures are whole numbers, so any engine gets the same fences.

Defined results: null and empty texts have no words and fail the base rule. Null languages and sources are groups
of their own. Repeated rows are judged alike and all kept or all dropped. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.text import GAP
from eventlake.session import fresh_path

WINDOW_WORDS = 5
BITS = 7
MIN_ROWS = 50


class Fence(NamedTuple):
    reach: int
    slack: int
    both: bool  # also a lower fence


MEASURES = {
    "word_length": Fence(6, 4, True),  # hundredths
    "length_class": Fence(4, 4, True),  # words, in eighths of a doubling
    "symbol_rate": Fence(6, 5, False),  # per thousand characters
    "dup_line_rate": Fence(6, 60, False),  # per thousand lines with a word
    "repeat_rate": Fence(6, 25, False),  # per thousand words
}
LIMITS = [f"{side}_{m}" for m, fence in MEASURES.items() for side in (("max", "min") if fence.both else ("max",))]


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` per document.

    Lines without a word do not count.

    Works inside each row: windows of five words are told apart by a 64-bit hash, sorted with their places, and
    a place is repeated if a neighbour in that order has the same hash.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        F.length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.transform(F.array_remove(F.split("text", GAP), ""), lambda w: F.xxhash64(w)).alias("words"),
    )
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW_WORDS)
    windows = F.transform(
        starts, lambda i: F.struct(F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW_WORDS)]).alias("h"), i.alias("at"))
    )
    windows = F.when(F.size("words") >= WINDOW_WORDS, F.sort_array(windows)).otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))
    rows = rows.select("*", windows.alias("windows"))
    def repeated(x: Column, i: Column) -> Column:
        return F.get("windows", i - 1)["h"].eqNullSafe(x["h"]) | F.get("windows", i + 1)["h"].eqNullSafe(x["h"])

    twice = F.filter("windows", repeated)
    rows = rows.select("*", F.sort_array(F.transform(twice, lambda x: x["at"])).alias("places"))
    # a repeated window covers its words up to the next repeated window
    covered = F.aggregate(
        F.transform(
            "places",
            lambda at, i: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get("places", i + 1) - at, F.lit(WINDOW_WORDS))),
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        covered.alias("n_repeat_words"),
    )


def rates(measured: DataFrame) -> DataFrame:
    """Add the measures that have fences, as whole numbers.

    The length class of ``n`` words is eight times the binary digits behind the first, plus the next three digits as a number.
    """
    return measured.withColumns(
        {
            "word_length": F.expr("100 * word_chars div greatest(n_words, 1)"),
            "length_class": F.expr("8 * (length(bin(n_words)) - 1) + greatest(shiftright(8 * n_words, length(bin(n_words)) - 1) - 8, 0)"),
            "symbol_rate": F.expr("1000 * n_symbols div greatest(word_chars, 1)"),
            "dup_line_rate": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
            "repeat_rate": F.expr("1000 * n_repeat_words div greatest(n_words, 1)"),
        }
    )


def bucket(value: Column) -> Column:
    """The value with all but its BITS leading binary digits set to zero."""
    drop = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketch(rated: DataFrame) -> DataFrame:
    """``lang, source, measure, bucket, n``: how many documents of a group have a measure in a bucket."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES])
    rows = rated.select("lang", "source", F.explode(values).alias("v"))
    return rows.groupBy("lang", "source", "v.measure", "v.bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of larger groups: those of the given keys, added up."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group of the keys: ``rows`` and the fences of LIMITS.

    A window sees the buckets of one group and measure: at most ``64 * 2 ** BITS`` rows.
    """
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(group.orderBy("bucket"))
    rows = sketches.select(*keys, "measure", "bucket", upto.alias("upto"), F.sum("n").over(group).alias("rows"))
    found = rows.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        F.min(F.when(F.col("upto") * 4 >= F.col("rows"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("rows") * 3, F.col("bucket"))).alias("q3"),
    )
    parts = []
    for limit in LIMITS:
        side, measure = limit.split("_", 1)
        fence = MEASURES[measure]
        away = fence.reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(fence.slack))
        bound = F.col("q3") + away if side == "max" else F.col("q1") - away
        parts.append(F.max(F.when(F.col("measure") == measure, bound)).cast("long").alias(limit))
    return found.groupBy(*keys).agg(F.max("rows").alias("rows"), *parts)


def judge(docs: DataFrame) -> DataFrame:
    """The measures per document with ``base_failed`` and ``kept``, and the fences that held for it.

    Measures, sketches and fences are written once and read again, so that texts are read once.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "quality-measures")
    measures(docs).write.parquet(path)
    rated = rates(spark.read.parquet(path))
    path = fresh_path(spark, "quality-sketches")
    sketch(rated).write.parquet(path)
    by_source = spark.read.parquet(path)
    by_lang = merge(by_source, ["lang"])
    fine = fences(by_source, ["lang", "source"]).where(F.col("rows") >= MIN_ROWS).alias("fine")
    coarse = fences(by_lang, ["lang"]).where(F.col("rows") >= MIN_ROWS).alias("coarse")
    whole = fences(merge(by_lang, []), []).alias("whole")
    # one row per group first: the fences each group takes
    groups = by_source.select("lang", "source").distinct().alias("g")
    groups = groups.join(
        fine, F.col("g.lang").eqNullSafe(F.col("fine.lang")) & F.col("g.source").eqNullSafe(F.col("fine.source")), "left"
    )
    groups = groups.join(coarse, F.col("g.lang").eqNullSafe(F.col("coarse.lang")), "left")
    everything = [F.lit(v).cast("long") for v in (whole.first() or [None] * (len(LIMITS) + 1))[1:]]
    chosen = groups.select(
        F.col("g.lang").alias("of_lang"),
        F.col("g.source").alias("of_source"),
        *[
            F.coalesce(F.col(f"fine.{limit}"), F.col(f"coarse.{limit}"), everything[i]).alias(limit)
            for i, limit in enumerate(LIMITS)
        ],
    )
    path = fresh_path(spark, "quality-fences")
    chosen.write.parquet(path)
    chosen = spark.read.parquet(path)
    same = rated["lang"].eqNullSafe(chosen["of_lang"]) & rated["source"].eqNullSafe(chosen["of_source"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    sides = [limit.split("_", 1) for limit in LIMITS]
    inside = [F.col(m) <= F.col(f"max_{m}") if side == "max" else F.col(m) >= F.col(f"min_{m}") for side, m in sides]
    within = reduce(lambda a, b: a & b, inside)
    return (
        rated.join(chosen, same, "left")
        .drop("of_lang", "of_source")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & within)
    )
