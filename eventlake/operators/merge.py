"""Key-based merging and deduplication of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """MERGE on a unique key: source rows replace matching target rows, others are inserted."""
    kept = target.join(source.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(source)


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each key to one row inside every map task (WindowGroupLimit) before it shuffles,
    so even a key that holds a large share of all rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedup_by_key(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Keep the most recently loaded row of every key."""
    order = [F.col("loaded_at").desc_nulls_last(), F.col("source_file").asc_nulls_last()]
    return latest_per_key(df, key, order)


def newer_than_loaded(source: DataFrame, target: DataFrame, begin: str) -> DataFrame:
    """Source rows loaded after the newest row of the target (strictly)."""
    mark = target.agg(
        F.coalesce(F.max("loaded_at"), F.lit(begin).cast("timestamp_ntz")).alias("high_water")
    )
    return source.where(F.col("loaded_at") > mark.scalar())


def overlapping(source: DataFrame, target: DataFrame, begin: str, hours: int) -> DataFrame:
    """Source rows created within ``hours`` of the target's newest event, or later."""
    newest = F.max("created_at") - F.make_interval(hours=F.lit(hours))
    mark = target.agg(
        F.coalesce(newest.cast("timestamp_ntz"), F.lit(begin).cast("timestamp_ntz")).alias("mark")
    )
    return source.where(F.col("created_at") > mark.scalar())
