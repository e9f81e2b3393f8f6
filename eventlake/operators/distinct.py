"""Event type totals and distinct counts that can be added up, so that no old event is read again.

Exact distinct counts cannot be added, but the set of (type, entity) pairs seen so far can grow: a batch sends in its own
distinct pairs and only those that no earlier batch had are stored. Counting pairs then counts entities. Event counts and
first and last times are kept per file and type. Beside them are HyperLogLog sketches of actors and repositories per file and type; merging them gives approximate counts for any set of
files without the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions import event_description, percent

ENTITIES = {"actor": "actor_id", "repo": "repo_id"}
SKETCH_BITS = 12

TYPE_COUNTS = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("first_occurrence", T.TimestampNTZType()),
        T.StructField("last_occurrence", T.TimestampNTZType()),
        T.StructField("actor_sketch", T.BinaryType()),
        T.StructField("repo_sketch", T.BinaryType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)
TYPE_ENTITIES = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("entity_id", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)


def type_counts(events: DataFrame) -> DataFrame:
    """One row per file and type; combined before the shuffle, so a dominant type is one row per task and file."""
    return (
        events.where(F.col("event_type").isNotNull())
        .groupBy("event_type", "source_file")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min("created_at").alias("first_occurrence"),
            F.max("created_at").alias("last_occurrence"),
            *[F.hll_sketch_agg(c, F.lit(SKETCH_BITS)).alias(f"{k}_sketch") for k, c in ENTITIES.items()],
        )
        .select(*TYPE_COUNTS.names[:-1])
    )


def type_entities(events: DataFrame) -> DataFrame:
    """Distinct ``event_type, kind, entity_id``; a row per event and kind goes in, distinct ones leave each task."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("entity_id")) for k, c in ENTITIES.items()])
    pairs = events.where(F.col("event_type").isNotNull()).select("event_type", F.inline(kinds))
    return pairs.where(F.col("entity_id").isNotNull()).distinct()


def unseen(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs that are not known yet. The join goes by type and entity together, so no type is hot."""
    keys = ["event_type", "kind", "entity_id"]
    return pairs.join(known.select(*keys), keys, "left_anti").select(*keys)


def _totals(counts: DataFrame, *more: Column) -> DataFrame:
    return counts.groupBy("event_type").agg(
        F.sum("event_count").alias("event_count"),
        F.min("first_occurrence").alias("first_occurrence"),
        F.max("last_occurrence").alias("last_occurrence"),
        *more,
    )


def _finished(types: DataFrame) -> DataFrame:
    total = F.sum("event_count").over(Window.partitionBy())
    return types.select(
        "event_type",
        "event_count",
        "unique_actors",
        "unique_repos",
        "first_occurrence",
        "last_occurrence",
        percent(F.col("event_count"), total).alias("percent_of_total_events"),
        event_description("event_type").alias("event_description"),
    )


def event_types(counts: DataFrame, entities: DataFrame) -> DataFrame:
    """What :func:`eventlake.plans.staging.stg_event_types` gives for all events, from the two stored tables."""
    unique = entities.groupBy("event_type").agg(
        *[F.count_if(F.col("kind") == k).alias(f"unique_{k}s") for k in ENTITIES]
    )
    joined = _totals(counts).join(unique, "event_type", "left")
    filled = {f"unique_{k}s": F.coalesce(F.col(f"unique_{k}s"), F.lit(0)) for k in ENTITIES}
    return _finished(joined.withColumns(filled))


def approximate_event_types(counts: DataFrame) -> DataFrame:
    """The same with approximate distinct counts, from the sketches of any set of files; no pairs are read.

    Counts are off by a few parts in ``2 ** (SKETCH_BITS / 2)``.
    """
    merged = [F.hll_sketch_estimate(F.hll_union_agg(f"{k}_sketch")).alias(f"unique_{k}s") for k in ENTITIES]
    return _finished(_totals(counts, *merged))
