"""Staging models: raw JSON documents to typed rows, actors, repositories and event types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import boundary_diff, classify_actor, event_description, percent
from eventlake.sources.ndjson import has_field


def _path(path: str, type_name: str, document: str = "raw_data") -> Column:
    """Typed value at a JSON path; NULL when absent, JSON null or of another type."""
    return F.try_variant_get(document, f"$.{path}", type_name)


def event_fields() -> list[Column]:
    """The typed fields of one event document."""
    return [
        _path("id", "string").alias("event_id"),
        _path("type", "string").alias("event_type"),
        _path("actor.id", "bigint").alias("actor_id"),
        _path("actor.login", "string").alias("actor_login"),
        _path("actor.type", "string").alias("actor_type"),
        _path("repo.id", "bigint").alias("repo_id"),
        _path("repo.name", "string").alias("repo_name"),
        _path("created_at", "timestamp_ntz").alias("created_at"),
        _path("payload", "variant").alias("payload"),
    ]


def stg_events(raw: DataFrame) -> DataFrame:
    """One typed row per raw event whose ``id`` and ``created_at`` keys are present.

    Everything downstream reads this table instead of the documents: once it is stored as
    Parquet, column pruning and filter pushdown work, which they cannot inside JSON.
    """
    return raw.where(has_field("id") & has_field("created_at")).select(
        *event_fields(), F.col("file_name").alias("source_file"), F.col("load_ts").alias("loaded_at")
    )


def with_actor_class(events: DataFrame) -> DataFrame:
    """Fill in the missing actor types."""
    return events.withColumn("actor_type", classify_actor("actor_type", "actor_login"))


def _newest_first(last_at: str) -> Column:
    """Sort value that is smallest for the newest time and largest without one."""
    return F.coalesce(-F.unix_micros(F.col(last_at).cast("timestamp")), F.lit((1 << 63) - 1))


def stg_actors(events: DataFrame) -> DataFrame:
    """One row per actor: first and last event, and the login and type of the latest event.

    Step one collapses events to distinct (actor, login, type) with fixed-width hash aggregation,
    combined before the shuffle; step two only sees those few rows, so an actor with a large share
    of all events costs nothing extra. On equal times the smaller login wins.
    """
    versions = (
        with_actor_class(events)
        .where(F.col("actor_id").isNotNull() & F.col("actor_login").isNotNull())
        .groupBy("actor_id", "actor_login", "actor_type")
        .agg(F.min("created_at").alias("first_seen_at"), F.max("created_at").alias("last_seen_at"))
    )
    return merge_actors(versions)


def merge_actors(parts: DataFrame) -> DataFrame:
    """Combine actor rows of several event sets, as if staged from all the events at once.

    Every input row states a login and type that were valid at its ``last_seen_at``. Merging a
    part twice changes nothing, so a repeated load is harmless.
    """
    latest = F.min(F.struct(_newest_first("last_seen_at").alias("age"), "actor_login", "actor_type"))
    return (
        parts.groupBy("actor_id")
        .agg(
            latest.alias("latest"),
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
        )
        .select(
            "actor_id",
            "latest.actor_login",
            "latest.actor_type",
            "first_seen_at",
            "last_seen_at",
            boundary_diff("day", "first_seen_at", "last_seen_at").alias("days_active"),
        )
    )


def stg_repositories(events: DataFrame) -> DataFrame:
    """One row per repository: first and last event, latest name split into owner and short name."""
    versions = (
        events.where(F.col("repo_id").isNotNull() & F.col("repo_name").isNotNull())
        .groupBy("repo_id", "repo_name")
        .agg(F.min("created_at").alias("first_event_at"), F.max("created_at").alias("last_event_at"))
    )
    return merge_repositories(versions)


def merge_repositories(parts: DataFrame) -> DataFrame:
    """Combine repository rows of several event sets; see :func:`merge_actors`."""
    latest = F.min(F.struct(_newest_first("last_event_at").alias("age"), "repo_name"))
    return (
        parts.groupBy("repo_id")
        .agg(
            latest.alias("latest"),
            F.min("first_event_at").alias("first_event_at"),
            F.max("last_event_at").alias("last_event_at"),
        )
        .select(
            "repo_id",
            "latest.repo_name",
            F.split_part("latest.repo_name", F.lit("/"), F.lit(1)).alias("repo_owner"),
            F.split_part("latest.repo_name", F.lit("/"), F.lit(2)).alias("repo_short_name"),
            "first_event_at",
            "last_event_at",
            boundary_diff("day", "first_event_at", "last_event_at").alias("days_active"),
        )
    )


def stg_event_types(events: DataFrame) -> DataFrame:
    """One row per event type with counts, share of all events and a description.

    Spark aggregates by (type, actor) and (type, repository) before it groups by type, so a
    dominant type is spread over many tasks. The window runs over one row per type.
    """
    types = (
        events.where(F.col("event_type").isNotNull())
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("actor_id").alias("unique_actors"),
            F.countDistinct("repo_id").alias("unique_repos"),
            F.min("created_at").alias("first_occurrence"),
            F.max("created_at").alias("last_occurrence"),
        )
    )
    total = F.sum("event_count").over(Window.partitionBy())
    return types.select(
        "*",
        percent(F.col("event_count"), total).alias("percent_of_total_events"),
        event_description("event_type").alias("event_description"),
    )


def payload_fields(raw: DataFrame) -> DataFrame:
    """Type-specific values from the payload and the repository URL; NULL where absent."""
    return raw.where(has_field("id") & has_field("created_at")).select(
        _path("id", "string").alias("event_id"),
        _path("type", "string").alias("event_type"),
        _path("payload.size", "bigint").alias("push_size"),
        _path("payload.pull_request.id", "bigint").alias("pull_request_id"),
        _path("payload.issue.id", "bigint").alias("issue_id"),
        _path("payload.action", "string").alias("issue_action"),
        _path("repo.url", "string").alias("repo_url"),
    )
