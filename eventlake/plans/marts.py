"""Star schema: the event fact, three dimensions, incremental builds and actor history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.functions import (
    boundary_diff,
    calendar_columns,
    event_category,
    fixed,
    is_test_repository,
    surrogate_key,
    trunc_ts,
)
from eventlake.operators.merge import newer_than_loaded, overlapping, upsert_by_key
from eventlake.plans.staging import (
    merge_repositories,
    stg_repositories,
    with_actor_class,
)
from eventlake.schemas import DIM_ACTOR, FACT_EVENTS
from eventlake.session import fresh_path
from eventlake.sources import layout, tables


def _ts(value: datetime | str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _stamps(as_of: datetime) -> list[Column]:
    return [_ts(as_of).alias("created_ts"), _ts(as_of).alias("updated_ts")]


# --- fact -----------------------------------------------------------------------------------


def fact_events(events: DataFrame, as_of: datetime) -> DataFrame:
    """Events with surrogate keys and calendar attributes.

    Keys are hashes of the natural ids, so no join with a dimension is needed and the plan is a
    single narrow stage.
    """
    return events.where(F.col("event_id").isNotNull() & F.col("created_at").isNotNull()).select(
        surrogate_key("event_id").alias("event_key"),
        "event_id",
        surrogate_key("actor_id").alias("actor_key"),
        surrogate_key("repo_id").alias("repo_key"),
        surrogate_key("event_type").alias("event_type_key"),
        "event_type",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        "created_at",
        *[c.alias(name) for name, c in calendar_columns("created_at").items()],
        "source_file",
        "loaded_at",
        _ts(as_of).alias("created_ts"),
    )


def fact_events_incremental(target: DataFrame, events: DataFrame, as_of: datetime) -> DataFrame:
    """Target after merging the events loaded since its newest row."""
    fresh = newer_than_loaded(events, target, fixed.BEGIN_OF_TIME)
    return upsert_by_key(target, fact_events(fresh, as_of), "event_id")


def fact_events_overlap(
    target: DataFrame, events: DataFrame, as_of: datetime, hours: int = 2
) -> DataFrame:
    """Like the incremental build, but reprocesses ``hours`` of event time for late rows."""
    recent = overlapping(events, target, fixed.BEGIN_OF_TIME, hours)
    return upsert_by_key(target, fact_events(recent, as_of), "event_id")


def newer_than_stored(events: DataFrame, stored: DataFrame) -> DataFrame:
    """Events less those of which the stored fact has a copy that was loaded later.

    An event's date is fixed, so only the dates of the events are read: one small value per date.
    """
    dates = [row[0] for row in events.select(F.to_date("created_at")).distinct().collect()]
    there = stored.where(F.col("event_date").isin([d for d in dates if d is not None]))
    there = there.select("event_id", F.col("loaded_at").alias("at"), F.col("source_file").alias("file"))
    later = (F.col("at") > F.col("loaded_at")) | (
        (F.col("at") == F.col("loaded_at")) & (F.col("file") < F.col("source_file"))
    )
    newer = events.join(there, "event_id").where(later).select("event_id")
    return events.join(newer, "event_id", "left_anti").select(*events.columns)


def fact_push_events(raw: DataFrame) -> DataFrame:
    """Push events with their commit and branch measures."""

    def value(path: str, kind: str) -> Column:
        return F.try_variant_get("raw_data", f"$.{path}", kind)

    ref = value("payload.ref", "string")
    return (
        raw.where(value("type", "string") == "PushEvent")
        .select(
            value("id", "string").alias("event_id"),
            value("actor.id", "bigint").alias("actor_id"),
            value("repo.id", "bigint").alias("repo_id"),
            value("created_at", "timestamp_ntz").alias("created_at"),
            value("payload.size", "bigint").alias("commits_count"),
            F.when(ref.startswith("refs/heads/"), 1).otherwise(0).cast("bigint").alias("branches_pushed"),
            value("payload.distinct_size", "bigint").alias("distinct_sizes"),
        )
        .where(F.col("event_id").isNotNull() & F.col("created_at").isNotNull())
        .select(surrogate_key("event_id").alias("event_key"), "*")
    )


# --- dimensions -----------------------------------------------------------------------------


def dim_actor(actors: DataFrame, as_of: datetime) -> DataFrame:
    """Actor dimension; every row is the open, current version."""
    return actors.where(F.col("actor_id").isNotNull() & F.col("actor_login").isNotNull()).select(
        surrogate_key("actor_id").alias("actor_key"),
        "actor_id",
        "actor_login",
        "actor_type",
        "first_seen_at",
        "last_seen_at",
        "days_active",
        (F.coalesce(F.col("actor_type"), F.lit("")) == "Bot").alias("is_bot"),
        _ts(as_of).alias("valid_from"),
        _ts(fixed.OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
        *_stamps(as_of),
    )


def dim_actor_incremental(target: DataFrame, actors: DataFrame, as_of: datetime) -> DataFrame:
    """Current rows of the target, untouched, plus the actors that have none yet."""
    current = target.where("is_current")
    new = dim_actor(actors, as_of).join(current.select("actor_id"), "actor_id", "left_anti")
    return current.unionByName(new.select(*current.columns))


def dim_actor_scd2(target: DataFrame, actors: DataFrame, changed_at: datetime) -> DataFrame:
    """Type-2 merge of a staging snapshot into the dimension.

    A changed login or type closes the open version at ``changed_at`` and opens a new one; an
    unchanged actor keeps its version and only refreshes its activity dates; an unknown actor gets
    a first version; closed versions stay as they are. Merging the same snapshot again changes
    nothing. One full outer join; each joined row yields one or two versions.
    """
    names = DIM_ACTOR.names
    history = target.where(~F.col("is_current")).select(*names)
    old = target.where("is_current").select("actor_id", F.struct(*names).alias("old"))
    new = dim_actor(actors, changed_at).select("actor_id", F.struct(*names).alias("new"))

    changed = ~(
        F.col("old.actor_login").eqNullSafe(F.col("new.actor_login"))
        & F.col("old.actor_type").eqNullSafe(F.col("new.actor_type"))
    )
    closed = (
        F.col("old")
        .withField("valid_to", _ts(changed_at))
        .withField("is_current", F.lit(False))
        .withField("updated_ts", _ts(changed_at))
    )
    refreshed = (
        F.col("old")
        .withField("first_seen_at", F.least("old.first_seen_at", "new.first_seen_at"))
        .withField("last_seen_at", F.greatest("old.last_seen_at", "new.last_seen_at"))
    )
    refreshed = refreshed.withField(
        "days_active", boundary_diff("day", refreshed["first_seen_at"], refreshed["last_seen_at"])
    )
    versions = (
        F.when(F.col("new").isNull(), F.array("old"))
        .when(F.col("old").isNull(), F.array("new"))
        .when(changed, F.array(closed, F.col("new")))
        .otherwise(F.array(refreshed))
    )
    merged = old.join(new, "actor_id", "full_outer").select(F.explode(versions).alias("v"))
    return merged.select("v.*").unionByName(history)


def dim_repository_from_batch(target: DataFrame, events: DataFrame, as_of: datetime) -> DataFrame:
    """Type-1 merge of newly loaded events into the repository dimension."""
    columns = ["repo_id", "repo_name", "first_event_at", "last_event_at"]
    parts = target.select(*columns).unionByName(stg_repositories(events).select(*columns))
    return dim_repository(merge_repositories(parts), as_of)


def actor_runs(events: DataFrame) -> DataFrame:
    """``actor_id, actor_login, actor_type, first_at, last_at``: what each actor was called, in the order of events.

    A run ends with the last event before login or type change. Events without actor, login or time are left out. Of
    events at one time the smaller login comes first.

    Events are first collapsed to one row per (actor, login, type), which combines before the shuffle. Where an actor's
    versions follow each other, as with most actors, these rows are the runs. Only actors whose versions overlap go back to
    their events, see :func:`_runs_by_hour`. The collapsed rows are stored, so it is known here whether there are such actors.
    """
    spark = events.sparkSession
    seen = with_actor_class(events).where(
        F.col("actor_id").isNotNull() & F.col("actor_login").isNotNull() & F.col("created_at").isNotNull()
    )
    seen = seen.select(*_VERSION, F.col("created_at").alias("first_at"), F.col("created_at").alias("last_at"))
    path = fresh_path(spark, "actor-versions")
    _alternating(_spanned(seen, *_VERSION), "actor_id").write.parquet(path)
    versions = spark.read.parquet(path)
    clear = versions.where(~F.col("alternates")).select(*_RUN)
    # a table of its own, whose size tells Spark whether to send it to the events
    path = fresh_path(spark, "actors-tangled")
    versions.where("alternates").select("actor_id").distinct().write.parquet(path)
    tangled = spark.read.parquet(path)
    if tangled.isEmpty():
        return clear
    return clear.unionByName(_runs_by_hour(seen.join(tangled, "actor_id", "left_semi").select(*_RUN)).select(*_RUN))


def _runs_by_hour(seen: DataFrame) -> DataFrame:
    """Runs of actors whose versions overlap, from one row per event.

    Events are collapsed to one row per (actor, hour, login, type), so an actor holding a large share of the data costs
    a few rows per hour. Where the versions of an hour follow each other their first times tell the order. Only hours in which
    they alternate go back to the events, and there the search stays inside (actor, hour).
    """
    seen = seen.withColumn("chunk", trunc_ts("hour", "first_at"))
    pieces = _alternating(_spanned(seen, *_VERSION, "chunk"), "actor_id", "chunk")
    tangled = pieces.where("alternates").select("actor_id", "chunk").distinct()
    detail = seen.join(tangled, ["actor_id", "chunk"], "left_semi").select(*seen.columns)
    clear = pieces.where(~F.col("alternates")).select(*_RUN)
    return _runs(clear.unionByName(_runs(detail, "actor_id", "chunk").select(*_RUN)), "actor_id")


def _spanned(seen: DataFrame, *keys: str) -> DataFrame:
    return seen.groupBy(*keys).agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))


def _alternating(pieces: DataFrame, *within: str) -> DataFrame:
    """Add ``alternates``: does any piece of the group begin before another has ended, or at its end?"""
    group = Window.partitionBy(*within)
    earlier = group.orderBy(*_in_time()).rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.max("last_at").over(earlier) >= F.col("first_at"), F.lit(False))
    return pieces.withColumn("alternates", begins).withColumn("alternates", F.bool_or("alternates").over(group))


_VERSION = ["actor_id", "actor_login", "actor_type"]
_RUN = [*_VERSION, "first_at", "last_at"]


def _in_time() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ("first_at", "actor_login", "actor_type")]


def _runs(pieces: DataFrame, *within: str) -> DataFrame:
    """Put pieces of one login and type together if none of another lies between them."""
    order = Window.partitionBy(*within).orderBy(*_in_time())
    version = F.struct("actor_login", "actor_type")
    starts = (~F.lag(version).over(order).eqNullSafe(version)).cast("int")
    numbered = pieces.withColumn("_starts", starts).withColumn(
        "_run", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    keys = list(dict.fromkeys([*within, *_VERSION]))
    runs = numbered.groupBy(*keys, "_run").agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    return runs.drop("_run")


def _bounded(runs: DataFrame) -> DataFrame:
    """A version holds from the first event of its run to the first event of the next run."""
    next_start = F.lead("first_at").over(Window.partitionBy("actor_id").orderBy(*_in_time()))
    return runs.select(
        surrogate_key("actor_id").alias("actor_key"),
        *_RUN,
        F.col("first_at").alias("valid_from"),
        F.coalesce(next_start, _ts(fixed.OPEN_END)).alias("valid_to"),
        next_start.isNull().alias("is_current"),
    )


def actor_history(events: DataFrame) -> DataFrame:
    """All type-2 versions of every actor, rebuilt from the events themselves; late and replayed events are harmless."""
    return _bounded(actor_runs(events)).drop("first_at", "last_at")


def _dim_rows(runs: DataFrame, as_of: datetime) -> DataFrame:
    """Dimension rows of whole actors: all runs of an actor are there.

    ``first_seen_at`` is the actor's first event, ``last_seen_at`` the last event of the version.
    """
    first_seen = F.min("first_at").over(Window.partitionBy("actor_id"))
    return _bounded(runs).select(
        "actor_key",
        *_VERSION,
        first_seen.alias("first_seen_at"),
        F.col("last_at").alias("last_seen_at"),
        boundary_diff("day", first_seen, F.col("last_at")).alias("days_active"),
        (F.coalesce(F.col("actor_type"), F.lit("")) == "Bot").alias("is_bot"),
        "valid_from",
        "valid_to",
        "is_current",
        *_stamps(as_of),
    ).select(*DIM_ACTOR.names)


def dim_actor_history(events: DataFrame, as_of: datetime) -> DataFrame:
    """Type-2 dimension in event time, from all events."""
    return _dim_rows(actor_runs(events), as_of)


def _spans(pieces: DataFrame) -> DataFrame:
    """Number the groups of pieces that overlap: ``span, lo, hi`` per piece and whether the group has several versions."""
    order = Window.partitionBy("actor_id").orderBy(*_in_time())
    reached = F.max("last_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first_at") > reached, F.lit(True)).cast("int")
    numbered = pieces.withColumn("_opens", opens).withColumn(
        "span", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    group = Window.partitionBy("actor_id", "span")
    version = F.struct("actor_login", "actor_type")
    return numbered.select(
        *_RUN,
        F.min("first_at").over(group).alias("lo"),
        F.max("last_at").over(group).alias("hi"),
        (F.min(version).over(group) != F.max(version).over(group)).alias("mixed"),
    )


def dim_actor_from_batch(target: DataFrame, batch: DataFrame, events: DataFrame, as_of: datetime) -> DataFrame:
    """Type-2 merge of newly loaded events in event time: the same versions as from all events, in any order of batches.

    ``target`` is a dimension in event time, where ``valid_from`` and ``last_seen_at`` bound the run of a version. Only actors of
    the batch are opened: their stored runs and the runs of the batch are spliced. Where these overlap and differ, a late
    event splits a stored run and its ends alone do not tell where it goes on; there, and only there, the run is taken
    again from ``events``, all staged events with the batch among them. Other actors' rows stay as they are. A repeated
    batch changes nothing.
    """
    spark = target.sparkSession
    path = fresh_path(spark, "actor-runs")
    actor_runs(batch).write.parquet(path)
    fresh = spark.read.parquet(path)
    touched = fresh.select("actor_id").distinct()
    stored = target.select(*_VERSION, F.col("valid_from").alias("first_at"), F.col("last_seen_at").alias("last_at"))
    pieces = stored.join(touched, "actor_id", "left_semi").select(*_RUN).unionByName(fresh.select(*_RUN))
    path = fresh_path(spark, "actor-pieces")
    _spans(pieces).write.parquet(path)
    spliced = spark.read.parquet(path)
    clear = spliced.where(~F.col("mixed")).select(*_RUN)
    mixed = spliced.where("mixed")
    lo, hi = mixed.agg(F.min("lo"), F.max("hi")).first()
    if lo is not None:
        spans = mixed.select("actor_id", "lo", "hi").distinct()
        within = events.where(F.col("created_at").between(_ts(lo), _ts(hi))).join(spans, "actor_id")
        within = within.where(F.col("created_at").between(F.col("lo"), F.col("hi")))
        clear = clear.unionByName(actor_runs(within.select(*events.columns)).select(*_RUN))
    merged = _dim_rows(_runs(clear, "actor_id"), as_of)

    # a version that is as it was keeps its clocks
    same = [*_VERSION, "valid_from"]
    on = [merged[c].eqNullSafe(F.col(f"old_{c}")) for c in same]
    old = target.join(touched, "actor_id", "left_semi")
    old = old.select(
        *[F.col(c).alias(f"old_{c}") for c in same],
        F.struct("first_seen_at", "last_seen_at", "valid_to").alias("old"),
        F.col("created_ts").alias("old_created"),
        F.col("updated_ts").alias("old_updated"),
    )
    unchanged = F.col("old").eqNullSafe(F.struct("first_seen_at", "last_seen_at", "valid_to"))
    merged = merged.join(old, on, "left").withColumns(
        {
            "created_ts": F.coalesce("old_created", "created_ts"),
            "updated_ts": F.when(unchanged, F.col("old_updated")).otherwise(F.col("updated_ts")),
        }
    )
    untouched = target.join(touched, "actor_id", "left_anti")
    return untouched.select(*DIM_ACTOR.names).unionByName(merged.select(*DIM_ACTOR.names))


def dim_repository(repositories: DataFrame, as_of: datetime) -> DataFrame:
    kept = repositories.where(F.col("repo_id").isNotNull() & F.col("repo_name").isNotNull())
    return kept.select(
        surrogate_key("repo_id").alias("repo_key"),
        "repo_id",
        "repo_name",
        "repo_owner",
        "repo_short_name",
        "first_event_at",
        "last_event_at",
        "days_active",
        is_test_repository("repo_name").alias("is_test_repo"),
        *_stamps(as_of),
    )


def dim_event_type(event_types: DataFrame, as_of: datetime) -> DataFrame:
    return event_types.where(F.col("event_type").isNotNull()).select(
        surrogate_key("event_type").alias("event_type_key"),
        "event_type",
        "event_description",
        "event_count",
        "unique_actors",
        "unique_repos",
        "percent_of_total_events",
        "first_occurrence",
        "last_occurrence",
        event_category("event_type").alias("event_category"),
        *_stamps(as_of),
    )


# --- physical layout ------------------------------------------------------------------------


def write_fact(fact: DataFrame, path: str, **options: str) -> None:
    """Fact laid out by ``event_date``, along a curve over repository and actor inside each date.

    The event key closes the range, so one busy repository still splits over several files; row-group bounds
    are tight for filters by either key, Bloom filters serve filters by id. ``options`` go to the Parquet writer.
    """
    (
        layout.sort_files(fact.select(*FACT_EVENTS.names), "event_date", *layout.fact_order(), by_range=True)
        .write.mode("overwrite")
        .options(**layout.filter_options(layout.FACT_FILTERS), **options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def write_dim_actor(dim: DataFrame, path: str) -> None:
    """Actor dimension split into current and closed versions, sorted by actor."""
    (
        dim.select(*DIM_ACTOR.names)
        .repartitionByRange("is_current", "actor_id")
        .sortWithinPartitions("is_current", "actor_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("is_current")
        .parquet(path)
    )


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, path, FACT_EVENTS)
