"""Activity reports over staged events and over the star schema.

Frames called ``events`` need the staged columns a report uses; ``fact`` and the dimensions are
the mart tables. Shares of a total use a window over the aggregated rows only (one per type, hour
or day), never over events. No join carries a broadcast hint except against a top-k list, whose
size is ``k``; for the others Spark decides from measured sizes.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import boundary_diff, percent, round_half_up, surrogate_key, trunc_ts
from eventlake.operators import summaries
from eventlake.operators.asof import count_in_force
from eventlake.sources.ndjson import has_field


def _ts(value: datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _count() -> Column:
    return F.count(F.lit(1))


def _grand_total(column: str) -> Column:
    """Sum over all aggregated rows."""
    return F.sum(column).over(Window.partitionBy())


# --- raw data -------------------------------------------------------------------------------


def raw_overview(events: DataFrame) -> DataFrame:
    """Totals, distinct entities and time span, as one row."""
    return events.agg(
        _count().alias("total_events"),
        F.countDistinct("event_id").alias("distinct_events"),
        F.countDistinct("actor_id").alias("unique_actors"),
        F.countDistinct("repo_id").alias("unique_repositories"),
        F.min("created_at").alias("earliest_event"),
        F.max("created_at").alias("latest_event"),
    ).withColumn("days_of_data", boundary_diff("day", "earliest_event", "latest_event"))


def null_profile(raw: DataFrame, fields: list[str]) -> DataFrame:
    """Per field: documents without the key and their share. One pass for all fields."""
    counts = raw.agg(
        _count().alias("total"), *[F.count_if(~has_field(f)).alias(f"n_{f}") for f in fields]
    )
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("null_count")) for f in fields]
    rows = counts.select("total", F.explode(F.array(*pairs)).alias("p"))
    return rows.select(
        "p.field",
        "p.null_count",
        percent(F.col("p.null_count"), F.col("total")).alias("null_percent"),
    )


def event_type_distribution(events: DataFrame) -> DataFrame:
    """Per event type: count, share, distinct actors and repositories, first and last time."""
    types = events.groupBy("event_type").agg(
        _count().alias("event_count"),
        F.countDistinct("actor_id").alias("unique_actors"),
        F.countDistinct("repo_id").alias("unique_repos"),
        F.min("created_at").alias("first_occurrence"),
        F.max("created_at").alias("last_occurrence"),
    )
    total = _grand_total("event_count")
    return types.withColumn("percent_of_total", percent(F.col("event_count"), total))


def _largest_first(count: str, keys: list[str]) -> list[Column]:
    """Sort order of every top-k report: by count, ties by the keys."""
    return [F.col(count).desc(), *[F.col(c).asc_nulls_last() for c in keys]]


def _top_groups(events: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Detail rows of the ``k`` largest groups.

    A first pass counts per group, which shuffles one number per group and map task. The second
    pass keeps only events of the winners, before anything wider is shuffled; the winner list has
    ``k`` rows, so broadcasting it is safe at any data size.
    """
    counts = events.groupBy(*keys).agg(_count().alias("_n"))
    winners = counts.orderBy(*_largest_first("_n", keys)).limit(k)
    winners = F.broadcast(winners.select(*[F.col(c).alias(f"_{c}") for c in keys]))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return events.join(winners, on, "left_semi")


REPOSITORY, DEVELOPER = ["repo_id", "repo_name"], ["actor_id", "actor_login", "actor_type"]


def _span_of_candidates(
    events: DataFrame, leaders: DataFrame, keys: list[str], k: int, first: date | None, last: date | None
) -> tuple[DataFrame, bool]:
    found = summaries.candidates(leaders, keys, k, first, last)
    span = summaries.within(summaries.with_day(events), first, last)
    return summaries.narrowed(span, found, keys), found.certain


def top_repositories_over(
    events: DataFrame, leaders: DataFrame, k: int = 100, first: date | None = None, last: date | None = None
) -> DataFrame:
    """:func:`top_repositories` of a span of days; daily leaders take the place of the pass that counts all groups."""
    rows, certain = _span_of_candidates(events, leaders, REPOSITORY, k, first, last)
    return top_repositories(rows, k, counted=certain)


def top_developers_over(
    events: DataFrame, leaders: DataFrame, k: int = 100, first: date | None = None, last: date | None = None
) -> DataFrame:
    """:func:`top_developers` of a span of days, in the same way."""
    rows, certain = _span_of_candidates(events, leaders, DEVELOPER, k, first, last)
    return top_developers(rows, k, counted=certain)


def top_repositories(events: DataFrame, k: int = 100, counted: bool = False) -> DataFrame:
    """The ``k`` busiest repositories with contributors and event types; ``counted`` if only few groups are left."""
    keys = REPOSITORY
    per_actor = (
        (events if counted else _top_groups(events, keys, k))
        .groupBy(*keys, "actor_id", "event_type")
        .agg(_count().alias("n"), F.min("created_at").alias("lo"), F.max("created_at").alias("hi"))
    )
    # the type list has a handful of entries, so its length also gives the distinct count
    return (
        per_actor.groupBy(*keys)
        .agg(
            F.sum("n").alias("total_events"),
            F.countDistinct("actor_id").alias("unique_contributors"),
            F.array_sort(F.collect_set("event_type")).alias("event_type_list"),
            F.min("lo").alias("first_event"),
            F.max("hi").alias("last_event"),
        )
        .withColumn("event_type_count", F.size("event_type_list").cast("bigint"))
        .orderBy(*_largest_first("total_events", keys))
        .limit(k)
    )


def top_developers(events: DataFrame, k: int = 100, counted: bool = False) -> DataFrame:
    """The ``k`` most active actors with repositories and event types; ``counted`` if only few groups are left."""
    keys = DEVELOPER
    return (
        (events if counted else _top_groups(events, keys, k))
        .groupBy(*keys)
        .agg(
            _count().alias("total_events"),
            F.countDistinct("repo_id").alias("repositories_contributed_to"),
            F.countDistinct("event_type").alias("event_types"),
            F.min("created_at").alias("first_event"),
            F.max("created_at").alias("last_event"),
        )
        .orderBy(*_largest_first("total_events", keys))
        .limit(k)
    )


def daily_activity(events: DataFrame) -> DataFrame:
    """Per day: events, distinct developers, repositories and types, hourly average."""
    return (
        events.groupBy(F.to_date("created_at").alias("activity_date"))
        .agg(
            _count().alias("daily_events"),
            F.countDistinct("actor_id").alias("unique_developers"),
            F.countDistinct("repo_id").alias("unique_repositories"),
            F.countDistinct("event_type").alias("event_types"),
            F.min("created_at").alias("earliest_event"),
            F.max("created_at").alias("latest_event"),
        )
        .withColumn("avg_events_per_hour", round_half_up(F.col("daily_events") / 24, 0))
    )


def hourly_pattern(events: DataFrame, days: int = 7) -> DataFrame:
    """Per hour of day over ``days`` days of data."""
    return (
        events.groupBy(F.hour("created_at").cast("bigint").alias("utc_hour"))
        .agg(
            _count().alias("total_events"),
            F.countDistinct("actor_id").alias("total_actors"),
            F.countDistinct("repo_id").alias("total_repos"),
        )
        .withColumn("avg_per_day", round_half_up(F.col("total_events") / days, 0))
    )


def language_distribution(events: DataFrame, k: int = 30) -> DataFrame:
    """The ``k`` most frequent repository languages, where the optional field is present."""
    return (
        events.where(F.col("language").isNotNull())
        .groupBy("language")
        .agg(_count().alias("event_count"), F.countDistinct("repo_id").alias("repo_count"))
        .orderBy(*_largest_first("event_count", ["language"]))
        .limit(k)
    )


def event_rate_per_minute(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Distribution of events per minute over the minutes that have events.

    The quantiles are taken over one row per minute. ``approximate`` uses a sketch instead of
    exact interpolated quantiles.
    """
    minutes = events.groupBy(trunc_ts("minute", "created_at").alias("minute")).agg(
        _count().alias("n")
    )
    quantile = F.percentile_approx if approximate else F.percentile
    return minutes.agg(
        F.min("n").alias("min_per_minute"),
        quantile("n", 0.25).cast("double").alias("p25_per_minute"),
        quantile("n", 0.5).cast("double").alias("median_per_minute"),
        quantile("n", 0.75).cast("double").alias("p75_per_minute"),
        F.max("n").alias("max_per_minute"),
        round_half_up(F.avg("n"), 2).alias("avg_per_minute"),
    )


def quality_report_rows(raw: DataFrame, events: DataFrame, audit: DataFrame) -> DataFrame:
    """Text report of ``line_no, section, label, value``: coverage, completeness, entities, loads.

    Three aggregates, each one pass, turned into lines.
    """
    missing = [("Missing Event IDs", "id"), ("Missing Event Types", "type"),
               ("Missing Actors", "actor"), ("Missing Repos", "repo")]
    coverage = events.agg(
        _count().alias("n"),
        F.min("created_at").alias("lo"),
        F.max("created_at").alias("hi"),
        F.countDistinct("actor_id").alias("actors"),
        F.countDistinct("repo_id").alias("repos"),
        F.countDistinct("event_type").alias("types"),
    )
    gaps = raw.agg(*[F.count_if(~has_field(f)).alias(f) for _, f in missing])
    loads = audit.agg(
        F.count_if(F.col("status") == "SUCCESS").alias("good"),
        F.count_if(F.col("status") == "FAILED").alias("bad"),
    )
    span = F.concat_ws(" to ", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("lo", "hi")])

    def lines(df: DataFrame, entries: list[tuple[int, str, str, Column]]) -> DataFrame:
        items = [
            F.struct(
                F.lit(line_no).cast("bigint").alias("line_no"),
                F.lit(section).alias("section"),
                F.lit(label).alias("label"),
                value.cast("string").alias("value"),
            )
            for line_no, section, label, value in entries
        ]
        return df.select(F.inline(F.array(*items)))

    from_events = lines(
        coverage,
        [
            (1, "Coverage", "Total Events", F.col("n")),
            (2, "Coverage", "Date Range", span),
            (7, "Entity Counts", "Unique Developers", F.col("actors")),
            (8, "Entity Counts", "Unique Repositories", F.col("repos")),
            (9, "Entity Counts", "Event Types", F.col("types")),
        ],
    )
    from_raw = lines(
        gaps, [(3 + i, "Data Completeness", t, F.col(f)) for i, (t, f) in enumerate(missing)]
    )
    from_loads = lines(
        loads,
        [
            (10, "Load Status", "Files Loaded", F.col("good")),
            (11, "Load Status", "Load Failures", F.col("bad")),
        ],
    )
    return from_events.unionByName(from_raw).unionByName(from_loads)


def duplicate_events(events: DataFrame) -> DataFrame:
    """Event ids that occur more than once."""
    counts = events.groupBy("event_id").agg(_count().alias("occurrence_count"))
    return counts.where(F.col("occurrence_count") > 1)


def future_events(events: DataFrame, as_of: datetime) -> DataFrame:
    """Per type: events dated after ``as_of``."""
    late = events.where(F.col("created_at") > _ts(as_of))
    return late.groupBy("event_type").agg(
        _count().alias("future_count"), F.max("created_at").alias("latest_event")
    )


def latest_events(
    events: DataFrame,
    as_of: datetime,
    days: int = 7,
    event_type: str | None = None,
    limit: int = 100_000,
) -> DataFrame:
    """Newest events of the last ``days`` days, optionally of one type.

    The date bound is a plain range on ``created_at``, which reaches the scan.
    """
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    recent = events.where(F.col("created_at") >= _ts(midnight - timedelta(days=days)))
    if event_type is not None:
        recent = recent.where(F.col("event_type") == event_type)
    return recent.orderBy(F.col("created_at").desc(), "event_id").limit(limit)


def raw_sample(raw: DataFrame, n: int = 10) -> DataFrame:
    """``n`` raw documents as JSON text, smallest id first."""
    event_id = F.try_variant_get("raw_data", "$.id", "string")
    rows = raw.select(event_id.alias("event_id"), F.col("raw_data").cast("string").alias("raw_json"))
    return rows.orderBy(F.col("event_id").asc_nulls_last(), "raw_json").limit(n)


# --- star schema ----------------------------------------------------------------------------


NATURAL = {"actor_key": "actor_id", "repo_key": "repo_id", "event_type_key": "event_type"}


def _counts_by(fact: DataFrame, *keys: str) -> DataFrame:
    """Collapse the fact to the given keys before any join with a dimension.

    A dimension key is the hash of a natural id, so grouping goes by the short id and the key is
    computed once per group.
    """
    counts = fact.groupBy(*[NATURAL.get(k, k) for k in keys]).agg(_count().alias("n"))
    columns = [surrogate_key(NATURAL[k]).alias(k) if k in NATURAL else F.col(k) for k in keys]
    return counts.select(*columns, "n")


def _with_actor(fact: DataFrame, actors: DataFrame, groups: list[str], attributes: list[str], at_event: bool) -> DataFrame:
    """Counts per group, actor and actor attributes: of the current version, or of the one in force at the event.

    Either way an event counts once, however many versions its actor has.
    """
    if at_event:
        return count_in_force(fact, actors, groups, attributes)
    counts = fact.groupBy(*groups, "actor_id").agg(_count().alias("n"))
    current = actors.where("is_current").select("actor_id", *attributes)
    return counts.join(current, "actor_id", "left").select(*groups, "actor_id", *attributes, "n")


def star_join_rollup(
    fact: DataFrame, actors: DataFrame, repositories: DataFrame, event_types: DataFrame, k: int = 10, at_event: bool = False
) -> DataFrame:
    """The ``k`` largest (date, type, category, login, bot, repository) combinations.

    With ``at_event`` an actor has the login of the time of the event instead of the current one.
    """
    groups = ["event_date", "event_type", "event_category", "actor_login", "is_bot", "repo_name"]
    typed = fact.select("event_date", F.col("event_type").alias("of_type"), "actor_id", "repo_id", "created_at")
    counts = _with_actor(typed, actors, ["event_date", "of_type", "repo_id"], ["actor_login", "is_bot"], at_event)
    types = event_types.select(F.col("event_type").alias("of_type"), "event_type", "event_category")
    return (
        counts.join(types, "of_type", "left")
        .join(repositories.select("repo_id", "repo_name"), "repo_id", "left")
        .groupBy(*groups)
        .agg(F.sum("n").alias("event_count"))
        .orderBy(*_largest_first("event_count", groups))
        .limit(k)
    )


def mart_top_repositories(
    fact: DataFrame, repositories: DataFrame, event_types: DataFrame, k: int = 20
) -> DataFrame:
    """The ``k`` busiest repositories by name, from the marts.

    Joins and distinct counts go by natural ids; events without an actor are one contributor. Types count if the
    dimension knows them.
    """
    counts = fact.groupBy("repo_id", "actor_id", F.col("event_type").alias("of_type")).agg(_count().alias("n"))
    known = event_types.select(F.col("event_type").alias("of_type"), "event_type")
    no_actor = F.max(F.col("actor_id").isNull().cast("bigint"))
    return (
        counts.join(repositories.select("repo_id", "repo_name"), "repo_id", "left")
        .join(known, "of_type", "left")
        .groupBy("repo_name")
        .agg(
            F.sum("n").alias("event_count"),
            (F.countDistinct("actor_id") + no_actor).alias("unique_contributors"),
            F.countDistinct("event_type").alias("event_types"),
        )
        .orderBy(*_largest_first("event_count", ["repo_name"]))
        .limit(k)
    )


def developer_daily(fact: DataFrame, actors: DataFrame, at_event: bool = False) -> DataFrame:
    """Events and repositories touched per day and developer; an unknown repository is one repository.

    With ``at_event`` a developer's login is that of the time of the event.
    """
    no_repo = F.max(F.col("repo_id").isNull().cast("bigint"))
    return (
        _with_actor(fact, actors, ["event_date", "repo_id"], ["actor_login"], at_event)
        .groupBy("event_date", "actor_login")
        .agg(F.sum("n").alias("events"), (F.countDistinct("repo_id") + no_repo).alias("repos_touched"))
    )


def category_distribution(fact: DataFrame, event_types: DataFrame) -> DataFrame:
    """Count and share per category and type."""
    groups = (
        _counts_by(fact, "event_type_key")
        .join(event_types.select("event_type_key", "event_type", "event_category"), "event_type_key", "left")
        .groupBy("event_category", "event_type")
        .agg(F.sum("n").alias("event_count"))
    )
    total = _grand_total("event_count")
    return groups.withColumn("percent_of_events", percent(F.col("event_count"), total))


def activity_heatmap(fact: DataFrame) -> DataFrame:
    """Events per day (rows) and hour of day (columns ``h00`` to ``h23``)."""
    wide = fact.groupBy("event_date").pivot("event_hour", list(range(24))).count()
    cells = [F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in range(24)]
    return wide.select("event_date", *cells)


def new_developers(actors: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Actors first seen in the ``days`` days before ``as_of``."""
    first = F.col("first_seen_at")
    recent = (first >= _ts(as_of - timedelta(days=days))) & (first < _ts(as_of))
    return actors.where(recent).select("actor_id", "actor_login", "actor_type", "first_seen_at")


def type_trend(events: DataFrame, types: list[str]) -> DataFrame:
    """Daily counts of the chosen types, one column per type."""
    wanted = events.where(F.col("event_type").isin(types))
    counts = [F.count_if(F.col("event_type") == t).alias(t) for t in types]
    return wanted.groupBy(F.to_date("created_at").alias("event_date")).agg(*counts)


def bot_share(fact: DataFrame, actors: DataFrame, at_event: bool = False) -> DataFrame:
    """Events and actors of bots and humans, with their share of all events; events without an actor are one actor's.

    With ``at_event`` an actor is a bot if it was one at the time of the event, so it can count on both sides.
    """
    no_actor = F.max(F.col("actor_id").isNull().cast("bigint"))
    groups = _with_actor(fact, actors, [], ["is_bot"], at_event).groupBy(F.coalesce("is_bot", F.lit(False)).alias("is_bot")).agg(
        F.sum("n").alias("event_count"), (F.countDistinct("actor_id") + no_actor).alias("actor_count")
    )
    total = _grand_total("event_count")
    return groups.withColumn("percent_of_events", percent(F.col("event_count"), total))


def recently_active(events: DataFrame, as_of: datetime, days: int = 7, k: int = 20) -> DataFrame:
    """Repositories and actors whose first event is recent, the ``k`` busiest of each kind."""
    results = None
    for kind, key in (("repository", "repo_id"), ("actor", "actor_id")):
        first = F.min("created_at")
        groups = events.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("entity_id")).agg(
            first.alias("first_event_at"),
            F.max("created_at").alias("last_event_at"),
            _count().alias("event_count"),
        )
        recent = groups.where(
            (F.col("first_event_at") >= _ts(as_of - timedelta(days=days)))
            & (F.col("first_event_at") < _ts(as_of))
        )
        top = recent.orderBy(F.col("event_count").desc(), "entity_id").limit(k)
        top = top.select(F.lit(kind).alias("entity_kind"), "*")
        results = top if results is None else results.unionByName(top)
    return results


def activity_trend(events: DataFrame, grain: str = "day") -> DataFrame:
    """Events per hour, day, week or month."""
    if grain not in ("hour", "day", "week", "month"):
        raise ValueError(f"unknown grain {grain!r}")
    return events.groupBy(trunc_ts(grain, "created_at").alias("period_start")).agg(
        _count().alias("event_count")
    )


def model_row_counts(models: dict[str, DataFrame]) -> DataFrame:
    """Row count per model."""
    result = None
    for name, df in models.items():
        counts = df.agg(_count().alias("row_count")).select(F.lit(name).alias("model_name"), "row_count")
        result = counts if result is None else result.unionByName(counts)
    return result
