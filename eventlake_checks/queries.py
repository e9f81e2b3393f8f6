"""Registered queries: every operator run over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import functions as fn
from eventlake.functions import fixed
from eventlake.operators import analytics, distinct, keyfilter, merge, monitoring, quality, summaries
from eventlake.plans import marts, pipeline, staging
from eventlake.schemas import (
    DIM_ACTOR,
    DIM_EVENT_TYPE,
    DIM_REPOSITORY,
    FACT_EVENTS,
    LOAD_HISTORY,
    RAW_EVENTS,
    STG_EVENTS,
    table_contract,
)
from eventlake.session import configure, fresh_path
from eventlake.sources import audit as loads
from eventlake.sources import hours, layout, ndjson, tables
from eventlake.streaming import jobs
from eventlake_checks import fixtures as fx
from eventlake_checks.fixtures import AS_OF

_CLOCKS = ("created_ts", "updated_ts")
# folders written once per application and scale, keyed by (application, scale folder, kind)
_written: dict[tuple[str, str, str], str] = {}


class Lake:
    """The derived inputs of one scale folder; all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    @cached_property
    def staged(self) -> DataFrame:
        return fx.staged(self.spark, self.sf_dir)

    @cached_property
    def lines(self) -> DataFrame:
        return fx.to_json_lines(self.staged)

    @cached_property
    def raw(self) -> DataFrame:
        """The raw table, stored like a production one so that scans read only needed paths."""
        path = self._once("raw", lambda folder: fx.to_raw(self.lines).write.parquet(folder))
        return self.spark.read.schema(RAW_EVENTS).parquet(path)

    @cached_property
    def gappy(self) -> DataFrame:
        return fx.with_missing_entities(self.staged)

    @cached_property
    def gappy_raw(self) -> DataFrame:
        return fx.to_raw(fx.to_json_lines(self.gappy))

    @cached_property
    def doubled(self) -> DataFrame:
        return fx.with_duplicates(self.staged)

    @cached_property
    def audit(self) -> DataFrame:
        return fx.audit(self.spark, self.sf_dir)

    @cached_property
    def load_times(self) -> DataFrame:
        return self.staged.select(F.col("loaded_at").alias("load_ts"))

    @cached_property
    def files(self) -> DataFrame:
        """Hour files that exist: ``file_name, file_hour``."""
        names = self.staged.select(F.col("source_file").alias("file_name")).distinct()
        return names.withColumn("file_hour", fn.hour_of_file_name("file_name"))

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fact_events(self.staged, AS_OF)

    @cached_property
    def actors(self) -> DataFrame:
        return marts.dim_actor(staging.stg_actors(self.staged), AS_OF)

    @cached_property
    def repositories(self) -> DataFrame:
        return marts.dim_repository(staging.stg_repositories(self.staged), AS_OF)

    @cached_property
    def types(self) -> DataFrame:
        return marts.dim_event_type(staging.stg_event_types(self.staged), AS_OF)

    @cached_property
    def known_types(self) -> DataFrame:
        """A dimension that only has the documented event types."""
        return self.types.where(F.col("event_type").isin(fixed.EVENT_TYPES))

    def actors_before(self, cutoff: datetime, as_of: datetime) -> DataFrame:
        return marts.dim_actor(staging.stg_actors(fx.loaded_before(self.staged, cutoff)), as_of)

    @cached_property
    def scd2(self) -> DataFrame:
        base = self.actors_before(fx.SCD_CUTOFF, fx.SCD_CUTOFF)
        return marts.dim_actor_scd2(base, staging.stg_actors(self.staged), AS_OF)

    def path(self, label: str) -> str:
        return fresh_path(self.spark, label)

    def _once(self, kind: str, write: Callable[[str], None]) -> str:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, kind)
        if key not in _written or not tables.path_exists(self.spark, _written[key]):
            folder = self.path(kind)
            write(folder)
            _written[key] = folder
        return _written[key]

    @property
    def landing(self) -> str:
        """Hourly gzip files of all events."""
        return self._once("landing", lambda folder: ndjson.write_hour_files(self.lines, folder))

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        """Write a frame as a table and read it back, as production tables are."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def suite_models(self) -> dict[str, DataFrame]:
        """Stored tables with duplicates and missing entities for the declared tests."""
        messy = self.stored(fx.with_duplicates(self.gappy).drop("language", "value"), "messy")
        models = {
            "raw_events": self.raw,
            "load_history": self.stored(self.audit, "audit"),
            "stg_events": messy,
            "stg_actors": self.stored(staging.stg_actors(messy), "actors"),
            "stg_repositories": self.stored(staging.stg_repositories(messy), "repositories"),
            "stg_event_types": self.stored(staging.stg_event_types(messy), "types"),
            "fact_events": self.stored(marts.fact_events(messy, AS_OF), "fact"),
        }
        models["dim_actor"] = marts.dim_actor(models["stg_actors"], AS_OF)
        models["dim_repository"] = marts.dim_repository(models["stg_repositories"], AS_OF)
        models["dim_event_type"] = marts.dim_event_type(models["stg_event_types"], AS_OF)
        return models

    @cached_property
    def suite(self) -> DataFrame:
        return self.stored(quality.run_dq_suite(self.suite_models), "suite")


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _seconds_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("load_duration_seconds", F.col("load_duration_seconds").cast("double"))


# --- sources and ingest ---------------------------------------------------------------------


def scan_hourly_ndjson(lake: Lake) -> DataFrame:
    raw = ndjson.scan_hourly_ndjson(lake.spark, lake.landing, AS_OF)
    return raw.select(
        F.variant_get("raw_data", "$.id", "string").alias("event_id"),
        F.variant_get("raw_data", "$.type", "string").alias("event_type"),
        F.variant_get("raw_data", "$.repo.name", "string").alias("repo_name"),
        "file_name",
        "load_ts",
    )


def well_formed_rows(lake: Lake) -> DataFrame:
    """The rows that are left of lines some of which are blank or broken."""
    raw = ndjson.skip_malformed_lines(fx.with_bad_lines(lake.lines))
    fields = (("event_id", "$.id"), ("event_type", "$.type"))
    return raw.select(*[F.variant_get("raw_data", path, "string").alias(name) for name, path in fields], "file_name")


def expected_hours(lake: Lake) -> DataFrame:
    series = {
        "loaded_span": hours.loaded_span(lake.audit),
        "last_days": hours.expected_hours(lake.spark, AS_OF, 7),
        "midnights": hours.expected_midnights(lake.spark, AS_OF, 7),
        "trailing": hours.trailing_hours(lake.spark, AS_OF),
    }
    counts = lake.staged.groupBy(F.col("source_file").alias("file_name")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    rows = _union(*[df.withColumn("series", F.lit(name)) for name, df in series.items()])
    return rows.join(counts, "file_name", "left").select(
        "series", "expected_hour", "file_name", F.coalesce("event_count", F.lit(0)).alias("event_count")
    )


def hour_file_name(lake: Lake) -> DataFrame:
    per_hour = lake.staged.groupBy(fn.trunc_ts("hour", "created_at").alias("file_hour")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    name = fn.hour_file_name("file_hour")
    return per_hour.select(
        "file_hour", "event_count", name.alias("file_name"), fn.hour_of_file_name(name).alias("parsed_hour")
    )


def discover_files(lake: Lake) -> DataFrame:
    found = ndjson.discover_files(lake.spark, lake.landing, min_bytes=1)
    expected = hours.expected_hours(lake.spark, AS_OF, 25)
    return ndjson.available_files(found, expected).select("file_name", "file_hour")


def load_once(lake: Lake) -> DataFrame:
    raw_path, audit_path = lake.path("raw"), lake.path("audit")
    for _ in range(2):
        loads.load_once(lake.spark, lake.landing, raw_path, audit_path, AS_OF)
    raw = tables.read_table(lake.spark, raw_path, RAW_EVENTS)
    return raw.select(F.variant_get("raw_data", "$.id", "string").alias("event_id"), "file_name")


def bulk_append(lake: Lake) -> DataFrame:
    path = lake.path("raw")
    raw = ndjson.scan_hourly_ndjson(lake.spark, lake.landing, AS_OF)
    for _ in range(2):
        loads.bulk_append(raw, path)
    stored = tables.read_table(lake.spark, path, RAW_EVENTS)
    return stored.groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count"))


def record_loads(lake: Lake) -> DataFrame:
    outcomes = lake.audit.select(
        "file_name",
        "row_count",
        "file_size_bytes",
        "load_duration_seconds",
        F.when(F.col("status") == "FAILED", F.repeat(F.lit("timeout "), 200)).alias("error_message"),
    )
    return _seconds_as_double(loads.record_loads(outcomes, AS_OF, "loader"))


def delete_file_events(lake: Lake) -> DataFrame:
    """Delete one file of a stored lake; what was reported as deleted and what is left."""
    raw_path, audit_path = lake.path("raw"), lake.path("audit")
    loads.bulk_append(lake.raw, raw_path)
    loads.append_audit(lake.audit, audit_path)
    events, rows = loads.delete_file_events(lake.spark, raw_path, audit_path, "2024-01-15-3.json.gz")
    left = [
        (name, gone, tables.read_table(lake.spark, path, schema).count())
        for name, gone, path, schema in (
            ("raw_events", events, raw_path, RAW_EVENTS),
            ("load_history", rows, audit_path, LOAD_HISTORY),
        )
    ]
    return lake.spark.createDataFrame(left, "table_name STRING, deleted_rows BIGINT, kept_rows BIGINT")


def archive_old_loads(lake: Lake) -> DataFrame:
    """Both tables after the archive job has run twice."""
    audit_path, archive_path = lake.path("audit"), lake.path("archive")
    loads.append_audit(lake.audit, audit_path)
    for _ in range(2):
        loads.archive_loads(lake.spark, audit_path, archive_path, AS_OF, 10)
    kept, archived = (tables.read_table(lake.spark, p, LOAD_HISTORY) for p in (audit_path, archive_path))
    rows = _union(kept.withColumn("part", F.lit("kept")), archived.withColumn("part", F.lit("archived")))
    return rows.select("part", "file_name", "file_hour", "load_ts", "status", "row_count")


_BACKFILL_SPLIT = datetime(2024, 1, 28)


def backfill(lake: Lake) -> DataFrame:
    raw_path, audit_path = lake.path("raw"), lake.path("audit")
    earlier = lake.audit.where(F.col("file_hour") < F.lit(_BACKFILL_SPLIT).cast("timestamp_ntz"))
    loads.append_audit(earlier, audit_path)
    outcome = loads.backfill(lake.spark, lake.landing, raw_path, audit_path, AS_OF, days=7)
    return outcome.select("file_name", "expected_hour", "outcome", "reason", "row_count")


def backfill_summary(lake: Lake) -> DataFrame:
    split = F.lit(_BACKFILL_SPLIT).cast("timestamp_ntz")
    before = loads.loaded_files(lake.audit.where(F.col("file_hour") < split))
    done = lake.audit.where(F.col("file_hour") >= split)
    expected = hours.expected_hours(lake.spark, AS_OF, 7)
    outcomes = loads.backfill_outcomes(expected, before, done)
    return loads.backfill_summary(outcomes, lake.staged, lake.audit)


def latest_events(lake: Lake) -> DataFrame:
    rows = analytics.latest_events(lake.staged, AS_OF, 7, "PushEvent", 1000)
    return rows.select("event_id", "event_type", "created_at", "actor_id", "repo_id")


def contract(lake: Lake) -> DataFrame:
    return table_contract(
        {
            "raw_events": (lake.raw, RAW_EVENTS),
            "load_history": (lake.audit, LOAD_HISTORY),
            "stg_events": (staging.stg_events(lake.raw), STG_EVENTS),
            "dim_actor": (lake.actors, DIM_ACTOR),
            "dim_repository": (lake.repositories, DIM_REPOSITORY),
            "dim_event_type": (lake.types, DIM_EVENT_TYPE),
            "fact_events": (lake.fact, FACT_EVENTS),
        }
    )


# --- staging and marts ----------------------------------------------------------------------


def surrogate_key(lake: Lake) -> DataFrame:
    return lake.gappy.select(
        "event_id",
        fn.surrogate_key("event_id").alias("event_key"),
        fn.surrogate_key("actor_id").alias("actor_key"),
        fn.surrogate_key("repo_id", "actor_type").alias("pair_key"),
    )


_FACT = [c for c in FACT_EVENTS.names if c not in _CLOCKS]
_MERGED = ["event_id", "event_key", "actor_key", "event_date", "source_file", "loaded_at"]


def fact_events_incremental(lake: Lake) -> DataFrame:
    target = marts.fact_events(fx.loaded_before(lake.staged, fx.BASE_CUTOFF), AS_OF)
    return marts.fact_events_incremental(target, lake.staged, AS_OF).select(*_MERGED)


def upsert_by_key(lake: Lake) -> DataFrame:
    rows = lake.staged.select("event_id", "created_at", "loaded_at", "value")
    changed = rows.where(F.col("created_at") >= F.lit("2024-01-19").cast("timestamp_ntz"))
    changed = changed.withColumn("value", F.col("value") + 1)
    return merge.upsert_by_key(fx.loaded_before(rows, fx.BASE_CUTOFF), changed, "event_id")


def late_arrival_overlap(lake: Lake) -> DataFrame:
    events = fx.with_late_rows(lake.staged)
    target = marts.fact_events(fx.loaded_before(events, fx.BASE_CUTOFF), AS_OF)
    return marts.fact_events_overlap(target, events, AS_OF).select(*_MERGED)


def dim_actor_incremental(lake: Lake) -> DataFrame:
    cutoff = fx.EARLY_CUTOFF - timedelta(days=1)
    target = lake.actors_before(cutoff, cutoff)
    actors = staging.stg_actors(lake.staged)
    return marts.dim_actor_incremental(target, actors, AS_OF).drop(*_CLOCKS)


_ORDER = (2, 0, 1)  # in which thirds of the hours arrive


def _in_batches(lake: Lake) -> list[tuple[str, DataFrame]]:
    """The staged files dealt out hour by hour, so that every batch but the first splits what is stored; one comes twice."""
    hour = F.expr("unix_seconds(cast(created_at as timestamp)) div 3600")
    return [(str(i), lake.staged.where(hour % 3 == i)) for i in (*_ORDER, _ORDER[1])]


def dim_actor_scd2_batches(lake: Lake) -> DataFrame:
    """The type-2 dimension after batches in another order than that of the events."""
    path = lake.path("dim-actor")
    for _, batch in _in_batches(lake):
        target = tables.read_table(lake.spark, path, DIM_ACTOR)
        merged = marts.dim_actor_from_batch(target, batch, lake.staged, AS_OF)
        tables.overwrite_table(merged, path, marts.write_dim_actor)
    return tables.read_table(lake.spark, path, DIM_ACTOR).drop(*_CLOCKS)


def _event_type_tables(lake: Lake) -> pipeline.LakePaths:
    paths = pipeline.LakePaths(lake.path("types"))
    for name, batch in _in_batches(lake):
        pipeline.update_event_types(lake.spark, paths, batch, name)
    return paths


def dim_event_type_batches(lake: Lake) -> DataFrame:
    """The event type dimension from the stored counts and pairs of several batches."""
    paths = _event_type_tables(lake)
    counts = tables.read_table(lake.spark, paths.table("type_counts"), distinct.TYPE_COUNTS)
    pairs = tables.read_table(lake.spark, paths.table("type_entities"), distinct.TYPE_ENTITIES)
    return marts.dim_event_type(distinct.event_types(counts, pairs), AS_OF).drop(*_CLOCKS)


def event_types_approximate(lake: Lake) -> DataFrame:
    """Exact counts of a type with whether the merged sketches come within five per cent of the distinct ones."""
    approximate = distinct.approximate_event_types(distinct.type_counts(lake.staged))
    near = [
        (F.abs(F.col(f"a.{c}") - F.col(f"e.{c}")) <= F.col(f"e.{c}") * 0.05).alias(f"near_{c}")
        for c in ("unique_actors", "unique_repos")
    ]
    exact = staging.stg_event_types(lake.staged).alias("e")
    return exact.join(approximate.alias("a"), F.col("a.event_type") == F.col("e.event_type")).select(
        "e.event_type", "a.event_count", "e.unique_actors", "e.unique_repos", *near
    )


FIRST_DAY, LAST_DAY = date(2024, 1, 8), date(2024, 1, 21)


def stored_summary(lake: Lake, summary: DataFrame) -> DataFrame:
    """A daily summary written and read by day as the pipeline does."""
    path = lake.path("summary")
    tables.append_by_partition(summary, path, summaries.DAY)
    return lake.spark.read.parquet(path)


def event_rate_from_sketches(lake: Lake) -> DataFrame:
    """Rates of two weeks from daily sketches, and whether the exact ranks of the quantiles are near those asked for."""
    minutes = summaries.within(summaries.with_day(lake.staged), FIRST_DAY, LAST_DAY)
    counts = minutes.groupBy(F.date_trunc("minute", "created_at").alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    rate = summaries.rate_over(stored_summary(lake, summaries.minute_rates(lake.staged)), FIRST_DAY, LAST_DAY)
    wanted = {"p25_per_minute": 0.25, "median_per_minute": 0.5, "p75_per_minute": 0.75}
    found = rate.select(F.to_json(F.struct(*wanted)).alias("found"))
    ranks = counts.withColumn("found", F.from_json(found.scalar(), ", ".join(f"{c} DOUBLE" for c in wanted))).agg(
        *[(F.avg((F.col("n") < F.col(f"found.{c}")).cast("int")) <= p + summaries.RANK_ERROR).alias(f"{c}_low") for c, p in wanted.items()],
        *[(F.avg((F.col("n") <= F.col(f"found.{c}")).cast("int")) >= p - summaries.RANK_ERROR).alias(f"{c}_high") for c, p in wanted.items()],
    )
    near = reduce(lambda a, b: a & b, [F.col(f"{c}_{side}") for c in wanted for side in ("low", "high")])
    return rate.select("min_per_minute", "max_per_minute", "avg_per_minute", ranks.select(near).scalar().alias("near_quantiles"))


def load_duration_quantiles(lake: Lake) -> DataFrame:
    """Durations per status from daily sketches, and whether the exact ranks of the quantiles are near those asked for."""
    found = summaries.durations_over(stored_summary(lake, summaries.load_durations(lake.audit))).alias("f")
    seconds, e = F.col("load_duration_seconds").cast("double"), summaries.RANK_ERROR
    rows = lake.audit.where(seconds.isNotNull()).join(found, "status")
    wanted = {"median_duration_seconds": 0.5, "p95_duration_seconds": 0.95}
    near = [
        (F.avg((seconds < F.col(c)).cast("int")) <= p + e) & (F.avg((seconds <= F.col(c)).cast("int")) >= p - e)
        for c, p in wanted.items()
    ]
    kept = ["attempt_count", "avg_duration_seconds", "min_duration_seconds", "max_duration_seconds"]
    return rows.groupBy("status", *kept).agg((near[0] & near[1]).alias("near_quantiles"))


def top_repositories_over(lake: Lake) -> DataFrame:
    leaders = stored_summary(lake, summaries.daily_leaders(lake.staged, analytics.REPOSITORY))
    top = analytics.top_repositories_over(lake.staged, leaders, 50, FIRST_DAY, LAST_DAY)
    return top.withColumn("event_type_list", F.array_join("event_type_list", ","))


def top_developers_over(lake: Lake) -> DataFrame:
    leaders = stored_summary(lake, summaries.daily_leaders(lake.staged, analytics.DEVELOPER))
    return analytics.top_developers_over(lake.staged, leaders, 50, FIRST_DAY, LAST_DAY)


def mart_layout(lake: Lake) -> DataFrame:
    path = lake.path("fact")
    marts.write_fact(lake.fact, path)
    stored = marts.read_fact(lake.spark, path)
    return stored.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("event_count"), F.countDistinct("repo_key").alias("repo_count")
    )


def layout_lookups(lake: Lake) -> DataFrame:
    """Counts by each column the stored layouts are clustered by."""
    fact, history, actors = (lake.path(n) for n in ("fact", "history", "actors"))
    marts.write_fact(lake.fact, fact)
    layout.write_audit(lake.audit, history)
    marts.write_dim_actor(lake.scd2.select(*DIM_ACTOR.names), actors)
    stored = marts.read_fact(lake.spark, fact)
    audit = tables.read_table(lake.spark, history, LOAD_HISTORY)
    current = tables.read_table(lake.spark, actors, DIM_ACTOR).where("is_current")
    parts = (
        ("repository", stored, F.col("repo_key") == fn.surrogate_key(F.lit(7))),
        ("actor", stored, F.col("actor_key") == fn.surrogate_key(F.lit(25))),
        ("event", stored, F.col("event_id") == "500"),
        ("failed loads", audit, (F.col("status") == "FAILED") & (F.col("file_hour") >= F.lit(fx.BASE_CUTOFF).cast("timestamp_ntz"))),
        ("current actors", current, F.lit(True)),
    )
    counts = [df.agg(F.count_if(where).alias("row_count")).withColumn("lookup", F.lit(name)) for name, df, where in parts]
    return _union(*counts).select("lookup", "row_count")


def new_duplicate_keys(lake: Lake) -> DataFrame:
    """A batch against a stored fact by its Bloom filters: new events, and a copy of every 50th event of all."""
    path, filters = lake.path("fact"), lake.path("filters")
    marts.write_fact(marts.fact_events(fx.loaded_before(lake.staged, fx.BASE_CUTOFF), AS_OF), path)
    keyfilter.store_filters(marts.read_fact(lake.spark, path), "event_id", "event_date", filters)
    new = lake.staged.where(F.col("loaded_at") >= F.lit(fx.BASE_CUTOFF).cast("timestamp_ntz"))
    batch = new.unionByName(lake.staged.where(F.col("event_id").cast("bigint") % 50 == 0))
    stored = keyfilter.stored_rows(lake.spark, batch, path, FACT_EVENTS, filters, "event_id", "event_date")
    return keyfilter.new_duplicates(batch, stored, "event_id")


# --- reports --------------------------------------------------------------------------------


def top_repositories(lake: Lake) -> DataFrame:
    top = analytics.top_repositories(lake.staged, 50)
    return top.withColumn("event_type_list", F.array_join("event_type_list", ","))


def activity_trend(lake: Lake) -> DataFrame:
    grains = ("hour", "day", "week", "month")
    return _union(
        *[analytics.activity_trend(lake.staged, g).withColumn("grain", F.lit(g)) for g in grains]
    )


def model_row_counts(lake: Lake) -> DataFrame:
    return analytics.model_row_counts(
        {
            "raw_events": lake.raw,
            "load_history": lake.audit,
            "stg_events": lake.staged,
            "dim_actor": lake.actors,
            "dim_repository": lake.repositories,
            "dim_event_type": lake.types,
            "fact_events": lake.fact,
        }
    )


def freshness_status(lake: Lake) -> DataFrame:
    tiers = [("FRESH", 60), ("WARN", 120)]
    by_minute = quality.freshness_status(lake.load_times, AS_OF, "minute", tiers)
    return _union(
        quality.freshness_status(lake.load_times, AS_OF).withColumn("rule", F.lit("hours")),
        by_minute.withColumn("rule", F.lit("minutes")),
    )


def source_freshness(lake: Lake) -> DataFrame:
    sources = {"raw_events": lake.load_times, "load_history": lake.audit.select("load_ts")}
    return quality.source_freshness(sources, AS_OF)


def grade_metrics(lake: Lake) -> DataFrame:
    fact = lake.suite_models["fact_events"]
    metrics = quality.quality_metrics(lake.load_times, fact, lake.audit, lake.suite, AS_OF)
    return quality.grade_metrics(metrics)


def quality_summary(lake: Lake) -> DataFrame:
    dims = {n: lake.suite_models[n] for n in ("dim_actor", "dim_repository", "dim_event_type")}
    return quality.quality_summary(lake.suite, lake.suite_models["fact_events"], dims)


def stale_actors(lake: Lake) -> DataFrame:
    """The actor dimension as it was after the first day, so later actors are missing."""
    cutoff = fx.EARLY_CUTOFF - timedelta(days=1)
    return lake.actors_before(cutoff, AS_OF)


def relationships(lake: Lake) -> DataFrame:
    return quality.relationship_failures(lake.fact, stale_actors(lake), "actor_key")


# --- streaming ------------------------------------------------------------------------------


def event_stream(lake: Lake) -> DataFrame:
    """The driver's events table as a file stream, mapped to staged columns."""
    reader = lake.spark.readStream.schema(fx.EVENTS_DDL).option("pathGlobFilter", "events.parquet")
    return fx.to_staged(reader.parquet(lake.sf_dir))


def stream_ingest_files(lake: Lake) -> DataFrame:
    path, checkpoint = lake.path("raw"), lake.path("checkpoint")
    for _ in range(2):
        jobs.stream_ingest_files(lake.spark, lake.landing, path, checkpoint, AS_OF)
    raw = tables.read_table(lake.spark, path, RAW_EVENTS)
    return raw.select(F.variant_get("raw_data", "$.id", "string").alias("event_id"), "file_name")


def stream_dedup(lake: Lake) -> DataFrame:
    path = lake.path("dedup")
    rows = jobs.dedup_stream(fx.with_duplicates(event_stream(lake)))
    jobs.write_stream(rows.select("event_id", "event_type", "created_at"), path, lake.path("checkpoint"))
    return lake.spark.read.parquet(path)


def stream_hourly_counts(lake: Lake) -> DataFrame:
    path = lake.path("counts")
    jobs.write_stream(jobs.counts_stream(event_stream(lake)), path, lake.path("checkpoint"))
    return lake.spark.read.parquet(path).drop("approx_actors")


def stream_hourly_anomaly(lake: Lake) -> DataFrame:
    path = lake.path("anomaly")
    jobs.write_stream(jobs.hourly_anomaly_stream(event_stream(lake), "event_type"), path, lake.path("checkpoint"))
    return lake.spark.read.parquet(path)


def stream_dedup_stored(lake: Lake) -> DataFrame:
    """Events loaded before a day, then all events with copies by a query that has no state of the first."""
    path, columns = lake.path("stored"), ("event_id", "event_type", "created_at", "loaded_at")
    rows = fx.with_duplicates(event_stream(lake)).select(*columns)
    for part in (fx.loaded_before(rows, fx.BASE_CUTOFF), rows):
        jobs.stream_dedup_stored(part, path, lake.path("checkpoint"))
    return lake.spark.read.parquet(path).select("event_id", "event_type", "created_at")


def stream_late_data(lake: Lake) -> DataFrame:
    kept, late = lake.path("kept"), lake.path("late")
    rows = fx.with_late_rows(event_stream(lake)).select("event_id", "created_at", "loaded_at")
    jobs.stream_late_data(rows, kept, late, lake.path("checkpoint"), hours=2)
    stored = [lake.spark.read.parquet(p).withColumn("part", F.lit(n)) for p, n in ((kept, "kept"), (late, "late"))]
    return _union(*stored).select("event_id", "created_at", "loaded_at", "part")


def stream_upsert_marts(lake: Lake) -> DataFrame:
    paths = pipeline.LakePaths(lake.path("stream-lake"))
    base = fx.loaded_before(lake.staged, fx.BASE_CUTOFF)
    marts.write_fact(marts.fact_events(base, AS_OF), paths.table("fact_events"))
    stream = event_stream(lake).drop("language", "value")
    jobs.stream_upsert_marts(stream, paths, lake.path("checkpoint"), AS_OF)
    fact = pipeline.read(lake.spark, paths, "fact_events")
    actors = pipeline.read(lake.spark, paths, "dim_actor").select("actor_key", "is_bot", "is_current")
    rows = fact.join(actors.where("is_current"), "actor_key", "left")
    return rows.select("event_id", "event_key", "event_date", "actor_key", "is_bot", "loaded_at")


def run_pipeline(lake: Lake) -> DataFrame:
    """The report of the second of two runs, whose loads have the earlier time."""
    paths = pipeline.LakePaths(lake.path("lake"))
    first = lake.files.where(F.hour("file_hour") % 2 == 0)
    pipeline.run_pipeline(lake.spark, lake.landing, paths, AS_OF, first, test=False)
    return pipeline.run_pipeline(lake.spark, lake.landing, paths, AS_OF - timedelta(hours=1))


def scalar_semantics(lake: Lake) -> DataFrame:
    """Every scalar expression the jobs rely on, over all events."""
    at, login, repo = F.col("created_at"), F.col("actor_login"), F.col("repo_name")
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    document = F.to_json(F.struct(F.col("actor_id").alias("a"), F.col("actor_type").alias("t")))
    half = F.substring(document, F.lit(1), F.lit(4))
    return lake.staged.select(
        "event_id",
        F.try_variant_get(F.try_parse_json(document), "$.a", "bigint").alias("json_long"),
        F.try_variant_get(F.try_parse_json(document), "$.t", "string").alias("json_text"),
        F.try_variant_get(F.try_parse_json(F.lit('{"n":null}')), "$.n", "variant").isNotNull().alias("json_null_present"),
        F.try_parse_json(half).isNotNull().alias("half_is_json"),
        F.try_parse_json(document).cast("string").alias("json_string"),
        *[c.alias(name) for name, c in fn.calendar_columns("created_at").items()],
        *[fn.trunc_ts(u, at).alias(f"trunc_{u}") for u in ("minute", "hour", "day", "week", "month")],
        *[fn.boundary_diff(u, at, as_of).alias(f"diff_{u}") for u in ("minute", "hour", "day")],
        (at + F.expr("INTERVAL 65 MINUTES")).alias("plus_interval"),
        fn.round_half_up(F.col("value") / 8, 1).alias("rounded"),
        F.abs(F.col("value") - 50).alias("distance"),
        F.coalesce("actor_type", F.lit("none")).alias("coalesced"),
        login.ilike("%BOT]%").alias("is_bracket_bot"),
        F.split_part(repo, F.lit("/"), F.lit(1)).alias("part_one"),
        F.split_part(repo, F.lit("/"), F.lit(3)).alias("part_missing"),
        F.lpad(F.hour(at).cast("string"), 2, "0").alias("padded_hour"),
        F.substring(login, 1, 5).alias("login_head"),
        fn.surrogate_key("event_id").alias("md5_key"),
        fn.hour_file_name(at).alias("file_name"),
    )


def _registry() -> dict[str, Callable[[Lake], DataFrame]]:
    early = fx.EARLY_CUTOFF
    return {
        # sources, sinks, ingest
        "scan_hourly_ndjson": scan_hourly_ndjson,
        "skip_malformed_lines": lambda k: ndjson.line_counts(fx.with_bad_lines(k.lines)),
        "well_formed_rows": well_formed_rows,
        "validate_required_fields": lambda k: ndjson.validity_counts(k.gappy_raw),
        "strip_nul_chars": lambda k: k.staged.select(
            "event_id",
            fn.strip_nul(F.concat("actor_login", F.lit("\x00"), "event_type", F.lit("\x00"))).alias("cleaned"),
        ),
        "expected_hours": expected_hours,
        "hour_file_name": hour_file_name,
        "discover_files": discover_files,
        "next_unloaded_file": lambda k: loads.next_unloaded_file(k.files, k.audit, AS_OF, 72),
        "unloaded_files": lambda k: loads.unloaded_files(k.files, k.audit),
        "load_once": load_once,
        "bulk_append": bulk_append,
        "record_loads": record_loads,
        "delete_file_events": delete_file_events,
        "archive_old_loads": archive_old_loads,
        "last_successful_load": lambda k: loads.last_successful_load(k.audit),
        "backfill": backfill,
        "backfill_summary": backfill_summary,
        "latest_events": latest_events,
        "raw_sample": lambda k: analytics.raw_sample(k.raw, 10),
        "table_contract": contract,
        # staging
        "stg_events": lambda k: staging.stg_events(k.raw).drop("payload"),
        "classify_actor": lambda k: staging.with_actor_class(k.staged).select(
            "event_id", "actor_login", "actor_type"
        ),
        "stg_actors": lambda k: staging.stg_actors(k.staged),
        "stg_repositories": lambda k: staging.stg_repositories(k.staged),
        "stg_event_types": lambda k: staging.stg_event_types(k.staged),
        "payload_fields": lambda k: staging.payload_fields(k.raw),
        # marts
        "surrogate_key": surrogate_key,
        "fact_events_full": lambda k: k.fact.select(*_FACT),
        "fact_events_incremental": fact_events_incremental,
        "upsert_by_key": upsert_by_key,
        "late_arrival_overlap": late_arrival_overlap,
        "dedup_by_key": lambda k: merge.dedup_by_key(k.doubled).select(
            "event_id", "created_at", "source_file", "loaded_at"
        ),
        "dim_actor_full": lambda k: k.actors.drop(*_CLOCKS),
        "dim_actor_incremental": dim_actor_incremental,
        "dim_actor_scd2": lambda k: k.scd2.drop(*_CLOCKS),
        "dim_actor_scd2_history": lambda k: marts.actor_history(k.staged),
        "dim_actor_scd2_batches": dim_actor_scd2_batches,
        "dim_event_type_batches": dim_event_type_batches,
        "event_types_approximate": event_types_approximate,
        "dim_repository": lambda k: k.repositories.drop(*_CLOCKS),
        "dim_event_type": lambda k: k.types.drop(*_CLOCKS),
        "fact_push_events": lambda k: marts.fact_push_events(k.raw),
        "mart_layout": mart_layout,
        "layout_lookups": layout_lookups,
        "new_duplicate_keys": new_duplicate_keys,
        # reports
        "raw_overview": lambda k: analytics.raw_overview(k.staged),
        "null_profile": lambda k: analytics.null_profile(k.gappy_raw, fixed.REQUIRED_FIELDS),
        "event_type_distribution": lambda k: analytics.event_type_distribution(k.staged),
        "top_repositories": top_repositories,
        "top_developers": lambda k: analytics.top_developers(k.staged, 50),
        "daily_activity": lambda k: analytics.daily_activity(k.staged),
        "hourly_pattern": lambda k: analytics.hourly_pattern(k.staged, 30),
        "language_distribution": lambda k: analytics.language_distribution(k.staged, 30),
        "event_rate_from_sketches": event_rate_from_sketches,
        "load_duration_quantiles": load_duration_quantiles,
        "top_repositories_over": top_repositories_over,
        "top_developers_over": top_developers_over,
        "event_rate_per_minute": lambda k: analytics.event_rate_per_minute(k.staged),
        "quality_report_rows": lambda k: analytics.quality_report_rows(k.gappy_raw, k.gappy, k.audit),
        "duplicate_events": lambda k: analytics.duplicate_events(k.doubled),
        "future_events": lambda k: analytics.future_events(k.staged, datetime(2024, 1, 30, 12)),
        "star_join_rollup": lambda k: analytics.star_join_rollup(k.fact, k.actors, k.repositories, k.types),
        "star_join_rollup_at_event": lambda k: analytics.star_join_rollup(
            k.fact, k.scd2, k.repositories, k.types, at_event=True
        ),
        "developer_daily_at_event": lambda k: analytics.developer_daily(k.fact, k.scd2, at_event=True),
        "bot_share_at_event": lambda k: analytics.bot_share(
            k.fact, marts.dim_actor_history(k.staged, AS_OF), at_event=True
        ),
        "mart_top_repositories": lambda k: analytics.mart_top_repositories(
            k.fact, k.repositories, k.types
        ),
        "developer_daily": lambda k: analytics.developer_daily(k.fact, k.actors),
        "category_distribution": lambda k: analytics.category_distribution(k.fact, k.types),
        "activity_heatmap": lambda k: analytics.activity_heatmap(k.fact),
        "new_developers": lambda k: analytics.new_developers(staging.stg_actors(k.staged), early, 1),
        "type_trend": lambda k: analytics.type_trend(
            k.staged, ["PushEvent", "PullRequestEvent", "IssuesEvent"]
        ),
        "bot_share": lambda k: analytics.bot_share(k.fact, k.actors),
        "recently_active": lambda k: analytics.recently_active(k.staged, early, 1),
        "activity_trend": activity_trend,
        "model_row_counts": model_row_counts,
        # load monitoring
        "loads_by_hour": lambda k: monitoring.loads_by_hour(k.audit),
        "load_status_distribution": lambda k: monitoring.load_status_distribution(k.audit),
        "load_duration_by_status": lambda k: monitoring.load_duration_by_status(k.audit),
        "retry_candidates": lambda k: monitoring.retry_candidates(k.audit, AS_OF),
        "load_freshness": lambda k: monitoring.load_freshness(k.audit, AS_OF),
        "missing_hours": lambda k: monitoring.missing_hours(k.audit, AS_OF),
        "unloaded_hours": lambda k: monitoring.unloaded_hours(k.audit, AS_OF),
        "row_count_anomalies": lambda k: monitoring.row_count_anomalies(k.audit),
        "row_count_flags": lambda k: monitoring.row_count_anomalies(k.audit, keep_normal=True),
        "last_loaded_files": lambda k: monitoring.last_loaded_files(k.audit),
        "recent_loads": lambda k: monitoring.recent_loads(k.audit, AS_OF),
        "load_failures": lambda k: monitoring.load_failures(k.audit, 20),
        "load_daily_summary": lambda k: monitoring.load_daily_summary(k.audit),
        "file_load_stats": lambda k: monitoring.file_load_stats(k.audit),
        "load_performance": lambda k: monitoring.load_performance(k.audit, AS_OF),
        "load_volume": lambda k: monitoring.load_volume(k.audit),
        "load_success_rate": lambda k: monitoring.load_success_rate(k.audit),
        # data quality
        "freshness_status": freshness_status,
        "source_freshness": source_freshness,
        "staging_freshness": lambda k: quality.staging_freshness(k.staged, AS_OF),
        "event_trend_7d": lambda k: quality.event_trend(k.staged, AS_OF),
        "fact_integrity": lambda k: quality.fact_integrity(marts.fact_events(k.doubled, AS_OF)),
        "dimension_completeness": lambda k: quality.dimension_completeness(
            k.scd2, k.repositories, k.types, k.fact, datetime(2024, 1, 30, 20)
        ),
        "quality_summary": quality_summary,
        "hourly_anomaly": lambda k: quality.hourly_anomaly(k.fact, datetime(2024, 1, 30, 20)),
        "daily_volume_anomaly": lambda k: quality.daily_volume_anomaly(k.fact, AS_OF, 30, 0.95, 1.05),
        "check_raw_freshness": lambda k: quality.check_raw_freshness(k.load_times, AS_OF),
        "check_duplicates": lambda k: quality.check_duplicates(k.doubled),
        "check_missing_dimensions": lambda k: quality.missing_dimension_counts(
            marts.fact_events(k.gappy, AS_OF)
        ),
        "check_load_failures": lambda k: quality.check_load_failures(k.audit, AS_OF, 72),
        "dq_report": lambda k: quality.dq_checks(
            k.load_times, marts.fact_events(k.doubled, AS_OF), k.audit, AS_OF, 72
        ),
        "test_not_null": lambda k: quality.not_null_failures(
            k.gappy, ["event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name", "created_at"]
        ),
        "test_unique": lambda k: quality.unique_failures(k.doubled, "event_id"),
        "test_accepted_values": lambda k: quality.accepted_values_failures(
            k.staged, "event_type", fixed.EVENT_TYPES
        ),
        "test_relationships": relationships,
        "test_scd2_single_current": lambda k: quality.scd2_multiple_current(
            k.scd2.withColumn("is_current", F.lit(True))
        ),
        "test_type_coverage": lambda k: quality.uncovered_types(k.fact, k.known_types),
        "run_dq_suite": lambda k: quality.run_dq_suite(k.suite_models),
        "grade_metrics": grade_metrics,
        "min_rows_per_day": lambda k: quality.min_rows_per_day(k.staged, 330),
        # streaming
        "stream_ingest_files": stream_ingest_files,
        "stream_dedup": stream_dedup,
        "stream_hourly_counts": stream_hourly_counts,
        "stream_hourly_anomaly": stream_hourly_anomaly,
        "stream_dedup_stored": stream_dedup_stored,
        "stream_late_data": stream_late_data,
        "stream_upsert_marts": stream_upsert_marts,
        # pipeline and scalars
        "run_pipeline": run_pipeline,
        "scalar_semantics": scalar_semantics,
    }


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write the stored inputs now, so that timings do not include them."""
    lake = Lake(spark, sf_dir)
    lake.raw, lake.landing


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Lake], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Lake(spark, sf_dir))

    return {name: bind(query) for name, query in _registry().items()}
