"""The hourly pipeline: ingest, staging, marts, then tests and freshness.

Each step writes its table and the next one reads it back, so a lost executor only repeats tasks
of the running step. A ledger says which loads each step has processed; its work is the successful loads that are not
in it, read by folder. So loads are processed in whatever order their times come, and folders of processed
loads are not opened. A step that breaks off is repeated, which its merge does not mind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import analytics, distinct, quality, summaries
from eventlake.operators.merge import dedup_by_key
from eventlake.plans import marts, staging
from eventlake.plans.together import run_together
from eventlake.schemas import (
    DIM_ACTOR,
    DIM_EVENT_TYPE,
    DIM_REPOSITORY,
    FACT_EVENTS,
    LOAD_HISTORY,
    RAW_EVENTS,
    STG_EVENTS,
    require_schema,
)
from eventlake.session import fresh_path
from eventlake.sources import audit as loads
from eventlake.sources import layout, ledger, tables


@dataclass(frozen=True)
class LakePaths:
    """Where the tables live below one root folder."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


TABLES = {
    "raw_events": RAW_EVENTS,
    "load_history": LOAD_HISTORY,
    "stg_events": STG_EVENTS,
    "dim_actor": DIM_ACTOR,
    "dim_repository": DIM_REPOSITORY,
    "dim_event_type": DIM_EVENT_TYPE,
    "fact_events": FACT_EVENTS,
}


LEDGER = "pipeline_ledger"


def read(spark: SparkSession, paths: LakePaths, name: str) -> DataFrame:
    return tables.read_table(spark, paths.table(name), TABLES[name])


def loaded(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """``file_name, load_ts`` of every file's last successful load."""
    return loads.last_loads(read(spark, paths, "load_history"))


def _pending(spark: SparkSession, paths: LakePaths, step: str) -> list[ledger.Load]:
    return ledger.pending(spark, paths.table(LEDGER), step, loaded(spark, paths))


def _done(spark: SparkSession, paths: LakePaths, step: str, work: list[ledger.Load]) -> None:
    ledger.record(spark, paths.table(LEDGER), step, work)


def _files(work: list[ledger.Load]) -> list[str]:
    return [load.file_name for load in work]


def _staged(spark: SparkSession, paths: LakePaths, names: list[str]) -> DataFrame:
    return tables.read_partitions(spark, paths.table("stg_events"), STG_EVENTS, "source_file", names)


def build_staging(spark: SparkSession, paths: LakePaths) -> None:
    """Stage the files not staged yet; a file replaces its own earlier rows, also by none."""
    work = _pending(spark, paths, "staging")
    if not work:
        return
    raw = tables.read_partitions(spark, paths.table("raw_events"), RAW_EVENTS, "file_name", _files(work))
    staged = require_schema(staging.stg_events(raw), STG_EVENTS)
    for load in work:
        if load.again:
            tables.delete_partition(spark, paths.table("stg_events"), "source_file", load.file_name)
    tables.append_by_partition(staged, paths.table("stg_events"), "source_file")
    _done(spark, paths, "staging", work)


def build_dimensions(spark: SparkSession, paths: LakePaths, as_of: datetime) -> None:
    """Merge the files not merged yet into the dimensions; files may come in any order and more than once.

    Actor versions are spliced in event time, repositories merge as minima, maxima and latest values, and the
    event types come from stored counts and pairs. Older events are read only where a late event splits an actor's version.
    A file that was loaded again may have taken events away, which no merge can undo: then actors and event types are built
    from all staged events once.
    """
    work = _pending(spark, paths, "dimensions")
    if not work:
        return
    fresh, events = _staged(spark, paths, _files(work)), read(spark, paths, "stg_events")
    again = any(load.again for load in work)
    if again:
        actors = marts.dim_actor_history(events, as_of)
    else:
        actors = marts.dim_actor_from_batch(read(spark, paths, "dim_actor"), fresh, events, as_of)
    tables.overwrite_table(require_schema(actors, DIM_ACTOR), paths.table("dim_actor"), marts.write_dim_actor)
    repositories = marts.dim_repository_from_batch(read(spark, paths, "dim_repository"), fresh, as_of)
    tables.overwrite_table(require_schema(repositories, DIM_REPOSITORY), paths.table("dim_repository"))
    types = marts.dim_event_type(update_event_types(spark, paths, fresh, _batch_of(work), events if again else None), as_of)
    tables.overwrite_table(require_schema(types, DIM_EVENT_TYPE), paths.table("dim_event_type"))
    _done(spark, paths, "dimensions", work)


def _batch_of(work: list[ledger.Load]) -> str:
    """A name for a set of loads, the same whenever the same loads are processed."""
    return hashlib.sha256("\n".join(sorted(f"{x.file_name} {x.load_ts}" for x in work)).encode()).hexdigest()[:16]


def update_event_types(
    spark: SparkSession, paths: LakePaths, fresh: DataFrame, batch: str, everything: DataFrame | None = None
) -> DataFrame:
    """Add a batch of whole files to the stored counts and pairs; staged event types of all events so far.

    Both tables have a folder per batch, which is written as a whole, so a repeated batch replaces its own rows. A batch that
    broke off and comes again with more files has another name; its files tell which folder of counts to remove. Pairs
    of such a folder are right all the same. ``everything`` rebuilds both tables from all events.
    """
    counts_path, pairs_path = paths.table("type_counts"), paths.table("type_entities")
    counts, pairs = fresh_path(spark, "type-counts"), fresh_path(spark, "type-entities")
    source = fresh if everything is None else everything
    new = distinct.type_entities(source)
    if everything is None:
        known = tables.read_table(spark, pairs_path, distinct.TYPE_ENTITIES).where(F.col("batch") != batch)
        new = distinct.unseen(new, known)
    for frame, path in ((distinct.type_counts(source), counts), (new, pairs)):
        frame.withColumn("batch", F.lit(batch)).hint("rebalance").write.parquet(path)
    counts = spark.read.schema(distinct.TYPE_COUNTS).parquet(counts)
    pairs = spark.read.schema(distinct.TYPE_ENTITIES).parquet(pairs)
    if everything is None:
        before = tables.read_table(spark, counts_path, distinct.TYPE_COUNTS).where(F.col("batch") != batch)
        broken_off = before.join(counts.select("source_file").distinct(), "source_file", "left_semi")
        for row in broken_off.select("batch").distinct().collect():
            tables.delete_partition(spark, counts_path, "batch", row.batch)
        tables.append_by_partition(counts, counts_path, "batch")
        tables.append_by_partition(pairs, pairs_path, "batch")
    else:
        for frame, path in ((counts, counts_path), (pairs, pairs_path)):
            tables.overwrite_table(frame, path, lambda df, folder: df.write.partitionBy("batch").parquet(folder))
    return distinct.event_types(
        tables.read_table(spark, counts_path, distinct.TYPE_COUNTS),
        tables.read_table(spark, pairs_path, distinct.TYPE_ENTITIES),
    )


def build_fact(spark: SparkSession, paths: LakePaths, as_of: datetime) -> None:
    """Merge the files not merged yet; afterwards the fact is what a full build would give.

    The copy of an event that was loaded last wins, whatever the order of processing: a copy that is
    older than the stored one is left out. For a file that was loaded again, events of either of its loads are taken
    from all staged files, and those that no file has any longer are deleted.
    """
    work = _pending(spark, paths, "fact")
    if not work:
        return
    path, names = paths.table("fact_events"), _files(work)
    events = dedup_by_key(_staged(spark, paths, names))
    if not tables.has_data(spark, path):
        marts.write_fact(require_schema(marts.fact_events(events, as_of), FACT_EVENTS), path)
        _done(spark, paths, "fact", work)
        return
    stored = read(spark, paths, "fact_events")
    again = [load.file_name for load in work if load.again]
    deletes = None
    if again:
        old = stored.where(F.col("source_file").isin(again)).select("event_id", "event_date")
        ids = old.select("event_id").unionByName(_staged(spark, paths, again).select("event_id")).distinct()
        everywhere = read(spark, paths, "stg_events").join(ids, "event_id", "left_semi")
        current = dedup_by_key(everywhere.select(*STG_EVENTS.names))
        deletes = old.join(current.where(F.col("created_at").isNotNull()).select("event_id"), "event_id", "left_anti")
        events = events.join(ids, "event_id", "left_anti").select(*STG_EVENTS.names)
        events = marts.newer_than_stored(events, stored).unionByName(current)
    else:
        events = marts.newer_than_stored(events, stored)
    fact = require_schema(marts.fact_events(events, as_of), FACT_EVENTS)
    # an event's date is fixed by its time; only another content of a file can move it
    tables.upsert_table(
        fact,
        path,
        "event_id",
        "event_date",
        FACT_EVENTS,
        not again,
        deletes,
        cluster=layout.fact_order(),
        options=layout.filter_options(layout.FACT_FILTERS),
    )
    _done(spark, paths, "fact", work)


SUMMARIES = {
    "minute_rates": summaries.minute_rates,
    "repository_leaders": lambda events: summaries.daily_leaders(events, analytics.REPOSITORY),
}


def build_summaries(spark: SparkSession, paths: LakePaths) -> None:
    """Bring the daily summaries of the fact up to date; only days that new files have events of are read.

    If a file was loaded again its earlier events may be gone from any day, so all days are summed up anew.
    """
    work = _pending(spark, paths, "summaries")
    if not work:
        return
    again = any(load.again for load in work)
    fact = read(spark, paths, "fact_events")
    if not again:
        times = _staged(spark, paths, _files(work)).select(F.to_date("created_at").alias(summaries.DAY))
        days = [row[0] for row in times.where(F.col(summaries.DAY).isNotNull()).distinct().collect()]
        fact = tables.read_partitions(spark, paths.table("fact_events"), FACT_EVENTS, summaries.DAY, days)
    for name, sum_up in SUMMARIES.items():
        if again:
            tables.overwrite_table(
                sum_up(fact), paths.table(name), lambda df, folder: df.write.partitionBy(summaries.DAY).parquet(folder)
            )
        else:
            tables.append_by_partition(sum_up(fact), paths.table(name), summaries.DAY)
    _done(spark, paths, "summaries", work)


def lake_models(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    """All tables and staging views by the names the declared tests use."""
    models = {name: read(spark, paths, name) for name in TABLES}
    models["stg_actors"] = staging.stg_actors(models["stg_events"])
    models["stg_repositories"] = staging.stg_repositories(models["stg_events"])
    models["stg_event_types"] = staging.stg_event_types(models["stg_events"])
    return models


def run_pipeline(
    spark: SparkSession,
    landing: str,
    paths: LakePaths,
    as_of: datetime,
    expected: DataFrame | None = None,
    test: bool = True,
) -> DataFrame:
    """Run all steps once; returns ``step_no, step, status, row_count``.

    ``expected`` limits the run to files of these names. ``test=False`` leaves the declared tests, which read whole tables,
    to another run; the tables are the same.

    The counts come from the stored tables. ``ingest`` is ``failed`` if a file could not be loaded. ``tests`` reports declared tests that failed,
    ``freshness`` whether the newest load is within the declared age.
    """
    new = loads.load_once(spark, landing, paths.table("raw_events"), paths.table("load_history"), as_of, expected=expected)
    failed = new.where(F.col("status") == "FAILED").count()
    loads.compact_audit(spark, paths.table("load_history"))
    build_staging(spark, paths)
    build_dimensions(spark, paths, as_of)
    build_fact(spark, paths, as_of)
    build_summaries(spark, paths)

    return report(spark, paths, as_of, failed, test)


def report(spark: SparkSession, paths: LakePaths, as_of: datetime, failed: int = 0, test: bool = True) -> DataFrame:
    """Row counts, declared tests and freshness of the stored tables, all at the same time; one row per step.

    They only read, so none waits for another: a stale source is known before the tests have ended. Only one count and
    one status per step reach the driver.
    """
    models = lake_models(spark, paths)

    def rows_of(name: str) -> Callable[[], tuple[str, int]]:
        status = "failed" if failed and name == "raw_events" else "done"
        return lambda: (status, models[name].count())

    def tested() -> tuple[str, int]:
        bad = quality.run_dq_suite(models).where(F.col("status") != "pass").count()
        return ("warn" if bad else "pass"), bad

    def freshness() -> tuple[str, int]:
        return quality.source_freshness({"raw_events": models["raw_events"]}, as_of).first()["status"], 1

    names = ("fact_events", "dim_actor", "dim_repository", "dim_event_type")
    steps = {"ingest": rows_of("raw_events"), "staging": rows_of("stg_events")}
    steps |= {"fact" if name == "fact_events" else name: rows_of(name) for name in names}
    if test:
        steps["tests"] = tested
    steps["freshness"] = freshness
    found = run_together(spark, steps)
    rows = [(number, step, *found[step]) for number, step in enumerate(steps, 1)]
    return spark.createDataFrame(rows, "step_no BIGINT, step STRING, status STRING, row_count BIGINT").coalesce(1)
