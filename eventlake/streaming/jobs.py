"""Structured Streaming jobs.

Every job takes its checkpoint folder and runs with ``availableNow``: it processes what has
arrived since the last run, in bounded batches if the source sets a limit, and stops. Scheduled
hourly it is the incremental loader; without the trigger it runs continuously. Event time must be
TIMESTAMP for watermarks, so wall-clock columns are cast at the edge.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators import quality
from eventlake.operators.merge import dedup_by_key
from eventlake.plans import marts
from eventlake.plans.pipeline import TABLES, LakePaths, read
from eventlake.session import fresh_path
from eventlake.sources import audit, layout, ndjson, tables
from eventlake.streaming.anomaly import OUTPUT, CountsBefore


ACTOR_LOG = T.StructType(
    [
        T.StructField("actor_id", T.LongType()),
        T.StructField("actor_login", T.StringType()),
        T.StructField("actor_type", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def _run(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def line_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of new hour files as they appear below ``landing``."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.text(landing).select("value", ndjson.source_file_name().alias("file_name"))


def stream_ingest_files(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    checkpoint: str,
    load_ts: datetime,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load new files into the raw table, each once.

    The checkpoint remembers the files. A batch replaces the partitions of its own files, so a
    batch repeated after a failure leaves no second copy.
    """
    stamp = F.lit(load_ts).cast("timestamp_ntz").alias("load_ts")

    def batch(lines: DataFrame, _: int) -> None:
        rows = ndjson.valid_documents(lines)
        audit.bulk_append(rows.select("raw_data", stamp, "file_name"), raw_path)

    return _run(line_stream(spark, landing, files_per_batch), checkpoint, batch)


def with_event_time(events: DataFrame, delay: str) -> DataFrame:
    """Add ``event_time`` and its watermark."""
    timed = events.withColumn("event_time", F.col("created_at").cast("timestamp"))
    return timed.withWatermark("event_time", delay)


def dedup_stream(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """One row per event id; state is kept only for the watermark delay."""
    return with_event_time(events, delay).dropDuplicatesWithinWatermark(["event_id"])


def counts_stream(events: DataFrame, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Tumbling counts per window and type with approximate distinct actors."""
    return (
        with_event_time(events, delay)
        .groupBy(F.window("event_time", width).alias("w"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("actor_id").alias("approx_actors"),
        )
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "event_type",
            "event_count",
            "approx_actors",
        )
    )


def hourly_anomaly_stream(
    events: DataFrame,
    series: str | None = None,
    delay: str = "2 hours",
    before: int = 24,
    low: float = 0.8,
    high: float = 1.2,
    idle_hours: int = 24 * 30,
) -> DataFrame:
    """Each finished hour's count against the mean of the ``before`` hours with events before it.

    ``series`` names a string column with a series of its own per value; NULL is one of them. Without it all events are one
    series, called ``all``. Events are counted in windows first, so a keyed task sees one row per hour and series, however many
    events there are. Hours the watermark has not passed are not reported yet; events later than it are not counted.
    A series without events for ``idle_hours`` starts anew. Needs the RocksDB state store that the session settings choose.
    """
    name = F.col(series) if series else F.lit("all")
    hours = (
        with_event_time(events, delay)
        .groupBy(F.window("event_time", "1 hour").alias("w"), name.alias("series"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select("series", F.col("w.start").alias("event_hour"), F.window_time("w").alias("event_time"), "event_count")
    )
    counted = hours.groupBy("series").transformWithStateInPandas(
        CountsBefore(before, idle_hours), OUTPUT, outputMode="append", timeMode="eventTime"
    )
    means = counted.withColumns(
        {"event_hour": F.col("event_hour").cast("timestamp_ntz"), "mean": F.col("sum_before") / F.col("hours_before")}
    )
    return quality.against_mean(means, ("series", "event_hour"), "event_count", low, high)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once, and stop when nothing is left."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_dedup_stored(
    events: DataFrame, path: str, checkpoint: str, window: str = "2 hours", partition_col: str = "event_date"
) -> StreamingQuery:
    """Append events that the table does not hold yet, however long ago their first copy came.

    Copies that arrive within ``window`` of each other meet in the state, whose size that bounds: its clock is the time of arrival,
    so an event that happened long ago is never too late for it. What is left of a batch is anti-joined with the stored ids of
    the batch's dates; folders of other dates are not opened. That is exact if copies of an event have the same
    ``created_at``. Rows without an id or a date are kept, as nothing tells that they are copies.

    A folder per date and batch is written as a whole, so a batch repeated after a failure replaces its own rows and is not
    compared with them. The batch is named by the query, so a new checkpoint goes on with the same table.
    """
    arrived = events.withColumn("arrived_at", F.current_timestamp()).withWatermark("arrived_at", window)
    # rows without an id would all be copies of one another
    own = F.coalesce(F.concat(F.lit("i"), F.col("event_id")), F.concat(F.lit("n"), F.expr("uuid()")))
    once = arrived.withColumn("copy_of", own).dropDuplicatesWithinWatermark(["copy_of"]).drop("copy_of", "arrived_at")
    dated = once.withColumn(partition_col, F.to_date("created_at"))
    schema = T.StructType([*dated.schema.fields, T.StructField("batch", T.StringType())])

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = _kept(rows)
        name = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        dates = [r[0] for r in rows.where(F.col(partition_col).isNotNull()).select(partition_col).distinct().collect()]
        stored = tables.read_partitions(spark, path, schema, partition_col, dates).where(F.col("batch") != name)
        new = rows.join(stored.select("event_id", partition_col), ["event_id", partition_col], "left_anti")
        new = new.select(*dated.columns).withColumn("batch", F.lit(name))
        new.hint("rebalance", partition_col).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(partition_col, "batch").parquet(path)

    return _run(dated, checkpoint, batch)


def _kept(rows: DataFrame) -> DataFrame:
    """The rows of a batch as a table, so that the source is read once however often they are used."""
    path = fresh_path(rows.sparkSession, "batch")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stream_late_data(
    events: DataFrame, kept_path: str, late_path: str, checkpoint: str, hours: int = 2
) -> StreamingQuery:
    """Split arriving events into on-time rows and rows loaded over ``hours`` after they happened.

    Late rows are written to a side table instead of being dropped by a watermark. Both writes are
    partitioned by batch, so a repeated batch overwrites itself.
    """
    late = F.col("loaded_at") > F.col("created_at") + F.make_dt_interval(hours=F.lit(hours))

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows = _kept(rows).withColumn("is_late", F.coalesce(late, F.lit(False))).withColumn(
            "batch_id", F.lit(batch_id).cast("bigint")
        )
        for path, wanted in ((kept_path, ~F.col("is_late")), (late_path, F.col("is_late"))):
            tables.append_by_partition(rows.where(wanted).drop("is_late"), path, "batch_id")

    return _run(events, checkpoint, batch)


def stream_upsert_marts(
    events: DataFrame, paths: LakePaths, checkpoint: str, as_of: datetime, fixed_partitions: bool = False
) -> StreamingQuery:
    """Maintain the fact and the actor and repository dimensions from a stream of staged events.

    The fact is merged by event id, actor versions are spliced in event time; all tables come out
    the same when a batch is repeated or batches come in another order. What an actor was called when, without other columns, is
    logged per batch in ``actor_log``, to be read again where a late event splits a version. Rows are stamped
    with the batch's newest load, or with ``as_of`` in batches without load times.
    ``fixed_partitions`` is passed on to :func:`tables.upsert_table`.
    """
    start = as_of
    log = paths.table("actor_log")

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = _kept(rows)
        seen = rows.select(*ACTOR_LOG.names[:-1]).distinct().withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        tables.append_by_partition(seen, log, "batch_id")
        as_of = rows.agg(F.max("loaded_at")).first()[0] or start
        fact = marts.fact_events(dedup_by_key(rows), as_of).select(*TABLES["fact_events"].names)
        tables.upsert_table(
            fact,
            paths.table("fact_events"),
            "event_id",
            "event_date",
            TABLES["fact_events"],
            fixed_partitions,
            cluster=layout.fact_order(),
            options=layout.filter_options(layout.FACT_FILTERS),
        )
        actors = marts.dim_actor_from_batch(
            read(spark, paths, "dim_actor"), rows, tables.read_table(spark, log, ACTOR_LOG), as_of
        )
        tables.overwrite_table(actors.select(*TABLES["dim_actor"].names), paths.table("dim_actor"), marts.write_dim_actor)
        repositories = marts.dim_repository_from_batch(
            read(spark, paths, "dim_repository"), rows, as_of
        )
        tables.overwrite_table(
            repositories.select(*TABLES["dim_repository"].names), paths.table("dim_repository")
        )

    return _run(events, checkpoint, batch)
