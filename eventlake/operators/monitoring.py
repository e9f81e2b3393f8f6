"""Load monitoring over the audit table, which holds about one row per hour of data."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import (
    boundary_diff,
    hour_file_name,
    percent,
    round_half_up,
    trunc_ts,
)
from eventlake.sources.audit import latest_attempt
from eventlake.sources.hours import hour_series, trailing_hours


def _ts(value: datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _count() -> Column:
    return F.count(F.lit(1))


def _succeeded() -> Column:
    return F.col("status") == "SUCCESS"


def _unfinished() -> Column:
    return F.col("status").isin("FAILED", "RETRY")


def _duration() -> Column:
    return F.col("load_duration_seconds").cast("double")


def loads_by_hour(audit: DataFrame) -> DataFrame:
    """Successful files and rows per hour, newest first."""
    return (
        audit.where(_succeeded())
        .groupBy(trunc_ts("hour", "file_hour").alias("load_hour"))
        .agg(_count().alias("files_loaded"), F.sum("row_count").alias("total_rows"))
        .orderBy(F.col("load_hour").desc())
    )


def load_status_distribution(audit: DataFrame) -> DataFrame:
    """Files, rows and share of files per status."""
    groups = audit.groupBy("status").agg(
        _count().alias("file_count"), F.sum("row_count").alias("total_rows")
    )
    total = F.sum("file_count").over(Window.partitionBy())
    return groups.withColumn("percentage", percent(F.col("file_count"), total))


def load_duration_by_status(audit: DataFrame) -> DataFrame:
    """Attempts and average, shortest and longest duration per status."""
    timed = audit.where(F.col("load_duration_seconds").isNotNull())
    return timed.groupBy("status").agg(
        _count().alias("attempt_count"),
        round_half_up(F.avg(_duration()), 2).alias("avg_duration_seconds"),
        F.min(_duration()).alias("min_duration_seconds"),
        F.max(_duration()).alias("max_duration_seconds"),
    )


def load_failures(audit: DataFrame, limit: int | None = None) -> DataFrame:
    """Failed and to-be-retried loads, newest first."""
    rows = (
        audit.where(_unfinished())
        .select("file_name", "file_hour", "status", "error_message", "retry_count", "load_ts")
        .orderBy(F.col("load_ts").desc_nulls_last(), "file_name")
    )
    return rows if limit is None else rows.limit(limit)


def retry_candidates(audit: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Files whose newest attempt failed or is to be retried, within ``days`` days, newest first."""
    audit = latest_attempt(audit)
    return load_failures(audit.where(F.col("load_ts") >= _ts(as_of - timedelta(days=days))))


def load_freshness(audit: DataFrame, as_of: datetime) -> DataFrame:
    """Newest successfully loaded hour and how far it is behind ``as_of``."""
    newest = audit.where(_succeeded()).agg(
        F.max("file_hour").alias("latest_loaded_hour"), F.max("load_ts").alias("load_timestamp")
    )
    return newest.select(
        "*",
        boundary_diff("hour", "latest_loaded_hour", _ts(as_of)).alias("hours_behind"),
        boundary_diff("minute", "latest_loaded_hour", _ts(as_of)).alias("minutes_behind"),
    )


def missing_hours(audit: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Hours since the first load, at most ``days`` days back, whose file's newest attempt is no success."""
    audit = latest_attempt(audit)
    bounds = audit.agg(
        trunc_ts("hour", F.min("file_hour")).alias("start_hour"), _ts(as_of).alias("stop_hour")
    ).where(F.col("start_hour") <= F.col("stop_hour"))
    hours = hour_series(bounds).where(F.col("expected_hour") >= _ts(as_of - timedelta(days=days)))
    loads = audit.select(
        trunc_ts("hour", "file_hour").alias("expected_hour"),
        "file_name",
        "row_count",
        F.col("status").alias("load_status"),
    )
    status = (
        F.when(F.col("file_name").isNull(), "MISSING")
        .when(F.col("load_status") != "SUCCESS", "FAILED")
        .otherwise("LOADED")
    )
    return (
        hours.join(loads, "expected_hour", "left")
        .select("expected_hour", status.alias("status"), "file_name", "row_count")
        .where(F.col("status") != "LOADED")
        .orderBy(F.col("expected_hour").desc())
    )


def unloaded_hours(audit: DataFrame, as_of: datetime, hours: int = 744) -> DataFrame:
    """Hours of the trailing period without any audit row, with the file that should hold them."""
    known = audit.select(trunc_ts("hour", "file_hour").alias("expected_hour"))
    expected = trailing_hours(audit.sparkSession, as_of, hours).select("expected_hour")
    return (
        expected.join(known, "expected_hour", "left_anti")
        .select(
            F.col("expected_hour").alias("hour_value"),
            hour_file_name("expected_hour").alias("expected_file_name"),
        )
        .orderBy(F.col("hour_value").desc())
    )


def row_count_anomalies(audit: DataFrame, keep_normal: bool = False) -> DataFrame:
    """Successful files whose row count is beyond two sample deviations from the mean.

    ``keep_normal`` lists all successful files with their flag.
    """
    done = audit.where(_succeeded())
    stats = done.where(F.col("row_count") > 0).agg(
        F.avg("row_count").alias("mean"), F.stddev_samp("row_count").alias("deviation")
    )
    mean = stats.select("mean").scalar()
    deviation = stats.select("deviation").scalar()
    flagged = done.select(
        "file_name",
        "file_hour",
        "row_count",
        mean.alias("mean"),
        deviation.alias("deviation"),
    ).select(
        "file_name",
        "file_hour",
        "row_count",
        round_half_up("mean", 0).alias("expected_avg"),
        F.when(F.col("row_count") < F.col("mean") - 2 * F.col("deviation"), "LOW")
        .when(F.col("row_count") > F.col("mean") + 2 * F.col("deviation"), "HIGH")
        .otherwise("NORMAL")
        .alias("anomaly"),
    )
    if keep_normal:
        return flagged
    return flagged.where((F.col("row_count") > 0) & (F.col("anomaly") != "NORMAL")).distinct()


def last_loaded_files(audit: DataFrame, n: int = 24) -> DataFrame:
    """The ``n`` newest successfully loaded files."""
    rows = audit.where(_succeeded()).select(
        "file_name", "file_hour", "row_count", _duration().alias("load_duration_seconds"), "load_ts"
    )
    return rows.orderBy(F.col("file_hour").desc_nulls_last(), "file_name").limit(n)


def recent_loads(audit: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """All loads of the last ``days`` days, newest first."""
    return (
        audit.where(F.col("load_ts") >= _ts(as_of - timedelta(days=days)))
        .select(
            "file_name",
            "file_hour",
            "row_count",
            "status",
            _duration().alias("load_duration_seconds"),
            "load_ts",
        )
        .orderBy(F.col("load_ts").desc(), "file_name")
    )


def load_daily_summary(audit: DataFrame) -> DataFrame:
    """Per file day, all statuses: files, successes, failures, rows, average duration."""
    return audit.groupBy(trunc_ts("day", "file_hour").alias("load_date")).agg(
        _count().alias("files_loaded"),
        F.count_if(_succeeded()).alias("success_count"),
        F.count_if(_unfinished()).alias("failed_count"),
        F.sum("row_count").alias("total_rows_loaded"),
        F.avg(_duration()).alias("avg_load_time_seconds"),
        F.max("load_ts").alias("last_load_time"),
    )


def file_load_stats(audit: DataFrame) -> DataFrame:
    """Per file day, successful loads only: files and rows per file."""
    done = audit.where(_succeeded())
    return done.groupBy(trunc_ts("day", "file_hour").alias("load_date")).agg(
        _count().alias("files_loaded"),
        F.sum("row_count").alias("total_events"),
        F.avg("row_count").alias("avg_events_per_file"),
        F.min("row_count").alias("min_events"),
        F.max("row_count").alias("max_events"),
        round_half_up(F.avg(_duration()), 2).alias("avg_load_time"),
    )


def load_performance(audit: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Per load date of the last ``days`` days: files, rows, durations, failures."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    recent = audit.where(F.col("load_ts") >= _ts(midnight - timedelta(days=days)))
    return recent.groupBy(F.to_date("load_ts").alias("load_date")).agg(
        _count().alias("files_loaded"),
        F.sum("row_count").alias("total_events"),
        F.avg(_duration()).alias("avg_load_time_seconds"),
        F.max(_duration()).alias("max_load_time_seconds"),
        F.min(_duration()).alias("min_load_time_seconds"),
        F.count_if(F.col("status") == "FAILED").alias("failed_loads"),
    )


def load_volume(audit: DataFrame) -> DataFrame:
    """Rows and files loaded so far, as one row."""
    return audit.where(_succeeded()).agg(
        F.sum("row_count").alias("total_events"),
        _count().alias("files_loaded"),
        F.max("load_ts").alias("last_load_time"),
    )


def load_success_rate(audit: DataFrame) -> DataFrame:
    """Share of successful loads per file day and rows loaded so far.

    The running sum goes over one row per day.
    """
    days = audit.groupBy(F.to_date("file_hour").alias("load_date")).agg(
        _count().alias("files"),
        F.count_if(_succeeded()).alias("success_files"),
        F.coalesce(F.sum(F.when(_succeeded(), F.col("row_count"))), F.lit(0)).alias("rows_loaded"),
    )
    so_far = Window.orderBy("load_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select(
        "load_date",
        percent(F.col("success_files"), F.col("files")).alias("success_percent"),
        "rows_loaded",
        F.sum("rows_loaded").over(so_far).alias("cumulative_rows"),
    )
