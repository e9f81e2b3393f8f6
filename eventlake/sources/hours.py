"""Expected hours and the files that should hold them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions import hour_file_name, trunc_ts


def hour_series(bounds: DataFrame) -> DataFrame:
    """Explode a frame with ``start_hour`` and ``stop_hour`` into one row per hour."""
    hours = F.sequence("start_hour", "stop_hour", F.expr("INTERVAL 1 HOUR"))
    return bounds.select(F.explode(hours).alias("expected_hour"))


def _series(spark: SparkSession, start: datetime, stop: datetime) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("timestamp_ntz").alias("start_hour"),
        F.lit(stop).cast("timestamp_ntz").alias("stop_hour"),
    )
    return hour_series(bounds).withColumn("file_name", hour_file_name("expected_hour"))


def expected_hours(spark: SparkSession, as_of: datetime, days: int) -> DataFrame:
    """The last ``days`` x 24 complete hours; the newest starts one hour before ``as_of``'s."""
    newest = as_of.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)
    return _series(spark, newest - timedelta(hours=days * 24 - 1), newest)


def expected_midnights(spark: SparkSession, as_of: datetime, days: int) -> DataFrame:
    """Midnight of each of the last ``days`` days, ``as_of``'s own day included."""
    today = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    hours = _series(spark, today - timedelta(days=days - 1), today)
    return hours.where(F.hour("expected_hour") == 0)


def trailing_hours(spark: SparkSession, as_of: datetime, hours: int = 744) -> DataFrame:
    """``as_of``'s hour and the ``hours`` hours before it."""
    newest = as_of.replace(minute=0, second=0, microsecond=0)
    return _series(spark, newest - timedelta(hours=hours), newest)


def loaded_span(audit: DataFrame) -> DataFrame:
    """Every hour between the first and the last hour the audit table knows."""
    bounds = audit.agg(
        trunc_ts("hour", F.min("file_hour")).alias("start_hour"),
        trunc_ts("hour", F.max("file_hour")).alias("stop_hour"),
    )
    series = hour_series(bounds.where(F.col("start_hour").isNotNull()))
    return series.withColumn("file_name", hour_file_name("expected_hour"))
