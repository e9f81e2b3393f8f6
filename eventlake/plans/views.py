"""Temporary views and SQL functions, so the tables can be queried with SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from eventlake.functions import fixed
from eventlake.operators import monitoring
from eventlake.plans.pipeline import LakePaths, lake_models


def register_views(spark: SparkSession, paths: LakePaths, as_of: datetime) -> list[str]:
    """One temporary view per table, staging model and audit report; returns their names."""
    views = lake_models(spark, paths)
    audit = views["load_history"]
    views |= {
        "load_history_recent": monitoring.recent_loads(audit, as_of),
        "load_history_failures": monitoring.load_failures(audit),
        "load_history_daily_summary": monitoring.load_daily_summary(audit),
        "unloaded_hours": monitoring.unloaded_hours(audit, as_of),
        "last_loaded_files": monitoring.last_loaded_files(audit),
        "missing_hours": monitoring.missing_hours(audit, as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def register_functions(spark: SparkSession) -> None:
    """SQL forms of the column helpers; they are inlined into the plan like any expression."""
    definitions = {
        "surrogate_key(key STRING)": ("STRING", f"md5(coalesce(key, '{fixed.NULL_KEY}'))"),
        "classify_actor(given STRING, login STRING)": (
            "STRING",
            f"coalesce(given, CASE WHEN login ILIKE '{fixed.BOT_PATTERN}' THEN 'Bot' ELSE 'User' END)",
        ),
        "hour_file_name(hour TIMESTAMP_NTZ)": (
            "STRING",
            f"date_format(hour, '{fixed.HOUR_FORMAT}') || '{fixed.FILE_SUFFIX}'",
        ),
        "hours_between(started TIMESTAMP_NTZ, ended TIMESTAMP_NTZ)": (
            "BIGINT",
            "timestampdiff(HOUR, date_trunc('HOUR', started), date_trunc('HOUR', ended))",
        ),
    }
    for signature, (kind, body) in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
