"""Declared table schemas and the contract check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


STRING, LONG, DOUBLE, BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TIME, VARIANT = T.DateType(), T.TimestampNTZType(), T.VariantType()
SECONDS = T.DecimalType(10, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW_EVENTS = _schema(
    raw_data=VARIANT,
    load_ts=TIME,
    file_name=STRING,
)

LOAD_HISTORY = _schema(
    file_name=STRING,
    load_ts=TIME,
    file_hour=TIME,
    row_count=LONG,
    file_size_bytes=LONG,
    status=STRING,
    error_message=STRING,
    retry_count=LONG,
    load_duration_seconds=SECONDS,
    loaded_by=STRING,
)

STG_EVENTS = _schema(
    event_id=STRING,
    event_type=STRING,
    actor_id=LONG,
    actor_login=STRING,
    actor_type=STRING,
    repo_id=LONG,
    repo_name=STRING,
    created_at=TIME,
    payload=VARIANT,
    source_file=STRING,
    loaded_at=TIME,
)

DIM_ACTOR = _schema(
    actor_key=STRING,
    actor_id=LONG,
    actor_login=STRING,
    actor_type=STRING,
    first_seen_at=TIME,
    last_seen_at=TIME,
    days_active=LONG,
    is_bot=BOOL,
    valid_from=TIME,
    valid_to=TIME,
    is_current=BOOL,
    created_ts=TIME,
    updated_ts=TIME,
)

DIM_REPOSITORY = _schema(
    repo_key=STRING,
    repo_id=LONG,
    repo_name=STRING,
    repo_owner=STRING,
    repo_short_name=STRING,
    first_event_at=TIME,
    last_event_at=TIME,
    days_active=LONG,
    is_test_repo=BOOL,
    created_ts=TIME,
    updated_ts=TIME,
)

DIM_EVENT_TYPE = _schema(
    event_type_key=STRING,
    event_type=STRING,
    event_description=STRING,
    event_count=LONG,
    unique_actors=LONG,
    unique_repos=LONG,
    percent_of_total_events=DOUBLE,
    first_occurrence=TIME,
    last_occurrence=TIME,
    event_category=STRING,
    created_ts=TIME,
    updated_ts=TIME,
)

FACT_EVENTS = _schema(
    event_key=STRING,
    event_id=STRING,
    actor_key=STRING,
    repo_key=STRING,
    event_type_key=STRING,
    event_type=STRING,
    actor_id=LONG,
    actor_login=STRING,
    repo_id=LONG,
    repo_name=STRING,
    created_at=TIME,
    event_date=DATE,
    event_hour=LONG,
    event_day_of_week=STRING,
    event_week=LONG,
    event_month=LONG,
    event_year=LONG,
    source_file=STRING,
    loaded_at=TIME,
    created_ts=TIME,
)


class SchemaDriftError(ValueError):
    """A table does not have the declared columns."""


def schema_drift(df: DataFrame, declared: T.StructType) -> list[str]:
    """Differences between a frame and a declaration; column order does not matter."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in declared}
    notes = [f"missing column {c}" for c in want if c not in have]
    notes += [f"unexpected column {c}" for c in have if c not in want]
    notes += [
        f"column {c} is {have[c].simpleString()}, declared {want[c].simpleString()}"
        for c in want
        if c in have and have[c] != want[c]
    ]
    return notes


def require_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Return ``df`` in declared column order, or raise on drift."""
    notes = schema_drift(df, declared)
    if notes:
        raise SchemaDriftError("; ".join(notes))
    return df.select(*declared.names)


def table_contract(tables: dict[str, tuple[DataFrame | None, T.StructType]]) -> DataFrame:
    """One row per table: does it exist, does it match its declaration, how many rows.

    ``tables`` maps a name to (frame or None, declared schema). The counts are one union of
    aggregates, so Spark runs them side by side.
    """
    reports = []
    spark = next(df for df, _ in tables.values() if df is not None).sparkSession
    for name, (df, declared) in tables.items():
        if df is None:
            rows = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
            notes = ["table does not exist"]
        else:
            rows = df.agg(F.count(F.lit(1)).alias("row_count"))
            notes = schema_drift(df, declared)
        reports.append(
            rows.select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit("FAIL" if notes else "PASS").alias("status"),
                F.lit("; ".join(notes) or "as declared").alias("note"),
            )
        )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
