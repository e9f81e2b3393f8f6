"""The load-audit table: what was loaded, what still has to be, and the loads themselves.

The audit holds one row per file and attempt, so it stays small: one row per hour of data.
"""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions import fixed, hour_of_file_name, trunc_ts
from eventlake.schemas import LOAD_HISTORY, RAW_EVENTS
from eventlake.session import fresh_path
from eventlake.sources import layout, ledger, tables
from eventlake.sources.hours import expected_hours
from eventlake.sources.ndjson import discover_files, scan_hourly_ndjson

# a month of hourly appends
MOST_AUDIT_FILES = 24 * 31


# --- reads ----------------------------------------------------------------------------------


def latest_attempt(audit: DataFrame) -> DataFrame:
    """The row of each file's newest attempt: the state of the file. Of attempts at one time a success counts."""
    order = F.struct(F.col("load_ts"), F.col("status") == "SUCCESS")
    newest = audit.groupBy("file_name").agg(F.max_by(F.struct(*audit.columns), order).alias("row"))
    return newest.select("row.*")


def last_loads(audit: DataFrame) -> DataFrame:
    """``file_name, load_ts`` of each file's last successful load."""
    done = audit.where(F.col("status") == "SUCCESS")
    return done.groupBy("file_name").agg(F.max("load_ts").alias("load_ts"))


def loaded_files(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("status") == "SUCCESS").select("file_name")


def unloaded_files(candidates: DataFrame, audit: DataFrame) -> DataFrame:
    """Candidate files without a successful load."""
    return candidates.join(loaded_files(audit), "file_name", "left_anti")


def next_unloaded_file(
    available: DataFrame, audit: DataFrame, as_of: datetime, look_back_hours: int = 2
) -> DataFrame:
    """The newest available, not yet loaded file of the last ``look_back_hours`` hours."""
    now = as_of.replace(minute=0, second=0, microsecond=0)
    recent = available.where(
        (F.col("file_hour") >= F.lit(now - timedelta(hours=look_back_hours)).cast("timestamp_ntz"))
        & (F.col("file_hour") < F.lit(now).cast("timestamp_ntz"))
    )
    todo = unloaded_files(recent, audit)
    return todo.orderBy(F.col("file_hour").desc_nulls_last(), "file_name").limit(1)


def last_successful_load(audit: DataFrame) -> DataFrame:
    """File and hour of the newest successful load."""
    done = audit.where(F.col("status") == "SUCCESS").select("file_name", "file_hour")
    return done.orderBy(F.col("file_hour").desc_nulls_last(), "file_name").limit(1)


def archive_old_loads(
    audit: DataFrame, as_of: datetime, days_to_keep: int = 90
) -> tuple[DataFrame, DataFrame]:
    """Split into (kept, archived): successful loads older than ``days_to_keep`` are archived."""
    horizon = F.lit(as_of - timedelta(days=days_to_keep)).cast("timestamp_ntz")
    is_old = F.coalesce((F.col("status") == "SUCCESS") & (F.col("load_ts") < horizon), F.lit(False))
    return audit.where(~is_old), audit.where(is_old)


def archive_loads(spark: SparkSession, audit_path: str, archive_path: str, as_of: datetime, days_to_keep: int = 90) -> int:
    """Move old successful loads from the audit table to the archive; returns how many left the audit table.

    The archive is written first and only gains rows it lacks, so a run that breaks off is simply repeated.
    """
    audit = tables.read_table(spark, audit_path, LOAD_HISTORY)
    kept, old = archive_old_loads(audit, as_of, days_to_keep)
    moved = old.count()
    if moved:
        archive = tables.read_table(spark, archive_path, LOAD_HISTORY)
        new = old.join(archive.select("file_name", "load_ts"), ["file_name", "load_ts"], "left_anti")
        path = fresh_path(spark, "archive-rows")
        new.select(*LOAD_HISTORY.names).coalesce(1).write.parquet(path)
        tables.append_rows(spark.read.schema(LOAD_HISTORY).parquet(path), archive_path)
        tables.overwrite_table(kept, audit_path, layout.write_audit)
    return moved


def compact_audit(spark: SparkSession, audit_path: str, most_files: int = MOST_AUDIT_FILES) -> bool:
    """Rewrite the audit once its appends have left more than ``most_files`` files; True if it did.

    Every hourly load appends a small file. No load may run meanwhile, as for other rewrites of the audit.
    """
    if tables.file_count(spark, audit_path) <= most_files:
        return False
    tables.overwrite_table(tables.read_table(spark, audit_path, LOAD_HISTORY), audit_path, layout.write_audit)
    return True


def without_file(table: DataFrame, file_name: str) -> DataFrame:
    """All rows but those of one file."""
    return table.where(F.col("file_name") != file_name)


def deletion_counts(tables_by_name: dict[str, DataFrame], file_name: str) -> DataFrame:
    """Per table: rows that belong to the file and rows that stay."""
    result = None
    is_file = F.col("file_name") == file_name
    for name, table in tables_by_name.items():
        counts = table.agg(
            F.count_if(is_file).alias("deleted_rows"), F.count_if(~is_file).alias("kept_rows")
        ).select(F.lit(name).alias("table_name"), "deleted_rows", "kept_rows")
        result = counts if result is None else result.unionByName(counts)
    return result


# --- writes ---------------------------------------------------------------------------------


def record_loads(outcomes: DataFrame, load_ts: datetime, loaded_by: str) -> DataFrame:
    """Audit rows for load outcomes.

    ``outcomes`` has ``file_name, row_count, file_size_bytes, load_duration_seconds,
    error_message``; a row with an error message becomes FAILED with no rows and no duration.
    """
    failed = F.col("error_message").isNotNull()
    return outcomes.select(
        "file_name",
        F.lit(load_ts).cast("timestamp_ntz").alias("load_ts"),
        hour_of_file_name("file_name").alias("file_hour"),
        F.when(failed, 0).otherwise(F.col("row_count")).cast("bigint").alias("row_count"),
        F.when(~failed, F.col("file_size_bytes")).cast("bigint").alias("file_size_bytes"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.substring("error_message", 1, fixed.ERROR_MESSAGE_CHARS).alias("error_message"),
        F.lit(0).cast("bigint").alias("retry_count"),
        F.when(~failed, F.col("load_duration_seconds"))
        .cast("decimal(10,2)")
        .alias("load_duration_seconds"),
        F.lit(loaded_by).alias("loaded_by"),
    )


def append_audit(rows: DataFrame, audit_path: str) -> None:
    """Append audit rows as one small file."""
    tables.append_rows(rows.select(*LOAD_HISTORY.names).coalesce(1), audit_path)


def bulk_append(raw: DataFrame, raw_path: str) -> None:
    """Write whole files into the raw table, all or nothing.

    Each file is one partition that is replaced as a whole, so a failed or repeated load never
    leaves part of a file or a second copy.
    """
    tables.append_by_partition(raw.select(*RAW_EVENTS.names), raw_path, "file_name")


def file_row_counts(spark: SparkSession, raw_path: str, names: list[str]) -> DataFrame:
    """Rows per file of the raw table.

    Only the folders of the named files are listed and only footers are read, however many files
    the table holds.
    """
    raw = tables.read_partitions(spark, raw_path, RAW_EVENTS, "file_name", names)
    return raw.groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count"))


class AlreadyLoadedError(RuntimeError):
    """A file was offered again although it may be loaded only once."""


def load_once(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    audit_path: str,
    as_of: datetime,
    *,
    expected: DataFrame | None = None,
    skip_if_exists: bool = True,
    loaded_by: str = "loader",
) -> DataFrame:
    """Load every available file that has no successful load yet; returns the new audit rows.

    The unloaded files are read by one job, not one job per file. If that job fails, the list is
    halved until the failing files stand alone: those are recorded as FAILED, the rest is loaded.
    Only file names and sizes reach the driver.
    """
    available = discover_files(spark, landing)
    if expected is not None:
        available = available.join(expected.select("file_name"), "file_name", "left_semi")
    audit = tables.read_table(spark, audit_path, LOAD_HISTORY)
    if not skip_if_exists:
        again = available.join(loaded_files(audit), "file_name", "left_semi").limit(1).collect()
        if again:
            raise AlreadyLoadedError(f"file already loaded: {again[0].file_name}")

    todo = unloaded_files(available, audit).select("file_name", "file_size_bytes", "paths").collect()
    outcomes: list[tuple] = []
    if todo:
        _load_batch(spark, todo, raw_path, as_of, outcomes)
    rows = record_loads(spark.createDataFrame(outcomes, _OUTCOME), as_of, loaded_by)
    if outcomes:
        append_audit(rows, audit_path)
    return rows


_OUTCOME = (
    "file_name STRING, row_count BIGINT, file_size_bytes BIGINT, "
    "load_duration_seconds DOUBLE, error_message STRING"
)


# what Spark and the JVM say about a file whose content cannot be read
_UNREADABLE = ("FAILED_READ_FILE", "EOFException", "ZipException", "not a gzip file", "incorrect header check")


def _load_batch(spark, files, raw_path, as_of, outcomes) -> None:
    names = [f.file_name for f in files]
    start = time.monotonic()
    try:
        raw = scan_hourly_ndjson(spark, [p for f in files for p in f.paths], as_of)
        bulk_append(raw, raw_path)
    except Exception as error:  # an unreadable file fails the whole job
        if not any(sign in str(error) for sign in _UNREADABLE):
            raise
        if len(files) == 1:
            outcomes.append((names[0], 0, files[0].file_size_bytes, None, str(error)))
            return
        half = len(files) // 2
        _load_batch(spark, files[:half], raw_path, as_of, outcomes)
        _load_batch(spark, files[half:], raw_path, as_of, outcomes)
        return
    seconds = (time.monotonic() - start) / len(files)
    counts = {r.file_name: r.row_count for r in file_row_counts(spark, raw_path, names).collect()}
    outcomes.extend(
        (f.file_name, counts.get(f.file_name, 0), f.file_size_bytes, seconds, None) for f in files
    )


def load_latest(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    audit_path: str,
    as_of: datetime,
    look_back_hours: int = 2,
) -> DataFrame:
    """The hourly load: load the newest available file of the look-back that is not loaded yet.

    Returns its audit row, or no row if there is nothing new.
    """
    history = tables.read_table(spark, audit_path, LOAD_HISTORY)
    newest = next_unloaded_file(discover_files(spark, landing), history, as_of, look_back_hours)
    return load_once(spark, landing, raw_path, audit_path, as_of, expected=newest)


def backfill(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    audit_path: str,
    as_of: datetime,
    days: int = 7,
) -> DataFrame:
    """Load all expected files of the last ``days`` days; one outcome row per expected file.

    Outcomes: ``skipped`` (already loaded, missing, or without events), ``loaded``, ``failed``.
    """
    expected = expected_hours(spark, as_of, days)
    before = loaded_files(tables.read_table(spark, audit_path, LOAD_HISTORY))
    # as it is before this run, and no more of it than was asked for
    path = fresh_path(spark, "loaded-before")
    before.join(expected.select("file_name"), "file_name", "left_semi").distinct().write.parquet(path)
    before = spark.read.parquet(path)
    done = load_once(spark, landing, raw_path, audit_path, as_of, expected=expected)
    return backfill_outcomes(expected, before, done)


def backfill_outcomes(expected: DataFrame, before: DataFrame, done: DataFrame) -> DataFrame:
    """Join the expected files with what was loaded before and what this run did: one row per expected file.

    ``before`` may name a file once per load, ``done`` may have several attempts of a file; the newest one counts.
    """
    marks = before.select("file_name").distinct().withColumn("was_loaded", F.lit(True))
    attempts = latest_attempt(done.select("file_name", "load_ts", "status", "row_count", "error_message"))
    joined = expected.join(marks, "file_name", "left").join(attempts.drop("load_ts"), "file_name", "left")
    loaded = (F.col("status") == "SUCCESS") & (F.col("row_count") > 0)
    return joined.select(
        "file_name",
        "expected_hour",
        F.when(F.col("was_loaded"), "skipped")
        .when(F.col("status") == "FAILED", "failed")
        .when(loaded, "loaded")
        .otherwise("skipped")
        .alias("outcome"),
        F.when(F.col("was_loaded"), "already loaded")
        .when(F.col("status") == "FAILED", F.col("error_message"))
        .when(loaded, "success")
        .when(F.col("status") == "SUCCESS", "no events in file")
        .otherwise("missing")
        .alias("reason"),
        F.when(loaded, F.col("row_count")).otherwise(0).cast("bigint").alias("row_count"),
    )


def backfill_summary(outcomes: DataFrame, events: DataFrame, audit: DataFrame) -> DataFrame:
    """Totals of a backfill and its validation against the tables, as one row.

    ``events`` needs ``created_at`` only.
    """
    totals = outcomes.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("outcome") == "loaded").alias("loaded_files"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_files"),
        F.count_if(F.col("outcome") == "failed").alias("failed_files"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("loaded_rows"),
    )
    stored = events.agg(
        F.count(F.lit(1)).alias("n"), F.min("created_at").alias("lo"), F.max("created_at").alias("hi")
    )
    success = audit.agg(F.count_if(F.col("status") == "SUCCESS").alias("n"))
    failures = audit.agg(F.count_if(F.col("status") == "FAILED").alias("n"))
    return (
        totals.withColumn("stored_events", stored.select("n").scalar())
        .withColumn("success_loads", success.scalar())
        .withColumn("failure_loads", failures.scalar())
        .withColumn("earliest_event", stored.select("lo").scalar())
        .withColumn("latest_event", stored.select("hi").scalar())
        .withColumn("is_valid", (F.col("stored_events") > 0) & (F.col("success_loads") > 0))
    )


def delete_file_events(
    spark: SparkSession, raw_path: str, audit_path: str, file_name: str, ledger_path: str | None = None
) -> tuple[int, int]:
    """Remove one file from the raw and the audit table; returns (events, audit rows) deleted.

    The raw table drops one partition folder; the small audit table is rewritten. The ledger, if one is named,
    notes it, so that the next load of the file is processed again.
    """
    events = file_row_counts(spark, raw_path, [file_name]).agg(F.sum("row_count")).first()[0] or 0
    tables.delete_partition(spark, raw_path, "file_name", file_name)
    audit = tables.read_table(spark, audit_path, LOAD_HISTORY)
    gone = audit.where(F.col("file_name") == file_name).count()
    if gone:
        tables.overwrite_table(without_file(audit, file_name), audit_path, layout.write_audit)
    if ledger_path is not None:
        ledger.forget(spark, ledger_path, file_name)
    return events, gone
