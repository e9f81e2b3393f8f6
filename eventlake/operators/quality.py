"""Data quality: freshness, anomalies, monitor checks and the declarative test suite."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import boundary_diff, fixed, percent, round_half_up
from eventlake.sources.audit import latest_attempt


def _ts(value: datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _midnight(value: datetime) -> datetime:
    return value.replace(hour=0, minute=0, second=0, microsecond=0)


def _count() -> Column:
    return F.count(F.lit(1))


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- freshness ------------------------------------------------------------------------------


def freshness_status(
    loads: DataFrame, as_of: datetime, unit: str = "hour", tiers: list[tuple[str, int]] | None = None
) -> DataFrame:
    """Newest ``load_ts``, minutes and hours behind ``as_of`` and the freshness tier.

    ``tiers`` lists (name, exclusive upper bound in ``unit``); beyond the last one it is STALE.
    """
    behind = boundary_diff(unit, "last_loaded", _ts(as_of))
    tier = F.lit(fixed.STALE_TIER)
    for name, bound in reversed(tiers or fixed.FRESHNESS_TIERS):
        tier = F.when(behind < bound, name).otherwise(tier)
    return loads.agg(F.max("load_ts").alias("last_loaded")).select(
        "last_loaded",
        boundary_diff("minute", "last_loaded", _ts(as_of)).alias("minutes_behind"),
        boundary_diff("hour", "last_loaded", _ts(as_of)).alias("hours_behind"),
        tier.alias("freshness"),
    )


def source_freshness(
    sources: dict[str, DataFrame], as_of: datetime, warn_hours: int = 2, error_hours: int = 4
) -> DataFrame:
    """Declared rule per source: ``pass``, ``warn`` after and ``error`` after the given age."""
    age_seconds = F.unix_seconds(_ts(as_of).cast("timestamp")) - F.unix_seconds(
        F.col("last_loaded").cast("timestamp")
    )
    status = (
        F.when(F.col("last_loaded").isNull() | (age_seconds > error_hours * 3600), "error")
        .when(age_seconds > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return _union(
        df.agg(F.max("load_ts").alias("last_loaded")).select(
            F.lit(name).alias("source_name"),
            "last_loaded",
            age_seconds.alias("age_seconds"),
            status.alias("status"),
        )
        for name, df in sources.items()
    )


def staging_freshness(events: DataFrame, as_of: datetime, max_hours: int = 2) -> DataFrame:
    """One row if the newest event is more than ``max_hours`` old, else none."""
    newest = events.agg(F.max("created_at").alias("latest_event"))
    return newest.select(
        "latest_event", boundary_diff("hour", "latest_event", _ts(as_of)).alias("hours_behind")
    ).where(F.col("hours_behind") > max_hours)


# --- completeness and accuracy --------------------------------------------------------------


def event_trend(events: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Daily events, distinct actors and repositories since ``days`` days before ``as_of``."""
    recent = events.where(F.col("created_at") >= _ts(_midnight(as_of) - timedelta(days=days)))
    return recent.groupBy(F.to_date("created_at").alias("event_date")).agg(
        _count().alias("daily_events"),
        F.countDistinct("actor_id").alias("unique_actors"),
        F.countDistinct("repo_id").alias("unique_repos"),
    )


def fact_integrity(fact: DataFrame) -> DataFrame:
    """Row and distinct counts, missing keys and whether each event occurs once; one pass."""
    return fact.agg(
        _count().alias("total_facts"),
        F.count_if(F.col("event_id").isNull()).alias("missing_event_ids"),
        F.count_if(F.col("actor_key").isNull()).alias("missing_actor_keys"),
        F.count_if(F.col("repo_key").isNull()).alias("missing_repo_keys"),
        F.count_if(F.col("event_type_key").isNull()).alias("missing_event_type_keys"),
        F.countDistinct("event_id").alias("distinct_events"),
    ).withColumn(
        "grain_status",
        F.when(F.col("distinct_events") == F.col("total_facts"), "VALID").otherwise("DUPLICATES"),
    )


def dimension_completeness(
    actors: DataFrame,
    repositories: DataFrame,
    event_types: DataFrame,
    fact: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Rows, current rows, their share and missing natural ids per mart table."""
    everything = F.lit(True)
    parts = [
        ("Dimensions", "dim_actor", actors, F.col("is_current"), "actor_id"),
        ("Dimensions", "dim_repository", repositories, everything, "repo_id"),
        ("Dimensions", "dim_event_type", event_types, everything, "event_type"),
        ("Facts", "fact_events", fact, F.col("created_at") >= _ts(_midnight(as_of)), "event_id"),
    ]
    return _union(
        df.agg(
            _count().alias("total_rows"),
            F.count_if(is_current).alias("current_rows"),
            F.count_if(F.col(key).isNull()).alias("missing_ids"),
        ).select(
            F.lit(kind).alias("check_type"),
            F.lit(name).alias("table_name"),
            "total_rows",
            "current_rows",
            percent(F.col("current_rows"), F.col("total_rows"), 1).alias("pct_current"),
            "missing_ids",
        )
        for kind, name, df, is_current, key in parts
    )


def min_rows_per_day(events: DataFrame, minimum: int = 100_000) -> DataFrame:
    """Days with fewer events than ``minimum``."""
    days = events.groupBy(F.to_date("created_at").alias("event_date")).agg(_count().alias("row_count"))
    return days.where(F.col("row_count") < minimum)


# --- anomalies ------------------------------------------------------------------------------


def _against_previous(counts: DataFrame, at: str, value: str, rows: int, low: float, high: float) -> DataFrame:
    """Compare each row with the mean of the ``rows`` rows before it.

    ``counts`` is aggregated to one row per hour or day, so ordering it in one window is cheap.
    A row without predecessors has no mean and counts as NORMAL.
    """
    before = Window.orderBy(at).rowsBetween(-rows, -1)
    return against_mean(counts.withColumn("mean", F.avg(value).over(before)), (at,), value, low, high)


def against_mean(counts: DataFrame, keys: tuple[str, ...], value: str, low: float, high: float) -> DataFrame:
    """Flag ``value`` by its ratio to the column ``mean``; without a mean it counts as NORMAL."""
    flag = (
        F.when(F.col(value) < low * F.col("mean"), "LOW")
        .when(F.col(value) > high * F.col("mean"), "HIGH")
        .otherwise("NORMAL")
    )
    return counts.select(
        *keys,
        value,
        round_half_up("mean", 0).alias("avg_before"),
        round_half_up(F.col(value) * 100.0 / F.col("mean"), 1).alias("pct_of_avg"),
        flag.alias("anomaly_flag"),
    )


def hourly_anomaly(
    events: DataFrame, as_of: datetime, low: float = 0.8, high: float = 1.2
) -> DataFrame:
    """Hourly counts of the last day against the mean of the 24 hours with events before each.

    The window sees a whole week; the last day is cut out afterwards.
    """
    recent = events.where(F.col("created_at") >= _ts(as_of - timedelta(days=7)))
    hours = recent.groupBy(
        F.date_trunc("hour", "created_at").cast("timestamp_ntz").alias("event_hour")
    ).agg(_count().alias("event_count"))
    flagged = _against_previous(hours, "event_hour", "event_count", 24, low, high)
    return flagged.where(F.col("event_hour") >= _ts(as_of - timedelta(days=1)))


def daily_volume_anomaly(
    events: DataFrame, as_of: datetime, days: int = 7, low: float = 0.8, high: float = 1.2
) -> DataFrame:
    """Daily counts against the mean of the six days before each."""
    recent = events.where(F.col("created_at") >= _ts(_midnight(as_of) - timedelta(days=days)))
    counts = recent.groupBy(F.to_date("created_at").alias("event_date")).agg(
        _count().alias("daily_events")
    )
    return _against_previous(counts, "event_date", "daily_events", 6, low, high)


# --- monitor checks -------------------------------------------------------------------------
# Each check is one row: check_name, status, value, severity (NULL without alert), message.


def _check(df: DataFrame, name: str, status: Column, value: Column, severity: Column, message: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        value.cast("double").alias("value"),
        severity.alias("severity"),
        F.when(severity.isNotNull(), message).alias("message"),
    )


def check_raw_freshness(loads: DataFrame, as_of: datetime, max_age_hours: int = 2) -> DataFrame:
    age = F.col("hours_behind")
    newest = loads.agg(F.max("load_ts").alias("last_loaded")).select(
        boundary_diff("hour", "last_loaded", _ts(as_of)).alias("hours_behind")
    )
    severity = F.when(age >= 2 * max_age_hours, "ERROR").when(age >= max_age_hours, "WARNING")
    return _check(
        newest,
        "raw_freshness",
        F.when(age < max_age_hours, "FRESH").otherwise("STALE"),
        age,
        severity,
        F.concat(F.lit("newest load is "), age.cast("string"), F.lit("h old")),
    )


def duplicate_keys(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Key values that occur more than once, with their row count."""
    counts = df.groupBy(key).agg(_count().alias("row_count"))
    return counts.where(F.col("row_count") > 1)


def check_duplicates(fact: DataFrame) -> DataFrame:
    n = F.col("n")
    found = duplicate_keys(fact).agg(_count().alias("n"))
    return _check(
        found,
        "duplicates",
        F.when(n == 0, "OK").otherwise("FAILED"),
        n,
        F.when(n > 0, "ERROR"),
        F.concat(n.cast("string"), F.lit(" event ids occur more than once")),
    )


def missing_dimension_counts(fact: DataFrame) -> DataFrame:
    """Facts without a dimension key or without the natural id behind it, per dimension."""
    pairs = [("actor", "actor_key", "actor_id"), ("repo", "repo_key", "repo_id"),
             ("event_type", "event_type_key", "event_type")]
    counts = fact.where(F.col("event_key").isNotNull()).agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for _, *columns in pairs for c in columns]
    )
    rows = [
        F.struct(
            F.lit(name).alias("dimension"),
            F.col(key).alias("missing_keys"),
            F.col(natural).alias("missing_ids"),
        )
        for name, key, natural in pairs
    ]
    return counts.select(F.inline(F.array(*rows)))


def check_missing_dimensions(fact: DataFrame) -> DataFrame:
    n = F.col("n")
    # a hashed null is no null, so a missing id is what shows
    total = missing_dimension_counts(fact).agg(F.sum(F.col("missing_keys") + F.col("missing_ids")).alias("n"))
    return _check(
        total,
        "missing_dimensions",
        F.when(n == 0, "OK").otherwise("FAILED"),
        n,
        F.when(n > 0, "WARNING"),
        F.concat(n.cast("string"), F.lit(" dimension keys or ids are missing")),
    )


def check_event_volume(
    fact: DataFrame, as_of: datetime, low: float = 0.8, high: float = 1.2
) -> DataFrame:
    """Yesterday's volume against the six days before; without events it is 0 and an anomaly.

    Only a fact whose first event is younger than yesterday is not expected to have any.
    """
    yesterday = (_midnight(as_of) - timedelta(days=1)).date()
    days = daily_volume_anomaly(fact, as_of, 7, low, high).where(F.col("event_date") == F.lit(yesterday))
    # a global aggregate has one row, also over no day
    days = days.agg(
        F.coalesce(F.max("daily_events"), F.lit(0)).alias("daily_events"),
        F.when(F.count(F.lit(1)) == 0, 0.0).otherwise(F.max("pct_of_avg")).alias("pct_of_avg"),
    )
    first = fact.agg(F.min("created_at").alias("first")).select(F.coalesce(F.to_date("first") <= F.lit(yesterday), F.lit(True)))
    pct = F.col("pct_of_avg")
    odd = ((pct < low * 100) | (pct > high * 100)) & first.scalar()
    return _check(
        days,
        "volume_anomaly",
        F.when(odd, "ANOMALY").otherwise("OK"),
        pct,
        F.when(odd, "WARNING"),
        F.concat(F.col("daily_events").cast("string"), F.lit(" events are "), pct.cast("string"),
                 F.lit("% of the average")),
    )


def check_load_failures(audit: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    n = F.col("n")
    recent = (F.col("status") == "FAILED") & (F.col("load_ts") >= _ts(as_of - timedelta(hours=hours)))
    failures = audit.agg(F.count_if(recent).alias("n"))
    return _check(
        failures,
        "recent_failures",
        F.when(n == 0, "OK").otherwise("FAILED"),
        n,
        F.when(n > 0, "WARNING"),
        F.concat(n.cast("string"), F.lit(f" loads failed in the last {hours}h")),
    )


def dq_checks(
    loads: DataFrame, fact: DataFrame, audit: DataFrame, as_of: datetime, failure_hours: int = 1
) -> DataFrame:
    """The five monitor checks as one frame."""
    return _union(
        [
            check_raw_freshness(loads, as_of),
            check_duplicates(fact),
            check_missing_dimensions(fact),
            check_event_volume(fact, as_of),
            check_load_failures(audit, as_of, failure_hours),
        ]
    )


def dq_report(checks: DataFrame) -> dict:
    """Collect the check rows (five at most) into a report with an exit code."""
    rows = [r.asDict() for r in checks.collect()]
    alerts = [r for r in rows if r["severity"] is not None]
    return {
        "status": "FAIL" if alerts else "PASS",
        "alert_count": len(alerts),
        "checks": rows,
        "alerts": [{"severity": a["severity"], "message": a["message"]} for a in alerts],
        "exit_code": 1 if alerts else 0,
    }


# --- declarative tests ----------------------------------------------------------------------


def not_null_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows where it is NULL. One pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return duplicate_keys(df.where(F.col(column).isNotNull()), column)


def accepted_values_failures(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list with their row count; NULL passes."""
    odd = df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))
    return odd.groupBy(column).agg(_count().alias("row_count"))


def relationship_failures(
    child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None
) -> DataFrame:
    """Child key values without a parent row, with their row count; NULL passes.

    The child is collapsed to its distinct keys before the join, so a busy key is one row.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(_count().alias("row_count"))
    parents = parent.select(F.col(parent_column or column).alias(column))
    return keys.join(parents, column, "left_anti")


def scd2_multiple_current(dim: DataFrame, key: str = "actor_id") -> DataFrame:
    """Keys with more than one current version."""
    current = dim.where("is_current").groupBy(key).agg(_count().alias("current_count"))
    return current.where(F.col("current_count") > 1)


def uncovered_types(fact: DataFrame, event_types: DataFrame) -> DataFrame:
    """Event types of the fact that the dimension does not have."""
    return relationship_failures(fact, event_types, "event_type").select("event_type")


@dataclass(frozen=True)
class ColumnTest:
    """One declared test: ``not_null``, ``unique``, ``accepted_values`` or ``relationships``."""

    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    parent: str | None = None
    severity: str = "warn"
    among: str = "true"  # condition on the rows that are tested


def declare(model: str, not_null: str, unique: str = "", accepted: dict | None = None,
            parents: dict[str, str] | None = None, unique_among: str = "true") -> list[ColumnTest]:
    """Declarations of one model; column lists are blank-separated. ``unique_among`` limits the unique tests to some rows."""
    tests = [ColumnTest(model, c, "not_null") for c in not_null.split()]
    tests += [ColumnTest(model, c, "unique", among=unique_among) for c in unique.split()]
    tests += [ColumnTest(model, c, "accepted_values", tuple(v)) for c, v in (accepted or {}).items()]
    tests += [ColumnTest(model, c, "relationships", parent=p) for c, p in (parents or {}).items()]
    return tests


def declared_tests() -> list[ColumnTest]:
    """The declared column tests of all models."""
    return [
        *declare("raw_events", "raw_data file_name load_ts"),
        *declare("load_history", "file_name load_ts", "file_name", {"status": fixed.LOAD_STATUSES}),
        *declare(
            "stg_events",
            "event_id event_type actor_id actor_login repo_id repo_name created_at source_file loaded_at",
            "event_id",
            {"event_type": fixed.EVENT_TYPES, "actor_type": fixed.ACTOR_TYPES},
        ),
        *declare(
            "stg_actors",
            "actor_id actor_login actor_type first_seen_at last_seen_at",
            "actor_id",
            {"actor_type": fixed.ACTOR_TYPES},
        ),
        *declare(
            "stg_repositories",
            "repo_id repo_name repo_owner repo_short_name first_event_at last_event_at",
            "repo_id",
        ),
        *declare(
            "stg_event_types",
            "event_type event_count unique_actors unique_repos first_occurrence last_occurrence "
            "percent_of_total_events",
            "event_type",
        ),
        *declare(
            "dim_actor",
            "actor_key actor_id actor_login actor_type is_bot first_seen_at last_seen_at valid_from "
            "valid_to is_current created_ts updated_ts",
            "actor_key",
            {"actor_type": fixed.ACTOR_TYPES},
            # all versions of an actor share its key, one of them is current
            unique_among="is_current",
        ),
        *declare(
            "dim_repository",
            "repo_key repo_id repo_name repo_owner repo_short_name is_test_repo first_event_at "
            "last_event_at created_ts updated_ts",
            "repo_key",
        ),
        *declare(
            "dim_event_type",
            "event_type_key event_type event_description event_category event_count unique_actors "
            "unique_repos percent_of_total_events first_occurrence last_occurrence created_ts updated_ts",
            "event_type_key event_type",
            {
                "event_type": fixed.EVENT_TYPES,
                "event_category": [*fixed.EVENT_CATEGORIES, fixed.OTHER_CATEGORY],
            },
        ),
        *declare(
            "fact_events",
            "event_key event_id actor_key repo_key event_type_key event_type actor_id actor_login "
            "repo_id repo_name created_at event_date event_hour event_day_of_week event_week "
            "event_month event_year source_file loaded_at created_ts",
            "event_key event_id",
            parents={
                "actor_key": "dim_actor",
                "repo_key": "dim_repository",
                "event_type_key": "dim_event_type",
            },
        ),
    ]


def failing_rows(test: ColumnTest, models: dict[str, DataFrame]) -> DataFrame:
    """The rows or values that fail one test."""
    df = models[test.model].where(test.among)
    if test.test == "not_null":
        return df.where(F.col(test.column).isNull())
    if test.test == "unique":
        return unique_failures(df, test.column)
    if test.test == "accepted_values":
        return accepted_values_failures(df, test.column, list(test.values))
    if test.test == "relationships":
        return relationship_failures(df, models[test.parent], test.column)
    raise ValueError(f"unknown test {test.test!r}")


def _inline(model: DataFrame, structs: list[str]) -> DataFrame:
    return model.selectExpr(f"inline(array({', '.join(structs)}))")


def _null_counts(model: DataFrame, tests: list[tuple[int, ColumnTest]]) -> DataFrame:
    """``test_no, failures`` of the not_null tests of a model: one pass, one row."""
    counts = model.selectExpr(*[f"count_if(({t.among}) AND `{t.column}` IS NULL) AS t{i}" for i, t in tests])
    return _inline(counts, [f"struct({i} AS test_no, t{i} AS failures)" for i, _ in tests])


def _key_values(model: DataFrame, tests: list[tuple[int, ColumnTest]], parent_of: list[tuple[int, ColumnTest]]) -> DataFrame:
    """``test_no, value, here, there``: a row per value that a test of this model looks at, or that a child of it looks for."""

    def quoted(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def entry(i: int, column: str, condition: str, here: int, there: int) -> str:
        value = f"CASE WHEN {condition} THEN CAST(`{column}` AS STRING) END"
        return f"struct({i} AS test_no, {value} AS value, {here}L AS here, {there}L AS there)"

    entries = []
    for i, t in tests:
        odd = f" AND `{t.column}` NOT IN ({', '.join(map(quoted, t.values))})" if t.test == "accepted_values" and t.values else ""
        entries.append(entry(i, t.column, f"({t.among}){odd}", 1, 0))
    entries += [entry(i, t.column, "true", 0, 1) for i, t in parent_of]
    return _inline(model, entries).where("value IS NOT NULL")


def run_dq_suite(
    models: dict[str, DataFrame],
    tests: list[ColumnTest] | None = None,
    failures_path: str | None = None,
) -> DataFrame:
    """Run declared tests: model, test, column, failures, severity, status.

    Two passes per model, whatever the number of tests. One counts nulls. The other sends the values of all its keys, as a
    child and as a parent, to one grouping by (test, value) that all models share and that combines before the shuffle: a
    value that occurs twice is not unique, one outside the list that occurs at all is not accepted, and one that occurs here but not
    there has no parent. With ``failures_path`` the rows behind every failed test are written below it, one folder per test.
    """
    tests = [t for t in (declared_tests() if tests is None else tests) if t.model in models]
    numbered = list(enumerate(tests))
    kinds = {"unique": [], "accepted_values": [], "relationships": []}
    for i, t in numbered:
        if t.test != "not_null":
            if t.test not in kinds:
                raise ValueError(f"unknown test {t.test!r}")
            kinds[t.test].append(i)
    counts, values = [], []
    for name, model in models.items():
        nulls = [(i, t) for i, t in numbered if t.model == name and t.test == "not_null"]
        keys = [(i, t) for i, t in numbered if t.model == name and t.test != "not_null"]
        parent_of = [(i, t) for i, t in numbered if t.parent == name]
        if nulls:
            counts.append(_null_counts(model, nulls))
        if keys or parent_of:
            values.append(_key_values(model, keys, parent_of))
    if values:
        here, there, no = F.col("here"), F.col("there"), F.col("test_no")
        fails = (
            F.when(no.isin(kinds["unique"]), here > 1)
            .when(no.isin(kinds["relationships"]), (here > 0) & (there == 0))
            .otherwise(here > 0)
        )
        grouped = _union(values).groupBy("test_no", "value").agg(F.sum("here").alias("here"), F.sum("there").alias("there"))
        counts.append(grouped.groupBy("test_no").agg(F.count_if(fails).alias("failures")))
    spark = next(iter(models.values())).sparkSession
    listed = spark.createDataFrame(
        [(i, t.model, t.test, t.column, t.severity) for i, t in numbered],
        "test_no INT, model_name STRING, test_name STRING, column_name STRING, severity STRING",
    )
    found = listed.join(_union(counts), "test_no", "left") if counts else listed.withColumn("failures", F.lit(0))
    failures = F.coalesce("failures", F.lit(0)).cast("bigint")
    results = found.select(
        "model_name",
        "test_name",
        "column_name",
        failures.alias("failures"),
        "severity",
        F.when(failures == 0, "pass").when(F.col("severity") == "error", "error").otherwise("warn").alias("status"),
    )
    if failures_path is not None:
        store_failures(models, tests, results, failures_path)
    return results


def store_failures(
    models: dict[str, DataFrame], tests: list[ColumnTest], results: DataFrame, path: str
) -> None:
    """Write the failing rows of every failed test to ``path/<model>__<test>__<column>``."""
    failed = {
        (r.model_name, r.test_name, r.column_name) for r in results.where("failures > 0").collect()
    }
    for t in tests:
        if (t.model, t.test, t.column) in failed:
            target = f"{path}/{t.model}__{t.test}__{t.column}"
            failing_rows(t, models).write.mode("overwrite").parquet(target)


def quality_summary(
    suite: DataFrame, fact: DataFrame, dimensions: dict[str, DataFrame]
) -> DataFrame:
    """Checks, passed checks and pass rate of the suite, the fact grain and the dimensions."""
    overall = suite.agg(
        _count().alias("total_checks"), F.count_if(F.col("status") == "pass").alias("passed_checks")
    ).select(F.lit("Declared tests").alias("assessment"), "total_checks", "passed_checks")
    grain = fact_integrity(fact).select(
        F.lit("Fact grain").alias("assessment"),
        F.lit(1).cast("bigint").alias("total_checks"),
        F.when(F.col("grain_status") == "VALID", 1).otherwise(0).cast("bigint").alias("passed_checks"),
    )
    filled = _union(df.limit(1).agg(_count().alias("n")) for df in dimensions.values()).agg(
        _count().alias("total_checks"), F.sum("n").alias("passed_checks")
    ).select(F.lit("Dimension completeness").alias("assessment"), "total_checks", "passed_checks")
    rows = _union([overall, grain, filled])
    rate = percent(F.col("passed_checks"), F.col("total_checks"), 1)
    return rows.withColumn("pass_rate", rate)


def longest_failure_run(audit: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Length of the longest run of FAILED files in hour order, of the ``days`` days up to ``as_of``.

    A file counts with its newest attempt. The windows see one row per hour of that time.
    """
    hour = F.col("file_hour")
    audit = latest_attempt(audit.where((hour >= _ts(as_of - timedelta(days=days))) & (hour <= _ts(as_of))))
    by_hour = Window.orderBy("file_hour", "file_name")
    by_group = Window.partitionBy("failed").orderBy("file_hour", "file_name")
    marked = audit.select("file_hour", "file_name", (F.col("status") == "FAILED").alias("failed"))
    island = F.row_number().over(by_hour) - F.row_number().over(by_group)
    runs = marked.withColumn("island", island).where("failed").groupBy("island").agg(_count().alias("n"))
    return runs.agg(F.coalesce(F.max("n"), F.lit(0)).cast("double").alias("value"))


def quality_metrics(
    loads: DataFrame, fact: DataFrame, audit: DataFrame, suite: DataFrame, as_of: datetime
) -> DataFrame:
    """Metric values for grading: ``metric, value``."""
    freshness = freshness_status(loads, as_of).select(F.col("hours_behind").cast("double").alias("value"))
    duplicates = duplicate_keys(fact).agg(_count().cast("double").alias("value"))
    missing = F.col("actor_id").isNull() | F.col("repo_id").isNull() | F.col("event_type").isNull()
    absent = fact.agg(_count().alias("total"), F.count_if(missing).alias("n")).select(
        F.coalesce(percent(F.col("n"), F.col("total")), F.lit(0.0)).alias("value")
    )
    failures = suite.agg(F.count_if(F.col("status") != "pass").cast("double").alias("value"))
    named = {
        "data_freshness_hours": freshness,
        "consecutive_load_failures": longest_failure_run(audit, as_of),
        "duplicate_events": duplicates,
        "missing_dimension_percent": absent,
        "test_failures": failures,
    }
    return _union(df.select(F.lit(name).alias("metric"), "value") for name, df in named.items())


def grade_metrics(
    metrics: DataFrame, bounds: list[tuple[str, float, float]] | None = None
) -> DataFrame:
    """Grade each metric OK, WARNING or ERROR against its bounds."""
    warn, error = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, warn_at, error_at in bounds or fixed.GRADE_BOUNDS:
        warn = F.when(F.col("metric") == name, warn_at).otherwise(warn)
        error = F.when(F.col("metric") == name, error_at).otherwise(error)
    grade = F.when(F.col("value") >= error, "ERROR").when(F.col("value") >= warn, "WARNING").otherwise("OK")
    return metrics.select(
        "metric", "value", warn.alias("warn_at"), error.alias("error_at"), grade.alias("grade")
    )
