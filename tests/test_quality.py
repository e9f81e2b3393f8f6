"""Monitor report, declared tests and their stored failures, grading, anomalies."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

from conftest import at
from pyspark.sql import functions as F

from eventlake.operators import analytics, monitoring, quality

EVENTS = "event_id STRING, event_type STRING, actor_id BIGINT, repo_id BIGINT, created_at TIMESTAMP_NTZ"


def loads(spark, when):
    return spark.createDataFrame([(when,)], "load_ts TIMESTAMP_NTZ")


def history(spark, *rows):
    return spark.createDataFrame(
        [(f"f{h}", at(1, h), at(1, h) + timedelta(minutes=65), s, n) for h, s, n in rows],
        "file_name STRING, file_hour TIMESTAMP_NTZ, load_ts TIMESTAMP_NTZ, status STRING, row_count BIGINT",
    )


def fact(spark, ids, days=8):
    rows = [(str(i), f"k{i}", "a", "r", "t", 1, 1, "PushEvent", at(1 + n % days)) for n, i in enumerate(ids)]
    return spark.createDataFrame(
        rows,
        "event_id STRING, event_key STRING, actor_key STRING, repo_key STRING, event_type_key STRING, "
        "actor_id BIGINT, repo_id BIGINT, event_type STRING, created_at TIMESTAMP_NTZ",
    )


def test_clean_report_passes(spark):
    as_of = at(9, 1)
    report = quality.dq_report(
        quality.dq_checks(loads(spark, at(9, 0, 30)), fact(spark, range(80)), history(spark, (1, "SUCCESS", 5)), as_of)
    )
    assert report["status"] == "PASS" and report["exit_code"] == 0 and report["alert_count"] == 0
    assert {c["check_name"]: c["status"] for c in report["checks"]} == {
        "raw_freshness": "FRESH",
        "duplicates": "OK",
        "missing_dimensions": "OK",
        "volume_anomaly": "OK",
        "recent_failures": "OK",
    }


def test_alerts_set_the_exit_code(spark):
    as_of = at(1, 4)
    checks = quality.dq_checks(
        loads(spark, at(1, 1)), fact(spark, [1, 1, 2]), history(spark, (2, "FAILED", 0)), as_of
    )
    report = quality.dq_report(checks)
    assert report["exit_code"] == 1 and report["alert_count"] == 3
    assert sorted(a["severity"] for a in report["alerts"]) == ["ERROR", "WARNING", "WARNING"]


def test_freshness_counts_boundaries(spark):
    # 10:59 to 11:01 is one hour boundary, two minutes
    row = quality.freshness_status(loads(spark, at(1, 10, 59)), at(1, 11, 1)).first()
    assert (row.minutes_behind, row.hours_behind, row.freshness) == (2, 1, "OK")
    empty = quality.freshness_status(loads(spark, at(1)).limit(0), at(1)).first()
    assert empty.last_loaded is None and empty.freshness == "STALE"


def test_staging_freshness_is_silent_when_fresh(spark):
    events = spark.createDataFrame([("1", "PushEvent", 1, 1, at(1, 10))], EVENTS)
    assert quality.staging_freshness(events, at(1, 12)).count() == 0
    assert quality.staging_freshness(events, at(1, 13)).count() == 1


def test_suite_stores_failing_rows(spark, tmp_path):
    events = spark.createDataFrame(
        [("1", "PushEvent", 1, 1, at(1)), ("1", "OddEvent", None, 1, at(1)), ("2", None, 2, 9, at(1))], EVENTS
    )
    parents = spark.createDataFrame([(1,), (2,)], "repo_id BIGINT")
    tests = quality.declare(
        "events", "event_id actor_id", "event_id", {"event_type": ["PushEvent"]}, {"repo_id": "repos"}
    )
    path = str(tmp_path / "failures")
    results = quality.run_dq_suite({"events": events, "repos": parents}, tests, path)
    got = {(r.test_name, r.column_name): (r.failures, r.status) for r in results.collect()}
    assert got == {
        ("not_null", "event_id"): (0, "pass"),
        ("not_null", "actor_id"): (1, "warn"),
        ("unique", "event_id"): (1, "warn"),
        ("accepted_values", "event_type"): (1, "warn"),
        ("relationships", "repo_id"): (1, "warn"),
    }
    stored = spark.read.parquet(f"{path}/events__unique__event_id").collect()
    assert [tuple(r) for r in stored] == [("1", 2)]
    assert spark.read.parquet(f"{path}/events__not_null__actor_id").count() == 1
    assert {p.name for p in (tmp_path / "failures").iterdir()} == {
        "events__not_null__actor_id",
        "events__unique__event_id",
        "events__accepted_values__event_type",
        "events__relationships__repo_id",
    }


def test_suite_counts_what_single_tests_find_in_two_scans_per_model(spark, tmp_path):
    events = [(str(i % 40), ["PushEvent", "it's \\ odd", None][i % 3], i % 7 or None, i % 11, at(1 + i % 2)) for i in range(200)]
    # stored, so that a scan of the plan is a read of the table
    spark.createDataFrame(events, EVENTS).write.parquet(str(tmp_path / "events"))
    spark.createDataFrame([(i, i in (2, None)) for i in (1, 1, 2, 2, 3, None)], "repo_id BIGINT, is_current BOOLEAN").write.parquet(
        str(tmp_path / "repos")
    )
    models = {name: spark.read.parquet(str(tmp_path / name)) for name in ("events", "repos")}
    models["empty"] = models["events"].limit(0)
    tests = [
        *quality.declare("events", "event_id event_type actor_id", "event_id actor_id", {"event_type": ["PushEvent", "it's \\ odd"]},
                         {"repo_id": "repos"}),
        quality.ColumnTest("events", "event_type", "accepted_values", ("PushEvent",), among="repo_id > 3"),
        *quality.declare("repos", "repo_id", "repo_id", unique_among="is_current"),
        *quality.declare("empty", "event_id", "event_id", parents={"repo_id": "repos"}),
    ]
    results = quality.run_dq_suite(models, tests)
    expected = Counter((t.model, t.test, t.column, quality.failing_rows(t, models).count()) for t in tests)
    assert Counter((r.model_name, r.test_name, r.column_name, r.failures) for r in results.collect()) == expected
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    # the empty model reads the same files as the events
    assert plan.count("Relation [") <= 2 * len(models)
    assert quality.run_dq_suite(models, []).collect() == []


def test_type_2_keys_are_unique_among_current_versions(spark):
    dim = spark.createDataFrame([("k", False), ("k", True), ("j", True)], "actor_key STRING, is_current BOOLEAN")
    test = [t for t in quality.declared_tests() if t.model == "dim_actor" and t.test == "unique"]
    assert quality.run_dq_suite({"dim_actor": dim}, test).first().status == "pass"
    twice = dim.withColumn("is_current", F.lit(True))
    assert quality.run_dq_suite({"dim_actor": twice}, test).first().failures == 1


def test_error_severity(spark):
    events = spark.createDataFrame([(None, "x", 1, 1, at(1))], EVENTS)
    test = quality.ColumnTest("events", "event_id", "not_null", severity="error")
    assert quality.run_dq_suite({"events": events}, [test]).first().status == "error"


def test_declared_tests_are_complete():
    kinds = Counter(t.test for t in quality.declared_tests())
    assert kinds == {"not_null": 86, "unique": 11, "accepted_values": 7, "relationships": 3}


def test_grades(spark):
    metrics = spark.createDataFrame(
        [("data_freshness_hours", 3.0), ("consecutive_load_failures", 3.0), ("duplicate_events", 0.0),
         ("missing_dimension_percent", 5.0), ("test_failures", 2.0)],
        "metric STRING, value DOUBLE",
    )
    grades = {r.metric: r.grade for r in quality.grade_metrics(metrics).collect()}
    assert grades == {
        "data_freshness_hours": "WARNING",
        "consecutive_load_failures": "ERROR",
        "duplicate_events": "OK",
        "missing_dimension_percent": "ERROR",
        "test_failures": "ERROR",
    }


def test_longest_failure_run(spark):
    audit = history(
        spark, (0, "FAILED", 0), (1, "SUCCESS", 1), (2, "FAILED", 0), (3, "FAILED", 0), (4, "RETRY", 0), (5, "FAILED", 0)
    )
    assert quality.longest_failure_run(audit, at(1, 6)).first().value == 2.0
    assert quality.longest_failure_run(audit.where("status = 'SUCCESS'"), at(1, 6)).first().value == 0.0
    # failures of long ago do not count
    assert quality.longest_failure_run(audit, at(20)).first().value == 0.0


def test_missing_ids_raise_the_alert(spark):
    rows = spark.createDataFrame([(str(i), "PushEvent", None, 1, at(1)) for i in range(40)], EVENTS)
    columns = [F.lit("x").alias(c) for c in ("event_key", "actor_key", "repo_key", "event_type_key")]
    row = quality.check_missing_dimensions(rows.select("*", *columns)).first()
    assert (row.status, row.value, row.severity) == ("FAILED", 40.0, "WARNING")


def test_a_day_without_events_is_an_alert(spark):
    rows = [(str(i), "PushEvent", 1, 1, at(1 + i % 3)) for i in range(30)]
    events = spark.createDataFrame(rows, EVENTS)
    for day in (5, 25):  # the day after the outage began, and after more than a week of it
        row = quality.check_event_volume(events, at(day, 2)).first()
        assert (row.status, row.value, row.severity) == ("ANOMALY", 0.0, "WARNING")
    assert quality.check_event_volume(events.limit(0), at(5)).first().severity == "WARNING"
    assert quality.check_event_volume(events, at(1, 2)).first().severity is None  # it only began today


def test_a_recovered_file_is_neither_missing_nor_retried(spark):
    columns = "file_name STRING, file_hour TIMESTAMP_NTZ, load_ts TIMESTAMP_NTZ, status STRING, row_count BIGINT, error_message STRING, retry_count BIGINT"
    audit = spark.createDataFrame(
        [
            ("a", at(1, 0), at(1, 1), "FAILED", 0, "x", 0),
            ("a", at(1, 0), at(1, 2), "SUCCESS", 5, None, 1),
            ("b", at(1, 1), at(1, 2), "SUCCESS", 5, None, 0),
            ("b", at(1, 1), at(1, 3), "FAILED", 0, "y", 0),
        ],
        columns,
    )
    assert [(r.file_name, r.status) for r in monitoring.missing_hours(audit, at(1, 1, 30)).collect()] == [("b", "FAILED")]
    assert [r.file_name for r in monitoring.retry_candidates(audit, at(1, 4)).collect()] == ["b"]


def test_first_row_without_history_is_normal(spark):
    rows = [(str(i), "PushEvent", 1, 1, at(1 + i // 10)) for i in range(20)]
    rows += [(str(100 + i), "PushEvent", 1, 1, at(3)) for i in range(30)]
    flagged = quality.daily_volume_anomaly(spark.createDataFrame(rows, EVENTS), at(4)).orderBy("event_date").collect()
    assert [(r.daily_events, r.avg_before, r.anomaly_flag) for r in flagged] == [
        (10, None, "NORMAL"),
        (10, 10.0, "NORMAL"),
        (30, 10.0, "HIGH"),
    ]


def test_hours_are_missing_failed_or_loaded(spark):
    audit = history(spark, (0, "SUCCESS", 3), (1, "FAILED", 0), (3, "SUCCESS", 2))
    rows = monitoring.missing_hours(audit, at(1, 4, 30)).orderBy("expected_hour").collect()
    assert [(r.expected_hour.hour, r.status) for r in rows] == [(1, "FAILED"), (2, "MISSING"), (4, "MISSING")]
    # missing, failed and loaded hours together are all expected hours
    assert len(rows) + 2 == 5


def test_shares_add_up(spark):
    rows = [(str(i), f"type{i % 7}", i % 5, i % 3, at(1)) for i in range(1000)]
    types = analytics.event_type_distribution(spark.createDataFrame(rows, EVENTS)).collect()
    assert abs(sum(r.percent_of_total for r in types) - 100) <= 0.005 * len(types)


def test_empty_inputs(spark):
    events = spark.createDataFrame([], EVENTS)
    overview = analytics.raw_overview(events).first()
    assert overview.total_events == 0 and overview.days_of_data is None
    assert analytics.event_type_distribution(events).count() == 0
    assert analytics.event_rate_per_minute(events).first().avg_per_minute is None
    raw = spark.createDataFrame([], "raw_data STRING").selectExpr("try_parse_json(raw_data) AS raw_data")
    assert [r.null_percent for r in analytics.null_profile(raw, ["id"]).collect()] == [None]
