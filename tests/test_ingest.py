"""Ingest edge cases on literal gzip files."""

from __future__ import annotations

import pytest
from conftest import at, event
from pyspark.sql import functions as F

from eventlake.plans.staging import stg_events
from eventlake.schemas import LOAD_HISTORY, RAW_EVENTS
from eventlake.sources import audit, hours, ndjson, tables

AS_OF = at(1, 6, 30)


def paths(tmp_path):
    return str(tmp_path / "raw"), str(tmp_path / "audit")


def ids(spark, raw_path):
    raw = tables.read_table(spark, raw_path, RAW_EVENTS)
    rows = raw.select(F.variant_get("raw_data", "$.id", "string"), "file_name").collect()
    return sorted(tuple(r) for r in rows)


def test_bad_lines_are_counted_and_left_out(spark, write_hour):
    no_repo = '{"id":"3","type":"PushEvent","actor":{"id":1},"created_at":"2024-01-01T00:00:00Z"}'
    null_type = event("4").replace('"PushEvent"', "null")
    landing = write_hour("2024-01-01-0.json.gz", [event("1"), "", "   ", '{"id":', no_repo, null_type, "12"])
    lines = ndjson.read_lines(spark, landing)
    counts = ndjson.line_counts(lines).collect()
    assert [tuple(r) for r in counts] == [("2024-01-01-0.json.gz", 7, 2, 1, 4)]
    good = ndjson.skip_malformed_lines(lines)
    assert good.count() == 4
    # a key with a JSON null is present, an absent key is not
    validity = ndjson.validity_counts(good).first()
    assert (validity.valid_count, validity.invalid_count) == (2, 2)
    assert validity.valid_count + validity.invalid_count + 1 + 2 == 7
    scanned = ndjson.scan_hourly_ndjson(spark, landing, AS_OF)
    assert sorted(r[0] for r in scanned.select(F.variant_get("raw_data", "$.id", "string")).collect()) == ["1", "4"]
    assert ndjson.valid_events(good).count() == 2


def test_duplicate_json_key_keeps_the_last(spark, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", [event("1", extra=',"id":"9"')])
    raw = ndjson.scan_hourly_ndjson(spark, landing, AS_OF)
    assert stg_events(raw).first().event_id == "9"


def test_staging_of_odd_values(spark, write_hour):
    text_id = event("1").replace('"actor":{"id":1', '"actor":{"id":"abc"')
    number_id = event("2").replace('"id":"2"', '"id":2')
    null_id = event("3").replace('"id":"3"', '"id":null')
    null_time = event("5").replace('"2024-01-01T00:10:00Z"', "null")
    no_slash = event("4", name="plain")
    landing = write_hour("2024-01-01-0.json.gz", [text_id, number_id, null_id, null_time, no_slash])
    rows = stg_events(ndjson.scan_hourly_ndjson(spark, landing, AS_OF)).collect()
    by_id = {r.event_id: r for r in rows}
    assert set(by_id) == {"1", "2", None, "5", "4"}
    assert by_id["1"].actor_id is None and by_id["2"].actor_id == 1
    assert by_id["5"].created_at is None
    assert by_id["2"].created_at == at(1, 0, 10)


def test_two_digit_hour_and_name_round_trip(spark, write_hour):
    landing = write_hour("2024-01-01-3.json.gz", [event("1")])
    write_hour("2024-01-01-13.json.gz", [event("2")])
    found = ndjson.discover_files(spark, landing).orderBy("file_hour").collect()
    assert [(r.file_name, r.file_hour) for r in found] == [
        ("2024-01-01-3.json.gz", at(1, 3)),
        ("2024-01-01-13.json.gz", at(1, 13)),
    ]
    assert ndjson.discover_files(spark, landing, min_bytes=10_000).count() == 0


def test_loading_twice_equals_loading_once(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", [event("1"), event("2")])
    write_hour("2024-01-01-1.json.gz", [event("3"), event("1")])
    raw_path, audit_path = paths(tmp_path)
    first = audit.load_once(spark, landing, raw_path, audit_path, AS_OF)
    once = ids(spark, raw_path)
    assert [r for r in once if r[0] == "1"] == [("1", "2024-01-01-0.json.gz"), ("1", "2024-01-01-1.json.gz")]
    second = audit.load_once(spark, landing, raw_path, audit_path, AS_OF)
    assert (first.count(), second.count()) == (2, 0)
    assert ids(spark, raw_path) == once
    assert tables.read_table(spark, audit_path, LOAD_HISTORY).count() == 2
    with pytest.raises(audit.AlreadyLoadedError):
        audit.load_once(spark, landing, raw_path, audit_path, AS_OF, skip_if_exists=False)


def test_crash_between_data_and_audit_leaves_no_second_copy(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", [event("1"), event("2")])
    raw_path, audit_path = paths(tmp_path)
    audit.bulk_append(ndjson.scan_hourly_ndjson(spark, landing, AS_OF), raw_path)
    audit.load_once(spark, landing, raw_path, audit_path, AS_OF)
    assert len(ids(spark, raw_path)) == 2


def test_unreadable_file_fails_alone(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", [event("1")])
    write_hour("2024-01-01-2.json.gz", [event("2")])
    with open(f"{landing}/2024-01-01-1.json.gz", "wb") as handle:
        handle.write(b"this is not gzip")
    raw_path, audit_path = paths(tmp_path)
    rows = audit.load_once(spark, landing, raw_path, audit_path, AS_OF).collect()
    status = {r.file_name: (r.status, r.row_count) for r in rows}
    assert status == {
        "2024-01-01-0.json.gz": ("SUCCESS", 1),
        "2024-01-01-1.json.gz": ("FAILED", 0),
        "2024-01-01-2.json.gz": ("SUCCESS", 1),
    }
    failed = next(r for r in rows if r.status == "FAILED")
    assert failed.error_message and len(failed.error_message) <= 1000
    assert failed.file_hour == at(1, 1)
    # the file is offered again, and loads once it is readable
    write_hour("2024-01-01-1.json.gz", [event("3")])
    again = audit.load_once(spark, landing, raw_path, audit_path, AS_OF).collect()
    assert [(r.file_name, r.status) for r in again] == [("2024-01-01-1.json.gz", "SUCCESS")]
    assert [i for i, _ in ids(spark, raw_path)] == ["1", "2", "3"]


def test_backfill_outcomes(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", [event("1")])
    raw_path, audit_path = paths(tmp_path)
    audit.load_once(spark, landing, raw_path, audit_path, AS_OF)
    write_hour("2024-01-01-1.json.gz", [event("2"), event("3")])
    write_hour("2024-01-01-2.json.gz", [""])
    rows = audit.backfill(spark, landing, raw_path, audit_path, AS_OF, days=1)
    assert rows.count() == 24
    kinds = {r.file_name: (r.outcome, r.reason, r.row_count) for r in rows.collect()}
    assert kinds["2024-01-01-0.json.gz"] == ("skipped", "already loaded", 0)
    assert kinds["2024-01-01-1.json.gz"] == ("loaded", "success", 2)
    assert kinds["2024-01-01-2.json.gz"] == ("skipped", "no events in file", 0)
    assert kinds["2024-01-01-3.json.gz"] == ("skipped", "missing", 0)


def test_backfill_has_one_outcome_per_file(spark):
    """Also for a file loaded twice before and for one that failed and then succeeded."""
    hours = [(f"{k}.json.gz", at(1, k)) for k in range(4)]
    expected = spark.createDataFrame(hours, "file_name STRING, expected_hour TIMESTAMP_NTZ")
    before = spark.createDataFrame([("0.json.gz",), ("0.json.gz",)], "file_name STRING")
    done = spark.createDataFrame(
        [("1.json.gz", at(2), "FAILED", 0, "timeout"), ("1.json.gz", at(3), "SUCCESS", 5, None), ("2.json.gz", at(2), "RETRY", 0, "later")],
        "file_name STRING, load_ts TIMESTAMP_NTZ, status STRING, row_count BIGINT, error_message STRING",
    )
    rows = audit.backfill_outcomes(expected, before, done).orderBy("file_name").collect()
    assert [(r.file_name, r.outcome, r.row_count) for r in rows] == [
        ("0.json.gz", "skipped", 0), ("1.json.gz", "loaded", 5), ("2.json.gz", "skipped", 0), ("3.json.gz", "skipped", 0),
    ]


def test_delete_file_events(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", [event("1"), event("2")])
    write_hour("2024-01-01-1.json.gz", [event("3")])
    raw_path, audit_path = paths(tmp_path)
    audit.load_once(spark, landing, raw_path, audit_path, AS_OF)
    assert audit.delete_file_events(spark, raw_path, audit_path, "2024-01-01-0.json.gz") == (2, 1)
    assert ids(spark, raw_path) == [("3", "2024-01-01-1.json.gz")]
    assert audit.delete_file_events(spark, raw_path, audit_path, "2024-01-01-9.json.gz") == (0, 0)
    # the replayed file loads again
    audit.load_once(spark, landing, raw_path, audit_path, AS_OF)
    assert len(ids(spark, raw_path)) == 3


def test_expected_hours(spark):
    rows = [r.expected_hour for r in hours.expected_hours(spark, AS_OF, 2).orderBy("expected_hour").collect()]
    assert len(rows) == 48 and rows[-1] == at(1, 5)
    assert hours.trailing_hours(spark, AS_OF).count() == 745
    midnights = hours.expected_midnights(spark, at(10, 5), 3).collect()
    assert sorted(r.expected_hour for r in midnights) == [at(8), at(9), at(10)]


def test_hourly_load_takes_one_file_per_run(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-4.json.gz", [event("1")])
    write_hour("2024-01-01-5.json.gz", [event("2")])
    write_hour("2024-01-01-1.json.gz", [event("3")])  # older than the look-back
    raw_path, audit_path = paths(tmp_path)
    loaded = []
    for _ in range(3):
        loaded += [r.file_name for r in audit.load_latest(spark, landing, raw_path, audit_path, AS_OF).collect()]
    assert loaded == ["2024-01-01-5.json.gz", "2024-01-01-4.json.gz"]
    assert [i for i, _ in ids(spark, raw_path)] == ["1", "2"]


def test_next_unloaded_file_prefers_the_newest(spark):
    files = spark.createDataFrame(
        [("2024-01-01-3.json.gz", at(1, 3)), ("2024-01-01-4.json.gz", at(1, 4)), ("2024-01-01-5.json.gz", at(1, 5))],
        "file_name STRING, file_hour TIMESTAMP_NTZ",
    )
    history = spark.createDataFrame(
        [("2024-01-01-5.json.gz", "SUCCESS"), ("2024-01-01-4.json.gz", "FAILED")], "file_name STRING, status STRING"
    )
    assert audit.next_unloaded_file(files, history, AS_OF, 2).first().file_name == "2024-01-01-4.json.gz"
    assert audit.next_unloaded_file(files, history, at(2), 2).count() == 0
