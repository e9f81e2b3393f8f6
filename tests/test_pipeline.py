"""The pipeline over growing landings, and the streaming jobs over repeated runs."""

from __future__ import annotations

from datetime import timedelta

from conftest import at, event

from eventlake.operators import quality
from eventlake.plans import marts, pipeline, staging
from eventlake.schemas import RAW_EVENTS
from eventlake.sources import audit, ndjson, tables
from eventlake.streaming import jobs

STAGED = (
    "event_id STRING, event_type STRING, actor_id BIGINT, actor_login STRING, actor_type STRING, "
    "repo_id BIGINT, repo_name STRING, created_at TIMESTAMP_NTZ, source_file STRING, loaded_at TIMESTAMP_NTZ"
)


def hour(h, *ids, login="ann"):
    return [event(i, login=login, actor_id=1 + int(i) % 2, at=f"2024-01-01T{h:02d}:10:00Z") for i in ids]


def bag(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_two_runs_equal_one_full_build(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", hour(0, "1", "2"))
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    first = {r.step: (r.status, r.row_count) for r in pipeline.run_pipeline(spark, landing, paths, at(1, 1)).collect()}
    assert first["fact"] == ("done", 2) and first["dim_actor"] == ("done", 2)
    assert first["tests"] == ("pass", 0) and first["freshness"][0] == "pass"

    # the second file repeats event 2 and renames one actor
    write_hour("2024-01-01-1.json.gz", hour(1, "2", "3", "5", login="eve"))
    second = {r.step: (r.status, r.row_count) for r in pipeline.run_pipeline(spark, landing, paths, at(1, 2)).collect()}
    assert second["ingest"] == ("done", 5)
    assert second["fact"] == ("done", 4)
    fact = pipeline.read(spark, paths, "fact_events")
    assert bag(fact, "event_id", "actor_login") == [("1", "ann"), ("2", "eve"), ("3", "eve"), ("5", "eve")]
    versions = bag(pipeline.read(spark, paths, "dim_actor"), "actor_id", "actor_login", "is_current")
    assert versions == [(1, "ann", False), (1, "eve", True), (2, "ann", False), (2, "eve", True)]
    staged = pipeline.read(spark, paths, "stg_events")
    repos = pipeline.read(spark, paths, "dim_repository")
    full = marts.dim_repository(staging.stg_repositories(staged), at(1, 2))
    assert bag(repos, "repo_id", "first_event_at", "last_event_at") == bag(full, "repo_id", "first_event_at", "last_event_at")
    assert quality.scd2_multiple_current(pipeline.read(spark, paths, "dim_actor")).count() == 0

    # nothing new: same tables
    third = {r.step: (r.status, r.row_count) for r in pipeline.run_pipeline(spark, landing, paths, at(1, 3)).collect()}
    assert {k: v for k, v in third.items() if k != "freshness"} == {k: v for k, v in second.items() if k != "freshness"}


def fact_ids(spark, paths):
    return bag(pipeline.read(spark, paths, "fact_events"), "event_id", "source_file")


def run(spark, landing, paths, as_of):
    return {r.step: r.status for r in pipeline.run_pipeline(spark, landing, paths, as_of, test=False).collect()}


def test_loads_in_any_order_of_time_reach_the_fact(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", hour(0, "1", "2"))
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    a, b, c, d = (f"2024-01-01-{h}.json.gz" for h in range(4))
    run(spark, landing, paths, at(1, 5))
    write_hour(b, hour(1, "3", "2"))
    run(spark, landing, paths, at(1, 5))  # the same time
    # the copy in the file whose name sorts first counts, as both were loaded at one time
    assert fact_ids(spark, paths) == [("1", a), ("2", a), ("3", b)]
    write_hour(c, hour(2, "4", "1"))
    run(spark, landing, paths, at(1, 3))  # an earlier time: newer copies stay
    assert fact_ids(spark, paths) == [("1", a), ("2", a), ("3", b), ("4", c)]
    write_hour(d, hour(3, "5", "1"))
    run(spark, landing, paths, at(1, 7))  # a later time: its copy wins
    assert fact_ids(spark, paths) == [("1", d), ("2", a), ("3", b), ("4", c), ("5", d)]
    staged = pipeline.read(spark, paths, "stg_events")
    assert staged.count() == pipeline.read(spark, paths, "raw_events").count() == 8
    assert staged.select("event_id").distinct().count() == 5


def test_backfill_that_ends_after_an_hourly_run(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-1.json.gz", hour(1, "3"))
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    run(spark, landing, paths, at(1, 6))
    write_hour("2024-01-01-0.json.gz", hour(0, "1", "2"))
    raw, history = paths.table("raw_events"), paths.table("load_history")
    audit.backfill(spark, landing, raw, history, at(1, 4), days=1)  # began before the hourly run
    run(spark, landing, paths, at(1, 7))
    assert [i for i, _ in fact_ids(spark, paths)] == ["1", "2", "3"]


def test_file_loaded_again_with_other_content(spark, tmp_path, write_hour):
    a, b = "2024-01-01-0.json.gz", "2024-01-01-1.json.gz"
    landing = write_hour(a, hour(0, "1", "2", "3"))
    write_hour(b, hour(1, "3", "4"))
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    run(spark, landing, paths, at(1, 5))
    raw, history, entries = (paths.table(t) for t in ("raw_events", "load_history", pipeline.LEDGER))
    audit.delete_file_events(spark, raw, history, a, entries)
    write_hour(a, [event("1", login="eve", at="2024-01-02T00:10:00Z"), *hour(0, "9")])
    run(spark, landing, paths, at(1, 5))  # with the time of the first load
    assert fact_ids(spark, paths) == [("1", a), ("3", b), ("4", b), ("9", a)]
    rows = bag(pipeline.read(spark, paths, "fact_events").where("event_id = '1'"), "event_date", "actor_login")
    assert [(str(d), who) for d, who in rows] == [("2024-01-02", "eve")]
    audit.delete_file_events(spark, raw, history, b, entries)
    write_hour(b, [""])
    run(spark, landing, paths, at(1, 8))
    assert [i for i, _ in fact_ids(spark, paths)] == ["1", "9"]


def test_processed_folders_are_not_opened(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", hour(0, "1"))
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    run(spark, landing, paths, at(1, 5))
    for table, column in (("raw_events", "file_name"), ("stg_events", "source_file")):
        for part in (tmp_path / "lake" / table / f"{column}=2024-01-01-0.json.gz").glob("*.parquet"):
            part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
            part.write_bytes(b"no parquet")
    write_hour("2024-01-01-1.json.gz", hour(1, "2"))
    raw, history = paths.table("raw_events"), paths.table("load_history")
    audit.load_once(spark, landing, raw, history, at(1, 6))
    pipeline.build_staging(spark, paths)
    pipeline.build_fact(spark, paths, at(1, 6))
    assert [i for i, _ in fact_ids(spark, paths)] == ["1", "2"]


def test_unreadable_file_shows_in_the_report(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", hour(0, "1"))
    with open(f"{landing}/2024-01-01-1.json.gz", "wb") as handle:
        handle.write(b"this is not gzip")
    steps = run(spark, landing, pipeline.LakePaths(str(tmp_path / "lake")), at(1, 2))
    assert steps["ingest"] == "failed" and steps["fact"] == "done"


def test_stream_ingest_takes_new_files_only(spark, tmp_path, write_hour):
    landing = write_hour("2024-01-01-0.json.gz", hour(0, "1", "2") + ["", "{"])
    raw_path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")

    def run(load_hour):
        jobs.stream_ingest_files(spark, landing, raw_path, checkpoint, at(1, load_hour), files_per_batch=1)
        return bag(tables.read_table(spark, raw_path, RAW_EVENTS), "file_name", "load_ts")

    first = run(1)
    assert first == [("2024-01-01-0.json.gz", at(1, 1))] * 2
    write_hour("2024-01-01-1.json.gz", hour(1, "3"))
    write_hour("2024-01-01-2.json.gz", hour(2, "4"))
    second = run(3)
    assert second == first + [("2024-01-01-1.json.gz", at(1, 3)), ("2024-01-01-2.json.gz", at(1, 3))]
    assert run(4) == second


def staged_rows(*rows):
    return [
        (i, "PushEvent", 1, "ann", None, 7, "o/r", created, "f", created + timedelta(hours=lag))
        for i, created, lag in rows
    ]


def parquet_stream(spark, folder):
    return spark.readStream.schema(STAGED).option("maxFilesPerTrigger", "1").parquet(folder)


def test_stream_dedup_across_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    checkpoint = str(tmp_path / "checkpoint")
    for rows in ([("1", at(1, 1), 1), ("2", at(1, 1), 1)], [("2", at(1, 1), 2), ("3", at(1, 2), 1)]):
        spark.createDataFrame(staged_rows(*rows), STAGED).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.dedup_stream(parquet_stream(spark, source)).select("event_id")
        jobs.write_stream(stream, out, checkpoint)
    assert bag(spark.read.parquet(out), "event_id") == [("1",), ("2",), ("3",)]


def test_stream_counts_by_minute(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("1", at(1, 1, 5), 1), ("2", at(1, 1, 5), 1), ("3", at(1, 1, 7), 1), ("4", at(1, 9), 1)]
    spark.createDataFrame(staged_rows(*rows), STAGED).coalesce(1).write.parquet(source)
    counts = jobs.counts_stream(parquet_stream(spark, source), "1 minute", "10 minutes")
    jobs.write_stream(counts, out, str(tmp_path / "checkpoint"))
    # the newest window stays open until the watermark passes it
    assert bag(spark.read.parquet(out), "window_start", "event_count") == [(at(1, 1, 5), 2), (at(1, 1, 7), 1)]


def test_stored_events_are_copies_however_late(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    # copies in one batch, and rows without an id or a time, which are nobody's copies
    first = [("1", at(1, 1), 1), ("1", at(1, 1), 2), ("2", at(2, 1), 1), (None, at(2, 1), 1), (None, at(2, 1), 1)]
    staged = staged_rows(*first) + [("9", "PushEvent", 1, "ann", None, 7, "o/r", None, "f", None)]
    spark.createDataFrame(staged, STAGED).coalesce(1).write.parquet(source)
    jobs.stream_dedup_stored(parquet_stream(spark, source), out, str(tmp_path / "a"), window="1 second")
    rows = spark.read.parquet(out)
    assert sorted(str(r.event_id) for r in rows.collect()) == ["1", "2", "9", "None", "None"]
    # two days late: a copy goes, an event that was never seen stays, also when older than all watermarks
    spark.createDataFrame(staged_rows(("1", at(1, 1), 48), ("3", at(1, 1), 48)), STAGED).coalesce(1).write.mode("append").parquet(source)
    jobs.stream_dedup_stored(parquet_stream(spark, source), out, str(tmp_path / "a"), window="1 second")
    kept = sorted(str(r.event_id) for r in spark.read.parquet(out).collect())
    assert kept == ["1", "2", "3", "9", "None", "None"]
    # a lost checkpoint replays all batches: rows with an id and a time are not written again
    jobs.stream_dedup_stored(parquet_stream(spark, source), out, str(tmp_path / "b"), window="1 second")
    again = [r.event_id for r in spark.read.parquet(out).where("event_id IS NOT NULL AND created_at IS NOT NULL").collect()]
    assert sorted(again) == ["1", "2", "3"]


def test_stored_events_of_other_dates_are_not_opened(spark, tmp_path):
    source, out = str(tmp_path / "in"), tmp_path / "out"
    spark.createDataFrame(staged_rows(("1", at(1, 1), 1), ("2", at(2, 1), 1)), STAGED).coalesce(1).write.parquet(source)
    jobs.stream_dedup_stored(parquet_stream(spark, source), str(out), str(tmp_path / "a"))
    for part in (out / "event_date=2024-01-01").rglob("*.parquet"):
        part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
        part.write_bytes(b"no parquet")
    spark.createDataFrame(staged_rows(("2", at(2, 1), 30), ("4", at(2, 3), 30)), STAGED).coalesce(1).write.mode("append").parquet(source)
    jobs.stream_dedup_stored(parquet_stream(spark, source), str(out), str(tmp_path / "a"))
    assert bag(spark.read.parquet(str(out / "event_date=2024-01-02")), "event_id") == [("2",), ("4",)]


def test_hourly_anomaly_over_batches_equals_the_window(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    counts = [5, 5, 9, 1, 0, 4, 5, 6, 2, 8, 3, 3]
    rows = [(f"{h}-{i}", at(1, h, i), 1) for h, n in enumerate(counts) for i in range(n)]
    for part in (rows[:12], rows[12:30], rows[30:]):
        spark.createDataFrame(staged_rows(*part), STAGED).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.hourly_anomaly_stream(parquet_stream(spark, source), delay="1 hour", before=3)
        jobs.write_stream(stream, out, checkpoint)
    expected, seen = [], []
    for h, n in enumerate(counts[:10]):
        if n:
            mean = sum(seen[-3:]) / len(seen[-3:]) if seen else None
            flag = "NORMAL" if mean is None or 0.8 * mean <= n <= 1.2 * mean else "LOW" if n < mean else "HIGH"
            expected.append((at(1, h), n, flag))
            seen.append(n)
    assert bag(spark.read.parquet(out), "event_hour", "event_count", "anomaly_flag") == expected


def test_idle_series_starts_anew(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    kinds = [("a", at(1, 1), "X"), ("b", at(1, 1), None), ("c", at(3, 1), None), ("d", at(3, 9), None), ("e", at(3, 10), "X"),
             ("f", at(3, 11), None), ("g", at(4, 1), None)]
    for event_id, created, kind in kinds:
        row = (event_id, kind, 1, "ann", None, 7, "o/r", created, "f", created)
        spark.createDataFrame([row], STAGED).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.hourly_anomaly_stream(parquet_stream(spark, source), "event_type", delay="1 hour", idle_hours=24)
        jobs.write_stream(stream, out, checkpoint)
    rows = {(r.series, r.event_hour): r.avg_before for r in spark.read.parquet(out).collect()}
    # X was idle for two days; the series of events without a type had its own
    assert rows[("X", at(1, 1))] is None and rows[("X", at(3, 10))] is None
    assert rows[(None, at(3, 9))] == 1 and rows[(None, at(3, 11))] == 1


def test_stream_keeps_late_rows_aside(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("1", at(1, 1), 1), ("2", at(1, 1), 5)]
    spark.createDataFrame(staged_rows(*rows), STAGED).coalesce(1).write.parquet(source)
    kept, late = str(tmp_path / "kept"), str(tmp_path / "late")
    jobs.stream_late_data(parquet_stream(spark, source), kept, late, str(tmp_path / "checkpoint"))
    assert bag(spark.read.parquet(kept), "event_id") == [("1",)]
    assert bag(spark.read.parquet(late), "event_id") == [("2",)]


def test_stream_upsert_is_repeatable(spark, tmp_path):
    source = str(tmp_path / "in")
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    spark.createDataFrame(staged_rows(("1", at(1, 1), 1), ("2", at(2, 1), 1)), STAGED).coalesce(1).write.parquet(source)

    def run(checkpoint):
        jobs.stream_upsert_marts(parquet_stream(spark, source), paths, str(tmp_path / checkpoint), at(3))
        return (
            bag(pipeline.read(spark, paths, "fact_events"), "event_id", "event_date", "loaded_at"),
            bag(pipeline.read(spark, paths, "dim_actor"), "actor_id", "last_seen_at", "is_current"),
            bag(pipeline.read(spark, paths, "dim_repository"), "repo_id", "last_event_at"),
        )

    once = run("a")
    assert len(once[0]) == 2 and once[1] == [(1, at(2, 1), True)] and once[2] == [(7, at(2, 1))]
    # a lost checkpoint replays every batch
    assert run("b") == once
    spark.createDataFrame(staged_rows(("2", at(2, 1), 2)), STAGED).coalesce(1).write.mode("append").parquet(source)
    fact, _, _ = run("b")
    assert [r[2] for r in fact] == [at(1, 2), at(2, 3)]


def test_landing_writer_round_trip(spark, tmp_path):
    rows = [(event(i, at=f"2024-01-01T0{h}:00:00Z"), f"2024-01-01-{h}.json.gz") for i, h in (("1", 0), ("2", 0), ("3", 5))]
    folder = str(tmp_path / "landing")
    ndjson.write_hour_files(spark.createDataFrame(rows, "value STRING, file_name STRING"), folder)
    lines = ndjson.read_lines(spark, folder)
    assert bag(lines, "value", "file_name") == sorted(rows)
