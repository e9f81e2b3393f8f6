"""Daily summaries: merged answers against the events they were made of."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from conftest import at, event

from eventlake.operators import analytics, summaries
from eventlake.plans import pipeline
from eventlake.sources import tables

EVENTS = (
    "repo_id long, repo_name string, actor_id long, actor_login string, actor_type string, event_type string, created_at timestamp_ntz"
)
REPO = analytics.REPOSITORY


def events(spark, rows):
    return spark.createDataFrame(
        [(r, None if r is None else f"r{r}", r, f"a{r}", "User", "PushEvent", t) for r, t in rows], EVENTS
    )


def random_events(spark, seed, days=12, n=4000):
    """A third of all events in one repository, a long tail of others, some without id or time."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        repo = 1 if rng.random() < 0.33 else rng.choice([None, *range(2, 8)]) if rng.random() < 0.5 else rng.randrange(8, 400)
        when = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(days * 1440))
        rows.append((repo, when if rng.random() > 0.01 else None))
    return events(spark, rows)


def test_leaders_give_the_exact_first_k(spark):
    df = random_events(spark, 5)
    span = (date(2024, 1, 3), date(2024, 1, 9))
    inside = summaries.within(summaries.with_day(df), *span)
    for most, k, sure in ((12, 5, True), (400, 50, True), (3, 40, False)):
        leaders = summaries.daily_leaders(df, REPO, most)
        per_day = leaders.groupBy("event_date").count().agg({"count": "max"}).first()[0]
        assert per_day <= most
        found = summaries.candidates(leaders, REPO, k, *span)
        assert found.certain is sure
        got = analytics.top_repositories_over(df, leaders, k, *span).collect()
        assert got == analytics.top_repositories(inside, k).collect() and len(got) == k
    # few candidates are left, so the second look is narrow
    narrow = summaries.candidates(summaries.daily_leaders(df, REPO, 12), REPO, 5, *span)
    assert 5 <= narrow.number < 20


def test_cut_bounds_what_is_left_out(spark):
    day = datetime(2024, 1, 1)
    # repository 9 is second on each day and never first, but first over both
    rows = [(1, day)] * 5 + [(9, day)] * 4 + [(2, day + timedelta(days=1))] * 5 + [(9, day + timedelta(days=1))] * 4
    df = events(spark, rows)
    leaders = summaries.daily_leaders(df, REPO, 1)
    assert sorted((r.repo_id, r.n, r.cut) for r in leaders.collect()) == [(1, 5, 4), (2, 5, 4)]
    found = summaries.candidates(leaders, REPO, 1)
    assert not found.certain
    assert [(r.repo_id, r.total_events) for r in analytics.top_repositories_over(df, leaders, 1).collect()] == [(9, 8)]
    # a tie between a leader and a group that never was one is no certainty either
    tied = events(spark, [(5, day)] * 3 + [(4, day)] * 3)
    leaders = summaries.daily_leaders(tied.where("repo_id = 5").unionByName(tied), REPO, 1)
    assert [r.repo_id for r in analytics.top_repositories_over(tied, summaries.daily_leaders(tied, REPO, 1), 1).collect()] == [4]
    assert leaders.first().repo_id == 5


def test_empty_tables_and_spans(spark):
    none = events(spark, [])
    leaders = summaries.daily_leaders(none, REPO)
    assert analytics.top_repositories_over(none, leaders, 3).count() == 0
    row = summaries.rate_over(summaries.minute_rates(none)).collect()
    assert len(row) == 1 and not any(row[0])
    some = random_events(spark, 1, days=2, n=50)
    assert not any(summaries.rate_over(summaries.minute_rates(some), first=date(2025, 1, 1)).first())


def test_merged_sketches_keep_their_rank_error(spark):
    df = random_events(spark, 2, days=20, n=30000)
    rates = summaries.minute_rates(df)
    assert rates.count() == 20
    found = summaries.rate_over(rates).first()
    exact = analytics.event_rate_per_minute(df.where("created_at IS NOT NULL")).first()
    for name in ("min_per_minute", "max_per_minute", "avg_per_minute"):
        assert found[name] == exact[name]
    counts = sorted(
        r["count"] for r in df.where("created_at IS NOT NULL").groupBy("created_at").count().collect()
    )
    for p, name in ((0.25, "p25_per_minute"), (0.5, "median_per_minute"), (0.75, "p75_per_minute")):
        below = sum(c < found[name] for c in counts) / len(counts)
        upto = sum(c <= found[name] for c in counts) / len(counts)
        assert below - summaries.RANK_ERROR <= p <= upto + summaries.RANK_ERROR


def test_pipeline_keeps_summaries_of_touched_days(spark, tmp_path, write_hour):
    def lines(*rows):
        return [event(i, repo_id=r, name=f"o/{r}", at=f"2024-01-{d:02d}T{m}Z") for i, r, d, m in rows]

    def leaders():
        rows = spark.read.parquet(paths.table("repository_leaders"))
        return sorted((r.event_date.day, r.repo_id, r.n) for r in rows.collect())

    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    landing = write_hour("2024-01-01-0.json.gz", lines(("1", 7, 1, "00:10:00"), ("2", 8, 1, "00:11:00")))
    pipeline.run_pipeline(spark, landing, paths, at(1, 1), test=False)
    assert leaders() == [(1, 7, 1), (1, 8, 1)]
    # a late event of the first day beside those of the second; the copy of event 2 counts once
    write_hour("2024-01-02-0.json.gz", lines(("3", 7, 1, "23:59:00"), ("4", 7, 2, "00:10:00"), ("2", 8, 1, "00:11:00")))
    pipeline.run_pipeline(spark, landing, paths, at(2, 1), test=False)
    assert leaders() == [(1, 7, 2), (1, 8, 1), (2, 7, 1)]
    rates = spark.read.parquet(paths.table("minute_rates"))
    assert sorted((r.event_date.day, r.minutes, r.events) for r in rates.collect()) == [(1, 3, 3), (2, 1, 1)]
    folders = tables.existing_partitions(spark, paths.table("minute_rates"), "event_date", ["2024-01-01", "2024-01-02"])
    pipeline.run_pipeline(spark, landing, paths, at(2, 2), test=False)
    assert leaders() == [(1, 7, 2), (1, 8, 1), (2, 7, 1)] and len(folders) == 2
