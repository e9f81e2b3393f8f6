"""Staging, merges and actor history against brute force on random, skewed events."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import SF_DIR, at
from pyspark.sql import functions as F

from eventlake.operators import analytics, asof, merge
from eventlake.plans import marts, pipeline, staging
from eventlake.schemas import DIM_ACTOR
from eventlake.sources import tables
from eventlake_checks import fixtures as fx

DDL = (
    "event_id STRING, event_type STRING, actor_id BIGINT, actor_login STRING, actor_type STRING, "
    "repo_id BIGINT, repo_name STRING, created_at TIMESTAMP_NTZ, source_file STRING, loaded_at TIMESTAMP_NTZ"
)
KINDS = ["PushEvent", "IssuesEvent", "WatchEvent"]


def random_events(seed: int, n: int = 600) -> list[tuple]:
    """A third of all events belongs to one actor, one repository and one type; times collide."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 1 / 3
        actor = 1 if hot else rng.choice([2, 3, 4, 5, None])
        repo = 1 if hot else rng.choice([2, 3, 4, None])
        when = datetime(2024, 1, 1) + timedelta(minutes=20 * rng.randrange(400))
        login = None if rng.random() < 0.05 else f"a{actor}" + rng.choice(["", "", "", "-bot", "-new"])
        rows.append(
            (
                str(i), KINDS[0] if hot else rng.choice(KINDS), actor, login, rng.choice([None, None, "User"]),
                repo, None if repo is None else rng.choice([f"o/r{repo}", f"o/test{repo}"]), when,
                f"f{when:%d%H}", when + timedelta(minutes=65),
            )
        )
    return rows


def kind(actor_type, login):
    return actor_type or ("Bot" if "bot" in login.lower() else "User")


@pytest.mark.parametrize("seed", [1, 2])
def test_stg_actors_brute_force(spark, seed):
    rows = random_events(seed)
    expected = {}
    for actor in {r[2] for r in rows if r[2] is not None}:
        mine = [(r[7], r[3], kind(r[4], r[3])) for r in rows if r[2] == actor and r[3] is not None]
        newest = max(m[0] for m in mine)
        _, login, cls = min(m for m in mine if m[0] == newest)
        oldest = min(m[0] for m in mine)
        expected[actor] = (login, cls, oldest, newest, (newest.date() - oldest.date()).days)
    got = {r[0]: tuple(r)[1:] for r in staging.stg_actors(spark.createDataFrame(rows, DDL)).collect()}
    assert got == expected


@pytest.mark.parametrize("seed", [3, 4])
def test_actor_history_brute_force(spark, seed):
    rows = random_events(seed)
    expected = []
    for actor in {r[2] for r in rows if r[2] is not None}:
        mine = sorted((r[7], r[3], kind(r[4], r[3]), r[0]) for r in rows if r[2] == actor and r[3] is not None)
        starts = [m for i, m in enumerate(mine) if i == 0 or mine[i - 1][1:3] != m[1:3]]
        for i, (when, login, cls, _) in enumerate(starts):
            end = starts[i + 1][0] if i + 1 < len(starts) else datetime(2099, 12, 31)
            expected.append((actor, login, cls, when, end, i + 1 == len(starts)))
    got = marts.actor_history(spark.createDataFrame(rows, DDL)).drop("actor_key").collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)
    # replayed events change nothing
    again = marts.actor_history(spark.createDataFrame(rows + rows[:100], DDL)).drop("actor_key").collect()
    assert sorted(tuple(r) for r in again) == sorted(expected)


def test_runs_go_back_to_the_events_only_for_versions_that_overlap(spark, tmp_path):
    def rows(actor, *seen):
        return [(str(i), "PushEvent", actor, login, "User", 7, "o/r", when, "f", when) for i, (login, when) in enumerate(seen)]

    apart = rows(1, ("a", at(1, 1)), ("a", at(5, 2)), ("b", at(5, 2, 1)), ("b", at(9))) + rows(2, ("c", at(3)))
    tied = rows(3, ("e", at(1)), ("e", at(2, 1)), ("d", at(2, 1)), ("d", at(4)))
    nested = rows(4, ("f", at(1)), ("g", at(2, 1)), ("f", at(2, 1, 30)), ("g", at(8)), ("f", at(9)))

    def runs(part, events):
        path = str(tmp_path / part)
        spark.createDataFrame(events, DDL).write.parquet(path)
        found = marts.actor_runs(spark.read.parquet(path))
        again = any(f"/{part}/" in name for name in found.inputFiles())
        return sorted(tuple(r) for r in found.drop("actor_type").collect()), again

    clear = [(1, "a", at(1, 1), at(5, 2)), (1, "b", at(5, 2, 1), at(9)), (2, "c", at(3), at(3))]
    assert runs("apart", apart) == (clear, False)
    # of events at one time the smaller login comes first, so e is seen on both sides of d
    ends = [(3, "d", at(2, 1), at(2, 1)), (3, "d", at(4), at(4)), (3, "e", at(1), at(1)), (3, "e", at(2, 1), at(2, 1))]
    back = [(4, "f", at(1), at(1)), (4, "f", at(2, 1, 30), at(2, 1, 30)), (4, "f", at(9), at(9)), (4, "g", at(2, 1), at(2, 1)), (4, "g", at(8), at(8))]
    assert runs("all", apart + tied + nested) == (clear + ends + back, True)
    assert runs("none", []) == ([], False)


@pytest.mark.parametrize("seed", [5, 6])
def test_merging_any_split_equals_staging_everything(spark, seed):
    rows = random_events(seed)
    rng = random.Random(seed)
    parts = [[], [], []]
    for row in rows:
        parts[rng.randrange(3)].append(row)
    frames = [spark.createDataFrame(p, DDL) for p in parts]
    everything = spark.createDataFrame(rows, DDL)

    actors = [staging.stg_actors(f).drop("days_active") for f in frames]
    merged = staging.merge_actors(actors[0].unionByName(actors[1]).unionByName(actors[2]).unionByName(actors[1]))
    assert bag(merged) == bag(staging.stg_actors(everything))
    repos = [staging.stg_repositories(f).select("repo_id", "repo_name", "first_event_at", "last_event_at") for f in frames]
    merged = staging.merge_repositories(repos[0].unionByName(repos[1]).unionByName(repos[2]))
    assert bag(merged) == bag(staging.stg_repositories(everything))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def versions(df):
    rows = df.orderBy("actor_id", "valid_from").collect()
    return [(r.actor_id, r.actor_login, r.valid_from, r.valid_to, r.is_current) for r in rows]


def test_scd2_merge(spark):
    def snapshot(*rows):
        return spark.createDataFrame(
            [(i, login, "User", at(1), at(last)) for i, login, last in rows],
            "actor_id BIGINT, actor_login STRING, actor_type STRING, first_seen_at TIMESTAMP_NTZ, "
            "last_seen_at TIMESTAMP_NTZ",
        ).withColumn("days_active", F.lit(0).cast("bigint"))

    far = datetime(2099, 12, 31)
    first = marts.dim_actor(snapshot((1, "a", 1), (2, "b", 1), (3, "c", 1)), at(2))
    second = marts.dim_actor_scd2(first, snapshot((1, "a2", 3), (2, "b", 4), (4, "d", 3)), at(5))
    expected = [
        (1, "a", at(2), at(5), False),
        (1, "a2", at(5), far, True),
        (2, "b", at(2), far, True),
        (3, "c", at(2), far, True),
        (4, "d", at(5), far, True),
    ]
    assert versions(second) == expected
    assert second.where("actor_id = 2").first().days_active == 3
    # the same snapshot again changes nothing
    assert versions(marts.dim_actor_scd2(second, snapshot((1, "a2", 3), (2, "b", 4), (4, "d", 3)), at(6))) == expected
    # back to the old login: a third version
    third = marts.dim_actor_scd2(second, snapshot((1, "a", 7)), at(8))
    assert [v for v in versions(third) if v[0] == 1] == [
        (1, "a", at(2), at(5), False),
        (1, "a2", at(5), at(8), False),
        (1, "a", at(8), far, True),
    ]
    # intervals of an actor never overlap and exactly one version is current
    current = third.where("is_current").groupBy("actor_id").count().where("count <> 1")
    assert current.count() == 0


def test_events_without_a_time_never_win_as_latest(spark):
    rows = [("1", "PushEvent", 1, "old", None, 1, "o/a", None, "f", at(9)), ("2", "PushEvent", 1, "zoe", None, 1, "o/z", at(5), "f", at(6))]
    events = spark.createDataFrame(rows, DDL)
    actor, repo = staging.stg_actors(events).first(), staging.stg_repositories(events).first()
    assert (actor.actor_login, actor.last_seen_at) == ("zoe", at(5))
    assert (repo.repo_name, repo.last_event_at) == ("o/z", at(5))
    alone = staging.stg_actors(events.where("event_id = '1'")).first()
    assert (alone.actor_login, alone.last_seen_at) == ("old", None)


def dimension(spark, tmp_path, batches, events):
    path = str(tmp_path / "dim")
    for batch in batches:
        merged = marts.dim_actor_from_batch(tables.read_table(spark, path, DIM_ACTOR), batch, events, at(9))
        tables.overwrite_table(merged, path, marts.write_dim_actor)
    return tables.read_table(spark, path, DIM_ACTOR)


def test_late_rows_do_not_flip_the_login_back(spark, tmp_path):
    early = spark.createDataFrame([("1", "PushEvent", 1, "old", None, 1, "o/r", at(3), "f", at(9))], DDL)
    newer = spark.createDataFrame([("2", "PushEvent", 1, "new", None, 1, "o/r", at(5), "f", at(6))], DDL)
    merged = dimension(spark, tmp_path, [newer, early], newer.unionByName(early))
    rows = merged.orderBy("valid_from").collect()
    assert [(r.actor_login, r.is_current, r.first_seen_at) for r in rows] == [("old", False, at(3)), ("new", True, at(3))]


def renaming_events(seed, n):
    """Actors that change login and type often, also within an hour and at equal times, and one dominant actor."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        actor = 1 if rng.random() < 0.4 else rng.choice([2, 3, None])
        login = rng.choice(["ann", "bob", "bot-x", None]) if rng.random() < 0.3 else "ann"
        when = at(1 + rng.randrange(2), rng.randrange(4), rng.choice([0, 10, 10, 20]))
        rows.append((str(i), "PushEvent", actor, login, rng.choice([None, "User"]), 1, "o/r", when, "f", at(9)))
    return rows


@pytest.mark.parametrize("seed", [11, 12])
def test_batches_in_any_order_give_the_same_history(spark, tmp_path, seed):
    rows = renaming_events(seed, 90)
    rng = random.Random(seed)
    parts = [[], [], []]
    for row in rows:
        parts[rng.randrange(3)].append(row)
    events = spark.createDataFrame(rows, DDL)
    batches = [spark.createDataFrame(p, DDL) for p in parts]
    found = dimension(spark, tmp_path, [*batches, batches[1]], events)
    full = marts.dim_actor_history(events, at(9))
    assert bag(found) == bag(full.select(*found.columns))
    # by hand: the order of events, ties by login and type
    classed = sorted(
        (r[7], r[3], r[4] or ("Bot" if "bot" in r[3] else "User"), r[2]) for r in rows if r[2] is not None and r[3] is not None
    )
    expected = []
    for actor in {c[3] for c in classed}:
        last = None
        for when, login, kind, _ in (c for c in classed if c[3] == actor):
            if (login, kind) != last:
                expected.append((actor, login, kind, when))
            last = (login, kind)
    assert sorted(expected) == sorted((r.actor_id, r.actor_login, r.actor_type, r.valid_from) for r in found.collect())


def test_a_batch_leaves_other_actors_and_clocks_alone(spark, tmp_path):
    def events(*rows):
        full = [(str(i), "PushEvent", a, login, None, 1, "o/r", when, "f", at(9)) for i, (a, login, when) in enumerate(rows)]
        return spark.createDataFrame(full, DDL)

    first, second = events((1, "a", at(1)), (2, "b", at(1)), (2, "b", at(3))), events((2, "c", at(2)))
    both = first.unionByName(second)
    target = tables.read_table(spark, str(tmp_path / "none"), DIM_ACTOR)
    one = marts.dim_actor_from_batch(target, first, both, at(10))
    path = str(tmp_path / "one")
    one.write.parquet(path)
    two = marts.dim_actor_from_batch(spark.read.parquet(path), second, both, at(11))
    clocks = [(r.actor_login, r.valid_from, r.valid_to, r.created_ts, r.updated_ts) for r in two.orderBy("actor_id", "valid_from").collect()]
    far = datetime(2099, 12, 31)
    assert clocks == [
        ("a", at(1), far, at(10), at(10)),
        ("b", at(1), at(2), at(10), at(11)),
        ("c", at(2), at(3), at(11), at(11)),
        ("b", at(3), far, at(11), at(11)),
    ]


def plain_versions(fact_rows, versions):
    """The version in force per event by a loop."""
    out = []
    for actor, when, *groups in fact_rows:
        mine = sorted(v for v in versions if v[0] == actor)
        past = [v for v in mine if when is not None and v[1] <= when] or mine[:1]
        out.append((*groups, actor, past[-1][3] if past else None))
    return Counter(out)


def test_counts_go_by_the_version_in_force(spark, monkeypatch):
    rng = random.Random(3)
    facts = []
    for _ in range(900):
        actor = 1 if rng.random() < 0.5 else rng.choice([2, 3, 4, None, 9])
        when = None if rng.random() < 0.05 else at(1 + rng.randrange(3), rng.randrange(3), rng.choice([0, 15, 30]))
        facts.append((actor, when, rng.choice(["x", "y"])))
    versions = [
        (1, at(1, 1), at(2), "one"), (1, at(2), at(2), "never"), (1, at(2), at(3, 1, 15), "two"), (1, at(3, 1, 15), at(30), "three"),
        (2, at(2, 1, 30), at(30), "only"), (3, at(1), at(2, 1, 15), "p"), (3, at(2, 1, 15), at(30), "q"),
    ]
    fact = spark.createDataFrame(facts, "actor_id BIGINT, created_at TIMESTAMP_NTZ, g STRING")
    dim = spark.createDataFrame(versions, "actor_id BIGINT, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, actor_login STRING")
    for most in (10, 1):
        monkeypatch.setattr(asof, "MOST_SENT", most)
        got = asof.count_in_force(fact, dim, ["g"], ["actor_login"])
        counts = Counter({(r.g, r.actor_id, r.actor_login): 0 for r in got.collect()})
        for r in got.collect():
            counts[(r.g, r.actor_id, r.actor_login)] += r.n
        assert counts == plain_versions([(a, w, g) for a, w, g in facts], versions)
    empty = asof.count_in_force(fact, dim.limit(0), [], ["actor_login"])
    assert sum(r.n for r in empty.collect()) == len(facts)
    assert asof.count_in_force(fact.limit(0), dim, [], ["actor_login"]).collect() == []


def test_reports_count_each_event_once_over_several_versions(spark):
    events = fx.staged(spark, SF_DIR.replace("sf0.01", "sf0.001"))
    fact, dim = marts.fact_events(events, at(31)), marts.dim_actor_history(events, at(31))
    assert dim.where("NOT is_current").count() > 0
    repos = marts.dim_repository(staging.stg_repositories(events), at(31))
    types = marts.dim_event_type(staging.stg_event_types(events), at(31))
    for at_event in (False, True):
        for df, column in (
            (analytics.star_join_rollup(fact, dim, repos, types, 10**6, at_event), "event_count"),
            (analytics.developer_daily(fact, dim, at_event), "events"),
            (analytics.bot_share(fact, dim, at_event), "event_count"),
        ):
            assert df.agg(F.sum(column)).first()[0] == fact.count()


@pytest.mark.parametrize("seed", [21])
def test_event_types_from_batches_equal_those_of_all_events(spark, tmp_path, seed):
    rows = random_events(seed)
    rng = random.Random(seed)
    parts = [[], [], []]
    for row in rows:
        part = rng.randrange(3)
        parts[part].append((*row[:8], f"file{part}-{rng.randrange(2)}", row[9]))
    frames = [spark.createDataFrame(p, DDL) for p in parts]
    paths = pipeline.LakePaths(str(tmp_path))
    pipeline.update_event_types(spark, paths, frames[2], "c")
    pipeline.update_event_types(spark, paths, frames[0], "a")
    # broke off, then came again with more files under another name; and a batch that is simply repeated
    for _ in range(2):
        found = pipeline.update_event_types(spark, paths, frames[0].unionByName(frames[1]), "ab")
    full = staging.stg_event_types(frames[0].unionByName(frames[1]).unionByName(frames[2]))
    assert bag(found.select(*full.columns)) == bag(full)
    # a file that was loaded again lost events
    left = frames[0].unionByName(frames[2])
    rebuilt = pipeline.update_event_types(spark, paths, frames[2], "d", left)
    assert bag(rebuilt.select(*full.columns)) == bag(staging.stg_event_types(left))
    again = pipeline.update_event_types(spark, paths, frames[1], "e")
    assert bag(again.select(*full.columns)) == bag(full)


def test_incremental_over_any_cut_equals_full_build(spark):
    events = fx.staged(spark, SF_DIR.replace("sf0.01", "sf0.001"))
    full = marts.fact_events(events, at(31))
    for day in (1, 7, 25):
        base = marts.fact_events(fx.loaded_before(events, at(day, 12)), at(31))
        merged = marts.fact_events_incremental(base, events, at(31))
        assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0


def test_incremental_into_an_empty_target(spark):
    events = spark.createDataFrame(random_events(7, 50), DDL)
    empty = marts.fact_events(events.limit(0), at(31))
    assert marts.fact_events_incremental(empty, events, at(31)).count() == 50


def test_dedup_of_one_dominant_key(spark):
    rows = [("same" if i % 3 == 0 else str(i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id STRING, n BIGINT").select(
        "event_id",
        F.lit("f").alias("source_file"),
        (F.lit(at(1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("n"))).alias("loaded_at"),
    )
    kept = merge.dedup_by_key(df)
    assert kept.count() == 2001
    assert kept.where("event_id = 'same'").first().loaded_at == at(1) + timedelta(seconds=2997)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_top_k_with_ties_and_nulls(spark):
    rows = random_events(8)
    events = spark.createDataFrame(rows, DDL)
    counts = {}
    for r in rows:
        counts.setdefault((r[5], r[6]), []).append(r)
    ranked = sorted(counts, key=lambda g: (-len(counts[g]), g[0] is None, g[0] or 0, g[1] or ""))
    got = analytics.top_repositories(events, 4).collect()
    assert [(r.repo_id, r.repo_name) for r in got] == ranked[:4]
    for r in got:
        mine = counts[(r.repo_id, r.repo_name)]
        assert r.total_events == len(mine)
        assert r.unique_contributors == len({m[2] for m in mine if m[2] is not None})
        assert r.event_type_list == sorted({m[1] for m in mine})


def test_typed_fixture_equals_parsed_documents(spark):
    events = fx.staged(spark, SF_DIR)
    parsed = staging.stg_events(fx.raw(spark, SF_DIR)).drop("payload")
    typed = events.select(*parsed.columns)
    assert parsed.exceptAll(typed).count() == 0 and typed.exceptAll(parsed).count() == 0
