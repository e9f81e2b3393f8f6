"""What the layouts let a scan skip, counted in row groups."""

from __future__ import annotations

from glob import glob

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR, at
from pyspark.sql import functions as F

from eventlake.functions.scalars import surrogate_key
from eventlake.plans import marts
from eventlake.schemas import FACT_EVENTS, LOAD_HISTORY, RAW_EVENTS
from eventlake.sources import audit, layout, tables
from eventlake_checks import fixtures as fx

# small row groups, so that a small table has many
SMALL = {"parquet.block.size": "32768", "parquet.page.size.row.check.min": "64", "parquet.page.size": "4096"}


def row_groups(path):
    for name in glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        for i in range(meta.num_row_groups):
            group = meta.row_group(i)
            yield {c.path_in_schema: c for c in map(group.column, range(group.num_columns))}


def share_read(path, column, values):
    """Mean share of the row groups whose bounds admit a value."""
    bounds = [g[column].statistics for g in row_groups(path)]
    return sum(s.min <= v <= s.max for v in values for s in bounds) / (len(values) * len(bounds)), len(bounds)


@pytest.fixture(scope="module")
def fact(spark):
    """One date; a third of all events are of one repository."""
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("PushEvent").alias("event_type"),
        F.pmod(F.xxhash64("id"), F.lit(3000)).alias("actor_id"),
        F.lit("ann").alias("actor_login"),
        F.lit(None).cast("string").alias("actor_type"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3000))).alias("repo_id"),
        F.lit("o/r").alias("repo_name"),
        F.lit(at(1, 1)).cast("timestamp_ntz").alias("created_at"),
        F.lit("f").alias("source_file"),
        F.lit(at(1, 2)).cast("timestamp_ntz").alias("loaded_at"),
    )
    return marts.fact_events(rows, at(2))


def test_filters_by_repository_and_by_actor_skip_row_groups(spark, tmp_path, fact):
    path = str(tmp_path / "fact")
    marts.write_fact(fact, path, **SMALL)
    keys = [r[0] for r in spark.range(100, 120).select(surrogate_key("id")).collect()]
    by_repo, groups = share_read(path, "repo_key", keys)
    by_actor, _ = share_read(path, "actor_key", keys)
    assert groups > 60 and by_repo < 0.3 and by_actor < 0.3
    # sorted by repository alone every group would have to be read for an actor
    one = str(tmp_path / "one")
    fact.sort("repo_key").write.options(**SMALL).parquet(one)
    assert share_read(one, "actor_key", keys)[0] > 0.9
    # and the rows are those of the fact
    stored = marts.read_fact(spark, path)
    assert stored.count() == 60_000 and stored.where("repo_id = 7").count() == fact.where("repo_id = 7").count()


def test_filters_by_id_have_bloom_filters_also_after_an_upsert(spark, tmp_path, fact):
    path = str(tmp_path / "fact")
    part = fact.where("repo_id <> 7")
    marts.write_fact(part.limit(20_000), path)
    tables.upsert_table(
        part, path, "event_id", "event_date", FACT_EVENTS, True,
        cluster=layout.fact_order(), options=layout.filter_options(layout.FACT_FILTERS),
    )
    assert marts.read_fact(spark, path).count() == part.count()
    # a value between the bounds that no row has is read from no row group
    scan = marts.read_fact(spark, path).where("event_id = '10000x'")
    assert scan.collect() == []
    metrics = scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numOutputRows").value() == 0


def test_a_sort_compares_stored_columns_only(spark, tmp_path, fact, monkeypatch):
    """Where the curve stays in the sort, it is worked out for both rows of every comparison."""
    frame, orders = type(fact), []

    def sort(self, *cols, f=frame.sortWithinPartitions, **kw):
        out = f(self, *cols, **kw)
        orders.append(out._jdf.queryExecution().optimizedPlan().toString().splitlines()[0])
        return out

    monkeypatch.setattr(frame, "sortWithinPartitions", sort)
    path, part = str(tmp_path / "fact"), fact.where("actor_id < 300")
    marts.write_fact(part.where("repo_id = 7"), path)
    tables.upsert_table(part, path, "event_id", "event_date", FACT_EVENTS, True, cluster=layout.fact_order())
    assert len(orders) == 2
    for order in orders:
        assert order.startswith("Sort [") and "conv(" not in order and "shiftleft(" not in order
    stored = marts.read_fact(spark, path)
    assert stored.exceptAll(part).isEmpty() and part.exceptAll(stored).isEmpty()
    place = layout.curve("repo_key", "actor_key").alias("place")
    for name in glob(f"{path}/**/*.parquet", recursive=True):
        rows = [tuple(r) for r in spark.read.parquet(name).select(place, "event_key").collect()]
        assert rows == sorted(rows)


def test_curve_is_in_order_of_both_keys(spark):
    rows = spark.createDataFrame([("0000a", "0000b"), ("ffffa", "0000b"), ("0000a", "ffffb"), ("ffffa", "ffffb"), (None, None)], "a STRING, b STRING")
    at_curve = [r[0] for r in rows.select(layout.curve("a", "b")).collect()]
    assert at_curve == [0, 0xAAAAAAAA, 0x55555555, 0xFFFFFFFF, 0]


def test_curve_interleaves_the_bits_of_both_keys(spark):
    rows = spark.range(2000).select(surrogate_key("id").alias("a"), surrogate_key(F.col("id") + 7).alias("b"))
    for r in rows.select("a", "b", layout.curve("a", "b").alias("c")).collect():
        x, y = (format(int(k[:4], 16), "016b") for k in (r.a, r.b))
        assert r.c == int("".join(i + j for i, j in zip(x, y)), 2)


def test_raw_and_audit_layouts(spark, tmp_path):
    raw, history = str(tmp_path / "raw"), str(tmp_path / "history")
    audit.bulk_append(fx.raw(spark, SF_DIR).where("file_name < '2024-01-03'").select(*RAW_EVENTS.names), raw)
    loaded = spark.read.schema(RAW_EVENTS).parquet(raw).groupBy("load_ts").count().orderBy("load_ts").limit(5).collect()
    read, groups = share_read(raw, "load_ts", [r.load_ts for r in loaded])
    assert groups > 20 and read <= 3 / groups
    attempts = fx.audit(spark, SF_DIR).select(*LOAD_HISTORY.names)
    for part in range(3):
        tables.append_rows(attempts.where(F.pmod(F.hash("file_name"), F.lit(3)) == part).coalesce(1), history)
    before = sorted(map(tuple, attempts.collect()), key=str)
    assert not audit.compact_audit(spark, history, most_files=3)
    assert audit.compact_audit(spark, history, most_files=2)
    stored = tables.read_table(spark, history, LOAD_HISTORY)
    assert sorted(map(tuple, stored.collect()), key=str) == before
    for name in glob(f"{history}/*.parquet"):
        rows = [(r["file_hour"], r["status"]) for r in pq.read_table(name, columns=["file_hour", "status"]).to_pylist()]
        assert rows == sorted(rows)
    assert not audit.compact_audit(spark, str(tmp_path / "none"), most_files=0)
