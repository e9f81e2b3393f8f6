"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR, at
from pyspark.sql import functions as F

import __spark_entry__ as driver
from eventlake.operators import analytics, quality
from eventlake.plans import marts, staging
from eventlake.sources import tables
from eventlake_checks import fixtures as fx

def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("activity_trend", {"ts"}),
        ("event_rate_per_minute", {"ts"}),
        ("loads_by_hour", {"ts"}),
        ("stg_actors", {"ts", "user_id"}),
        ("stg_repositories", {"ts", "props"}),
        ("hourly_pattern", {"ts", "user_id", "props"}),
    ],
)
def test_scans_read_only_needed_columns(spark, name, columns):
    read = scans(plan(driver.queries()[name](spark, SF_DIR)))
    assert read and all({c.split(":")[0] for c in schema.split(",")} <= columns for schema in read)


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "staged")
    fx.staged(spark, SF_DIR).write.parquet(path)
    events = spark.read.parquet(path)
    text = plan(analytics.latest_events(events, at(31), 7, "PushEvent"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThanOrEqual(created_at" in pushed and "EqualTo(event_type,PushEvent)" in pushed
    assert "TakeOrderedAndProject" in text
    text = plan(quality.event_trend(events, at(31)))
    assert "GreaterThanOrEqual(created_at" in text


def test_fact_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "fact")
    marts.write_fact(marts.fact_events(fx.staged(spark, SF_DIR), at(31)), path)
    one_day = marts.read_fact(spark, path).where(F.col("event_date") == F.lit("2024-01-05").cast("date"))
    text = plan(one_day.groupBy("event_hour").count())
    assert "event_date" in re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert scans(text) == ["event_hour:bigint"]


def test_partitioned_writes_are_rebalanced(spark):
    """AQE may split the rows of one large partition over several writing tasks."""
    fact = marts.fact_events(fx.staged(spark, SF_DIR), at(31))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(tables._balanced(fact, "event_date"))


def test_documents_are_read_by_path(spark, tmp_path):
    """Stored documents are shredded: staging reads the typed paths, not whole documents."""
    path = str(tmp_path / "raw")
    fx.raw(spark, SF_DIR).write.parquet(path)
    text = plan(staging.stg_events(spark.read.parquet(path)).select("event_id", "actor_id"))
    assert "parseJson" not in text
    assert re.search(r"ReadSchema: struct<raw_data:struct<0:string,1:bigint", text)


def test_distinct_counts_are_aggregated_before_the_group(spark):
    """A dominant type is spread by (type, actor) and (type, repository) first."""
    text = plan(analytics.event_type_distribution(fx.staged(spark, SF_DIR)))
    assert re.search(r"hashpartitioning\(event_type#\d+, (\w+#\d+L, ){2}gid#\d+", text)


def test_windows_over_all_rows_only_see_aggregates(spark):
    """A window without partitioning sits above an aggregate, never above a scan."""
    for name in ("event_type_distribution", "hourly_anomaly", "daily_volume_anomaly", "load_success_rate"):
        text = plan(driver.queries()[name](spark, SF_DIR))
        below = text[text.index("Exchange SinglePartition"):].splitlines()[1:]
        assert "HashAggregate" in below[0] or "Project" in below[0] and "HashAggregate" in below[1]
