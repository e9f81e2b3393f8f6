"""Command-line jobs, SQL views and SQL functions."""

from __future__ import annotations

import pytest
from conftest import event
from pyspark.sql import functions as F

from eventlake import functions as fn
from eventlake.__main__ import arguments, run
from eventlake.plans.pipeline import LakePaths, read
from eventlake.plans.views import register_functions, register_views
from conftest import at


def job(spark, *argv):
    return run(spark, arguments(list(argv)))


def test_jobs_end_to_end(spark, tmp_path, write_hour, capsys):
    lake = str(tmp_path / "lake")
    landing = write_hour("2024-01-01-0.json.gz", [event("1"), event("2")])
    now = ("--lake", lake, "--as-of", "2024-01-01T02:05:00")
    assert job(spark, "latest", "--landing", landing, *now) == 0
    write_hour("2024-01-01-1.json.gz", [event("3", at="2024-01-01T01:30:00Z")])
    assert job(spark, "backfill", "--landing", landing, "--days", "1", *now) == 0
    assert job(spark, "pipeline", "--landing", landing, *now) == 0
    assert job(spark, "monitor", *now) == 0
    assert '"status": "PASS"' in capsys.readouterr().out
    # a day later the data is stale
    assert job(spark, "monitor", "--lake", lake, "--as-of", "2024-01-02T02:05:00") == 1

    assert job(spark, "delete", "--file", "2024-01-01-1.json.gz", *now) == 0
    assert read(spark, LakePaths(lake), "raw_events").count() == 2
    with pytest.raises(SystemExit):
        job(spark, "backfill", *now)

    names = register_views(spark, LakePaths(lake), at(1, 3))
    assert {"fact_events", "stg_actors", "load_history_recent", "unloaded_hours"} <= set(names)
    sql = """SELECT a.actor_login, count(*) AS n FROM fact_events f JOIN dim_actor a ON f.actor_key = a.actor_key
             WHERE a.is_current GROUP BY a.actor_login"""
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("ann", 3)]
    assert spark.sql("SELECT * FROM last_loaded_files").count() == 1


def test_sql_functions_equal_column_helpers(spark):
    register_functions(spark)
    rows = spark.createDataFrame(
        [("1", None, "a-Bot", at(1, 10, 59), at(1, 11, 1)), (None, "User", "x", at(2), at(3))],
        "k STRING, given STRING, login STRING, a TIMESTAMP_NTZ, b TIMESTAMP_NTZ",
    )
    by_sql = rows.selectExpr("surrogate_key(k) AS x1", "classify_actor(given, login) AS x2", "hour_file_name(a) AS x3", "hours_between(a, b) AS x4")
    by_column = rows.select(
        fn.surrogate_key("k").alias("x1"),
        fn.classify_actor("given", "login").alias("x2"),
        fn.hour_file_name("a").alias("x3"),
        fn.boundary_diff("hour", F.col("a"), F.col("b")).alias("x4"),
    )
    assert by_sql.collect() == by_column.collect()
    assert by_column.first().x4 == 1
