"""Upserts into partitioned Parquet and the schema contract."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import types as T

from eventlake.schemas import SchemaDriftError, require_schema, table_contract
from eventlake.sources import tables

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("v", T.LongType()),
        T.StructField("d", T.DateType()),
    ]
)
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def put(spark, path, rows, **options):
    return tables.upsert_table(spark.createDataFrame(rows, SCHEMA), path, "k", "d", SCHEMA, **options)


def content(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path, SCHEMA).collect())


def test_insert_replace_and_repeat(spark, tmp_path):
    path = str(tmp_path / "t")
    assert put(spark, path, [("a", 1, D1), ("b", 1, D1), ("c", 1, D2)]) == 2
    delta = [("b", 2, D1), ("d", 2, D3)]
    for _ in range(2):
        put(spark, path, delta)
        assert content(spark, path) == [("a", 1, D1), ("b", 2, D1), ("c", 1, D2), ("d", 2, D3)]


def test_key_moves_to_another_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, D1), ("b", 1, D2), ("c", 1, D2)])
    # D1 loses its only row and must disappear; D2 loses one of two
    put(spark, path, [("a", 2, D3), ("b", 2, D3)])
    assert content(spark, path) == [("a", 2, D3), ("b", 2, D3), ("c", 1, D2)]


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = tmp_path / "t"
    put(spark, str(path), [("a", 1, D1), ("b", 1, D2)])
    before = sorted(p.name for p in (path / "d=2024-01-01").iterdir())
    assert put(spark, str(path), [("b", 2, D2)], fixed_partitions=True) == 1
    assert sorted(p.name for p in (path / "d=2024-01-01").iterdir()) == before
    assert content(spark, str(path)) == [("a", 1, D1), ("b", 2, D2)]


def test_empty_source_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, D1)])
    assert put(spark, path, []) == 0
    assert content(spark, path) == [("a", 1, D1)]


def test_overwrite_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, D1), ("b", 2, D1)], SCHEMA).write.parquet(path)
    tables.overwrite_table(tables.read_table(spark, path, SCHEMA).where("v > 1"), path)
    assert content(spark, path) == [("b", 2, D1)]


def test_contract(spark):
    good = spark.createDataFrame([("a", 1, D1)], SCHEMA)
    drifted = good.withColumnRenamed("v", "w")
    rows = table_contract({"good": (good, SCHEMA), "drifted": (drifted, SCHEMA), "absent": (None, SCHEMA)})
    status = {r.table_name: (r.row_count, r.status, r.note) for r in rows.collect()}
    assert status["good"] == (1, "PASS", "as declared")
    assert status["drifted"][:2] == (1, "FAIL") and "missing column v" in status["drifted"][2]
    assert status["absent"] == (0, "FAIL", "table does not exist")
    assert require_schema(good.select("d", "v", "k"), SCHEMA).columns == ["k", "v", "d"]
    with pytest.raises(SchemaDriftError):
        require_schema(drifted, SCHEMA)


def test_interrupted_overwrite_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, D1)], SCHEMA).write.parquet(path)
    tables.rename(spark, path, path + tables.OLD)  # as if stopped between the renames
    assert content(spark, path) == [("a", 1, D1)]


def test_failing_overwrite_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, D1)], SCHEMA).write.parquet(path)
    broken = tables.read_table(spark, path, SCHEMA).selectExpr("k", "CAST(raise_error('stop') AS BIGINT) AS v", "d")
    with pytest.raises(Exception, match="stop"):
        tables.overwrite_table(broken, path)
    assert content(spark, path) == [("a", 1, D1)]


def test_failing_upsert_keeps_the_old_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, D1), ("b", 1, D2)])
    broken = spark.createDataFrame([("a", 2, D1)], SCHEMA).selectExpr(
        "k", "IF(v > 1, CAST(raise_error('stop') AS BIGINT), v) AS v", "d"
    )
    with pytest.raises(Exception, match="stop"):
        tables.upsert_table(broken, path, "k", "d", SCHEMA)
    assert content(spark, path) == [("a", 1, D1), ("b", 1, D2)]


def test_interrupted_swap_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, D1), ("b", 1, D2), ("c", 1, D3)])
    moves = []

    def stop(spark, old, new):
        if moves:
            raise OSError("driver lost")
        moves.append(new)
        return rename(spark, old, new)

    rename = tables.rename
    monkeypatch.setattr(tables, "rename", stop)
    with pytest.raises(OSError, match="driver lost"):
        put(spark, path, [("a", 2, D1), ("b", 2, D2), ("c", 2, D1)])
    monkeypatch.setattr(tables, "rename", rename)
    assert content(spark, path) == [("a", 2, D1), ("b", 2, D2), ("c", 2, D1)]
    put(spark, path, [("d", 1, D3)])
    assert len(content(spark, path)) == 4


def test_deletes_and_sorted_files(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(k, 1, D1) for k in "zyxw"] + [("a", 1, D2)], cluster=("k",))
    gone = spark.createDataFrame([("y", 1, D1), ("a", 1, D2)], SCHEMA)
    put(spark, path, [("b", 1, D1)], fixed_partitions=True, deletes=gone, cluster=("k",))
    assert content(spark, path) == [(k, 1, D1) for k in "bwxz"]
    for file in (tmp_path / "t" / "d=2024-01-01").glob("*.parquet"):
        keys = [r.k for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)


def test_partitions_are_read_by_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, D1), ("b", 1, D2)])
    assert sorted(map(tuple, tables.read_partitions(spark, path, SCHEMA, "d", [D2, D3]).collect())) == [("b", 1, D2)]
    assert tables.read_partitions(spark, path, SCHEMA, "d", [D3]).count() == 0
