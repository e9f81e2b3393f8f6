"""Bloom filters per partition: nothing is missed, what passes wrongly is found out, other partitions stay shut."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date
from glob import glob

import pytest
from pyspark.sql import types as T

from eventlake.operators import keyfilter
from eventlake.sources import tables

TABLE = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("event_date", T.DateType())])


def rows_of(seed):
    """A skewed table: a third of all rows on one date, some ids on several dates."""
    rng = random.Random(seed)
    days = [date(2024, 1, d) for d in range(1, 9)]
    return [(str(rng.randrange(3000)), i, days[0] if i % 3 == 0 else rng.choice(days)) for i in range(2500)]


@pytest.fixture
def table(spark, tmp_path):
    path, filters = str(tmp_path / "table"), str(tmp_path / "filters")
    rows = rows_of(1)
    tables.append_by_partition(spark.createDataFrame(rows, TABLE), path, "event_date")
    return rows, path, filters


def found(spark, batch, path, filters):
    keys = spark.createDataFrame([(k, 0, None) for k in batch], TABLE)
    stored = keyfilter.stored_rows(spark, keys, path, TABLE, filters, "event_id", "event_date")
    pairs = sorted(tuple(r) for r in stored.select("event_id", "event_date").collect())
    return pairs, dict(map(tuple, keyfilter.new_duplicates(keys, stored, "event_id").collect()))


# 10**6 keys in a block set all its bits, so that every key passes everywhere
@pytest.mark.parametrize("per_block", [1, 25, 10**6])
def test_answers_are_exact_whatever_passes(spark, table, per_block):
    rows, path, filters = table
    stored = tables.read_table(spark, path, TABLE)
    built = keyfilter.key_filters(stored, "event_id", "event_date", per_block)
    tables.append_by_partition(built, filters, "event_date")
    batch = [str(k) for k in range(2000, 4000, 7)] + ["2007", "3997", "x", "x", None, ""]
    pairs, twice = found(spark, batch, path, filters)
    wanted = {k for k in batch if k}
    assert pairs == sorted((k, d) for k, _, d in rows if k in wanted)
    counts = Counter(k for k in batch if k is not None) + Counter(k for k, _ in pairs)
    assert twice == {k: n for k, n in counts.items() if n > 1}


def test_few_absent_keys_pass(spark, table):
    rows, path, _ = table
    filters = keyfilter.key_filters(tables.read_table(spark, path, TABLE), "event_id", "event_date")
    keys = spark.createDataFrame([(f"absent-{i}",) for i in range(20_000)], "event_id STRING")
    assert keyfilter.may_hold(keys, filters, "event_id", "event_date").count() < 20_000 * 8 * 0.002
    held = spark.createDataFrame([(k,) for k, _, _ in rows], "event_id STRING")
    passed = {tuple(r) for r in keyfilter.may_hold(held, filters, "event_id", "event_date").collect()}
    assert {(k, d) for k, _, d in rows} <= passed


def test_partitions_that_cannot_hold_a_key_are_not_opened(spark, table):
    rows, path, filters = table
    keyfilter.store_filters(tables.read_table(spark, path, TABLE), "event_id", "event_date", filters)
    key, day = next((k, d) for k, _, d in rows if d == date(2024, 1, 5))
    holds = {d for k, _, d in rows if k == key}
    keys = spark.createDataFrame([(key,)], "event_id STRING")
    stored = tables.read_table(spark, filters, keyfilter.filter_schema("event_date", T.DateType()))
    passed = {r[1] for r in keyfilter.may_hold(keys, stored, "event_id", "event_date").collect()}
    assert holds <= passed and len(passed) < 8
    for d in {d for _, _, d in rows} - passed:
        for part in glob(f"{path}/event_date={d}/*.parquet"):
            with open(part, "wb") as handle:
                handle.write(b"no parquet")
    pairs, _ = found(spark, [key], path, filters)
    assert pairs == sorted((k, d) for k, _, d in rows if k == key)


def test_filters_follow_a_batch(spark, table):
    rows, path, filters = table
    keyfilter.store_filters(tables.read_table(spark, path, TABLE), "event_id", "event_date", filters)
    assert found(spark, ["new"], path, filters) == ([], {})
    day = date(2024, 1, 9)
    tables.append_by_partition(spark.createDataFrame([("new", 1, day), (None, 2, day)], TABLE), path, "event_date")
    keyfilter.store_filters(tables.read_table(spark, path, TABLE), "event_id", "event_date", filters, [day])
    assert found(spark, ["new"], path, filters) == ([("new", day)], {"new": 2})
    old = rows[0][0]
    assert found(spark, [old], path, filters)[0] == sorted((k, d) for k, _, d in rows if k == old)


def test_nothing_stored_and_no_keys(spark, tmp_path, table):
    _, path, filters = table
    assert found(spark, ["a", "a", "b"], path, filters) == ([], {"a": 2})
    keyfilter.store_filters(tables.read_table(spark, path, TABLE), "event_id", "event_date", filters)
    assert found(spark, [], path, filters) == ([], {})
