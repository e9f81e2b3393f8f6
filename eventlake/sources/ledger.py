"""Which loads each step of the pipeline has processed.

A load is a file with the time of its load. The ledger has one row per step and load, appended once the step's
table is written, so the work of a step is the successful loads less its rows, whatever order load times come in. A
deleted file gets a row that makes its earlier ones void, so that a later load counts as new even with the same time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.sources import tables

DELETED = "deleted"
LEDGER = T.StructType(
    [
        T.StructField("step", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("load_ts", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
    ]
)


class Load(NamedTuple):
    file_name: str
    load_ts: object
    again: bool  # the step has processed an earlier load of the file


def _append(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    newest = tables.read_table(spark, path, LEDGER).agg(F.max("seq")).first()[0] or 0
    numbered = [(*row, newest + 1) for row in rows]
    tables.append_rows(spark.createDataFrame(numbered, LEDGER).coalesce(1), path)


def record(spark: SparkSession, path: str, step: str, loads: list[Load]) -> None:
    """Note that a step has processed these loads."""
    if loads:
        _append(spark, path, [(step, x.file_name, x.load_ts) for x in loads])


def forget(spark: SparkSession, path: str, file_name: str) -> None:
    """Note that a file was deleted from the raw table."""
    _append(spark, path, [(DELETED, file_name, None)])


def pending(spark: SparkSession, path: str, step: str, loaded: DataFrame) -> list[Load]:
    """Loads of ``loaded`` (``file_name, load_ts``) that a step has not processed: one small row per new file."""
    rows = tables.read_table(spark, path, LEDGER)
    gone = rows.where(F.col("step") == DELETED).groupBy("file_name").agg(F.max("seq").alias("gone"))
    mine = rows.where(F.col("step") == step).join(gone, "file_name", "left")
    valid = mine.where(F.col("gone").isNull() | (F.col("seq") > F.col("gone")))
    todo = loaded.select("file_name", "load_ts").distinct().join(valid.select("file_name", "load_ts"), ["file_name", "load_ts"], "left_anti")
    known = mine.select("file_name", F.lit(True).alias("again")).distinct()
    found = todo.join(known, "file_name", "left").select("file_name", "load_ts", F.coalesce("again", F.lit(False)).alias("again"))
    return [Load(*row) for row in found.orderBy("file_name").collect()]
