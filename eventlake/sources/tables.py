"""Partitioned Parquet tables: paths, appends by partition, upserts.

Plain Parquet has no MERGE. An upsert therefore writes the touched partitions next to the table, then a plan of which
to put in place and which to drop, and then renames one partition after the other. A lost executor repeats tasks
on intact input. A driver lost before the plan is written leaves the old table; after it, the next read
or write of the table finishes the plan.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators.merge import upsert_by_key
from eventlake.session import fresh_path
from eventlake.sources import layout


# siblings of a table folder while it is being replaced
NEXT, OLD = "__next", "__old"
# and while partitions of it are
MERGED, PLAN = "__merged", "__plan"
_PLAN = "folder STRING"


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop_path(spark, path)
    return fs.exists(jvm_path)


def _recover(spark: SparkSession, path: str) -> None:
    """Undo an :func:`overwrite_table` that stopped between its renames, finish an upsert that stopped within its."""
    if path_exists(spark, f"{path}{PLAN}/_SUCCESS"):
        _finish_plan(spark, path)
    if not path_exists(spark, path) and path_exists(spark, path + OLD):
        rename(spark, path + OLD, path)


def has_data(spark: SparkSession, path: str) -> bool:
    """Does the folder hold a readable Parquet table?"""
    _recover(spark, path)
    if not path_exists(spark, path):
        return False
    jvm_path, fs = _hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
    return any(not n.startswith(("_", ".")) for n in names)


def rename(spark: SparkSession, path: str, target: str) -> None:
    jvm_path, fs = _hadoop_path(spark, path)
    if not fs.rename(jvm_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {path} to {target}")


def drop_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder; True if there was one."""
    jvm_path, fs = _hadoop_path(spark, path)
    return fs.delete(jvm_path, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with the declared schema; an absent table reads as empty."""
    if not has_data(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_by_partition(df: DataFrame, path: str, partition_col: str, options: dict[str, str] | None = None) -> None:
    """Replace exactly the partitions present in ``df``; repeating the call changes nothing."""
    (
        df.write.mode("overwrite")
        .options(**options or {})
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def _finish_plan(spark: SparkSession, path: str) -> None:
    """Put the merged partitions in place of the old ones; a folder that is no longer there was moved before."""
    for row in spark.read.schema(_PLAN).parquet(path + PLAN).collect():
        merged, old = f"{path}{MERGED}/{row.folder}", f"{path}/{row.folder}"
        if path_exists(spark, merged):
            drop_path(spark, old)
            rename(spark, merged, old)
    for row in spark.read.schema("folder STRING, is_empty BOOLEAN").parquet(path + PLAN).where("is_empty").collect():
        drop_path(spark, f"{path}/{row.folder}")
    drop_path(spark, path + PLAN)
    drop_path(spark, path + MERGED)


def existing_partitions(spark: SparkSession, path: str, partition_col: str, values: list) -> list[str]:
    """Folders of the given partition values that exist; one listing of the table, not a call per value."""
    if not path_exists(spark, path):
        return []
    jvm_path, fs = _hadoop_path(spark, path)
    there = {status.getPath().getName() for status in fs.listStatus(jvm_path)}
    return [f"{path}/{name}" for name in (f"{partition_col}={v}" for v in values) if name in there]


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, partition_col: str, values: list
) -> DataFrame:
    """Rows of the given partitions; folders of others are not opened."""
    _recover(spark, path)
    folders = existing_partitions(spark, path, partition_col, values)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def file_count(spark: SparkSession, path: str) -> int:
    """Data files of a table without folders."""
    if not has_data(spark, path):
        return 0
    jvm_path, fs = _hadoop_path(spark, path)
    return sum(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(jvm_path))


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_table(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> None:
    """Replace a whole table with a frame that may be derived from it; ``write`` lays out its files.

    The new table is complete before two renames put it in place of the old one, so a failing job
    never costs the old table.
    """
    spark = df.sparkSession
    if write:
        drop_path(spark, path + NEXT)
        write(df, path + NEXT)
    else:
        df.write.mode("overwrite").parquet(path + NEXT)
    _recover(spark, path)
    if path_exists(spark, path):
        drop_path(spark, path + OLD)
        rename(spark, path, path + OLD)
    rename(spark, path + NEXT, path)
    drop_path(spark, path + OLD)


def upsert_table(
    source: DataFrame,
    path: str,
    key: str,
    partition_col: str,
    schema: T.StructType,
    fixed_partitions: bool = False,
    deletes: DataFrame | None = None,
    cluster: tuple[str | Column, ...] = (),
    options: dict[str, str] | None = None,
) -> int:
    """MERGE ``source`` (unique per ``key``) into a Parquet table; returns partitions rewritten.

    A key that already lives in another partition is found by a semi join over the table's key
    column, so it moves instead of appearing twice. Only the touched partitions are read in full
    and rewritten. The list of touched partition values is the only thing that reaches the driver.

    ``fixed_partitions`` promises that a key never changes its partition. Then the key column of
    the other partitions is not read, which matters once the table is much larger than a batch.
    ``deletes`` has ``key`` and ``partition_col`` of rows to remove. Files are sorted by ``cluster``;
    ``options`` go to the Parquet writer.
    """
    spark = source.sparkSession
    staged_source = fresh_path(spark, "upsert-source")
    source.write.parquet(staged_source)
    source = spark.read.schema(source.schema).parquet(staged_source)
    if not has_data(spark, path):
        append_by_partition(_balanced(source, partition_col, cluster), path, partition_col, options)
        return source.select(partition_col).distinct().count()

    target = read_table(spark, path, schema)
    touched = _values(source.select(partition_col))
    if deletes is not None:
        touched |= _values(deletes.select(partition_col))
    if not fixed_partitions:
        moved = target.select(key, partition_col).join(source.select(key), key, "left_semi")
        touched |= _values(moved.select(partition_col))
    if touched:
        part = target.where(F.col(partition_col).isin(list(touched)))
        if deletes is not None:
            part = part.join(deletes.select(key), key, "left_anti").select(*schema.names)
        merged = upsert_by_key(part, source, key)
        drop_path(spark, path + PLAN)
        _balanced(merged, partition_col, cluster).write.mode("overwrite").options(**options or {}).option(
            "partitionOverwriteMode", "static"
        ).partitionBy(partition_col).parquet(path + MERGED)
        folders = [f"{partition_col}={value}" for value in touched]
        full = {f.rsplit("/", 1)[1] for f in existing_partitions(spark, path + MERGED, partition_col, list(touched))}
        plan = [(f, f not in full) for f in folders]
        spark.createDataFrame(plan, "folder STRING, is_empty BOOLEAN").coalesce(1).write.parquet(path + PLAN)
        _finish_plan(spark, path)
    drop_path(spark, staged_source)
    return len(touched)


def _values(partitions: DataFrame) -> set:
    """Distinct values of a partition column; there are as many as folders."""
    return {row[0] for row in partitions.distinct().collect()}


def _balanced(df: DataFrame, partition_col: str, cluster: tuple[str | Column, ...] = ()) -> DataFrame:
    """Group rows by partition value for writing; AQE splits large groups and joins small ones. Files are sorted."""
    grouped = df.hint("rebalance", partition_col)
    return layout.sort_files(grouped, partition_col, *cluster) if cluster else grouped


def delete_partition(spark: SparkSession, path: str, partition_col: str, value: str) -> bool:
    """Drop one partition folder; True if it existed."""
    try:
        return drop_path(spark, f"{path}/{partition_col}={value}")
    except Py4JJavaError as error:
        raise OSError(f"could not delete {partition_col}={value} below {path}") from error
