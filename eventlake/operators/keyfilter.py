"""Which partitions of a table may hold a key: Bloom filters per partition, and exact answers from them.

A filter is a set of rows: a key's hash picks one block of its partition and one bit in each of the block's eight
64-bit words. So a filter is built by one grouping that combines before the shuffle, and tested by a join with eight
bit tests. It takes about 2.5 bytes per key and lets one in some thousand absent keys pass. Whatever passes is looked up in the
partitions it passed for, so answers are exact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.sources import tables

WORDS = 8
# 512 bits a block
KEYS_PER_BLOCK = 25


def filter_schema(partition_col: str, partition_type: T.DataType) -> T.StructType:
    words = [T.StructField(f"w{i}", T.LongType()) for i in range(WORDS)]
    numbers = [T.StructField("blocks", T.LongType()), T.StructField("block", T.LongType())]
    return T.StructType([*numbers, *words, T.StructField(partition_col, partition_type)])


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _bit(key: str, word: int) -> Column:
    """The bit of a key in a word; bytes of one further hash, as the first one chose the block."""
    chosen = F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 8 * word).bitwiseAND(F.lit(63).cast("bigint"))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), chosen.cast("int"))


def key_filters(rows: DataFrame, key: str, partition_col: str, keys_per_block: int = KEYS_PER_BLOCK) -> DataFrame:
    """Filters of all partitions of ``rows``: a power of two of blocks each, by their number of rows.

    Rows without a key or a partition value are in no filter.
    """
    rows = rows.select(key, partition_col).where(F.col(key).isNotNull() & F.col(partition_col).isNotNull())
    needed = F.ceil(F.log2(F.greatest(F.count(F.lit(1)) / keys_per_block, F.lit(1.0))))
    sizes = rows.groupBy(partition_col).agg(F.pow(F.lit(2.0), needed).cast("bigint").alias("blocks"))
    words = [F.bit_or(_bit(key, i)).alias(f"w{i}") for i in range(WORDS)]
    placed = rows.join(sizes, partition_col).withColumn("block", _block(key, F.col("blocks")))
    filters = placed.groupBy(partition_col, "blocks", "block").agg(*words)
    return filters.select("blocks", "block", *[f"w{i}" for i in range(WORDS)], partition_col)


def store_filters(table: DataFrame, key: str, partition_col: str, path: str, values: Iterable | None = None) -> None:
    """Write the filters of a table, or replace those of the partitions in ``values`` after a batch touched them."""
    if values is not None:
        table = table.where(F.col(partition_col).isin(list(values)))
    filters = key_filters(table, key, partition_col).hint("rebalance", partition_col)
    tables.append_by_partition(filters, path, partition_col)


def may_hold(keys: DataFrame, filters: DataFrame, key: str, partition_col: str) -> DataFrame:
    """Pairs of a key and a partition that may hold it; no pair that does is missing.

    A key is sent to one block per size of filter, of which there are as many as powers of two, and meets that block of
    every partition of this size. The bits are tested within the join.
    """
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    probes = wanted.withColumn("blocks", F.explode(F.lit(sizes).cast("array<bigint>")))
    probes = probes.withColumn("block", _block(key, F.col("blocks"))).withColumns({f"b{i}": _bit(key, i) for i in range(WORDS)})
    p, f = probes.alias("p"), filters.alias("f")
    on = (F.col("p.blocks") == F.col("f.blocks")) & (F.col("p.block") == F.col("f.block"))
    for i in range(WORDS):
        on &= F.col(f"f.w{i}").bitwiseAND(F.col(f"p.b{i}")) != 0
    return p.join(f, on).select(F.col(f"p.{key}").alias(key), F.col(f"f.{partition_col}").alias(partition_col))


def stored_rows(
    spark: SparkSession, keys: DataFrame, path: str, schema: T.StructType, filters_path: str, key: str, partition_col: str
) -> DataFrame:
    """Key and partition of every stored row that has one of the keys, one row each; exact.

    Reads the filters and, of partitions for which a key passed, the key column. The values of these partitions reach the driver.
    """
    filters = tables.read_table(spark, filters_path, filter_schema(partition_col, schema[partition_col].dataType))
    passed = may_hold(keys, filters, key, partition_col)
    values = [r[0] for r in passed.select(partition_col).distinct().collect()]
    stored = tables.read_partitions(spark, path, schema, partition_col, values).select(key, partition_col)
    return stored.join(passed, [key, partition_col], "left_semi")


def new_duplicates(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """``key, row_count`` of keys of a batch that occur more than once, in the batch or with the stored rows.

    ``stored`` is what :func:`stored_rows` gives for the batch before it was written. What a check of the whole table would
    report for these keys, at the cost of the batch. Rows without a key are not counted.
    """
    rows = batch.select(key).where(F.col(key).isNotNull()).unionByName(stored.select(key))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
