"""Mix sources to target weights by pivotal dependent rounding.

Each source has a target number of words, at most twice what it holds. A document should appear
``target / source size`` times, which is a whole number and a fraction. The fractions are rounded in pairs: for two
documents of a source, mass moves from one to the other at the rate of their sizes, so the expected words stay the
same, until one of them is 0 or 1; which way is drawn so that each keeps its expected number. What is
left of a group (one open document at most) goes on to the next level of a reduction tree, until a source has a
single open document, rounded at random. So a source misses its target by less than one document.

Draws come from a hash of the seed and the documents, and groups from a hash of the document, so reruns agree
however the rows are spread.

Defined results: null texts have size 0, and size-0 documents are never taken. A null source is a source of its
own, last in order. Identical rows (id, source, size) are rounded together and differ by one copy at
most. With no words at all every target is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.session import fresh_path

GROUP_ROWS = 4096
CAP = 2.0


def source_targets(sizes: DataFrame, weights: list[int], share: float) -> DataFrame:
    """``source, source_size, target`` per source from rows of ``source, size``.

    Sources in order of code points (null last) take the weights in turn. Targets are ``share`` of all words
    split by weight; one above CAP times its source stays there and the excess goes to the others by
    weight, until none is above. Sources are sorted by how early they reach the cap: the capped ones are
    a prefix of that order. Both orders see one row per source.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place").cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = totals.withColumn("place", (F.row_number().over(by_name) - 1) % len(weights) + 1)
    totals = totals.withColumn("w", weight)
    ratio = F.col("source_size") / F.col("w")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        share * F.sum("source_size").over(everything) - CAP * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("w").over(after)
    # the first source whose cap is not reached sets the level for itself and all after it
    totals = totals.withColumn("level", F.when(F.col("w") * level <= CAP * F.col("source_size"), level))
    totals = totals.withColumn("level", F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.col("level") * F.col("w"), CAP * F.col("source_size"))
    return totals.select("source", "source_size", target.cast("double").alias("target"))


def _draw(*parts: object) -> float:
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little") / 2.0**64


def round_group(rows: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """Weighted pivotal rounding of ``part`` within a group; at most one row stays ``open``.

    Rows are taken by size, so partners have like sizes and little mass must travel. The words
    ``sum(part * size)`` do not change.
    """
    rows = rows.sort_values(["size", "key"], kind="stable")
    part, size, key = rows["part"].tolist(), rows["size"].tolist(), rows["key"].tolist()
    held = -1
    for i in range(len(part)):
        if not 0.0 < part[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        # words that may move from b to a, and from a to b
        to_a = min((1.0 - part[a]) * size[a], part[b] * size[b])
        to_b = min(part[a] * size[a], (1.0 - part[b]) * size[b])
        move = to_a if _draw(seed, level, key[a], key[b]) * (to_a + to_b) < to_b else -to_b
        full_a = move > 0 and to_a == (1.0 - part[a]) * size[a]
        empty_a = move < 0 and to_b == part[a] * size[a]
        empty_b = move > 0 and to_a == part[b] * size[b]
        full_b = move < 0 and to_b == (1.0 - part[b]) * size[b]
        part[a] = 1.0 if full_a else 0.0 if empty_a else part[a] + move / size[a]
        part[b] = 1.0 if full_b else 0.0 if empty_b else part[b] - move / size[b]
        held = next((k for k in (a, b) if 0.0 < part[k] < 1.0), -1)
    rows["part"] = part
    rows["open"] = [0.0 < p < 1.0 for p in part]
    return rows


def _reducer(seed: int, level: int):
    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        return round_group(group, seed, level)

    return reduce


_UNIT = "source string, key string, doc_id long, tag string, size long, n long, source_size long, target double"
_ROUND = f"{_UNIT}, whole long, part double, bucket long, open boolean"


def copies_of(units: DataFrame, seed: int = 0) -> DataFrame:
    """Add ``copies`` to units with ``expected`` copies: whole, unbiased, and on target in sum.

    Level 0 has groups of about GROUP_ROWS units; each later level joins GROUP_ROWS groups of the one
    before until every source has a single group.
    """
    spark = units.sparkSession
    path = fresh_path(spark, "mixing-units")
    whole = F.floor("expected").cast("long")
    units.select("*", whole.alias("whole"), (F.col("expected") - whole).alias("part")).drop("expected").write.parquet(path)
    rows = spark.read.parquet(path)
    buckets = math.ceil(max(1, rows.count()) / GROUP_ROWS)
    pending = rows.where(F.col("part") > 0).withColumns(
        {"bucket": F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(buckets)), "open": F.lit(True)}
    )
    done = rows.where(F.col("part") == 0)
    level = 0
    while True:
        columns = [c.split()[0] for c in _ROUND.split(", ")]
        path = fresh_path(spark, f"mixing-level-{level}")
        pending.select(columns).groupBy("source", "bucket").applyInPandas(_reducer(seed, level), _ROUND).write.parquet(path)
        rounded = spark.read.schema(_ROUND).parquet(path)
        done = done.unionByName(rounded.where(~F.col("open")).select(done.columns))
        pending = rounded.where("open")
        if buckets == 1:
            break
        level, buckets = level + 1, math.ceil(buckets / GROUP_ROWS)
        pending = pending.withColumn("bucket", F.pmod("bucket", F.lit(buckets)))
    draw = F.pmod(F.xxhash64(F.lit("last"), F.lit(seed), "key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    last = pending.withColumn("part", F.when(draw < F.col("part"), 1.0).otherwise(0.0))
    done = done.unionByName(last.select(done.columns))
    return done.withColumn("copies", F.col("whole") + F.round("part").cast("long"))


def plan_mix(sizes: DataFrame, weights: list[int], share: float = 1.5, seed: int = 0) -> DataFrame:
    """``doc_id, source, size, tag, n, copies, source_size, target`` per distinct ``doc_id, source, size, tag``.

    ``n`` rows are alike in these columns and get ``copies`` between them. ``tag`` tells apart rows that
    share an id; it may be null.
    """
    spark = sizes.sparkSession
    path = fresh_path(spark, "mixing-targets")
    source_targets(sizes.select("source", "size"), weights, share).write.parquet(path)
    targets = spark.read.parquet(path).withColumnRenamed("source", "of")
    units = sizes.groupBy("doc_id", "source", "size", "tag").agg(F.count(F.lit(1)).alias("n"))
    units = units.withColumn("key", F.to_json(F.struct("doc_id", "source", "size", "tag")))
    units = units.join(targets, units["source"].eqNullSafe(targets["of"]), "left").drop("of")
    expected = F.when(F.col("size") > 0, F.col("n") * F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = copies_of(units.withColumn("expected", expected.cast("double")), seed)
    return planned.select("doc_id", "source", "size", "tag", "n", "copies", "source_size", "target")


def row_copies(plan: DataFrame) -> DataFrame:
    """One row per row of the input again: ``doc_id, source, size, copies, source_size, target``."""
    each, over = F.floor(F.col("copies") / F.col("n")), F.col("copies") % F.col("n")
    rows = plan.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
    return rows.select(
        "doc_id",
        "source",
        "size",
        (each + (F.col("i") <= over).cast("long")).cast("long").alias("copies"),
        "source_size",
        "target",
    )


def mix_documents(docs: DataFrame, size: Column, weights: list[int], share: float = 1.5, seed: int = 0) -> DataFrame:
    """The documents of the mix: all columns of ``docs``, a row as often as it is taken.

    Rows meet the plan by id, source, size and a digest of the text. Of rows alike in all of these each gets
    the same whole number of copies; copies left over, fewer than there are such rows, are all made from one of them.
    """
    tagged = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size.cast("long").alias("size"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("tag"),
    )
    names = ("doc_id", "source", "size", "tag")
    plan = plan_mix(tagged.select(*names), weights, share, seed).where(F.col("copies") > 0)
    plan = plan.select(*[F.col(c).alias(f"p_{c}") for c in names], "n", "copies")
    meets = [tagged[c].eqNullSafe(plan[f"p_{c}"]) for c in names]
    each = F.floor(F.col("copies") / F.col("n")).cast("int")
    mixed = tagged.join(plan, meets[0] & meets[1] & meets[2] & meets[3]).where(each > 0)
    mixed = mixed.select("row", F.explode(F.array_repeat(F.lit(1), each)))
    left = plan.where((F.col("n") > 1) & (F.col("copies") % F.col("n") > 0))
    if not left.isEmpty():
        one = tagged.join(left, meets[0] & meets[1] & meets[2] & meets[3])
        one = one.groupBy(*names, "n", "copies").agg(F.first("row").alias("row"))
        over = (F.col("copies") % F.col("n")).cast("int")
        mixed = mixed.unionByName(one.select("row", F.explode(F.array_repeat(F.lit(1), over))))
    return mixed.select("row.*")
