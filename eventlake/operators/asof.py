"""Rows joined with the version of an entity that was in force at their time.

Versions of a key follow each other: one holds from its start to the start of the next. A row earlier than the first version
takes the first one, so no row is lost or counted twice. Of versions with one start the one that ends last holds.

No range join: rows and version starts are stacked, sorted by key and time, and the version is carried forward. Rows are
collapsed first. Keys with one version need no time at all. For the others an hour in which no version starts is one point,
whatever it holds, and only hours in which one starts go by the instant. So a key with a third of all rows sends a row per
hour to its sort, and the result is joined back by key and point, which spreads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import fixed, trunc_ts

# up to so many (key, hour) pairs, a few dozen bytes each, are sent to all executors; more are joined by a shuffle
MOST_SENT = 1_000_000


def in_force(points: DataFrame, versions: DataFrame, key: str) -> DataFrame:
    """``key, point, version`` for distinct points in time of ``points`` (``key, point``).

    ``versions`` has ``key, starts, ends, version``; the last is a struct. Points of unknown keys have no version.
    """
    none = F.lit(None)
    kind = versions.schema["version"].dataType
    stacked = versions.select(key, F.col("starts").alias("at"), F.lit(0).alias("is_point"), "ends", "version").unionByName(
        points.select(key, F.col("point").alias("at"), F.lit(1).alias("is_point"), none.cast("timestamp_ntz").alias("ends"),
                      none.cast(kind).alias("version"))
    )
    in_time = Window.partitionBy(key).orderBy("at", "is_point", F.col("ends").asc_nulls_last())
    carried = F.last("version", ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    earliest = F.first("version", ignorenulls=True).over(
        in_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    found = stacked.withColumn("version", F.coalesce(carried, earliest)).where(F.col("is_point") == 1)
    return found.select(key, F.col("at").alias("point"), "version")


def count_in_force(
    rows: DataFrame,
    versions: DataFrame,
    groups: list[str],
    attributes: list[str],
    key: str = "actor_id",
    at: str = "created_at",
    starts: str = "valid_from",
    ends: str = "valid_to",
) -> DataFrame:
    """``groups, key, attributes, n``: rows per group, key and attributes of the version in force.

    Rows without key or of an unknown key have NULL attributes; rows without a time take the first version. The sum of ``n``
    is the number of rows, whatever the versions are.
    """
    all_versions = versions.select(
        key, F.col(starts).alias("starts"), F.col(ends).alias("ends"), F.struct(*attributes).alias("version")
    )
    per_key = all_versions.groupBy(key).agg(F.count(F.lit(1)).alias("versions"), F.any_value("version").alias("version"))
    many = per_key.where(F.col("versions") > 1).select(key)
    changing = all_versions.join(many, key, "left_semi").select(key, "starts", "ends", "version")
    tangled = changing.select(key, trunc_ts("hour", "starts").alias("point")).distinct()
    if tangled.limit(MOST_SENT + 1).count() <= MOST_SENT:
        tangled = F.broadcast(tangled)

    time = F.coalesce(F.col(at), F.lit(fixed.BEGIN_OF_TIME).cast("timestamp_ntz"))
    timed = rows.select(*groups, key, time.alias("_time"), trunc_ts("hour", time).alias("point"))
    hours = timed.groupBy(*groups, key, "point").agg(F.count(F.lit(1)).alias("n"))
    single = hours.join(per_key.where(F.col("versions") == 1), key, "left").join(many, key, "left_anti")
    names = [F.col(f"version.{a}").alias(a) for a in attributes]
    single = single.groupBy(*groups, key, "version").agg(F.sum("n").alias("n")).select(*groups, key, *names, "n")

    whole = hours.join(many, key, "left_semi").join(tangled, [key, "point"], "left_anti")
    cut = timed.join(tangled, [key, "point"], "left_semi").groupBy(*groups, key, F.col("_time").alias("point"))
    moving = whole.select(*groups, key, "point", "n").unionByName(cut.agg(F.count(F.lit(1)).alias("n")))
    found = in_force(moving.select(key, "point").distinct(), changing, key)
    moving = moving.join(found, [key, "point"]).select(*groups, key, *names, "n")
    return single.unionByName(moving)
