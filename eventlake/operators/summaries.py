"""Daily summaries that can be merged for any span of days, so that a report over a year reads no event twice.

Quantiles: a KLL sketch per day, merged over days; the rank of an answer is off by at most RANK_ERROR of the rows (with the
sketch's default size, at 99 %). Counts, sums and extremes beside it are exact.

Leaders: the largest groups of each day with their exact counts, and per day the ``cut``, the largest count that was left out.
A group that is no leader of a day has at most its cut there, which bounds every group's total from below and above. Groups
whose upper bound is below the k-th lower bound cannot be among the first k; only the others are counted in the events. The
answer is exact; if bounds cannot exclude groups that never were a leader, all groups are counted.

Days without date (null times) have no summary. A day's summary is replaced as a whole, so repeating a day changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import round_half_up, trunc_ts

RANK_ERROR = 0.0175
# leaders kept per day; a summary has at most this many rows a day
LEADERS = 1000
# candidates sent to all tasks at most; more are joined by a shuffle if Spark wants one
MOST_SENT = 100_000
DAY = "event_date"


def within(days: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, both included; None leaves an end open."""
    if first:
        days = days.where(F.col(DAY) >= F.lit(first))
    return days.where(F.col(DAY) <= F.lit(last)) if last else days


def with_day(events: DataFrame) -> DataFrame:
    return events.withColumn(DAY, F.to_date("created_at")).where(F.col(DAY).isNotNull())


def minute_rates(events: DataFrame) -> DataFrame:
    """``event_date, minutes, events, least, most, sketch``: events per minute with events, per day."""
    minutes = events.groupBy(trunc_ts("minute", "created_at").alias("created_at")).agg(F.count(F.lit(1)).alias("n"))
    return with_day(minutes).groupBy(DAY).agg(
        F.count(F.lit(1)).alias("minutes"),
        F.sum("n").alias("events"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.kll_sketch_agg_bigint("n").alias("sketch"),
    )


def rate_over(rates: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """What ``event_rate_per_minute`` gives for a span of days, quantiles within RANK_ERROR; one row."""
    merged = within(rates, first, last).agg(
        F.min("least").alias("min_per_minute"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
        F.max("most").alias("max_per_minute"),
        round_half_up(F.sum("events") / F.sum("minutes"), 2).alias("avg_per_minute"),
        F.sum("minutes").alias("minutes"),
    )

    def quantile(p: float):
        # an empty sketch has no quantiles
        return F.when(F.col("minutes") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).cast("double"))

    return merged.select(
        "min_per_minute",
        quantile(0.25).alias("p25_per_minute"),
        quantile(0.5).alias("median_per_minute"),
        quantile(0.75).alias("p75_per_minute"),
        "max_per_minute",
        "avg_per_minute",
    )


def load_durations(audit: DataFrame) -> DataFrame:
    """``event_date, status, attempts, seconds, least, most, sketch`` of timed attempts, per day of loading."""
    timed = audit.where(F.col("load_duration_seconds").isNotNull() & F.col("load_ts").isNotNull())
    return timed.groupBy(F.to_date("load_ts").alias(DAY), "status").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum("load_duration_seconds").alias("seconds"),
        F.min("load_duration_seconds").alias("least"),
        F.max("load_duration_seconds").alias("most"),
        F.kll_sketch_agg_double(F.col("load_duration_seconds").cast("double")).alias("sketch"),
    )


def durations_over(durations: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Per status: attempts, average, shortest and longest duration, median and 95th percentile within RANK_ERROR."""
    merged = within(durations, first, last).groupBy("status").agg(
        F.sum("attempts").alias("attempt_count"),
        round_half_up(F.sum("seconds") / F.sum("attempts"), 2).alias("avg_duration_seconds"),
        F.min("least").cast("double").alias("min_duration_seconds"),
        F.max("most").cast("double").alias("max_duration_seconds"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    for name, p in (("median_duration_seconds", 0.5), ("p95_duration_seconds", 0.95)):
        merged = merged.withColumn(name, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))
    return merged.drop("sketch")


def daily_leaders(events: DataFrame, keys: list[str], most: int = LEADERS) -> DataFrame:
    """``event_date, *keys, n, cut``: the ``most`` largest groups per day and the largest count left out (0 if none).

    Groups are counted with a combine before the shuffle; Spark cuts each day to ``most + 1`` groups inside every task
    before they meet, so a day with very many groups is no large partition.
    """
    counts = with_day(events).groupBy(DAY, *keys).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), *[F.col(c).asc_nulls_last() for c in keys]]
    rank = F.row_number().over(Window.partitionBy(DAY).orderBy(*order))
    first = counts.withColumn("rank", rank).where(F.col("rank") <= most + 1)
    cut = F.coalesce(F.max(F.when(F.col("rank") > most, F.col("n"))).over(Window.partitionBy(DAY)), F.lit(0).cast("bigint"))
    return first.withColumn("cut", cut).where(F.col("rank") <= most).drop("rank")


@dataclass(frozen=True)
class Candidates:
    """``rows`` of keys that may be among the first; ``number`` of them; ``certain`` if no other group may be."""

    rows: DataFrame
    number: int
    certain: bool


def candidates(leaders: DataFrame, keys: list[str], k: int, first: date | None = None, last: date | None = None) -> Candidates:
    """Groups that may be among the ``k`` largest of a span of days. Three numbers reach the driver."""
    span = within(leaders, first, last)
    left_out = span.groupBy(DAY).agg(F.max("cut").alias("cut")).agg(F.coalesce(F.sum("cut"), F.lit(0))).first()[0]
    bounds = span.groupBy(*keys).agg(F.sum("n").alias("lower"), F.sum("cut").alias("known"))
    # a day on which the group is a leader leaves nothing open
    bounds = bounds.withColumn("upper", F.col("lower") + left_out - F.col("known"))
    largest = bounds.orderBy(F.desc("lower")).limit(k).agg(F.min("lower").alias("least"), F.count(F.lit(1)).alias("n")).first()
    least = largest["least"] if largest["n"] == k else 0
    rows = bounds.where(F.col("upper") >= least).select(*keys)
    return Candidates(rows, rows.count(), left_out == 0 or left_out < least)


def narrowed(events: DataFrame, found: Candidates, keys: list[str]) -> DataFrame:
    """Events of the candidates; all events if other groups may win."""
    if not found.certain:
        return events
    rows = found.rows.select(*[F.col(c).alias(f"_{c}") for c in keys])
    if found.number <= MOST_SENT:
        rows = F.broadcast(rows)
    return events.join(rows, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]), "left_semi")
