"""Derive event documents, staged events and the load audit from the driver's ``events`` table.

``FIXTURES.md`` describes the mapping. :func:`staged` is the staged table derived column by
column, so a query's column pruning reaches the Parquet scan; :func:`raw` goes through JSON text.
A test shows that parsing the second gives the first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions import hour_file_name, trunc_ts

AS_OF = datetime(2024, 1, 31, 3, 0, 0)
BASE_CUTOFF = datetime(2024, 1, 20, 0, 0, 0)
EARLY_CUTOFF = datetime(2024, 1, 3, 0, 0, 0)
SCD_CUTOFF = datetime(2024, 1, 10, 0, 0, 0)

# the driver's events table, also the schema a stream over it needs
EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def _event_type() -> Column:
    kind, n = F.col("event_type"), F.col("event_id")
    return (
        F.when(kind == "click", F.when(n % 5 == 0, "CreateEvent").otherwise("PushEvent"))
        .when(kind == "view", F.when(n % 4 == 0, "ForkEvent").otherwise("WatchEvent"))
        .when(kind == "purchase", F.lit("PullRequestEvent"))
        .when(kind == "error", F.when(n % 6 == 0, "IssueCommentEvent").otherwise("IssuesEvent"))
        .when(kind == "signup", F.when(n % 7 == 0, "GollumEvent").otherwise("MemberEvent"))
    )


def _login() -> Column:
    user = F.col("user_id")
    renamed = (user % 9 == 0) & (F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    return F.concat(
        F.lit("user"),
        user.cast("string"),
        F.when(user % 10 == 0, "[bot]").otherwise(""),
        F.when(renamed, "-v2").otherwise(""),
    )


def _repo_name(k: Column) -> Column:
    return F.concat(
        F.lit("org"),
        (k % 10).cast("string"),
        F.lit("/"),
        F.when(k % 7 == 0, "test-").otherwise(""),
        F.lit("repo"),
        k.cast("string"),
    )


def to_staged(events: DataFrame) -> DataFrame:
    """Staged event columns from the driver's columns; a pure projection, batch or stream."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    hour = trunc_ts("hour", "ts")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        _event_type().alias("event_type"),
        F.col("user_id").alias("actor_id"),
        _login().alias("actor_login"),
        F.when(F.col("user_id") % 25 == 0, "User").alias("actor_type"),
        k.alias("repo_id"),
        _repo_name(k).alias("repo_name"),
        F.get(F.array(F.lit("Python"), F.lit("Go"), F.lit("Rust")), (k % 4).cast("int")).alias("language"),
        F.col("ts").alias("created_at"),
        "value",
        hour_file_name(hour).alias("source_file"),
        (hour + F.expr("INTERVAL 65 MINUTES")).alias("loaded_at"),
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_staged(source(spark, sf_dir))


def loaded_before(events: DataFrame, cutoff: datetime) -> DataFrame:
    return events.where(F.col("loaded_at") < F.lit(cutoff).cast("timestamp_ntz"))


def with_late_rows(events: DataFrame) -> DataFrame:
    """Every 97th event arrives three hours late."""
    late = F.col("event_id").cast("bigint") % 97 == 0
    delayed = F.col("loaded_at") + F.expr("INTERVAL 3 HOURS")
    return events.withColumn("loaded_at", F.when(late, delayed).otherwise(F.col("loaded_at")))


def with_duplicates(events: DataFrame) -> DataFrame:
    """Every 50th event is there twice, the second copy loaded an hour later."""
    twice = F.col("event_id").cast("bigint") % 50 == 0
    copies = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        events.withColumn("_copy", F.explode(copies))
        .withColumn("loaded_at", F.expr("loaded_at + make_interval(0, 0, 0, 0, _copy, 0, 0)").cast("timestamp_ntz"))
        .drop("_copy")
    )


def with_missing_entities(events: DataFrame) -> DataFrame:
    """Every 101st event has no repository, every 103rd no actor."""
    n = F.col("event_id").cast("bigint")
    no_repo, no_actor = n % 101 == 0, n % 103 == 0
    columns = {c: F.when(~no_repo, F.col(c)) for c in ("repo_id", "repo_name", "language")}
    columns |= {c: F.when(~no_actor, F.col(c)) for c in ("actor_id", "actor_login", "actor_type")}
    return events.withColumns(columns)


def to_json_lines(events: DataFrame) -> DataFrame:
    """Event documents as JSON text: ``value, file_name, load_ts``. Absent fields are left out."""
    n = F.col("event_id").cast("bigint")
    actor = F.struct(
        F.col("actor_id").alias("id"),
        F.col("actor_login").alias("login"),
        F.col("actor_type").alias("type"),
    )
    repo = F.struct(
        F.col("repo_id").alias("id"),
        F.col("repo_name").alias("name"),
        F.concat(F.lit("https://example.org/"), F.col("repo_name")).alias("url"),
        F.col("language").alias("language"),
    )
    is_pull = F.col("event_type") == "PullRequestEvent"
    is_issue = F.col("event_type").isin("IssuesEvent", "IssueCommentEvent")
    payload = F.struct(
        (n % 5).alias("size"),
        (n % 3).alias("distinct_size"),
        F.concat(F.lit("refs/heads/b"), (F.col("repo_id") % 3).cast("string")).alias("ref"),
        F.col("value").alias("value"),
        F.when(is_pull, F.struct((n * 10).alias("id"))).alias("pull_request"),
        F.when(is_issue, F.struct((n * 10 + 1).alias("id"))).alias("issue"),
        F.when(is_issue, F.lit("opened")).alias("action"),
    )
    document = F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.when(F.col("actor_id").isNotNull(), actor).alias("actor"),
        F.when(F.col("repo_id").isNotNull(), repo).alias("repo"),
        payload.alias("payload"),
        F.lit(True).alias("public"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
    )
    return events.select(
        F.to_json(document).alias("value"),
        F.col("source_file").alias("file_name"),
        F.col("loaded_at").alias("load_ts"),
    )


def with_bad_lines(lines: DataFrame) -> DataFrame:
    """Cut the text of every 107th event in half and blank every 109th."""
    n = F.get_json_object("value", "$.id").cast("bigint")
    half = F.substring(F.col("value"), F.lit(1), (F.length("value") / 2).cast("int"))
    return lines.withColumn(
        "value", F.when(n % 109 == 0, "").when(n % 107 == 0, half).otherwise(F.col("value"))
    )


def to_raw(lines: DataFrame) -> DataFrame:
    """JSON text rows to the raw table; the explode keeps filters from parsing a line again."""
    document = F.explode(F.array(F.try_parse_json("value")))
    return lines.select(document.alias("raw_data"), "load_ts", "file_name")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(to_json_lines(staged(spark, sf_dir)))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load audit: one row per hour of events, with gaps, failures and retries; some failures succeeded later."""
    hours = (
        source(spark, sf_dir)
        .groupBy(trunc_ts("hour", "ts").alias("file_hour"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("h", F.unix_seconds(F.col("file_hour").cast("timestamp")).cast("bigint"))
        .withColumn("h", F.expr("h div 3600"))
        .where(F.col("h") % 53 != 0)
    )
    status = F.when(F.col("h") % 31 == 0, "FAILED").when(F.col("h") % 41 == 0, "RETRY").otherwise("SUCCESS")
    rows = hours.withColumn("status", status)
    failed = F.col("status") == "FAILED"
    rows = rows.withColumn("row_count", F.when(failed, 0).otherwise(F.col("n")).cast("bigint"))
    recovered = rows.where(failed & (F.col("h") % 2 == 0)).withColumns(
        {"status": F.lit("SUCCESS"), "row_count": F.col("n"), "minutes": F.lit(95)}
    )
    rows = rows.withColumn("minutes", F.lit(65)).unionByName(recovered)
    return rows.select(
        hour_file_name("file_hour").alias("file_name"),
        (F.col("file_hour") + F.make_dt_interval(mins="minutes")).alias("load_ts"),
        "file_hour",
        "row_count",
        (F.col("row_count") * 300).alias("file_size_bytes"),
        "status",
        F.when(F.col("status") != "SUCCESS", "timeout").alias("error_message"),
        F.when(F.col("status") == "RETRY", F.col("h") % 3).otherwise(0).cast("bigint").alias("retry_count"),
        F.when(~failed, (F.col("row_count") % 17) + F.lit(0.25)).cast("decimal(10,2)").alias("load_duration_seconds"),
        F.lit("loader").alias("loaded_by"),
    )
