"""Hourly gzip files of newline-delimited JSON.

A gzip file cannot be split, so one task reads one file; with thousands of hourly files that is
the parallelism. Lines are parsed once, into a VARIANT, on the executors.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions import hour_of_file_name
from eventlake.functions import fixed


def source_file_name() -> Column:
    """Hour file name taken from the path, whether the file or its folder carries it."""
    return F.regexp_extract(F.col("_metadata.file_path"), fixed.FILE_NAME_PATTERN, 1)


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines with the name of their hour file."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.text(paths).select("value", source_file_name().alias("file_name"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``raw_data``; NULL where the line is blank or not JSON."""
    return lines.withColumn("raw_data", F.try_parse_json("value"))


def _documents(lines: DataFrame, keep: Callable[[Column], Column]) -> DataFrame:
    """Rows ``raw_data, file_name`` of the lines whose parsed document satisfies ``keep``.

    A plain filter on the parsed column would be pushed below the projection and parse every line
    once per condition. Filtering a one-element array and exploding it parses each line once.
    """
    document = F.filter(F.array(F.try_parse_json("value")), keep)
    return lines.select(F.explode(document).alias("raw_data"), "file_name")


def skip_malformed_lines(lines: DataFrame) -> DataFrame:
    """Parsed rows only: blank and unparsable lines are left out."""
    return _documents(lines, lambda document: document.isNotNull())


def line_counts(lines: DataFrame) -> DataFrame:
    """Per file: lines, blank lines, malformed lines, parsed lines."""
    is_blank = F.trim("value") == ""
    is_good = F.col("raw_data").isNotNull()
    return (
        parse_lines(lines)
        .groupBy("file_name")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.count_if(is_blank).alias("blank_count"),
            F.count_if(~is_blank & ~is_good).alias("malformed_count"),
            F.count_if(is_good).alias("parsed_count"),
        )
    )


def has_field(name: str, document: Column | str = "raw_data") -> Column:
    """Is the key present? A JSON null counts as present."""
    return F.variant_get(document, f"$.{name}", "variant").isNotNull()


def has_required_fields(document: Column | str = "raw_data") -> Column:
    return reduce(Column.__and__, [has_field(name, document) for name in fixed.REQUIRED_FIELDS])


def valid_documents(lines: DataFrame) -> DataFrame:
    """Rows of the lines that are JSON and carry every required key, parsed once."""
    return _documents(lines, has_required_fields)


def valid_events(raw: DataFrame) -> DataFrame:
    """Rows that carry every required key."""
    return raw.where(has_required_fields())


def validity_counts(raw: DataFrame) -> DataFrame:
    """Per file: rows with and without all required keys."""
    return (
        raw.select("file_name", has_required_fields().alias("is_valid"))
        .groupBy("file_name")
        .agg(
            F.count_if("is_valid").alias("valid_count"),
            F.count_if(~F.col("is_valid")).alias("invalid_count"),
        )
    )


def scan_hourly_ndjson(
    spark: SparkSession, paths: str | list[str], load_ts: datetime
) -> DataFrame:
    """Raw rows ``raw_data, load_ts, file_name`` of all parsable, valid lines."""
    rows = valid_documents(read_lines(spark, paths))
    return rows.select(
        "raw_data", F.lit(load_ts).cast("timestamp_ntz").alias("load_ts"), "file_name"
    )


def discover_files(spark: SparkSession, folder: str, min_bytes: int = 0) -> DataFrame:
    """Hour files below ``folder``: ``file_name, file_hour, file_size_bytes, paths``.

    Only the listing is read, never the content. Files under ``min_bytes`` are left out.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.gz")
        .load(folder)
        .select("path", "length", F.regexp_extract("path", fixed.FILE_NAME_PATTERN, 1).alias("file_name"))
    )
    return (
        listing.where(F.col("file_name") != "")
        .groupBy("file_name")
        .agg(
            F.sum("length").alias("file_size_bytes"),
            F.array_sort(F.collect_list("path")).alias("paths"),
        )
        .where(F.col("file_size_bytes") >= min_bytes)
        .select("file_name", hour_of_file_name("file_name").alias("file_hour"), "file_size_bytes", "paths")
    )


def available_files(discovered: DataFrame, expected: DataFrame) -> DataFrame:
    """The discovered files whose hour is expected."""
    return discovered.join(expected.select("file_name"), "file_name", "left_semi")


def write_hour_files(raw_text: DataFrame, folder: str) -> None:
    """Write ``value, file_name`` rows as one gzip text file per hour, for tests and exports."""
    tasks = int(raw_text.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        raw_text.select("value", "file_name")
        .repartition(tasks, "file_name")
        .write.mode("overwrite")
        .option("compression", "gzip")
        .partitionBy("file_name")
        .text(folder)
    )
