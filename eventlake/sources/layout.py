"""How tables lie on disk, so that scans skip what a filter excludes.

=============  ======================  ==================================================================
table          folders                 inside a folder
=============  ======================  ==================================================================
raw_events     hour file               one load, so the bounds of ``load_ts`` are tight
load_history   none                    sorted by (file_hour, status), joined up when files get many
fact_events    event date              along a curve over (repository, actor), Bloom filters for ids
dim_actor      current or not          sorted by actor
=============  ======================  ==================================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# bits of each column in the curve: 65,536 ranges a side are more than a date has row groups
CURVE_BITS = 16
FACT_FILTERS = ("event_id", "actor_id", "repo_id")


def _spread(key: str) -> Column:
    """The leading 16 bits of a hexadecimal key with a zero bit before each: its binary digits, read in base 4."""
    bits = F.conv(F.substring(key, 1, CURVE_BITS // 4), 16, 2)
    return F.coalesce(F.conv(bits, 4, 10).cast("bigint"), F.lit(0).cast("bigint"))


def curve(first: str, second: str) -> Column:
    """Position on a Z-order curve over two surrogate keys; rows close on it are close in both.

    Surrogate keys are hashes, so their leading hexadecimal digits are spread evenly and need no ranks. A third of
    all rows may share one key: they are then spread by the other. NULL counts as zero.
    """
    return F.shiftleft(_spread(first), 1).bitwiseOR(_spread(second))


def fact_order() -> tuple[str | Column, ...]:
    """Sort order of a date of the fact; the event key splits rows of one repository and actor."""
    return curve("repo_key", "actor_key"), "event_key"


def sort_files(df: DataFrame, *order: str | Column, by_range: bool = False) -> DataFrame:
    """Sort within partitions, dealt by ranges of the same order first if ``by_range``.

    An expression becomes a column for the time of the sort: a sort works out its expressions anew for both rows of every
    comparison, which costs more than all else that is done with a row.
    """
    made = {f"_order_{i}": c for i, c in enumerate(order) if isinstance(c, Column)}
    names = [f"_order_{i}" if isinstance(c, Column) else c for i, c in enumerate(order)]
    rows = df.withColumns(made) if made else df
    if by_range:
        rows = rows.repartitionByRange(*names)
    return rows.sortWithinPartitions(*names).drop(*made)


def filter_options(columns: tuple[str, ...]) -> dict[str, str]:
    """Writer options for Parquet Bloom filters, as large as a row group's values need."""
    options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}
    return options | {f"parquet.bloom.filter.adaptive.enabled#{name}": "true" for name in columns}


def write_audit(audit: DataFrame, path: str) -> None:
    """The audit in few files, sorted as its readers filter it; one row per file and attempt, so a sort of all is small."""
    ordered = audit.repartitionByRange("file_hour", "status").sortWithinPartitions("file_hour", "status")
    ordered.write.mode("overwrite").parquet(path)
