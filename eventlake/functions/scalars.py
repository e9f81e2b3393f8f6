"""Column helpers. All are built-in expressions, so plans stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.functions import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """Deterministic md5 key over one or more columns; NULL hashes to a fixed placeholder."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(fixed.NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def trunc_ts(unit: str, ts: Column | str) -> Column:
    """``date_trunc`` that stays a wall-clock timestamp."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def boundary_diff(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of unit boundaries crossed between two times (10:59 to 11:01 is one hour)."""
    start, end = _col(start), _col(end)
    if unit == "day":
        return F.datediff(end, start).cast("bigint")
    return F.timestamp_diff(unit.upper(), trunc_ts(unit, start), trunc_ts(unit, end))


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round decimally (ties away from zero) and return a double."""
    return F.round(_col(value).cast("decimal(38,10)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero."""
    part, whole = part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")
    return F.round(F.try_divide(part * 100, whole), digits).cast("double")


def hour_file_name(hour: Column | str) -> Column:
    """Name of the file that holds the events of one hour."""
    return F.concat(F.date_format(_col(hour), fixed.HOUR_FORMAT), F.lit(fixed.FILE_SUFFIX))


def hour_of_file_name(name: Column | str) -> Column:
    """Inverse of :func:`hour_file_name`; NULL when the name has another form."""
    stem = F.regexp_extract(_col(name), r"^(\d{4}-\d{2}-\d{2}-\d{1,2})\.json\.gz$", 1)
    return F.try_to_timestamp(F.nullif(stem, F.lit("")), F.lit(fixed.HOUR_FORMAT)).cast(
        "timestamp_ntz"
    )


def strip_nul(text: Column | str) -> Column:
    """Remove NUL characters."""
    return F.replace(_col(text), F.lit("\x00"), F.lit(""))


def classify_actor(actor_type: Column | str, login: Column | str) -> Column:
    """The given type if there is one, else Bot or User by login."""
    guess = F.when(_col(login).ilike(fixed.BOT_PATTERN), "Bot").otherwise("User")
    return F.coalesce(_col(actor_type), guess)


def is_test_repository(name: Column | str) -> Column:
    hits = [_col(name).ilike(p) for p in fixed.TEST_REPO_PATTERNS]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def event_description(event_type: Column | str) -> Column:
    pairs = [F.lit(x) for kv in fixed.EVENT_DESCRIPTIONS.items() for x in kv]
    known = F.try_element_at(F.create_map(*pairs), _col(event_type))
    return F.coalesce(known, F.lit(fixed.OTHER_DESCRIPTION))


def event_category(event_type: Column | str) -> Column:
    pairs = [
        F.lit(x) for name, types in fixed.EVENT_CATEGORIES.items() for t in types for x in (t, name)
    ]
    known = F.try_element_at(F.create_map(*pairs), _col(event_type))
    return F.coalesce(known, F.lit(fixed.OTHER_CATEGORY))


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """The six calendar attributes of the fact table (ISO week, three-letter day name)."""
    ts = _col(ts)
    return {
        "event_date": F.to_date(ts),
        "event_hour": F.hour(ts).cast("bigint"),
        "event_day_of_week": F.dayname(ts),
        "event_week": F.weekofyear(ts).cast("bigint"),
        "event_month": F.month(ts).cast("bigint"),
        "event_year": F.year(ts).cast("bigint"),
    }
