"""Date/hour parts and date arithmetic as column expressions (all in the session time zone)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

DATE_FMT = "yyyy-MM-dd"
HOUR_FMT = "HH"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(_c(ms))


def now_ms() -> Column:
    """Current time in epoch milliseconds (one value per query)."""
    return F.unix_millis(F.current_timestamp())


def log_date(ts) -> Column:
    return F.date_format(_c(ts), DATE_FMT)


def log_hour(ts) -> Column:
    return F.date_format(_c(ts), HOUR_FMT)


def with_time_parts(df, ts="ts", date_col="log_date", hour_col="log_hour", from_ms=False):
    """Add 'yyyy-MM-dd' date and 'HH' hour strings derived from a timestamp (or epoch-ms) column."""
    t = ms_to_ts(ts) if from_ms else _c(ts)
    return df.withColumn(date_col, log_date(t)).withColumn(hour_col, log_hour(t))


def create_date(create_time) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> 'yyyy-MM-dd' (text before the first space)."""
    return F.try_element_at(F.split(_c(create_time), " "), F.lit(1))


def create_hour(create_time) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> 'HH' (text of the time part before the first colon)."""
    time_part = F.try_element_at(F.split(_c(create_time), " "), F.lit(2))
    return F.try_element_at(F.split(time_part, ":"), F.lit(1))


def with_create_parts(df, create_time="create_time"):
    return (df.withColumn("create_date", create_date(create_time))
              .withColumn("create_hour", create_hour(create_time)))


def age_years(birthday, as_of) -> Column:
    """Whole days between birthday ('yyyy-MM-dd') and ``as_of``, divided by 365, truncated."""
    days = F.datediff(_c(as_of), F.try_to_date(_c(birthday), DATE_FMT))
    # double -> int cast truncates toward zero, like the integer division of the reference
    return (days / F.lit(365)).cast("int")


def previous_day(date: str) -> str | None:
    """The day before a 'yyyy-MM-dd' query parameter; None for a malformed date."""
    try:
        d = _dt.datetime.strptime(date, "%Y-%m-%d").date()
    except (TypeError, ValueError):
        return None
    return (d - _dt.timedelta(days=1)).isoformat()

