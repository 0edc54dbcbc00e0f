"""Dashboard queries over the DAU and order tables (daily totals, hour-by-hour today vs yesterday).

The date filters are plain equality/IN predicates on the date column, so on a date-partitioned table
they prune folders, and on the stand-ins the caller narrows the raw timestamp range at the scan.
Today and yesterday are computed in one pass with conditional aggregates (one shuffle, not a join
of two aggregates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martpulse.functions.timeparts import previous_day
from martpulse.operators.dedup import first_per_key


def dau_table(startup: DataFrame) -> DataFrame:
    """One row per (device, day): the day's first startup record (earliest ts, then event id)."""
    return first_per_key(startup, ["mid", "log_date"], ["ts", "event_id"])


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """``count(*)`` of the DAU table for a date (one row, ``dau``)."""
    return dau.where(F.col("log_date") == date).agg(F.count(F.lit(1)).alias("dau"))


def order_amount(orders: DataFrame, date: str) -> DataFrame:
    """``sum(total_amount)`` for a date; null when the day has no orders."""
    return orders.where(F.col("create_date") == date).agg(F.sum("total_amount").alias("total_amount"))


def _vs_yesterday(df: DataFrame, date_col: str, hour_col: str, date: str, value=None,
                  round_to: int | None = None) -> DataFrame:
    y = previous_day(date)
    if y is None:
        raise ValueError(f"bad date {date!r}")
    d = F.col(date_col)
    if value is None:   # counts
        today, yday = F.count(F.when(d == date, 1)), F.count(F.when(d == y, 1))
    else:
        today, yday = F.sum(F.when(d == date, value)), F.sum(F.when(d == y, value))
    if round_to is not None:
        today, yday = F.round(today, round_to), F.round(yday, round_to)
    return (df.where(d.isin(date, y))
              .groupBy(hour_col).agg(today.alias("today"), yday.alias("yesterday")))


def realtime_hour(kind: str, date: str, dau: DataFrame | None = None, orders: DataFrame | None = None,
                  round_to: int | None = 2) -> DataFrame:
    """Per hour: the metric for ``date`` and for the day before (``hour, today, yesterday``)."""
    if kind == "dau":
        return _vs_yesterday(dau, "log_date", "log_hour", date)
    if kind == "order_amount":
        return _vs_yesterday(orders, "create_date", "create_hour", date, F.col("total_amount"), round_to)
    raise ValueError(f"unknown metric id {kind!r}")


def realtime_total(date: str, dau: DataFrame, orders: DataFrame, round_to: int | None = 2,
                   order_date: str | None = None) -> DataFrame:
    """Rows ``(id, value)``: ``dau`` = devices active on the date, ``order_amount`` = the day's sum.

    ``order_date`` (default: ``date``) lets the two tables be asked about different days.
    """
    n = dau_total(dau, date).select(F.lit("dau").alias("id"), F.col("dau").cast("double").alias("value"))
    amount = F.col("total_amount")
    if round_to is not None:
        amount = F.round(amount, round_to)
    a = order_amount(orders, order_date or date).select(F.lit("order_amount").alias("id"), amount.alias("value"))
    return n.unionByName(a)


# Display names of the two totals.
TOTAL_NAMES = (("dau", "当前日活"), ("order_amount", "新增交易额"))


def realtime_total_json(date: str, dau: DataFrame, orders: DataFrame, order_date: str | None = None) -> DataFrame:
    """The published response: one row ``[{"id", "name", "value"}, ...]`` with a whole-number device count."""
    n = dau_total(dau, date).select("dau").scalar()
    amount = order_amount(orders, order_date or date).agg(F.round(F.max("total_amount"), 2).alias("v"))
    (dau_id, dau_name), (sum_id, sum_name) = TOTAL_NAMES

    def entry(key, name, value):
        return F.to_json(F.struct(F.lit(key).alias("id"), F.lit(name).alias("name"), value.alias("value")),
                         {"ignoreNullFields": "false"})

    return amount.select(F.concat(F.lit("["), entry(dau_id, dau_name, n), F.lit(","), entry(sum_id, sum_name, F.col("v")),
                                  F.lit("]")).alias("response"))


def realtime_hour_json(kind: str, date: str, dau: DataFrame | None = None, orders: DataFrame | None = None,
                       round_to: int | None = 2) -> DataFrame:
    """The published response shape: one row ``{"today": {hour: v, ...}, "yesterday": {...}}``.

    Hours are sorted; a day without data is an empty object.
    """
    rows = realtime_hour(kind, date, dau, orders, round_to)
    hour = rows.columns[0]

    def day_map(col):
        entries = F.filter(F.array_sort(F.collect_list(F.struct(F.col(hour).alias("k"), F.col(col).alias("v")))),
                           lambda e: e["v"].isNotNull() & (e["v"] != 0) if kind == "dau" else e["v"].isNotNull())
        return F.map_from_entries(entries)

    return rows.agg(F.to_json(F.struct(day_map("today").alias("today"),
                                       day_map("yesterday").alias("yesterday"))).alias("response"))
