"""First / latest record per key, exclusion of already-seen keys, streaming dedup.

First/latest use ``min_by``/``max_by`` aggregates rather than ``row_number()`` windows: an aggregate
is combined map-side before the shuffle, so a key holding a third of all rows still leaves each map
task as one row, while a window would pull every row of that key into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _pick(df: DataFrame, keys, order_cols, fn) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*order_cols)   # a struct is never null: rows without a version still count
    picked = df.groupBy(*keys).agg(fn(F.struct(*rest), order).alias("__r"))
    return picked.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """The row with the smallest ``order_cols`` per key (a total order: add a unique id as last tie-break)."""
    return _pick(df, keys, order_cols, F.min_by)


def latest_per_key(df: DataFrame, keys, version_cols) -> DataFrame:
    """The row with the largest version per key (last write wins)."""
    return _pick(df, keys, version_cols, F.max_by)


def exclude_seen(batch: DataFrame, seen: DataFrame, keys) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen`` (anti-join).

    The seen set grows with the day, so it is not broadcast unconditionally: Spark broadcasts it only
    while its runtime size is under the broadcast threshold and shuffles both sides otherwise.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return batch.join(seen.select(*keys).distinct(), on=keys, how="left_anti")


def first_per_day_stream(stream: DataFrame, key: str, ts: str = "ts", lateness: str = "1 hour", tie=()) -> DataFrame:
    """Streaming (update mode): the earliest row so far per (key, day of ``ts``); ties by ``tie``, then the row.

    The watermark follows ``ts`` itself, so a day's state is dropped ``lateness`` after its end and a
    row up to ``lateness`` late counts, before and after midnight. Raw rows are reduced before the state
    exchange (partial aggregation), so a hot device reaches its state as one row per task. Each
    micro-batch emits the changed keys; a keyed sink where a later batch wins keeps the earliest row.
    """
    rest = [c for c in stream.columns if c != key]
    order = F.struct(F.col(ts), *tie, F.xxhash64(*rest))
    firsts = (stream.withWatermark(ts, lateness)
              .groupBy(F.window(F.col(ts), "1 day").alias("__day"), key)
              .agg(F.min_by(F.struct(*rest), order).alias("__r")))
    return firsts.select(key, *[F.col("__r")[c].alias(c) for c in rest])
