"""Coupon-abuse alerts over sliding windows.

A device alerts in a window when at least ``min_uids`` distinct users took a coupon on it and nobody
clicked an item there. The alert carries the distinct coupon users and items and every event id of
the window in time order.

Batch plan (panes): a window of ``size`` sliding by ``slide`` is a union of ``size/slide`` panes of
``gcd(size, slide)``. First only user sets, item sets and the veto flag are gathered per (device, pane)
and merged into windows, which decides what alerts. Then the events of alerting windows alone are
gathered, by joining the rows to those windows' panes. No list is built for a window that doesn't alert.
Streaming plan: the same panes as two chained watermarked window aggregations (append mode): one
state row per (device, pane), then the closed pane summaries slid into the windows. ``attach_events`` takes the events
of alerting windows from a stored table instead of the state. A window is emitted
once the watermark passes its end: on a quiet topic a later record (a heartbeat) moves it on.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

# Fixed values of the alert rule.
TRIGGER_EVID = "coupon"
VETO_EVID = "clickItem"
MIN_UIDS = 3
SIZE_SECONDS, SLIDE_SECONDS = 100, 10


def _floor_to(us, width_us):
    return us - F.pmod(us, F.lit(width_us))


def coupon_alerts(actions: DataFrame, size_seconds: int = SIZE_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                  min_uids: int = MIN_UIDS, trigger_evid: str = TRIGGER_EVID, veto_evid: str = VETO_EVID,
                  ts: str = "ts", tie=()) -> DataFrame:
    """Alerts ``(mid, window_start, window_end, uids, item_ids, events)`` (arrays; sets sorted).

    ``actions`` needs ``mid, uid, itemid, evid`` and a TIMESTAMP ``ts``; events of one time are ordered by the
    columns ``tie``, then by their kind.
    """
    pane_us = math.gcd(int(size_seconds), int(slide_seconds)) * 1_000_000
    size_us, slide_us = int(size_seconds) * 1_000_000, int(slide_seconds) * 1_000_000
    trig = F.col("evid") == F.lit(trigger_evid)
    rows = actions.withColumn("__pane", _floor_to(F.unix_micros(F.col(ts)), pane_us))
    panes = (rows.where(F.col("evid").isin(trigger_evid, veto_evid)).groupBy("mid", "__pane")
             .agg(F.collect_set(F.when(trig, F.col("uid"))).alias("__uids"),
                  F.collect_set(F.when(trig, F.col("itemid"))).alias("__items"),
                  F.bool_or(F.col("evid") == F.lit(veto_evid)).alias("__veto")))
    # windows [s, s + size) with s a multiple of slide that contain the whole pane [p, p + pane)
    p = F.col("__pane")
    lo = p + F.lit(pane_us - size_us)
    first = lo + F.pmod(-lo, F.lit(slide_us))
    last = _floor_to(p, slide_us)
    # where slide > size, panes in a gap lie in no window
    windows = panes.withColumn("__w", F.explode(F.when(first <= last, F.sequence(first, last, F.lit(slide_us)))))
    alerts = (windows.groupBy("mid", "__w")
              .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("__uids")))).alias("uids"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("__items")))).alias("item_ids"),
                   F.bool_or("__veto").alias("__veto"))
              .where((F.size("uids") >= min_uids) & ~F.col("__veto")))
    w = F.col("__w")
    wanted = alerts.select("mid", "__w", F.explode(F.sequence(w, w + F.lit(size_us - pane_us), F.lit(pane_us))).alias("__pane"))
    events = (rows.select("mid", "__pane", F.struct(F.col(ts), *tie, F.col("evid")).alias("__e"))
              .join(wanted, ["mid", "__pane"]).groupBy("mid", "__w").agg(F.array_sort(F.collect_list("__e")).alias("__evs")))
    return alerts.join(events, ["mid", "__w"]).select(
        "mid", F.timestamp_micros(w).alias("window_start"), F.timestamp_micros(w + F.lit(size_us)).alias("window_end"),
        "uids", "item_ids", F.transform("__evs", lambda e: e["evid"]).alias("events"))


def alert_id(mid="mid", at="window_end"):
    """Idempotence id: device + '_' + whole minutes of the alert time (one stored alert per minute)."""
    return F.concat_ws("_", F.col(mid), F.floor(F.unix_seconds(F.col(at)) / 60).cast("long").cast("string"))


def with_alert_id(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("id", alert_id()).withColumn("ts", F.unix_millis(F.col("window_end")))


def coupon_alerts_stream(actions: DataFrame, size_seconds: int = SIZE_SECONDS,
                         slide_seconds: int = SLIDE_SECONDS, min_uids: int = MIN_UIDS,
                         trigger_evid: str = TRIGGER_EVID, veto_evid: str = VETO_EVID,
                         ts: str = "ts", lateness: str = "1 hour", tie=(), with_events: bool = True) -> DataFrame:
    """Streaming pane plan: two chained watermarked window aggregations (append mode).

    Stage 1 keeps one state row per (device, pane); stage 2 places each closed pane (by its
    ``window_time``, which lies in exactly the windows containing the whole pane) into the sliding
    windows and merges the summaries. State holds pane summaries, not size/slide copies of raw rows.
    Where slide > size, each window is the beginning of one slide-long cell; panes in the gaps are left out.
    Without ``with_events`` the state holds sets and veto only; ``attach_events`` adds the events of what alerted.
    """
    pane = math.gcd(int(size_seconds), int(slide_seconds))
    trig = F.col("evid") == F.lit(trigger_evid)
    lists = [F.collect_list(F.struct(F.col(ts), *tie, F.col("evid"))).alias("__evs")] if with_events else []
    panes = (actions.withWatermark(ts, lateness)
             .groupBy(F.window(F.col(ts), f"{pane} seconds").alias("pw"), "mid")
             .agg(F.collect_set(F.when(trig, F.col("uid"))).alias("__uids"),
                  F.collect_set(F.when(trig, F.col("itemid"))).alias("__items"),
                  F.max(F.when(F.col("evid") == F.lit(veto_evid), 1).otherwise(0)).alias("__veto"), *lists))
    gaps = int(slide_seconds) > int(size_seconds)
    if gaps:
        panes = panes.where(F.pmod(F.unix_seconds("pw.start"), F.lit(int(slide_seconds))) < int(size_seconds))
    w = F.window(F.window_time("pw"), f"{int(slide_seconds if gaps else size_seconds)} seconds", f"{int(slide_seconds)} seconds")
    chunks = [F.collect_list(F.struct(F.col("pw.start").alias("p"), F.array_sort("__evs").alias("e"))).alias("__chunks")] if with_events else []
    merged = (panes.groupBy(w.alias("w"), "mid")
              .agg(F.collect_list("__uids").alias("__u"), F.collect_list("__items").alias("__i"), F.max("__veto").alias("__veto"), *chunks))
    uids = F.array_sort(F.array_distinct(F.flatten("__u")))
    events = [F.flatten(F.transform(F.array_sort("__chunks"), lambda c: F.transform(c["e"], lambda e: e["evid"]))).alias("events")
              ] if with_events else []
    return (merged.where((F.size(uids) >= min_uids) & (F.col("__veto") == 0))
                  .select("mid", F.col("w.start").alias("window_start"),
                          F.timestamp_seconds(F.unix_seconds("w.start") + int(size_seconds)).alias("window_end"),
                          uids.alias("uids"), F.array_sort(F.array_distinct(F.flatten("__i"))).alias("item_ids"), *events))


def attach_events(alerts: DataFrame, actions: DataFrame, size_seconds: int = SIZE_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                  ts: str = "ts", tie=()) -> DataFrame:
    """``alerts`` (mid, window_start, ...) plus ``events``: the kinds of all events of the window, in time order.

    Joined by (device, pane), so a busy device's events are only compared with the windows around them. An alert without
    a stored event has an empty list; an alert without device has one too.
    """
    pane_us = math.gcd(int(size_seconds), int(slide_seconds)) * 1_000_000
    start = F.unix_micros("window_start")
    panes = F.sequence(start, start + F.lit(int(size_seconds) * 1_000_000 - pane_us), F.lit(pane_us))
    wanted = alerts.select("mid", "window_start", F.explode(panes).alias("__pane"))
    rows = actions.select("mid", _floor_to(F.unix_micros(F.col(ts)), pane_us).alias("__pane"),
                          F.struct(F.col(ts), *tie, F.col("evid")).alias("__e"))
    events = (rows.join(wanted, ["mid", "__pane"]).groupBy("mid", "window_start")
              .agg(F.transform(F.array_sort(F.collect_list("__e")), lambda e: e["evid"]).alias("events")))
    none = F.array().cast("array<string>")
    return alerts.join(events, ["mid", "window_start"], "left").withColumn("events", F.coalesce("events", none))
