"""Routing of app logs and change-log entries to topics (log intake and CDC relay)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martpulse.functions.jsonrec import as_string_map
from martpulse.functions.timeparts import now_ms
from martpulse.sources import topics as T

ROW_OPS = ("INSERT", "UPDATE", "DELETE")   # change entries that carry row data


def route_logs(raw: DataFrame, value: str = "value", stamp: Column | None = None, keep=()) -> DataFrame:
    """Log intake: stamp a server ``ts`` (epoch ms) into each JSON log and pick its topic.

    ``type == 'startup'`` goes to the startup topic, anything else (missing type included) to the
    event topic. Every other field of the log is kept (as text). Malformed text gets ``topic`` null.
    Output: ``(*keep, topic, value)``.
    """
    stamp = now_ms() if stamp is None else stamp
    parsed = raw.select(*keep, as_string_map(value).alias("__m"))
    m = F.col("__m")
    stamped = F.to_json(F.map_concat(F.map_filter(m, lambda k, _v: k != F.lit("ts")),
                                     F.create_map(F.lit("ts"), stamp.cast("string"))))
    topic = (F.when(m.isNull(), F.lit(None).cast("string"))
              .when(m["type"] == F.lit("startup"), F.lit(T.STARTUP_TOPIC))
              .otherwise(F.lit(T.EVENT_TOPIC)))
    return parsed.select(*keep, topic.alias("topic"), F.when(m.isNotNull(), stamped).alias("value"))


def route_logs_typed(raw: DataFrame, value: str = "value", stamp: Column | None = None, keep=()) -> DataFrame:
    """``route_logs`` on typed objects: numbers, flags, arrays and nested objects stay what they are, ``ts`` is a number.

    The log is parsed once into a VARIANT; the top level becomes a map of variants, gets its ``ts`` and is written
    as an object again. Text that is no JSON object (broken, a bare value, a key twice) gets ``topic`` and ``value`` null.
    Output: ``(*keep, topic, value)``.
    """
    stamp = now_ms() if stamp is None else stamp
    fields = F.try_variant_get(F.try_parse_json(F.col(value)), "$", "map<string,variant>")
    parsed = raw.select(*keep, fields.alias("__m"))
    m = F.col("__m")
    own = F.create_map(F.lit("ts"), stamp.cast("long").cast("variant"))
    stamped = F.to_json(F.to_variant_object(F.map_concat(F.map_filter(m, lambda k, _v: k != F.lit("ts")), own)))
    kind = F.try_variant_get(m["type"], "$", "string")
    topic = F.when(m.isNotNull(), F.when(kind == F.lit("startup"), F.lit(T.STARTUP_TOPIC)).otherwise(F.lit(T.EVENT_TOPIC)))
    return parsed.select(*keep, topic.alias("topic"), F.when(m.isNotNull(), stamped).alias("value"))


def cdc_topic(tbl: Column, op: Column) -> Column:
    """(table, op) -> topic: order and line inserts, user inserts and updates; everything else null.

    (Only ``user_info`` updates are routed to the user topic; deletes are not routed.)
    """
    return (F.when((tbl == "order_info") & (op == "INSERT"), F.lit(T.ORDER_TOPIC))
             .when((tbl == "user_info") & op.isin("INSERT", "UPDATE"), F.lit(T.USER_TOPIC))
             .when((tbl == "order_detail") & (op == "INSERT"), F.lit(T.DETAIL_TOPIC)))


def route_cdc(cdc: DataFrame, db_pattern: str | None = None, with_seq: bool = False) -> DataFrame:
    """Change log -> ``(seq, topic, value)`` with the row after-image as a JSON object of strings.

    ``with_seq``: the message also carries the entry's number, so a reader of the topic has a version.
    """
    df = cdc.where(F.col("op").isin(*ROW_OPS))
    if db_pattern:
        df = df.where(F.col("db").rlike(db_pattern))
    return (df.select("seq", cdc_topic(F.col("tbl"), F.col("op")).alias("topic"),
                      F.to_json(F.map_concat(F.col("after"), F.create_map(F.lit("seq"), F.col("seq").cast("string")))
                                if with_seq else F.col("after")).alias("value"))
              .where(F.col("topic").isNotNull()))

