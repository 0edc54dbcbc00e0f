"""Shop tables derived by Spark from the shared tables (FIXTURES.md section 4).

The reference reads app logs and database change logs that are not shipped; these functions build
the same record types from ``events``, ``orders``, ``lineitem``, ``part`` and ``customer`` so every
query's work grows with those tables. Each is lazy; filters and column lists reach the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.functions.jsonrec import to_json_record
from martpulse.functions.timeparts import with_create_parts, with_time_parts
from martpulse.sources.tables import read_table

# Fixed values of the stand-ins (FIXTURES.md section 4).
STARTUP_EVENT_TYPES = ("view", "signup")          # event types that count as an app start
DEVICES = 40                                      # action log: user_id % 40 -> device id
EVID_BY_EVENT_TYPE = {"purchase": "coupon", "signup": "clickItem", "click": "addCart",
                      "view": "addFavor"}         # anything else -> "addComment"
OTHER_EVID = "addComment"
TEL_PREFIX = "138"                                # phone = '138' + custkey left-padded to 8 digits
CREATE_SECONDS_MULT = 7919                        # order time of day = (orderkey * 7919) % 86400 s
BIRTH_BASE, BIRTH_MULT, BIRTH_SPAN = "1960-01-01", 37, 18000  # birthday = base + (custkey*37) % 18000 days
USER_GAP = 11                                     # every 11th customer has no user row (lookup misses)
AGE_AS_OF = _dt.date(2021, 1, 1)                  # fixed "now" for user_age


def _day_range(col: str, days):
    """Predicate keeping whole days [first day, last day + 1) of a TIMESTAMP_NTZ column.

    A plain range on the stored column, so the parquet scan receives it as a pushed filter (the
    stand-in's answer to partition pruning on a date-partitioned table).
    """
    if not days:
        return F.lit(True)
    first = _dt.date.fromisoformat(min(days))
    end = _dt.date.fromisoformat(max(days)) + _dt.timedelta(days=1)
    lo = F.lit(f"{first.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{end.isoformat()} 00:00:00").cast("timestamp_ntz")
    return (F.col(col) >= lo) & (F.col(col) < hi)


def startup_log(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    """Startup records: (event_id, mid, ts TIMESTAMP, log_date, log_hour); ``days`` narrows the scan."""
    return startup_log_from(read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type"]), days)


def startup_log_from(ev: DataFrame, days=None) -> DataFrame:
    """``startup_log`` over any events DataFrame (batch or stream)."""
    df = (ev.where(F.col("event_type").isin(*STARTUP_EVENT_TYPES) & _day_range("ts", days))
            .select("event_id",
                    F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
                    F.col("ts").cast("timestamp").alias("ts")))
    return with_time_parts(df, "ts")


def action_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action (event-topic) records: (event_id, mid, uid, ts, evid, itemid)."""
    return action_log_from(read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type", "props"]))


def action_log_from(ev: DataFrame) -> DataFrame:
    evid = F.lit(OTHER_EVID)
    for et, name in reversed(list(EVID_BY_EVENT_TYPE.items())):
        evid = F.when(F.col("event_type") == et, F.lit(name)).otherwise(evid)
    return ev.select(
        "event_id",
        F.concat(F.lit("mid_"), (F.col("user_id") % DEVICES).cast("string")).alias("mid"),
        F.concat(F.lit("uid_"), F.col("user_id").cast("string")).alias("uid"),
        F.col("ts").cast("timestamp").alias("ts"),
        evid.alias("evid"),
        # a JSON number read into a string field keeps its text
        F.from_json("props", "k STRING")["k"].alias("itemid"))


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App log lines as posted by clients (JSON text, no server ``ts`` yet): (event_id, value)."""
    return raw_logs_from(read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"]))


def raw_logs_from(ev: DataFrame) -> DataFrame:
    typ = F.when(F.col("event_type").isin(*STARTUP_EVENT_TYPES), F.lit("startup")).otherwise(F.lit("event"))
    mid = F.concat(F.lit("mid_"), F.col("user_id").cast("string"))
    uid = F.concat(F.lit("uid_"), F.col("user_id").cast("string"))
    return ev.select("event_id", to_json_record(
        typ.alias("type"), mid.alias("mid"), uid.alias("uid"), F.col("event_type").alias("evid"),
        F.get_json_object("props", "$.k").cast("int").alias("itemid")).alias("value"))


def raw_logs_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App log lines whose fields are numbers, flags, lists and objects (and a client's own ``ts``): (event_id, value)."""
    return raw_logs_typed_from(read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"]))


def raw_logs_typed_from(ev: DataFrame) -> DataFrame:
    typ = F.when(F.col("event_type").isin(*STARTUP_EVENT_TYPES), F.lit("startup")).otherwise(F.lit("event"))
    return ev.select("event_id", to_json_record(
        typ.alias("type"), "event_id", F.col("user_id").alias("uid"), (F.col("user_id") % 2 == 0).alias("member"),
        (F.col("event_id") / F.lit(4.0)).alias("share"), F.array("event_type", F.lit("app")).alias("tags"),
        F.from_json("props", "k INT").alias("props"), F.lit("client").alias("ts")).alias("value"))


def order_info(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    """Order rows: (id, user_id, order_status, total_amount, consignee_tel, create_time, create_date, create_hour).

    The time of day is added to a midnight order date, so ``days`` can narrow the scan on that date.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate"])
    return order_info_from(o, days)


def order_info_from(o: DataFrame, days=None) -> DataFrame:
    o = o.where(_day_range("o_orderdate", days))
    secs = ((F.col("o_orderkey") * CREATE_SECONDS_MULT) % 86400).cast("decimal(18,6)")
    created = F.col("o_orderdate") + F.make_dt_interval(secs=secs)
    df = o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.concat(F.lit(TEL_PREFIX), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("consignee_tel"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    return with_create_parts(df)


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines: (id, order_id, sku_id, sku_name, order_price, create_time).

    ``create_time`` (the detail's arrival) is the ship date; ``id`` joins the four line keys, which
    are unique together.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                "l_extendedprice", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return order_detail_from(li, part)


def order_detail_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, order_id, create_time) of the order lines: no product join."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
                     F.col("l_orderkey").cast("string").alias("order_id"),
                     F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"))


def order_detail_from(li: DataFrame, part: DataFrame) -> DataFrame:
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_extendedprice").cast("string").alias("order_price"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"))


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension: (id, user_level, birthday, gender)."""
    return user_info_from(read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"]))


def user_info_from(c: DataFrame) -> DataFrame:
    birthday = F.date_add(F.lit(BIRTH_BASE).cast("date"),
                          ((F.col("c_custkey") * BIRTH_MULT) % BIRTH_SPAN).cast("int"))
    return (c.where(F.col("c_custkey") % USER_GAP != 0)
             .select(F.col("c_custkey").cast("string").alias("id"),
                     F.col("c_mktsegment").alias("user_level"),
                     F.date_format(birthday, "yyyy-MM-dd").alias("birthday"),
                     F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender")))


def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-log entries: (seq, db, tbl, op, after MAP<STRING,STRING>) with the row after-image.

    Inserts of users/orders/lines, some user and order updates, some user deletes (after = null) and
    updates of an unrouted ``sku_info`` table.
    """
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                "l_returnflag"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])

    def entry(df, seq, tbl, op, id_col, field, val):
        after = (F.create_map(F.lit("id"), id_col, F.lit(field), val) if val is not None
                 else F.lit(None).cast("map<string,string>"))
        return df.select(seq.cast("long").alias("seq"), F.lit("shop").alias("db"), F.lit(tbl).alias("tbl"),
                         F.lit(op).alias("op"), after.alias("after"))

    ck, ok = F.col("c_custkey"), F.col("o_orderkey")
    parts = [
        entry(c, ck * 10 + 1, "user_info", "INSERT", ck.cast("string"), "user_level", F.col("c_mktsegment")),
        entry(c.where(ck % 3 == 0), ck * 10 + 2, "user_info", "UPDATE", ck.cast("string"), "user_level",
              F.lit("VIP")),
        entry(c.where(ck % 10 == 0), ck * 10 + 3, "user_info", "DELETE", ck.cast("string"), "user_level", None),
        entry(o, ok * 10 + 1, "order_info", "INSERT", ok.cast("string"), "order_status", F.col("o_orderstatus")),
        entry(o.where(ok % 4 == 0), ok * 10 + 2, "order_info", "UPDATE", ok.cast("string"), "order_status",
              F.lit("F")),
        entry(li, F.col("l_orderkey") * 10 + F.col("l_linenumber"), "order_detail", "INSERT",
              F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "return_flag",
              F.col("l_returnflag")),
        entry(p, F.col("p_partkey") * 10 + 2, "sku_info", "UPDATE", F.col("p_partkey").cast("string"),
              "brand", F.col("p_brand")),
    ]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def wide_inputs(spark: SparkSession, sf_dir: str, days=None):
    """(orders, details, users) for the wide sale table; ``days`` narrows the order scan."""
    return order_info(spark, sf_dir, days), order_detail(spark, sf_dir), user_info(spark, sf_dir)


def age_as_of():
    return F.lit(AGE_AS_OF.isoformat()).cast("date")


__all__ = ["startup_log", "action_log", "raw_logs", "raw_logs_typed", "order_info", "order_detail", "user_info", "cdc_log",
           "wide_inputs", "age_as_of"]
