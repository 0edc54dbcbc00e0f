"""Registered queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where SQL can express it,
the equivalent DuckDB SQL over the shared tables (the correctness oracle).

Every query reads whole shared tables (through the stand-ins of ``sources.standins``); parameters
such as dates and keywords are query arguments, not row caps. Computed columns carry the same alias
on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martpulse import schemas
from martpulse.functions.jsonrec import parse_json
from martpulse.functions.masking import mask_phone
from martpulse.functions.timeparts import with_time_parts
from martpulse.operators.alerts import coupon_alerts
from martpulse.operators.dedup import exclude_seen, latest_per_key
from martpulse.operators.pairs import pair_within
from martpulse.operators.bitmaps import extend_dictionary, period_bitmaps, rolling
from martpulse.operators.route import route_cdc, route_logs, route_logs_typed
from martpulse.operators.search import bm25_top, match_all, top_terms
from martpulse.operators.widen import pair_orders_within, pair_per_batch, sale_rows
from martpulse.plans import dashboard as D
from martpulse.plans import saledetail as S
from martpulse.sources import standins as SI
from martpulse.sources import topics as TP
from martpulse.sources.tables import read_table

# Query parameters (fixed so that both sides compute the same thing).
DAU_DATE = "2024-01-15"
ORDER_DATE = "1996-09-17"
EMPTY_DATE = "1900-01-01"
SALE_DATE, SALE_KEYWORD = "1997-05-20", "red"
ALERT_SIZE, ALERT_SLIDE = 86400, 21600       # the event fixture has ~1 event per 260 s
PAIR_BOUND = 3600
ORDER_TTL = 7 * 86400
BM25_QUERY, BM25_TOP = "the", 20
SALE_TWO_WORDS, BM25_TWO_WORDS = "plate red", "of thing"
STAMP = "1700000000000"                      # fixed server time of the payload queries

# DuckDB stand-ins (FIXTURES.md section 4), used as CTE prefixes of the oracle SQL.
CTES = {
    "startup_log": """SELECT event_id, 'mid_' || user_id AS mid, ts, strftime(ts, '%Y-%m-%d') AS log_date,
  strftime(ts, '%H') AS log_hour FROM events WHERE event_type IN ('view', 'signup')""",
    "action_log": """SELECT event_id, 'mid_' || (user_id % 40) AS mid, 'uid_' || user_id AS uid, ts,
  CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'signup' THEN 'clickItem' WHEN 'click' THEN 'addCart'
    WHEN 'view' THEN 'addFavor' ELSE 'addComment' END AS evid,
  CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS itemid FROM events""",
    "order_info": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  o_orderstatus AS order_status, o_totalprice AS total_amount,
  '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS consignee_tel,
  strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%Y-%m-%d %H:%M:%S') AS create_time
  FROM orders""",
    "order_detail": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
  CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id, p_name AS sku_name,
  CAST(l_extendedprice AS VARCHAR) AS order_price, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time
  FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "user_info": """SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level,
  strftime(DATE '1960-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
  CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender FROM customer WHERE c_custkey % 11 <> 0""",
    "cdc_log": """SELECT c_custkey * 10 + 1 AS seq, 'user_info' AS tbl, 'INSERT' AS op, CAST(c_custkey AS VARCHAR) AS id,
  c_mktsegment AS val FROM customer
  UNION ALL SELECT c_custkey * 10 + 2, 'user_info', 'UPDATE', CAST(c_custkey AS VARCHAR), 'VIP' FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey * 10 + 3, 'user_info', 'DELETE', CAST(c_custkey AS VARCHAR), NULL FROM customer WHERE c_custkey % 10 = 0
  UNION ALL SELECT o_orderkey * 10 + 1, 'order_info', 'INSERT', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey * 10 + 2, 'order_info', 'UPDATE', CAST(o_orderkey AS VARCHAR), 'F' FROM orders WHERE o_orderkey % 4 = 0
  UNION ALL SELECT l_orderkey * 10 + l_linenumber, 'order_detail', 'INSERT',
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey), l_returnflag FROM lineitem
  UNION ALL SELECT p_partkey * 10 + 2, 'sku_info', 'UPDATE', CAST(p_partkey AS VARCHAR), p_brand FROM part""",
    "wide": """SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
  u.gender AS user_gender, coalesce(date_diff('day', CAST(u.birthday AS DATE), DATE '2021-01-01') // 365, 0) AS user_age,
  u.user_level, CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name, split_part(o.create_time, ' ', 1) AS dt
  FROM order_info o JOIN order_detail d ON d.order_id = o.id LEFT JOIN user_info u ON u.id = o.user_id""",
}
CTE_DEPS = {"wide": ("order_info", "order_detail", "user_info")}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _with_ctes(body: str, ctes: tuple[str, ...]) -> str:
    names: list[str] = []
    for c in ctes:
        for dep in CTE_DEPS.get(c, ()) + (c,):
            if dep not in names:
                names.append(dep)
    if not names:
        return body
    prefix = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return f"WITH {prefix},\n{b[4:].lstrip()}"
    return f"WITH {prefix}\n{b}"


def register(name: str, sql: str | None = None, ctes: tuple[str, ...] = ()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _with_ctes(sql, ctes)
        return fn
    return deco


def _wide(spark, sf, *days):
    o, d, u = SI.wide_inputs(spark, sf, days or None)
    return sale_rows(o, d, u, SI.age_as_of())


def _days(*dates):
    return tuple(sorted(dates))


# --- intake and change-log routing --------------------------------------------------------------

@register("log_route", """SELECT CASE WHEN event_type IN ('view', 'signup') THEN 'startup' ELSE 'event' END AS topic,
  CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""")
def q_log_route(spark, sf):
    routed = route_logs(SI.raw_logs(spark, sf))
    return routed.where(F.col("topic").isNotNull()).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


_SHAPE = ("OBJECT<event_id: BIGINT, member: BOOLEAN, props: OBJECT<k: BIGINT>, share: DECIMAL, tags: ARRAY<STRING>, "
          "ts: BIGINT, type: STRING, uid: BIGINT>")
#: Logs whose fields are typed: each field read back with its type, and the types of the whole object.
TYPED_LOGS = f"""SELECT CASE WHEN event_type IN ('view', 'signup') THEN 'startup' ELSE 'event' END AS topic, event_id, user_id AS uid,
  user_id % 2 = 0 AS member, event_id / 4.0 AS share, event_type || ',app' AS tags, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  CAST({STAMP} AS BIGINT) AS ts, '{_SHAPE}' AS shape FROM events"""


def typed_log_fields(routed: DataFrame) -> DataFrame:
    """Fields of routed typed logs; a field of another type than the client sent would be null here."""
    v = F.parse_json("value")
    shape = F.regexp_replace(F.schema_of_variant(v), r"DECIMAL\(\d+,\d+\)", "DECIMAL")
    # a share without decimals is a whole number in the text
    shape = F.regexp_replace(shape, r"share: (BIGINT|DOUBLE)", "share: DECIMAL")
    return routed.select("topic", F.variant_get(v, "$.event_id", "bigint").alias("event_id"), F.variant_get(v, "$.uid", "bigint").alias("uid"),
                         F.variant_get(v, "$.member", "boolean").alias("member"), F.variant_get(v, "$.share", "double").alias("share"),
                         F.array_join(F.variant_get(v, "$.tags", "array<string>"), ",").alias("tags"), F.variant_get(v, "$.props.k", "int").alias("k"),
                         F.variant_get(v, "$.ts", "bigint").alias("ts"), shape.alias("shape"))


@register("log_route_typed", TYPED_LOGS)
def q_log_route_typed(spark, sf):
    return typed_log_fields(route_logs_typed(SI.raw_logs_typed(spark, sf), stamp=F.lit(STAMP)))


@register("json_fields", "SELECT event_id, CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS k FROM events")
def q_json_fields(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "props"])
    good, _bad = parse_json(ev, T.StructType([T.StructField("k", T.StringType())]), "props",
                            keep=("event_id",))
    return good


@register("cdc_route", """SELECT topic, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE
  WHEN tbl = 'order_info' AND op = 'INSERT' THEN 'order_info'
  WHEN tbl = 'user_info' AND op IN ('INSERT', 'UPDATE') THEN 'user_info'
  WHEN tbl = 'order_detail' AND op = 'INSERT' THEN 'order_detail' END AS topic FROM cdc_log)
  WHERE topic IS NOT NULL GROUP BY 1""", ("cdc_log",))
def q_cdc_route(spark, sf):
    return route_cdc(SI.cdc_log(spark, sf)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@register("user_latest", """SELECT id, arg_max(val, seq) AS user_level FROM cdc_log
  WHERE tbl = 'user_info' AND op IN ('INSERT', 'UPDATE') GROUP BY id""", ("cdc_log",))
def q_user_latest(spark, sf):
    routed = route_cdc(SI.cdc_log(spark, sf)).where(F.col("topic") == TP.USER_TOPIC)
    users, _bad = parse_json(routed, schemas.USER, keep=("seq",))
    return latest_per_key(users, "id", "seq").select("id", "user_level")


@register("log_route_payload", f"""SELECT CASE WHEN event_type IN ('view', 'signup') THEN 'startup' ELSE 'event' END AS topic,
  CASE WHEN event_type IN ('view', 'signup') THEN 'startup' ELSE 'event' END AS type, 'mid_' || user_id AS mid, 'uid_' || user_id AS uid,
  event_type AS evid, CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS itemid, '{STAMP}' AS ts FROM events""")
def q_log_route_payload(spark, sf):
    routed = route_logs(SI.raw_logs(spark, sf), stamp=F.lit(STAMP))
    fields = ("type", "mid", "uid", "evid", "itemid", "ts")
    return routed.select("topic", F.json_tuple("value", *fields).alias(*fields))


@register("cdc_payload", """SELECT seq, tbl AS topic, id, CASE WHEN tbl = 'user_info' THEN val END AS user_level,
  CASE WHEN tbl = 'order_info' THEN val END AS order_status, CASE WHEN tbl = 'order_detail' THEN val END AS return_flag,
  CAST(seq AS VARCHAR) AS message_seq FROM cdc_log WHERE (tbl = 'order_info' AND op = 'INSERT')
  OR (tbl = 'user_info' AND op IN ('INSERT', 'UPDATE')) OR (tbl = 'order_detail' AND op = 'INSERT')""", ("cdc_log",))
def q_cdc_payload(spark, sf):
    routed = route_cdc(SI.cdc_log(spark, sf), with_seq=True)
    return routed.select("seq", "topic", F.json_tuple("value", "id", "user_level", "order_status", "return_flag", "seq").alias(
        "id", "user_level", "order_status", "return_flag", "message_seq"))


# --- scalar parsing ------------------------------------------------------------------------------

@register("time_parts", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour FROM events")
def q_time_parts(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    return with_time_parts(ev, "ts").select("event_id", "log_date", "log_hour")


@register("order_time_parts", """SELECT id, split_part(create_time, ' ', 1) AS create_date,
  split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour FROM order_info""", ("order_info",))
def q_order_time_parts(spark, sf):
    return SI.order_info(spark, sf).select("id", "create_date", "create_hour")


@register("mask_prefix", "SELECT id, substr(consignee_tel, 1, 4) || '******' AS tel FROM order_info", ("order_info",))
def q_mask_prefix(spark, sf):
    return SI.order_info(spark, sf).select("id", mask_phone("consignee_tel", "prefix").alias("tel"))


@register("mask_middle", "SELECT id, substr(consignee_tel, 1, 3) || '****' || substr(consignee_tel, 8) AS tel FROM order_info",
          ("order_info",))
def q_mask_middle(spark, sf):
    return SI.order_info(spark, sf).select("id", mask_phone("consignee_tel", "middle").alias("tel"))


# --- daily active devices ------------------------------------------------------------------------

@register("dau_first", """SELECT event_id, mid, log_date, log_hour FROM (SELECT *, row_number() OVER
  (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn FROM startup_log) WHERE rn = 1""", ("startup_log",))
def q_dau_first(spark, sf):
    return D.dau_table(SI.startup_log(spark, sf)).select("event_id", "mid", "log_date", "log_hour")


@register("dau_exclude_seen", f"""SELECT DISTINCT mid FROM startup_log WHERE log_date = '{DAU_DATE}' AND log_hour >= '12'
  AND mid NOT IN (SELECT mid FROM startup_log WHERE log_date = '{DAU_DATE}' AND log_hour < '12')""", ("startup_log",))
def q_dau_exclude_seen(spark, sf):
    s = SI.startup_log(spark, sf, days=_days(DAU_DATE)).where(F.col("log_date") == DAU_DATE)
    batch = s.where(F.col("log_hour") >= "12").select("mid").distinct()
    seen = s.where(F.col("log_hour") < "12")
    return exclude_seen(batch, seen, "mid")


@register("dau_total", "SELECT log_date, CAST(count(DISTINCT mid) AS BIGINT) AS dau FROM startup_log GROUP BY 1",
          ("startup_log",))
def q_dau_total(spark, sf):
    return D.dau_table(SI.startup_log(spark, sf)).groupBy("log_date").agg(F.count(F.lit(1)).alias("dau"))


@register("dau_hour", """WITH f AS (SELECT mid, log_date, arg_min(log_hour, ts) AS log_hour FROM startup_log GROUP BY 1, 2)
  SELECT log_date, log_hour, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY 1, 2""", ("startup_log",))
def q_dau_hour(spark, sf):
    # the hour of the earliest time: a minimum of one number, which a hash aggregate holds
    firsts = SI.startup_log(spark, sf).groupBy("mid", "log_date").agg(F.min("ts").alias("ts"))
    return with_time_parts(firsts, "ts").groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("n"))


@register("dau_hour_vs_yesterday", """WITH f AS (SELECT mid, log_date, arg_min(log_hour, ts) AS log_hour
  FROM startup_log GROUP BY 1, 2)
  SELECT log_hour, CAST(count(*) FILTER (WHERE log_date = '2024-01-15') AS BIGINT) AS today,
  CAST(count(*) FILTER (WHERE log_date = '2024-01-14') AS BIGINT) AS yesterday
  FROM f WHERE log_date IN ('2024-01-14', '2024-01-15') GROUP BY 1""", ("startup_log",))
def q_dau_hour_vs_yesterday(spark, sf):
    dau = D.dau_table(SI.startup_log(spark, sf, days=_days(DAU_DATE, "2024-01-14")))
    return D.realtime_hour("dau", DAU_DATE, dau=dau)


_HOUR_JSON = """SELECT CAST(json_object(
  'today', to_json(coalesce(map_from_entries(list(struct_pack(k := {h}, v := {v}) ORDER BY {h}) FILTER (WHERE {d} = '{today}')), MAP {{}})),
  'yesterday', to_json(coalesce(map_from_entries(list(struct_pack(k := {h}, v := {v}) ORDER BY {h}) FILTER (WHERE {d} = '{yday}')), MAP {{}}))
  ) AS VARCHAR) AS response FROM hours"""


@register("dau_hour_json", """WITH f AS (SELECT mid, log_date, arg_min(log_hour, ts) AS log_hour FROM startup_log GROUP BY 1, 2),
  hours AS (SELECT log_date, log_hour, count(*) AS n FROM f WHERE log_date IN ('2024-01-14', '2024-01-15') GROUP BY 1, 2)
  """ + _HOUR_JSON.format(h="log_hour", v="n", d="log_date", today=DAU_DATE, yday="2024-01-14"), ("startup_log",))
def q_dau_hour_json(spark, sf):
    dau = D.dau_table(SI.startup_log(spark, sf, days=_days(DAU_DATE, "2024-01-14")))
    return D.realtime_hour_json("dau", DAU_DATE, dau=dau)


# --- order amounts -------------------------------------------------------------------------------

@register("order_amount", """SELECT split_part(create_time, ' ', 1) AS create_date,
  round(sum(total_amount), 2) AS total_amount FROM order_info GROUP BY 1""", ("order_info",))
def q_order_amount(spark, sf):
    return (SI.order_info(spark, sf).groupBy("create_date")
            .agg(F.round(F.sum("total_amount"), 2).alias("total_amount")))


@register("order_amount_empty_day", f"SELECT sum(total_amount) AS total_amount FROM order_info WHERE create_time LIKE '{EMPTY_DATE}%'",
          ("order_info",))
def q_order_amount_empty_day(spark, sf):
    return D.order_amount(SI.order_info(spark, sf, days=_days(EMPTY_DATE)), EMPTY_DATE)


@register("order_hour", """SELECT split_part(create_time, ' ', 1) AS create_date, substr(create_time, 12, 2) AS create_hour,
  round(sum(total_amount), 2) AS total_amount FROM order_info GROUP BY 1, 2""", ("order_info",))
def q_order_hour(spark, sf):
    return (SI.order_info(spark, sf).groupBy("create_date", "create_hour")
            .agg(F.round(F.sum("total_amount"), 2).alias("total_amount")))


@register("order_hour_vs_yesterday", f"""SELECT substr(create_time, 12, 2) AS create_hour,
  round(sum(total_amount) FILTER (WHERE create_time LIKE '{ORDER_DATE}%'), 2) AS today,
  round(sum(total_amount) FILTER (WHERE create_time LIKE '1996-09-16%'), 2) AS yesterday
  FROM order_info WHERE create_time LIKE '{ORDER_DATE}%' OR create_time LIKE '1996-09-16%' GROUP BY 1""",
          ("order_info",))
def q_order_hour_vs_yesterday(spark, sf):
    orders = SI.order_info(spark, sf, days=_days(ORDER_DATE, "1996-09-16"))
    return D.realtime_hour("order_amount", ORDER_DATE, orders=orders)


@register("order_hour_json", """WITH hours AS (SELECT substr(create_time, 1, 10) AS d, substr(create_time, 12, 2) AS hr,
  round(sum(total_amount), 2) AS v FROM order_info WHERE create_time LIKE '1996-09-17%' OR create_time LIKE '1996-09-16%'
  GROUP BY 1, 2)
  """ + _HOUR_JSON.format(h="hr", v="v", d="d", today=ORDER_DATE, yday="1996-09-16"), ("order_info",))
def q_order_hour_json(spark, sf):
    orders = SI.order_info(spark, sf, days=_days(ORDER_DATE, "1996-09-16"))
    return D.realtime_hour_json("order_amount", ORDER_DATE, orders=orders)


@register("realtime_total", f"""SELECT 'dau' AS id, CAST(count(DISTINCT mid) AS DOUBLE) AS value FROM startup_log
  WHERE log_date = '{DAU_DATE}'
  UNION ALL SELECT 'order_amount', round(sum(total_amount), 2) FROM order_info WHERE create_time LIKE '{ORDER_DATE}%'""",
          ("startup_log", "order_info"))
def q_realtime_total(spark, sf):
    dau = D.dau_table(SI.startup_log(spark, sf, days=_days(DAU_DATE)))
    orders = SI.order_info(spark, sf, days=_days(ORDER_DATE))
    return D.realtime_total(DAU_DATE, dau, orders, order_date=ORDER_DATE)


@register("realtime_total_json", f"""SELECT '[' || CAST(to_json(struct_pack(id := 'dau', name := '当前日活',
  value := (SELECT count(DISTINCT mid) FROM startup_log WHERE log_date = '{DAU_DATE}'))) AS VARCHAR) || ',' ||
  CAST(to_json(struct_pack(id := 'order_amount', name := '新增交易额',
  value := (SELECT round(sum(total_amount), 2) FROM order_info WHERE create_time LIKE '{ORDER_DATE}%'))) AS VARCHAR) || ']' AS response""",
          ("startup_log", "order_info"))
def q_realtime_total_json(spark, sf):
    dau = D.dau_table(SI.startup_log(spark, sf, days=_days(DAU_DATE)))
    return D.realtime_total_json(DAU_DATE, dau, SI.order_info(spark, sf, days=_days(ORDER_DATE)), order_date=ORDER_DATE)


# --- order x detail x user -----------------------------------------------------------------------

@register("order_detail_full_outer", """WITH ob AS (SELECT substr(create_time, 1, 7) AS batch, id AS order_id FROM order_info),
  db AS (SELECT substr(create_time, 1, 7) AS batch, order_id, id AS detail_id FROM order_detail)
  SELECT coalesce(ob.batch, db.batch) AS batch, ob.order_id, db.detail_id
  FROM ob FULL JOIN db ON ob.batch = db.batch AND ob.order_id = db.order_id""", ("order_info", "order_detail"))
def q_order_detail_full_outer(spark, sf):
    return pair_per_batch(SI.order_info(spark, sf), SI.order_detail_keys(spark, sf), "month")


@register("sale_pairs_ttl", f"""SELECT o.id AS order_id, d.id AS order_detail_id FROM order_info o JOIN order_detail d
  ON d.order_id = o.id AND CAST(d.create_time AS TIMESTAMP) BETWEEN CAST(o.create_time AS TIMESTAMP) - INTERVAL {ORDER_TTL} SECOND
  AND CAST(o.create_time AS TIMESTAMP) + INTERVAL {ORDER_TTL} SECOND""", ("order_info", "order_detail"))
def q_sale_pairs_ttl(spark, sf):
    return pair_orders_within(SI.order_info(spark, sf), SI.order_detail_keys(spark, sf), ORDER_TTL)


@register("sale_wide", """SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender,
  CAST(user_age AS INTEGER) AS user_age, user_level, sku_price, sku_name, dt FROM wide""", ("wide",))
def q_sale_wide(spark, sf):
    return _wide(spark, sf)


# --- coupon alerts and time-bounded pairs ---------------------------------------------------------

@register("coupon_alerts", f"""SELECT mid || '_' || (CAST(epoch(ws + INTERVAL {ALERT_SIZE} SECOND) AS BIGINT) // 60) AS id, mid,
  strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
  array_to_string(list_sort(list(DISTINCT uid) FILTER (WHERE evid = 'coupon')), ',') AS uids,
  array_to_string(list_sort(list(DISTINCT itemid) FILTER (WHERE evid = 'coupon')), ',') AS item_ids,
  string_agg(evid, ',' ORDER BY ts, event_id) AS events
  FROM action_log a, (SELECT unnest(generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-01-31',
    INTERVAL {ALERT_SLIDE} SECOND)) AS ws) w
  WHERE a.ts >= ws AND a.ts < ws + INTERVAL {ALERT_SIZE} SECOND GROUP BY mid, ws
  HAVING count(DISTINCT CASE WHEN evid = 'coupon' THEN uid END) >= 3 AND NOT bool_or(evid = 'clickItem')""",
          ("action_log",))
def q_coupon_alerts(spark, sf):
    a = coupon_alerts(SI.action_log(spark, sf), ALERT_SIZE, ALERT_SLIDE, tie=("event_id",))
    return a.select(
        F.concat_ws("_", "mid", F.floor(F.unix_seconds("window_end") / 60).cast("long").cast("string")).alias("id"),
        "mid", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.array_join("uids", ",").alias("uids"), F.array_join("item_ids", ",").alias("item_ids"),
        F.array_join("events", ",").alias("events"))


@register("pair_within_hour", f"""SELECT a.event_id AS view_id, b.event_id AS purchase_id FROM events a JOIN events b
  ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL {PAIR_BOUND} SECOND AND a.ts + INTERVAL {PAIR_BOUND} SECOND
  WHERE a.event_type = 'view' AND b.event_type = 'purchase'""")
def q_pair_within_hour(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    views = ev.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").cast("timestamp").alias("v_ts"))
    buys = ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").cast("timestamp").alias("p_ts"))
    return pair_within(views, buys, "user_id", PAIR_BOUND, "v_ts", "p_ts").select("view_id", "purchase_id")


# --- sale search ---------------------------------------------------------------------------------

_HIT = f"dt = '{SALE_DATE}' AND list_contains(string_split_regex(lower(sku_name), '[^\\p{{L}}\\p{{N}}]+'), '{SALE_KEYWORD}')"


@register("sale_search_total", f"SELECT CAST(count(*) AS BIGINT) AS total FROM wide WHERE {_HIT}", ("wide",))
def q_sale_search_total(spark, sf):
    return S.sale_detail(_wide(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD, 1, 5)["total"]


@register("sale_search_page", f"""SELECT order_detail_id, sku_name, sku_price FROM wide WHERE {_HIT}
  ORDER BY order_detail_id LIMIT 5 OFFSET 5""", ("wide",))
def q_sale_search_page(spark, sf):
    return S.sale_detail(_wide(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD, 2, 5)["page"].select(
        "order_detail_id", "sku_name", "sku_price")


@register("sale_search_relevance_page", f"""WITH t AS (SELECT order_detail_id, dt, sku_name,
  list_filter(string_split_regex(lower(sku_name), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws FROM wide),
  tf AS (SELECT order_detail_id, dt, sku_name, len(ws) AS dl, len(list_filter(ws, lambda x: x = '{SALE_KEYWORD}')) AS f FROM t),
  s AS (SELECT count(*) AS n, avg(dl) AS avgdl, sum(CASE WHEN f > 0 THEN 1 ELSE 0 END) AS df FROM tf)
  SELECT order_detail_id, sku_name,
  round(ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score
  FROM tf, s WHERE dt = '{SALE_DATE}' AND f > 0 ORDER BY score DESC, order_detail_id LIMIT 5 OFFSET 5""", ("wide",))
def q_sale_search_relevance_page(spark, sf):
    # the statistics need the names of the whole sale table only: its lines that have an order
    o, d, _ = SI.wide_inputs(spark, sf)
    names = d.join(o.select(F.col("id").alias("order_id")), "order_id", "left_semi").select("sku_name")
    return S.relevance_page(_wide(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD, 2, 5, corpus=names).select(
        "order_detail_id", "sku_name", "score")


def _pct_sql(c):
    return f"CASE WHEN total > 0 THEN floor({c} * 1000.0 / total + 0.5) / 10 END"


@register("sale_detail_response", f"""WITH h AS (SELECT * FROM wide WHERE {_HIT}),
  c AS (SELECT count(*) AS total, count(*) FILTER (WHERE user_gender = 'M') AS g_m,
    count(*) FILTER (WHERE user_gender = 'F') AS g_f, count(*) FILTER (WHERE user_age < 20) AS a_0,
    count(*) FILTER (WHERE user_age >= 20 AND user_age < 30) AS a_1, count(*) FILTER (WHERE user_age >= 30) AS a_2 FROM h),
  pg AS (SELECT * FROM h ORDER BY order_detail_id LIMIT 5 OFFSET 5),
  p AS (SELECT list(struct_pack(order_detail_id := order_detail_id, order_id := order_id, order_status := order_status,
    create_time := create_time, user_id := user_id, sku_id := sku_id, user_gender := user_gender,
    user_age := CAST(user_age AS INTEGER), user_level := user_level, sku_price := sku_price, sku_name := sku_name, dt := dt)
    ORDER BY order_detail_id) AS detail FROM pg)
  SELECT CAST(to_json(struct_pack(total := total, stat := [
    struct_pack(title := 'gender', options := [struct_pack(name := 'M', value := {_pct_sql('g_m')}),
                                              struct_pack(name := 'F', value := {_pct_sql('g_f')})]),
    struct_pack(title := 'age', options := [struct_pack(name := '<20', value := {_pct_sql('a_0')}),
                                           struct_pack(name := '20-29', value := {_pct_sql('a_1')}),
                                           struct_pack(name := '30+', value := {_pct_sql('a_2')})])],
    detail := coalesce(detail, []))) AS VARCHAR) AS response FROM c, p""", ("wide",))
def q_sale_detail_response(spark, sf):
    return S.sale_detail_response(_wide(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD, 2, 5)


@register("sale_detail_stats", f"""WITH h AS (SELECT * FROM wide WHERE {_HIT}), t AS (SELECT count(*) AS total FROM h)
  SELECT 'gender' AS stat, user_gender AS name, floor(count(*) * 1000.0 / any_value(t.total) + 0.5) / 10 AS pct
  FROM h, t WHERE user_gender IS NOT NULL GROUP BY user_gender
  UNION ALL SELECT 'age', CASE WHEN user_age < 20 THEN '<20' WHEN user_age < 30 THEN '20-29' ELSE '30+' END,
  floor(count(*) * 1000.0 / any_value(t.total) + 0.5) / 10 FROM h, t GROUP BY 2""", ("wide",))
def q_sale_detail_stats(spark, sf):
    return S.sale_detail_stats(_wide(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD)


# Fixed values of the Han stand-in: each letter of a product name becomes the character at its place.
HAN = "天地人日月山水火木金土手机电小米大中上下东西南北红白"
HAN_KEYWORD = "手电"   # two words, neither next to the other in the names


def han_names(names):
    """Product names in a script without spaces between words."""
    return F.translate(F.lower(names), "abcdefghijklmnopqrstuvwxyz", HAN)


@register("sale_search_han", f"""WITH h AS (SELECT order_detail_id, dt, translate(lower(sku_name), 'abcdefghijklmnopqrstuvwxyz', '{HAN}') AS sku_name FROM wide)
  SELECT order_detail_id, sku_name FROM h WHERE dt = '{SALE_DATE}' AND contains(sku_name, '{HAN_KEYWORD[0]}') AND contains(sku_name, '{HAN_KEYWORD[1]}')""", ("wide",))
def q_sale_search_han(spark, sf):
    wide = _wide(spark, sf, SALE_DATE).withColumn("sku_name", han_names(F.col("sku_name")))
    return S.search_hits(wide, SALE_DATE, HAN_KEYWORD).select("order_detail_id", "sku_name")


@register("sale_facets", f"""WITH h AS (SELECT * FROM wide WHERE {_HIT}), f AS (
  SELECT 'total' AS facet, 'total' AS name, count(*) AS n FROM h
  UNION ALL SELECT 'gender', user_gender, count(*) FROM h WHERE user_gender IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'age', CAST(user_age AS VARCHAR), count(*) FROM h GROUP BY 2
  UNION ALL SELECT 'band', CASE WHEN user_age < 20 THEN '<20' WHEN user_age < 30 THEN '20-29' ELSE '30+' END, count(*) FROM h GROUP BY 2),
  t AS (SELECT count(*) AS total FROM h)
  SELECT facet, name, n, {_pct_sql('n')} AS pct FROM f, t""", ("wide",))
def q_sale_facets(spark, sf):
    return S.sale_facets(_wide(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD)


DAU_SPAN = 7


@register("dau_range_bitmap", f"""WITH s AS (SELECT DISTINCT mid, CAST(log_date AS DATE) AS d FROM startup_log)
  SELECT strftime(e.d, '%Y-%m-%d') AS log_date, count(DISTINCT s.mid) AS n FROM (SELECT DISTINCT d FROM s) e
  JOIN s ON s.d BETWEEN e.d - {DAU_SPAN - 1} AND e.d GROUP BY 1""", ("startup_log",))
def q_dau_range_bitmap(spark, sf):
    logs = SI.startup_log(spark, sf)
    bits = period_bitmaps(logs, "mid", "log_date", extend_dictionary(logs, "mid"))
    return rolling(bits, "log_date", DAU_SPAN)


@register("gender_terms", """SELECT user_gender, CAST(count(*) AS BIGINT) AS n FROM wide WHERE user_gender IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, user_gender LIMIT 2""", ("wide",))
def q_gender_terms(spark, sf):
    return top_terms(_wide(spark, sf), "user_gender", 2)


@register("age_terms", """SELECT CAST(user_age AS INTEGER) AS user_age, CAST(count(*) AS BIGINT) AS n FROM wide
  GROUP BY 1 ORDER BY n DESC, user_age LIMIT 100""", ("wide",))
def q_age_terms(spark, sf):
    return top_terms(_wide(spark, sf), "user_age", 100)


@register("gender_share", """SELECT user_gender, floor(count(*) * 1000.0 / (SELECT count(*) FROM wide) + 0.5) / 10 AS pct
  FROM wide WHERE user_gender IS NOT NULL GROUP BY 1""", ("wide",))
def q_gender_share(spark, sf):
    return S.gender_share(_wide(spark, sf))


@register("age_band_share", """SELECT CASE WHEN user_age < 20 THEN '<20' WHEN user_age < 30 THEN '20-29' ELSE '30+' END AS band,
  floor(count(*) * 1000.0 / (SELECT count(*) FROM wide) + 0.5) / 10 AS pct FROM wide GROUP BY 1""", ("wide",))
def q_age_band_share(spark, sf):
    return S.age_band_share(_wide(spark, sf))


_WORDS = "string_split_regex(lower(sku_name), '[^\\p{L}\\p{N}]+')"


@register("sale_search_two_words", f"""SELECT order_detail_id, sku_name FROM wide
  WHERE list_contains({_WORDS}, '{SALE_TWO_WORDS.split()[0]}') AND list_contains({_WORDS}, '{SALE_TWO_WORDS.split()[1]}')""", ("wide",))
def q_sale_search_two_words(spark, sf):
    return match_all(_wide(spark, sf), "sku_name", SALE_TWO_WORDS).select("order_detail_id", "sku_name")


def _bm25_term(i):
    return (f"CASE WHEN f{i} > 0 THEN ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * f{i} * 2.2 / "
            f"(f{i} + 1.2 * (0.25 + 0.75 * dl / avgdl)) ELSE 0 END")


@register("bm25_two_words", f"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
  lambda x: x <> '') AS ws FROM documents),
  tf AS (SELECT doc_id, len(ws) AS dl, len(list_filter(ws, lambda x: x = '{BM25_TWO_WORDS.split()[0]}')) AS f0,
    len(list_filter(ws, lambda x: x = '{BM25_TWO_WORDS.split()[1]}')) AS f1 FROM t),
  s AS (SELECT count(*) AS n, avg(dl) AS avgdl, sum(CASE WHEN f0 > 0 THEN 1 ELSE 0 END) AS df0,
    sum(CASE WHEN f1 > 0 THEN 1 ELSE 0 END) AS df1 FROM tf)
  SELECT doc_id, round({_bm25_term(0)} + {_bm25_term(1)}, 6) AS score
  FROM tf, s WHERE f0 > 0 OR f1 > 0 ORDER BY score DESC, doc_id LIMIT {BM25_TOP}""")
def q_bm25_two_words(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return bm25_top(docs, "doc_id", "text", BM25_TWO_WORDS, BM25_TOP, 6)


@register("bm25_top", f"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
  lambda x: x <> '') AS ws FROM documents),
  tf AS (SELECT doc_id, len(ws) AS dl, len(list_filter(ws, lambda x: x = '{BM25_QUERY}')) AS f FROM t),
  s AS (SELECT count(*) AS n, avg(dl) AS avgdl, sum(CASE WHEN f > 0 THEN 1 ELSE 0 END) AS df FROM tf)
  SELECT doc_id, round(ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score
  FROM tf, s WHERE f > 0 ORDER BY score DESC, doc_id LIMIT {BM25_TOP}""")
def q_bm25_top(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return bm25_top(docs, "doc_id", "text", BM25_QUERY, BM25_TOP, 6)


__all__ = ["QUERIES", "ORACLES", "CTES", "register"]
