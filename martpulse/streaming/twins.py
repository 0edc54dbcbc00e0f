"""Streaming twins: the streaming jobs run with ``availableNow`` over file streams of the shared tables,
registered as queries whose result is read back from the job's output table.

Each run writes under a fresh folder of the shared checkpoint root (``spark.checkpoint.dir``).
Their oracles are the batch SQL plus the watermark rule where one applies (append mode emits a
window only once the watermark has passed its end).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse import schemas
from martpulse.functions.jsonrec import parse_json, to_json_record
from martpulse.operators.alerts import coupon_alerts_stream
from martpulse.operators.pairs import pair_within_stream
from martpulse.operators.route import route_cdc
from martpulse.operators.rollup import read_rollup
from martpulse.operators.textindex import index_batch, search_index
from martpulse.operators.upsert import CONCURRENT_FILES, DROP_SHUFFLES, PASSES, SHORT_JOINS, current, settings, upsert_batch
from martpulse.operators.widen import SALE_COLUMNS, sale_rows
from martpulse.plans import catalog as C
from martpulse.plans import saledetail as S
from martpulse.session import scratch_path
from martpulse.sources import standins as SI
from martpulse.sources import topics as TP
from martpulse.sources.tables import read_table, stream_table
from martpulse.streaming import jobs as J
from martpulse.streaming import metrics as M

ALERT_LATENESS_SECONDS = 3600


def _run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "twins", f"{name}-{uuid.uuid4().hex[:12]}")


def _events(spark, sf, cols):
    return stream_table(spark, sf, "events").select(*cols)


@C.register("stream_log_route", C.ORACLES["log_route"])
def q_stream_log_route(spark: SparkSession, sf: str) -> DataFrame:
    run = _run_dir(spark, "log_route")
    raw = SI.raw_logs_from(_events(spark, sf, ["event_id", "user_id", "event_type", "props"]))
    J.run_to_end(J.log_intake_job(raw, f"{run}/out", f"{run}/ckpt", available_now=True))
    return spark.read.parquet(f"{run}/out").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@C.register("stream_log_route_typed", C.ORACLES["log_route_typed"])
def q_stream_log_route_typed(spark: SparkSession, sf: str) -> DataFrame:
    run = _run_dir(spark, "log_route_typed")
    raw = SI.raw_logs_typed_from(_events(spark, sf, ["event_id", "user_id", "event_type", "props"]))
    J.run_to_end(J.log_intake_job(raw, f"{run}/out", f"{run}/ckpt", available_now=True, stamp=F.lit(C.STAMP), typed=True))
    return C.typed_log_fields(spark.read.parquet(f"{run}/out"))


@C.register("stream_dau_keys", "SELECT DISTINCT mid, log_date FROM startup_log", ("startup_log",))
def q_stream_dau_keys(spark: SparkSession, sf: str) -> DataFrame:
    run = _run_dir(spark, "dau")
    startup = SI.startup_log_from(_events(spark, sf, ["event_id", "user_id", "ts", "event_type"]))
    J.run_to_end(J.dau_job(startup, f"{run}/dau", f"{run}/ckpt", available_now=True, tie=("event_id",)))
    return current(spark, f"{run}/dau", ["mid", "log_date"], partition_by=J.DAU_PARTS).select("mid", "log_date")


@C.register("stream_alerts", C.ORACLES["coupon_alerts"].replace(
    "AND NOT bool_or(evid = 'clickItem')",
    f"AND NOT bool_or(evid = 'clickItem') AND ws + INTERVAL {C.ALERT_SIZE} SECOND <= "
    f"(SELECT max(ts) FROM action_log) - INTERVAL {ALERT_LATENESS_SECONDS} SECOND"))
def q_stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    run = _run_dir(spark, "alerts")
    actions = SI.action_log_from(_events(spark, sf, ["event_id", "user_id", "ts", "event_type", "props"]))
    alerts = coupon_alerts_stream(actions, C.ALERT_SIZE, C.ALERT_SLIDE,
                                  lateness=f"{ALERT_LATENESS_SECONDS} seconds", tie=("event_id",))
    q = (alerts.writeStream.outputMode("append").format("parquet").option("path", f"{run}/out")
         .option("checkpointLocation", f"{run}/ckpt").trigger(availableNow=True).start())
    J.run_to_end(q)
    a = spark.read.parquet(f"{run}/out")
    return a.select(
        F.concat_ws("_", "mid", F.floor(F.unix_seconds("window_end") / 60).cast("long").cast("string")).alias("id"),
        "mid", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.array_join("uids", ",").alias("uids"), F.array_join("item_ids", ",").alias("item_ids"),
        F.array_join("events", ",").alias("events"))


@C.register("stream_pairs", C.ORACLES["pair_within_hour"])
def q_stream_pairs(spark: SparkSession, sf: str) -> DataFrame:
    run = _run_dir(spark, "pairs")
    cols = ["event_id", "user_id", "ts", "event_type"]
    views = (_events(spark, sf, cols).where(F.col("event_type") == "view")
             .select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").cast("timestamp").alias("v_ts")))
    buys = (_events(spark, sf, cols).where(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").cast("timestamp").alias("p_ts")))
    pairs = pair_within_stream(views, buys, "user_id", C.PAIR_BOUND, "v_ts", "p_ts", "1 hour")
    q = (pairs.select("view_id", "purchase_id").writeStream.format("parquet").option("path", f"{run}/out")
         .option("checkpointLocation", f"{run}/ckpt").trigger(availableNow=True).start())
    J.run_to_end(q)
    return spark.read.parquet(f"{run}/out")


@C.register("stream_cdc_upsert", C.ORACLES["user_latest"])
def q_stream_cdc_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Change log written once as files, then relayed in several micro-batches into the user table."""
    run = _run_dir(spark, "cdc")
    SI.cdc_log(spark, sf).write.parquet(f"{run}/cdc")
    cdc = spark.readStream.schema(schemas.CDC).option("maxFilesPerTrigger", 2).parquet(f"{run}/cdc")
    routed = route_cdc(cdc).where(F.col("topic") == TP.USER_TOPIC)
    users, _ = parse_json(routed, schemas.USER, keep=("seq",))
    # compact every 2 micro-batches so the read-back covers snapshot + recent batches
    J.run_to_end(J.user_dim_job(users, f"{run}/users", f"{run}/ckpt", "seq", available_now=True, compact_every=2))
    return current(spark, f"{run}/users", "id", "seq").select("id", "user_level")


@C.register("stream_cdc_relay", C.ORACLES["cdc_route"])
def q_stream_cdc_relay(spark: SparkSession, sf: str) -> DataFrame:
    """Change log (written once as files) relayed by the streaming job into one folder per topic."""
    run = _run_dir(spark, "relay")
    SI.cdc_log(spark, sf).write.parquet(f"{run}/cdc")
    cdc = spark.readStream.schema(schemas.CDC).option("maxFilesPerTrigger", 4).parquet(f"{run}/cdc")
    J.run_to_end(J.cdc_relay_job(cdc, f"{run}/topics", f"{run}/ckpt", db_pattern="^shop$", available_now=True, with_seq=False))
    return spark.read.parquet(f"{run}/topics").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@C.register("stream_order_hour", C.ORACLES["order_hour"])
def q_stream_order_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as topic messages (JSON of strings) -> typed, masked -> order table -> hourly amounts."""
    run = _run_dir(spark, "orders")
    o = SI.order_info_from(stream_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    msgs = o.select(to_json_record(
        "id", "user_id", "order_status", F.col("total_amount").cast("string").alias("total_amount"),
        "consignee_tel", "create_time").alias("value"))
    # the whole order history arrives in one micro-batch here: written unpartitioned (see order_job)
    J.run_to_end(J.order_job(J.typed_orders(msgs), f"{run}/orders", f"{run}/ckpt", available_now=True,
                             partition_by=None))
    t = current(spark, f"{run}/orders", "id")
    return t.groupBy("create_date", "create_hour").agg(F.round(F.sum("total_amount"), 2).alias("total_amount"))


@C.register("stream_sale_wide_ttl", f"""SELECT w.order_detail_id, w.order_id, w.order_status, w.create_time, w.user_id,
  w.sku_id, w.user_gender, CAST(w.user_age AS INTEGER) AS user_age, w.user_level, w.sku_price, w.sku_name, w.dt
  FROM wide w JOIN order_detail d2 ON d2.id = w.order_detail_id
  WHERE CAST(d2.create_time AS TIMESTAMP) BETWEEN CAST(w.create_time AS TIMESTAMP) - INTERVAL {C.ORDER_TTL} SECOND
  AND CAST(w.create_time AS TIMESTAMP) + INTERVAL {C.ORDER_TTL} SECOND""", ("wide",))
def q_stream_sale_wide_ttl(spark: SparkSession, sf: str) -> DataFrame:
    """Order and line streams paired within the TTL, user looked up per micro-batch -> sale table."""
    run = _run_dir(spark, "sale")
    upsert_batch(SI.user_info(spark, sf), 0, f"{run}/users", "id")
    orders = SI.order_info_from(stream_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    lines = stream_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    details = SI.order_detail_from(lines, read_table(spark, sf, "part", ["p_partkey", "p_name"]))
    # years of history arrive in one micro-batch here: written unpartitioned (see order_job)
    J.run_to_end(J.sale_job(orders, details, f"{run}/users", f"{run}/sale", f"{run}/ckpt", SI.age_as_of(),
                            ttl_seconds=C.ORDER_TTL, lateness="30 days", available_now=True, partition_by=None,
                            user_version=None))
    return current(spark, f"{run}/sale", "order_detail_id").select(*SALE_COLUMNS)


def _in_slices(df: DataFrame, path: str, slice_of) -> tuple[DataFrame, int]:
    """A file stream over ``df`` that takes about one slice per micro-batch, in the slices' order, and the files per slice.

    Slices are ranges of a number, each of some files: rows are dealt by range, not through one task, and the files
    are named in the order of the slices.
    """
    spark, files = df.sparkSession, max(1, df.sparkSession.sparkContext.defaultParallelism // 4)
    last = df.agg(F.max(slice_of)).first()[0]
    for k in range(0 if last is None else int(last) + 1):
        df.where(slice_of == k).repartition(files).write.parquet(f"{path}/{k:06d}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/*"), files


DAU_SLICE_DAYS, DAU_LATE_SECONDS = 5, 3600


def _late_events(spark: SparkSession, sf: str, path: str) -> DataFrame:
    """Events in files of five days each whose ends overlap by up to an hour: about one event in eighty comes
    after later ones, some of them after midnight."""
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    jitter = F.pmod(F.xxhash64("event_id"), F.lit(DAU_LATE_SECONDS))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) + jitter - F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    k = F.greatest(F.floor(seconds / (DAU_SLICE_DAYS * 86400)), F.lit(0))
    return _in_slices(ev, path, k)[0]


@C.register("stream_dau_first", C.ORACLES["dau_first"])
def q_stream_dau_first(spark: SparkSession, sf: str) -> DataFrame:
    """Late and out-of-order events over several micro-batches: the kept record is the day's earliest."""
    run = _run_dir(spark, "dau_first")
    startup = SI.startup_log_from(_late_events(spark, sf, f"{run}/in"))
    J.run_to_end(J.dau_job(startup, f"{run}/dau", f"{run}/ckpt", "2 hours", available_now=True, tie=("event_id",), compact_every=3))
    return current(spark, f"{run}/dau", ["mid", "log_date"], partition_by=J.DAU_PARTS).select("event_id", "mid", "log_date", "log_hour")


@C.register("dau_hour_from_table", f"""WITH f AS (SELECT mid, log_date, arg_min(log_hour, ts) AS log_hour FROM startup_log GROUP BY 1, 2)
  SELECT log_hour, CAST(count(*) AS BIGINT) AS n FROM f WHERE log_date = '{C.DAU_DATE}' GROUP BY 1""", ("startup_log",))
def q_dau_hour_from_table(spark: SparkSession, sf: str) -> DataFrame:
    """A dashboard query over the DAU table that the job wrote: the date prunes its folders."""
    run = _run_dir(spark, "dau_table")
    startup = SI.startup_log_from(_events(spark, sf, ["event_id", "user_id", "ts", "event_type"]))
    J.run_to_end(J.dau_job(startup, f"{run}/dau", f"{run}/ckpt", available_now=True, tie=("event_id",)))
    return dau_hours(spark, f"{run}/dau", C.DAU_DATE)


def dau_hours(spark: SparkSession, table: str, date: str) -> DataFrame:
    day = current(spark, table, ["mid", "log_date"], partition_by=J.DAU_PARTS, where=F.col("log_date") == date)
    return day.groupBy("log_hour").agg(F.count(F.lit(1)).alias("n"))


def order_hours(spark: SparkSession, table: str, date: str) -> DataFrame:
    day = current(spark, table, "id", "operate_time", J.ORDER_PARTS, where=F.col("create_date") == date)
    return day.groupBy("create_hour").agg(F.round(F.sum("total_amount"), 2).alias("total_amount"))


@C.register("order_hour_from_table", f"""SELECT substr(create_time, 12, 2) AS create_hour, round(sum(total_amount), 2) AS total_amount
  FROM order_info WHERE create_time LIKE '{C.ORDER_DATE}%' GROUP BY 1""", ("order_info",))
def q_order_hour_from_table(spark: SparkSession, sf: str) -> DataFrame:
    """The order table as the job writes it (partitioned by creation date), asked for one day."""
    run = _run_dir(spark, "order_table")
    orders = SI.order_info(spark, sf).withColumn("operate_time", F.col("create_time"))
    upsert_batch(orders, 0, f"{run}/orders", "id", "operate_time", J.ORDER_PARTS)
    return order_hours(spark, f"{run}/orders", C.ORDER_DATE)


@C.register("sale_search_from_table", C.ORACLES["sale_search_total"])
def q_sale_search_from_table(spark: SparkSession, sf: str) -> DataFrame:
    """The written sale table (partitioned by day), searched for one day and keyword."""
    run = _run_dir(spark, "sale_table")
    wide = sale_rows(*SI.wide_inputs(spark, sf), SI.age_as_of())
    upsert_batch(wide, 0, f"{run}/sale", "order_detail_id", None, J.SALE_PARTS, passes=PASSES)
    day = current(spark, f"{run}/sale", "order_detail_id", None, J.SALE_PARTS, where=F.col("dt") == C.SALE_DATE)
    return S.sale_detail(day, C.SALE_DATE, C.SALE_KEYWORD, 1, 5)["total"]


@C.register("stream_dau_from_topic", C.ORACLES["dau_total"])
def q_stream_dau_from_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Raw logs -> startup topic (JSON lines) -> typed records -> DAU table, as the jobs compose."""
    run = _run_dir(spark, "dau_topic")
    ev = read_table(spark, sf, "events", ["user_id", "ts", "event_type"])
    logs = ev.where(F.col("event_type").isin(*SI.STARTUP_EVENT_TYPES)).select(
        to_json_record(F.lit("startup").alias("type"), F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
                       F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")).alias("value"), F.lit(TP.STARTUP_TOPIC).alias("topic"))
    TP.write_topics(logs, f"{run}/topics", "json")
    messages = TP.read_topic(spark, f"{run}/topics/topic={TP.STARTUP_TOPIC}", "json", streaming=True)
    J.run_to_end(J.dau_job(J.typed_events(messages, schemas.STARTUP), f"{run}/dau", f"{run}/ckpt", available_now=True))
    table = current(spark, f"{run}/dau", ["mid", "log_date"], partition_by=J.DAU_PARTS)
    return table.groupBy("log_date").agg(F.count(F.lit(1)).alias("dau"))


@C.register("stream_user_from_topic", C.ORACLES["user_latest"])
def q_stream_user_from_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Change log -> user topic (JSON lines) -> user table: the message carries its version."""
    run = _run_dir(spark, "user_topic")
    SI.cdc_log(spark, sf).where(F.col("tbl") == "user_info").repartition(6, "seq").write.parquet(f"{run}/cdc")
    cdc = spark.readStream.schema(schemas.CDC).parquet(f"{run}/cdc")
    J.run_to_end(J.cdc_relay_job(cdc, f"{run}/topics", f"{run}/ckpt-relay", available_now=True, fmt="text"))
    messages = TP.read_topic(spark, f"{run}/topics/topic={TP.USER_TOPIC}", "json", streaming=True)
    J.run_to_end(J.user_dim_job(J.typed_users(messages), f"{run}/users", f"{run}/ckpt", available_now=True))
    return current(spark, f"{run}/users", "id", "seq").select("id", "user_level")


@C.register("stream_bad_records", """SELECT CASE WHEN event_id % 13 = 0 THEN 'malformed' ELSE 'no ts' END AS reason,
  CAST(count(*) AS BIGINT) AS n FROM events WHERE event_id % 13 = 0 OR event_id % 17 = 0 GROUP BY 1""")
def q_stream_bad_records(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of the event table, some cut short and some without a usable time: each is in the side table once."""
    run = _run_dir(spark, "bad")
    ev = _events(spark, sf, ["event_id", "user_id", "ts", "event_type"])
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    whole = to_json_record(F.col("event_type").alias("evid"), F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
                           F.when(F.col("event_id") % 17 == 0, F.lit("soon")).otherwise(ms).alias("ts"))
    messages = ev.withColumn("v", whole).select(
        F.when(F.col("event_id") % 13 == 0, F.substring("v", 1, 12)).otherwise(F.col("v")).alias("value"))
    J.run_to_end(J.bad_records_job(J.bad_events(messages), f"{run}/bad", f"{run}/ckpt", available_now=True))
    return spark.read.parquet(f"{run}/bad").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


ALERT_SCALE = 1440   # a day of events becomes a minute, so that several slides share a minute


ALERT_TABLE_SQL = f"""SELECT id, arg_max(mid, ws) AS mid, arg_max(uids, ws) AS uids, arg_max(events, ws) AS events FROM (
  SELECT mid || '_' || (CAST(epoch(ws + INTERVAL {C.ALERT_SIZE // 1440} SECOND) AS BIGINT) // 60) AS id, mid, ws,
  array_to_string(list_sort(list(DISTINCT uid) FILTER (WHERE evid = 'coupon')), ',') AS uids,
  string_agg(evid, ',' ORDER BY t, event_id) AS events
  FROM (SELECT *, make_timestamp(CAST(epoch_us(TIMESTAMP '2024-01-01') + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // {ALERT_SCALE} AS BIGINT)) AS t
    FROM action_log) a,
    (SELECT unnest(generate_series(TIMESTAMP '2023-12-31 23:58:00', TIMESTAMP '2024-01-01 00:32:00', INTERVAL {C.ALERT_SLIDE // 1440} SECOND)) AS ws) w
  WHERE t >= ws AND t < ws + INTERVAL {C.ALERT_SIZE // 1440} SECOND GROUP BY mid, ws
  HAVING count(DISTINCT CASE WHEN evid = 'coupon' THEN uid END) >= 3 AND NOT bool_or(evid = 'clickItem')) GROUP BY id"""


def _quick_actions(spark: SparkSession, sf: str, run: str) -> DataFrame:
    """The action log ALERT_SCALE times as quick, as a stream of files; a heartbeat in the last closes all windows."""
    zero = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    a = SI.action_log(spark, sf)
    a = a.withColumn("ts", F.timestamp_micros(zero + F.floor((F.unix_micros("ts") - zero) / ALERT_SCALE).cast("long")))
    a.write.parquet(f"{run}/in/0")
    beat = a.agg(F.max("event_id").alias("event_id"), (F.max("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts")).select(
        "event_id", F.lit("heartbeat").alias("mid"), F.lit(None).cast("string").alias("uid"), "ts", F.lit("beat").alias("evid"),
        F.lit(None).cast("string").alias("itemid"))
    beat.select(*a.columns).coalesce(1).write.parquet(f"{run}/in/1")
    return spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/in/*")


def _alert_rows(spark: SparkSession, run: str) -> DataFrame:
    t = current(spark, f"{run}/alerts", "id", "ts")
    return t.select("id", "mid", F.array_join("uids", ",").alias("uids"), F.array_join("events", ",").alias("events"))


@C.register("stream_alert_table", ALERT_TABLE_SQL, ("action_log",))
def q_stream_alert_table(spark: SparkSession, sf: str) -> DataFrame:
    """The alert job's table: one alert per device and minute, the last window wins; a heartbeat closes the last windows."""
    run = _run_dir(spark, "alert_table")
    J.run_to_end(J.alert_job(_quick_actions(spark, sf, run), f"{run}/alerts", f"{run}/ckpt", C.ALERT_SIZE // ALERT_SCALE,
                             C.ALERT_SLIDE // ALERT_SCALE, "1 minute", available_now=True, tie=("event_id",)))
    return _alert_rows(spark, run)


@C.register("stream_alerts_from_table", ALERT_TABLE_SQL, ("action_log",))
def q_stream_alerts_from_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same table from a stored event table, with no event in the state."""
    run = _run_dir(spark, "alerts_from_table")
    actions = _quick_actions(spark, sf, run)
    J.run_to_end(J.event_table_job(actions, f"{run}/events", f"{run}/ckpt-events", available_now=True))
    J.run_to_end(J.alert_from_table_job(spark, actions.schema, f"{run}/events", f"{run}/alerts", f"{run}/ckpt", C.ALERT_SIZE // ALERT_SCALE,
                                        C.ALERT_SLIDE // ALERT_SCALE, "1 minute", available_now=True, tie=("event_id",)))
    return _alert_rows(spark, run)


def _order_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in versions: first with another amount and hour for some, then as they are, then a late old version
    of some. ``step`` is the file they come in."""
    o = SI.order_info(spark, sf)
    number = F.col("id").cast("long")
    first = o.withColumn("operate_time", F.lit("1")).withColumn("total_amount", F.when(number % 3 == 0, F.col("total_amount") + 10).otherwise(F.col("total_amount")))
    first = first.withColumn("create_hour", F.when(number % 5 == 0, F.lit("23")).otherwise(F.col("create_hour")))
    changed = o.where((number % 3 == 0) | (number % 5 == 0)).withColumn("operate_time", F.lit("2"))
    late = first.where(number % 15 == 0)
    return (first.withColumn("step", F.lit(0)).unionByName(changed.withColumn("step", F.lit(1))).unionByName(late.withColumn("step", F.lit(2))))


def _in_steps(inputs: dict[str, DataFrame], steps: int, job) -> None:
    """Run ``job`` over file streams of the inputs (path -> rows), the rows of each ``step`` as one micro-batch.

    The rows are made once and written to a folder per step; then the job is resumed from its checkpoint for each folder more.
    """
    for path, df in inputs.items():
        with settings(df.sparkSession, {CONCURRENT_FILES: str(steps), **DROP_SHUFFLES, **SHORT_JOINS}):
            df.where(F.col("step").between(0, steps - 1)).write.partitionBy("step").parquet(path)
    for k in range(steps):
        so_far = ",".join(map(str, range(k + 1)))
        J.run_to_end(job(*[df.sparkSession.readStream.schema(df.drop("step").schema).parquet(f"{path}/step={{{so_far}}}")
                           for path, df in inputs.items()]))


@C.register("order_hour_rollup", C.ORACLES["order_hour"])
def q_order_hour_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly amounts kept by the stream while orders change amount and hour; compared with the batch SQL over the end state."""
    run = _run_dir(spark, "rollup")
    _in_steps({f"{run}/in": _order_changes(spark, sf)}, 3, lambda orders: J.order_rollup_job(
        orders, f"{run}/orders", f"{run}/hours", f"{run}/ckpt", available_now=True, compact_every=2))
    hours = read_rollup(spark, f"{run}/hours", J.ROLLUP_BY)
    return hours.select("create_date", "create_hour", F.round(F.col("amount").cast("double"), 2).alias("total_amount"))


@C.register("sale_search_indexed", C.ORACLES["sale_search_relevance_page"])
def q_sale_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The relevance page from the inverted index, after names were corrected by a later batch."""
    run = _run_dir(spark, "index")
    o, d, _ = SI.wide_inputs(spark, sf)
    names = d.join(o.select(F.col("id").alias("order_id"), F.col("create_date").alias("dt")), "order_id").select(
        F.col("id").alias("order_detail_id"), "sku_name", "dt")
    dealt = F.pmod(F.xxhash64("order_detail_id"), F.lit(10))
    index_batch(names.where(dealt < 7).withColumn("sku_name", F.when(dealt == 1, F.concat(F.lit("red red old "), "sku_name")).otherwise(F.col("sku_name"))),
                0, f"{run}/index", "order_detail_id", "sku_name", "dt")
    index_batch(names.where((dealt == 1) | (dealt >= 7)), 1, f"{run}/index", "order_detail_id", "sku_name", "dt")
    shown = search_index(spark, f"{run}/index", C.SALE_DATE, C.SALE_KEYWORD, 2, 5).withColumnRenamed("key", "order_detail_id")
    return shown.join(_names_of_day(spark, sf, C.SALE_DATE), "order_detail_id").select("order_detail_id", "sku_name", "score")


def _names_of_day(spark: SparkSession, sf: str, day: str) -> DataFrame:
    """(order_detail_id, sku_name) of the lines whose order is of one day: its few orders narrow the lines before the products."""
    orders = SI.order_info(spark, sf, [day]).select(F.col("id").alias("order_id"))
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"])
    lines = lines.join(orders.distinct(), F.col("l_orderkey").cast("string") == F.col("order_id"), "left_semi")
    names = SI.order_detail_from(lines, read_table(spark, sf, "part", ["p_partkey", "p_name"]))
    return names.join(orders, "order_id").select(F.col("id").alias("order_detail_id"), "sku_name")


TTL_STEPS, TTL_STEP_SECONDS, TTL_SECONDS = 6, 100, 150   # a pending row is alive in the next micro-batch, not in the one after


@C.register("stream_sale_ttl_refresh", f"""WITH o AS (SELECT o_orderkey AS k, o_orderkey % {TTL_STEPS} AS step FROM orders
    UNION SELECT o_orderkey, o_orderkey % {TTL_STEPS} + 3 FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % {TTL_STEPS} + 3 < {TTL_STEPS}),
  l AS (SELECT l_orderkey AS k, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, (l_orderkey * 5 + l_linenumber) % {TTL_STEPS} AS step
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
  alone AS (SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.k = l.k AND o.step = l.step)),
  w AS (SELECT k, step, sum(jump) OVER (PARTITION BY k ORDER BY step) AS run FROM (
    SELECT k, step, CASE WHEN step - lag(step) OVER (PARTITION BY k ORDER BY step) = 1 THEN 0 ELSE 1 END AS jump FROM (SELECT DISTINCT k, step FROM alone)))
  SELECT id AS order_detail_id, CAST(k AS VARCHAR) AS order_id FROM (
    SELECT l.id, l.k FROM l JOIN o USING (k, step)
    UNION SELECT a.id, a.k FROM alone a JOIN o ON o.k = a.k AND a.step = o.step + 1
    UNION SELECT a.id, a.k FROM alone a JOIN w ON w.k = a.k AND w.step = a.step JOIN w e ON e.k = a.k AND e.run = w.run AND e.step >= a.step
      JOIN o ON o.k = a.k AND o.step = e.step + 1)""")
def q_stream_sale_ttl_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Orders (some sent twice) and lines dealt to six micro-batches; each write keeps what is pending alive for one more."""
    run = _run_dir(spark, "ttl")
    upsert_batch(SI.user_info(spark, sf), 0, f"{run}/users", "id")
    number = F.col("id").cast("long")
    o = SI.order_info(spark, sf).withColumn("step", F.pmod(number, F.lit(TTL_STEPS)))
    again = o.where(number % 4 == 0).withColumn("step", F.col("step") + 3).where(F.col("step") < TTL_STEPS)
    line = F.split("id", "-")
    d = SI.order_detail(spark, sf).withColumn("step", F.pmod(line[0].cast("long") * 5 + line[1].cast("long"), F.lit(TTL_STEPS)))
    orders = o.unionByName(again).withColumn("arrived", F.col("step") * TTL_STEP_SECONDS)
    details = d.withColumn("arrived", F.col("step") * TTL_STEP_SECONDS)
    _in_steps({f"{run}/orders": orders, f"{run}/details": details}, TTL_STEPS, lambda o, d: J.sale_refresh_job(
        o, d, f"{run}/users", f"{run}/sale", f"{run}/ckpt", SI.age_as_of(), TTL_SECONDS, clock=F.max("arrived"),
        available_now=True, partition_by=None, user_version=None))
    return current(spark, f"{run}/sale", "order_detail_id", columns="order_id")


@C.register("stream_job_metrics", """SELECT 'dau_in.rows_in' AS name, CAST(count(*) AS DOUBLE) AS value FROM startup_log
  UNION ALL SELECT 'dau_out.rows_out', CAST(count(DISTINCT mid || log_date) AS DOUBLE) FROM startup_log
  UNION ALL SELECT 'late_rows_dropped', 0.0::DOUBLE""", ("startup_log",))
def q_stream_job_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What the DAU job counted, from the table that its listener writes."""
    run = _run_dir(spark, "metrics")
    startup = SI.startup_log_from(_events(spark, sf, ["event_id", "user_id", "ts", "event_type"]))
    counts = M.BatchCounts(spark, f"{run}/counts")
    spark.streams.addListener(counts)
    try:
        query = J.dau_job(startup, f"{run}/dau", f"{run}/ckpt", available_now=True, tie=("event_id",), name=f"dau-{uuid.uuid4().hex[:8]}")
        J.run_to_end(query)
        M.wait_for(spark, f"{run}/counts", query)
    finally:
        spark.streams.removeListener(counts)
    return M.read_counts(spark, f"{run}/counts").where("name <> 'input_rows'").groupBy("name").agg(F.sum("value").alias("value"))


@C.register("stream_late_rows", f"""WITH e AS (SELECT event_id, ts, CAST(floor((epoch(ts) - epoch(TIMESTAMP '2024-01-01')) / {DAU_SLICE_DAYS * 86400}) AS BIGINT)
    + CASE WHEN event_id % 50 = 7 THEN 1 ELSE 0 END AS step FROM events),
  m AS (SELECT step, max(max(ts)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM e GROUP BY step)
  SELECT event_id, coalesce(ts < seen - INTERVAL {DAU_LATE_SECONDS} SECOND, false) AS late FROM e JOIN m USING (step)""")
def q_stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every fiftieth event comes a slice too late: it is kept or in the side table by its batch's own watermark."""
    run = _run_dir(spark, "late")
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    step = F.floor(seconds / (DAU_SLICE_DAYS * 86400)) + F.when(F.col("event_id") % 50 == 7, 1).otherwise(0)
    stream, _ = _in_slices(ev, f"{run}/in", step)
    J.run_to_end(J.late_gate_job(stream, f"{run}/kept", f"{run}/late", f"{run}/ckpt", "ts", DAU_LATE_SECONDS, available_now=True))
    return (spark.read.parquet(f"{run}/kept").select("event_id", F.lit(False).alias("late"))
            .unionByName(spark.read.parquet(f"{run}/late").select("event_id", F.lit(True).alias("late"))))
