"""Structured Streaming jobs composed from the batch operators.

Each job takes a streaming DataFrame (from ``sources.topics.read_topic(..., streaming=True)`` or a
file stream), an output path and a checkpoint folder (under the shared ``spark.checkpoint.dir``),
and returns the started ``StreamingQuery``. Offsets and operator state live in the checkpoint, so a
restarted job resumes where it stopped; keyed outputs go through ``upsert_batch`` whose per-batch
folders make a replayed batch harmless.

Trigger: ``processing_time`` (default 5 seconds, the reference's batch interval) or ``available_now``
for draining what exists and stopping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martpulse import schemas
from martpulse.functions.jsonrec import parse_json
from martpulse.functions.masking import mask_phone
from martpulse.functions.timeparts import ms_to_ts, with_create_parts, with_time_parts
from martpulse.operators.alerts import attach_events, coupon_alerts_stream, with_alert_id
from martpulse.operators.dedup import first_per_day_stream
from martpulse.operators.pairs import pair_within_batches
from martpulse.operators.route import route_cdc, route_logs, route_logs_typed
from martpulse.operators.pending import pair_pending
from martpulse.operators.rollup import compact_rollup, rollup_batch
from martpulse.operators.textindex import compact_index, index_batch
from martpulse.operators.upsert import (BATCH_COL, CONCURRENT_FILES, DROP_SHUFFLES, SHORT_JOINS, compact, current, foreach_batch_upsert,
                                         newest_batch, settings, upsert_batch)
from martpulse.operators.widen import SALE_COLUMNS, attach_user
from martpulse.sources.paths import delete, exists, matching

BATCH_INTERVAL = "5 seconds"
# Folder layout of the keyed output tables (pass to ``upsert.current``).
MALFORMED_TOPIC = "malformed"
COMPACT_EVERY = 100   # micro-batches between snapshots of a keyed table
PINS_KEPT = 10        # micro-batches whose lookup state is remembered; only the last one can be replayed
DAU_PARTS, ORDER_PARTS, SALE_PARTS = ("log_date",), ("create_date",), ("dt",)


def _start(writer, checkpoint: str, available_now: bool, interval: str = BATCH_INTERVAL, name: str | None = None):
    w = writer.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def _event_wire(schema) -> T.StructType:
    return T.StructType([f if f.name != "ts" else T.StructField("ts", T.StringType()) for f in schema.fields])


def typed_events(messages: DataFrame, schema=schemas.EVENT) -> DataFrame:
    """Topic messages -> typed records with ``ts`` TIMESTAMP, ``log_date``, ``log_hour``.

    ``ts`` arrives as epoch milliseconds (a JSON number or its text). Messages that give no record are in
    ``bad_events``: nothing is lost between the two.
    """
    good, _ = parse_json(messages, _event_wire(schema))
    typed = good.withColumn("ts", ms_to_ts(F.col("ts").try_cast("long")))
    return with_time_parts(typed.where(F.col("ts").isNotNull()), "ts")


def bad_events(messages: DataFrame, schema=schemas.EVENT) -> DataFrame:
    """``(reason, value)`` of the messages that ``typed_events`` can't use: malformed JSON, or no usable time."""
    good, bad = parse_json(messages, _event_wire(schema), keep_raw=True)
    untimed = good.where(F.col("ts").try_cast("long").isNull()).select(F.lit("no ts").alias("reason"), "value")
    return bad.select(F.lit("malformed").alias("reason"), "value").unionByName(untimed)


def bad_rows(messages: DataFrame, schema) -> DataFrame:
    """``(reason, value)`` of the messages of a row topic (orders, lines, users) that are no JSON object."""
    _, bad = parse_json(messages, schema)
    return bad.select(F.lit("malformed").alias("reason"), "value")


def bad_records_job(bad: DataFrame, out_path: str, checkpoint: str, available_now: bool = False):
    """Unusable messages (``bad_events``, ``bad_rows``) -> side table, one folder per reason; counted with ``observe``."""
    seen = bad.observe("bad_messages", F.count(F.lit(1)).alias("rows"))
    writer = seen.writeStream.format("parquet").option("path", out_path).partitionBy("reason")
    return _start(writer, checkpoint, available_now)


def _topic_writer(routed: DataFrame, out: str, fmt: str):
    """Writer of ``(topic, value)`` rows: a folder per topic (parquet, or text: JSON lines), or Kafka records."""
    writer = routed.select("topic", "value").writeStream.format(fmt)
    if fmt == "kafka":
        return writer.option("kafka.bootstrap.servers", out)
    return writer.option("path", out).partitionBy("topic")


def log_intake_job(raw: DataFrame, out_path: str, checkpoint: str, available_now: bool = False, fmt: str = "parquet",
                   stamp=None, typed: bool = False):
    """Raw app logs -> stamped JSON per topic (``startup`` / ``event``); ``typed``: fields keep their JSON types.

    Malformed logs have no topic: they go to the folder (or Kafka topic) ``malformed``, as they came.
    """
    route = route_logs_typed if typed else route_logs
    routed = route(raw.withColumn("__raw", F.col("value")), stamp=stamp, keep=("__raw",))
    routed = routed.select(F.coalesce("topic", F.lit(MALFORMED_TOPIC)).alias("topic"), F.coalesce("value", "__raw").alias("value"))
    return _start(_topic_writer(routed, out_path, fmt), checkpoint, available_now)


def cdc_relay_job(cdc: DataFrame, out_path: str, checkpoint: str, db_pattern: str | None = None,
                  available_now: bool = False, fmt: str = "parquet", with_seq: bool = True):
    """Change-log entries -> after-image JSON per topic; entries of other tables or kinds aren't relayed."""
    return _start(_topic_writer(route_cdc(cdc, db_pattern, with_seq), out_path, fmt), checkpoint, available_now)


def dau_job(startup: DataFrame, table_path: str, checkpoint: str, lateness: str = "1 hour",
            available_now: bool = False, tie=(), compact_every: int | None = COMPACT_EVERY, name: str | None = None):
    """First startup per device and day -> DAU table (upsert on (mid, log_date), partitioned by date).

    Update mode: a device's row is written when its earliest record changes, and the later batch wins.
    Rows before/after the reduction are counted with ``observe``; under a ``name``, ``metrics.BatchCounts`` stores them.
    """
    seen = startup.observe("dau_in", F.count(F.lit(1)).alias("rows_in"))
    firsts = first_per_day_stream(seen, "mid", "ts", lateness, tie)
    firsts = firsts.observe("dau_out", F.count(F.lit(1)).alias("rows_out"))
    sink = foreach_batch_upsert(table_path, ["mid", "log_date"], None, DAU_PARTS, compact_every)
    return _start(firsts.writeStream.outputMode("update").foreachBatch(sink), checkpoint, available_now, name=name)


def late_gate_job(stream: DataFrame, kept_path: str, late_path: str, checkpoint: str, ts: str = "ts", lateness_seconds: int = 3600,
                  available_now: bool = False):
    """Part a stream before its stateful jobs: rows behind the watermark go to a side table instead of being dropped.

    The watermark of a micro-batch is the greatest ``ts`` of all batches before it less the lateness, as Spark's own.
    It is remembered per batch, so a replay parts its rows alike; every row is in exactly one of the two tables.
    """
    def _write(batch_df: DataFrame, batch_id: int) -> None:
        spark, seen = batch_df.sparkSession, f"{kept_path.rstrip('/')}/_seen"
        before = remembered(spark, seen, batch_id - 1, lambda: None) if batch_id else None
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        late = F.coalesce(us < F.lit(before) - F.lit(lateness_seconds * 1_000_000), F.lit(False)) if before is not None else F.lit(False)
        stage = f"{kept_path.rstrip('/')}/_stage/{BATCH_COL}={int(batch_id)}"
        batch_df.withColumn("__late", late).write.mode("overwrite").parquet(stage)
        rows = spark.read.parquet(stage)
        for path, part in ((kept_path, ~F.col("__late")), (late_path, F.col("__late"))):
            rows.where(part).drop("__late").write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH_COL}={int(batch_id)}")
        most = rows.agg(F.max(us).alias("most")).first()["most"]
        remembered(spark, seen, batch_id, lambda: max((x for x in (before, most) if x is not None), default=None))
        delete(spark, stage)

    return _start(stream.writeStream.foreachBatch(_write), checkpoint, available_now)


def typed_orders(messages: DataFrame, mask_style: str = "middle") -> DataFrame:
    """Order topic -> typed orders: double amount, create date/hour, masked phone."""
    good, _bad = parse_json(messages, schemas.ORDER)
    out = good.withColumn("total_amount", F.col("total_amount").try_cast("double"))
    out = out.withColumn("consignee_tel", mask_phone("consignee_tel", mask_style))
    return with_create_parts(out)


def typed_users(messages: DataFrame) -> DataFrame:
    """User topic -> user rows with their version ``seq`` (BIGINT)."""
    good, _ = parse_json(messages, schemas.USER_MESSAGE)
    return good.withColumn("seq", F.col("seq").try_cast("long"))


def order_job(orders: DataFrame, table_path: str, checkpoint: str, available_now: bool = False,
              partition_by: str | None = "create_date", version: str | None = "operate_time",
              compact_every: int | None = COMPACT_EVERY):
    """Typed orders -> order table (upsert on id, partitioned by create_date by default).

    A live stream writes a few dates per micro-batch; a replay of years of history in one batch
    would write one small folder per day, so a backfill may pass ``partition_by=None``.
    """
    sink = foreach_batch_upsert(table_path, "id", version, partition_by, compact_every)
    return _start(orders.writeStream.foreachBatch(sink), checkpoint, available_now)


ROLLUP_BY = ("create_date", "create_hour")


def order_rollup_job(orders: DataFrame, table_path: str, rollup_path: str, checkpoint: str, available_now: bool = False,
                     version: str | None = "operate_time", compact_every: int | None = COMPACT_EVERY):
    """Typed orders -> order table and its hourly counts and amounts (``rollup.read_rollup``), right after updates and moves."""
    def _write(batch_df: DataFrame, batch_id: int) -> None:
        rollup_batch(batch_df, batch_id, table_path, rollup_path, "id", ROLLUP_BY, "total_amount", version)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch_df.sparkSession, table_path, "id", version, upto=batch_id)
            compact_rollup(batch_df.sparkSession, rollup_path, ROLLUP_BY, upto=batch_id)

    return _start(orders.writeStream.foreachBatch(_write), checkpoint, available_now)


def index_job(sales: DataFrame, index_path: str, checkpoint: str, key: str = "order_detail_id", text: str = "sku_name", day: str = "dt",
              available_now: bool = False, compact_every: int | None = COMPACT_EVERY):
    """Sale rows -> inverted index of their names (``textindex.search_index``)."""
    def _write(batch_df: DataFrame, batch_id: int) -> None:
        index_batch(batch_df, batch_id, index_path, key, text, day)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_index(batch_df.sparkSession, index_path, upto=batch_id)

    return _start(sales.writeStream.foreachBatch(_write), checkpoint, available_now)


def remembered(spark: SparkSession, folder: str, batch_id: int, value) -> int | None:
    """A number that a micro-batch takes from ``value()`` once; its replay gets the same. Old batches' are deleted."""
    at = f"{folder}/{BATCH_COL}={int(batch_id)}"
    if not exists(spark, f"{at}/_SUCCESS"):
        spark.createDataFrame([(value(),)], "number long").coalesce(1).write.mode("overwrite").parquet(at)
        if batch_id >= PINS_KEPT:
            delete(spark, f"{folder}/{BATCH_COL}={int(batch_id) - PINS_KEPT}")
    return spark.read.schema("number long").parquet(at).first()["number"]


def pinned(spark: SparkSession, pins: str, batch_id: int, table: str) -> int | None:
    """The newest batch of ``table`` as this micro-batch first saw it (None: the table had none): a replay looks rows
    up in the same state."""
    return remembered(spark, pins, batch_id, lambda: newest_batch(spark, table) if exists(spark, table) else None)


def alert_job(actions: DataFrame, table_path: str, checkpoint: str, size_seconds: int = 100,
              slide_seconds: int = 10, lateness: str = "1 minute", available_now: bool = False, tie=(),
              compact_every: int | None = COMPACT_EVERY):
    """Action events -> coupon alerts, one stored alert per device and minute (upsert on id)."""
    alerts = with_alert_id(coupon_alerts_stream(actions, size_seconds, slide_seconds, lateness=lateness, tie=tie))
    sink = foreach_batch_upsert(table_path, "id", "ts", compact_every=compact_every)
    return _start(alerts.writeStream.outputMode("append").foreachBatch(sink), checkpoint, available_now)


EVENT_DAY = "event_day"


def event_table_job(actions: DataFrame, events_path: str, checkpoint: str, ts: str = "ts", available_now: bool = False):
    """Action events -> event table in folders by day, each event once (the file sink's log)."""
    rows = actions.withColumn(EVENT_DAY, F.to_date(F.col(ts)))
    return _start(rows.writeStream.format("parquet").option("path", events_path).partitionBy(EVENT_DAY), checkpoint, available_now)


def alert_from_table_job(spark: SparkSession, schema, events_path: str, table_path: str, checkpoint: str, size_seconds: int = 100,
                         slide_seconds: int = 10, lateness: str = "1 minute", available_now: bool = False, tie=(),
                         compact_every: int | None = COMPACT_EVERY, files_per_trigger: int | None = None):
    """``alert_job`` over the table of ``event_table_job``, with no event in the state.

    The table is the stream's source, so every event that the state has counted is stored. A micro-batch stages its alerts,
    then reads the day folders that their windows touch. Events behind the watermark count for no alert, but stand in the
    lists of windows that close after they are stored. ``schema``: of the events, without the day.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    alerts = coupon_alerts_stream(reader.parquet(events_path), size_seconds, slide_seconds, lateness=lateness, with_events=False)

    def _write(batch_df: DataFrame, batch_id: int) -> None:
        session, stage = batch_df.sparkSession, f"{table_path.rstrip('/')}/_stage/{BATCH_COL}={int(batch_id)}"
        batch_df.write.mode("overwrite").parquet(stage)
        staged = session.read.schema(batch_df.schema).parquet(stage)
        days = staged.agg(F.to_date(F.min("window_start")).alias("lo"), F.to_date(F.max("window_end")).alias("hi")).first()
        if days["lo"] is not None:
            stored = session.read.schema(_with_day(schema)).parquet(events_path).where(F.col(EVENT_DAY).between(days["lo"], days["hi"]))
        else:   # nothing alerts: the batch is written without rows, so the table can be read and compacted
            stored = session.createDataFrame([], _with_day(schema))
        found = with_alert_id(attach_events(staged, stored, size_seconds, slide_seconds, tie=tie))
        upsert_batch(found, batch_id, table_path, "id", "ts")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(session, table_path, "id", "ts", upto=batch_id)
        delete(session, stage)

    return _start(alerts.writeStream.outputMode("append").foreachBatch(_write), checkpoint, available_now)


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(EVENT_DAY, T.DateType())])


def user_dim_job(users: DataFrame, table_path: str, checkpoint: str, version: str = "seq",
                 available_now: bool = False, compact_every: int | None = COMPACT_EVERY):
    """User changes -> user dimension (upsert on id, last write wins, never expires).

    Compacted every ``compact_every`` batches: the sale job reads this table in every micro-batch.
    """
    sink = foreach_batch_upsert(table_path, "id", version, compact_every=compact_every)
    return _start(users.writeStream.foreachBatch(sink), checkpoint, available_now)


def _user_lookup(user_table: str, table_path: str, as_of, user_version: str | None, partition_by, compact_every: int | None):
    """What a sale job does with a micro-batch's rows: user attributes (``attach``), then the keyed sale table (``store``)."""
    def attach(rows: DataFrame, batch_id: int) -> DataFrame:
        spark = rows.sparkSession
        wanted = rows.select(F.col("user_id").alias("id")).where(F.col("id").isNotNull())
        # a replay looks users up in the state that the batch saw first
        upto = pinned(spark, f"{table_path.rstrip('/')}/_pins", batch_id, user_table)
        if upto is not None:
            users = current(spark, user_table, "id", user_version, only_keys=wanted, upto=upto)
        else:   # no user written yet: every lookup misses, rows are kept
            users = spark.createDataFrame([], schemas.USER)
        return attach_user(rows, users, as_of)

    def store(wide: DataFrame, batch_id: int, reread: bool = False) -> None:
        upsert_batch(wide.select(*SALE_COLUMNS), batch_id, table_path, "order_detail_id", None, partition_by, reread=reread)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(wide.sparkSession, table_path, "order_detail_id", None, partition_by, upto=batch_id)

    return attach, store


def sale_job(orders: DataFrame, details: DataFrame, user_table: str, table_path: str, checkpoint: str,
             as_of, ttl_seconds: int = 300, lateness: str = "10 minutes", available_now: bool = False,
             partition_by=SALE_PARTS, user_version: str | None = "seq", by_arrival: bool = False,
             compact_every: int | None = COMPACT_EVERY):
    """Orders x lines within ``ttl_seconds`` of each other, plus the user lookup -> sale table.

    The pair join is a watermarked join of the micro-batches (``pairs.pair_within_batches``): no row of a long history goes
    through a state store. The user dimension is re-read inside each micro-batch so the lookup sees the latest upserts (a
    static side read once would go stale).
    ``by_arrival``: the TTL runs from each message's arrival (stamped by its micro-batch), not from its
    ``create_time``. ``user_version``: the version column that the user table was written with.
    """
    at = F.current_timestamp() if by_arrival else F.to_timestamp("create_time", "yyyy-MM-dd HH:mm:ss")
    o = orders.select(F.col("id").alias("order_id"), F.struct("order_status", "create_time", "user_id", F.col("create_date").alias("dt"),
                                                              at.alias("o_ts")).alias("o"))
    d = details.select("order_id", F.struct(F.col("id").alias("order_detail_id"), "sku_id", "sku_name",
                                            F.col("order_price").try_cast("double").alias("sku_price"), at.alias("d_ts")).alias("d"))
    state = f"{table_path.rstrip('/')}/_pending"
    attach, store = _user_lookup(user_table, table_path, as_of, user_version, partition_by, compact_every)

    def _write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        # this micro-batch and its pairs are written once to a staging folder (overwritten on retry,
        # invisible to readers of the table) and read from there: the join runs once, and the user
        # lookup aggregates only this batch's users, not the whole dimension
        stage = f"{table_path.rstrip('/')}/_stage/batch_id={int(batch_id)}"
        batch_df.write.mode("overwrite").parquet(f"{stage}/in")
        rows = spark.read.schema(batch_df.schema).parquet(f"{stage}/in")
        seen = rows.agg(F.unix_micros(F.max("o.o_ts")).alias("o"), F.unix_micros(F.max("d.d_ts")).alias("d")).first()
        before, after = [], []   # the latest time of either stream, without this micro-batch and with it; a replay finds the same
        for side in ("o", "d"):
            last = remembered(spark, f"{state}/seen_{side}", batch_id - 1, lambda: None) if batch_id else None
            most = max((x for x in (last, seen[side]) if x is not None), default=None)
            before.append(last)
            after.append(remembered(spark, f"{state}/seen_{side}", batch_id, lambda: most))
        pairs = pair_within_batches(rows.where("o is not null").select("order_id", "o.*"), rows.where("d is not null").select("order_id", "d.*"),
                                    "order_id", ttl_seconds, "o_ts", "d_ts", lateness, before, after, state, batch_id, f"{stage}/pairs")
        store(attach(pairs.drop("o_ts", "d_ts"), batch_id), batch_id)
        delete(spark, stage)

    return _start(o.unionByName(d, allowMissingColumns=True).writeStream.foreachBatch(_write), checkpoint, available_now)


def sale_refresh_job(orders: DataFrame, details: DataFrame, user_table: str, table_path: str, checkpoint: str, as_of,
                     ttl_seconds: int = 300, clock=None, available_now: bool = False, partition_by=SALE_PARTS,
                     user_version: str | None = "seq", compact_every: int | None = COMPACT_EVERY):
    """``sale_job`` with an expiry that each write refreshes (``operators.pending``), by the time of the micro-batches.

    ``clock``: seconds of a micro-batch as an aggregate over its rows (``arrived`` is a column both streams may have); by
    default the time the batch first ran, which a replay finds again.
    """
    o = orders.select(F.col("id").alias("order_id"), F.struct("order_status", "create_time", "user_id", F.col("create_date").alias("dt")).alias("o"),
                      *_arrival(orders))
    d = details.select("order_id", F.struct(F.col("id").alias("order_detail_id"), "sku_id", "sku_name",
                                            F.col("order_price").try_cast("double").alias("sku_price")).alias("d"), *_arrival(details))
    state = f"{table_path.rstrip('/')}/_pending"
    attach, store = _user_lookup(user_table, table_path, as_of, user_version, partition_by, compact_every)

    def _write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        stage = f"{table_path.rstrip('/')}/_stage/batch_id={int(batch_id)}"
        with settings(spark, {**DROP_SHUFFLES, **SHORT_JOINS}):
            with settings(spark, {CONCURRENT_FILES: "2"}):   # orders and lines in folders of their own: neither is read for the other
                batch_df.withColumn("__side", F.col("o").isNotNull()).write.mode("overwrite").partitionBy("__side").parquet(f"{stage}/in")
            sides = []
            for side in ("true", "false"):
                found = matching(spark, f"{stage}/in/__side={side}")
                sides.append(spark.read.schema(batch_df.schema).parquet(*found) if found else spark.createDataFrame([], batch_df.schema))
            at = (sides[0].unionByName(sides[1]).agg(clock.alias("t")).first()["t"] if clock is not None else
                  remembered(spark, f"{state}/clocks", batch_id, lambda: spark.range(1).select(F.unix_seconds(F.current_timestamp())).first()[0]))
            if at is not None:   # an empty batch has no time of its own
                # users are looked up once per order that may pair, in the state that the batch saw first
                wide = pair_pending(sides[0].select("order_id", "o.*"), sides[1].where("d is not null").select("order_id", "d.*"), state, batch_id,
                                    int(at), f"{stage}/pairs", ttl=ttl_seconds, widen=lambda orders: attach(orders, batch_id))
                store(wide, batch_id, reread=True)
        delete(spark, stage)

    both = o.unionByName(d, allowMissingColumns=True)
    return _start(both.writeStream.foreachBatch(_write), checkpoint, available_now)


def _arrival(df: DataFrame) -> list:
    return [F.col("arrived")] if "arrived" in df.columns else []


def console_job(stream: DataFrame, checkpoint: str, rows: int = 20, available_now: bool = False):
    """Print each micro-batch (debugging output of a job's stream)."""
    writer = stream.writeStream.format("console").option("numRows", rows).option("truncate", "false")
    return _start(writer, checkpoint, available_now)


def run_to_end(query) -> None:
    """Wait for an ``available_now`` query and surface its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")

