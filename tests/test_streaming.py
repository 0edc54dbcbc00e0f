"""Batch-stream parity on hand-made micro-batches: dedup across batches and midnight, late matches
across batches within the TTL, user dimension updates between batches, alert windows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from martpulse import schemas
from martpulse.functions.jsonrec import parse_json
from martpulse.operators.upsert import current, upsert_batch
from martpulse.sources.paths import matching
from martpulse.streaming import jobs as J

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _ms(s):
    return int((dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc) - EPOCH).total_seconds() * 1000)


def _write_json_lines(spark, path, records):
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1).write.text(path)


def test_dau_job_dedups_across_batches_and_midnight(spark, scratch):
    src = f"{scratch}/in"
    b1 = [{"type": "startup", "mid": "m1", "ts": _ms("2024-01-14 23:59:59")},
          {"type": "startup", "mid": "m1", "ts": _ms("2024-01-14 23:00:00")},
          {"type": "startup", "mid": "m2", "ts": _ms("2024-01-15 00:00:01")}]
    b2 = [{"type": "startup", "mid": "m1", "ts": _ms("2024-01-15 00:00:00")},   # same device, next day
          {"type": "startup", "mid": "m2", "ts": _ms("2024-01-15 05:00:00")}]   # already seen today
    _write_json_lines(spark, f"{src}/b1", b1)
    _write_json_lines(spark, f"{src}/b2", b2)
    msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{src}/*")
    startup = J.typed_events(msgs, schemas.STARTUP)
    J.run_to_end(J.dau_job(startup, f"{scratch}/dau", f"{scratch}/ck", available_now=True))
    got = sorted((r.mid, r.log_date) for r in current(spark, f"{scratch}/dau", ["mid", "log_date"], partition_by=J.DAU_PARTS).collect())
    assert got == [("m1", "2024-01-14"), ("m1", "2024-01-15"), ("m2", "2024-01-15")]


def test_sale_job_late_matches_and_user_lookup(spark, scratch):
    as_of = F.lit("2021-01-01").cast("date")
    users = spark.createDataFrame([("u1", "gold", "2000-01-01", "M")], "id string, user_level string, birthday string, gender string")
    upsert_batch(users, 0, f"{scratch}/users", "id")
    order = {"id": "o1", "user_id": "u1", "order_status": "1", "create_time": "2024-01-15 10:00:00",
             "consignee_tel": "13800001111", "total_amount": "5"}
    late_order = {"id": "o2", "user_id": "u2", "order_status": "1", "create_time": "2024-01-15 10:01:00",
                  "consignee_tel": "1", "total_amount": "7"}
    d_before = {"id": "d0", "order_id": "o1", "sku_id": "s", "sku_name": "x", "order_price": "1",
                "create_time": "2024-01-15 09:59:00"}
    d_with = {"id": "d1", "order_id": "o1", "sku_id": "s", "sku_name": "x", "order_price": "2",
              "create_time": "2024-01-15 10:00:00"}
    d_after = {"id": "d2", "order_id": "o1", "sku_id": "s", "sku_name": "x", "order_price": "3",
               "create_time": "2024-01-15 10:03:00"}
    d_too_late = {"id": "d3", "order_id": "o1", "sku_id": "s", "sku_name": "x", "order_price": "4",
                  "create_time": "2024-01-15 11:00:00"}
    d_for_o2 = {"id": "d4", "order_id": "o2", "sku_id": "s", "sku_name": "x", "order_price": "5",
                "create_time": "2024-01-15 10:00:30"}
    _write_json_lines(spark, f"{scratch}/o/b1", [order])
    _write_json_lines(spark, f"{scratch}/o/b2", [late_order])
    _write_json_lines(spark, f"{scratch}/d/b1", [d_before, d_with, d_for_o2])
    _write_json_lines(spark, f"{scratch}/d/b2", [d_after, d_too_late])
    o_msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{scratch}/o/*")
    d_msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{scratch}/d/*")
    orders = J.typed_orders(o_msgs)
    details, _bad = parse_json(d_msgs, schemas.DETAIL)
    J.run_to_end(J.sale_job(orders, details, f"{scratch}/users", f"{scratch}/sale", f"{scratch}/ck", as_of,
                            ttl_seconds=300, lateness="1 hour", available_now=True, user_version=None))
    rows = {r.order_detail_id: r for r in current(spark, f"{scratch}/sale", "order_detail_id", partition_by=J.SALE_PARTS).collect()}
    assert sorted(rows) == ["d0", "d1", "d2", "d4"]      # d3 is outside the 300 s bound
    assert rows["d1"].user_gender == "M" and rows["d1"].user_age == 21
    assert rows["d4"].user_age == 0 and rows["d4"].user_gender is None   # user miss keeps the row


def test_alert_job_emits_closed_windows(spark, scratch):
    base = "2024-01-15 00:00:"
    evs = [{"mid": "m1", "uid": f"u{i}", "evid": "coupon", "itemid": str(i), "ts": _ms(f"{base}{10 + i:02d}")}
           for i in range(4)]
    evs.append({"mid": "m2", "uid": "u1", "evid": "coupon", "itemid": "1", "ts": _ms(f"{base}15")})
    evs.append({"mid": "m0", "uid": "x", "evid": "addCart", "itemid": "1", "ts": _ms("2024-01-15 00:10:00")})
    _write_json_lines(spark, f"{scratch}/in", evs)
    msgs = spark.readStream.schema("value string").text(f"{scratch}/in")
    actions = J.typed_events(msgs, schemas.EVENT)
    J.run_to_end(J.alert_job(actions, f"{scratch}/alerts", f"{scratch}/ck", 100, 10, "1 minute", available_now=True))
    got = current(spark, f"{scratch}/alerts", "id", "ts").collect()
    assert got and {r.mid for r in got} == {"m1"}
    assert all(r.uids[:3] == ["u0", "u1", "u2"] for r in got)


@pytest.mark.parametrize("size, slide", [(120, 30), (40, 60)])  # the latter leaves gaps between windows
def test_stream_alert_panes_equal_batch_over_several_batches(spark, scratch, size, slide):
    """Three time-ordered files, one per trigger: the streaming pane plan emits exactly the batch
    alerts whose windows closed under the final watermark."""
    import random

    from martpulse.operators.alerts import coupon_alerts, coupon_alerts_stream

    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 15)
    evids = ["coupon"] * 5 + ["addCart", "clickItem"]
    rows = [{"event_id": i, "mid": f"m{rnd.randint(1, 3)}", "uid": f"u{rnd.randint(1, 6)}",
             "evid": rnd.choice(evids), "itemid": str(rnd.randint(1, 4)),
             "ts": (base + dt.timedelta(seconds=3 * i + rnd.randint(0, 2))).isoformat(sep=" ")} for i in range(600)]
    schema = "event_id long, mid string, uid string, evid string, itemid string, ts timestamp"
    df = spark.createDataFrame([(r["event_id"], r["mid"], r["uid"], r["evid"], r["itemid"],
                                 dt.datetime.fromisoformat(r["ts"])) for r in rows], schema)
    for k, (lo, hi) in enumerate([(0, 200), (200, 400), (400, 600)]):
        df.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.parquet(f"{scratch}/in/f{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in/*")
    q = (coupon_alerts_stream(stream, size, slide, lateness="5 minutes").writeStream.format("parquet")
         .option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    J.run_to_end(q)
    got = {(r.mid, r.window_start, tuple(r.uids), tuple(r.events)) for r in spark.read.parquet(f"{scratch}/out").collect()}
    closed_by = df.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=5)
    want = {(r.mid, r.window_start, tuple(r.uids), tuple(r.events))
            for r in coupon_alerts(df, size, slide).collect()
            if r.window_start + dt.timedelta(seconds=max(size, slide)) <= closed_by}
    assert want and got == want


@pytest.mark.parametrize("size, slide", [(120, 30), (40, 60)])
def test_alerts_from_the_event_table_hold_no_events_in_state(spark, scratch, size, slide):
    """Three files over midnight, one per trigger: the stored alerts equal the batch's closed windows, the last of each minute."""
    import random

    from martpulse.operators.alerts import coupon_alerts, coupon_alerts_stream, with_alert_id

    rnd = random.Random(12)
    base = dt.datetime(2024, 1, 14, 23, 45)
    evids = ["coupon"] * 5 + ["addCart", "clickItem"]
    rows = [(i, rnd.choice(["m1", "m2", "m3", None]), f"u{rnd.randint(1, 6)}", rnd.choice(evids), str(rnd.randint(1, 4)),
             base + dt.timedelta(seconds=3 * i + rnd.randint(0, 2))) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, mid string, uid string, evid string, itemid string, ts timestamp")
    df = df.where("mid is not null")
    for k in range(3):
        df.where(F.floor(F.col("event_id") / 200) == k).coalesce(1).write.parquet(f"{scratch}/in/f{k}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in/*")
    J.run_to_end(J.event_table_job(stream, f"{scratch}/events", f"{scratch}/ck-events", available_now=True))
    J.run_to_end(J.alert_from_table_job(spark, df.schema, f"{scratch}/events", f"{scratch}/alerts", f"{scratch}/ck", size, slide,
                                        "5 minutes", available_now=True, tie=("event_id",), files_per_trigger=1))
    got = {(r.id, r.window_start, tuple(r.uids), tuple(r.events)) for r in current(spark, f"{scratch}/alerts", "id", "ts").collect()}
    closed_by = df.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=5)
    last = {}
    for r in with_alert_id(coupon_alerts(df, size, slide, tie=("event_id",))).orderBy("window_start").collect():
        if r.window_start + dt.timedelta(seconds=max(size, slide)) <= closed_by:
            last[r.id] = (r.id, r.window_start, tuple(r.uids), tuple(r.events))
    assert last and got == set(last.values())
    plan = coupon_alerts_stream(stream, size, slide, with_events=False)._jdf.queryExecution().analyzed().toString()
    assert "event_id" not in plan.split("Aggregate", 2)[1] and "__evs" not in plan


def test_alerts_from_the_event_table_without_any_alert(spark, scratch):
    """Where a click vetoes every window, the table is there without rows, and a compaction of it runs."""
    base = dt.datetime(2024, 1, 15)
    rows = [(i, "m1", f"u{i % 5}", "clickItem" if i % 2 else "coupon", "1", base + dt.timedelta(seconds=i)) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, mid string, uid string, evid string, itemid string, ts timestamp")
    df.coalesce(1).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{scratch}/in")
    J.run_to_end(J.event_table_job(stream, f"{scratch}/events", f"{scratch}/ck-events", available_now=True))
    J.run_to_end(J.alert_from_table_job(spark, df.schema, f"{scratch}/events", f"{scratch}/alerts", f"{scratch}/ck", 20, 10,
                                        "10 seconds", available_now=True, tie=("event_id",), compact_every=1))
    table = current(spark, f"{scratch}/alerts", "id", "ts")
    assert table.count() == 0 and {"id", "mid", "uids", "events", "ts"} <= set(table.columns)


def test_sale_job_without_user_table_keeps_rows(spark, scratch):
    order = {"id": "o1", "user_id": "u1", "order_status": "1", "create_time": "2024-01-15 10:00:00",
             "consignee_tel": "1", "total_amount": "5"}
    line = {"id": "d1", "order_id": "o1", "sku_id": "s", "sku_name": "x", "order_price": "2",
            "create_time": "2024-01-15 10:01:00"}
    _write_json_lines(spark, f"{scratch}/o", [order])
    _write_json_lines(spark, f"{scratch}/d", [line])
    orders = J.typed_orders(spark.readStream.schema("value string").text(f"{scratch}/o"))
    details, _bad = parse_json(spark.readStream.schema("value string").text(f"{scratch}/d"), schemas.DETAIL)
    J.run_to_end(J.sale_job(orders, details, f"{scratch}/no-users", f"{scratch}/sale", f"{scratch}/ck",
                            F.lit("2021-01-01").cast("date"), 300, "1 hour", available_now=True))
    rows = current(spark, f"{scratch}/sale", "order_detail_id", partition_by=J.SALE_PARTS).collect()
    assert [(r.order_detail_id, r.user_age, r.user_gender) for r in rows] == [("d1", 0, None)]


def test_dau_keeps_a_record_that_arrives_after_midnight(spark, scratch):
    src = f"{scratch}/in"
    _write_json_lines(spark, f"{src}/b1", [{"type": "startup", "mid": "m1", "ts": _ms("2024-01-14 22:00:00")}])
    _write_json_lines(spark, f"{src}/b2", [{"type": "startup", "mid": "m1", "ts": _ms("2024-01-15 00:00:05")}])
    # twelve seconds late, after midnight; an earlier record of a known device; one later than the lateness allows
    _write_json_lines(spark, f"{src}/b3", [{"type": "startup", "mid": "m2", "ts": _ms("2024-01-14 23:59:59")},
                                           {"type": "startup", "mid": "m1", "ts": _ms("2024-01-14 21:30:00")}])
    _write_json_lines(spark, f"{src}/b4", [{"type": "startup", "mid": "m1", "ts": _ms("2024-01-15 03:00:00")}])
    _write_json_lines(spark, f"{src}/b5", [{"type": "startup", "mid": "m4", "ts": _ms("2024-01-15 03:00:00")}])
    _write_json_lines(spark, f"{src}/b6", [{"type": "startup", "mid": "m3", "ts": _ms("2024-01-14 23:59:59")}])
    msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{src}/*")
    J.run_to_end(J.dau_job(J.typed_events(msgs, schemas.STARTUP), f"{scratch}/dau", f"{scratch}/ck", "1 hour", available_now=True))
    got = {(r.mid, r.log_date): r.log_hour for r in current(spark, f"{scratch}/dau", ["mid", "log_date"], partition_by=J.DAU_PARTS).collect()}
    assert got == {("m1", "2024-01-14"): "21", ("m1", "2024-01-15"): "00", ("m2", "2024-01-14"): "23", ("m4", "2024-01-15"): "03"}


def test_job_resumes_from_its_checkpoint_and_replays_harmlessly(spark, scratch):
    """Stopped after half of its files, started again, and one batch written twice: the answer of one run."""
    src = f"{scratch}/in"
    files = [[{"type": "startup", "mid": f"m{(k * 7 + i) % 5}", "ts": _ms(f"2024-01-15 {k:02d}:{i:02d}:00")} for i in range(6)] for k in range(6)]
    for k in (0, 1, 2):
        _write_json_lines(spark, f"{src}/b{k}", files[k])

    def run():
        msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{src}/*")
        q = J.dau_job(J.typed_events(msgs, schemas.STARTUP), f"{scratch}/dau", f"{scratch}/ck", available_now=True, compact_every=2)
        J.run_to_end(q)
        return q.lastProgress

    run()
    for k in (3, 4, 5):
        _write_json_lines(spark, f"{src}/b{k}", files[k])
    progress = run()
    assert progress is not None and progress["batchId"] >= 5   # it went on, it didn't begin anew
    folder = max(matching(spark, f"{scratch}/dau/batch_id=*/log_date=*"), key=lambda p: int(p.split("batch_id=")[1].split("/")[0]))
    last = spark.read.parquet(folder).withColumn("log_date", F.lit("2024-01-15"))
    upsert_batch(last, 5, f"{scratch}/replayed", ["mid", "log_date"], None, J.DAU_PARTS)
    upsert_batch(last, 5, f"{scratch}/replayed", ["mid", "log_date"], None, J.DAU_PARTS)
    assert current(spark, f"{scratch}/replayed", ["mid", "log_date"], partition_by=J.DAU_PARTS).count() == last.count()
    got = {r.mid: r.log_hour + str(r.ts.minute) for r in current(spark, f"{scratch}/dau", ["mid", "log_date"], partition_by=J.DAU_PARTS).collect()}
    want = {}
    for f in files:
        for r in f:
            want[r["mid"]] = min(want.get(r["mid"], r["ts"]), r["ts"])
    assert got == {m: f"{(t // 3_600_000) % 24:02d}{(t // 60_000) % 60}" for m, t in want.items()}


def test_stream_pairs_of_a_hot_key_over_several_batches(spark, scratch):
    from martpulse.operators.pairs import pair_within, pair_within_stream

    base = dt.datetime(2024, 1, 15)
    left = spark.createDataFrame([("hot" if i % 2 else f"k{i % 7}", i, base + dt.timedelta(seconds=37 * i)) for i in range(200)], "key string, l int, l_ts timestamp")
    right = spark.createDataFrame([("hot" if i % 2 else f"k{i % 7}", i, base + dt.timedelta(seconds=41 * i + 5)) for i in range(180)], "key string, r int, r_ts timestamp")
    for k in range(4):
        left.where((F.col("l") >= 50 * k) & (F.col("l") < 50 * k + 50)).coalesce(1).write.parquet(f"{scratch}/l/{k}")
        right.where((F.col("r") >= 45 * k) & (F.col("r") < 45 * k + 45)).coalesce(1).write.parquet(f"{scratch}/r/{k}")
    ls, rs = (spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/{n}/*") for d, n in ((left, "l"), (right, "r")))
    q = (pair_within_stream(ls, rs, "key", 300, "l_ts", "r_ts", "1 hour").writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    J.run_to_end(q)
    got = sorted((r.l, r.r) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == sorted((r.l, r.r) for r in pair_within(left, right, "key", 300, "l_ts", "r_ts").collect()) and got


def test_sale_job_by_arrival(spark, scratch):
    """The TTL runs from arrival: a line of an old order pairs when both arrive together."""
    order = {"id": "o1", "user_id": "u1", "order_status": "1", "create_time": "2024-01-15 10:00:00", "consignee_tel": "1", "total_amount": "5"}
    line = {"id": "d1", "order_id": "o1", "sku_id": "s", "sku_name": "x", "order_price": "2", "create_time": "2024-03-01 10:01:00"}
    _write_json_lines(spark, f"{scratch}/o", [order])
    _write_json_lines(spark, f"{scratch}/d", [line])
    orders = J.typed_orders(spark.readStream.schema("value string").text(f"{scratch}/o"))
    details, _ = parse_json(spark.readStream.schema("value string").text(f"{scratch}/d"), schemas.DETAIL)
    J.run_to_end(J.sale_job(orders, details, f"{scratch}/no-users", f"{scratch}/sale", f"{scratch}/ck", F.lit("2021-01-01").cast("date"),
                            300, "1 hour", available_now=True, by_arrival=True))
    rows = current(spark, f"{scratch}/sale", "order_detail_id", partition_by=J.SALE_PARTS).collect()
    assert [r.order_detail_id for r in rows] == ["d1"]


def test_bad_messages_go_to_the_side_table(spark, scratch):
    good = json.dumps({"mid": "m", "ts": _ms("2024-01-15 00:00:00")})
    texts = [good, "{cut", None, '{"mid": "m"}', '{"mid": "m", "ts": "soon"}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    df.write.parquet(f"{scratch}/in")
    msgs = spark.readStream.schema("value string").parquet(f"{scratch}/in")
    J.run_to_end(J.bad_records_job(J.bad_events(msgs), f"{scratch}/bad", f"{scratch}/ck", available_now=True))
    got = {r.reason: r["count"] for r in spark.read.parquet(f"{scratch}/bad").groupBy("reason").count().collect()}
    assert got == {"malformed": 2, "no ts": 2} and J.typed_events(df).count() == 1


def test_log_intake_keeps_malformed_logs(spark, scratch):
    df = spark.createDataFrame([('{"type":"startup"}',), ("{cut",), ('{"evid":"x"}',)], "value string")
    df.write.parquet(f"{scratch}/in")
    raw = spark.readStream.schema("value string").parquet(f"{scratch}/in")
    J.run_to_end(J.log_intake_job(raw, f"{scratch}/out", f"{scratch}/ck", available_now=True, fmt="text", stamp=F.lit(7)))
    got = {r.topic: r.value for r in spark.read.format("text").load(f"{scratch}/out").collect()}
    assert got == {"startup": '{"type":"startup","ts":"7"}', "event": '{"evid":"x","ts":"7"}', "malformed": "{cut"}


def test_table_queries_prune_folders(spark, scratch):
    from martpulse.streaming.twins import dau_hours, order_hours

    rows = spark.createDataFrame([(f"m{i}", f"2024-01-{1 + i % 5:02d}", f"{i % 24:02d}") for i in range(50)], "mid string, log_date string, log_hour string")
    upsert_batch(rows, 0, f"{scratch}/dau", ["mid", "log_date"], None, J.DAU_PARTS)
    plan = dau_hours(spark, f"{scratch}/dau", "2024-01-02")
    assert sum(r.n for r in plan.collect()) == 10
    assert "PartitionFilters: [isnotnull(log_date" in plan._jdf.queryExecution().executedPlan().toString()
    orders = rows.selectExpr("mid as id", "log_date as create_date", "log_hour as create_hour", "1.5D as total_amount", "'x' as operate_time")
    upsert_batch(orders, 0, f"{scratch}/orders", "id", "operate_time", J.ORDER_PARTS)
    plan = order_hours(spark, f"{scratch}/orders", "2024-01-02")
    assert plan.count() > 0 and "PartitionFilters: [isnotnull(create_date" in plan._jdf.queryExecution().executedPlan().toString()


def test_an_incomplete_snapshot_is_not_read(spark, scratch):
    from martpulse.operators.upsert import compact, latest_snapshot
    from martpulse.sources.paths import delete

    for n in range(4):
        upsert_batch(spark.createDataFrame([("a", n), (f"k{n}", n)], "id string, v int"), n, f"{scratch}/t", "id", "v")
    assert compact(spark, f"{scratch}/t", "id", "v", upto=1) == 1 and compact(spark, f"{scratch}/t", "id", "v", upto=3) == 3
    assert not matching(spark, f"{scratch}/t/batch_id=1") and matching(spark, f"{scratch}/t/batch_id=2")   # covered twice over
    delete(spark, f"{scratch}/t/_base/upto=3/_SUCCESS")
    assert latest_snapshot(spark, f"{scratch}/t") == 1
    assert {(r.id, r.v) for r in current(spark, f"{scratch}/t", "id", "v").collect()} == {("a", 3), ("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3)}


def test_each_step_is_written_by_all_tasks_and_read_as_one_batch(spark, scratch):
    """Two inputs of three steps, the middle one empty in one of them: three micro-batches, files from several tasks."""
    from martpulse.streaming.twins import _in_steps

    a = spark.range(0, 300, 1, 3).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(2).alias("step"))
    b = spark.range(0, 300, 1, 3).select("id", (F.col("id") % 3).cast("int").alias("step"))
    seen = []

    def job(x, y):
        def write(df, batch_id):
            seen.append((batch_id, {(r.side, r.n) for r in df.groupBy("side").agg(F.count("id").alias("n")).collect()}))
        both = x.withColumn("side", F.lit("a")).unionByName(y.withColumn("side", F.lit("b")))
        return both.writeStream.foreachBatch(write).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()

    _in_steps({f"{scratch}/a": a, f"{scratch}/b": b}, 3, job)
    assert seen == [(0, {("a", 150), ("b", 100)}), (1, {("b", 100)}), (2, {("a", 150), ("b", 100)})]
    assert len(matching(spark, f"{scratch}/b/0/part-*")) == 3


def test_pairs_of_batches_equal_the_stream_join(spark, scratch):
    """A hot key over several batches, some rows late beyond the watermark, a replayed batch and snapshots of what is pending."""
    from martpulse.operators.pairs import pair_within, pair_within_batches

    base = dt.datetime(2024, 1, 15)
    left = spark.createDataFrame([("hot" if i % 2 else None if i % 14 == 0 else f"k{i % 7}", i, base + dt.timedelta(seconds=37 * i - (9000 if i % 50 == 49 else 0)))
                                  for i in range(200)], "key string, l int, l_ts timestamp")
    right = spark.createDataFrame([("hot" if i % 2 else f"k{i % 7}", i, base + dt.timedelta(seconds=41 * i + 5)) for i in range(180)], "key string, r int, r_ts timestamp")
    got, last, seen = [], [None, None], [None, None]
    for k in range(4):
        ls, rs = left.where((F.col("l") >= 50 * k) & (F.col("l") < 50 * k + 50)), right.where((F.col("r") >= 45 * k) & (F.col("r") < 45 * k + 45))
        news = [df.agg(F.unix_micros(F.max(ts))).first()[0] for df, ts in ((ls, "l_ts"), (rs, "r_ts"))]
        seen = [max(x for x in (a, b) if x is not None) for a, b in zip(last, news, strict=True)]
        for _ in range(2 if k == 2 else 1):
            pairs = pair_within_batches(ls, rs, "key", 300, "l_ts", "r_ts", "1 hour", last, seen, f"{scratch}/state", k, f"{scratch}/out{k}", compact_every=2)
        got += [(r.l, r.r) for r in pairs.collect()]
        last = seen
    late = [i for i in range(99, 200, 50)]   # the first batch has no watermark
    want = [(r.l, r.r) for r in pair_within(left.where(~F.col("l").isin(late)), right, "key", 300, "l_ts", "r_ts").collect()]
    assert sorted(got) == sorted(want) and want
    kept = spark.read.parquet(f"{scratch}/state/left/batch_id=3").agg(F.min("l")).first()[0]
    assert kept >= 150 - 2


def test_sale_job_keeps_no_row_in_a_state_store(spark, scratch):
    order = {"id": "o1", "user_id": "u1", "order_status": "1", "create_time": "2024-01-15 10:00:00", "consignee_tel": "1", "total_amount": "5"}
    line = {"id": "d1", "order_id": "o1", "sku_id": "s", "sku_name": "x", "order_price": "2", "create_time": "2024-01-15 10:01:00"}
    _write_json_lines(spark, f"{scratch}/o", [order])
    _write_json_lines(spark, f"{scratch}/d", [line])
    orders = J.typed_orders(spark.readStream.schema("value string").text(f"{scratch}/o"))
    details, _ = parse_json(spark.readStream.schema("value string").text(f"{scratch}/d"), schemas.DETAIL)
    q = J.sale_job(orders, details, f"{scratch}/no-users", f"{scratch}/sale", f"{scratch}/ck", F.lit("2021-01-01").cast("date"), 300, "1 hour", available_now=True)
    J.run_to_end(q)
    assert q.lastProgress["stateOperators"] == []
    assert current(spark, f"{scratch}/sale", "order_detail_id", partition_by=J.SALE_PARTS).count() == 1
