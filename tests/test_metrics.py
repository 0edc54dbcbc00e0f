"""Stored batch counts and the late-row gate, over several micro-batches."""

import datetime as dt

from pyspark.sql import functions as F

from martpulse.streaming import jobs as J, metrics as M

T0 = dt.datetime(2024, 1, 15)
SCHEMA = "i int, ts timestamp"


def files(spark, path, batches):
    for k, rows in enumerate(batches):
        df = spark.createDataFrame([(i, None if s is None else T0 + dt.timedelta(seconds=s)) for i, s in rows], SCHEMA)
        df.coalesce(1).write.parquet(f"{path}/{k}")


def test_late_gate_keeps_every_row_once_across_a_restart(spark, scratch):
    batches = [[(1, 0), (2, 5000)], [(3, 1300), (4, 1400), (5, None), (6, 9000)], [(7, 5399), (8, 5400), (9, 100)], [(10, 20000)], [(11, 16399), (12, 16400)]]
    files(spark, f"{scratch}/in", batches[:3])

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in/*")
        J.run_to_end(J.late_gate_job(stream, f"{scratch}/kept", f"{scratch}/late", f"{scratch}/ck", "ts", 3600, available_now=True))

    run()
    for k, rows in enumerate(batches[3:]):
        df = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s)) for i, s in rows], SCHEMA)
        df.coalesce(1).write.parquet(f"{scratch}/in/{k + 3}")
        run()   # a new start for each: the watermark is remembered
    kept, late = (sorted(r.i for r in spark.read.parquet(f"{scratch}/{x}").collect()) for x in ("kept", "late"))
    # watermarks: none, 1400, 5400, 5400, 16400
    assert late == [3, 7, 9, 11] and kept == [1, 2, 4, 5, 6, 8, 10, 12]


def test_batch_counts_are_stored_for_named_queries(spark, scratch):
    files(spark, f"{scratch}/in", [[(1, 0), (2, 1)], [(3, 2)]])
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in/*")
    counts = M.BatchCounts(spark, f"{scratch}/counts")
    spark.streams.addListener(counts)
    try:
        for name in ("counted", None):
            seen = stream().observe("all", F.count(F.lit(1)).alias("rows"), F.max("i").alias("most"), F.lit("x").alias("text"))
            writer = seen.writeStream.format("parquet").option("path", f"{scratch}/out-{name}").option("checkpointLocation", f"{scratch}/ck-{name}")
            query = (writer.queryName(name) if name else writer).trigger(availableNow=True).start()
            J.run_to_end(query)
            if name:
                M.wait_for(spark, f"{scratch}/counts", query)
    finally:
        spark.streams.removeListener(counts)
    got = {(r.query, r.batch_id, r["name"]): r.value for r in M.read_counts(spark, f"{scratch}/counts").collect()}
    assert {k[0] for k in got} == {"counted"}
    assert [got["counted", n, "all.rows"] for n in (0, 1)] == [2.0, 1.0] and got["counted", 1, "all.most"] == 3.0
    assert [got["counted", n, "input_rows"] for n in (0, 1)] == [2.0, 1.0] and ("counted", 0, "all.text") not in got
