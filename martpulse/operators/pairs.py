"""Time-bounded equi-join: pairs of records with the same key whose times differ by at most a bound.

Batch form: both sides get a time bucket as wide as the bound; the left side is replicated to its
bucket and the two neighbours, so the join key is (key, bucket). A key holding a third of all rows is
thus spread over its time buckets instead of pairing every left row with every right row of the key;
the exact bound is then checked on the candidates. Streaming form: Spark's stream-stream join on the same
(key, bucket), with watermarks on both sides and the range condition (state is dropped behind the watermark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martpulse.operators.upsert import BATCH_COL, compact, rows_since_snapshot


def _bucket(ts: Column, width_us: int) -> Column:
    us = F.unix_micros(ts)
    return ((us - F.pmod(us, F.lit(width_us))) / F.lit(width_us)).cast("long")


def pair_within(left: DataFrame, right: DataFrame, key: str, bound_seconds: int,
                left_ts: str = "ts", right_ts: str = "ts") -> DataFrame:
    """All (left, right) rows with equal ``key`` and ``|right_ts - left_ts| <= bound``.

    Column names of the two sides must be distinct apart from ``key`` (rename before calling).
    """
    width = int(bound_seconds) * 1_000_000
    lb = left.withColumn("__b", _bucket(F.col(left_ts), width))
    lb = lb.withColumn("__b", F.explode(F.array(F.col("__b") - 1, F.col("__b"), F.col("__b") + 1)))
    rb = right.withColumn("__b", _bucket(F.col(right_ts), width))
    bound = F.make_dt_interval(secs=F.lit(bound_seconds))
    cond = F.col(right_ts).between(F.col(left_ts) - bound, F.col(left_ts) + bound)
    return lb.join(rb, on=[key, "__b"], how="inner").where(cond).drop("__b")


def pair_within_stream(left: DataFrame, right: DataFrame, key: str, bound_seconds: int,
                       left_ts: str, right_ts: str, lateness: str = "1 hour") -> DataFrame:
    """Streaming twin: watermarked stream-stream inner join on (key, time bucket) with the range condition.

    The left side goes to its bucket and both neighbours, as in the batch form, so the state of a hot key is
    spread over its buckets.
    """
    lk, rk, width = f"__l_{key}", f"__r_{key}", int(bound_seconds) * 1_000_000
    lw = left.withColumnRenamed(key, lk).withWatermark(left_ts, lateness).withColumn("__bucket", _bucket(F.col(left_ts), width))
    lw = lw.withColumn("__lb", F.explode(F.array(F.col("__bucket") - 1, F.col("__bucket"), F.col("__bucket") + 1))).drop("__bucket")
    rw = right.withColumnRenamed(key, rk).withWatermark(right_ts, lateness).withColumn("__rb", _bucket(F.col(right_ts), width))
    bound = F.expr(f"INTERVAL {int(bound_seconds)} SECONDS")
    cond = ((F.col(lk) == F.col(rk)) & (F.col("__lb") == F.col("__rb"))
            & (F.col(right_ts) >= F.col(left_ts) - bound) & (F.col(right_ts) <= F.col(left_ts) + bound))
    return lw.join(rw, cond, "inner").withColumnRenamed(lk, key).drop(rk, "__lb", "__rb")


COMPACT_EVERY = 20   # micro-batches between snapshots of the pending rows


def pair_within_batches(left: DataFrame, right: DataFrame, key: str, bound_seconds: int, left_ts: str, right_ts: str, lateness: str,
                        before, after, state: str, batch_id: int, out: str, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """The pairs that one micro-batch adds to ``pair_within_stream``, written to ``out`` (overwritten) and read from there.

    ``before``, ``after``: latest times (microseconds, left and right) of the micro-batches without this one and with it;
    the watermark is the lesser of the two less the lateness, as Spark's own. A micro-batch's rows behind the watermark are
    dropped. Rows that a later row may still pair with lie in a folder per micro-batch below ``state`` and are read by the
    next ones; every ``compact_every``-th folds those still alive into a snapshot. A replay reads and writes the same.
    """
    spark, old = left.sparkSession, []
    sides = [("left", left, left_ts), ("right", right, right_ts)]
    new = [df.where(F.coalesce(F.col(ts) > _mark(before, lateness), F.lit(True)) & F.col(key).isNotNull() & F.col(ts).isNotNull())
           for _, df, ts in sides]
    reach = F.make_dt_interval(secs=F.lit(bound_seconds))
    for (side, df, ts), rows in zip(sides, new, strict=True):
        table = f"{state.rstrip('/')}/{side}"
        # null watermark: all rows stay
        alive = [F.coalesce(F.col(ts) >= _mark(marks, lateness) - reach, F.lit(True)) for marks in (before, after)]
        old.append(rows_since_snapshot(spark, table, upto=batch_id - 1).select(*df.columns).where(alive[0]) if batch_id else None)
        rows.where(alive[1]).write.mode("overwrite").parquet(f"{table}/{BATCH_COL}={int(batch_id)}")
    pairs = pair_within(new[0] if old[0] is None else new[0].unionByName(old[0]), new[1], key, bound_seconds, left_ts, right_ts)
    if old[1] is not None:
        pairs = pairs.unionByName(pair_within(new[0], old[1], key, bound_seconds, left_ts, right_ts))
    pairs.write.mode("overwrite").parquet(out)
    if (batch_id + 1) % compact_every == 0:
        for side, _, ts in sides:
            fold = F.coalesce(F.col(ts) >= _mark(after, lateness) - reach, F.lit(True))
            compact(spark, f"{state.rstrip('/')}/{side}", [], upto=batch_id, fold=lambda rows, fold=fold: rows.where(fold))
    return spark.read.schema(pairs.schema).parquet(out)


def _mark(latest, lateness: str) -> Column:
    """The watermark, null while either stream has sent nothing."""
    least = None if None in latest else min(latest)
    return F.timestamp_micros(F.lit(least).cast("long")) - F.expr(f"INTERVAL {lateness}")
