"""Sums per group of a keyed table, kept up by each micro-batch with retractions.

A batch adds the new value of each changed row to its group and takes the old value out of the group that held it,
so an order that changes its amount or its hour is right without reading the table again. Old values come from the
table as it was before the batch, and a batch's differences have a folder of their own: a replay writes the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.operators.dedup import latest_per_key
from martpulse.operators.upsert import BATCH_COL, compact, current, rows_since_snapshot, upsert_batch

AMOUNT = "decimal(38,6)"   # sums of doubles would keep a rest after a value is taken out again


def rollup_batch(batch: DataFrame, batch_id: int, table: str, rollup: str, key: str, by, value: str, version: str | None = None) -> None:
    """Upsert the rows of a micro-batch into ``table`` and write what that changes in the sums of ``value`` per ``by``.

    A row that is older (by ``version``) than the one the table holds changes nothing. Rows without a value count
    in ``n`` and not in the sum.
    """
    spark, by = batch.sparkSession, list(by)
    upsert_batch(batch, batch_id, table, key, version)
    own = spark.read.parquet(f"{table.rstrip('/')}/{BATCH_COL}={int(batch_id)}")
    new = own.withColumn("__at", F.lit(1))
    try:
        old = current(spark, table, key, version, only_keys=own, upto=batch_id - 1)
    except FileNotFoundError:   # the first batch
        old = None
    if old is None:
        signed = new.withColumn("__sign", F.lit(1))
    else:
        after = latest_per_key(new.unionByName(old.withColumn("__at", F.lit(0))), key, ([version] if version else []) + ["__at"])
        signed = after.withColumn("__sign", F.lit(1)).unionByName(old.withColumn("__at", F.lit(0)).withColumn("__sign", F.lit(-1)))
    amount = F.col("__sign") * F.coalesce(F.col(value).cast(AMOUNT), F.lit(0).cast(AMOUNT))
    change = signed.groupBy(*by).agg(F.sum("__sign").alias("n"), F.sum(amount).cast(AMOUNT).alias("amount")).where("n <> 0 or amount <> 0")
    # one row per changed group: summed by all tasks, then written as few files
    change.hint("rebalance").write.mode("overwrite").parquet(f"{rollup.rstrip('/')}/{BATCH_COL}={int(batch_id)}")


def add_up(by):
    """What a rollup's rows of several batches come to; also the ``fold`` of its compaction."""
    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("amount").cast(AMOUNT).alias("amount"))
    return fold


def read_rollup(spark: SparkSession, rollup: str, by) -> DataFrame:
    """``(*by, n, amount)``: the groups that hold rows now."""
    return add_up(by)(rows_since_snapshot(spark, rollup).drop(BATCH_COL)).where("n <> 0")


def compact_rollup(spark: SparkSession, rollup: str, by, upto: int | None = None) -> int | None:
    return compact(spark, rollup, list(by), upto=upto, fold=add_up(by))
