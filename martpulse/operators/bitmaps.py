"""Exact distinct counts over any span of days from merged bitmaps.

A dictionary gives each key a small number: keys are dealt to ``parts`` by a hash, numbered inside their part, and
the number is ``place * parts + part``. New keys continue each part's numbers, so numbers never change and no task
sees all keys. A bitmap table holds one bitmap of 32,768 numbers per (period, bucket); a span's count is the sum over
buckets of the bits set in the OR of its periods' bitmaps. OR doesn't mind a row twice: a replayed batch is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

PARTS = 64


def extend_dictionary(keys: DataFrame, key: str, known: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """``(key, part, place, number)`` of the keys that ``known`` (such a table) doesn't hold; null keys get none."""
    new = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
    new = new.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(key)).cast("long") - 1
    new = new.withColumn("place", place)
    if known is not None:
        last = known.groupBy("part").agg((F.max("place") + 1).alias("__next"))   # at most ``parts`` rows
        new = new.join(F.broadcast(last), "part", "left").withColumn("place", F.col("place") + F.coalesce("__next", F.lit(0))).drop("__next")
    return new.select(key, "part", "place", (F.col("place") * parts + F.col("part")).alias("number"))


def period_bitmaps(rows: DataFrame, key: str, period, dictionary: DataFrame) -> DataFrame:
    """``(*period, bucket, bits)`` of the keys of each period. A key counts once however many rows it has."""
    period = [period] if isinstance(period, str) else list(period)
    numbered = rows.select(key, *period).distinct().join(dictionary.select(key, "number"), key)
    return (numbered.groupBy(*period, F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def merged(bitmaps: DataFrame, by=()) -> DataFrame:
    """``(*by, n)``: distinct keys of all bitmaps of each group."""
    by = [by] if isinstance(by, str) else list(by)
    whole = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return whole.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def rolling(bitmaps: DataFrame, day: str, days: int) -> DataFrame:
    """``(day, n)``: distinct keys of each day and the ``days`` - 1 before it, for the days that have rows.

    Each bitmap goes to the days it counts for: ``days`` copies of a bitmap of at most 4 KB, not of its keys.
    """
    ends = bitmaps.select(F.col(day).alias("__end")).distinct()
    spread = bitmaps.select("bucket", "bits", F.explode(F.sequence(F.to_date(day), F.date_add(F.to_date(day), days - 1))).alias("__d"))
    spread = spread.select("bucket", "bits", F.date_format("__d", "yyyy-MM-dd").alias("__end")).join(ends, "__end", "left_semi")
    return merged(spread, "__end").withColumnRenamed("__end", day)
