"""Late-match join whose expiry each write refreshes: orders and lines that meet while the earlier one is still pending.

An order stays pending for ``ttl`` seconds after it was last sent. Lines stay pending together: each further line
of an order that comes without its order starts the time of all its pending lines anew. An arriving order pairs with
the lines of its batch and the pending ones, an arriving line with the order of its batch or else the pending one.

Pending rows lie in folders by time and batch, ``<state>/<side>/epoch=<e>/batch_id=<n>``, where an epoch is ``wheel``
seconds of the batches' clock. A batch reads the epochs that can still be alive, joins in the JVM, writes what it
sent or refreshed into its own folder (a refreshed row moves there: its latest write counts), and drops the epochs that
are past. A replay with the same clock reads the batches before it only and writes the same. Nothing is kept per key
in a Python or state-store process, and a hot order's lines are split like any skewed join's.

All that a batch must know of an order (is it here or pending, did a line of it come, which batch wrote its pending lines
last) is a sum over ids and numbers only. Since a line that comes without its order takes all pending lines of that order
along, the last batch that wrote any of them wrote all. So the rows themselves are joined once, by order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.operators.dedup import latest_per_key
from martpulse.operators.upsert import kept, one_per_key, reduce_some
from martpulse.sources.paths import delete, matching

_FOLDER = re.compile(r"epoch=(-?\d+)/batch_id=(\d+)/_SUCCESS$")
AT, WRITE = "__at", "__write"   # the clock and the batch of a row's write


def alive(spark: SparkSession, path: str, schema, batch_id: int, clock: int, ttl: int, wheel: int) -> DataFrame:
    """Rows written by earlier batches less than ``ttl`` seconds before ``clock``, with every write of a key."""
    oldest = (clock - ttl) // wheel
    found = [f"{path}/epoch={m[1]}/batch_id={m[2]}" for m in map(_FOLDER.search, matching(spark, f"{path}/epoch=*/batch_id=*/_SUCCESS"))
             if m and int(m[1]) >= oldest and int(m[2]) < batch_id]
    if not found:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*found).where(F.lit(clock) - F.col(AT) < ttl)
    return rows.withColumn(WRITE, F.coalesce(WRITE, F.col(AT) - F.lit(clock + 1)))   # an older layout has the time only


def _folder(path: str, batch_id: int, clock: int, wheel: int) -> str:
    return f"{path}/epoch={clock // wheel}/batch_id={int(batch_id)}"


def _stamped(df: DataFrame, batch_id: int, clock: int) -> DataFrame:
    return df.withColumn(AT, F.lit(clock).cast("long")).withColumn(WRITE, F.lit(batch_id).cast("long"))


def drop_expired(spark: SparkSession, path: str, clock: int, ttl: int, wheel: int) -> None:
    """Delete the epochs whose last moment is ``ttl`` seconds ago or more."""
    for folder in matching(spark, f"{path}/epoch=*"):
        if (int(folder.rsplit("=", 1)[1]) + 1) * wheel + ttl <= clock:
            delete(spark, folder)


def pair_pending(orders: DataFrame, lines: DataFrame, state: str, batch_id: int, clock: int, out: str, order_key: str = "order_id",
                 line_key: str = "order_detail_id", ttl: int = 300, wheel: int | None = None, widen=None) -> DataFrame:
    """Pairs of one micro-batch, written to ``out`` (overwritten, with the lines that stay pending) and read from there; then the
    pending rows are brought up to date.

    ``orders`` and ``lines`` share ``order_key`` only and come from files (they are read more than once); of repeated keys in a
    batch one row counts. Rows without an order key pair with nothing. ``clock``: the batch's time in seconds, the same on
    a replay, never behind that of the batch before. ``widen``: adds columns to the orders that may pair, which pairs show.
    """
    spark, wheel = orders.sparkSession, wheel or max(1, ttl // 4)
    keys, stage = [order_key, line_key], f"{out.rstrip('/')}.parts"
    orders, lines = (df.where(F.col(order_key).isNotNull()) for df in (orders, lines))
    orders = _stamped(one_per_key(orders, [order_key], f"{stage}/orders", _reducer(orders, [order_key])), batch_id, clock)
    orders = kept(orders, _folder(f"{state}/orders", batch_id, clock, wheel))
    old_orders = alive(spark, f"{state}/orders", orders.schema, batch_id, clock, ttl, wheel)
    old_lines = alive(spark, f"{state}/lines", _stamped(lines, batch_id, clock).schema, batch_id, clock, ttl, wheel)
    repeated = kept(_repeated(lines, old_lines, keys), f"{stage}/lines")
    lines = reduce_some(lines, keys, repeated.where("n > 1").select("__key"), _reducer(lines, keys))
    old_lines = _unsent(old_lines, lines, keys, repeated.where("old").select("__key"))
    all_orders, all_lines = orders.unionByName(old_orders), _stamped(lines, batch_id, clock).unionByName(old_lines)

    here = F.lit(batch_id)
    seen = (all_orders.select(order_key, F.col(WRITE).alias("o"), F.lit(None).cast("long").alias("d"))
            .unionByName(all_lines.select(order_key, F.lit(None).cast("long").alias("o"), F.col(WRITE).alias("d"))))
    known = seen.groupBy(order_key).agg(
        F.max("o").alias("__order"), F.max("d").alias("__line"), F.max(F.when(F.col("d") < here, F.col("d"))).alias("__old_line"))
    known = known.where((F.col("__order") == here) | (F.col("__line") == here))   # orders that came, or with a line that came
    wide = all_orders.drop(AT).withColumnRenamed(WRITE, "__order")
    wide = wide if widen is None else widen(wide)
    known = kept(known.join(wide, [order_key, "__order"], "left"), f"{stage}/known")

    new, came = F.col(WRITE) == here, F.coalesce(F.col("__order") == here, F.lit(False))   # the line is of this batch; its order is
    met = all_lines.join(known, order_key).where(new | (F.col(WRITE) == F.col("__old_line")))
    met = met.withColumn("__pair", came | (new & F.col("__order").isNotNull())).withColumn("__keep", ~came & (F.col("__line") == here))
    met = kept(met.where(F.col("__pair") | F.col("__keep")), out)
    kept(_stamped(met.where("__keep").select(*lines.columns), batch_id, clock), _folder(f"{state}/lines", batch_id, clock, wheel))
    for side in ("orders", "lines"):
        drop_expired(spark, f"{state}/{side}", clock, ttl, wheel)
    delete(spark, stage)
    rest = [c for c in lines.columns if c != order_key]
    return met.where("__pair").select(order_key, *[c for c in wide.columns if c not in (order_key, "__order")], *rest)


def _repeated(lines: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Hashes of keys that come more than once in the batch (``n``) or are pending too (``old``)."""
    hashes = lambda df, new: df.select(F.xxhash64(*keys).alias("__key"), F.lit(new).alias("new"))
    counted = hashes(lines, 1).unionByName(hashes(old, 0)).groupBy("__key").agg(F.sum("new").alias("n"), (F.min("new") == 0).alias("old"))
    return counted.where((F.col("n") > 1) | ((F.col("n") > 0) & F.col("old")))


def _unsent(old: DataFrame, lines: DataFrame, keys: list[str], sent: DataFrame) -> DataFrame:
    """The old lines but those that are sent again; ``sent``: the hashes of those that can be."""
    if sent.isEmpty():
        return old
    lines = lines.withColumn("__key", F.xxhash64(*keys)).join(sent, "__key", "left_semi").select(*keys)
    return old.join(lines, keys, "left_anti").select(*old.columns)


def _reducer(df: DataFrame, keys: list[str]):
    """Rows -> one of each key, settled by a hash of the row."""
    rest = F.xxhash64(F.to_json(F.struct(*df.columns)))
    return lambda rows: latest_per_key(rows.withColumn("__tie", rest), keys, ["__tie"]).select(*df.columns)
