"""Order x detail x user widening into sale rows.

Joins are declared with equality keys and left to Catalyst/AQE: a side whose runtime size is under the
broadcast threshold is broadcast, otherwise both sides shuffle on the key, and AQE splits a skewed
partition of the many-side (a hot order or user) across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martpulse.functions.timeparts import age_years


def _order_side(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
                         F.col("create_date").alias("dt"))


def _detail_side(details: DataFrame) -> DataFrame:
    return details.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
                          # bad price text -> null instead of failing the batch
                          F.col("order_price").try_cast("double").alias("sku_price"))


def pair_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Inner equi-join of orders and their lines -> sale rows without user attributes."""
    return _order_side(orders).join(_detail_side(details), on="order_id", how="inner")


def attach_user(rows: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Left lookup of the user dimension by ``user_id``; a miss keeps the row (age 0, nulls)."""
    u = users.select(F.col("id").alias("user_id"), F.col("gender").alias("user_gender"), "user_level",
                     age_years(F.col("birthday"), as_of).alias("__age"))
    j = rows.join(u, on="user_id", how="left")
    return j.withColumn("user_age", F.coalesce(F.col("__age"), F.lit(0))).drop("__age")


SALE_COLUMNS = ("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
                "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt")


def sale_rows(orders: DataFrame, details: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """The wide sale table: one row per order line with order and user attributes.

    Users are looked up per order, before its lines multiply the rows: the lines are not dealt by user.
    """
    return attach_user(_order_side(orders), users, as_of).join(_detail_side(details), on="order_id", how="inner").select(*SALE_COLUMNS)


def arrival_batch(create_time: str = "create_time", length: str = "month") -> Column:
    """Arrival batch of a record from its 'yyyy-MM-dd HH:mm:ss' time: 'yyyy-MM' or 'yyyy-MM-dd'."""
    n = {"month": 7, "day": 10, "hour": 13}[length]
    return F.substring(F.col(create_time), 1, n)


def pair_per_batch(orders: DataFrame, details: DataFrame, batch_len: str = "month") -> DataFrame:
    """Full outer join of orders and lines that arrive in the same batch, on the order id.

    Rows: ``(batch, order_id, detail_id)``; an order without lines in its batch has a null detail,
    a line whose order is not in the batch a null order. Built as ``lines LEFT JOIN orders`` plus
    ``orders LEFT ANTI (distinct line keys)``, which is the full outer join for any multiplicities:
    AQE can split a hot order on the lines side of a left join (not in a full outer sort-merge
    join), and the anti-join reads distinct keys only (combined map-side).
    """
    o = orders.select(arrival_batch(length=batch_len).alias("batch"), F.col("id").alias("order_id"))
    d = details.select(arrival_batch(length=batch_len).alias("batch"), F.col("order_id"),
                       F.col("id").alias("detail_id"))
    keys = ["batch", "order_id"]
    with_lines = (d.join(o.select(*keys, F.col("order_id").alias("__o")), on=keys, how="left")
                   .select("batch", F.col("__o").alias("order_id"), "detail_id"))
    only_o = (o.join(d.select(*keys).distinct(), on=keys, how="left_anti")
               .select("batch", "order_id", F.lit(None).cast("string").alias("detail_id")))
    return with_lines.unionByName(only_o)


def pair_orders_within(orders: DataFrame, details: DataFrame, ttl_seconds: int) -> DataFrame:
    """Late-match join: an order and a line of it pair when they arrive within ``ttl_seconds``.

    The net result of the reference's cache-and-expire join: matched pairs only, bounded by the TTL.
    Each line has one order, so the equi-join on the id carries no quadratic blow-up; the time bound
    is a post-join predicate.
    """
    o = orders.select(F.col("id").alias("order_id"),
                      F.to_timestamp("create_time", "yyyy-MM-dd HH:mm:ss").alias("o_ts"))
    d = details.select(F.col("id").alias("order_detail_id"), "order_id",
                       F.to_timestamp("create_time", "yyyy-MM-dd HH:mm:ss").alias("d_ts"))
    bound = F.make_dt_interval(secs=F.lit(ttl_seconds))
    return (o.join(d, on="order_id", how="inner")
             .where(F.col("d_ts").between(F.col("o_ts") - bound, F.col("o_ts") + bound))
             .select("order_id", "order_detail_id"))
