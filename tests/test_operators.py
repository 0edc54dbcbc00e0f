"""Operators against brute force on micro fixtures."""

import datetime as dt
import itertools
from collections import Counter
import random

import pytest
from pyspark.sql import functions as F

from martpulse.operators.alerts import coupon_alerts
from martpulse.operators.dedup import exclude_seen, first_per_key, latest_per_key
from martpulse.operators.pairs import pair_within
from martpulse.operators.route import route_cdc
from martpulse.operators.search import bm25_top, match_all, page, top_terms
from martpulse.operators import upsert
from martpulse.operators.upsert import compact, current, rows_since_snapshot, upsert_batch
from martpulse.operators.widen import pair_per_batch, sale_rows
from martpulse.plans import dashboard as D
from martpulse.plans import saledetail as S
from martpulse.sources.paths import matching

T0 = dt.datetime(2024, 1, 15, 0, 0, 0)


def test_first_and_latest_per_key(spark):
    rows = [("m1", "d1", 3, 10, "a"), ("m1", "d1", 1, 12, "b"), ("m1", "d1", 1, 11, "c"), ("m2", "d1", 5, 1, "d")]
    df = spark.createDataFrame(rows, "mid string, day string, ts long, event_id long, x string")
    first = {(r.mid, r.day): r.x for r in first_per_key(df, ["mid", "day"], ["ts", "event_id"]).collect()}
    assert first == {("m1", "d1"): "c", ("m2", "d1"): "d"}
    last = {r.mid: r.x for r in latest_per_key(df, "mid", ["ts", "event_id"]).collect()}
    assert last == {"m1": "a", "m2": "d"}


def test_exclude_seen(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("c",)], "mid string")
    seen = spark.createDataFrame([("b",), ("b",)], "mid string")
    assert sorted(r.mid for r in exclude_seen(batch, seen, "mid").collect()) == ["a", "c"]


def test_route_cdc_only_routes_intended_tables(spark):
    rows = [(1, "shop", "order_info", "INSERT", {"id": "1"}), (2, "shop", "order_info", "UPDATE", {"id": "1"}),
            (3, "shop", "user_info", "UPDATE", {"id": "u"}), (4, "shop", "sku_info", "UPDATE", {"id": "s"}),
            (5, "shop", "user_info", "DELETE", None), (6, "shop", "order_detail", "INSERT", {"id": "d"}),
            (7, "other", "order_info", "INSERT", {"id": "9"})]
    df = spark.createDataFrame(rows, "seq long, db string, tbl string, op string, after map<string,string>")
    got = sorted((r.seq, r.topic) for r in route_cdc(df, db_pattern="^shop$").collect())
    assert got == [(1, "order_info"), (3, "user_info"), (6, "order_detail")]


def _brute_pairs(left, right, bound):
    return sorted((a[0], b[0]) for a, b in itertools.product(left, right)
                  if a[1] == b[1] and abs((b[2] - a[2]).total_seconds()) <= bound)


def test_pair_within_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    # key 0 is hot; exact boundary offsets included
    left = [(i, 0 if i % 3 else rnd.randint(1, 4), T0 + dt.timedelta(seconds=rnd.randint(0, 20000))) for i in range(300)]
    right = [(1000 + i, 0 if i % 2 else rnd.randint(1, 4), T0 + dt.timedelta(seconds=rnd.randint(0, 20000)))
             for i in range(300)]
    right.append((5000, left[0][1], left[0][2] + dt.timedelta(seconds=600)))   # exactly on the bound
    right.append((5001, left[0][1], left[0][2] + dt.timedelta(seconds=601)))   # just outside
    l_df = spark.createDataFrame(left, "lid long, k long, lts timestamp")
    r_df = spark.createDataFrame(right, "rid long, k long, rts timestamp")
    got = sorted((r.lid, r.rid) for r in pair_within(l_df, r_df, "k", 600, "lts", "rts").collect())
    assert got == _brute_pairs(left, right, 600)


def test_pair_per_batch_is_full_outer(spark):
    orders = spark.createDataFrame([("1", "2024-01-01 10:00:00"), ("2", "2024-01-02 10:00:00"),
                                    ("3", "2024-02-01 00:00:00")], "id string, create_time string")
    details = spark.createDataFrame([("d1", "1", "2024-01-05 00:00:00"), ("d2", "1", "2024-01-06 00:00:00"),
                                     ("d3", "3", "2024-01-31 00:00:00"), ("d4", "9", "2024-01-01 00:00:00")],
                                    "id string, order_id string, create_time string")
    got = Counter(tuple(r) for r in pair_per_batch(orders, details).collect())
    assert got == Counter([("2024-01", "1", "d1"), ("2024-01", "1", "d2"), ("2024-01", "2", None),
                           ("2024-02", "3", None), ("2024-01", None, "d3"), ("2024-01", None, "d4")])


def _brute_alerts(rows, size, slide, min_uids=3):
    out = {}
    starts = set()
    for r in rows:
        t = int(r[3].replace(tzinfo=dt.timezone.utc).timestamp())
        s = (t // slide) * slide
        while s > t - size:
            starts.add(s)
            s -= slide
    for s in starts:
        for mid in {r[1] for r in rows}:
            grp = sorted([r for r in rows if r[1] == mid and
                          s <= int(r[3].replace(tzinfo=dt.timezone.utc).timestamp()) < s + size],
                         key=lambda r: (r[3], r[0]))
            if not grp:
                continue
            uids = sorted({r[2] for r in grp if r[4] == "coupon" and r[2] is not None})
            if len(uids) >= min_uids and not any(r[4] == "clickItem" for r in grp):
                items = sorted({r[5] for r in grp if r[4] == "coupon" and r[5] is not None})
                out[(mid, s)] = (uids, items, [r[4] for r in grp])
    return out


def test_coupon_alerts_match_brute_force(spark):
    rnd = random.Random(3)
    evids = ["coupon"] * 6 + ["addCart", "addFavor", "clickItem"]
    rows = []
    for i in range(400):
        uid = None if i % 37 == 0 else f"u{rnd.randint(1, 6)}"        # null uid never counts
        rows.append((i, f"m{rnd.randint(1, 3)}", uid, T0 + dt.timedelta(seconds=rnd.randint(0, 3000)),
                     rnd.choice(evids), str(rnd.randint(1, 5))))
    df = spark.createDataFrame(rows, "event_id long, mid string, uid string, ts timestamp, evid string, itemid string")
    got = {}
    for r in coupon_alerts(df, size_seconds=300, slide_seconds=60).collect():
        s = int(r.window_start.replace(tzinfo=dt.timezone.utc).timestamp()) if r.window_start.tzinfo is None \
            else int(r.window_start.timestamp())
        got[(r.mid, s)] = (r.uids, r.item_ids, r.events)
    want = _brute_alerts(rows, 300, 60)
    assert want, "fixture should produce alerts"
    assert got == want


@pytest.mark.parametrize("size, slide", [(45, 30), (20, 30), (100, 10)])
def test_coupon_alerts_window_not_multiple_of_slide(spark, size, slide):
    rows = [(i, "m", f"u{i}", T0 + dt.timedelta(seconds=10 * i), "coupon", "1") for i in range(12)]
    df = spark.createDataFrame(rows, "event_id long, mid string, uid string, ts timestamp, evid string, itemid string")
    got = {int(r.window_start.timestamp()) for r in coupon_alerts(df, size, slide, 2).collect()}
    want = set(_brute_alerts(rows, size, slide, 2))
    assert {s for (_m, s) in want} == got


def test_upsert_retry_is_idempotent_and_latest_wins(spark, scratch):
    path = f"{scratch}/t"
    b0 = spark.createDataFrame([("1", 1, "a"), ("2", 1, "b")], "id string, v long, x string")
    upsert_batch(b0, 0, path, "id", "v")
    upsert_batch(b0, 0, path, "id", "v")          # retried batch: same folder, no duplicates
    b1 = spark.createDataFrame([("1", 2, "a2"), ("1", 3, "a3"), (None, 9, "auto")], "id string, v long, x string")
    upsert_batch(b1, 1, path, "id", "v")
    cur = {r.id: r.x for r in current(spark, path, "id", "v").collect() if r.id in ("1", "2")}
    assert cur == {"1": "a3", "2": "b"}
    assert current(spark, path, "id", "v").count() == 3   # null key got its own generated id
    assert compact(spark, path, "id", "v") == 1
    assert compact(spark, path, "id", "v") == 1               # idempotent
    b2 = spark.createDataFrame([("2", 0, "b-old"), ("3", 1, "c")], "id string, v long, x string")
    upsert_batch(b2, 2, path, "id", "v")
    cur = {r.id: r.x for r in current(spark, path, "id", "v").collect() if r.id in ("1", "2", "3")}
    assert cur == {"1": "a3", "2": "b", "3": "c"}             # snapshot + later batch, versions respected
    assert compact(spark, path, "id", "v") == 2
    assert current(spark, path, "id", "v").count() == 4


@pytest.mark.parametrize("parts, version, repeats", [(["day"], "v", True), (["day"], None, False), (None, None, True)])
def test_a_large_batch_is_written_like_a_small_one(spark, scratch, monkeypatch, parts, version, repeats):
    rng = random.Random(7)
    rows = [(f"k{i}", rng.randrange(3), f"d{rng.randrange(9)}", None if i % 5 else "x") for i in range(200)]
    if repeats:   # keys that come again with other or equal versions and days, equal rows, null keys and days
        rows += [(f"k{i}", rng.randrange(3), f"d{rng.randrange(9)}", "again") for i in range(0, 200, 3)] + rows[:20]
        rows += [(None, 1, "d1", "auto"), (None, 1, "d1", "auto"), (None, 2, "d2", "auto"), ("n", 1, None, "n"), ("n", 1, "d1", "m")]
    df = spark.createDataFrame(rows, "id string, v long, day string, x string").repartition(3)
    upsert_batch(df, 4, f"{scratch}/small", "id", version, parts)
    for most in (upsert.ONE_PASS_BYTES, 0):   # in one pass; a retry, in three, replaces the batch
        monkeypatch.setattr(upsert, "ONE_PASS_BYTES", most)
        upsert_batch(df, 4, f"{scratch}/large", "id", version, parts, passes=3)
    upsert_batch(df, 4, f"{scratch}/reread", "id", version, parts, reread=True)
    small, large, reread = (rows_since_snapshot(spark, f"{scratch}/{n}", parts or ()) for n in ("small", "large", "reread"))
    assert small.dtypes == large.dtypes == reread.dtypes
    assert Counter(large.collect()) == Counter(small.collect()) == Counter(reread.collect())
    assert not matching(spark, f"{scratch}/*/_large/*")   # the stage is gone
    some = current(spark, f"{scratch}/large", "id", version, parts or (), columns="x")
    assert some.columns == ["id", "x"] and Counter(some.collect()) == Counter(small.select("id", "x").collect())
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_large_batch_cut_short_is_not_complete(spark, scratch, monkeypatch):
    df = spark.createDataFrame([(f"k{i}", f"d{i % 9}") for i in range(50)], "id string, day string")
    write, done = upsert._write, []
    monkeypatch.setattr(upsert, "ONE_PASS_BYTES", 0)
    monkeypatch.setattr(upsert, "_write", lambda *a, **k: done.append(1) or (write(*a, **k) if len(done) < 3 else 1 / 0))
    with pytest.raises(ZeroDivisionError):
        upsert_batch(df, 0, f"{scratch}/t", "id", None, ["day"], passes=3)
    assert upsert.newest_batch(spark, f"{scratch}/t") is None
    monkeypatch.undo()
    upsert_batch(df, 0, f"{scratch}/t", "id", None, ["day"], passes=3)
    assert current(spark, f"{scratch}/t", "id", None, ["day"]).count() == 50


def _sales(spark):
    orders = spark.createDataFrame(
        [("o1", "1", "2024-01-15 10:00:00", "u1", "2024-01-15"), ("o2", "1", "2024-01-15 11:00:00", "u9", "2024-01-15")],
        "id string, order_status string, create_time string, user_id string, create_date string")
    details = spark.createDataFrame(
        [("d1", "o1", "s1", "red shoe", "10.5"), ("d2", "o1", "s2", "blue hat", "abc"), ("d3", "o2", "s1", "red shoe", "3")],
        "id string, order_id string, sku_id string, sku_name string, order_price string")
    users = spark.createDataFrame([("u1", "gold", "2000-06-01", "F")], "id string, user_level string, birthday string, gender string")
    return sale_rows(orders, details, users, F.lit("2021-01-01").cast("date"))


def test_sale_rows_user_miss_and_bad_price(spark):
    rows = {r.order_detail_id: r for r in _sales(spark).collect()}
    assert rows["d1"].user_age == 20 and rows["d1"].user_gender == "F" and rows["d1"].sku_price == 10.5
    assert rows["d2"].sku_price is None                  # bad price text does not fail the batch
    assert rows["d3"].user_age == 0 and rows["d3"].user_gender is None and rows["d3"].user_level is None


def test_sale_detail_parts(spark):
    sales = _sales(spark)
    parts = S.sale_detail(sales, "2024-01-15", "RED", 1, 1)
    assert parts["total"].first().total == 2
    assert [r.order_detail_id for r in parts["page"].collect()] == ["d1"]
    assert S.sale_detail(sales, "2024-01-15", "red", 5, 10)["page"].count() == 0   # page past the end
    g = {r.user_gender: r.pct for r in parts["gender_share"].collect()}
    assert g == {"F": 50.0}                               # missing M bucket is simply absent (0 %)
    a = {r.band: r.pct for r in parts["age_share"].collect()}
    assert a == {"20-29": 50.0, "<20": 50.0}
    assert S.sale_detail(sales, "2024-01-15", "  ", 1, 5)["total"].first().total == 0
    with pytest.raises(ValueError):
        page(sales, 0, 5, "order_detail_id")


def test_percent_rounds_half_up_and_zero_total(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 0)], "c long, t long")
    got = [r.p for r in df.select(S.percent_1dp(F.col("c"), F.col("t")).alias("p")).collect()]
    assert got == [12.5, 33.3, None]


def test_top_terms_and_match_all(spark):
    df = spark.createDataFrame([("a red x",), ("red",), ("x",), (None,)], "t string")
    assert match_all(df, "t", "x red").count() == 1
    assert [tuple(r) for r in top_terms(df, "t", 2).collect()] == [("a red x", 1), ("red", 1)]


def test_bm25_top_ranks_and_drops_non_matches(spark):
    df = spark.createDataFrame([(1, "the cat"), (2, "the the the dog"), (3, "no match here"), (4, "The end of the line")],
                               "id long, text string")
    got = [r.id for r in bm25_top(df, "id", "text", "the", 10).collect()]
    assert got[0] == 2 and 3 not in got and sorted(got) == [1, 2, 4]


def test_dashboard_empty_day_and_bad_metric(spark):
    orders = spark.createDataFrame([("2024-01-15", "01", 5.0)], "create_date string, create_hour string, total_amount double")
    assert D.order_amount(orders, "1999-01-01").first().total_amount is None
    with pytest.raises(ValueError):
        D.realtime_hour("nope", "2024-01-15", orders=orders)
    rows = {r.create_hour: (r.today, r.yesterday) for r in D.realtime_hour("order_amount", "2024-01-16", orders=orders).collect()}
    assert rows == {"01": (None, 5.0)}


def test_users_are_looked_up_per_order(spark):
    """The lines join last: they are not dealt by user. A user that is there twice doubles its orders' rows as before."""
    from martpulse.operators.widen import attach_user, pair_orders, sale_rows, SALE_COLUMNS

    orders = spark.createDataFrame([("o1", "u1", "1", "2024-01-15 10:00:00", "2024-01-15"), ("o2", None, "1", "2024-01-15 10:00:00", "2024-01-15")],
                                   "id string, user_id string, order_status string, create_time string, create_date string")
    lines = spark.createDataFrame([("d1", "o1", "s", "x", "1"), ("d2", "o1", "s", "y", "bad"), ("d3", "o2", "s", "z", "2"), ("d4", "o9", "s", "z", "2")],
                                  "id string, order_id string, sku_id string, sku_name string, order_price string")
    users = spark.createDataFrame([("u1", "gold", "2000-01-01", "M"), ("u1", "vip", "2000-01-01", "M")], "id string, user_level string, birthday string, gender string")
    as_of = F.lit("2021-01-01").cast("date")
    got = sale_rows(orders, lines, users, as_of)
    want = attach_user(pair_orders(orders, lines), users, as_of).select(*SALE_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 5
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert "order_id" in joins[0] and "user_id" in joins[1]
