"""Rollups with retractions, bitmaps over spans, typed logs, and lookups pinned to a version."""

import json
import random

import pytest
from pyspark.sql import functions as F

from martpulse.operators.bitmaps import extend_dictionary, merged, period_bitmaps, rolling
from martpulse.operators.rollup import compact_rollup, read_rollup, rollup_batch
from martpulse.operators.route import route_logs_typed
from martpulse.operators.upsert import compact, current, upsert_batch
from martpulse.streaming import jobs as J


def test_rollup_follows_updates_moves_and_replays(spark, scratch):
    rng = random.Random(2)
    table, rollup = f"{scratch}/orders", f"{scratch}/hours"
    state = {}
    for n in range(5):
        rows = {}
        for _ in range(30):
            k = f"o{rng.randrange(40)}"
            rows[k] = (k, rng.choice(["d1", "d2"]), rng.choice(["01", "02"]), rng.choice([None, 1.1, 2.25, 1e9, 0.0]), rng.randrange(3) + n)
        df = spark.createDataFrame(list(rows.values()), "id string, create_date string, create_hour string, total_amount double, v int")
        for _ in range(2 if n in (0, 3) else 1):   # batches 0 and 3 are replayed
            rollup_batch(df, n, table, rollup, "id", ["create_date", "create_hour"], "total_amount", "v")
        for k, r in rows.items():
            if k not in state or r[4] >= state[k][4]:
                state[k] = r
        if n == 2:
            compact(spark, table, "id", "v", upto=n)
            compact_rollup(spark, rollup, ["create_date", "create_hour"], upto=n)
    want = {}
    for _, d, h, x, _ in state.values():
        n, total = want.get((d, h), (0, 0.0))
        want[d, h] = (n + 1, total + (x or 0.0))
    got = {(r.create_date, r.create_hour): (r.n, float(r.amount)) for r in read_rollup(spark, rollup, ["create_date", "create_hour"]).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-6)


def test_bitmaps_count_spans_exactly(spark):
    rng = random.Random(8)
    rows = [(f"2024-01-{rng.randint(1, 20):02d}", f"m{rng.randrange(300) if rng.random() < 0.6 else 7}") for _ in range(2000)] + [("2024-01-05", None)]
    df = spark.createDataFrame(rows, "day string, mid string").where("day <> '2024-01-09'")
    rows = [r for r in rows if r[0] != "2024-01-09"]
    early = df.where("day < '2024-01-08'")
    first = extend_dictionary(early, "mid", parts=8)
    both = first.unionByName(extend_dictionary(df, "mid", first, parts=8)).cache()
    numbers = [r.number for r in both.collect()]
    assert len(numbers) == len(set(numbers)) == len({m for _, m in rows if m}) and max(numbers) < 8 * 300
    bits = period_bitmaps(df, "mid", "day", both)
    bits = bits.unionByName(bits)   # a replayed batch
    got = {r.day: r.n for r in rolling(bits, "day", 7).collect()}
    for day in {d for d, _ in rows}:
        span = {f"2024-01-{k:02d}" for k in range(int(day[-2:]) - 6, int(day[-2:]) + 1)}
        assert got[day] == len({m for d, m in rows if d in span and m})
    assert got.keys() == {d for d, _ in rows}
    assert merged(bits).first().n == len(set(numbers))
    assert merged(bits.limit(0)).first().n == 0


def test_typed_logs_keep_their_types(spark):
    logs = ['{"type":"startup","uid":12,"deep":{"a":[1,2,{"b":null}]},"ok":true,"share":1.5,"big":12345678901234567890,"ts":"x"}',
            '{"type":"order","n":null}', '{"type":5}', "{}", '{"a":1', "[1,2]", '"text"', "null", "", None, '{"a":1,"a":2}', '{"Type":"startup","type":"event"}']
    df = spark.createDataFrame(list(enumerate(logs)), "i int, value string")
    got = {r.i: r for r in route_logs_typed(df, stamp=F.lit("1700000000000"), keep=("i",)).collect()}
    assert json.loads(got[0].value) == {"type": "startup", "uid": 12, "deep": {"a": [1, 2, {"b": None}]}, "ok": True, "share": 1.5,
                                        "big": 12345678901234567890, "ts": 1700000000000}
    assert [got[i].topic for i in range(4)] == ["startup", "event", "event", "event"]
    assert json.loads(got[1].value) == {"type": "order", "n": None, "ts": 1700000000000} and json.loads(got[3].value) == {"ts": 1700000000000}
    assert all(got[i].topic is None and got[i].value is None for i in range(4, 11))
    assert got[11].topic == "event" and json.loads(got[11].value)["Type"] == "startup"


def test_replay_looks_up_the_state_it_saw_first(spark, scratch):
    users, pins = f"{scratch}/users", f"{scratch}/_pins"
    put = lambda n, level: upsert_batch(spark.createDataFrame([("u1", level, n)], "id string, user_level string, seq long"), n, users, "id", "seq")
    assert J.pinned(spark, pins, 0, users) is None
    put(0, "a")
    assert J.pinned(spark, pins, 0, users) is None   # a replay of batch 0
    assert J.pinned(spark, pins, 1, users) == 0
    put(1, "b")
    compact(spark, users, "id", "seq", upto=1)
    put(2, "c")

    def seen(n):
        return current(spark, users, "id", "seq", upto=J.pinned(spark, pins, n, users)).first().user_level

    assert seen(1) == "a" and seen(2) == "c"
    put(3, "d")
    compact(spark, users, "id", "seq", upto=3)
    assert seen(2) == "c" and seen(3) == "d"
    with pytest.raises(FileNotFoundError):   # older than the snapshot before the newest: gone, and said so
        current(spark, users, "id", "seq", upto=0)
