"""Late-match join with a refreshed expiry against a brute-force cache, over micro-batches with a hot key and replays."""

import random

from pyspark.sql import functions as F

from martpulse.operators.pending import pair_pending
from martpulse.sources.paths import matching
from martpulse.streaming import jobs as J
from martpulse.streaming import twins as T

ORDER, LINE = "order_id string, status string", "order_id string, order_detail_id string, price int"


class Cache:
    """The expiring cache in plain Python: one time per order, one per order's set of lines."""

    def __init__(self, ttl):
        self.ttl, self.orders, self.lines = ttl, {}, {}

    def batch(self, clock, orders, lines):
        out = set()
        pending = {k: dict(rows) for k, (at, rows) in self.lines.items() if clock - at < self.ttl}
        known = {k: s for k, (at, s) in self.orders.items() if clock - at < self.ttl}
        here = dict(orders)
        for k, d, p in lines:
            if k in here:
                out.add((k, here[k], d, p))
            elif k in known:
                out.add((k, known[k], d, p))
        sent = {(k, d) for k, d, _ in lines}
        for k, s in here.items():
            out |= {(k, s, d, p) for d, p in pending.get(k, {}).items() if (k, d) not in sent}
            self.orders[k] = (clock, s)
        for k in {k for k, _, _ in lines} - here.keys():
            rows = pending.get(k, {})
            rows.update({d: p for x, d, p in lines if x == k})
            self.lines[k] = (clock, rows)
        return out


def test_pending_pairs_match_a_plain_cache(spark, scratch):
    rng = random.Random(4)
    cache, clock, replays = Cache(300), 1_000, 0
    for n in range(10):
        clock += rng.choice([60, 100, 150, 299, 300, 301])
        orders = [(f"o{k}", f"s{n}") for k in rng.sample(range(12), 3)] + ([("hot", f"s{n}")] if n in (4, 8) else [])
        lines = [(f"o{rng.randrange(12)}", f"d{n}_{i}", i) for i in range(6)] + [("hot", f"h{n}_{i}", i) for i in range(20)]
        lines += [("o1", "again", n)]   # one line written in every batch
        o = spark.createDataFrame(orders + [(None, "x")], ORDER)
        d = spark.createDataFrame(lines + [(None, "y", 1)], LINE)
        want = cache.batch(clock, orders, lines)
        for _ in range(2 if n % 4 == 3 else 1):   # some batches are replayed after all their writes
            got = pair_pending(o, d, f"{scratch}/state", n, clock, f"{scratch}/out/{n}", wheel=50)
            assert sorted((r.order_id, r.status, r.order_detail_id, r.price) for r in got.collect()) == sorted(want), n
    # expired epochs are gone: what is left is about one expiry's length
    epochs = {p.split("epoch=")[1].split("/")[0] for p in matching(spark, f"{scratch}/state/lines/epoch=*")}
    assert min(map(int, epochs)) >= (clock - 300) // 50 - 1


def test_a_replay_keeps_its_clock(spark, scratch):
    times = iter([100, 200, 300])
    assert J.remembered(spark, f"{scratch}/clocks", 0, lambda: next(times)) == 100
    assert J.remembered(spark, f"{scratch}/clocks", 0, lambda: next(times)) == 100
    assert J.remembered(spark, f"{scratch}/clocks", 1, lambda: next(times)) == 200


def test_repeated_rows_count_once_and_one_clock_may_hold_many_batches(spark, scratch):
    """Rows that come twice or differ under one key, a pending line sent anew, lines that move within a second."""
    batches = [([], [("o1", "d1", 1), ("o1", "d1", 1), ("o2", "e", 1), ("o2", "e", 2), ("o3", "f", 1)]),
               ([("o3", "a"), ("o3", "a"), ("o3", "b")], [("o1", "d2", 1), ("o2", "e", 7)]),
               ([("o1", "a"), ("o2", "a")], [("o3", "g", 1), ("o3", "g", 2)])]
    seen = []
    for n, (orders, lines) in enumerate(batches):
        o, d = spark.createDataFrame(orders, ORDER), spark.createDataFrame(lines, LINE)
        runs = [pair_pending(o, d, f"{scratch}/state", n, 1_000, f"{scratch}/out/{n}",
                             widen=lambda df: df.withColumn("level", F.upper("status"))).collect() for _ in range(2)]
        assert sorted(runs[0]) == sorted(runs[1])   # a replay
        assert runs[0] == [] or runs[0][0].__fields__ == ["order_id", "status", "level", "order_detail_id", "price"]
        assert all(r.level == r.status.upper() for r in runs[0])
        seen.append(sorted((r.order_id, r.order_detail_id, r.price) for r in runs[0]))
    assert seen[0] == [] and seen[1] == [("o3", "f", 1)]
    assert seen[2][:3] == [("o1", "d1", 1), ("o1", "d2", 1), ("o2", "e", 7)]
    assert [x[:2] for x in seen[2][3:]] == [("o3", "g")]   # with the pending order, once


def test_rows_of_all_steps_are_made_once(spark, scratch):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = spark.createDataFrame([(i, i % 4) for i in range(40)] + [(99, None), (98, 7)], "id long, step int")   # no row in step 4
    seen = []

    def job(stream):
        def write(df, _):
            seen.append(sorted(r.id for r in df.collect()))
        return J._start(stream.writeStream.foreachBatch(write), f"{scratch}/ckpt", True)

    T._in_steps({f"{scratch}/in": rows.mapInPandas(count, rows.schema)}, 5, job)
    assert [x for x in seen if x] == [list(range(k, 40, 4)) for k in range(4)]
    assert made.value == 42   # it was 42 per step
