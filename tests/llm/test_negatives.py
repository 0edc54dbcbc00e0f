"""Hard negatives against a brute-force version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martpulse.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, same int"


def brute_mine(rows, k=5):
    sound = {(i, l, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, l, *_ in rows
             if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for a, label, q in sound:
        if a % 100:
            continue
        others = [(sum(x * y for x, y in zip(q, v, strict=True)), i, l) for i, l, v in sound if i != a and len(v) == len(q)]
        others.sort(key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in others if r[2] == label][:k]:
            window = [r for r in others if r[2] != label and 80 * ps <= 100 * r[0] <= 100 * ps][:k]
            out |= {(a, p, n + 1, i, ps, s) for n, (s, i, _) in enumerate(window)}
    return out


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(map(tuple, negatives.mine(spark, df, F.col("vec_id") % 100 == 0, **kw).collect()))


def made(rng):
    centres = rng.normal(size=(4, 16))
    rows = [(i, (centres[i % 4] * rng.uniform(0.5, 1) + rng.normal(size=16) * 0.3).astype(np.float32).tolist(), int(rng.integers(0, 3)), 0) for i in range(600)]
    rows += [(1000 + i, rows[0][1], i % 2, 1) for i in range(60)]  # copies and ties
    rows += [rows[5], rows[5], rows[100]]  # repeated rows
    rows += [(700, None, 1, 0), (701, [None] + [1.0] * 15, 1, 0), (702, [float("nan")] * 16, 1, 0), (703, [float("inf")] * 16, 1, 0), (704, rows[1][1], None, 0),
             (None, rows[1][1], 1, 0), (800, [1.0, 2.0], 1, 0), (801, [1.0, 2.0], 1, 0), (802, [1.0, 1.5], 0, 0), (900, [], 1, 0), (901, [], 1, 0), (902, [], 2, 0),
             (1100, [0.0] * 16, 1, 0), (1200, [-1.0, -1.0, 0.5], 1, 0), (1201, [1.0, 1.0, 1.0], 1, 0), (1202, [1.0, 1.0, 0.5], 0, 0)]
    return rows


def test_mining_matches_brute_force(spark):
    rows = made(np.random.default_rng(2))
    want = sorted(brute_mine(rows))
    assert len(want) > 100
    assert mined(spark, rows) == want
    # several passes, and a look at the bounds after every dimension
    assert mined(spark, rows, params=negatives.Params(anchor_bytes=600, step=1)) == want
    assert mined(spark, []) == []


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * 50_000).astype(np.float32).tolist(), i % 2, 0) for i in range(150)]
    rows += [(300, [1e30] * 8, 0, 0)]  # scores beyond 64 bits: takes no part
    assert mined(spark, rows) == sorted(brute_mine(rows[:-1]))


@pytest.mark.parametrize("step", [1, 3, 64])
def test_scan_prunes_but_never_loses(step):
    rng = np.random.default_rng(9)
    v = rng.integers(-90, 90, (800, 24))
    v[:200] = v[0]
    block = negatives.Block(np.arange(800), np.array(["a", "b"] * 400, object), np.arange(800), v)
    for q in rng.integers(-90, 90, (10, 24)):
        best = negatives.Best(5)
        negatives.add_positives(block, best, q, 4, "a", step)
        want = sorted(((-int(q @ v[i]), i) for i in range(800) if i % 2 == 0 and i != 4))[:5]
        assert [(-s, k) for s, k in zip(best.score.tolist(), best.key.tolist(), strict=True)] == want
    seen = []

    def needed(least, greatest):
        seen.append(len(least))
        return greatest >= np.sort(least)[-5]

    block.search(np.r_[np.full(4, 200), np.full(20, 1)], np.arange(800), needed, 4)
    assert seen[0] == 800 and seen[-1] < 400
