"""Fingerprints against a brute-force version, and what sketches promise."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from martpulse.llm import sketch

from . import brute

P = sketch.Params()


def hashes(text):
    return {hashlib.md5(" ".join(g).encode()).hexdigest()[:15] for g in brute.grams(text)}


def brute_sketch(text):
    every = sorted(hashes(text))
    low = [h for h in every if int(h, 16) <= P.top]
    return (low, False) if len(low) >= P.least else (every[:P.least], len(every) <= P.least)


def brute_string(text):
    kept, whole = brute_sketch(text)
    return ("all:" if whole else "low:") + ",".join(kept)


def brute_near(a, b):
    (x, wx), (y, wy) = brute_sketch(a), brute_sketch(b)
    if not x and not y:
        return 1.0
    ends = [16**15 if w else max(P.top, int(h[-1], 16)) for h, w in ((x, wx), (y, wy))]
    x, y = ({h for h in s if int(h, 16) <= min(ends)} for s in (x, y))
    return len(x & y) / min(len(x), len(y)) if x and y else 0.0


def made(rng):
    out = []
    for i in range(60):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.choice([0, 1, 3, 5, 9, 40, 300, 2500]))]
        out.append((i * 7 % 61, " ".join(words)))
    return out + [(100, "Ü é x 𝒳𝒳 " * 30), (101, None), (102, "  \t "), (103, out[6][1]), (104, "a" * 100_000), (105, "short"), (None, "no id here at all")]


def test_report_matches_brute_force(spark):
    rows = made(random.Random(1))
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, sketch string, words int").repartition(6)
    got = {r.doc_id: r for r in sketch.report(spark, df).collect()}
    assert len(got) == len(rows)
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0]) + [r for r in rows if r[0] is None]
    for k, (i, text) in enumerate(order):
        t, u = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        changed = t[:len(t) - cut] + u[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (brute_string(t), brute_string(changed))
        assert r.near_edited == pytest.approx(brute_near(t, changed)) and r.near_next == pytest.approx(brute_near(t, u))
        assert 0 <= r.jaccard_edited <= r.near_edited <= 1


def test_repeated_rows_and_single_documents(spark):
    schema = "doc_id long, text string"
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(1, text), (1, text), (2, text + " end"), (2, text + " end"), (2, "another text of this id"), (3, text)]
    out = sketch.report(spark, spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.doc_id for r in out) == [1, 1, 2, 2, 2, 3]
    assert len({tuple(r) for r in out if r.doc_id == 1}) == 1
    only = sketch.report(spark, spark.createDataFrame([(5, text)], schema)).collect()
    assert [(r.doc_id, r.near_next) for r in only] == [(5, 1.0)]
    assert sketch.report(spark, spark.createDataFrame([], schema)).count() == 0


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(30_000)]
    long, part, other = " ".join(words), " ".join(words[5000:6500]), " ".join(words[20_000:20_900] + [f"x{i}" for i in range(900)])
    tiny = " ".join(words[:12])
    rows = [(long, part), (long, other), (long, tiny), (part, other), (tiny, tiny), ("", tiny), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    df = sketch.with_sketch(sketch.with_sketch(df, "a", "sa"), "b", "sb")
    # n-grams across the seam belong to neither text, so the union is that of the sets
    got = df.select("a", "b", sketch.as_string(sketch.merge(F.col("sa"), F.col("sb"))).alias("m"),
                    sketch.containment(F.col("sa"), F.col("sb")).alias("c"), sketch.jaccard(F.col("sa"), F.col("sb")).alias("j")).collect()
    for r in got:
        x, y = brute.grams(r.a), brute.grams(r.b)
        both = sorted(hashes(r.a) | hashes(r.b))
        low = [h for h in both if int(h, 16) <= P.top]
        want = low if len(low) >= P.least else both[:P.least]
        assert r.m.split(":")[1] == ",".join(want)
        if x and y and min(len(x), len(y)) > 100:
            assert r.c == pytest.approx(len(x & y) / min(len(x), len(y)), abs=0.12)
            assert r.j == pytest.approx(len(x & y) / len(x | y), abs=0.05)
    assert [r.c for r in got][4:] == [1.0, 0.0, 1.0]


def test_new_column_replaces_one_of_its_name(spark):
    df = spark.createDataFrame([("a b c", 1, "x")], "text string, sketch int, hashes string")
    out = sketch.with_sketch(df, "text", "sketch")
    assert sorted(out.columns) == ["hashes", "sketch", "text"] and out.first().hashes == "x" and out.first().sketch.whole
