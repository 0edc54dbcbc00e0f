"""Inverted index, word boundaries and facets."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from martpulse.functions.text import unicode_words
from martpulse.operators.search import facets, match_all
from martpulse.operators.textindex import bucket_of, compact_index, index_batch, postings_of, search_index


@pytest.mark.parametrize("text, want", [
    ("小米手机", ["小", "米", "手", "机"]), ("iPhone手机 Pro", ["iphone", "手", "机", "pro"]), ("カタカナ と ひら", ["カタカナ", "と", "ひ", "ら"]),
    ("ภาษาไทย ดี", ["ภาษาไทย", "ดี"]), ("don't rock’n’roll 'quoted'", ["don't", "rock’n’roll", "quoted"]), ("3.5 1,000 v1.2 a.b a. b", ["3.5", "1,000", "v1.2", "a.b", "a", "b"]),
    ("é café नमस्ते", ["é", "café", "नमस्ते"]), ("한국어 단어", ["한국어", "단어"]), ("", []), (None, None), ("--- ,,,", []), ("red plate", ["red", "plate"])])
def test_unicode_words(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(unicode_words("t").alias("w")).first().w
    assert got == want


def test_search_matches_inside_han_runs(spark):
    df = spark.createDataFrame([(1, "小米手机"), (2, "手 电 机"), (3, "手表"), (4, None)], "id int, t string")
    assert {r.id for r in match_all(df, "t", "手机", unicode_words).collect()} == {1, 2}
    assert match_all(df, "t", " ,", unicode_words).count() == 0


def test_facets_count_in_one_pass(spark):
    rows = [("F", 20), ("F", 31), ("M", 20), (None, 20), ("M", None)]
    df = spark.createDataFrame(rows, "gender string, age int")
    got = facets(df, {"gender": "gender", "age": F.col("age")})
    assert {(r.facet, r.name): (r.n, r.total) for r in got.collect()} == {
        ("total", "total"): (5, 5), ("gender", "F"): (2, 5), ("gender", "M"): (2, 5), ("age", "20"): (3, 5), ("age", "31"): (1, 5)}
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1
    none = facets(df.where("age > 99"), {"gender": "gender", "age": "age"}).collect()
    assert [(r.facet, r.name, r.n, r.total) for r in none] == [("total", "total", 0, 0)]


def brute_search(docs, day, query, page_no, size):
    words = {k: re.findall(r"\w+", t.lower()) for k, (_, t) in docs.items()}
    n, average = len(words), sum(map(len, words.values())) / len(words)
    out = []
    for k, ws in words.items():
        if docs[k][0] != day or not all(q in ws for q in query):
            continue
        score = 0.0
        for q in dict.fromkeys(query):   # a word twice in the query counts once
            d, f = sum(q in x for x in words.values()), ws.count(q)
            score += math.log(1 + (n - d + 0.5) / (d + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(ws) / average))
        out.append((k, round(score, 6)))
    out.sort(key=lambda r: (-r[1], r[0]))
    return out[(page_no - 1) * size:page_no * size]


def test_index_follows_updates_replays_and_compaction(spark, scratch):
    rng = random.Random(5)
    vocabulary = ["red", "blue", "plate", "cup", "old", "tin", "lid"]
    made = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6)))
    docs, path = {}, f"{scratch}/index"

    def check(*queries):
        for q in queries:
            got = [(r.key, r.score) for r in search_index(spark, path, "d1", q, 1, 1000).orderBy(F.desc("score"), "key").collect()]
            want = brute_search(docs, "d1", q.split(), 1, 1000)
            assert [k for k, _ in got] == [k for k, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-6)

    for n in range(4):
        batch = {f"k{rng.randrange(40):02d}": (rng.choice(["d1", "d1", "d2"]), made()) for _ in range(25)}
        same = {k: docs[k] for k in list(docs)[:5]}   # written again as they are
        batch.update(same)
        df = spark.createDataFrame([(k, d, t) for k, (d, t) in batch.items()], "id string, day string, name string")
        index_batch(df, n, path, "id", "name", "day")
        if n == 2:
            index_batch(df, n, path, "id", "name", "day")   # a replay
            compact_index(spark, path, 1)
        docs.update(batch)
        if n in (0, 2, 3):
            check("red", "blue cup")
    check("red red plate", "missing")
    assert search_index(spark, path, "d1", " - ", 1, 5).count() == 0
    assert search_index(spark, path, "d1", "red", 2, 3).count() <= 3


def test_search_reads_the_buckets_of_its_words_only(spark, scratch):
    names = [(f"k{i}", "d1", f"red word{i} plate") for i in range(200)]
    index_batch(spark.createDataFrame(names, "id string, day string, name string"), 0, f"{scratch}/ix", "id", "name", "day")
    own = spark.range(1).select(bucket_of(F.lit("red"))).first()[0]
    found = postings_of(spark, f"{scratch}/ix", ["red"])
    assert found.count() == 200
    scan = next(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert re.search(rf"PartitionFilters: \[.*bucket.*{own}", scan)
    assert "PushedFilters" in scan and "word" in scan.split("PushedFilters")[1]


def test_names_of_a_day_are_those_of_all_lines(spark, scratch):
    """An order and a line that are there twice, a null key and another day; the products join the day's lines only."""
    from martpulse.sources import standins as SI
    from martpulse.streaming.twins import _names_of_day

    day = "TIMESTAMP_NTZ '2024-01-02 00:00:00'"
    spark.sql(f"""SELECT * FROM VALUES (1L, 1L, 'O', 1.0D, {day}), (2L, 1L, 'O', 1.0D, {day}), (2L, 1L, 'O', 1.0D, {day}), (NULL, 1L, 'O', 1.0D, {day}),
      (3L, 1L, 'O', 1.0D, {day} + INTERVAL 1 DAY) AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate)""").write.parquet(f"{scratch}/orders.parquet")
    spark.sql(f"""SELECT *, 1.0D AS l_extendedprice, {day} AS l_shipdate FROM VALUES (1L, 1, 7L, 1L), (1L, 1, 7L, 1L), (2L, 1, 8L, 1L), (3L, 1, 8L, 1L), (NULL, 1, 8L, 1L),
      (1L, 2, 9L, 1L) AS t(l_orderkey, l_linenumber, l_partkey, l_suppkey)""").write.parquet(f"{scratch}/lineitem.parquet")
    spark.sql("SELECT * FROM VALUES (7L, 'red box'), (8L, 'old pen') AS t(p_partkey, p_name)").write.parquet(f"{scratch}/part.parquet")
    o, d = SI.order_info(spark, scratch), SI.order_detail(spark, scratch)
    names = d.join(o.select(F.col("id").alias("order_id"), F.col("create_date").alias("dt")), "order_id")
    want = names.where(F.col("dt") == "2024-01-02").select(F.col("id").alias("order_detail_id"), "sku_name")
    got = _names_of_day(spark, scratch, "2024-01-02")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 4


def test_a_batch_is_indexed_from_its_own_folder(spark, scratch, monkeypatch):
    """The first batch reads no former state and sums no postings up: nothing can cancel out."""
    from martpulse.operators import textindex as X

    calls = []
    for name in ("net", "current"):
        monkeypatch.setattr(X, name, lambda *a, f=getattr(X, name), n=name, **k: calls.append(n) or f(*a, **k))
    df = spark.createDataFrame([("a", "red red box", "1"), ("b", None, "1"), ("c", "box", "2")], "id string, name string, dt string")
    X.index_batch(df, 0, f"{scratch}/i", "id", "name", "dt")
    assert calls == []
    got = {(r.word, r.key, r.tf, r["size"]) for r in X.postings_of(spark, f"{scratch}/i", ["red", "box"]).collect()}
    assert got == {("red", "a", 2, 3), ("box", "a", 1, 3), ("box", "c", 1, 1)}
