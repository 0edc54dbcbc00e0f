"""Document and vector joins, and connected components."""

import random

import numpy as np
import pytest

from martpulse.llm import ngram_join, queries, vector_dedup
from martpulse.llm.common import Scratch, components, span_hash

from . import brute

SF = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(None, 3), (7, 7), (5, 6), (6, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b", Scratch(spark, "t")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    keys = sorted({x for e in real for x in e})
    linked = {frozenset(e) for e in real}
    want = dict(zip(keys, brute.classes(keys, lambda i, j: frozenset((keys[i], keys[j])) in linked), strict=True))
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b", Scratch(spark, "t")).count() == 0


def test_components_stop_at_stars(spark):
    # edges that are stars already are written once; no round follows
    scratch = Scratch(spark, "t")
    edges = spark.createDataFrame([(1, 2), (3, 1), (1, 3), (7, 9)], "a long, b long")
    assert {r.node: r.root for r in components(edges, "a", "b", scratch).collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 9: 7}
    assert scratch.n == 1


def near_copies(rng, base, share):
    return " ".join(w if rng.random() > share else f"n{rng.randrange(10**6)}" for w in base.split())


def test_ngram_classes_match_brute_force(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [None, "", "  \n", "one two", "One  TWO", "one two three", "a b c d e", "a b c d e f", "é É é É é"]
    for g in range(6):
        base = " ".join(f"w{g}_{rng.randrange(500)}" for _ in range(rng.randint(20, 300)))
        texts += [near_copies(rng, base, s) for s in (0, 0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.3)]
        texts += [base + " " + passage, passage + " " + " ".join(f"q{g}_{i}" for i in range(40))]
    base = " ".join(f"h{i}" for i in range(80))
    texts += [near_copies(rng, base, 0.02) for _ in range(60)] + [passage] * 5 + ["x " * 30_000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    got = {r.doc_id: r for r in ngram_join.classes(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    sets = [brute.grams(t) for t in texts]
    want = brute.classes(ids, lambda i, j: brute.similar(sets[i], sets[j]))
    assert {i: got[i].component_id for i in ids} == dict(zip(ids, want, strict=True))
    assert {i: got[i].n_shingles for i in ids} == {i: len(s) for i, s in zip(ids, sets, strict=True)}


def test_ngram_bounds_are_exact(spark):
    # similarity of exactly 0.8 links, just below it doesn't
    base = [f"w{i}" for i in range(14)]  # 10 n-grams
    a, b = " ".join(base), " ".join(base[:12])  # 8 of 10
    c = " ".join(base[:11])  # 7 of 10 with a, 7 of 8 with b
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {r.component_id for r in ngram_join.classes(spark, df).collect()} == {1}
    df = spark.createDataFrame([(1, a), (3, c)], "doc_id long, text string")
    assert {r.component_id for r in ngram_join.classes(spark, df).collect()} == {1, 3}


def test_long_words_that_differ_are_two_classes(spark):
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = []
    for k, n in enumerate((1024, 2048, 4096)):
        rows += [(10 * k, word[:n]), (10 * k + 1, word[:n].translate(str.maketrans("ab", "ba"))), (10 * k + 2, word[:n].upper())]
    got = {r.doc_id: r.component_id for r in ngram_join.classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i if i % 10 < 2 else i - 2 for i, _ in rows}


def test_span_hashes_follow_the_bytes():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 60_000).astype(np.uint8)
    starts = rng.integers(0, 50_000, 4000)
    ends = starts + rng.choice([0, 1, 7, 8, 9, 16, 511, 512, 513, 1024, 5000], 4000)
    raw = data.tobytes()
    by_hash, by_bytes = {}, {}
    for h, a, b in zip(span_hash(data, starts, ends).tolist(), starts.tolist(), ends.tolist(), strict=True):
        by_hash.setdefault(h, set()).add(raw[a:b])
        by_bytes.setdefault(raw[a:b], set()).add(h)
    assert all(len(x) == 1 for x in by_hash.values()) and all(len(x) == 1 for x in by_bytes.values())


def test_ngram_keep_one(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(5, long, "a"), (2, long + " z", "b"), (9, long, "c"), (2, long + " z", "b"), (2, "quite another text of seven words", "d"),
            (7, None, "e"), (8, None, "f"), (None, long, "g"), (11, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    out = ngram_join.keep_one(spark, docs)
    assert out.columns == docs.columns
    assert sorted((r.node for r in out.collect())) == ["b", "d", "e", "f", "g", "h"]
    assert ngram_join.keep_one(spark, docs.limit(0)).count() == 0


def test_ngram_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sets = [brute.grams(r.text) for r in rows]
    want = brute.classes([r.doc_id for r in rows], lambda i, j: brute.similar(sets[i], sets[j]))
    got = {r.doc_id: r.component_id for r in queries.QUERIES["op7_ngram_join"](spark, SF).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, want, strict=True)}


def vectors(rng):
    """A group of near copies, chains near the bound, exact copies, and unrelated vectors."""
    out = []
    for k in range(3):
        c = rng.normal(size=24)
        out += [c + rng.normal(size=24) * 0.05 for _ in range(40)] + [c * (k + 1)] * 3
        out += [c + rng.normal(size=24) * 0.35 for _ in range(10)]
    return out + list(rng.normal(size=(60, 24)))


@pytest.mark.parametrize("block", [1024, 16])
def test_vector_classes(spark, monkeypatch, block):
    rng = np.random.default_rng(4)
    x = np.array(vectors(rng), dtype=np.float32)
    rows = [(i, v.tolist(), int(i % 5 == 0)) for i, v in enumerate(x)]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 24, 1), (1003, [float("nan")] + [1.0] * 23, 1), (1004, x[0].tolist(), None),
           (1005, [None] + [1.0] * 23, 1), (None, x[0].tolist(), 1), (1006, [1.0, 2.0], 1), (1007, [float("inf")] * 24, 1), (0, x[0].tolist(), 1)]
    made = vector_dedup.plan
    monkeypatch.setattr(vector_dedup, "plan", lambda *a: vector_dedup.Plan(**{**made(*a).__dict__, "block": block}))
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = vector_dedup.classes(spark, df).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.vec_id: r for r in got}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = np.arange(len(x)) % 5 == 0
    links = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(links, False)
    found = np.array([by[i].n_links for i in range(len(x))])
    assert (found <= links.sum(axis=1)).all() and found.sum() >= 0.99 * links.sum()
    for i in range(1000, 1008):
        assert (by[i].n_links, by[i].component_id) == (0, i)
    assert (by[None].n_links, by[None].component_id) == (0, None)
    want = brute.classes(list(range(len(x))), lambda i, j: links[i, j])
    assert sum(by[i].component_id != w for i, w in enumerate(want)) <= 0.01 * len(x)
    assert vector_dedup.classes(spark, df.limit(0)).count() == 0


def test_vector_recall_at_the_bound():
    # pairs exactly at the bound: the plan's recall holds for the hardest links
    rng = np.random.default_rng(8)
    p = vector_dedup.plan(5000)
    a = vector_dedup.unit(rng.normal(size=(1500, 64)))
    side = rng.normal(size=(1500, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    b = 0.931 * a + np.sqrt(1 - 0.931 ** 2) * vector_dedup.unit(side)
    (ha, ca), (hb, cb) = vector_dedup.place(a, p), vector_dedup.place(b, p)
    found = (ca == cb).any(axis=1) & ((np.abs(ha - hb) <= p.window).sum(axis=1) >= p.least)
    assert found.mean() >= 0.997


def test_vector_links_are_complete(spark):
    # pairs just above the bound, and chains of them: no link is left to chance, no chain falls apart
    rng = np.random.default_rng(17)
    dim, chains = 64, 400
    angle = np.arccos(0.9301)
    a = vector_dedup.unit(rng.normal(size=(chains, dim)))
    side = rng.normal(size=(chains, dim))
    side = vector_dedup.unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    x = np.concatenate([np.cos(k * angle) * a + np.sin(k * angle) * side for k in range(5)])  # k links with k - 1 and k + 1
    want = (x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    assert want.sum() == 8 * chains
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.classes(spark, df).collect()}
    assert got == {i: (int(want[i].sum()), i % chains) for i in range(len(x))}


@pytest.mark.parametrize("dim", [1, 2, 5, 24, 200])
def test_vector_windows_lose_no_pair(dim):
    rng = np.random.default_rng(dim)
    p = vector_dedup.plan(5000, 0.93, dim)
    a = vector_dedup.unit(rng.normal(size=(3000, dim)))
    b = vector_dedup.unit(a + 0.4 * rng.normal(size=a.shape) / np.sqrt(dim))
    b[:50] = a[:50]
    close = (a * b).sum(axis=1) >= 0.93
    assert close.sum() > 100
    (ha, _), (hb, _) = vector_dedup.place(a, p), vector_dedup.place(b, p)
    assert ((np.abs(ha - hb) <= p.window).sum(axis=1) >= p.least)[close].all()


def test_vector_collisions_match_plain_count():
    rng = np.random.default_rng(2)
    h, g = rng.normal(size=(30, 7)), rng.normal(size=(50, 7))
    want = (np.abs(h[:, None] - g[None]) <= 0.6).sum(axis=2)
    assert (vector_dedup.collisions(h, g, 0.6) == want).all()


def test_vector_query(spark):
    got = queries.QUERIES["op10_vector_dedup"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
