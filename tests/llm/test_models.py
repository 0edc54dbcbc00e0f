"""Quality, toxicity and language models."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martpulse.llm import langid, quality, queries, toxicity
from martpulse.llm.common import SHAPES, SPACE_SEP, blocks, fold_of, words

SF = "/root/testdata/sf0.01"


def test_blocks_and_words_cover_every_row():
    texts = ["The cat  SAT\n on", None, "", " x", "x cat the", "Ünï x", "y" * 5000]
    seen = [(i, j) for i, j, _, _ in blocks(pa.array(texts), 10)]
    assert [i for i, _ in seen] == [0, *[j for _, j in seen[:-1]]] and seen[-1][1] == len(texts)
    for limit in (1, 10, 1 << 20):
        got = {}
        for i, _, data, offsets in blocks(pa.array(texts), limit):
            row, h, _ = words(data, offsets, SPACE_SEP)
            for r, x in zip(row, h, strict=True):
                got.setdefault(int(r) + i, []).append(int(x))
        assert {k: len(v) for k, v in got.items()} == {k: len((t or "").split()) for k, t in enumerate(texts) if (t or "").split()}
        assert got[0][0] == got[4][2] and got[0][1] == got[4][1] and got[3][0] == got[5][1]
    row, h, n = words(np.frombuffer(b"ab,,cd ef", np.uint8), np.array([0, 9]), SHAPES)
    assert len(h) == 4 and n[0] == 4


def test_fold_is_crc32_of_the_id_as_text(spark):
    import zlib

    got = spark.range(50).select("id", fold_of("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_quality_held_out(spark):
    got = queries.QUERIES["op3_quality"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.quality for r in got])
    kept = np.mean([r.predicted for r in got if r.quality == 1])
    assert right >= 0.95 and kept >= 0.98 and all(0 <= r.score <= 1 for r in got)


def test_quality_neighbour_sums_match_plain_loops():
    p = quality.Params(buckets=16, dims=6, entries=2)
    place, sign = quality.index_vectors(p)
    rng = np.random.default_rng(1)
    row, bucket = np.sort(rng.integers(0, 5, 40)), rng.integers(0, 16, 40)
    want = np.zeros((16, 6), np.int64)
    for a in range(40):
        for b in range(40):
            if a != b and row[a] == row[b] and abs(a - b) <= p.reach:
                for k, s in zip(place[bucket[b]], sign[bucket[b]], strict=True):
                    want[bucket[a], k] += s
    total = np.zeros(16 * 6, np.int64)
    quality.neighbour_sums(p, row, bucket, total)
    assert (total.reshape(16, 6) == want).all()


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "word " * 20_000, 0.5), (3, "a b", 0.5), (None, "c", 0.5)],
                                 "doc_id long, text string, score double")
    for rows, share in (([], 0.5), ([(1, 1), (3, 1), (2, None)], 3.5 / 4)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        pooler, net = quality.train(spark, docs, labels)
        got = quality.score(spark, docs, pooler, net).collect()
        assert len(got) == 5 and all(abs(r.score - share) < 1e-9 for r in got)
    assert quality.score(spark, docs.limit(0), pooler, net).count() == 0


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.train(spark, docs, labels.where(fold_of("doc_id", 4) != 0))
    got = toxicity.score(spark, docs, chain).join(labels.where(fold_of("doc_id", 4) == 0), "doc_id").collect()
    caught = np.mean([r.is_toxic for r in got if r.toxic])
    wrong = np.mean([r.is_toxic for r in got if not r.toxic])
    assert caught >= 0.8 and wrong <= 0.005, (caught, wrong)
    assert all(0 <= r.p_toxic <= 1 for r in got)


def test_toxicity_without_arrow_in_the_session(spark):
    """Rows then reach the driver as lists; the result is the same."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    with_arrow = toxicity.train(spark, docs, labels)
    before = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        without = toxicity.train(spark, docs, labels)
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", before)
    assert sum(m is not None for m in without.models) > 0
    for a, b in zip(with_arrow.models, without.models, strict=True):
        assert (a is None) == (b is None) and (a is None or (a[0] == b[0]).all() and np.allclose(a[1], b[1]))


def test_toxicity_query(spark):
    got = queries.QUERIES["op8_toxicity"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.score == r.p_toxic for r in got) and 0 < sum(r.toxic for r in got) < len(got)


def plain_logistic(x, y, ridge):
    a, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    penalty = np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(60):
        q = 1 / (1 + np.exp(-a @ w))
        step = np.linalg.solve((a * np.maximum(q * (1 - q), 1e-6)[:, None]).T @ a + np.diag(penalty), a.T @ (q - y) + penalty * w)
        w -= step * min(1.0, 5.0 / np.abs(step).max())
    return w


def plain_chain(sets, targets, fold, p):
    """Probabilities of every document by the chain, with plain loops; ``sets``: each document's word hashes."""
    n, earlier, final = len(sets), np.zeros((len(sets), 0)), np.zeros((len(sets), 0))

    def matrix(inside, y):
        counts = {}
        for i in np.flatnonzero(inside).tolist():
            for h in sets[i]:
                c = counts.setdefault(h, [0, 0])
                c[0] += 1
                c[1] += y[i]
        m, share = inside.sum(), y[inside].mean()
        gains = {h: (b - a * share) ** 2 / (a * share * (1 - share) * (1 - a / m) + 1e-9) for h, (a, b) in counts.items() if b >= 2 * share * a}
        best = sorted(gains, key=lambda h: (-gains[h], h))[:p.features]
        words = sorted(h for h in best if gains[h] > 10.8)
        return np.array([[float(h in s) for h in words] for s in sets]).reshape(n, len(words))

    for y in targets.T:
        known, out = ~np.isnan(y), np.zeros(n)
        for k in range(p.folds):
            inside = known & (fold != k)
            x = np.c_[matrix(inside, y), earlier]
            out[fold == k] = (1 / (1 + np.exp(-np.c_[x, np.ones(n)] @ plain_logistic(x[inside], y[inside], p.ridge))))[fold == k]
        words = matrix(known, y)
        w = plain_logistic(np.c_[words, earlier][known], y[known], p.ridge)
        final = np.c_[final, 1 / (1 + np.exp(-np.c_[words, final, np.ones(n)] @ w))]
        earlier = np.c_[earlier, out]
    return final, earlier


def test_toxicity_chain_matches_plain_loops():
    rng = np.random.default_rng(6)
    n, p = 400, toxicity.Params(features=12, least_positives=5)
    targets = np.stack([rng.random(n) < 0.3, rng.random(n) < 0.2], axis=1).astype(float)
    targets[:, 1] = np.maximum(targets[:, 1], (targets[:, 0] == 1) & (rng.random(n) < 0.4))
    texts = []
    for i in range(n):
        words = [f"w{rng.integers(0, 60)}" for _ in range(25)]
        words += ["junk"] * int(targets[i, 0] == 1 and rng.random() < 0.7) + ["vile"] * int(targets[i, 1] == 1 and rng.random() < 0.6)
        texts.append(" ".join(words))
    targets[rng.random(n) < 0.2, 0] = np.nan
    fold = rng.integers(0, p.folds, n)
    docs, hits = (np.concatenate(c) for c in zip(*toxicity.document_words(pa.array(texts)), strict=True))
    chain = toxicity.fit_chain(docs, hits, targets, fold, p)
    sets = [set(hits[docs == i].tolist()) for i in range(n)]
    want, _ = plain_chain(sets, targets, fold, p)
    assert np.allclose(chain.predict(pa.array(texts)), want, atol=1e-3)
    # the second model has a weight for the first category
    assert len(chain.models[1][1]) == len(chain.models[1][0]) + 2


def test_toxicity_repeated_labelled_rows_count_once(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    once = toxicity.train(spark, docs, labels)
    again = toxicity.train(spark, docs.unionByName(docs), labels.unionByName(labels))
    for a, b in zip(once.models, again.models, strict=True):
        assert (a is None) == (b is None) and (a is None or ((a[0] == b[0]).all() and np.allclose(a[1], b[1])))


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "idiot " * 30_000, "c"), (3, "x", "d"), (None, "y", "e")],
                                 "doc_id long, text string, p_toxic string")
    for rows in ([], [(1, 0), (3, 1), (3, 0), (2, None)]):
        chain = toxicity.train(spark, docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert [r.is_toxic for r in toxicity.score(spark, docs, chain).collect()] == [False] * 5
        kept = toxicity.reject(spark, docs, chain)
        assert kept.columns == docs.columns and kept.count() == 5
    assert toxicity.score(spark, docs.limit(0), chain).count() == 0


def segmentations(word, number):
    if not word:
        return [[]]
    return [[word[:k], *rest] for k in range(1, len(word) + 1) if word[:k] in number for rest in segmentations(word[k:], number)]


def test_language_forward_sums_all_segmentations():
    rng = random.Random(4)
    pieces = ["a", "b", "ab", "ba", "aba", "bb", "▁", "▁a"]
    root = langid.trie(pieces)
    number = {p: i for i, p in enumerate(pieces)}
    probs = [[rng.random() for _ in pieces] + [langid.STRAY] for _ in range(3)]
    for word in ("▁abab", "▁bba", "▁a", "▁ababbab"):
        got = langid.forward(word, root, probs)
        uses = langid.expected(word, root, probs[0])
        for k, p in enumerate(probs):
            parts = [np.prod([p[number[x]] for x in s]) for s in segmentations(word, number)]
            assert abs(got[k] - np.log(sum(parts))) < 1e-9
        weights = [np.prod([probs[0][number[x]] for x in s]) for s in segmentations(word, number)]
        want = sum(w * len(s) for w, s in zip(weights, segmentations(word, number), strict=True)) / sum(weights)
        assert abs(sum(e for _, e in uses) - want) < 1e-9


def test_language_held_out(spark):
    got = queries.QUERIES["op5_language"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.99 and all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark):
    rows = [(1, "the house and the tree", "en"), (2, "das Haus und der Baum", "de"), (3, "the cat", None), (4, None, "en"), (5, "12 ! ²", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(spark, df, queries.PIECE_VOCABULARY)
    ask = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "123 ²!", 3), (4, "der Baum", 4), (4, "the tree " * 50_000, 5), (None, "中" + "x" * 500, 6)],
                                "doc_id long, text string, score long")
    got = [(r.lang_pred, r.score) for r in langid.predict(spark, ask, model).collect()]
    assert [g[0] for g in got[:5]] == ["und", "und", "und", "de", "en"] and got[5][0] in ("de", "en")
    assert [g[1] for g in got[:3]] == [0.0] * 3 and all(0 <= g[1] <= 1 for g in got)
    assert langid.predict(spark, ask.limit(0), model).count() == 0
    empty = langid.train(spark, df.where(F.lit(False)), queries.PIECE_VOCABULARY)
    assert {r.lang_pred for r in langid.predict(spark, ask, empty).collect()} == {"und"}


def test_long_runs_are_neither_cut_nor_lost(monkeypatch):
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "bab"]
    root, rng = langid.trie(pieces), random.Random(8)
    probs = [[rng.random() / 9 for _ in pieces] + [langid.STRAY] for _ in range(3)]

    def plain(word, p):
        """The same sum in exact numbers."""
        from fractions import Fraction
        ways = [Fraction(1)] + [Fraction(0)] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - 3), end):
                part = word[start:end]
                if part in pieces:
                    ways[end] += ways[start] * Fraction(p[pieces.index(part)])
                elif end == start + 1:
                    ways[end] += ways[start] * Fraction(p[-1])
        return math.log(ways[-1].numerator) - math.log(ways[-1].denominator)

    words = ["▁" + "".join(rng.choice("aabbx") for _ in range(n)) for n in (1, 63, 64, 65, 66, 130, 300)] + ["▁" + "x" * 36 + "bbb"]
    want = [[plain(w, p) for p in probs] for w in words]
    got = langid.forward_rows(words, root, langid.logs(probs))
    assert np.allclose(got, want, rtol=1e-12, atol=1e-9)
    assert np.allclose([langid.forward_run(w, root, langid.logs(probs)) for w in words], want, rtol=1e-12, atol=1e-9)
    monkeypatch.setattr(langid, "RUN_CHARS", 100)
    assert np.allclose(langid.forward_rows(words, root, langid.logs(probs)), want, rtol=1e-12, atol=1e-9)
    model = langid.LanguageModel(["x", "y", "z"], pieces, probs)
    assert np.allclose(model.word_rows(words), want, rtol=1e-12, atol=1e-9) and len(model.cache) == 3
    # a language in which "b" is likelier wins behind any number of strays
    louder = [list(probs[0]), list(probs[0])]
    louder[1][pieces.index("b")] *= 10
    assert langid.LanguageModel(["p", "q"], pieces, louder).predict("x" * 3000 + "bbb")[0] == "q"
    uses = langid.expected(words[5], root, probs[0])
    assert all(0 <= e <= 1 + 1e-9 for _, e in uses)
