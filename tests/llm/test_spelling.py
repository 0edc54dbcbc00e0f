"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

from martpulse.llm import spelling
from martpulse.llm.common import Scratch

from . import brute


def brute_words(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows):
    n = brute_words(rows)
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def varied(rng, w):
    at, kind = rng.randrange(len(w)), rng.randrange(3)
    c = rng.choice("abcdeéßÿ×")
    return w[:at] + (c if kind < 2 else "") + w[at + (kind != 1):]


def made(rng, size):
    base = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(5, 9))) for _ in range(40)] + ["aaaaa", "ababab"]
    pool = base * 8 + [varied(rng, w) for w in base * 3] + [varied(rng, varied(rng, w)) for w in base * 2]
    return [(i, " ".join(rng.choice(pool).title() if rng.random() < 0.2 else rng.choice(pool) for _ in range(60)) + ", x1y;") for i in range(size)]


def rows_of(out):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out.collect()}


def test_variants_match_brute_force(spark):
    rng = random.Random(3)
    rows = made(rng, 120) + [(None, "colour colour color " * 9), (500, None), (501, ""), (502, "Q" * 3000 + " " + "q" * 3000 + " " + "q" * 2999), (502, "q" * 3000),
                             (503, "  . 12 "), (7, "again again again"), (7, "again again again")]
    df = spark.createDataFrame([(i, t, "w", 3) for i, t in rows], "doc_id long, text string, word string, n int").repartition(5)
    want = brute_variants(rows)
    assert rows_of(spelling.variants(spark, df)) == want
    # every signature is hot: words meet by their halves only
    assert rows_of(spelling.variants(spark, df, params=spelling.Params(hot=1))) == want
    assert rows_of(spelling.variants(spark, df, params=spelling.Params(parts=7))) == want
    assert spelling.variants(spark, df.limit(0)).count() == 0


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(61)] + [(f"h{i}", "w00") for i in range(500)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string"), Scratch(spark, "t")).collect()}
    assert got == {w: "w61" for w, _ in forms}
