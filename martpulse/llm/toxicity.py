"""Operator 8: toxicity categories by a classifier chain.

One linear model per category, in a fixed order: ``low_quality`` and ``toxic``, each a column of the labels. Each
model sees the document's words and the probabilities of the earlier categories; in training these are out-of-fold
predictions, so a later model learns how far it can trust them. A fold's words are picked without its labels.

Cases: null or empty text has no words and scores as such a document does; null labels aren't learned
from (a document may have a label of one category only); a document labelled twice counts once with its higher
label, and rows that repeat a labelled id and text are learned from once; a category with fewer than
``least_positives`` labelled documents gets probability 0 and no say in later models; without any toxic
label nothing is toxic; very long texts are scored whole; repeated rows are scored each; an empty table
gives an empty table; extra columns pass through (those named like the output are replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm.common import PUNCT_SEP, PerWorker, Scratch, add_columns, blocks, draw, mix, span_hash, word_bounds
from martpulse.llm.quality import labelled_texts, sigmoid

#: Categories in the chain's order; the last one decides.
CATEGORIES = ("low_quality", "toxic")


@dataclass(frozen=True)
class Params:
    """``sample`` bounds the labelled documents learned from, ``features`` the words per model."""

    candidates: int = 1000  # words that the driver gets for a category and choice of folds, the most telling ones
    sample: int = 12_000
    features: int = 300
    folds: int = 4
    ridge: float = 0.03
    least_positives: int = 20
    least_documents: int = 6  # rarer words aren't features


#: Bytes of the word beginnings that are features beside whole words: inflected forms share them.
BEGINNINGS = (4, 5)


def document_words(texts: pa.Array, wanted: "Wanted | None" = None):
    """(row, hash) of the distinct words of each row and of their beginnings, ordered; with ``wanted``, of those alone."""
    for i, _, data, offsets in blocks(texts):
        if not len(data):
            continue
        starts, ends = word_bounds(data, offsets, PUNCT_SEP)
        row = np.searchsorted(offsets, starts, side="right") - 1 + i
        rows, hashes = [row], [span_hash(data, starts, ends)]
        for size in BEGINNINGS:
            more = ends - starts > size
            rows.append(row[more])
            hashes.append(mix(span_hash(data, starts[more], starts[more] + size) + np.uint64(size)))
        row, h = np.concatenate(rows), np.concatenate(hashes).view(np.int64)
        if wanted is not None:
            keep = wanted.maybe[h & 0xFFFF]
            row, h = row[keep], h[keep]
            keep = wanted.hashes[np.minimum(np.searchsorted(wanted.hashes, h), len(wanted.hashes) - 1)] == h if len(wanted.hashes) else keep[keep]
            row, h = row[keep], h[keep]
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        yield row[new], h[new]


class Wanted:
    """A set of hashes, and which low 16 bits occur in it."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hashes & 0xFFFF] = True


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept.

    Equal rows (most documents hold none of the words) are fitted as one row with their number.
    """
    a = np.c_[x, np.ones(len(x))]
    order = np.lexsort((y, x @ np.random.Generator(np.random.PCG64(3)).random(x.shape[1]))) if x.shape[1] else np.argsort(y, kind="stable")
    a, t = a[order], y[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]).any(axis=1) | (t[1:] != t[:-1])])
    times = np.diff(np.r_[first, len(t)]).astype(float)
    a, t = a[first], t[first]
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        q = sigmoid(a @ w)
        grad = a.T @ (times * (q - t)) + penalty * w
        hess = (a * (times * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ a
        hess[np.diag_indices_from(hess)] += penalty
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / np.abs(step).max())
        if np.abs(step).max() < 1e-4:
            break
    return w


def telling_words(hits: np.ndarray, docs: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Hashes that at least double the share of the class and tell most of it (chi-squared), in order.

    Frequent words only follow a document's length; the doubling keeps them out.
    """
    words, which = np.unique(hits, return_inverse=True)
    total = np.bincount(which, minlength=len(words)).astype(float)
    with_pos = np.bincount(which, weights=y[docs], minlength=len(words))
    share = y.mean()
    spread = total * share * (1 - share) * (1 - total / max(1, len(y))) + 1e-9
    gain = (with_pos - total * share) ** 2 / spread
    gain[with_pos < 2 * share * total] = 0
    best = np.lexsort((words, -gain))[:most]
    return np.sort(words[best[gain[best] > 10.8]])  # one in a thousand by chance


@dataclass
class Chain:
    """By category: feature hashes and weights (words, earlier categories, intercept), or None."""

    params: Params
    models: list[tuple[np.ndarray, np.ndarray] | None]
    threshold: float = 0.5  # of the last category, from its out-of-fold predictions

    def __post_init__(self):
        self.wanted = Wanted(np.concatenate([np.zeros(0, np.int64), *[m[0] for m in self.models if m is not None]]))
        self.weights = np.zeros((len(self.models), len(self.wanted.hashes)))
        for c, m in enumerate(self.models):
            if m is not None:
                self.weights[c, np.searchsorted(self.wanted.hashes, m[0])] = m[1][:len(m[0])]

    def predict(self, texts: pa.Array) -> np.ndarray:
        """Probabilities, rows by categories."""
        n = len(texts)
        sums = np.zeros((n, len(self.models)))
        for row, h in document_words(texts, self.wanted):
            at = np.searchsorted(self.wanted.hashes, h)
            for c in range(len(self.models)):
                sums[:, c] += np.bincount(row, weights=self.weights[c, at], minlength=n)
        probs = np.zeros_like(sums)
        for c, m in enumerate(self.models):
            if m is not None:
                rest = m[1][len(m[0]):]
                probs[:, c] = sigmoid(sums[:, c] + probs[:, :c] @ rest[:-1] + rest[-1])
        return probs


def fit_chain(docs: np.ndarray, hits: np.ndarray, targets: np.ndarray, fold: np.ndarray, p: Params) -> Chain:
    """``docs``, ``hits``: (document, word hash) pairs; ``targets``: documents by categories, 0, 1 or NaN (no label)."""
    n = len(targets)
    earlier = np.zeros((n, 0))
    models: list[tuple[np.ndarray, np.ndarray] | None] = []
    threshold = 0.5
    for y in targets.T:
        known = ~np.isnan(y)
        out_of_fold = np.zeros(n)
        if not p.least_positives <= y[known].sum() < known.sum():
            models.append(None)
            earlier = np.c_[earlier, out_of_fold]
            continue
        for k in range(p.folds):
            inside = known & (fold != k)
            x, _ = features(docs, hits, inside, y, earlier, p)
            w = fit_linear(x[inside], y[inside], p.ridge)
            out_of_fold[fold == k] = sigmoid(np.c_[x, np.ones(n)][fold == k] @ w)
        x, picked = features(docs, hits, known, y, earlier, p)
        models.append((picked, fit_linear(x[known], y[known], p.ridge)))
        earlier = np.c_[earlier, out_of_fold]
        threshold = best_threshold(out_of_fold[known], y[known])
    return Chain(p, models, threshold if models and models[-1] is not None else 0.5)


def features(docs: np.ndarray, hits: np.ndarray, inside: np.ndarray, y: np.ndarray, earlier: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(words of all documents beside earlier probabilities, the words' hashes), picked by the labels ``inside``."""
    own = inside[docs]
    place = np.cumsum(inside) - 1
    picked = telling_words(hits[own], place[docs[own]], y[inside], p.features)
    return np.c_[presence(docs, hits, picked, len(y)), earlier], picked


def best_threshold(q: np.ndarray, y: np.ndarray, precision: float = 0.995) -> float:
    """The lowest cut that keeps the precision; if none does, that of the highest F-score that weighs precision twice."""
    grid = np.linspace(0.2, 0.95, 76)
    hit = np.array([(q >= cut) @ y for cut in grid])
    taken = np.array([(q >= cut).sum() for cut in grid])
    good = np.flatnonzero((taken > 0) & (hit >= precision * taken))
    if len(good):
        return float(grid[good[0]])
    return float(grid[np.argmax(1.25 * hit / np.maximum(1e-9, 0.25 * y.sum() + taken))])


def presence(docs: np.ndarray, hits: np.ndarray, picked: np.ndarray, n: int) -> np.ndarray:
    x = np.zeros((n, len(picked)))
    if len(picked):
        at = np.searchsorted(picked, hits)
        at[at == len(picked)] = 0
        found = picked[at] == hits
        x[docs[found], at[found]] = 1.0
    return x


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
          low_quality: str = "quality", toxic: str = "toxic", params: Params = Params()) -> Chain:
    """Learn from at most ``params.sample`` labelled documents, drawn by a hash of the key.

    The broadcast holds at most that many keys and labels. Spark counts the sample's words by category and fold;
    for each category, over all folds and without each of them, the driver gets the ``params.candidates`` most telling
    words and where they occur. So a fold's own labels have no part in what is picked for it.
    """
    marks = [F.lit(1) - (F.col(low_quality) if low_quality in labels.columns else F.lit(None)), F.col(toxic)]
    known = (labels.select(key, *[F.when(m.isin(0, 1), m.cast("double")).alias(c) for c, m in zip(CATEGORIES, marks, strict=True)])
             .where(F.col(key).isNotNull() & F.col(CATEGORIES[-1]).isNotNull()).groupBy(key).agg(*[F.max(c).alias(c) for c in CATEGORIES]))
    sample = draw(known, params.sample, key)
    scratch = Scratch(spark, "toxicity")
    rows = labelled_texts(docs.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key), key, params.sample, scratch, *CATEGORIES)
    rows = rows.withColumn("fold", F.pmod(F.xxhash64(key), F.lit(params.folds)).cast("int"))

    def run(texts: pa.Array) -> list[pa.Array]:
        parts = list(document_words(texts))
        row = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in parts]])
        off = np.searchsorted(row, np.arange(len(texts) + 1))
        hits = np.concatenate([np.zeros(0, np.int64), *[h for _, h in parts]])
        return [pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(hits))]

    held, path = scratch.put(add_columns(rows, "text", run, "hits array<long>").select(key, "body", *CATEGORIES, "fold", "hits"))
    # sizes and counts of words, by category and left-out fold (the last: none left out)
    cases = [(c, k) for c in CATEGORIES for k in range(params.folds + 1)]

    def sums(prefix: str) -> list:
        out = []
        for i, (c, k) in enumerate(cases):
            here = F.col(c).isNotNull() & (F.col("fold") != k)
            out += [F.count(F.when(here, 1)).alias(f"{prefix}n{i}"), F.coalesce(F.sum(F.when(here, F.col(c))), F.lit(0.0)).alias(f"{prefix}p{i}")]
        return out

    size = held.agg(*sums("all_")).first()
    if not size[f"all_p{len(cases) - 1}"]:
        return Chain(params, [None] * len(CATEGORIES))
    counted = (held.select(*CATEGORIES, "fold", F.explode("hits").alias("hit")).groupBy("hit")
               .agg(F.count(F.lit(1)).alias("documents"), *sums("")).where(F.col("documents") >= params.least_documents))
    counted, counted_path = scratch.put(counted)
    wanted: set[int] = set()
    for i in range(len(cases)):
        all_n, all_p = size[f"all_n{i}"], size[f"all_p{i}"]
        if not 0 < all_p < all_n:
            continue
        share, n, pos = all_p / all_n, F.col(f"n{i}"), F.col(f"p{i}")
        gain = (pos - n * share) ** 2 / (n * share * (1 - share) * (1 - n / all_n) + 1e-9)
        best = counted.where((n > 0) & (pos >= 2 * share * n)).orderBy(gain.desc(), "hit").limit(params.candidates)
        wanted.update(r.hit for r in best.select("hit").collect())
    few, _ = scratch.put(spark.createDataFrame([(h,) for h in sorted(wanted)], "hit long"))
    found = held.select(key, "body", F.explode("hits").alias("hit")).join(F.broadcast(few), "hit").groupBy(key, "body").agg(F.collect_list("hit").alias("hits"))
    got = held.select(key, "body", *CATEGORIES, "fold").join(found, [key, "body"], "left").toArrow().sort_by([(key, "ascending"), ("body", "ascending")])
    scratch.drop(path, counted_path)
    lists = got.column("hits").combine_chunks()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    targets = np.stack([got.column(c).to_numpy() for c in CATEGORIES], axis=1).astype(float)
    return fit_chain(np.repeat(np.arange(got.num_rows), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), targets,
                     got.column("fold").to_numpy(), params)


def score(spark: SparkSession, df: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``df`` plus ``p_low_quality``, ``p_toxic`` and the decision ``is_toxic``."""
    shared = PerWorker(spark, chain, _same)

    def run(texts: pa.Array) -> list[pa.Array]:
        known = shared.get()
        probs = known.predict(texts)
        return [pa.array(probs[:, c]) for c in range(probs.shape[1])] + [pa.array(probs[:, -1] >= known.threshold)]

    return add_columns(df, text, run, ", ".join(f"p_{c} double" for c in CATEGORIES) + ", is_toxic boolean")


def reject(spark: SparkSession, df: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The rows of ``df`` that aren't toxic, with their columns unchanged."""
    shared, schema = PerWorker(spark, chain, _same), df.schema

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                known = shared.get()
                probs = known.predict(batch.column(text))
                yield batch.filter(pa.array(probs[:, -1] < known.threshold))

    return df.mapInArrow(run, schema)


def _same(chain: Chain) -> Chain:
    return chain
