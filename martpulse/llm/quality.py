"""Operator 3: text quality from random-indexing word vectors and a small network.

Every word falls in one of ``buckets`` hash buckets, which has a sparse random index vector. A bucket's
word vector is the sum of the index vectors of its words' neighbours over the whole corpus (one Spark
aggregation). Documents pool the vectors of their words; a two-layer numpy network, trained on a bounded
sample of labelled documents, scores the pooled vector, and a temperature fitted on held-back sample
rows calibrates the score.

Cases: null or empty text pools to zeros and still gets a score; null labels are not learned from; a
document labelled twice counts once with its lower label; with one class only, or no label at all, the
score is that class's smoothed share (0.5 without labels); very long texts are pooled whole; repeated
rows are scored each; an empty table gives an empty table; extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm.common import SHAPES, PerWorker, Scratch, add_columns, blocks, draw, ship, words


@dataclass(frozen=True)
class Params:
    """``sample`` bounds the labelled documents learned from; ``buckets`` and ``dims`` what the driver holds."""

    buckets: int = 8192
    dims: int = 24
    entries: int = 4  # non-zero entries of an index vector
    reach: int = 2  # neighbours on each side
    sample: int = 6000
    hidden: int = 24
    epochs: int = 80
    common: float = 1e-3  # words rarer than this share weigh more


def index_vectors(p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries by bucket; the same on every machine."""
    rng = np.random.Generator(np.random.PCG64(77))
    place = np.argsort(rng.random((p.buckets, p.dims)), axis=1)[:, :p.entries]
    return place, rng.choice((-1, 1), (p.buckets, p.entries))


def bucket_words(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each word, number or run of signs; upper and lower case differ."""
    row, h, _ = words(data, offsets, SHAPES, lower=False)
    return row, (h % np.uint64(buckets)).astype(np.int64)


def neighbour_sums(p: Params, row: np.ndarray, bucket: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` (buckets x dims) the index vectors of each word's neighbours in its row."""
    place, sign = index_vectors_cached(p)
    for d in range(1, p.reach + 1):
        same = row[d:] == row[:-d]
        left, right = bucket[:-d][same], bucket[d:][same]
        for a, b in ((left, right), (right, left)):
            at = (a[:, None] * p.dims + place[b]).ravel()
            total += np.bincount(at, weights=sign[b].ravel(), minlength=p.buckets * p.dims).astype(np.int64)


_INDEX: dict = {}


def index_vectors_cached(p: Params):
    if p not in _INDEX:
        _INDEX[p] = index_vectors(p)
    return _INDEX[p]


def word_vectors(df: DataFrame, p: Params, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(vectors by bucket, words by bucket), summed over every row of ``df``.

    A task sends at most ``buckets`` rows of whole numbers, so sums don't depend on how rows are dealt.
    """
    dims = [f"c{i}" for i in range(p.dims)]

    def gather(batches):
        total, seen = np.zeros(p.buckets * p.dims, np.int64), np.zeros(p.buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                row, bucket = bucket_words(data, offsets, p.buckets)
                seen += np.bincount(bucket, minlength=p.buckets)
                neighbour_sums(p, row, bucket, total)
        used = np.flatnonzero(seen)
        table = total.reshape(p.buckets, p.dims)[used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(seen[used])] + [pa.array(table[:, i]) for i in range(p.dims)],
            names=["bucket", "n", *dims])

    ddl = "bucket int, n long, " + ", ".join(f"{d} long" for d in dims)
    summed = (df.select(text).mapInArrow(gather, ddl).groupBy("bucket")
              .agg(F.sum("n").alias("n"), *[F.sum(d).alias(d) for d in dims]).toPandas())
    vectors, seen = np.zeros((p.buckets, p.dims)), np.zeros(p.buckets)
    at = summed["bucket"].to_numpy(int)
    vectors[at], seen[at] = summed[dims].to_numpy(float), summed["n"].to_numpy(float)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1), seen


@dataclass
class Pooler:
    """Two pooled means per document: of all words, and with frequent words weighing less."""

    params: Params
    vectors: np.ndarray
    seen: np.ndarray

    def __post_init__(self):
        share = self.seen / max(1.0, self.seen.sum())
        weight = self.params.common / (self.params.common + share)
        self.both = np.hstack([self.vectors, self.vectors * weight[:, None], weight[:, None]]).astype(np.float32)

    @property
    def width(self) -> int:
        return 2 * self.params.dims

    def pool(self, texts: pa.Array) -> np.ndarray:
        d = self.params.dims
        out = np.zeros((len(texts), self.width))
        for i, j, data, offsets in blocks(texts, 1 << 19):
            row, bucket = bucket_words(data, offsets, self.params.buckets)
            if not len(row):
                continue
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            sums = np.add.reduceat(self.both[bucket], first, axis=0, dtype=np.float64)
            count = np.diff(np.r_[first, len(row)])[:, None]
            at = i + row[first]
            out[at, :d] = sums[:, :d] / count
            out[at, d:] = sums[:, d:2 * d] / sums[:, 2 * d:]
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Network:
    """Two layers: tanh units, then one logit, divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def fit_network(x: np.ndarray, y: np.ndarray, p: Params) -> Network:
    """Adam on the cross entropy of four fifths of the rows; the temperature from the last fifth."""
    width = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
                       float(np.log(share / (1 - share))))
    rng = np.random.Generator(np.random.PCG64(5))
    order = rng.permutation(len(y))
    held, fit = order[:len(y) // 5], order[len(y) // 5:]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    net = Network(mean, scale, rng.normal(0, width ** -0.5, (width, p.hidden)), np.zeros(p.hidden),
                  rng.normal(0, p.hidden ** -0.5, p.hidden), 0.0)
    z, t = (x[fit] - mean) / scale, y[fit].astype(float)
    slots = [np.zeros_like(w) for w in (net.w1, net.b1, net.w2, np.zeros(1))]
    second = [np.zeros_like(w) for w in slots]
    b2, step = np.zeros(1), 0
    for _ in range(p.epochs):
        mixed = rng.permutation(len(t))
        for at in range(0, len(t), 128):
            i = mixed[at:at + 128]
            hidden = np.tanh(z[i] @ net.w1 + net.b1)
            err = (sigmoid(hidden @ net.w2 + b2[0]) - t[i]) / len(i)
            back = np.outer(err, net.w2) * (1 - hidden ** 2)
            grads = (z[i].T @ back + 1e-4 * net.w1, back.sum(axis=0), hidden.T @ err + 1e-4 * net.w2, np.array([err.sum()]))
            step += 1
            for k, (w, g) in enumerate(zip((net.w1, net.b1, net.w2, b2), grads, strict=True)):
                slots[k] += 0.1 * (g - slots[k])
                second[k] += 0.001 * (g * g - second[k])
                w -= 0.004 * (slots[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net.b2 = float(b2[0])
    if len(held):
        logit, truth = net.logits(x[held]), y[held]
        grid = np.geomspace(0.25, 8.0, 60)
        loss = [-np.mean(np.log(np.clip(np.where(truth == 1, q := sigmoid(logit / g), 1 - q), 1e-12, 1))) for g in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def bounded_sample(labels: DataFrame, key: str, label: str, size: int) -> DataFrame:
    """At most ``size`` labelled keys (0 or 1), by a hash of the key; a key labelled twice has its lower label."""
    rows = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
            .groupBy(key).agg(F.min(label).alias("label")))
    return draw(rows, size, key)


def labelled_texts(rows: DataFrame, key: str, size: int, scratch: Scratch, *labels: str) -> DataFrame:
    """At most ``size`` rows of (key, text, labels): rows that repeat key and text count once, other texts of one key each."""
    once = rows.groupBy(key, F.xxhash64("text").alias("body")).agg(F.first("text").alias("text"), *[F.first(c).alias(c) for c in labels])
    return draw(scratch.put(once)[0], size, key, "body")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
          label: str = "quality", params: Params = Params()) -> tuple[Pooler, Network]:
    """Word vectors from every row of ``docs``, the network from ``params.sample`` labelled ones.

    The broadcast below holds at most ``params.sample`` pairs of key and label.
    """
    ship(spark)
    pooler = Pooler(params, *word_vectors(docs, params, text))
    sample = bounded_sample(labels, key, label, params.sample)
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key)
    rows = labelled_texts(rows, key, params.sample, Scratch(spark, "quality-sample"), "label")
    got = add_pooled(spark, rows, pooler, "text").select("label", "pooled").toPandas()
    x = np.stack(got["pooled"].to_numpy()) if len(got) else np.zeros((0, pooler.width))
    y = got["label"].to_numpy(int) if len(got) else np.zeros(0, int)
    order = np.lexsort(np.c_[x, y].T) if len(got) else slice(None)  # the same whatever order rows came in
    return pooler, fit_network(x[order], y[order], params)


def add_pooled(spark: SparkSession, df: DataFrame, pooler: Pooler, text: str) -> DataFrame:
    shared = PerWorker(spark, (pooler.params, pooler.vectors.astype(np.float32), pooler.seen), _pooler)

    def run(texts: pa.Array) -> list[pa.Array]:
        x = shared.get().pool(texts)
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))]

    return add_columns(df, text, run, "pooled array<double>")


def _pooler(parts) -> Pooler:
    params, vectors, seen = parts
    return Pooler(params, vectors.astype(float), seen)


def _scorer(parts) -> tuple[Pooler, Network]:
    return _pooler(parts[:3]), parts[3]


def score(spark: SparkSession, df: DataFrame, pooler: Pooler, net: Network, text: str = "text",
          out: str = "score") -> DataFrame:
    """``df`` plus the calibrated probability ``out`` that a document's label is 1."""
    shared = PerWorker(spark, (pooler.params, pooler.vectors.astype(np.float32), pooler.seen, net), _scorer)

    def run(texts: pa.Array) -> list[pa.Array]:
        pool, known = shared.get()
        return [pa.array(known.scores(pool.pool(texts)))]

    return add_columns(df, text, run, f"`{out}` double")
