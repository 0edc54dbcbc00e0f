"""Operator 11: hard negatives by a vertical scan with branch and bound (BOND).

Vectors become whole numbers, so scores are exact. A task holds a block of rows by dimension, with the least
and the greatest value of each. For an anchor it reads the dimensions in descending order of the anchor's own
values: after a few of them, what the rest can add at least and at most bounds every row's score, and rows that
can't be among the wanted ones leave the candidate set, until the exact scores of the few left decide.

A first scan finds each anchor's positives (best rows of its label), a second one, per positive, the best rows
of other labels whose score lies in its window. Each task keeps no more than the wanted number of rows per anchor
(and window) over all its blocks; Spark ranks what the tasks found. Anchors are broadcast by passes of at most
``anchor_bytes``: every row is scanned against every anchor of a pass, and no pair is written out.

Cases: rows with a null id, label or vector, with a null or non-finite component, or so long that scores leave
64 bits (squared length of 2**55 or more) take no part; vectors of different length aren't compared (empty ones
score 0 with each other); rows that repeat id, label and vector count once, other rows of one id each for
themselves, but never with an anchor of that id; ties go to the smaller id; an anchor without positives, and a
positive without negatives, give no row; an empty table gives an empty table; other columns are ignored. Ids are
whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martpulse.llm.common import PerWorker, Scratch

#: Squared lengths from here on are no longer certain to give scores that a long holds after a product with 100.
TOO_LONG = 2.0 ** 55
#: Whole numbers below this are exact in doubles.
EXACT = 2.0 ** 53


@dataclass(frozen=True)
class Params:
    positives: int = 5
    negatives: int = 5
    low: int = 80  # a negative's score is at least so many hundredths of the positive's
    high: int = 100
    scale: int = 256
    step: int = 8  # dimensions read between two looks at the bounds
    anchor_bytes: int = 16 << 20  # anchors that one broadcast holds


def quantised(df: DataFrame, key: str, vector: str, label: Column, anchor: Column, p: Params) -> DataFrame:
    """(key, label, is_anchor, same, v): the rows that take part; ``same`` is equal for repeated rows."""
    x = F.transform(vector, lambda c: F.floor(p.scale * c.cast("double")).cast("double"))
    sound = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    length = F.aggregate(x, F.lit(0.0), lambda a, c: a + c * c)
    rows = df.where(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull()).where(sound).where(length < TOO_LONG)
    v = F.transform(x, lambda c: c.cast("long"))
    return rows.select(F.col(key).cast("long").alias("key"), label.cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
                       F.xxhash64(label, v).alias("same"), v.alias("v"))


class Block:
    """Rows of one length, held by dimension."""

    def __init__(self, key: np.ndarray, label: np.ndarray, same: np.ndarray, v: np.ndarray):
        if len(np.unique(key)) < len(key):  # repeated rows would fill the places of others
            first = np.unique(np.stack([key, same]), axis=1, return_index=True)[1]
            key, label, same, v = key[first], label[first], same[first], v[first]
        self.key, self.label, self.same = key, label, same
        most = float(np.abs(v).max(initial=0))
        self.columns = np.ascontiguousarray(v.T)
        self.low, self.high = self.columns.min(axis=1, initial=2**62), self.columns.max(axis=1, initial=-2**62)
        self.most = most
        self.doubles = self.columns.astype(np.float64)

    def search(self, q: np.ndarray, rows: np.ndarray, needed, step: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows left, their exact scores). ``needed(least, greatest)`` tells which rows are still wanted."""
        exact = self.most * float(np.abs(q).max(initial=0)) * len(q) < EXACT
        columns, kind = (self.doubles, np.float64) if exact else (self.columns, np.int64)
        low, high, q = self.low.astype(kind), self.high.astype(kind), q.astype(kind)
        order = np.argsort(-np.abs(q), kind="stable")
        at_low, at_high = q[order] * low[order], q[order] * high[order]
        rest_least = np.r_[np.cumsum(np.minimum(at_low, at_high)[::-1])[::-1], kind(0)]
        rest_most = np.r_[np.cumsum(np.maximum(at_low, at_high)[::-1])[::-1], kind(0)]
        part = np.zeros(len(rows), kind)
        for i in range(0, len(q), step):
            d = order[i:i + step]
            part += q[d] @ (columns[d] if len(rows) == len(self.key) else columns[np.ix_(d, rows)])
            end = min(i + step, len(q))
            keep = needed(part + rest_least[end], part + rest_most[end])
            if not keep.all():
                rows, part = rows[keep], part[keep]
            if not len(rows):
                break
        return rows, part.astype(np.int64)


class Best:
    """The ``k`` best (score, then smaller key) distinct rows seen so far."""

    __slots__ = ("k", "score", "key", "same")

    def __init__(self, k: int):
        self.k = k
        self.score = self.key = self.same = np.zeros(0, np.int64)

    def floor(self):
        """A row below this score is not wanted."""
        return self.score[self.k - 1] if len(self.score) >= self.k else None

    def add(self, score: np.ndarray, key: np.ndarray, same: np.ndarray) -> None:
        if len(score) > self.k:  # rows of a block are distinct, so its k-th score bounds them
            some = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, key, same = score[some], key[some], same[some]
        score, key, same = np.r_[self.score, score], np.r_[self.key, key], np.r_[self.same, same]
        order = np.lexsort((same, key, -score))
        key, same = key[order], same[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (same[1:] != same[:-1])
        self.score, self.key, self.same = score[order][new][:self.k], key[new][:self.k], same[new][:self.k]


def _largest(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def add_positives(block: Block, best: Best, q: np.ndarray, key: int, label: str, step: int) -> None:
    """Best rows of the anchor's own label."""
    def needed(least, greatest):
        bounds = [b for b in (best.floor(), _largest(least, best.k) if len(least) > best.k else None) if b is not None]
        return greatest >= max(bounds) if bounds else np.ones(len(least), bool)

    rows, score = block.search(q, np.flatnonzero((block.label == label) & (block.key != key)), needed, step)
    best.add(score, block.key[rows], block.same[rows])


def add_negatives(block: Block, best: dict[int, Best], q: np.ndarray, key: int, label: str, p: Params) -> None:
    """Best rows of other labels in the window of each positive score (the keys of ``best``)."""
    windows = [(-(-p.low * s // 100), p.high * s // 100, b) for s, b in best.items()]

    def needed(least, greatest):
        keep = np.zeros(len(least), bool)
        for low, high, b in windows:
            bound = low if b.floor() is None else max(low, b.floor())
            inside = least[(least >= low) & (greatest <= high)]
            if len(inside) >= b.k:
                bound = max(bound, _largest(inside, b.k))
            keep |= (greatest >= bound) & (least <= high)
        return keep

    rows, score = block.search(q, np.flatnonzero((block.label != label) & (block.key != key)), needed, p.step)
    for low, high, b in windows:
        some = (score >= low) & (score <= high)
        b.add(score[some], block.key[rows[some]], block.same[rows[some]])


def by_length(batch: pa.RecordBatch):
    """(positions, matrix) of the rows of each vector length in a batch with a column ``v``."""
    v = batch.column("v")
    sizes = v.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        flat = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, flat.astype(np.int64).reshape(len(at), dim)


def blocks_of(batch: pa.RecordBatch):
    key, same = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "same"))
    label = batch.column("label").to_numpy(zero_copy_only=False)
    for at, v in by_length(batch):
        yield v.shape[1], Block(key[at], label[at], same[at], v)


def _scan(rows: DataFrame, anchors: PerWorker, p: Params) -> DataFrame:
    """(aid, window, score, key, same): each task's best rows. Without windows: positives, window null."""
    schema = "aid long, window long, score long, key long, same long"

    def run(batches):
        known = anchors.get()
        best = [Best(p.positives) if a["windows"] is None else {s: Best(p.negatives) for s in a["windows"]} for a in known]
        by_dim: dict[int, list[int]] = {}
        for i, a in enumerate(known):
            by_dim.setdefault(len(a["q"]), []).append(i)
        for batch in batches:
            for dim, block in blocks_of(batch):
                for i in by_dim.get(dim, ()):
                    a = known[i]
                    if a["windows"] is None:
                        add_positives(block, best[i], a["q"], a["key"], a["label"], p.step)
                    elif a["windows"]:
                        add_negatives(block, best[i], a["q"], a["key"], a["label"], p)
        found = [(a["aid"], w, b) for a, of in zip(known, best, strict=True)
                 for w, b in ([(None, of)] if a["windows"] is None else of.items()) if len(b.score)]
        for i in range(0, len(found), 4096):
            part = found[i:i + 4096]
            times = [len(b.score) for _, _, b in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([a for a, _, _ in part], times), pa.int64()),
                 pa.array([w for (_, w, _), n in zip(part, times, strict=True) for _ in range(n)], pa.int64())]
                + [pa.array(np.concatenate([getattr(b, c) for _, _, b in part])) for c in ("score", "key", "same")],
                names=["aid", "window", "score", "key", "same"])

    return rows.select("key", "label", "same", "v").mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct rows of each (aid, window) over what all tasks found."""
    order = Window.partitionBy("aid", "window").orderBy(F.desc("score"), "key", "same")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(spark: SparkSession, df: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding",
         label: Column | str = "label", params: Params = Params()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds."""
    p, scratch = params, Scratch(spark, "negatives")
    rows, _ = scratch.put(quantised(df, key, vector, F.col(label) if isinstance(label, str) else label, anchor, p))
    anchors = rows.where("is_anchor").groupBy("key", "same").agg(F.first("label").alias("label"), F.first("v").alias("v"))
    anchors, _ = scratch.put(anchors)
    total = anchors.agg(F.coalesce(F.sum(F.size("v") * 8 + 64), F.lit(0))).first()[0]
    passes = max(1, -(-total // p.anchor_bytes))
    out = None
    for n in range(passes):
        mine_now = anchors.where(F.pmod(F.xxhash64("key", "same"), F.lit(passes)) == n).toArrow()
        known = [{"aid": n + i * passes, "key": k, "label": l, "q": np.array(v, np.int64), "windows": None} for i, (k, l, v) in
                 enumerate(zip(*(mine_now.column(c).to_pylist() for c in ("key", "label", "v")), strict=True))]
        holder = PerWorker(spark, known, list)
        positives, _ = scratch.put(_ranked(_scan(rows, holder, p), p.positives).select("aid", "key", "score"))
        holder.drop()
        # negative positives have an empty window
        windows: dict[int, set] = {}
        for r in positives.where("score >= 0").select("aid", "score").distinct().toLocalIterator():
            windows.setdefault(r.aid, set()).add(r.score)
        known = [{**a, "windows": sorted(windows.get(a["aid"], ()), reverse=True)} for a in known]
        holder = PerWorker(spark, known, list)
        negatives, _ = scratch.put(_ranked(_scan(rows, holder, p), p.negatives))
        holder.drop()
        ids = spark.createDataFrame([(a["aid"], a["key"]) for a in known], "aid long, anchor_id long")
        pairs = positives.join(ids, "aid").select("aid", "anchor_id", F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
        part = (negatives.select("aid", F.col("window").alias("positive_score"), "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
                .join(pairs, ["aid", "positive_score"]))
        out = part if out is None else out.unionByName(part)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
