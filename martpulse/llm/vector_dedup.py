"""Operator 10: near-duplicate vectors by collision-counting projections, without a miss.

Unit vectors are projected on orthonormal lines (the first lines of a random rotation). On each line the vectors
are sorted, and a window of fixed width around each query counts as a collision for the vectors in it. A pair at the
cosine bound or closer is at most d = sqrt(2 - 2 * cosine) apart, and its squared differences on orthonormal lines
add up to no more than d * d: it leaves a window of d / sqrt(t + 1) on at most t lines. So every pair to be linked
collides on all lines but t, whatever the data (``plan``); unrelated vectors rarely do. Pairs with so many collisions
are verified by their cosine in double precision. Nothing is left to chance: no link is lost.

A label is dealt at random into blocks, and each pair of its blocks is a task's group of its own, compared tile by
tile: memory follows ``block`` and ``TILE``, the work the square of a label's size, spread over the block pairs. A
task sends one row per vector of a group (its links and a vector of its class there), never the pairs.

Cases: null labels, and vectors that are null, empty, zero or hold null or non-finite parts, link with
nothing; vectors of different length don't link; equal vectors of a label are one node with their number;
rows that repeat id, label and vector count once; a null id is never linked and has a null class; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import ceil, erf, erfc, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm.common import Scratch, stars

#: A list of labels (16 bytes each) up to this long may be broadcast; a longer one is joined by shuffle.
BROADCAST_LABELS = 500_000
#: Vectors on each side of a comparison in memory, and candidates whose vectors are gathered at once.
TILE, GATHER = 1024, 1 << 16


@dataclass(frozen=True)
class Plan:
    cosine: float
    lines: int
    window: float
    least: int  # collisions of a pair to be verified
    block: int  # vectors that one side of a group holds, on average


def plan(largest: int, cosine: float = 0.93, dim: int = 64) -> Plan:
    """Parameters for labels of up to ``largest`` vectors of ``dim`` parts; they decide the cost, never the links.

    Of the lines and windows that lose no pair, those of the least cost a pair: its lines, and the chance that an
    unrelated pair has to be verified. A label has about eight blocks, so each vector is sent about eight times.
    """
    d = sqrt(max(0.0, 2 - 2 * cosine) + 1e-12)  # the least difference allows for rounding
    best = (float("inf"), 1, 0)
    for lines in sorted({*range(8, dim, max(8, dim // 32)), dim}):
        for out in range(lines):
            hit = erf(d / sqrt(out + 1) * sqrt(dim) / 2)  # an unrelated pair differs by N(0, sqrt(2 / dim)) on a line
            sigma = sqrt(lines * hit * (1 - hit)) + 1e-9
            chance = erfc((lines - out - 0.5 - lines * hit) / sigma / sqrt(2)) / 2
            best = min(best, (lines + 6 * dim * chance, lines, out))
    _, lines, out = best
    return Plan(cosine, lines, d / sqrt(out + 1) * (1 + 1e-9), lines - out, min(max(ceil(largest / 8), 128), 1 << 15))


@lru_cache(8)
def directions(dim: int, lines: int) -> np.ndarray:
    """Orthonormal lines (dim x lines), at most ``dim`` of them."""
    rng = np.random.Generator(np.random.PCG64([11, dim]))
    return np.linalg.qr(rng.normal(size=(dim, min(dim, lines))))[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # tiny or huge parts don't under- or overflow
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def place(u: np.ndarray, p: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(projections, cell) of unit vectors. Vectors of fewer parts than lines get lines on which all collide; the cell
    is one for all, as a border between cells would part linked vectors."""
    h = np.zeros((len(u), p.lines))
    a = directions(u.shape[1], p.lines)
    h[:, :a.shape[1]] = u @ a
    return h, np.zeros((len(u), 1), np.int64)


def collisions(h: np.ndarray, g: np.ndarray, window: float) -> np.ndarray:
    """Lines on which each of ``g`` lies in the window around each query of ``h``, from sorted lines: the window is a
    range of ranks, so a vector collides where its rank is in the range."""
    kind = np.uint16 if len(g) < 1 << 16 else np.uint32
    count, part = np.zeros((len(h), len(g)), np.int16), np.zeros((len(h), len(g)), np.uint8)
    rank, ranks = np.empty(len(g), kind), np.arange(len(g), dtype=kind)
    for k in range(h.shape[1]):
        order = np.argsort(g[:, k], kind="stable")
        line = g[order, k]
        rank[order] = ranks
        low = np.searchsorted(line, h[:, k] - window, "left").astype(kind)
        wide = np.searchsorted(line, h[:, k] + window, "right").astype(kind) - low
        part += (rank[None] - low[:, None] < wide[:, None]).view(np.uint8)  # a rank below the range wraps around
        if k % 255 == 254:  # as many as a byte counts
            count += part
            part[:] = 0
    return count + part


def links_of(u: np.ndarray, h: np.ndarray, v: np.ndarray, g: np.ndarray, same: bool, p: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the linked pairs between two tiles (or inside one) of unit vectors and their projections."""
    a, b = np.nonzero(collisions(h, g, p.window) >= p.least)
    if same:
        a, b = a[a < b], b[a < b]
    if 8 * len(a) > len(u) * len(v):  # near copies
        close = (u @ v.T)[a, b] >= p.cosine
    else:
        close = np.zeros(len(a), bool)
        for i in range(0, len(a), GATHER):
            close[i:i + GATHER] = np.einsum("ij,ij->i", u[a[i:i + GATHER]], v[b[i:i + GATHER]]) >= p.cosine
    return a[close], b[close]


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (of each row, a row that is its own) after its classes are joined by the links (a, b)."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def nodes_of(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, node, dim, label, vector): node null where a row can't link."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    ok = F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(~bad & some, F.lit(False))
    return df.select(F.col(key).cast("long").alias("key"), F.when(ok, F.xxhash64(label, vector)).alias("node"),
                     F.when(ok, F.xxhash64(label)).alias("label"), F.when(ok, v).alias("vector"))


def classes(spark: SparkSession, df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
            cosine: float = 0.93) -> DataFrame:
    """(key, n_links, component_id) of every row of ``df``."""
    scratch = Scratch(spark, "vector-dedup")
    rows = nodes_of(df, key, vector, label)
    # equal vectors of a label are one node
    nodes, _ = scratch.put(rows.where("node is not null").groupBy("node")
                           .agg(F.first("label").alias("label"), F.first("vector").alias("vector"),
                                F.count_distinct("key").cast("int").alias("weight"), F.min("key").alias("low")))
    sizes, _ = scratch.put(nodes.groupBy("label", F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")))
    largest, dim, labels = sizes.agg(F.max("n"), F.max_by("dim", "n"), F.count(F.lit(1))).first()
    p = plan(largest or 0, cosine, dim or 1)

    def deal(batches):
        for b in batches:
            vectors = b.column("vector")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                raw = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                body, size = unit(raw).tobytes(), dim * 8
                blobs = pa.array([body[i * size:(i + 1) * size] for i in range(len(at))], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at)) for c in ("label", "dim", "node", "weight")), blobs],
                                                 names=["label", "dim", "node", "weight", "unit"])

    dealt = nodes.select("label", F.size("vector").alias("dim"), "node", "weight", "vector").mapInArrow(
        deal, "label long, dim int, node long, weight int, unit binary")
    parts = sizes.where("n > 1").select("label", "dim", F.ceil(F.col("n") / p.block).cast("int").alias("parts"))
    if labels <= BROADCAST_LABELS:
        parts = F.broadcast(parts)
    split = dealt.join(parts, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    split = split.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    group = ["label", "dim", "i", "j"]
    split = split.select("label", "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "weight", "unit")
    found = (split.repartition(*group).sortWithinPartitions(*group, "own", "node")
             .mapInArrow(lambda batches: _compare(batches, p), "node long, links long, joined long"))
    found, _ = scratch.put(found)

    roots = stars(found.where("joined is not null"), "node", "joined", scratch)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (nodes.select("node", "weight", "low").join(links, "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    lows = named.groupBy("root").agg(F.min("low").alias("component"))
    named = named.join(lows, "root").select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component")
    out = rows.select("key", "node").join(named, "node", "left")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).cast("long").alias("n_links"),
                      F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component_id"))


def _compare(batches, p: Plan):
    """Stream sorted rows; each group (a pair of a label's blocks, or one block) is compared when it is whole."""
    held: list[pa.RecordBatch] = []
    keys = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(c).to_numpy() for c in range(4)], axis=1)
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for s, e in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(k)].tolist(), strict=True):
            if keys is not None and tuple(k[s]) != keys:
                yield from _group(held, keys, p)
                held = []
            keys = tuple(k[s])
            held.append(b.slice(s, e - s))
    if held:
        yield from _group(held, keys, p)


def _group(parts: list[pa.RecordBatch], keys: tuple, p: Plan):
    rows = pa.Table.from_batches(parts).combine_chunks()
    if len(rows) < 2:
        return
    _, dim, i, j = keys
    own, node, weight = (rows.column(c).to_numpy() for c in (4, 5, 6))
    u = np.frombuffer(b"".join(rows.column(7).to_pylist()), np.float64).reshape(len(rows), dim)
    h, _ = place(u, p)
    border = int(np.searchsorted(own, i, "right"))  # rows are sorted by their block
    left, right = (0, border), (0, border) if i == j else (border, len(rows))
    links, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
    for at in range(*left, TILE):
        q = slice(at, min(at + TILE, left[1]))
        for to in range(at if i == j else right[0], right[1], TILE):
            r = slice(to, min(to + TILE, right[1]))
            a, b = links_of(u[q], h[q], u[r], h[r], at == to, p)
            links[q] += np.bincount(a, weights=weight[r][b], minlength=q.stop - at).astype(np.int64)
            links[r] += np.bincount(b, weights=weight[q][a], minlength=r.stop - to).astype(np.int64)
            root = join_roots(root, a + at, b + to)
    some = links > 0
    yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])],
                                     names=["node", "links", "joined"])
