"""Operator 7: exact Jaccard self-join of documents on word n-grams, and its connected classes.

Rare-first prefix filtering: a global order puts n-grams with a low hashed document count first (counts
of all documents, in a table of ``order_buckets``; any total order gives the same links, a rare-first one
gives few candidates). Two sets that link share an n-gram within both prefixes, so prefix entries meet by
n-gram. Length and positional filters, and in the verifying task a suffix filter, drop most candidates
before the one exact count per pair.

Only classes are asked for, so no group is expanded into its pairs. The sets of an n-gram are verified
against its ``pivots``: those that share the most n-grams with others, as the centre of a group of copies
does. Pairs that are then in one class need no check. Of the other pairs of an n-gram, those between its main
class and the rest, and within the rest, are verified too: every link between classes is found.

Sets are compared by 64-bit n-gram hashes, and a set is named by a 64-bit hash of its members.

Cases: null, empty or blank text: no n-gram, linked with nothing, its own class; fewer words than n: the
whole sequence is one n-gram; a null key: never linked, null class; equal sets are one node, so thousands
of copies cost one; rows that repeat a key are compared each with its own text; very long texts are read
whole; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm.common import SPACE_SEP, PerWorker, Scratch, blocks, fresh, mix, slices, stars, words


#: A list of set owners (16 bytes each) up to this long may be broadcast; a longer one is joined by shuffle.
BROADCAST_OWNERS = 1_000_000


@dataclass(frozen=True)
class Params:
    n: int = 5
    num: int = 80  # linked if den * intersection >= num * union
    den: int = 100
    order_buckets: int = 1 << 17
    pivots: int = 8


def ngram_hashes(row: np.ndarray, h: np.ndarray, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every n-gram; a row of fewer words, but not none, has one of them all."""
    count = np.bincount(row, minlength=rows)
    with np.errstate(over="ignore"):
        out_row, out = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if len(h) >= n:
            g = h[:len(h) - n + 1]
            for i in range(1, n):
                g = mix(g * np.uint64(0x2545F4914F6CDD1D) + h[i:len(h) - n + 1 + i])
            same = row[:len(h) - n + 1] == row[n - 1:]
            out_row, out = row[:len(h) - n + 1][same], g[same]
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            first = (np.cumsum(count) - count)[short]
            g = h[first]
            for i in range(1, n):
                more = count[short] > i
                at = np.where(more, first + i, first)
                g = np.where(more, mix(g * np.uint64(0x2545F4914F6CDD1D) + h[at]), g)
            g = mix(g + count[short].astype(np.uint64))
            out_row, out = np.r_[out_row, short], np.r_[out, g]
    return out_row, out


def set_names(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, size) of each row's set; ``row`` is sorted and (row, hash) pairs are distinct."""
    size = np.bincount(row, minlength=rows)
    total = np.zeros(rows, np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        first = (np.cumsum(size) - size)[some]
        total[some] = np.add.reduceat(mix(h ^ np.uint64(0xA0761D6478BD642F)), first)
    return mix(total + size.astype(np.uint64)).view(np.int64), size


def distinct_sets(texts: pa.Array, p: Params, rank: np.ndarray | None = None) -> Iterator[tuple]:
    """(first row, rows, row, hash, name, size) per block: distinct n-grams by row, then by rank and hash."""
    for i, j, data, offsets in blocks(texts):
        row, h, _ = words(data, offsets, SPACE_SEP)
        row, h = ngram_hashes(row, h, j - i, p.n)
        if rank is None:
            order = np.lexsort((h, row))
        else:
            order = np.lexsort((h, rank[(h % np.uint64(len(rank))).astype(np.int64)], row))
        row, h = row[order], h[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        row, h = row[new], h[new]
        yield i, j - i, row, h, *set_names(row, h, j - i)


def name_sets(docs: DataFrame, p: Params) -> DataFrame:
    """(doc_id, node, n) of every document; ``node`` names its set, ``n`` counts its n-grams."""

    def run(batches):
        for b in batches:
            for i, rows, _, _, name, size in distinct_sets(b.column(1), p):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, rows), pa.array(name), pa.array(size)],
                                                 names=["doc_id", "node", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, node long, n long")


def order_table(docs: DataFrame, p: Params) -> np.ndarray:
    """Hashed document counts of the n-grams of all rows (at most ``order_buckets`` rows from each task)."""

    def run(batches):
        total = np.zeros(p.order_buckets, np.int64)
        for b in batches:
            for _, _, _, h, _, _ in distinct_sets(b.column(0), p):
                total += np.bincount((h % np.uint64(p.order_buckets)).astype(np.int64), minlength=p.order_buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["b", "c"])

    got = docs.select("text").mapInArrow(run, "b int, c long").groupBy("b").agg(F.sum("c").alias("c")).toPandas()
    table = np.zeros(p.order_buckets, np.int64)
    table[got["b"].to_numpy(int)] = got["c"].to_numpy(int)
    return table


def prefix_entries(spark: SparkSession, docs: DataFrame, p: Params) -> DataFrame:
    """(gram, n, node, pos): the rarest n-grams of each set, as many as any linked set must meet one of.

    A task names a set it has already met only once, so copies are reduced before the shuffle.
    """
    shared = PerWorker(spark, order_table(docs, p), _same)

    def run(batches):
        rank, met = shared.get(), set()
        for b in batches:
            for _, rows, row, h, name, size in distinct_sets(b.column(0), p, rank):
                fresh = np.zeros(rows, bool)
                for r in np.flatnonzero(size).tolist():
                    k = int(name[r])
                    if k not in met:
                        met.add(k)
                        fresh[r] = True
                first = np.cumsum(size) - size
                pos = np.arange(len(row)) - first[row]
                length = size - -(-p.num * size // p.den) + 1
                keep = fresh[row] & (pos < length[row])
                row_, pos_ = row[keep], pos[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[keep].view(np.int64)), pa.array(size[row_].astype(np.int32)), pa.array(name[row_]),
                     pa.array(pos_.astype(np.int32))], names=["gram", "n", "node", "pos"])

    return docs.select("text").mapInArrow(run, "gram long, n int, node long, pos int")


def _same(x):
    return x


def streamed(batches, held: int):
    """Sorted batches (first column: group) with each row's rank in its group, and the group's rows so far.

    Yields (columns, rank, heads): ``heads[k]`` are the columns of the row of rank k in each row's group, for
    k below ``held``. No group is kept whole: only its first ``held`` rows go on from batch to batch.
    """
    last, count, first = None, 0, []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        key, at = cols[0], np.arange(len(cols[0]))
        begins = np.r_[last is None or key[0] != last, key[1:] != key[:-1]]
        start = np.maximum.accumulate(np.where(begins, at, -1))
        rank = np.where(start >= 0, at - start, at + count)
        heads = []
        for k in range(held):
            inside = np.minimum(np.maximum(start, 0) + k, len(key) - 1)
            carried = start < 0
            h = []
            for c, col in enumerate(cols):
                value = col[inside]
                if carried.any():
                    value = value.copy()
                    value[carried] = first[k][c] if k < len(first) else col[np.minimum(max(k - count, 0), len(key) - 1)]
                h.append(value)
            heads.append(h)
        yield cols, rank, heads
        e = int(start[-1])
        first = ([] if e >= 0 else first) + [[col[i] for col in cols] for i in range(max(e, 0), min(len(key), max(e, 0) + held))]
        first = first[:held]
        count = len(key) - e if e >= 0 else count + len(key)
        last = key[-1]


def meet(entries: DataFrame) -> DataFrame:
    """(gram, n, node, pos): each entry whose n-gram two or more sets hold, once.

    One shuffle by n-gram; a task streams its sorted entries and holds no group. A set has an n-gram
    once, so even one that every set holds is a small share of all entries.
    """

    def run(batches):
        waiting = None  # a first entry whose group may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy() for c in b.columns]
            if waiting is not None:
                cols = [np.r_[w, c] for w, c in zip(waiting, cols, strict=True)]
            gram, _, node, _ = cols
            new = np.r_[True, (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])]  # copies of one set from several tasks
            cols = [c[new] for c in cols]
            gram = cols[0]
            before = np.r_[False, gram[1:] == gram[:-1]]
            after = np.r_[gram[1:] == gram[:-1], True]  # the last one waits
            keep = before | after
            keep[-1] = before[-1]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], names=["gram", "n", "node", "pos"])
            # a last entry that was sent stays as a witness, marked by an impossible place
            waiting = [c[-1:] for c in cols]
            if keep[-1]:
                waiting[3] = np.array([-1], np.int32)

    def drop_witnesses(batches):
        for b in batches:
            yield b.filter(pa.array(b.column(3).to_numpy() >= 0))

    return (entries.repartition("gram").sortWithinPartitions("gram", "n", "node")
            .mapInArrow(lambda x: drop_witnesses(run(x)), "gram long, n int, node long, pos int"))


def may_link(p: Params, n_a, pos_a, met_a, n_b, pos_b, met_b, low, high):
    """Length, positional and count filters of a pair that meets at these places of its prefixes.

    Two sets that share ``need`` n-grams meet in one before the last ``need`` - 1 of either: a meeting place
    further on is left to that one. What they share stands in both prefixes, or else beyond the prefix that
    ends first: at most the larger remainder; ``met``, a set's number of met n-grams, bounds the former. For
    columns and for numpy arrays (``low``, ``high``: least and greatest of two).
    """
    short, long = low(n_a, n_b), high(n_a, n_b)
    need = (n_a + n_b) * p.num  # of num + den: least intersection of linked sets
    rest = (long * p.num + p.den - 1) / p.den - 1
    return ((short * p.den >= long * p.num) & (low(n_a - pos_a, n_b - pos_b) * (p.num + p.den) >= need)
            & ((low(met_a, met_b) + rest) * (p.num + p.den) >= need))


def star(shared: DataFrame, p: Params) -> DataFrame:
    """Pairs to verify and what they leave open. Rows (gram null, a, b): each set of an n-gram with each of its
    pivots, if the filters let it. Rows (gram, a, n, pos, met): entries that are no pivot."""
    names = ["gram", "a", "b", "n", "pos", "met"]

    def run(batches):
        for cols, rank, heads in streamed(batches, p.pivots):
            gram, _, node, n, pos, met = cols
            pairs = []
            for k, (_, _, node_k, n_k, pos_k, met_k) in enumerate(heads):
                ok = (rank > k) & may_link(p, n, pos, met, n_k, pos_k, met_k, np.minimum, np.maximum)
                pairs.append(np.stack([node_k[ok], node[ok]], axis=1))
            pairs = np.unique(np.concatenate(pairs), axis=0)
            open_ = rank >= p.pivots
            m, k = len(pairs), int(open_.sum())
            nothing = pa.nulls(m, pa.int32())
            whole = [pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(gram[open_])]),
                     pa.array(np.r_[pairs[:, 0], node[open_]]), pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(k, pa.int64())])]
            whole += [pa.concat_arrays([nothing, pa.array(c[open_].astype(np.int32))]) for c in (n, pos, met)]
            yield pa.RecordBatch.from_arrays(whole, names=names)

    met = shared.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("met"))
    rows = shared.join(met, "node").select("gram", (-F.col("met")).alias("o"), "node", "n", "pos", "met")
    return (rows.repartition("gram").sortWithinPartitions("gram", "o", "node")
            .mapInArrow(run, "gram long, a long, b long, n int, pos int, met int"))


def verify(docs: DataFrame, named: DataFrame, pairs: DataFrame, p: Params, scratch: Scratch) -> tuple[DataFrame, str]:
    """(linked rows of ``pairs``, folder that they read, to be dropped after them); each pair (a, b) is counted once
    from two documents' texts.

    Texts travel, not sets: they are smaller, and only those of sets in some pair are read out.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    owners = (named.where("doc_id is not null").join(nodes, "node", "left_semi").groupBy("node")
              .agg(F.min("doc_id").alias("doc_id")))
    if 2 * pairs.count() <= BROADCAST_OWNERS:
        owners = F.broadcast(owners)
    texts = (docs.join(owners, "doc_id").select("node", F.xxhash64("text").alias("key"), "text")
             .groupBy("node", "key").agg(F.first("text").alias("text")).drop("key"))
    texts, path = scratch.put(texts)
    both = (pairs
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    columns = pairs.columns

    def compare(batches):
        for batch in batches:
            for i, j in slices(batch.column("text_a")):
                part = batch.slice(i, j - i)
                sides = [set_list(part.column(c), p) for c in ("text_a", "text_b")]
                ok = [(a, b) == (name_a, name_b) and linked(x, y, p) for a, b, (name_a, x), (name_b, y) in zip(
                    part.column("a").to_pylist(), part.column("b").to_pylist(), *sides, strict=True)]
                yield part.select(columns).filter(pa.array(ok, pa.bool_()))

    return both.select(*columns, "text_a", "text_b").mapInArrow(compare, pairs.schema), path


def set_list(texts: pa.Array, p: Params) -> list[tuple[int, np.ndarray]]:
    """(name, sorted hashes) of each text's set."""
    out = []
    for _, _, _, h, name, size in distinct_sets(texts, p):
        out += zip(name.tolist(), np.split(h, np.cumsum(size)[:-1]), strict=True)
    return out


def linked(x: np.ndarray, y: np.ndarray, p: Params) -> bool:
    """Whether two sorted sets link; the suffix filter first bounds what they share between a few cuts."""
    cuts = x[[len(x) // 4, len(x) // 2, 3 * len(x) // 4]] if len(x) > 8 else x[:0]
    in_x, in_y = np.r_[0, np.searchsorted(x, cuts), len(x)], np.r_[0, np.searchsorted(y, cuts), len(y)]
    most = int(np.minimum(np.diff(in_x), np.diff(in_y)).sum())
    if p.den * most < p.num * (len(x) + len(y) - most):
        return False
    share = len(np.intersect1d(x, y, assume_unique=True))
    return p.den * share >= p.num * (len(x) + len(y) - share)


def classes(spark: SparkSession, docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, class) of every row of ``docs`` (doc_id, text)."""
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named, _ = scratch.put(name_sets(docs, p))
    keyed = docs.where("doc_id is not null")
    shared, shared_path = scratch.put(meet(prefix_entries(spark, keyed, p)))
    made, made_path = scratch.put(star(shared, p))
    scratch.drop(shared_path)
    pairs, _ = scratch.put(made.where("gram is null").select("a", "b").distinct())
    links, texts_path = verify(keyed, named, pairs, p, scratch)
    roots = stars(links, "a", "b", scratch)
    scratch.drop(texts_path)

    # pairs without a pivot: of n-grams whose other sets are in several classes, all but those inside the main class
    at = (made.where("gram is not null").select("gram", F.col("a").alias("node"), "n", "pos", "met")
          .join(roots, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root"))
    by_class = at.groupBy("gram", "class").agg(F.count(F.lit(1)).alias("c"))
    mixed = (by_class.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.max_by("class", F.struct("c", "class")).alias("main"))
             .where("k > 1").select("gram", "main"))
    rest, rest_path = scratch.put(at.join(mixed, "gram"))
    scratch.drop(made_path)
    a, b = rest.where("class <> main").alias("a"), rest.alias("b")
    more = a.join(b, F.col("a.gram") == F.col("b.gram")).where(
        (F.col("a.class") != F.col("b.class"))
        & ((F.col("b.class") == F.col("b.main")) | (F.col("a.node") < F.col("b.node")))
        & may_link(p, *(F.col(f"{t}.{c}") for t in "ab" for c in ("n", "pos", "met")), F.least, F.greatest))
    ends = [pick(f"a.{c}", f"b.{c}").alias(f"{to}{c}") for c in ("node", "class") for pick, to in ((F.least, "a_"), (F.greatest, "b_"))]
    more, _ = scratch.put(more.select(*ends).distinct().withColumnsRenamed({"a_node": "a", "b_node": "b"}))
    scratch.drop(rest_path)
    late, texts_path = verify(keyed, named, more, p, scratch)
    over = stars(late, "a_class", "b_class", scratch).toDF("class", "over")
    scratch.drop(texts_path)

    # smallest key per node, then per class: copies are reduced before classes are joined
    node_ids = named.where("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    in_class = (node_ids.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("class"), "low")
                .join(over, "class", "left").select("node", F.coalesce("over", "class").alias("class"), "low"))
    class_ids = in_class.groupBy("class").agg(F.min("low").alias("component_id"))
    node_class = in_class.join(class_ids, "class").select("node", "component_id", "class")
    out = named.join(node_class, "node", "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.when(~alone, F.col("class")).alias("class"))


#: A list of dropped documents (16 bytes each) up to this long may be broadcast; a longer one is joined by shuffle.
BROADCAST_DROPPED = 1_000_000


def keep_one(spark: SparkSession, docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id. Columns are unchanged.

    Documents without words and those with a null id stay. Rows that repeat an id with different texts stay
    if one of them does; of rows equal in id and text, one stays.
    """
    scratch = Scratch(spark, "ngram-keep")
    found, _ = scratch.put(classes(spark, docs, p))
    drop = found.where("component_id <> doc_id").select("doc_id").join(
        found.where("component_id = doc_id").select("doc_id"), "doc_id", "left_anti").distinct()
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    twice = twice.join(drop, "doc_id", "left_anti")
    drop, _ = scratch.put(drop.withColumn("gone", F.lit(True)).unionByName(twice.withColumn("gone", F.lit(False))))
    few = drop.count() <= BROADCAST_DROPPED
    drop_id, gone = fresh(docs, "drop_id", "gone")
    drop = drop.toDF(drop_id, gone)
    marked = docs.join(F.broadcast(drop) if few else drop, docs["doc_id"] == F.col(drop_id), "left")
    stay = marked.where(F.col(gone).isNull()).select(*docs.columns)
    again = marked.where(~F.col(gone)).select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return stay.unionByName(again)
