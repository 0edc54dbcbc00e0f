"""Operator 6 [native]: benchmark passages in documents, by a broadcast hash set of word windows.

Benchmark items become windows of ``n`` words. Every document window is hashed and looked up in the
broadcast set in one generated pipeline (tokenise, explode positions, hash, probe); a hash that is found
is verified word by word in the same row. Only DataFrame functions run: no Python code on the executors.

The set is broadcast in parts of at most ``BROADCAST_WINDOWS`` windows, each part one pass over the
documents, so a larger benchmark costs passes, not memory, and loses nothing.

Cases: null or empty text, or text without words: no hit, not contaminated; an item of fewer than ``n``
words, but not none, is one window; an item without words or id is skipped; items that share windows are
all reported; overlapping hits count each word once; very long texts are scanned whole; rows that repeat
id and text each get the same result, rows that repeat only the id their own; a null id is kept; an empty
benchmark finds nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martpulse.llm.common import Scratch, fresh

#: Fixed values of the word rule: everything else in ASCII parts words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: About 200 bytes each: a broadcast stays under 50 MB.
BROADCAST_WINDOWS = 200_000


def word_list(text: Column) -> Column:
    """Words of a text with A-Z lower-cased."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def window_hash(hashes: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(hashes, start + j) for j in range(length)])


def benchmark_windows(bench: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, size, h, window): every window of every item; ``window`` is its list of words."""
    items = (bench.where("item_id is not null").select("item_id", word_list(F.col("text")).alias("words"))
             .where(F.size("words") > 0)
             .withColumns({"hashes": F.transform("words", lambda w: F.xxhash64(w)),
                           "size": F.least(F.size("words"), F.lit(n))}))
    at = items.select("item_id", "words", "hashes", "size", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("start"))
    return at.select("item_id", "size", choose_hash("hashes", "start", "size", range(1, n + 1)).alias("h"),
                     F.slice("words", F.col("start") + 1, F.col("size")).alias("window"))


def choose_hash(hashes: str, start: str, size: str, sizes) -> Column:
    out = F.lit(None).cast("long")
    for k in sizes:
        out = F.when(F.col(size) == k, window_hash(F.col(hashes), F.col(start), k)).otherwise(out)
    return out


def scan(spark: SparkSession, docs: DataFrame, bench: DataFrame, scratch: Scratch, n: int = WINDOW
         ) -> tuple[DataFrame, DataFrame]:
    """(marks, items). ``marks`` (doc_id, text_key, n_words, start, size, found): one row per document with
    start -1, and one per verified hit. ``items`` (found, item_id): the items that hold each window."""
    every = benchmark_windows(bench, n).withColumn("found", F.sha2(F.concat_ws(" ", "window"), 256))
    every, _ = scratch.put(every)
    distinct = every.groupBy("found").agg(*[F.first(c).alias(c) for c in ("size", "h", "window")])
    sizes = sorted(r[0] for r in every.select("size").distinct().collect())  # at most n numbers
    parts = max(1, -(-distinct.count() // BROADCAST_WINDOWS))

    words = docs.select("doc_id", F.xxhash64("text").alias("text_key"), word_list(F.col("text")).alias("words"))
    hashed = words.select("doc_id", "text_key", "words", F.size("words").cast("long").alias("n_words"),
                          F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    least = min(sizes, default=n)
    starts = hashed.select("*", F.explode(F.sequence(F.lit(-1), F.greatest(F.col("n_words").cast("int") - least, F.lit(-1)))).alias("start"))
    if len(sizes) > 1:
        starts = starts.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
        starts = starts.where((F.col("start") >= 0) | (F.col("size") == least))
    else:
        starts = starts.withColumn("size", F.lit(least))
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words"))
    probes = starts.withColumn("h", F.when(fits, choose_hash("hashes", "start", "size", sizes)))

    marks = None
    for part in range(parts):
        known = distinct.where(F.pmod("h", F.lit(parts)) == part).select(
            F.col("h").alias("bench_h"), F.col("size").alias("bench_size"), "window", "found")
        same = ((F.col("h") == F.col("bench_h")) & (F.col("size") == F.col("bench_size"))
                & (F.slice("words", F.greatest(F.col("start") + 1, F.lit(1)), F.col("size")) == F.col("window")))
        found = probes.join(F.broadcast(known), same, "left")
        keep = F.col("found").isNotNull() | (F.col("start") == -1) if part == 0 else F.col("found").isNotNull()
        found = found.where(keep).select("doc_id", "text_key", "n_words", "start", "size", "found")
        marks = found if marks is None else marks.unionByName(found)
    marks, _ = scratch.put(marks)
    return marks, every.select("found", "item_id").distinct()


def report(spark: SparkSession, docs: DataFrame, bench: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, item_ids) for every row of ``docs``; ``item_ids``: sorted strings."""
    marks, items = scan(spark, docs, bench, Scratch(spark, "decontaminate"), n)
    key = ["doc_id", "text_key"]
    rows = marks.where("start = -1").groupBy(*key).agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("times"))
    hits = marks.where("start >= 0")
    words = (hits.select(*key, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("at"))
             .distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit")))
    named = (hits.select(*key, "found").distinct().join(items, "found").select(*key, "item_id").distinct()
             .groupBy(*key).agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids")))

    def alike(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("doc_id", "r_id").withColumnRenamed("text_key", "r_key")
        on = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key"))
        return left.join(right, on, "left").drop("r_id", "r_key")

    out = alike(alike(rows, words), named)
    return out.select(*key, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")


def remove_documents(spark: SparkSession, docs: DataFrame, bench: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without those that hold a window of an item; columns unchanged."""
    marks, _ = scan(spark, docs, bench, Scratch(spark, "decontaminate"), n)
    bad_id, bad_key = fresh(docs, "bad_id", "bad_key")
    bad = marks.where("start >= 0").select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    on = docs["doc_id"].eqNullSafe(F.col(bad_id)) & (F.xxhash64(docs["text"]) == F.col(bad_key))
    return docs.join(bad, on, "left_anti")
