"""Inverted index of a keyed text table, kept up by micro-batches, with BM25 search from its postings.

Layout below ``path``: ``docs`` (KEYED-UPSERT table of key, day, text), ``postings`` (word, day, key, tf, size, sign;
one folder per batch and word bucket) and ``stats`` (day, documents, words per batch). A batch that rewrites a
document also writes the postings and counts of its former text with the opposite sign, so sums give the present state
and an unchanged document cancels out. Former texts come from ``docs`` as it was before the batch: a replay
writes the same. A search reads the buckets of its own words and the counts, and no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martpulse.functions.text import query_tokens, unicode_words
from martpulse.operators.search import B, K1, page
from martpulse.operators.upsert import BATCH_COL, compact, current, newest_batch, rows_since_snapshot, upsert_batch

BUCKETS = 64
_BUCKET = ("bucket",)


def bucket_of(word: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("string")


def _write(df: DataFrame, path: str, batch_id: int, *parts: str) -> None:
    writer = (df.hint("rebalance", *parts) if parts else df.hint("rebalance")).write.mode("overwrite")
    (writer.partitionBy(*parts) if parts else writer).parquet(f"{path}/{BATCH_COL}={int(batch_id)}")


def index_batch(batch: DataFrame, batch_id: int, path: str, key: str, text: str, day: str, words=unicode_words,
                buckets: int = BUCKETS) -> None:
    """Index the documents of one micro-batch: new ones, and new versions of known ones (the later batch wins).

    Of rows with one key, that of the greatest row hash counts, as in ``upsert_batch``. A null text has no words.
    """
    spark, docs = batch.sparkSession, f"{path}/docs"
    upsert_batch(batch.select(F.col(key).alias("key"), F.col(day).alias("day"), F.col(text).alias("text")), batch_id, docs, "key")
    now = spark.read.parquet(f"{docs}/{BATCH_COL}={int(batch_id)}").select("key", "day", "text")   # one row per key, and the newest
    signed = now.withColumn("sign", F.lit(1))
    first = newest_before(spark, docs, batch_id) is None
    if not first:
        before = current(spark, docs, "key", upto=batch_id - 1, only_keys=now)
        signed = signed.unionByName(before.withColumn("sign", F.lit(-1)))
    cut = signed.select("key", "day", "sign", F.coalesce(words("text"), F.array().cast("array<string>")).alias("ws"))
    cut = cut.select("key", "day", "sign", "ws", F.size("ws").alias("size"))
    stats = cut.groupBy("day").agg(F.sum("sign").alias("documents"), F.sum(F.col("sign") * F.col("size")).alias("words"))
    _write(stats.where("documents <> 0 or words <> 0"), f"{path}/stats", batch_id)
    each = F.transform(F.array_distinct("ws"), lambda w: F.struct(w.alias("word"), F.size(F.filter("ws", lambda x: x == w)).alias("tf")))
    postings = cut.select("key", "day", "sign", "size", F.explode(each).alias("p")).select("p.word", "day", "key", "p.tf", "size", "sign")
    # the first batch has nothing that cancels out: a word stands once for each key
    postings = (postings if first else net(postings)).withColumn("bucket", bucket_of(F.col("word"), buckets))
    _write(postings, f"{path}/postings", batch_id, *_BUCKET)


def newest_before(spark: SparkSession, docs: str, batch_id: int) -> int | None:
    """Whether there is a state before this batch (a batch id of it), replayed or not."""
    try:
        rows_since_snapshot(spark, docs, upto=batch_id - 1)
    except FileNotFoundError:
        if newest_batch(spark, docs) is not None and newest_batch(spark, docs) > batch_id:
            raise
        return None
    return batch_id - 1


def net(postings: DataFrame) -> DataFrame:
    """Postings with their signs added up; those that cancel out go."""
    keys = [c for c in postings.columns if c != "sign"]
    return postings.groupBy(*keys).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")


def compact_index(spark: SparkSession, path: str, upto: int | None = None) -> None:
    """Fold the batches up to ``upto`` of all three tables into snapshots."""
    compact(spark, f"{path}/docs", "key", upto=upto)
    compact(spark, f"{path}/postings", "key", None, _BUCKET, upto, fold=net)
    compact(spark, f"{path}/stats", "day", None, None, upto,
            fold=lambda rows: rows.groupBy("day").agg(F.sum("documents").alias("documents"), F.sum("words").alias("words")))


def postings_of(spark: SparkSession, path: str, wanted: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Present postings of these words. Only their buckets are read."""
    words = F.array(*[F.lit(w) for w in wanted]) if wanted else F.array().cast("array<string>")
    own = [r.b for r in spark.range(1).select(F.explode(words).alias("w")).select(bucket_of(F.col("w"), buckets).alias("b")).distinct().collect()]
    rows = rows_since_snapshot(spark, f"{path}/postings", _BUCKET).where(F.col("bucket").isin(own) & F.col("word").isin(wanted))
    return net(rows.select("word", "day", "key", "tf", "size", "sign"))


def search_index(spark: SparkSession, path: str, day: str, query: str, page_no: int, page_size: int, digits: int | None = 6,
                 words=unicode_words, buckets: int = BUCKETS, k1: float = K1, b: float = B) -> DataFrame:
    """``(key, score)``: one page of the day's documents that hold every word of ``query``, by BM25 over the whole
    table, ties by key. A query without words finds nothing. The caller joins the few keys to the day's rows."""
    q = query_tokens(spark, query, words)
    found = postings_of(spark, path, q, buckets)
    counts = rows_since_snapshot(spark, f"{path}/stats").agg(
        F.struct(F.sum("documents").alias("n"), (F.sum("words") / F.sum("documents")).alias("average")).alias("s")).scalar()
    n, average = counts["n"], counts["average"]
    holding = found.agg(F.struct(F.lit(0).alias("none"), *[F.count(F.when(F.col("word") == w, 1)).alias(f"d{i}") for i, w in enumerate(q)])
                        .alias("s")).scalar()
    hits = (found.where(F.col("day") == day).groupBy("key")
            .agg(F.max("size").alias("size"), *[F.max(F.when(F.col("word") == w, F.col("tf"))).alias(f"f{i}") for i, w in enumerate(q)]))
    score = F.lit(0.0)
    for i in range(len(q)):
        f, d = F.col(f"f{i}"), holding[f"d{i}"]
        hits = hits.where(f.isNotNull())
        idf = F.log(F.lit(1.0) + (n - d + F.lit(0.5)) / (d + F.lit(0.5)))
        score = score + idf * f * F.lit(k1 + 1) / (f + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("size") / average))
    scored = hits.select("key", (F.round(score, digits) if digits is not None else score).alias("score"))
    return page(scored, page_no, page_size, F.desc("score"), F.asc("key"))
