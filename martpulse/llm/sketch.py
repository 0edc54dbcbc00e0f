"""Operator 12 [native]: document fingerprints by threshold-scaled sketches.

A text's shingles are its runs of five words (words part at white space, A-Z lower-cased; a text of fewer words has
one). A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows the text and
sketches of any two texts are comparable and can be merged. Where fewer than ``least`` hashes lie below it, the
``least`` smallest are kept instead (all, if there are no more), so short texts have a usable sketch too.

Two sketches are compared up to the hash to which both are complete: the share of common hashes in the smaller
(``containment``, which very unequal texts allow) or in both (``jaccard``). Only DataFrame functions run.

Cases: a null text counts as empty; texts without words have the empty sketch, which is like (1) another empty one
and unlike (0) all others; very long texts are read whole; equal texts have equal sketches; documents follow each
other by descending id, null ids last, texts of one id by a hash of the text; rows that repeat id and text are one
document there and each get its result; the only document follows itself; an empty table gives an empty table;
``with_sketch`` keeps other columns and replaces one of the new name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martpulse.llm.common import Scratch, fresh

SPACE = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hashes are numbers of so many hexadecimal digits.
DIGITS = 15


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    one_in: int = 8  # the threshold: one hash in so many is kept
    least: int = 16

    @property
    def top(self) -> int:
        """Greatest hash below the threshold."""
        return 16 ** DIGITS // self.one_in - 1


def with_sketch(df: DataFrame, text: str, name: str, p: Params = Params()) -> DataFrame:
    """``df`` plus ``name``: struct(hashes: sorted distinct array<long>, whole: all hashes are kept)."""
    df = df.drop(name) if name != text else df
    words, hashes, low, rest = fresh(df, "words", "hashes", "low", "rest")
    bound = f"{p.top + 1:0{DIGITS}x}"
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    n = F.size(words)
    shingles = (F.when(n >= p.shingle, F.transform(F.sequence(F.lit(1), n - p.shingle + 1), lambda i: F.array_join(F.slice(words, i, p.shingle), " ")))
                .when(n > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>")))
    out = df.select("*", F.filter(F.split(lower, SPACE), lambda w: w != "").alias(words))
    out = out.withColumn(hashes, F.transform(shingles, lambda s: F.substring(F.md5(s.cast("binary")), 1, DIGITS)))
    out = out.withColumn(low, F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < bound))))
    out = out.withColumn(rest, F.when(F.size(low) < p.least, F.array_sort(F.array_distinct(hashes))))
    kept = F.transform(F.coalesce(F.slice(rest, 1, p.least), F.col(low)), lambda h: F.conv(h, 16, 10).cast("long"))
    whole = F.coalesce(F.size(rest) <= p.least, F.lit(False))
    whole = F.when(F.col(rest).isNull(), F.lit(False)).otherwise(whole)
    return out.withColumn(name, F.struct(kept.alias("hashes"), whole.alias("whole"))).drop(words, hashes, low, rest)


def limit(s: Column, p: Params) -> Column:
    """The greatest hash up to which the sketch misses none."""
    return F.when(s["whole"], F.lit(16 ** DIGITS)).otherwise(F.greatest(F.lit(p.top), F.element_at(s["hashes"], -1)))


def merge(a: Column, b: Column, p: Params = Params()) -> Column:
    """The sketch of the union of two shingle sets."""
    upto = F.least(limit(a, p), limit(b, p))
    both = F.filter(F.array_sort(F.array_union(a["hashes"], b["hashes"])), lambda h: h <= upto)
    low = F.filter(both, lambda h: h <= p.top)
    kept = F.when(F.size(low) >= p.least, low).otherwise(F.slice(both, 1, p.least))
    return F.struct(kept.alias("hashes"), (a["whole"] & b["whole"] & (F.size(both) <= p.least)).alias("whole"))


def _compared(a: Column, b: Column, p: Params) -> tuple[Column, Column, Column, Column]:
    """(common, hashes of a, hashes of b up to the common limit, both sketches are empty)."""
    upto = F.least(limit(a, p), limit(b, p))
    x, y = (F.filter(s["hashes"], lambda h: h <= upto) for s in (a, b))
    empty = (F.size(a["hashes"]) == 0) & (F.size(b["hashes"]) == 0)
    return F.size(F.array_intersect(x, y)), F.size(x), F.size(y), empty


def containment(a: Column, b: Column, p: Params = Params()) -> Column:
    """Share of the smaller shingle set that lies in the other, 0 to 1."""
    common, x, y, empty = _compared(a, b, p)
    return F.when(empty, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(common.cast("double"), F.least(x, y).cast("double")), F.lit(0.0)))


def jaccard(a: Column, b: Column, p: Params = Params()) -> Column:
    common, x, y, empty = _compared(a, b, p)
    return F.when(empty, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(common.cast("double"), (x + y - common).cast("double")), F.lit(0.0)))


def as_string(s: Column) -> Column:
    """``all:`` (every hash is kept) or ``low:`` and the hashes in hexadecimal digits."""
    digits = F.transform(s["hashes"], lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0"))
    return F.concat(F.when(s["whole"], F.lit("all:")).otherwise(F.lit("low:")), F.array_join(digits, ","))


def successors(spark: SparkSession, docs: DataFrame, scratch: Scratch, key: str, text: str) -> DataFrame:
    """(id, body, n, next_id, next_body, next_times): each distinct (id, hash of text) and the one that follows it.

    Ids are dealt to ranges; a window inside each range finds the next one, and the first of each range (one
    row a range) the next of the range before it. No task sees all ids.
    """
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("body"), F.char_length(F.coalesce(text, F.lit(""))).alias("n"))
    keys, _ = scratch.put(rows.groupBy("id", "body").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("times")))
    order = [F.desc_nulls_last("id"), F.asc("body")]
    ranged, _ = scratch.put(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*order)
    follow = F.struct(F.col("id").alias("next_id"), F.col("body").alias("next_body"), F.col("times").alias("next_times"))
    ranged = ranged.select("*", F.lead(follow).over(inside).alias("follow"), (F.row_number().over(inside) == 1).alias("first"))
    ranged, _ = scratch.put(ranged.select("*", follow.alias("own")))
    # one row a range: its first document follows the last one of the range before it
    firsts = ranged.where("first").select("part", "own")
    around = Window.partitionBy(F.lit(0)).orderBy("part")
    edges = firsts.select("part", F.coalesce(F.lead("own").over(around), F.first("own").over(around)).alias("edge"))
    return (ranged.join(edges, "part").select("id", "body", "n", F.coalesce("follow", "edge").alias("f"))
            .select("id", "body", "n", "f.next_id", "f.next_body", "f.next_times"))


def with_next(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = 3, params: Params = Params()) -> DataFrame:
    """(id, text, n_chars, sketch, edited, next_sketch) for every row of ``docs``.

    ``edited``: the last floor(n_chars / share) code points replaced by as many from the beginning of the next document.
    Of the next document only these code points and its sketch travel.
    """
    scratch = Scratch(spark, "sketch")
    chain, _ = scratch.put(successors(spark, docs, scratch, key, text))
    body = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    body = with_sketch(body.withColumn("body", F.xxhash64("text")), "text", "sketch", params)
    wanted = chain.select(F.col("id").alias("for_id"), F.col("body").alias("for_body"), F.floor(F.col("n") / share).cast("int").alias("take"),
                          "next_id", "next_body", "next_times")
    heads = wanted.join(body, F.col("next_id").eqNullSafe(F.col("id")) & (F.col("next_body") == F.col("body"))).select(
        "for_id", "for_body", F.substring("text", F.lit(1), F.col("take")).alias("head"), F.col("sketch").alias("next_sketch"), "next_times")
    # repeated rows are one document
    again = heads.where("next_times > 1").groupBy("for_id", "for_body").agg(F.first("head").alias("head"), F.first("next_sketch").alias("next_sketch"))
    heads = heads.where("next_times = 1").drop("next_times").unionByName(again)
    both = body.join(heads, F.col("id").eqNullSafe(F.col("for_id")) & (F.col("body") == F.col("for_body")))
    n = F.char_length("text")
    kept = F.substring("text", F.lit(1), (n - F.floor(n / share)).cast("int"))
    return both.select("id", "text", n.cast("long").alias("n_chars"), "sketch", F.concat(kept, F.col("head")).alias("edited"), "next_sketch")


def report(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are to each other and to the next document's."""
    both = with_sketch(with_next(spark, docs, key, text, params=params), "edited", "edited_sketch", params)
    own, changed, other = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        F.col("id").alias(key), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_string(own).alias("fingerprint"), as_string(changed).alias("edited_fingerprint"),
        containment(own, changed, params).alias("near_edited"), containment(own, other, params).alias("near_next"),
        jaccard(own, changed, params).alias("jaccard_edited"), jaccard(own, other, params).alias("jaccard_next"))
