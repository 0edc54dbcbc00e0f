"""Operator 13: groups of spelling variants by PartEnum signatures of letter multisets.

A word's letters, counted, are a binary vector (one place per letter and occurrence). One inserted, deleted or
replaced letter changes it in one or two places, so words one edit apart lie within Hamming distance two. The
letters are dealt into ``parts`` parts: two such words agree on all parts but two (a replaced letter, equal length)
or but one (a letter more). A signature is the word's multiset without those parts, with the greater length; each
word gives one per choice of parts, words of equal signature are joined, and the edit distance verifies a pair
inside the join, so that other pairs never become rows. A signature that more than ``hot`` words share is joined
by its words' halves as well: one edit leaves the first or the last half alone, so no pair is lost.

A word's form is its near word of most occurrences, if that has at least ``ratio`` times its own; the root follows
forms to the last by pointer jumping (each step at least doubles the count, so chains are short).

Cases: null and empty texts have no words; very long runs are words like others; repeated rows count each; a null
id counts as the empty text in the edit rule; ties go to the smaller word in code-point order; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martpulse.llm.common import Scratch

#: Letters of a word, and its least length and number of occurrences.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_TIMES = 5, 3
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))


@dataclass(frozen=True)
class Params:
    parts: int = 5
    ratio: int = 2
    hot: int = 256  # words of one signature that are compared without a look at their halves


def runs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, run) of every run of letters, A-Z lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), 0)).alias("run"))


def edited(doc: Column, run: Column, every: int = 97) -> Column:
    """The run, without one of its letters where the checksum of id and run is a multiple of ``every``."""
    h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the edited runs that are long and frequent enough."""
    made = runs(docs, key, text).where(F.char_length("run") >= LEAST_CHARS).select(edited(F.col("id"), F.col("run")).alias("word"))
    return (made.where(F.char_length("word") >= LEAST_CHARS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= LEAST_TIMES))


def letter_parts(letters: str, parts: int) -> list[str]:
    """Letters dealt in turn to the parts; ``letters`` in descending frequency gives even parts."""
    return [letters[i::parts] for i in range(parts)]


def signatures(words: DataFrame, parts: list[str]) -> DataFrame:
    """(sig, side, word): side 0 pairs with itself (equal length), 1 (the longer word) with 2 (the shorter)."""
    size = F.char_length("word")
    bag = F.array_join(F.array_sort(F.split("word", "")), "")

    def sig(length: Column, kind: int, dropped: tuple[int, ...]) -> Column:
        rest = F.translate("bag", "".join(parts[i] for i in dropped), "")
        return F.xxhash64(length, F.lit(kind), F.lit(",".join(map(str, dropped))), rest)

    each = [(0, sig(F.col("size"), 0, d)) for d in combinations(range(len(parts)), 2)]
    each += [(side, sig(F.col("size") + side - 1, 1, (i,))) for i in range(len(parts)) for side in (1, 2)]
    rows = words.select("word", size.alias("size"), bag.alias("bag"))
    made = F.explode(F.array(*[F.struct(s.alias("sig"), F.lit(side).cast("byte").alias("side")) for side, s in each]))
    return rows.select("word", made.alias("s")).select("s.sig", "s.side", "word")


def halves(sigs: DataFrame) -> DataFrame:
    """Signatures again, one row per half of the word. Either half of the shorter word is one of the longer."""
    size = F.char_length("word")
    half = F.floor((size - F.when(F.col("side") == 1, 1).otherwise(0)) / 2).cast("int")  # from the shorter length
    rest = (size - F.when(F.col("side") == 1, 1).otherwise(0)) - half
    first, last = F.substring("word", F.lit(1), half), F.substring("word", size - rest + 1, rest)
    made = F.array(F.xxhash64("sig", F.lit(1), first), F.xxhash64("sig", F.lit(2), last))
    return sigs.select(F.explode(made).alias("sig"), "side", "word")


def near_pairs(spark: SparkSession, words: DataFrame, scratch: Scratch, p: Params) -> DataFrame:
    """(word, near): both directions of every pair of words one edit apart, once."""
    counted = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    # at most one row per letter of the alphabet
    by_count = [r.letter for r in counted.orderBy(F.desc("count"), "letter").collect()]
    alphabet = "".join(by_count + [c for c in LETTERS if c not in by_count])
    sigs, _ = scratch.put(signatures(words, letter_parts(alphabet, p.parts)))
    sizes = sigs.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.max("side").alias("most"), F.min("side").alias("least"))
    sizes = sizes.where((F.col("m") > 1) & ((F.col("most") == 0) | (F.col("most") > F.col("least"))))
    shared = sigs.join(sizes.select("sig", (F.col("m") > p.hot).alias("is_hot")), "sig")
    shared, _ = scratch.put(shared)
    split = shared.where(~F.col("is_hot")).drop("is_hot").unionByName(halves(shared.where("is_hot").drop("is_hot")))
    left = split.where("side <= 1").select("sig", "side", F.col("word").alias("word"))
    right = split.where("side <> 1").select("sig", F.col("side").alias("other_side"), F.col("word").alias("near"))
    meet = ((F.col("side") == 0) & (F.col("other_side") == 0) & (F.col("word") < F.col("near"))) | ((F.col("side") == 1) & (F.col("other_side") == 2))
    close = F.levenshtein("word", "near", 1) == 1
    found = left.join(right, "sig").where(meet & close).select("word", "near").distinct()
    found, _ = scratch.put(found)
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


def roots(forms: DataFrame, scratch: Scratch, max_rounds: int = 12) -> DataFrame:
    """(word, root): the last of the chain word -> form, for every word that has a form."""
    now, path = scratch.put(forms.select("word", F.col("form").alias("root")))
    for _ in range(max_rounds):  # the jump doubles, and a chain has at most 62 steps
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        nxt, nxt_path = scratch.put(nxt)
        moved = nxt.where("moved").limit(1).count()
        scratch.drop(path)
        now, path = nxt.drop("moved"), nxt_path
        if not moved:
            return now
    raise RuntimeError(f"forms did not settle in {max_rounds} rounds")


def variants(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    scratch = Scratch(spark, "spelling")
    words, _ = scratch.put(vocabulary(docs, key, text))
    pairs = near_pairs(spark, words, scratch, params)
    with_n = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # most occurrences first, then the smaller word
    best = with_n.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named, _ = scratch.put(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= params.ratio * F.col("n"), F.col("best.near")).alias("form"), (-F.col("best.less")).alias("best_n")))
    last = roots(named.where("form is not null"), scratch)
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
