"""Search over the sale table: exact-term filter, all-terms text match, BM25 relevance, paging,
top-N term buckets.

Everything is column expressions and aggregates; corpus statistics (N, average length, document
frequencies) come from one aggregate row used as a scalar subquery, not from a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martpulse.functions.text import query_tokens, tokens

# BM25 constants (Robertson & Zaragoza 2009 defaults).
K1, B = 1.2, 0.75


def match_all(df: DataFrame, text_col: str, keyword: str, words=tokens) -> DataFrame:
    """Rows whose text contains every word of ``keyword`` (no words -> no rows); ``words``: how texts are cut."""
    wanted = F.array_distinct(words(F.lit(keyword or "")))   # a constant, folded by the optimiser
    return df.where((F.size(wanted) > 0) & (F.size(F.array_except(wanted, words(text_col))) == 0))


def _term_count(toks: str, word: str):
    """Occurrences of one word in a token array."""
    return F.size(F.filter(toks, lambda t: t == F.lit(word)))


def bm25_scores(df: DataFrame, id_col: str, text_col: str, query: str, k1: float = K1, b: float = B
                ) -> DataFrame:
    """``(id, score)`` for every document; ``score`` is null when no query term occurs.

    Per-document features (length, term counts) are computed once and hash-partitioned by id; the
    corpus statistics (one aggregate row, a scalar subquery) and the scoring both read that same
    exchange, so the text is tokenised once. Nothing filters before the exchange: a pushed-down
    filter would re-tokenise in the scan stage.
    """
    q = query_tokens(df.sparkSession, query)
    if not q:
        return df.select(id_col, F.lit(None).cast("double").alias("score"))
    per_doc = (df.select(id_col, tokens(text_col).alias("__t"))
                 .select(id_col, F.size("__t").alias("dl"),
                         *[_term_count("__t", w).alias(f"__f{i}") for i, w in enumerate(q)])
                 .repartition(F.col(id_col)))
    stats = per_doc.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"),
        *[F.sum(F.when(F.col(f"__f{i}") > 0, 1).otherwise(0)).alias(f"df{i}") for i in range(len(q))]
    ).alias("s")).scalar()
    n, avgdl = stats["n"], stats["avgdl"]
    score = None
    for i in range(len(q)):
        f, dfi = F.col(f"__f{i}"), stats[f"df{i}"]
        idf = F.log(F.lit(1.0) + (n - dfi + F.lit(0.5)) / (dfi + F.lit(0.5)))
        term = idf * f * F.lit(k1 + 1) / (f + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / avgdl))
        term = F.when(f > 0, term).otherwise(F.lit(0.0))
        score = term if score is None else score + term
    any_hit = None
    for i in range(len(q)):
        c = F.col(f"__f{i}") > 0
        any_hit = c if any_hit is None else (any_hit | c)
    return per_doc.select(id_col, F.when(any_hit, score).alias("score"))


def with_bm25(df: DataFrame, text_col: str, query: str, corpus: DataFrame, k1: float = K1, b: float = B,
              score_col: str = "score", words=tokens) -> DataFrame:
    """``df`` plus a BM25 ``score`` of ``text_col`` (null when no query term occurs).

    Corpus statistics come from all of ``corpus`` (a DataFrame with ``text_col``; one aggregate row, a scalar
    subquery), like a search index whose statistics cover every document. Texts repeat (product names), so
    each distinct text is tokenised once and weighted by its number of rows.
    """
    q = query_tokens(df.sparkSession, query, words)
    if not q:
        return df.withColumn(score_col, F.lit(None).cast("double"))
    toks = words(text_col)
    names = corpus.groupBy(text_col).agg(F.count(F.lit(1)).alias("__n"))
    feats = names.select("__n", F.size(toks).alias("dl"), *[_term_count(toks, w).alias(f"__f{i}") for i, w in enumerate(q)])
    stats = feats.agg(F.struct(
        F.sum("__n").alias("n"), (F.sum(F.col("__n") * F.col("dl")) / F.sum("__n")).alias("avgdl"),
        *[F.sum(F.when(F.col(f"__f{i}") > 0, F.col("__n")).otherwise(0)).alias(f"df{i}") for i in range(len(q))]
    ).alias("s")).scalar()
    n, avgdl = stats["n"], stats["avgdl"]
    dl = F.size(toks)
    score, any_hit = None, None
    for i, w in enumerate(q):
        f, dfi = _term_count(toks, w), stats[f"df{i}"]
        idf = F.log(F.lit(1.0) + (n - dfi + F.lit(0.5)) / (dfi + F.lit(0.5)))
        term = F.when(f > 0, idf * f * F.lit(k1 + 1) / (f + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / avgdl)))
        term = term.otherwise(F.lit(0.0))
        score = term if score is None else score + term
        any_hit = (f > 0) if any_hit is None else (any_hit | (f > 0))
    return df.withColumn(score_col, F.when(any_hit, score))


def bm25_top(df: DataFrame, id_col: str, text_col: str, query: str, k: int, digits: int | None = 6,
             k1: float = K1, b: float = B) -> DataFrame:
    """The ``k`` best-scoring documents (ties by id); documents without a query term never qualify.

    Null scores sort last and are dropped after the top-k, so no filter is pushed under the exchange.
    """
    s = bm25_scores(df, id_col, text_col, query, k1, b)
    if digits is not None:
        s = s.withColumn("score", F.round("score", digits))
    return top_k(s, k, F.desc_nulls_last("score"), F.asc(id_col)).where(F.col("score").isNotNull())


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """First ``k`` rows in a total order (planned as a top-k, no full sort)."""
    return df.orderBy(*order).limit(k)


def page(df: DataFrame, page_no: int, page_size: int, *order, after: Column | None = None) -> DataFrame:
    """Rows ``(page_no-1)*page_size`` .. ``+page_size`` in a total order (page past the end -> empty).

    A deep page gathers offset + size rows in one step; with ``after`` (a predicate that holds for the rows
    behind the last one shown) and ``page_no`` 1 it gathers ``page_size`` rows at any depth.
    """
    if page_no < 1 or page_size < 1:
        raise ValueError("page_no and page_size start at 1")
    rows = df if after is None else df.where(after)
    return rows.orderBy(*order).offset((page_no - 1) * page_size).limit(page_size)


def facets(df: DataFrame, buckets: dict[str, Column | str]) -> DataFrame:
    """``(facet, name, n, total)``: counts of every bucket of every facet, in one pass over ``df`` (grouping sets).

    ``buckets``: facet -> its column (names as text). Rows without a value are in ``total`` and in no bucket; the row
    with facet and name ``total`` is there even without any hit.
    """
    cols = {name: (F.col(c) if isinstance(c, str) else c).cast("string") for name, c in buckets.items()}
    names = list(cols)
    grouped = df.select(*[c.alias(f"__{k}") for k, c in cols.items()]).groupingSets(
        [[F.col(f"__{k}")] for k in names] + [[]], *[F.col(f"__{k}") for k in names])
    counts = grouped.agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__g"))
    # in the grouping id, the bit of a column that is grouped by is 0
    full = 2 ** len(names) - 1
    facet, name = F.lit("total"), F.lit("total")
    for i, k in enumerate(names):
        here = F.col("__g") == full - 2 ** (len(names) - 1 - i)
        facet, name = F.when(here, F.lit(k)).otherwise(facet), F.when(here, F.col(f"__{k}")).otherwise(name)
    rows = counts.select(facet.alias("facet"), name.alias("name"), "n")
    # without any row there is no grouping set either: the total's row is always added
    none = df.sparkSession.range(1).select(F.lit("total").alias("facet"), F.lit("total").alias("name"), F.lit(0).cast("long").alias("n"))
    rows = rows.unionByName(none).groupBy("facet", "name").agg(F.sum("n").alias("n"))
    total = F.max(F.when(F.col("facet") == "total", F.col("n"))).over(Window.partitionBy())   # over the bucket rows
    return rows.withColumn("total", total).where(F.col("name").isNotNull())


def top_terms(df: DataFrame, col: str, n: int, count_col: str = "n") -> DataFrame:
    """Top ``n`` values of ``col`` by count (ties by value); null values are not a bucket."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    return counts.orderBy(F.desc(count_col), F.asc(col)).limit(n)
