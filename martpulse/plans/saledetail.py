"""Sale-detail search (Q-4): hits of a date + keyword, their total, gender and age-band shares, one page.

All parts derive from one filtered DataFrame. Shares are computed from bucket counts: the data is
aggregated once per bucket, and the total is a sum over those few bucket rows (a window over at most
a handful of rows), so no second pass over the hits is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from martpulse.functions.text import unicode_words
from martpulse.operators.search import facets, match_all, page, top_terms, with_bm25

# Age bands (upper bounds exclusive) and their labels.
AGE_BANDS = (("<20", 20), ("20-29", 30), ("30+", None))


def percent_1dp(count, total):
    """Percent with one decimal, half rounded up: floor(count * 1000 / total + 0.5) / 10; null if total 0."""
    return F.when(total > 0, F.floor(count * F.lit(1000.0) / total + F.lit(0.5)) / F.lit(10.0))


def age_band(age="user_age"):
    c = F.col(age) if isinstance(age, str) else age
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for label, upper in AGE_BANDS:
        if upper is None:
            expr = expr.otherwise(F.lit(label))
        else:
            expr = expr.when(c < upper, F.lit(label))
    return expr


def _shares(df: DataFrame, bucket, name: str, drop_null: bool) -> DataFrame:
    counts = df.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("__n"))
    total = F.sum("__n").over(Window.partitionBy())   # over the few bucket rows only
    out = counts.select(name, percent_1dp(F.col("__n"), total).alias("pct"))
    return out.where(F.col(name).isNotNull()) if drop_null else out


def gender_share(hits: DataFrame) -> DataFrame:
    """``(user_gender, pct)``: share of hits per gender (hits without gender count in the total)."""
    return _shares(hits, F.col("user_gender"), "user_gender", drop_null=True)


def age_band_share(hits: DataFrame) -> DataFrame:
    """``(band, pct)``: share of hits per age band."""
    return _shares(hits, age_band(), "band", drop_null=False)


def search_hits(sales: DataFrame, date: str, keyword: str) -> DataFrame:
    """Exact day filter (cheap, first) and all-words match on ``sku_name``, in any script."""
    return match_all(sales.where(F.col("dt") == date), "sku_name", keyword, unicode_words)


def sale_facets(sales: DataFrame, date: str, keyword: str) -> DataFrame:
    """``(facet, name, n, pct)``: total, gender, age and age-band buckets of a search, from one scan of the hits."""
    hits = search_hits(sales, date, keyword)
    found = facets(hits, {"gender": "user_gender", "age": "user_age", "band": age_band()})
    return found.select("facet", "name", "n", percent_1dp(F.col("n"), F.col("total")).alias("pct"))


def sale_detail(sales: DataFrame, date: str, keyword: str, page_no: int, page_size: int,
                gender_top: int = 2, age_top: int = 100) -> dict[str, DataFrame]:
    """The parts of one search response, all lazy views of the same hits."""
    hits = search_hits(sales, date, keyword)
    return {
        "total": hits.agg(F.count(F.lit(1)).alias("total")),
        "gender_terms": top_terms(hits, "user_gender", gender_top),
        "age_terms": top_terms(hits, "user_age", age_top),
        "gender_share": gender_share(hits),
        "age_share": age_band_share(hits),
        "page": page(hits, page_no, page_size, F.col("order_detail_id")),
    }


def sale_detail_stats(sales: DataFrame, date: str, keyword: str) -> DataFrame:
    """Both share charts of a search as rows ``(stat, name, pct)``: one pass over the hits, then a few counts."""
    agg = search_hits(sales, date, keyword).agg(*_option_counts())
    rows = F.array(*[F.struct(F.lit(stat).alias("stat"), F.lit(name).alias("name"), F.col(c).alias("n"))
                     for stat, name, c in _OPTIONS])
    return (agg.select("total", F.explode(rows).alias("r")).where("r.n > 0")
            .select("r.stat", "r.name", percent_1dp(F.col("r.n"), F.col("total")).alias("pct")))


def relevance_page(sales: DataFrame, date: str, keyword: str, page_no: int, page_size: int,
                   digits: int | None = 6, corpus: DataFrame | None = None) -> DataFrame:
    """One page of hits by BM25 relevance of ``sku_name`` (ties by ``order_detail_id``).

    Statistics cover ``corpus``, the whole sale table (default: ``sales``); the day and keyword filters pick the
    hits. A caller whose ``sales`` already holds only the day passes the names of the whole table.
    """
    hits = search_hits(sales, date, keyword)
    scored = with_bm25(hits, "sku_name", keyword, sales if corpus is None else corpus, words=unicode_words)
    if digits is not None:
        scored = scored.withColumn("score", F.round("score", digits))
    return page(scored, page_no, page_size, F.desc("score"), F.asc("order_detail_id"))


# Options of the two share charts, in display order.
GENDER_OPTIONS = ("M", "F")
_OPTIONS = ([("gender", g, f"g_{g}") for g in GENDER_OPTIONS]
            + [("age", label, f"a_{i}") for i, (label, _u) in enumerate(AGE_BANDS)])


def _option_counts():
    """Conditional counts of every chart option, and the total."""
    counts = [F.count(F.lit(1)).alias("total")]
    counts += [F.count(F.when(F.col("user_gender") == name, 1)).alias(c) for stat, name, c in _OPTIONS if stat == "gender"]
    return counts + [F.count(F.when(age_band() == name, 1)).alias(c) for stat, name, c in _OPTIONS if stat == "age"]


def sale_detail_response(sales: DataFrame, date: str, keyword: str, page_no: int, page_size: int) -> DataFrame:
    """The whole search response as one JSON row ``{"total", "stat": [...], "detail": [...]}``.

    Total and both share charts come from one aggregate pass with conditional counts (fixed options:
    a missing bucket is 0 %, a zero total gives null); the page (at most ``page_size`` rows) is a
    scalar subquery, not a join.
    """
    from martpulse.operators.widen import SALE_COLUMNS

    hits = search_hits(sales, date, keyword)
    agg = hits.agg(*_option_counts())
    total = F.col("total")
    stat = F.array(
        F.struct(F.lit("gender").alias("title"), F.array(*[
            F.struct(F.lit(g).alias("name"), percent_1dp(F.col(f"g_{g}"), total).alias("value"))
            for g in GENDER_OPTIONS]).alias("options")),
        F.struct(F.lit("age").alias("title"), F.array(*[
            F.struct(F.lit(label).alias("name"), percent_1dp(F.col(f"a_{i}"), total).alias("value"))
            for i, (label, _u) in enumerate(AGE_BANDS)]).alias("options")))
    rows = page(hits, page_no, page_size, F.col("order_detail_id")).select(*SALE_COLUMNS)
    # page rows sorted by their first field (order_detail_id); an empty page is []
    detail = rows.agg(F.array_sort(F.collect_list(F.struct(*SALE_COLUMNS))).alias("d")).scalar()
    body = F.struct(total.alias("total"), stat.alias("stat"), detail.alias("detail"))
    return agg.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("response"))
