"""Registered queries of the corpus operators: ``opN_<name>`` over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm import bpe, decontaminate, htmltext, langid, negatives, ngram_join, pii, quality, secret_scan, sketch, spelling, toxicity, vector_dedup
from martpulse.llm.common import fold_of, read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Vocabulary files of the public tokenizers that the queries use.
BPE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


#: Pieces of the DuckDB SQL: A-Z lower-cased, and words of operator 6 and 7.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS6 = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WORDS7 = f"list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
#: (id, smallest id reachable) over the links (a, b) of both directions.
_REACH = "reach AS (SELECT id, id AS c FROM node UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.c)"


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return keep


@query()
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.report(spark, read(spark, sf_dir, "documents", "doc_id", "text"),
                               secret_scan.dictionary_of(spark, WORD_VOCABULARY))
    return found.select("doc_id", "n_candidates", "n_secrets",
                        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["start"] + s["size"])), ",").alias("spans"),
                        "top_score")


@query()
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.find_pii(read(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select(
        "doc_id", *[pii.kind_count(F.col("pii"), k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(pii.digest(F.col("pii"), pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.digest(F.col("pii")).alias("spans"),
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("top_score"))


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read(spark, sf_dir, "documents", "doc_id", "text"), fold_of("doc_id", 5)
    labels = read(spark, sf_dir, "labels", "doc_id", "quality").where(fold != 0)
    pooler, net = quality.train(spark, docs, labels)
    return quality.score(spark, docs, pooler, net).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.BpeTokenizer(spark, BPE_VOCABULARY)
    both = codec.encode(read(spark, sf_dir, "documents", "doc_id", "text"), decoded="decoded")
    return both.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = fold_of("doc_id", 4)
    learn = read(spark, sf_dir, "documents", "doc_id", "text", "lang").where(fold != 2)
    model = langid.train(spark, learn, PIECE_VOCABULARY)
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return langid.predict(spark, docs, model).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query(f"""WITH d AS (SELECT doc_id, {_WORDS6} AS w FROM documents),
  b AS (SELECT item_id, {_WORDS6} AS w, least(len({_WORDS6}), 10) AS k FROM benchmark WHERE item_id IS NOT NULL),
  win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM b, unnest(range(1, len(w) - k + 2)) t(i) WHERE k > 0),
  dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k FROM d, (SELECT DISTINCT k FROM win)),
    unnest(range(1, len(w) - k + 2)) t(i)),
  hits AS (SELECT doc_id, i, k, item_id FROM dw JOIN win USING (k, s)),
  cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, k FROM hits), unnest(range(i, i + k)) u(p) GROUP BY 1),
  it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY 1)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)""")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(spark, read(spark, sf_dir, "documents", "doc_id", "text"),
                                 read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query(f"""WITH RECURSIVE d AS (SELECT doc_id AS id, {_WORDS7} AS w FROM documents), node AS (SELECT id FROM d),
  sh AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
  n AS (SELECT id, count(*) AS n FROM sh GROUP BY 1),
  pair AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
  link AS (SELECT a, b FROM pair JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
  {_REACH}
  SELECT r.id AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
  FROM reach r LEFT JOIN n ON n.id = r.id GROUP BY r.id""")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(spark, read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id")


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    chain = toxicity.train(spark, docs, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return toxicity.score(spark, docs, chain).select(
        "doc_id", *[f"p_{c}" for c in toxicity.CATEGORIES], F.col("p_toxic").alias("score"),
        F.col("is_toxic").alias("toxic"))


@query()
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    out = htmltext.extract(spark, pages, htmltext.train(spark, pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query(f"""WITH RECURSIVE v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), node AS (SELECT id FROM v),
  ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
  link AS (SELECT a.id AS a, b.id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.id <> b.id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
  deg AS (SELECT a AS id, count(*) AS n FROM link GROUP BY 1),
  {_REACH}
  SELECT r.id AS vec_id, coalesce(any_value(deg.n), 0) AS n_links, min(c) AS component_id, r.id = min(c) AS kept
  FROM reach r LEFT JOIN deg ON deg.id = r.id GROUP BY r.id""")
def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_dedup.classes(spark, read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


@query("""WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id AS id, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
    FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id AND len(a.e) = len(v.e)),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
    id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
  QUALIFY rank <= 5""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark, rows, F.col("vec_id") % 100 == 0, label=label)


@query(f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
  o AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first(t) OVER (ORDER BY doc_id DESC)) AS u FROM d),
  x AS (SELECT doc_id, 0 AS k, t AS text FROM o UNION ALL SELECT doc_id, 1, left(t, n - n // 3) || left(u, n // 3) FROM o UNION ALL SELECT doc_id, 2, u FROM o),
  w AS (SELECT doc_id, k, text, {_WORDS7} AS w FROM x),
  h AS (SELECT doc_id, k, text, list_sort(list_distinct(list_transform(CASE WHEN len(w) >= 5 THEN range(1, len(w) - 3) WHEN len(w) > 0 THEN [1] ELSE [] END,
    lambda i: left(md5(array_to_string(w[i:i + 4], ' ')), 15)))) AS h FROM w),
  l AS (SELECT *, list_filter(h, lambda y: y < '2') AS low FROM h),
  f AS (SELECT doc_id, k, text, CASE WHEN len(low) >= 16 THEN low ELSE h[1:16] END AS h, len(low) < 16 AND len(h) <= 16 AS whole FROM l),
  g AS (SELECT *, CASE WHEN whole THEN 'g' ELSE greatest('1ffffffffffffff', h[-1]) END AS upto,
    CASE WHEN whole THEN 'all:' ELSE 'low:' END || array_to_string(h, ',') AS s FROM f),
  p AS (SELECT a.doc_id, b.k, a.s AS fingerprint, b.s AS other, b.text, len(a.h) + len(b.h) = 0 AS empty,
      list_filter(a.h, lambda y: y <= least(a.upto, b.upto)) AS x, list_filter(b.h, lambda y: y <= least(a.upto, b.upto)) AS y
    FROM g a JOIN g b ON a.doc_id = b.doc_id AND a.k = 0 AND b.k > 0),
  q AS (SELECT *, len(list_intersect(x, y)) AS m FROM p),
  r AS (SELECT *, CASE WHEN empty THEN 1.0 ELSE coalesce(CAST(m AS DOUBLE) / nullif(least(len(x), len(y)), 0), 0.0) END AS near,
    CASE WHEN empty THEN 1.0 ELSE coalesce(CAST(m AS DOUBLE) / nullif(len(x) + len(y) - m, 0), 0.0) END AS jac FROM q)
  SELECT d.doc_id, d.n AS n_chars, sha256(e.text) AS edited_sha256, e.fingerprint, e.other AS edited_fingerprint,
    CAST(e.near AS DOUBLE) AS near_edited, CAST(v.near AS DOUBLE) AS near_next, CAST(e.jac AS DOUBLE) AS jaccard_edited, CAST(v.jac AS DOUBLE) AS jaccard_next
  FROM d JOIN r e ON e.doc_id = d.doc_id AND e.k = 1 JOIN r v ON v.doc_id = d.doc_id AND v.k = 2""")
def op12_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.report(spark, read(spark, sf_dir, "documents", "doc_id", "text"))


@query("""WITH RECURSIVE crc0 AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i) UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc0 WHERE k < 8),
  crc AS (SELECT list(c ORDER BY i) AS t FROM crc0 WHERE k = 8),
  run AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
  one AS (SELECT id, run, count(*) AS m, hex(encode(id || ':' || run)) AS x FROM run WHERE length(run) >= 5 GROUP BY 1, 2),
  h AS (SELECT run, m, xor(4294967295, list_reduce(list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT)),
    lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8), 4294967295)) AS h FROM one, crc),
  word AS (SELECT w, CAST(sum(m) AS BIGINT) AS n FROM (SELECT m, CASE WHEN h % 97 = 0
      THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS w FROM h)
    WHERE length(w) >= 5 GROUP BY 1 HAVING sum(m) >= 3),
  place AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word),
  gap AS (SELECT w, n, left(w, i - 1) || '*' || substr(w, i + 1) AS g, left(w, i - 1) || substr(w, i + 1) AS d FROM place),
  pair AS (SELECT a.w AS a, b.w AS b FROM gap a JOIN gap b ON a.g = b.g AND a.w <> b.w
    UNION SELECT gap.w, word.w FROM gap JOIN word ON word.w = d UNION SELECT word.w, gap.w FROM gap JOIN word ON word.w = d),
  best AS (SELECT a AS w, count(*) AS n_near, first(b ORDER BY word.n DESC, encode(b)) AS form, max(word.n) AS form_n
    FROM pair JOIN word ON word.w = b GROUP BY 1),
  named AS (SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * word.n THEN form END AS form,
    CASE WHEN form_n >= 2 * word.n THEN form_n END AS form_n FROM word LEFT JOIN best USING (w)),
  chain AS (SELECT w, coalesce(form, w) AS r, form IS NOT NULL AS more FROM named UNION ALL
    SELECT chain.w, form, true FROM chain JOIN named ON named.w = chain.r WHERE more AND form IS NOT NULL),
  last AS (SELECT w, r FROM chain JOIN (SELECT w AS r, form AS f FROM named) USING (r) WHERE f IS NULL)
  SELECT w AS word, form, r AS root, n, n_near, form_n FROM named JOIN last USING (w)""")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, read(spark, sf_dir, "documents", "doc_id", "text"))
