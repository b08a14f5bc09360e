"""More registered queries: crawl planning (X13, X14), nested posts and
their explosion (R1-R5), comment cleaning (C5, C6), row masks (R18, R19),
tokenizing (K1, K2), training log (M3, M4, M14) and class export (M15).

Every query reads whole driver tables (through the fixture views) and,
where SQL can express it, carries the same result as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from threadscope.catalog import query
from threadscope.operators import cleaning as C
from threadscope.operators import extract as X
from threadscope.operators import keywords as K
from threadscope.operators import lexicon as L
from threadscope.operators import model as M
from threadscope.operators import relational as R
from threadscope.plans.sql_cleaning import cleaned
from threadscope.plans.sql_keywords import SQL_SPACE
from threadscope.plans.sql_keywords import SQL_STOP as _SQL_STOP
from threadscope.plans.sql_keywords import SQL_TOKENS as _SQL_TOKENS
from threadscope.session import scratch_path
from threadscope.sources import fixtures as fx
from threadscope.sources import tables
from threadscope.sources.fixtures import with_fx

# --- X13 / X14: crawl planning over the stored pages ------------------------

# Board plans derived per page: PTT counts down from 900 + page_id % 61 for
# page_id % 4 pages; Bahamut pages page_id % 5 .. page_id % 7 (inclusive,
# invalid ranges give nothing).


@query("x13_board_pages", sql="""
SELECT page_id, 'ptt' AS site, p AS page,
       'https://www.ptt.cc/bbs/PokemonGO/index' || p || '.html' AS url
FROM (SELECT page_id, unnest(CASE WHEN page_id % 4 >= 1
                                  THEN range(900 + page_id % 61, 900 + page_id % 61 - page_id % 4, -1)
                                  ELSE [] END) AS p FROM pages)
UNION ALL
SELECT page_id, 'baha' AS site, p AS page,
       'https://forum.gamer.com.tw/B.php?page=' || p || '&bsn=29659' AS url
FROM (SELECT page_id, unnest(CASE WHEN page_id % 5 >= 1 AND page_id % 7 >= page_id % 5
                                  THEN range(page_id % 5, page_id % 7 + 1) ELSE [] END) AS p FROM pages)""")
def x13_board_pages(spark, sf):
    pages = fx.read_table(spark, sf, "pages").select("page_id")
    start = F.lit(900) + F.col("page_id") % 61
    ptt = pages.select("page_id", F.lit("ptt").alias("site"),
                       F.explode(X.plan_ptt_index_pages(start, F.col("page_id") % 4)).alias("page")) \
               .withColumn("url", X.ptt_board_url(F.lit("PokemonGO"), F.col("page")))
    baha = pages.select("page_id", F.lit("baha").alias("site"),
                        F.explode(X.plan_baha_board_pages(F.col("page_id") % 5, F.col("page_id") % 7))
                        .alias("page")) \
                .withColumn("url", X.baha_board_url(F.lit(29659), F.col("page")))
    return R.union_all([ptt, baha]).withColumn("page", F.col("page").cast("bigint"))


_SQL_LANG = "regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1)"


@query("x14_dcard_urls", sql=f"""
SELECT page_id, mode, q, forum,
       CASE mode WHEN 'topic' THEN 'https://www.dcard.tw/topics/' || q || '?tab=latest'
                 WHEN 'search' THEN CASE WHEN forum != '' THEN 'https://www.dcard.tw/f/' || forum || '?tab=latest'
                                         ELSE 'https://www.dcard.tw/search/posts?query=' || q || '&sort=latest' END
                 ELSE 'https://www.dcard.tw/f/' || q || '?tab=latest' END AS front_url,
       CASE mode WHEN 'topic' THEN 'https://www.dcard.tw/service/api/v3/search/posts?query=' || q
                                   || '&field=topics&highlight=false&sort=latest&country=TW&nsfw=true&platform=web'
                 WHEN 'search' THEN 'https://www.dcard.tw/service/api/v3/search/posts?query=' || q
                                   || CASE WHEN forum != '' THEN '&forum=' || forum ELSE '' END || '&field=all&highlight=false&sort=latest&country=TW&nsfw=true&platform=web'
                 ELSE 'https://www.dcard.tw/service/api/v3/forums/' || q || '/posts?sort=new' END AS api_url,
       'https://www.dcard.tw/service/api/v3/posts/' || page_id || '/comments?limit=5&sort=oldest' AS comments_url
FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'topic' WHEN 1 THEN 'search' ELSE 'forum' END AS mode,
             CASE page_id % 6 WHEN 1 THEN 'host' || page_id WHEN 4 THEN '' END AS forum,
             {_SQL_LANG} AS q FROM pages)""")
def x14_dcard_urls(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    mode = F.when(F.col("page_id") % 3 == 0, "topic").when(F.col("page_id") % 3 == 1, "search").otherwise("forum")
    # Every other search stays inside a forum; an empty forum counts as none.
    forum = F.when(F.col("page_id") % 6 == 1, F.concat(F.lit("host"), F.col("page_id").cast("string"))) \
        .when(F.col("page_id") % 6 == 4, F.lit(""))
    d = pages.select("page_id", mode.alias("mode"), forum.alias("forum"),
                     F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1).alias("q"))
    u = X.dcard_urls(F.col("mode"), F.col("q"), F.col("forum"))
    return d.select("page_id", "mode", "q", "forum", u["front_url"].alias("front_url"), u["api_url"].alias("api_url"),
                    X.dcard_comments_url(F.col("page_id"), F.lit(5)).alias("comments_url"))


# --- R1-R5: nested posts -> long table ----------------------------------------

@query("r3_explode_comments", sql=with_fx("""
SELECT p.doc_id, p.platform, p.title, p.total_reac, p.comment_count,
       CASE WHEN c.post_key IS NOT NULL
            THEN row_number() OVER (PARTITION BY p.doc_id ORDER BY c.pos) - 1 END AS comment_pos,
       c.comment_tag, c.comment_author, c.comment
FROM (SELECT p.*, (SELECT count(*) FROM fx_comments c WHERE c.post_key = p.doc_id) AS comment_count
      FROM fx_posts p) p
LEFT JOIN fx_comments c ON c.post_key = p.doc_id""", "fx_posts", "fx_comments"))
def r3_explode_comments(spark, sf):
    nested = fx.fx_nested_posts(spark, sf).select("doc_id", "platform", "title", "total_reac",
                                                  "comment_count", "comments_data")
    return R.explode_comments(nested, "comments_data", "comment_pos").select(
        "doc_id", "platform", "title", "total_reac", "comment_count", "comment_pos",
        "comment_tag", "comment_author", "comment")


# --- C5 / C6 ------------------------------------------------------------------

@query("c5_clean_comments", sql=with_fx(f"""
SELECT post_key, pos, comment_author, comment FROM {cleaned('fx_comments', 'comment')} WHERE length(comment) >= 6""", "fx_comments"))
def c5_clean_comments(spark, sf):
    return C.clean_comments(fx.fx_comments(spark, sf)).select("post_key", "pos", "comment_author", "comment")


@query("c6_drop_commentless_posts", sql=with_fx("""
SELECT doc_id, platform FROM fx_posts
WHERE doc_id IN (SELECT post_key FROM fx_comments WHERE length(comment) >= 6)""", "fx_posts", "fx_comments"))
def c6_drop_commentless_posts(spark, sf):
    kept = fx.fx_comments(spark, sf).filter(F.length("comment") >= C.MIN_COMMENT_LEN)
    posts = fx.fx_posts(spark, sf).select(F.col("doc_id").alias("post_key"), "platform")
    return C.drop_commentless_posts(posts, kept, "post_key").withColumnRenamed("post_key", "doc_id")


# --- R18 / R19 ----------------------------------------------------------------

@query("r18_row_masks", sql=with_fx("""
SELECT doc_id, platform, total_reac FROM fx_posts
WHERE total_reac IS DISTINCT FROM '爆' AND platform = 'ptt' AND author != 'web'""", "fx_posts"))
def r18_row_masks(spark, sf):
    p = fx.fx_posts(spark, sf)
    mask = R.ne_pandas(F.col("total_reac"), "爆") & (F.col("platform") == "ptt") & (F.col("author") != "web")
    return p.filter(mask).select("doc_id", "platform", "total_reac")


@query("r19_fill_and_drop", sql=with_fx("""
SELECT doc_id, coalesce(total_reac, '') AS total_reac, comment_count FROM (
  SELECT p.doc_id, p.total_reac, c.n AS comment_count FROM fx_posts p
  LEFT JOIN (SELECT post_key, count(*) AS n FROM fx_comments GROUP BY post_key) c ON c.post_key = p.doc_id)
WHERE comment_count IS NOT NULL""", "fx_posts", "fx_comments"))
def r19_fill_and_drop(spark, sf):
    counts = fx.fx_comments(spark, sf).groupBy(F.col("post_key").alias("doc_id")) \
        .agg(F.count(F.lit(1)).alias("comment_count"))
    p = fx.fx_posts(spark, sf).select("doc_id", "total_reac").join(counts, "doc_id", "left")
    return R.drop_missing(R.fill_blank(p, ["total_reac"]), ["comment_count"])


# --- K1 / K2 ------------------------------------------------------------------



@query("k1_segment", sql=with_fx(f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {_SQL_TOKENS} AS t FROM fx_scored)""", "fx_scored"))
def k1_segment(spark, sf):
    t = K.segment(F.col("comment"))
    return fx.fx_scored(spark, sf).select("doc_id", F.size(t).cast("bigint").alias("n_tokens"),
                                          F.array_join(t, " ").alias("tokens"))


@query("k2_filter_tokens", sql=with_fx(f"""
SELECT doc_id, len(k) AS n_kept, array_to_string(k, ' ') AS kept FROM (
  SELECT doc_id, list_filter({_SQL_TOKENS}, lambda t: NOT list_contains({_SQL_STOP}, t)
                 AND (length(t) >= 2 OR regexp_matches(t, '^\\p{{L}}+$'))) AS k FROM fx_scored)""", "fx_scored"))
def k2_filter_tokens(spark, sf):
    k = K.filter_tokens(K.segment(F.col("comment")))
    return fx.fx_scored(spark, sf).select("doc_id", F.size(k).cast("bigint").alias("n_kept"),
                                          F.array_join(k, " ").alias("kept"))


# --- K1 / R11 with long word lists ----------------------------------------------

#: Words of the conversations that occur at least 20 times: a list that grows with the data.
_SQL_WORDS = """(SELECT word FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{3,}')) AS word FROM conversations)
                 GROUP BY word HAVING count(*) >= 20)"""


def _long_list(spark, sf):
    talks = fx.read_table(spark, sf, "conversations")
    words = talks.select(F.explode(F.regexp_extract_all("text", F.lit(r"([A-Za-z]{3,})"), F.lit(1))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("times")).filter("times >= 20").select("word")


@query("k1_segment_long_list", sql=f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, coalesce(regexp_extract_all(text, (SELECT '(' || string_agg(word || '|', '' ORDER BY length(word) DESC, word)
                                                        || '[A-Za-z0-9]+|[^A-Za-z0-9{SQL_SPACE}])' FROM {_SQL_WORDS})), []) AS t FROM documents)""")
def k1_segment_long_list(spark, sf):
    docs = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    out = L.segment_long(docs, _long_list(spark, sf), "text", "doc_id")
    return out.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query("r11_match_long_list", sql=f"""
SELECT doc_id, text FROM documents
WHERE EXISTS (SELECT 1 FROM (SELECT word FROM {_SQL_WORDS} WHERE length(word) >= 6) WHERE contains(lower(text), lower(word)))""")
def r11_match_long_list(spark, sf):
    docs = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    return L.match_long(docs, _long_list(spark, sf).filter(F.length("word") >= 6), "text", "doc_id")


# --- M3 / M4 / M14 --------------------------------------------------------------

@query("m14_loss_history", note="fits a classifier (iterative optimiser); rows-only")
def m14_loss_history(spark, sf):
    """Train and evaluation loss after each epoch over the labelled comments,
    evaluated on the test side of the split; the log's other entries go."""
    split = M.stratified_split(fx.fx_labelled(spark, sf), "label", "doc_id").persist()
    try:
        train, test = (split.filter(F.col("split") == side) for side in ("train", "test"))
        model = M.train_sentiment(train, "comment", evaluation=test)
    finally:
        split.unpersist()
    return M.loss_history(M.training_log(model, spark))


# --- M5: a network from outside -----------------------------------------------

#: A stand-in for a trained network: weights of three features for each class, in steps of 1/1024.
_NETWORK = [[40, -9, 3], [-20, 12, 1], [6, 2, -30]]


def _load_network():
    """What a user passes: loads the model, once a worker, and returns the function that scores a batch."""
    import numpy as np
    weights = np.array(_NETWORK, float).T / 1024

    def predict(texts: np.ndarray) -> np.ndarray:
        features = [[t.count("e"), t.count(" "), t.count(".")] for t in texts.tolist()]
        return np.minimum(np.array(features, float).reshape(-1, 3), 200.0) @ weights

    return predict


_SQL_LOGITS = ", ".join("(" + " + ".join(f"{w} * least(length(t) - length(replace(t, '{c}', '')), 200)" for w, c in zip(row, "e .", strict=True)) + ") / 1024.0::DOUBLE"
                        for row in _NETWORK)


@query("m5_external_scores", sql=with_fx(f"""
SELECT doc_id, logits, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS predict_label
FROM (SELECT doc_id, [{_SQL_LOGITS}] AS logits FROM (SELECT doc_id, coalesce(content, '') AS t FROM fx_posts))""", "fx_posts"))
def m5_external_scores(spark, sf):
    """All posts scored by a model from outside, in batches of 32."""
    posts = fx.fx_posts(spark, sf).select("doc_id", F.col("content").alias("comment"))
    return M.score_external(posts, _load_network).select("doc_id", "logits", "predict_label")


# --- M15 + S4 / S5: one predicted class through CSV ---------------------------

@query("m15_export_class_csv", sql=with_fx(
    "SELECT doc_id, platform, comment, predict_label FROM fx_scored WHERE predict_label = 0", "fx_scored"))
def m15_export_class_csv(spark, sf):
    import uuid
    path = scratch_path(spark, f"export-{uuid.uuid4().hex}")
    out = M.export_class(fx.fx_scored(spark, sf), 0)
    if not tables.write_csv(out, path):
        return out.limit(0)
    return tables.read_csv(spark, path, "doc_id bigint, platform string, comment string, predict_label int")
