"""Registered page-extraction queries.

The pages are rendered by Spark from the fixture posts and comments
(``threadscope.sources.rendered``), parsed back by the extractors, and
compared with the fixture rows computed directly in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from threadscope.catalog import query
from threadscope.operators import extract as X
from threadscope.operators import relational as R
from threadscope.sources import fixtures as fx
from threadscope.sources import rendered
from threadscope.sources.fixtures import with_fx

# Python's str.strip() white space, as an RE2 class for the oracle SQL.
_PY_WS = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_PY_WS}+|{_PY_WS}+$', '', 'g')"


def _rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{_PY_WS}+$', '')"


_SQL_VOTES = """(SELECT post_key, CAST(count_if(comment_tag = '推') AS BIGINT) AS lk,
                        CAST(count_if(comment_tag = '噓') AS BIGINT) AS ul,
                        count(*) AS n FROM fx_comments GROUP BY post_key)"""


# --- X1 / X3: PTT article pages -> long table --------------------------------

@query("x1_ptt_articles", sql=with_fx(f"""
SELECT p.doc_id, p.post_time,
       {_strip("p.content || CASE WHEN p.doc_id % 10 = 9 THEN '推 : broken' ELSE '' END")} AS content,
       coalesce(v.lk, 0) AS "like", coalesce(v.ul, 0) AS unlike,
       CAST(coalesce(v.lk, 0) - coalesce(v.ul, 0) AS VARCHAR) AS total_reac, coalesce(v.n, 0) AS comment_count,
       CASE WHEN c.post_key IS NOT NULL THEN row_number() OVER (PARTITION BY p.doc_id ORDER BY c.pos) - 1 END
         AS comment_pos,
       c.comment_tag, c.comment_author, ' ' || {_rstrip("c.comment")} AS comment
FROM fx_posts p LEFT JOIN {_SQL_VOTES} v ON v.post_key = p.doc_id
LEFT JOIN fx_comments c ON c.post_key = p.doc_id
""", "fx_posts", "fx_comments"))
def x1_ptt_articles(spark, sf):
    pages = rendered.ptt_article_pages(fx.fx_nested_posts(spark, sf))
    arts = X.extract_ptt_articles(pages)
    long = R.explode_comments(arts.select("page_id", "post_time", "content", "like", "unlike", "total_reac",
                                          "comment_count", "comments_data"), "comments_data", "comment_pos")
    return long.select(F.col("page_id").alias("doc_id"), "post_time", "content", "like", "unlike", "total_reac",
                       "comment_count", "comment_pos", "comment_tag", "comment_author", "comment")


# --- X2: PTT board listing joined to its articles ------------------------------

@query("x2_ptt_board_posts", sql=with_fx(f"""
SELECT 'https://www.ptt.cc/bbs/PokemonGO/M.' || p.doc_id || '.A.html' AS post_url, {_strip("p.title")} AS title,
       p.author, p.post_time, CAST(coalesce(v.lk, 0) - coalesce(v.ul, 0) AS VARCHAR) AS total_reac,
       coalesce(v.n, 0) AS comment_count
FROM fx_posts p LEFT JOIN {_SQL_VOTES} v ON v.post_key = p.doc_id
WHERE p.doc_id % 7 != 0""", "fx_posts", "fx_comments"))
def x2_ptt_board_posts(spark, sf):
    nested = fx.fx_nested_posts(spark, sf)
    board = rendered.ptt_board_pages(nested.select("doc_id", "title", "author"))
    arts = rendered.ptt_article_pages(nested)
    return X.ptt_posts(board, arts).select("post_url", "title", "author", "post_time", "total_reac",
                                           "comment_count")


# --- X4: Bahamut thread pages -> one row per floor and reply -------------------

@query("x4_baha_floors", sql=with_fx(f"""
, f AS (SELECT p.*, p.doc_id // 5 AS page_id,
               row_number() OVER (PARTITION BY p.doc_id // 5 ORDER BY p.doc_id) - 1 AS floor_pos
        FROM fx_posts p),
t0 AS (SELECT page_id, arg_min(title, doc_id) AS first_title FROM f GROUP BY page_id)
SELECT f.page_id, f.floor_pos, 'Bahamut' AS platform,
       CASE WHEN f.doc_id % 9 != 8 THEN f.post_time END AS post_time,
       CASE WHEN f.doc_id % 4 != 3 THEN f.author ELSE 'Anonymous' END AS author,
       {_strip("CASE WHEN f.doc_id % 5 = 0 OR f.doc_id % 2 = 0 THEN f.title ELSE t0.first_title END")} AS title,
       {_strip("f.content")} AS content,
       CASE WHEN f.doc_id % 6 = 5 THEN '0' ELSE CAST(f.doc_id * 7 % 100 AS VARCHAR) END AS total_reac,
       coalesce(v.n, 0) AS comment_count,
       CASE WHEN c.post_key IS NOT NULL THEN row_number() OVER (PARTITION BY f.doc_id ORDER BY c.pos) - 1 END
         AS comment_pos,
       c.comment_author, {_strip("c.comment")} AS comment
FROM f JOIN t0 ON t0.page_id = f.page_id
LEFT JOIN {_SQL_VOTES} v ON v.post_key = f.doc_id
LEFT JOIN fx_comments c ON c.post_key = f.doc_id""", "fx_posts", "fx_comments").replace("\n\n, f AS", ",\nf AS", 1))
def x4_baha_floors(spark, sf):
    pages = rendered.baha_thread_pages(fx.fx_nested_posts(spark, sf))
    floors = X.extract_baha_floors(pages)
    long = R.explode_comments(floors, "comments_data", "comment_pos")
    return long.select("page_id", "floor_pos", "platform", "post_time", "author", "title", "content",
                       "total_reac", "comment_count", "comment_pos", "comment_author", "comment")


# --- X7-X10: Dcard listing and comment payloads -> long table -----------------

_SQL_DCARD = f"""
, d AS (SELECT p.*, p.doc_id // 10 AS page_id,
               row_number() OVER (PARTITION BY p.doc_id // 10 ORDER BY p.doc_id) - 1 AS post_pos,
               coalesce(v.n, 0) AS n_comments
        FROM fx_posts p LEFT JOIN {_SQL_VOTES} v ON v.post_key = p.doc_id),
c AS (SELECT post_key, pos, comment_author, comment,
             row_number() OVER (PARTITION BY post_key ORDER BY pos) - 1 AS i FROM fx_comments)
SELECT d.page_id, d.post_pos, d.doc_id AS id, 'Dcard' AS platform,
       CASE WHEN d.doc_id % 13 = 5 THEN NULL ELSE d.post_time END AS post_time,
       CASE WHEN d.doc_id % 4 >= 2 THEN CASE WHEN d.doc_id % 8 = 2 THEN 'dept' || (d.doc_id % 5) ELSE d.author END
            ELSE 'Anonymous' END AS author,
       CASE WHEN d.doc_id % 11 = 2 THEN '無標題' ELSE d.title END AS title,
       CASE WHEN d.doc_id % 6 = 5 THEN 'note ' || d.doc_id ELSE d.content END AS content,
       CASE WHEN d.doc_id % 10 = 8 THEN '0' ELSE CAST(d.doc_id % 50 AS VARCHAR) END AS total_reac,
       CASE WHEN d.doc_id % 7 = 3 THEN 0 ELSE d.n_comments END AS comment_count,
       c.i AS comment_pos,
       CASE WHEN c.post_key IS NULL THEN NULL WHEN c.i % 2 = 0 THEN 'Anonymous' ELSE c.comment_author END
         AS comment_author,
       c.comment
FROM d LEFT JOIN c ON c.post_key = d.doc_id"""


@query("x8_dcard_posts", sql=with_fx(_SQL_DCARD, "fx_posts", "fx_comments").replace("\n\n, d AS", ",\nd AS", 1))
def x8_dcard_posts(spark, sf):
    nested = fx.fx_nested_posts(spark, sf)
    listing = rendered.dcard_listing_pages(nested)
    cpages = rendered.dcard_comment_pages(nested)
    # The payload is parsed once per page into a column; the shape tests
    # below refer to it many times.
    listing = listing.select("page_id", X.page_to_json(F.col("html")).alias("payload"))
    cpages = cpages.select("page_id", X.page_to_json(F.col("html")).alias("payload"))
    posts = listing.select("page_id", F.posexplode(X.dcard_posts(F.col("payload")))
                           .alias("post_pos", "post")).withColumn("post_pos", F.col("post_pos").cast("bigint"))
    posts = posts.withColumn("id", F.try_variant_get("post", "$.id", "bigint")).filter(F.col("id").isNotNull())
    comments = cpages.select(F.col("page_id").alias("id"),
                             X.dcard_comments(F.col("payload")).alias("cm"))
    joined = posts.join(comments, "id", "left")
    rec = X.dcard_format(F.col("post"), F.coalesce(F.col("cm"), F.array().cast("array<variant>")))
    flat = joined.select("page_id", "post_pos", "id", rec.alias("r")).select("page_id", "post_pos", "id", "r.*")
    long = R.explode_comments(flat, "comments_data", "comment_pos")
    return long.select("page_id", "post_pos", "id", "platform", "post_time", "author", "title", "content",
                       "total_reac", "comment_count", "comment_pos", "comment_author", "comment")


# --- X11: paging cursor of each listing payload --------------------------------

@query("x11_next_cursor", sql=with_fx("""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN CAST(max(doc_id) AS VARCHAR) WHEN 1 THEN NULL
                                 ELSE 'k' || page_id END AS next_cursor
FROM (SELECT doc_id, doc_id // 10 AS page_id FROM fx_posts) GROUP BY page_id""",
                                      "fx_posts"))
def x11_next_cursor(spark, sf):
    listing = rendered.dcard_listing_pages(fx.fx_nested_posts(spark, sf))
    payload = listing.select("page_id", X.page_to_json(F.col("html")).alias("payload"))
    return payload.select("page_id", X.next_cursor(F.col("payload")).alias("next_cursor"))


# --- X5 / X6 / X12: Bahamut board pages ---------------------------------------

_SQL_TOTAL = "CASE WHEN page_id % 6 = 5 THEN 1 ELSE page_id % 13 + 1 END"


@query("x5_thread_ids", sql=with_fx("""
SELECT CAST(doc_id // 20 AS BIGINT) AS page_id, row_number() OVER (PARTITION BY doc_id // 20 ORDER BY doc_id) AS thread_pos,
       CAST(doc_id + 1000 AS VARCHAR) AS thread_id
FROM fx_posts WHERE doc_id % 9 != 4 AND doc_id % 11 != 6""", "fx_posts"))
def x5_thread_ids(spark, sf):
    """Thread ids of the title links of board pages, distinct and in order."""
    pages = rendered.baha_board_pages(fx.fx_posts(spark, sf))
    return pages.select("page_id", F.posexplode(X.extract_thread_ids(F.col("html"))).alias("pos", "thread_id")).select(
        "page_id", (F.col("pos") + 1).cast("bigint").alias("thread_pos"), "thread_id")


@query("x6_pager_pages", sql=with_fx(f"""
SELECT page_id, CAST({_SQL_TOTAL} AS INTEGER) AS max_page FROM (SELECT DISTINCT CAST(doc_id // 20 AS BIGINT) AS page_id FROM fx_posts)""", "fx_posts"))
def x6_pager_pages(spark, sf):
    """Number of pages by the pager of board pages; links elsewhere do not count."""
    pages = rendered.baha_board_pages(fx.fx_posts(spark, sf))
    return pages.select("page_id", X.max_page(F.col("html")).alias("max_page"))


@query("x12_planned_pages", sql=with_fx(f"""
SELECT page_id, CAST(reply_page AS BIGINT) AS reply_page,
       'https://forum.gamer.com.tw/C.php?page=' || reply_page || '&bsn=29659&snA=' || page_id AS url
FROM (SELECT page_id, unnest(CASE WHEN total > 3 THEN range(total, greatest(total - 2, 0), -1)
                                  ELSE range(1, least(total, 2) + 1) END) AS reply_page
      FROM (SELECT page_id, {_SQL_TOTAL} AS total FROM (SELECT DISTINCT CAST(doc_id // 20 AS BIGINT) AS page_id FROM fx_posts)))""", "fx_posts"))
def x12_planned_pages(spark, sf):
    """Reply pages to fetch, the last two, by the number of pages of a pager."""
    pages = rendered.baha_board_pages(fx.fx_posts(spark, sf))
    totals = pages.select("page_id", X.max_page(F.col("html")).alias("total"))
    planned = totals.select("page_id", F.explode(X.plan_reply_pages(F.col("total"), F.lit(2))).alias("reply_page"))
    return planned.select("page_id", F.col("reply_page").cast("bigint").alias("reply_page"),
                          X.baha_article_url(F.lit(29659), F.col("page_id"), F.col("reply_page")).alias("url"))
