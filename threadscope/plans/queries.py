"""Registered queries over the driver tables (see ``threadscope.catalog``).

Each query reads whole tables through the forum-shaped fixture views of
``threadscope.sources.fixtures`` and returns a DataFrame whose column names
equal those of its oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from threadscope.catalog import query
from threadscope.operators import relational as R
from threadscope.plans.weak_label import hot_comments, weak_label_sample
from threadscope.plans.sql_cleaning import CLEANED_POSTS, cleaned
from threadscope.plans.sql_keywords import SQL_STOP as _SQL_STOP
from threadscope.plans.sql_keywords import SQL_TOKENS as _SQL_TOKENS
from threadscope.sources import fixtures as fx
from threadscope.sources.fixtures import with_fx

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
_SQL_LEAD = "regexp_extract({c}, '^[ \\t\\n\\x0B\\f\\r]*([+-]?[0-9]+)', 1)"
SQL_REAC_INT = ("CASE WHEN {c} IS NULL THEN NULL ELSE coalesce(try_cast(" + _SQL_LEAD + " AS BIGINT), "
                "CASE WHEN " + _SQL_LEAD + " = '' THEN 0 WHEN starts_with(" + _SQL_LEAD + ", '-') "
                "THEN -9223372036854775808 ELSE 9223372036854775807 END) END")
PLATFORMS = ["ptt", "baha", "dcard"]


def _posts(spark, sf):
    return fx.fx_posts(spark, sf).withColumnRenamed("doc_id", "post_key")


def _sql_like_any(col: str, kws) -> str:
    return "(" + " OR ".join(f"translate({col}, '{UPPER}', '{LOWER}') LIKE '%{k.lower()}%'" for k in kws) + ")"


# --- P2 / R9-R16 ---------------------------------------------------------

def _p2_sql() -> str:
    parts = []
    for plat in PLATFORMS:
        for sent, (kws, lim) in fx.FX_WEAK_KEYWORDS.items():
            lim_sql = f"LIMIT {lim}" if lim else ""
            parts.append(f"""(SELECT platform, title, comment, total_reac, '{sent}' AS sentiment, post_key, pos,
                    '' AS label, '' AS remark
             FROM base WHERE platform = '{plat}' AND {_sql_like_any('comment', kws)}
             ORDER BY reac_int DESC NULLS LAST, post_key, pos {lim_sql})""")
    body = f"""
, base AS (
  SELECT c.platform, p.title, c.comment, p.total_reac, c.post_key, c.pos,
         {SQL_REAC_INT.format(c='p.total_reac')} AS reac_int
  FROM fx_comments c LEFT JOIN fx_posts p ON c.post_key = p.doc_id
  WHERE c.comment IS NOT NULL AND c.comment != ''
)
""" + "\nUNION ALL\n".join(parts)
    return with_fx(body, "fx_posts", "fx_comments").replace("\n, base AS", ",\nbase AS", 1)


@query("p2_weak_label_sample", sql=_p2_sql())
def p2_weak_label_sample(spark, sf):
    return weak_label_sample(fx.fx_comments(spark, sf), _posts(spark, sf), fx.FX_WEAK_KEYWORDS)




@query("r9_comments_with_posts", sql=with_fx("""
SELECT c.post_key, c.pos, c.platform, c.comment_author, c.comment, p.title, p.total_reac, p.post_time
FROM fx_comments c LEFT JOIN fx_posts p ON c.post_key = p.doc_id
WHERE c.comment IS NOT NULL AND c.comment != ''""", "fx_posts", "fx_comments"))
def r9_comments_with_posts(spark, sf):
    c = fx.fx_comments(spark, sf).filter(R.non_empty("comment"))
    p = _posts(spark, sf).select("post_key", "title", "total_reac", "post_time")
    return R.comments_with_posts(c, p, "post_key").select(
        "post_key", "pos", "platform", "comment_author", "comment", "title", "total_reac", "post_time")


@query("r11_keyword_match", sql=with_fx(f"""
SELECT post_key, pos, comment FROM fx_comments
WHERE {_sql_like_any('comment', ['elle', 'und', 'the', 'con'])}""", "fx_comments"))
def r11_keyword_match(spark, sf):
    return R.keyword_match(fx.fx_comments(spark, sf), ["elle", "und", "the", "con"]).select(
        "post_key", "pos", "comment")


@query("r12_order_by_reactions", sql=with_fx(f"""
SELECT doc_id, total_reac, {SQL_REAC_INT.format(c='total_reac')} AS reac_int
FROM fx_posts ORDER BY reac_int DESC NULLS LAST, doc_id LIMIT 10""", "fx_posts"))
def r12_order_by_reactions(spark, sf):
    from threadscope.functions.reactions import sqlite_integer
    p = fx.fx_posts(spark, sf).select("doc_id", "total_reac")
    return R.order_by_reactions(p, "total_reac", ["doc_id"], limit=10).withColumn(
        "reac_int", sqlite_integer(F.col("total_reac")))


@query("r13_hot_comments_per_platform", sql=with_fx(f"""
SELECT platform, title, comment, total_reac, post_key, pos, rank FROM (
  SELECT c.platform, p.title, c.comment, p.total_reac, c.post_key, c.pos,
         row_number() OVER (PARTITION BY c.platform
                            ORDER BY {SQL_REAC_INT.format(c='p.total_reac')} DESC NULLS LAST, c.post_key, c.pos) AS rank
  FROM fx_comments c LEFT JOIN fx_posts p ON c.post_key = p.doc_id
  WHERE c.comment IS NOT NULL AND c.comment != '') t
WHERE rank <= 180""", "fx_posts", "fx_comments"))
def r13_hot_comments_per_platform(spark, sf):
    return hot_comments(fx.fx_comments(spark, sf), _posts(spark, sf), limit=180)


# --- Cleaning (C3, C4, C7, C8, C9, X3, C2, C12) ---------------------------

from threadscope.functions.dates import clean_date  # noqa: E402
from threadscope.functions.text import clean_text  # noqa: E402
from threadscope.operators import cleaning as C  # noqa: E402
from threadscope.operators import extract as X  # noqa: E402

# Date strings in every accepted shape (plus unparseable ones), built from
# the event timestamps: event_id % 10 picks the shape.
_DATE_SHAPES_SPARK = [
    ("yyyy-MM-dd", True), ("yyyy/M/d", True), ("yyyyMMdd", True), ("M/d/yyyy", True),
    ("yyyy年M月d日", True), ("EEE MMM dd HH:mm:ss yyyy", True), ("yyyy-MM-dd'T'HH:mm:ss'+08:00'", True),
    ("yyyy.MM.dd HH:mm", True), ("yyyy年M月", False), (None, False),
]
_DATE_SHAPES_SQL = ["%Y-%m-%d", "%Y/%-m/%-d", "%Y%m%d", "%-m/%-d/%Y", "%Y年%-m月%-d日",
                    "%a %b %d %H:%M:%S %Y", "%Y-%m-%dT%H:%M:%S+08:00", "%Y.%m.%d %H:%M", "%Y年%-m月", None]


@query("c3_clean_date", sql="SELECT event_id, raw, post_date FROM (SELECT event_id, CASE event_id % 10 "
       + " ".join(f"WHEN {i} THEN " + (f"strftime(ts, '{f}')" if f else "event_type")
                  for i, f in enumerate(_DATE_SHAPES_SQL))
       + " END AS raw, CASE WHEN event_id % 10 < 8 THEN strftime(ts, '%Y-%m-%d') END AS post_date FROM events)")
def c3_clean_date(spark, sf):
    e = fx.read_table(spark, sf, "events")
    raw = None
    for i, (fmt, _) in enumerate(_DATE_SHAPES_SPARK):
        v = F.date_format("ts", fmt) if fmt else F.col("event_type")
        raw = F.when(F.col("event_id") % 10 == i, v) if raw is None else raw.when(F.col("event_id") % 10 == i, v)
    return e.select("event_id", raw.alias("raw")).withColumn("post_date", clean_date(F.col("raw")))


@query("c4_filter_year", sql=with_fx("SELECT doc_id, platform, post_time FROM fx_posts "
                                     "WHERE post_time LIKE '2025%'", "fx_posts"))
def c4_filter_year(spark, sf):
    p = fx.fx_posts(spark, sf).select("doc_id", "platform", "post_time")
    return C.filter_year(p.withColumn("post_time", clean_date(F.col("post_time"))), "2025")


@query("c7_merge_continuations", sql=with_fx("""
, s AS (
  SELECT *, CASE WHEN lag(event_id) OVER w IS NULL OR comment_tag != '→'
                   OR comment_author IS DISTINCT FROM lag(comment_author) OVER w THEN 1 ELSE 0 END AS st
  FROM fx_pushes WINDOW w AS (PARTITION BY post_key ORDER BY ts, event_id)),
g AS (SELECT *, sum(st) OVER (PARTITION BY post_key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT post_key, min(ts) AS ts, arg_min(event_id, ts) AS event_id, first(comment_author) AS comment_author,
       string_agg(comment, '' ORDER BY ts, event_id) AS comment, count(*) AS n_merged
FROM g GROUP BY post_key, run""", "fx_pushes").replace("\n\n, s AS", ",\ns AS", 1))
def c7_merge_continuations(spark, sf):
    return C.merge_continuations(fx.fx_pushes(spark, sf), "post_key", ["ts", "event_id"])


@query("x3_vote_tally", sql=with_fx("""
SELECT post_key, CAST(count_if(comment_tag = '推') AS BIGINT) AS "like",
       CAST(count_if(comment_tag = '噓') AS BIGINT) AS unlike,
       CAST(count_if(comment_tag = '推') - count_if(comment_tag = '噓') AS BIGINT) AS total_reac,
       count(*) AS comment_count
FROM fx_comments GROUP BY post_key""", "fx_comments"))
def x3_vote_tally(spark, sf):
    return X.vote_tally(fx.fx_comments(spark, sf), "post_key")


@query("c8_repair_total_reac", sql=with_fx("""
SELECT doc_id, total_reac AS raw_total_reac,
       CASE WHEN total_reac IS NULL OR total_reac = '' THEN '0'
            WHEN total_reac = '爆' OR starts_with(total_reac, 'X') OR regexp_matches(total_reac, '^-*[0-9]+$')
            THEN CAST(coalesce(v."like", 0) - coalesce(v.unlike, 0) AS VARCHAR)
            ELSE total_reac END AS total_reac
FROM fx_posts p LEFT JOIN (
  SELECT post_key, count_if(comment_tag = '推') AS "like", count_if(comment_tag = '噓') AS unlike
  FROM fx_comments GROUP BY post_key) v ON p.doc_id = v.post_key""", "fx_posts", "fx_comments"))
def c8_repair_total_reac(spark, sf):
    votes = X.vote_tally(fx.fx_comments(spark, sf), "post_key").select(
        F.col("post_key").alias("doc_id"), "like", "unlike")
    p = fx.fx_posts(spark, sf).select("doc_id", F.col("total_reac"))
    p = p.join(votes, "doc_id", "left").withColumn("raw_total_reac", F.col("total_reac"))
    return C.repair_reactions(p).select("doc_id", "raw_total_reac", "total_reac")


@query("c9_article_tag", sql="""
SELECT page_id, CASE WHEN t IS NULL OR t = '' THEN ''
       WHEN strpos(t, '[') > 0 AND strpos(t, ']') >= strpos(t, '[') THEN substr(t, strpos(t, '['), strpos(t, ']') - strpos(t, '[') + 1)
       ELSE '' END AS article_tag
FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)""")
def c9_article_tag(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    t = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return pages.select("page_id", C.extract_article_tag(t).alias("article_tag"))


@query("c2_clean_text", sql=f"SELECT doc_id, text AS clean_text FROM {cleaned('documents', 'text')}")
def c2_clean_text(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    return d.select("doc_id", clean_text(F.col("text")).alias("clean_text"))


@query("c12_clean_posts", sql=with_fx(CLEANED_POSTS + """
SELECT k.post_key, k.pos, k.platform, k.comment_author, k.comment, k.comment_tag, p.post_time, p.author, p.title, p.content, p.total_reac
FROM kept k JOIN posts p ON p.doc_id = k.post_key""", "fx_posts", "fx_comments").replace("\n\n, given AS", ",\ngiven AS", 1))
def c12_clean_posts(spark, sf):
    cp, cc = C.clean_all(_posts(spark, sf), fx.fx_comments(spark, sf), "post_key", ["pos"], year="2025",
                         materialize=True)
    return cc.join(cp.drop("platform"), "post_key", "inner")


# --- Extraction over stored pages (X5, X6, X12-X14) ------------------------

@query("x5_link_targets", sql="""
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY min(i)) AS link_pos, href
FROM (SELECT page_id, i, replace(regexp_extract_all(html, '(?i)<[a-z][a-z0-9]*\\s(?:[^>]*\\s)?href\\s*=\\s*"([^"]*)"[^>]*>', 1)[i], '&amp;', '&') AS href
      FROM (SELECT page_id, html, generate_subscripts(regexp_extract_all(html, '(?i)<[a-z][a-z0-9]*\\s(?:[^>]*\\s)?href\\s*=\\s*"([^"]*)"[^>]*>', 1), 1) AS i FROM pages))
WHERE href != ''
GROUP BY page_id, href""")
def x5_link_targets(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    return pages.select("page_id", F.posexplode(X.link_targets(F.col("html"))).alias("link_pos", "href")) \
                .withColumn("link_pos", (F.col("link_pos") + 1).cast("bigint"))


_SQL_PAGE_PARAM = "regexp_extract(url, '[?&]page=([^&#]*)', 1)"


@query("x6_max_page", sql=f"""
SELECT page_id, greatest(coalesce(try_cast(CASE WHEN regexp_matches({_SQL_PAGE_PARAM}, '^[0-9]+$')
                                  THEN {_SQL_PAGE_PARAM} END AS INTEGER), 1), 1) AS max_page
FROM pages""")
def x6_max_page(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    return pages.select("page_id", X.max_page(F.col("html"), "BH-pagebtnA", F.col("url")).alias("max_page"))


@query("x12_reply_page_urls", sql=f"""
SELECT page_id, reply_page, 'https://forum.gamer.com.tw/C.php?page=' || reply_page || '&bsn=29659&snA=' || page_id AS url
FROM (SELECT page_id, unnest(CASE WHEN total > 3 THEN range(total, greatest(total - 2 + 1, 1) - 1, -1)
                                  ELSE range(1, least(total, 2) + 1) END) AS reply_page
      FROM (SELECT page_id, greatest(coalesce(try_cast(CASE WHEN regexp_matches({_SQL_PAGE_PARAM}, '^[0-9]+$')
                                  THEN {_SQL_PAGE_PARAM} END AS INTEGER), 1), 1) AS total FROM pages))""")
def x12_reply_page_urls(spark, sf):
    pages = fx.read_table(spark, sf, "pages")
    # The page count is one column, so the regex over the page runs once per
    # page (plan_reply_pages refers to its input several times).
    totals = pages.select("page_id", X.max_page(F.col("html"), "BH-pagebtnA", F.col("url")).alias("total"))
    planned = totals.select("page_id", F.explode(X.plan_reply_pages(F.col("total"), F.lit(2))).alias("reply_page")) \
                    .withColumn("reply_page", F.col("reply_page").cast("bigint"))
    return planned.withColumn("url", X.baha_article_url(F.lit(29659), F.col("page_id"), F.col("reply_page")))


# --- Identity, dedupe, indexes, counts (R6-R8, R20-R25) --------------------

from threadscope.functions.ids import post_id  # noqa: E402

_SQL_POST_ID = ("md5(coalesce(CAST({p} AS VARCHAR), 'None') || '_' || coalesce(CAST({t} AS VARCHAR), 'None') || '_' || "
                "coalesce(CAST({a} AS VARCHAR), 'None') || '_' || substr(coalesce(CAST({ti} AS VARCHAR), ''), 1, 10))")


@query("r6_post_id", sql=with_fx(
    f"SELECT doc_id, {_SQL_POST_ID.format(p='platform', t='post_time', a='author', ti='title')} AS post_id "
    "FROM fx_posts", "fx_posts"))
def r6_post_id(spark, sf):
    p = fx.fx_posts(spark, sf)
    return p.select("doc_id", post_id(F.col("platform"), F.col("post_time"), F.col("author"), F.col("title"))
                    .alias("post_id"))


@query("r7_dedupe_first_wins", sql=f"""
SELECT post_id, arg_min(doc_id, doc_id) AS doc_id, arg_min(source, doc_id) AS source, arg_min(lang, doc_id) AS lang
FROM (SELECT doc_id, source, lang, {_SQL_POST_ID.format(p='source', t='lang', a='NULL', ti='text')} AS post_id FROM documents)
GROUP BY post_id""")
def r7_dedupe_first_wins(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    keyed = d.select(post_id(F.col("source"), F.col("lang"), F.lit(None), F.col("text")).alias("post_id"),
                     "doc_id", "source", "lang")
    return R.dedupe_first_wins(keyed, "post_id", "doc_id")


@query("r8_comments_table", sql=with_fx(f"""
SELECT row_number() OVER (ORDER BY c.post_key, c.pos) AS comment_id,
       {_SQL_POST_ID.format(p='p.platform', t='p.post_time', a='p.author', ti='p.title')} AS post_id,
       c.comment_author, c.comment
FROM fx_comments c JOIN fx_posts p ON c.post_key = p.doc_id""", "fx_posts", "fx_comments"))
def r8_comments_table(spark, sf):
    posts = _posts(spark, sf).select(
        "post_key", post_id(F.col("platform"), F.col("post_time"), F.col("author"), F.col("title")).alias("post_id"))
    c = fx.fx_comments(spark, sf).join(posts, "post_key", "inner")
    return R.dense_index(c, ["post_key", "pos"], name="comment_id").select(
        "comment_id", "post_id", "comment_author", "comment")


@query("r20_value_counts", sql="""
SELECT lang, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def r20_value_counts(spark, sf):
    return R.value_counts(fx.read_table(spark, sf, "documents"), "lang")


@query("r21_row_counts", sql=with_fx("""
SELECT 'posts' AS name, count(*) AS n_rows FROM fx_posts
UNION ALL SELECT 'comments', count(*) FROM fx_comments
UNION ALL SELECT 'comments_with_posts', count(*) FROM fx_comments c LEFT JOIN fx_posts p ON c.post_key = p.doc_id
  WHERE c.comment IS NOT NULL AND c.comment != ''""", "fx_posts", "fx_comments"))
def r21_row_counts(spark, sf):
    posts, comments = _posts(spark, sf), fx.fx_comments(spark, sf)
    joined = R.comments_with_posts(comments.filter(R.non_empty("comment")), posts.select("post_key"), "post_key")
    return R.row_counts({"posts": posts, "comments": comments, "comments_with_posts": joined})


@query("r22_distinct_values", sql="SELECT DISTINCT role FROM conversations")
def r22_distinct_values(spark, sf):
    return R.distinct_values(fx.read_table(spark, sf, "conversations"), "role")


@query("r23_seeded_shuffle", sql="SELECT doc_id, quality, toxic FROM labels",
       note="row order is not compared; checks the shuffle keeps every row once")
def r23_seeded_shuffle(spark, sf):
    return R.seeded_shuffle(fx.read_table(spark, sf, "labels"), ["doc_id"], seed=42)


@query("r24_row_position", sql="SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) AS row_index "
                               "FROM documents")
def r24_row_position(spark, sf):
    d = fx.read_table(spark, sf, "documents").select("doc_id", "lang")
    return R.dense_index(d, ["lang", "doc_id"], name="row_index")


@query("r25_concat_texts", sql="SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text "
                               "FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def r25_concat_texts(spark, sf):
    c = fx.read_table(spark, sf, "conversations")
    return R.concat_texts(c, ["conv_id"], "text", ["turn"], sep=" ", out_col="text")


# --- Keywords (K1-K6, P3, P4) ------------------------------------------------

from threadscope.operators import keywords as K  # noqa: E402

_SQL_KEEP = f"NOT list_contains({_SQL_STOP}, Keyword) AND (length(Keyword) >= 2 OR regexp_matches(Keyword, '^\\p{{L}}+$'))"


@query("k3_keyword_table", sql=with_fx(f"""
SELECT doc_id, predict_label, Keyword FROM (
  SELECT doc_id, predict_label, unnest({_SQL_TOKENS}) AS Keyword FROM fx_scored)
WHERE {_SQL_KEEP}""", "fx_scored"))
def k3_keyword_table(spark, sf):
    return K.keyword_table(fx.fx_scored(spark, sf))


@query("k4_negative_comments", sql=with_fx(
    "SELECT doc_id, comment FROM fx_scored WHERE predict_label = 0 AND comment IS NOT NULL", "fx_scored"))
def k4_negative_comments(spark, sf):
    return K.label_corpus(fx.fx_scored(spark, sf), 0).select("doc_id", "comment")


@query("k5_term_frequency", sql=with_fx(f"""
SELECT word, count, count / max(count) OVER () AS weight FROM (
  SELECT word, count(*) AS count FROM (
    SELECT unnest({_SQL_TOKENS}) AS word FROM fx_scored
    WHERE predict_label = 0 AND comment IS NOT NULL)
  WHERE length(word) >= 2 AND NOT list_contains({_SQL_STOP}, word)
  GROUP BY word ORDER BY count DESC, word LIMIT 100)""", "fx_scored"))
def k5_term_frequency(spark, sf):
    return K.term_frequency(K.label_corpus(fx.fx_scored(spark, sf), 0))


@query("k6_keyword_counts", sql=with_fx(f"""
SELECT platform, predict_label, Keyword, count(*) AS n FROM (
  SELECT platform, predict_label, unnest({_SQL_TOKENS}) AS Keyword FROM fx_scored)
WHERE {_SQL_KEEP} GROUP BY platform, predict_label, Keyword""", "fx_scored"))
def k6_keyword_counts(spark, sf):
    return K.keyword_counts(K.keyword_table(fx.fx_scored(spark, sf), keep=["platform"]))


@query("p4_volume_trend", sql=with_fx("""
SELECT p.post_time, c.platform, l.quality + l.toxic AS predict_label,
       count(DISTINCT c.post_key) AS n_posts, count(*) AS n_comments
FROM fx_comments c JOIN fx_posts p ON c.post_key = p.doc_id LEFT JOIN labels l ON l.doc_id = c.post_key
GROUP BY p.post_time, c.platform, l.quality + l.toxic""", "fx_posts", "fx_comments"))
def p4_volume_trend(spark, sf):
    from threadscope.plans.trend import volume_trend
    labels = fx.read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("post_key"), (F.col("quality") + F.col("toxic")).alias("predict_label"))
    scored = (fx.fx_comments(spark, sf).join(_posts(spark, sf).select("post_key", "post_time"), "post_key")
              .join(labels, "post_key", "left"))
    return volume_trend(scored)


# --- Model data work (M1-M13, P5) -------------------------------------------

from threadscope.operators import model as M  # noqa: E402

_SQL_SPLIT = """CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id)
                  <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END"""


@query("m1_stratified_split", sql=with_fx(
    f"SELECT doc_id, label, {_SQL_SPLIT} AS split FROM fx_labelled", "fx_labelled"))
def m1_stratified_split(spark, sf):
    return M.stratified_split(fx.fx_labelled(spark, sf).select("doc_id", "label"), "label", "doc_id")


@query("m2_split_real_generated", sql=with_fx(f"""
SELECT doc_id, label, is_generated, {_SQL_SPLIT} AS split FROM fx_labelled WHERE is_generated = 'F'
UNION ALL SELECT doc_id, label, is_generated, 'train' FROM fx_labelled WHERE is_generated = 'T'""", "fx_labelled"))
def m2_split_real_generated(spark, sf):
    return M.split_real_generated(fx.fx_labelled(spark, sf).select("doc_id", "label", "is_generated"))


def _predictions(spark, sf):
    lg = fx.fx_logits(spark, sf)
    probs = M.softmax(F.col("logits"))
    return lg.select("vec_id", "true_label", probs.alias("probs"), M.argmax(probs).alias("test_label"))


_SQL_PROBS = """(SELECT vec_id, true_label, list_transform(e, lambda x: x / list_sum(e)) AS probs FROM
  (SELECT vec_id, true_label, list_transform(logits, lambda x: exp(x - list_max(logits))) AS e FROM fx_logits))"""
_SQL_PRED = f"""(SELECT vec_id, true_label, probs, list_position(probs, list_max(probs)) - 1 AS test_label
  FROM {_SQL_PROBS})"""


@query("m6_softmax", sql=with_fx(f"""
SELECT vec_id, round(probs[1], 9) AS p0, round(probs[2], 9) AS p1, round(probs[3], 9) AS p2 FROM {_SQL_PROBS}""",
                                "fx_logits"))
def m6_softmax(spark, sf):
    p = _predictions(spark, sf)
    return p.select("vec_id", *[F.round(F.element_at("probs", i + 1), 9).alias(f"p{i}") for i in range(3)])


@query("m7_argmax", sql=with_fx(f"SELECT vec_id, test_label FROM {_SQL_PRED}", "fx_logits"))
def m7_argmax(spark, sf):
    return _predictions(spark, sf).select("vec_id", "test_label")


def _sql_pct(i: int) -> str:
    return f"printf('%.2f%%', probs[{i}] * 100)"


_SQL_MATRIX = f"{_sql_pct(1)} || ', ' || {_sql_pct(2)} || ', ' || {_sql_pct(3)}"
_SQL_CONF = f"'負:' || {_sql_pct(1)} || ', 中:' || {_sql_pct(2)} || ', 正:' || {_sql_pct(3)}"


@query("m8_confidence_string", sql=with_fx(
    f"SELECT vec_id, {_SQL_CONF} AS confidence_matrix, {_SQL_MATRIX} AS matrix FROM {_SQL_PROBS}", "fx_logits"))
def m8_confidence_string(spark, sf):
    p = _predictions(spark, sf)
    return p.select("vec_id", M.confidence_string(F.col("probs")).alias("confidence_matrix"),
                    M.confidence_string(F.col("probs"), names=None).alias("matrix"))


@query("m9_prediction_table", sql=with_fx(
    f"SELECT CAST(vec_id AS VARCHAR) AS comment, {_SQL_MATRIX} AS matrix, test_label, true_label FROM {_SQL_PRED}",
    "fx_logits"))
def m9_prediction_table(spark, sf):
    p = _predictions(spark, sf)
    return p.select(F.col("vec_id").cast("string").alias("comment"),
                    M.confidence_string(F.col("probs"), names=None).alias("matrix"), "test_label", "true_label")


@query("m10_metrics", sql=with_fx(f"""
, pairs AS (SELECT true_label, test_label, count(*) AS n FROM {_SQL_PRED} GROUP BY ALL),
labels_ AS (SELECT true_label AS c FROM pairs UNION SELECT test_label FROM pairs),
per AS (SELECT l.c,
          coalesce((SELECT sum(n) FROM pairs WHERE true_label = l.c AND test_label = l.c), 0) AS tp,
          coalesce((SELECT sum(n) FROM pairs WHERE true_label = l.c), 0) AS n_true,
          coalesce((SELECT sum(n) FROM pairs WHERE test_label = l.c), 0) AS n_pred FROM labels_ l),
prf AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS p,
               CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END AS r FROM per)
SELECT round(sum(tp) / sum(n_true), 9) AS accuracy, round(avg(p), 9) AS precision, round(avg(r), 9) AS recall,
       round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END), 9) AS f1 FROM prf""",
                                 "fx_logits").replace("\n\n, pairs AS", ",\npairs AS", 1))
def m10_metrics(spark, sf):
    m = M.metrics(_predictions(spark, sf))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("m11_confusion_matrix", sql=with_fx(f"""
, pr AS {_SQL_PRED},
labels_ AS (SELECT true_label AS l FROM pr UNION SELECT test_label FROM pr)
SELECT l AS true_label, CAST(count_if(true_label = l AND test_label = 0) AS BIGINT) AS pred_0,
       CAST(count_if(true_label = l AND test_label = 1) AS BIGINT) AS pred_1,
       CAST(count_if(true_label = l AND test_label = 2) AS BIGINT) AS pred_2
FROM labels_ LEFT JOIN pr ON pr.true_label = labels_.l GROUP BY l""", "fx_logits").replace("\n\n, pr AS", ",\npr AS", 1))
def m11_confusion_matrix(spark, sf):
    return M.confusion_matrix(_predictions(spark, sf))


@query("m12_mispredictions", sql=with_fx(
    f"SELECT vec_id, true_label, test_label FROM {_SQL_PRED} WHERE test_label != true_label", "fx_logits"))
def m12_mispredictions(spark, sf):
    return M.mispredictions(_predictions(spark, sf)).select("vec_id", "true_label", "test_label")


@query("m12_neutral_misses", sql=with_fx(
    f"SELECT vec_id, true_label, test_label FROM {_SQL_PRED} WHERE true_label = 1 AND test_label != 1", "fx_logits"))
def m12_neutral_misses(spark, sf):
    return M.class_misses(_predictions(spark, sf), 1).select("vec_id", "true_label", "test_label")


@query("m13_label_ratio", sql=with_fx(f"""
SELECT test_label AS predict_label, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM {_SQL_PRED} GROUP BY test_label""", "fx_logits"))
def m13_label_ratio(spark, sf):
    return M.label_ratio(_predictions(spark, sf).withColumnRenamed("test_label", "predict_label"))


@query("p5_scored_corpus", note="trains a classifier (iterative); rows-only")
def p5_scored_corpus(spark, sf):
    labelled = fx.fx_labelled(spark, sf)
    split = M.stratified_split(labelled, "label", "doc_id")
    model = M.train_sentiment(split.filter(F.col("split") == "train").select(
        F.col("comment").alias("text"), "label"))
    docs = fx.fx_posts(spark, sf).select("doc_id", "platform", F.col("content").alias("comment"))
    return M.score_comments(model, docs)
