"""Forum pages rendered by Spark from the fixture views.

The driver's ``pages`` table holds generic web pages, not forum markup. To
run the page extractors (X1, X2, X4, X7-X11) over whole tables, these
builders render the fixture posts and comments into the markup and JSON
payload shapes the extractors read: one PTT article page per post, PTT
board index pages, Bahamut thread pages and Dcard listing / comment
payloads. A page groups a bounded number of posts (``PER_PAGE``), so no
group grows with the data. Edge cases are switched on by row id: deleted
board entries, incomplete pushes, missing titles, authors, times and
reaction counts, and all four Dcard payload shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadscope.operators.extract import BAHA_BASE, PTT_BASE

PTT_BOARD = "PokemonGO"
PER_PAGE = 20          # PTT board entries per index page
BAHA_GROUP = 5         # Bahamut thread page = doc_id div 5 (five floors)
DCARD_GROUP = 10       # Dcard listing page = doc_id div 10 (ten posts)


def esc(c: Column) -> Column:
    """HTML text escape (``&``, ``<``, ``>``); NULL -> empty."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _ordered_join(df: DataFrame, group: str, order: str, html: str, out: str) -> DataFrame:
    """Concatenate the html of a (bounded) group in ``order``."""
    return df.groupBy(group).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(html).alias("h")))),
        lambda x: x["h"]), "").alias(out))


def ptt_article_url(doc_id: Column) -> Column:
    return _cat(f"{PTT_BASE}/bbs/{PTT_BOARD}/M.", doc_id.cast("string"), ".A.html")


def ptt_article_pages(nested_posts: DataFrame) -> DataFrame:
    """``(page_id, url, html)``: one PTT article page per post. Posts with
    ``doc_id % 10 == 9`` carry one incomplete push (no user id), which the
    extractor must leave in the content."""
    p = nested_posts
    ts = F.date_format(F.to_timestamp(F.col("post_time")), "EEE MMM dd HH:mm:ss yyyy")
    pushes = F.array_join(F.transform(F.col("comments_data"), lambda c: _cat(
        '<div class="push"><span class="push-tag">', esc(c["comment_tag"]), ' </span>',
        '<span class="push-userid">', esc(c["comment_author"]), '</span>',
        '<span class="push-content">: ', esc(c["comment"]), '</span>',
        '<span class="push-ipdatetime"> 12/01 10:00</span></div>')), "")
    broken = F.when(F.col("doc_id") % 10 == 9, F.lit(
        '<div class="push"><span class="push-tag">推 </span><span class="push-content">: broken</span></div>'
    )).otherwise(F.lit(""))

    def meta(tag: str, value: Column, right: bool = False) -> Column:
        cls = "article-metaline-right" if right else "article-metaline"
        return _cat(f'<div class="{cls}"><span class="article-meta-tag">{tag}</span>'
                    '<span class="article-meta-value">', value, '</span></div>')
    html = _cat('<html><body><div id="main-container"><div id="main-content" class="bbs-screen bbs-content">',
                meta("作者", esc(F.col("author"))), meta("看板", F.lit(PTT_BOARD), right=True),
                meta("標題", esc(F.col("title"))), meta("時間", ts),
                esc(F.col("content")), pushes, broken, '</div></div></body></html>')
    return p.select(F.col("doc_id").alias("page_id"), ptt_article_url(F.col("doc_id")).alias("url"),
                    html.alias("html"))


def ptt_board_pages(posts: DataFrame) -> DataFrame:
    """``(page_id, url, html)``: PTT index pages, ``PER_PAGE`` entries each
    in post order; entries with ``doc_id % 7 == 0`` are deleted (no link)."""
    href = _cat(f"/bbs/{PTT_BOARD}/M.", F.col("doc_id").cast("string"), ".A.html")
    title = F.when(F.col("doc_id") % 7 == 0, _cat("(本文已被刪除) [", esc(F.col("author")), "]")) \
             .otherwise(_cat('<a href="', href, '">', esc(F.col("title")), "</a>"))
    entry = _cat('<div class="r-ent"><div class="nrec"></div><div class="title">', title,
                 '</div><div class="meta"><div class="author">', esc(F.col("author")),
                 '</div><div class="date">12/01</div></div></div>')
    e = posts.select(F.floor(F.col("doc_id") / PER_PAGE).alias("page_id"), "doc_id", entry.alias("h"))
    pages = _ordered_join(e, "page_id", "doc_id", "h", "body")
    return pages.select("page_id",
                        _cat(f"{PTT_BASE}/bbs/{PTT_BOARD}/index", F.col("page_id").cast("string"), ".html").alias("url"),
                        _cat('<html><body><div class="r-list-container action-bar-margin bbs-screen">',
                             F.col("body"), "</div></body></html>").alias("html"))


def baha_thread_pages(nested_posts: DataFrame) -> DataFrame:
    """``(page_id, url, html)``: Bahamut thread pages of ``doc_id div 5``,
    one ``.c-section`` floor per post. A floor shows its own title only when
    it is the page's first (``doc_id % 5 == 0``) or ``doc_id`` is even;
    the user link is missing for ``doc_id % 4 == 3``, the edit time for
    ``doc_id % 9 == 8``, and the reaction count is not a number for
    ``doc_id % 6 == 5``."""
    d = F.col("doc_id")
    title = F.when((d % BAHA_GROUP == 0) | (d % 2 == 0),
                   _cat('<h1 class="c-post__header__title">', esc(F.col("title")), "</h1>")).otherwise(F.lit(""))
    user = F.when(d % 4 != 3, _cat('<a class="username" href="/home">', esc(F.col("author")), "</a>")) \
            .otherwise(F.lit(""))
    mtime = F.when(d % 9 != 8, _cat(' data-mtime="', F.col("post_time"), ' 10:20:30"')).otherwise(F.lit(""))
    reac = F.when(d % 6 == 5, F.lit("爆")).otherwise((d * 7 % 100).cast("string"))
    replies = F.array_join(F.transform(F.col("comments_data"), lambda c: _cat(
        '<div class="c-reply__item"><div class="reply-content">',
        '<a class="reply-content__user">', esc(c["comment_author"]), "：</a>",
        '<article class="reply-content__article"><span>', esc(c["comment"]), "</span></article></div></div>")), "")
    floor = _cat('<section class="c-section"><div class="c-section__main c-post"><div class="c-post__header">',
                 title, '<div class="c-post__header__author">', user, "</div>",
                 '<div class="c-post__header__info"><a class="edittime tippy-post-info"', mtime, ">edited</a></div>",
                 '</div><div class="c-post__body"><article class="c-article"><div class="c-article__content">',
                 esc(F.col("content")), '</div></article></div><div class="c-post__footer">',
                 '<a class="count tippy-gpbp-list">', reac, "</a></div>", replies, "</div></section>")
    f = nested_posts.select(F.floor(d / BAHA_GROUP).alias("page_id"), "doc_id", floor.alias("h"))
    pages = _ordered_join(f, "page_id", "doc_id", "h", "body")
    return pages.select("page_id",
                        _cat(f"{BAHA_BASE}/C.php?bsn=29659&snA=", F.col("page_id").cast("string")).alias("url"),
                        _cat("<html><body>", F.col("body"), "</body></html>").alias("html"))


def baha_board_pages(posts: DataFrame) -> DataFrame:
    """``(page_id, url, html)``: Bahamut board pages, ``PER_PAGE`` threads each
    in post order, and a pager. The thread of a post has the id ``1000 +
    doc_id``. The link has no id for ``doc_id % 9 == 4`` and an empty one for
    ``% 11 == 6``; it comes twice for ``% 5 == 0``, its attributes are the other
    way round for even ids, and a link of another class follows for ``% 7 ==
    3``. The pager links to pages 1 to 3, to page ``page_id % 13 + 1`` and to
    ``next``; every sixth page has none. A link outside it has a higher page."""
    d = F.col("doc_id")
    target = F.when(d % 9 == 4, F.lit("B.php?bsn=29659")).when(d % 11 == 6, F.lit("C.php?bsn=29659&amp;snA=&amp;tnum=2")) \
        .otherwise(_cat("C.php?bsn=29659&amp;snA=", (d + 1000).cast("string"), "&amp;tnum=2"))
    link = F.when(d % 2 == 0, _cat('<a href="', target, '" class="b-list__main__title is-highlight">')) \
        .otherwise(_cat('<a data-gtm="x" class="b-list__main__title" href="', target, '">'))
    link = _cat(link, esc(F.col("title")), "</a>")
    other = F.when(d % 7 == 3, F.lit('<a class="b-list__main__titles" href="C.php?bsn=29659&amp;snA=7">x</a>')).otherwise(F.lit(""))
    row = _cat('<tr class="b-list__row">', link, F.when(d % 5 == 0, link).otherwise(F.lit("")), other, "</tr>")
    e = posts.select(F.floor(d / PER_PAGE).alias("page_id"), "doc_id", row.alias("h"))
    pages = _ordered_join(e, "page_id", "doc_id", "h", "body")
    total = F.col("page_id") % 13 + 1
    button = lambda n: _cat('<a href="?page=', n.cast("string"), '&amp;bsn=29659">', n.cast("string"), "</a>")
    pager = _cat('<p class="BH-pagebtnA">', F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), F.least(total, F.lit(3))), button), ""),
                 button(total), '<a href="?page=next">&gt;</a></p>')
    return pages.select("page_id", _cat(f"{BAHA_BASE}/B.php?page=1&bsn=29659&group=", F.col("page_id").cast("string")).alias("url"),
                        _cat("<html><body><table>", F.col("body"), "</table>", F.when(F.col("page_id") % 6 != 5, pager).otherwise(F.lit("")),
                             '<div class="ad"><a href="?page=500">500</a></div></body></html>').alias("html"))


# --- Dcard payloads (JSON shown inside <pre>) --------------------------------

def _pre(json_text: Column) -> Column:
    return _cat("<html><body><pre>", json_text, "</pre></body></html>")


def dcard_post_object(d: Column | None = None) -> Column:
    """The API's post object. Keys left NULL are absent from the JSON:
    no title for ``doc_id % 11 == 2``, no ``anonymous`` for ``% 4 == 1``
    (defaults to true), empty school for ``% 8 == 2``, an annotation for
    ``% 6 == 5``, no like count for ``% 10 == 8``, no comment count for
    ``% 7 == 3`` and an unparseable ``createdAt`` for ``% 13 == 5``."""
    d = F.col("doc_id") if d is None else d
    return F.struct(
        d.alias("id"),
        F.when(d % 11 != 2, F.col("title")).alias("title"),
        F.when(d % 13 == 5, F.lit("yesterday")).otherwise(_cat(F.col("post_time"), "T08:30:00.000+08:00"))
        .alias("createdAt"),
        F.when(d % 8 == 2, F.lit("")).otherwise(F.col("author")).alias("school"),
        _cat("dept", (d % 5).cast("string")).alias("department"),
        F.when(d % 4 == 0, F.lit(True)).when(d % 4 >= 2, F.lit(False)).alias("anonymous"),
        F.col("content").alias("excerpt"),
        F.when(d % 6 == 5, F.struct(_cat("note ", d.cast("string")).alias("annotation"))).alias("meta"),
        F.when(d % 10 != 8, d % 50).alias("likeCount"),
        F.when(d % 7 != 3, F.col("comment_count")).alias("commentCount"),
    )


def dcard_listing_pages(nested_posts: DataFrame) -> DataFrame:
    """``(page_id, url, html)``: one listing payload per ``doc_id div 10``
    page in one of the four shapes (``page_id % 4``): a bare list;
    ``widgets[].forumlist.items[].post`` (plus an ``items`` key that must be
    ignored); ``items[].searchPost.post``; ``items[]`` of ``{post}`` or the
    post itself. Object payloads carry a ``nextKey``."""
    posts = nested_posts.select(F.floor(F.col("doc_id") / DCARD_GROUP).alias("page_id"), "doc_id",
                                dcard_post_object().alias("p"))
    grouped = posts.groupBy("page_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("doc_id").alias("o"), F.col("p").alias("p")))),
        lambda x: x["p"]).alias("ps"))
    key = _cat("k", F.col("page_id").cast("string"))
    as_list = F.to_json(F.col("ps"))
    widgets = F.to_json(F.struct(
        F.array(F.struct(F.struct(F.transform("ps", lambda p: F.struct(p.alias("post"))).alias("items"))
                         .alias("forumlist"))).alias("widgets"),
        F.array(F.struct(F.struct(F.lit(-1).alias("id")).alias("post"))).alias("items")))
    search = F.to_json(F.struct(
        F.transform("ps", lambda p: F.struct(F.struct(p.alias("post")).alias("searchPost"))).alias("items"),
        key.alias("nextKey")))
    items = _cat('{"items":[', F.array_join(F.transform("ps", lambda p: F.when(
        p["id"] % 2 == 0, F.to_json(F.struct(p.alias("post")))).otherwise(F.to_json(p))), ","),
        '],"nextKey":"', key, '"}')
    m = F.col("page_id") % 4
    payload = F.when(m == 0, as_list).when(m == 1, widgets).when(m == 2, search).otherwise(items)
    return grouped.select("page_id", _cat("https://www.dcard.tw/service/api/v3/page/", F.col("page_id").cast("string"))
                          .alias("url"), _pre(payload).alias("html"))


def dcard_comment_pages(nested_posts: DataFrame) -> DataFrame:
    """``(page_id, url, html)``: one comments payload per post, shape by
    ``(doc_id div 3) % 3``: ``{"items": [...]}``, ``{"comments": [...]}`` or a
    bare list that also holds a non-object element. Every other comment
    (even position) is anonymous."""
    cm = F.transform(F.col("comments_data"), lambda c, i: F.struct(
        c["comment"].alias("content"), c["comment_author"].alias("school"),
        (i % 2 == 0).alias("anonymous")))
    m = F.floor(F.col("doc_id") / 3) % 3
    payload = (F.when(m == 0, F.to_json(F.struct(cm.alias("items"))))
               .when(m == 1, F.to_json(F.struct(cm.alias("comments"))))
               .otherwise(F.regexp_replace(F.to_json(cm), r"\]$", F.when(F.size(cm) > 0, F.lit(",7]"))
                                           .otherwise(F.lit("7]")))))
    return nested_posts.select(F.col("doc_id").alias("page_id"),
                               _cat("https://www.dcard.tw/service/api/v3/posts/", F.col("doc_id").cast("string"),
                                    "/comments").alias("url"), _pre(payload).alias("html"))
