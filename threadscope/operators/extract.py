"""Extraction of stored raw pages into post rows (survey §2.X).

Fetching is not data work and is not built; these operators parse pages
that are already stored as rows ``(page_id, url, html)``. URL building,
page planning, query-string and JSON-payload handling are native column
expressions (JSON through VARIANT). HTML that needs a DOM (PTT articles and
boards, Bahamut floors) is parsed with the standard-library parser inside
``mapInArrow`` (see ``threadscope.functions.html``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Site addresses and URL formats.
PTT_BASE = "https://www.ptt.cc"
BAHA_BASE = "https://forum.gamer.com.tw"
DCARD_BASE = "https://www.dcard.tw"
DCARD_API = "https://www.dcard.tw/service/api/v3"


# X3 ----------------------------------------------------------------------

def vote_tally(comments: DataFrame, key: str, tag_col: str = "comment_tag") -> DataFrame:
    """推 counts as like, 噓 as unlike, anything else as arrow;
    ``total_reac = like - unlike``; ``comment_count`` counts all pushes.
    A plain aggregate, so a hot thread is pre-aggregated map-side."""
    t = F.col(tag_col)
    return comments.groupBy(key).agg(
        F.count_if(t == "推").alias("like"),
        F.count_if(t == "噓").alias("unlike"),
        (F.count_if(t == "推") - F.count_if(t == "噓")).alias("total_reac"),
        F.count(F.lit(1)).alias("comment_count"))


# X5 / X6 -----------------------------------------------------------------

def _tags_with_href(html: Column, css_class: str | None) -> Column:
    """Opening tags that carry an ``href`` (and the class token, if given)."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<[a-z][a-z0-9]*\s[^>]*>"), F.lit(0))
    tags = F.filter(tags, lambda t: t.rlike(r'(?i)\shref\s*=\s*"'))
    if css_class:
        pat = r'(?i)\sclass\s*=\s*"([^"]*\s)?' + css_class.replace(".", r"\.") + r'(\s[^"]*)?"'
        tags = F.filter(tags, lambda t: t.rlike(pat))
    return tags


def _href(tag: Column) -> Column:
    return F.replace(F.regexp_extract(tag, r'(?i)\shref\s*=\s*"([^"]*)"', 1), F.lit("&amp;"), F.lit("&"))


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter (URL-decoded); NULL when absent or blank."""
    v = F.try_parse_url(url, F.lit("QUERY"), F.lit(name))
    v = F.try_url_decode(v)
    return F.when(v != "", v)


def link_targets(html: Column, css_class: str | None = None, param: str | None = None) -> Column:
    """Ordered distinct ``href`` targets of elements with ``css_class``;
    with ``param`` the value of that query parameter instead (links
    without it are skipped). X5 = ``link_targets(html,
    'b-list__main__title', 'snA')``."""
    hrefs = F.transform(_tags_with_href(html, css_class), _href)
    if param:
        hrefs = F.transform(F.filter(hrefs, lambda h: h.contains(f"{param}=")),
                            lambda h: query_param(h, param))
    return F.array_distinct(F.filter(hrefs, lambda h: h.isNotNull() & (h != "")))


def extract_thread_ids(html: Column) -> Column:
    return link_targets(html, "b-list__main__title", "snA")


def max_page(html: Column, pager_class: str | None = "BH-pagebtnA", extra_urls: Column | None = None) -> Column:
    """Largest numeric ``page`` query value among the pager's links; 1 when
    there is none (non-digit values are ignored)."""
    scope = html
    if pager_class:
        scope = F.regexp_extract(html, r'(?is)<([a-z0-9]+)[^>]*\sclass\s*=\s*"(?:[^"]*\s)?'
                                 + pager_class + r'(?:\s[^"]*)?"[^>]*>(.*?)</\1>', 2)
    urls = F.transform(_tags_with_href(scope, None), _href)
    if extra_urls is not None:
        urls = F.concat(urls, F.array(extra_urls))
    pages = F.transform(urls, lambda u: query_param(u, "page"))
    nums = F.transform(F.filter(pages, lambda p: p.rlike(r"^[0-9]+$")), lambda p: p.try_cast("int"))
    return F.greatest(F.coalesce(F.array_max(nums), F.lit(1)), F.lit(1))


# X7 ----------------------------------------------------------------------

def page_to_json(html: Column) -> Column:
    """JSON inside the first ``<pre>...</pre>`` as VARIANT; NULL if absent or invalid."""
    body = F.regexp_extract(html, r"(?s)<pre>(.*?)</pre>", 1)
    return F.try_parse_json(F.when(body != "", body))


# X8 / X9 / X10 / X11 (Dcard payloads, VARIANT) ---------------------------

def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _is_array(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))


def _get(v: Column, path: str, typ: str = "variant") -> Column:
    return F.try_variant_get(v, path, typ)


def _has_key(v: Column, key: str) -> Column:
    return _is_object(v) & F.array_contains(F.coalesce(F.map_keys(v.try_cast("map<string,variant>")),
                                                       F.array().cast("array<string>")), key)


def _arr(v: Column) -> Column:
    return F.coalesce(v.try_cast("array<variant>"), F.array().cast("array<variant>"))


def _truthy(v: Column) -> Column:
    """Python truthiness of a JSON value (null, false, 0, "", [] and {} are false)."""
    s = F.schema_of_variant(v)
    return (v.isNotNull() & (s != "VOID")
            & F.when(s == "BOOLEAN", _get(v, "$", "boolean"))
               .when(s == "STRING", _get(v, "$", "string") != "")
               .when(s.startswith("ARRAY"), F.size(_arr(v)) > 0)
               .when(s.startswith("OBJECT"), F.size(F.map_keys(v.try_cast("map<string,variant>"))) > 0)
               .otherwise(F.coalesce(_get(v, "$", "double") != 0, F.lit(True))))


def dcard_posts(payload: Column) -> Column:
    """Array of post objects from one listing payload (four shapes):
    a bare list; ``widgets[].forumlist.items[].post`` (when the ``widgets``
    key exists, ``items`` is ignored); ``items[]`` holding ``searchPost.post``,
    ``post`` or the post itself (an item with ``id``). Falsy -> empty."""
    v = payload
    as_list = F.when(_is_array(v), _arr(v))
    widgets = F.flatten(F.transform(
        F.filter(_arr(_get(v, "$.widgets")), _is_object),
        lambda w: F.transform(
            F.filter(_arr(_get(w, "$.forumlist.items")), lambda it: _has_key(it, "post")),
            lambda it: _get(it, "$.post"))))
    items = F.transform(
        F.filter(_arr(_get(v, "$.items")),
                 lambda it: _has_key(it, "searchPost") | _has_key(it, "post") | _has_key(it, "id")),
        lambda it: F.when(_has_key(it, "searchPost"),
                          F.coalesce(_get(it, "$.searchPost.post"), F.parse_json(F.lit("{}"))))
                    .when(_has_key(it, "post"), _get(it, "$.post"))
                    .otherwise(it))
    posts = (F.when(~_truthy(v), F.array().cast("array<variant>"))
             .when(_is_array(v), as_list)
             .when(_has_key(v, "widgets"), widgets)
             .otherwise(items))
    return posts


def dcard_comments(payload: Column) -> Column:
    """Comment objects: ``items``, else ``comments``, or a bare list; falsy -> empty."""
    v = payload
    return (F.when(~_truthy(v), F.array().cast("array<variant>"))
            .when(_is_array(v), _arr(v))
            .when(_has_key(v, "items"), _arr(_get(v, "$.items")))
            .otherwise(_arr(_get(v, "$.comments"))))


def _author(v: Column) -> Column:
    school = _get(v, "$.school", "string")
    dept = _get(v, "$.department", "string")
    name = F.when(F.coalesce(school, F.lit("")) != "", school).otherwise(dept)
    anonymous = F.coalesce(_get(v, "$.anonymous", "boolean"), F.lit(True))
    return F.when(anonymous | name.isNull() | (name == ""), F.lit("Anonymous")).otherwise(name)


def _iso_date(s: Column) -> Column:
    """Date part of an ISO-8601 timestamp in its own offset (no conversion)."""
    ok = s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
    d = F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")
    return F.when(ok, F.date_format(d, "yyyy-MM-dd"))


def dcard_format(post: Column, comments: Column, crawl_date: Column | None = None) -> Column:
    """One post record (struct) in the common post shape."""
    created = _get(post, "$.createdAt", "string")
    post_time = F.coalesce(_iso_date(created), crawl_date if crawl_date is not None else F.lit(None).cast("string"))
    annotation = _get(post, "$.meta.annotation", "string")
    content = F.when(F.coalesce(annotation, F.lit("")) != "", annotation) \
               .otherwise(F.coalesce(_get(post, "$.excerpt", "string"), F.lit("")))
    title = F.when(_has_key(post, "title"), _get(post, "$.title", "string")).otherwise(F.lit("無標題"))
    cmts = F.transform(F.filter(comments, _is_object), lambda c: F.struct(
        F.lit(None).cast("string").alias("comment_tag"),
        _author(c).alias("comment_author"),
        F.coalesce(_get(c, "$.content", "string"), F.lit("")).alias("comment")))
    return F.struct(
        F.lit("Dcard").alias("platform"), post_time.alias("post_time"), _author(post).alias("author"),
        title.alias("title"), content.alias("content"),
        F.coalesce(_get(post, "$.likeCount", "string"), F.lit("0")).alias("total_reac"),
        F.coalesce(_get(post, "$.commentCount", "bigint"), F.lit(0).cast("bigint")).alias("comment_count"),
        cmts.alias("comments_data"))


def next_cursor(payload: Column) -> Column:
    """``nextKey`` of an object payload; for a list, the last element's ``id``."""
    last = F.element_at(_arr(payload), -1)
    return F.when(_is_object(payload), _get(payload, "$.nextKey", "string")) \
            .when(_is_array(payload) & (F.size(_arr(payload)) > 0), _get(last, "$.id", "string"))


# X12 / X13 / X14 ---------------------------------------------------------

def plan_reply_pages(total: Column, reply_pages: Column) -> Column:
    """Reply pages to fetch: the last ``reply_pages`` pages, newest first,
    when the thread has more than 3 pages; otherwise 1..min(total, reply_pages)."""
    t = total.cast("int")
    r = reply_pages.cast("int")
    empty = F.array().cast("array<int>")
    tail_end = F.greatest(t - r + 1, F.lit(1))
    many = F.when((r >= 1) & (tail_end <= t), F.sequence(t, tail_end, F.lit(-1))).otherwise(empty)
    upto = F.least(t, r)
    few = F.when(upto >= 1, F.sequence(F.lit(1), upto)).otherwise(empty)
    return F.when(t > 3, many).otherwise(few)


def plan_ptt_index_pages(start_index: Column, pages: Column) -> Column:
    """PTT board index pages counting down from ``start_index``."""
    n = pages.cast("int")
    return F.when(n >= 1, F.sequence(start_index.cast("int"), start_index.cast("int") - n + 1, F.lit(-1))) \
            .otherwise(F.array().cast("array<int>"))


def plan_baha_board_pages(start: Column, end: Column) -> Column:
    """Inclusive board page range; invalid (start < 1 or end < start) -> empty."""
    return F.when((start >= 1) & (end >= start), F.sequence(start.cast("int"), end.cast("int"))) \
            .otherwise(F.array().cast("array<int>"))


def ptt_board_url(board: Column, index: Column) -> Column:
    return F.when(F.coalesce(index, F.lit(0)) != 0,
                  F.format_string(PTT_BASE + "/bbs/%s/index%d.html", board, index)) \
            .otherwise(F.format_string(PTT_BASE + "/bbs/%s/index.html", board))


def ptt_article_url(href: Column) -> Column:
    return F.concat(F.lit(PTT_BASE), href)


def baha_board_url(board_id: Column, page: Column) -> Column:
    return F.format_string(BAHA_BASE + "/B.php?page=%s&bsn=%s", page.cast("string"), board_id.cast("string"))


def baha_article_url(board_id: Column, article_id: Column, page: Column) -> Column:
    return F.format_string(BAHA_BASE + "/C.php?page=%s&bsn=%s&snA=%s", page.cast("string"),
                           board_id.cast("string"), article_id.cast("string"))


def dcard_urls(mode: Column, query: Column, forum: Column | None = None) -> Column:
    """Struct (front_url, api_url) for mode topic / search / forum; a search
    with a forum stays inside it. An empty forum counts as none. An unknown
    mode, or no query outside forum mode, raises on either field."""
    m = F.lower(mode)
    q = query
    inside = F.when(forum != "", forum) if forum is not None else F.lit(None).cast("string")
    target = F.coalesce(inside, q)
    need_query = (m != "forum") & (q.isNull() | (q == ""))
    front = (F.when(m == "topic", F.format_string(DCARD_BASE + "/topics/%s?tab=latest", q))
             .when((m == "search") & inside.isNotNull(), F.format_string(DCARD_BASE + "/f/%s?tab=latest", inside))
             .when(m == "search", F.format_string(DCARD_BASE + "/search/posts?query=%s&sort=latest", q))
             .when(m == "forum", F.format_string(DCARD_BASE + "/f/%s?tab=latest", target)))
    api = (F.when(m == "topic", F.format_string(
                DCARD_API + "/search/posts?query=%s&field=topics&highlight=false&sort=latest&country=TW&nsfw=true&platform=web", q))
           .when((m == "search") & inside.isNotNull(), F.format_string(
                DCARD_API + "/search/posts?query=%s&forum=%s&field=all&highlight=false&sort=latest&country=TW&nsfw=true&platform=web",
                q, inside))
           .when(m == "search", F.format_string(
                DCARD_API + "/search/posts?query=%s&field=all&highlight=false&sort=latest&country=TW&nsfw=true&platform=web", q))
           .when(m == "forum", F.format_string(DCARD_API + "/forums/%s/posts?sort=new", target)))
    def checked(url: Column) -> Column:
        return (F.when(need_query, F.raise_error(F.lit("a query is required in this mode")))
                .when(url.isNull(), F.raise_error(F.concat(F.lit("unknown Dcard mode: "), mode)))
                .otherwise(url))
    return F.struct(checked(front).alias("front_url"), checked(api).alias("api_url"))


def dcard_comments_url(post_id: Column, limit: Column) -> Column:
    return F.format_string(DCARD_API + "/posts/%s/comments?limit=%s&sort=oldest",
                           post_id.cast("string"), limit.cast("string"))


# X1 / X2 / X4 (HTML pages, mapInArrow) -------------------------------------

import datetime as _dt  # noqa: E402
from collections.abc import Callable, Iterator  # noqa: E402

import pyarrow as _pa  # noqa: E402
from pyspark.sql import types as _T  # noqa: E402
from pyspark.sql.pandas.types import to_arrow_schema as _arrow_schema  # noqa: E402

_COMMENT = _T.StructType([_T.StructField("comment_tag", _T.StringType()),
                          _T.StructField("comment_author", _T.StringType()),
                          _T.StructField("comment", _T.StringType())])

PTT_ARTICLE_SCHEMA = _T.StructType([
    _T.StructField("page_id", _T.LongType()), _T.StructField("url", _T.StringType()),
    _T.StructField("platform", _T.StringType()), _T.StructField("post_time", _T.StringType()),
    _T.StructField("content", _T.StringType()), _T.StructField("like", _T.LongType()),
    _T.StructField("unlike", _T.LongType()), _T.StructField("total_reac", _T.StringType()),
    _T.StructField("comment_count", _T.LongType()),
    _T.StructField("comments_data", _T.ArrayType(_COMMENT)),
])
PTT_BOARD_SCHEMA = _T.StructType([
    _T.StructField("page_id", _T.LongType()), _T.StructField("entry_pos", _T.LongType()),
    _T.StructField("post_url", _T.StringType()), _T.StructField("title", _T.StringType()),
    _T.StructField("author", _T.StringType()),
])
BAHA_FLOOR_SCHEMA = _T.StructType([
    _T.StructField("page_id", _T.LongType()), _T.StructField("floor_pos", _T.LongType()),
    _T.StructField("platform", _T.StringType()), _T.StructField("post_time", _T.StringType()),
    _T.StructField("author", _T.StringType()), _T.StructField("title", _T.StringType()),
    _T.StructField("content", _T.StringType()), _T.StructField("total_reac", _T.StringType()),
    _T.StructField("comment_count", _T.LongType()),
    _T.StructField("comments_data", _T.ArrayType(_COMMENT)),
])


def _fmt(raw: str, pattern: str) -> str | None:
    try:
        return _dt.datetime.strptime(raw, pattern).strftime("%Y-%m-%d")
    except (TypeError, ValueError):
        return None


def parse_ptt_article(html: str | None, crawl_date: str | None = None) -> dict | None:
    """One PTT article page -> post record, or None without ``#main-content``."""
    from threadscope.functions.html import parse
    root = parse(html)
    main = next((n for n in root.select("div#main-content")), None)
    if main is None:
        return None
    meta = root.select("span.article-meta-value")
    raw_time = meta[3].text().strip() if len(meta) > 3 else ""
    like = unlike = 0
    pushes = []
    for p in main.select("div.push"):
        tag_n, user_n, text_n = (p.select_one("span.push-tag"), p.select_one("span.push-userid"),
                                 p.select_one("span.push-content"))
        if tag_n is None or user_n is None or text_n is None:
            continue  # an incomplete push stays in the content
        tag = tag_n.text().strip()
        if tag == "推":
            like += 1
        elif tag == "噓":
            unlike += 1
        pushes.append({"comment_tag": tag, "comment_author": user_n.text().strip(),
                       "comment": text_n.text().strip().lstrip(":")})
        p.remove()
    for cls in ("div.article-metaline", "div.article-metaline-right"):
        for m in main.select(cls):
            m.remove()
    return {"platform": "PTT", "post_time": _fmt(raw_time, "%a %b %d %H:%M:%S %Y") or crawl_date,
            "content": main.text().strip(), "like": like, "unlike": unlike,
            "total_reac": str(like - unlike), "comment_count": len(pushes), "comments_data": pushes}


def parse_ptt_board(html: str | None) -> list[dict]:
    """Board index page -> listing entries (deleted entries have no link)."""
    from threadscope.functions.html import parse
    out = []
    for ent in parse(html).select("div.r-ent"):
        title_div = ent.select_one("div.title")
        a = title_div.select_one("a") if title_div is not None else None
        if a is None:
            continue
        author = ent.select_one("div.author")
        out.append({"post_url": PTT_BASE + (a.get("href") or ""), "title": a.text().strip(),
                    "author": author.text().strip() if author is not None else None})
    return out


def parse_baha_page(html: str | None) -> list[dict]:
    """Bahamut thread page -> one record per floor (``.c-section``)."""
    from threadscope.functions.html import parse
    root = parse(html)
    main_title_n = root.select_one("h1.c-post__header__title")
    main_title = main_title_n.text().strip() if main_title_n is not None else "巴哈討論串"
    floors = []
    for post in root.select(".c-section"):
        t = post.select_one("h1.c-post__header__title")
        title = t.text().strip() if t is not None else main_title
        a = post.select_one("a.username")
        author = a.text().strip() if a is not None else "Anonymous"
        tm = post.select_one(".c-post__header__info a.edittime")
        post_time = _fmt(tm.get("data-mtime"), "%Y-%m-%d %H:%M:%S") if tm is not None and "data-mtime" in tm.attrs \
            else None
        lk = post.select_one("a.count.tippy-gpbp-list")
        try:
            reac = int(lk.text().strip()) if lk is not None else 0
        except ValueError:
            reac = 0
        body = post.select_one("div.c-article__content")
        comments = []
        for c in post.select(".c-reply__item"):
            txt = c.select_one(".reply-content__article")
            if txt is None:
                continue
            u = c.select_one(".reply-content__user")
            comments.append({"comment_tag": None,
                             "comment_author": u.text().strip().replace("：", "") if u is not None else "Anonymous",
                             "comment": txt.text().strip()})
        floors.append({"platform": "Bahamut", "post_time": post_time, "author": author, "title": title,
                       "content": body.text().strip() if body is not None else "", "total_reac": str(reac),
                       "comment_count": len(comments), "comments_data": comments})
    return floors


#: Bytes of pages whose rows are sent on at a time.
_SEND = 1 << 20


def _rows_of_pages(pages: DataFrame, columns: list[str], rows_of: Callable[..., list[dict]], schema: _T.StructType) -> DataFrame:
    """The rows that ``rows_of`` makes of each page's ``columns``. One page is
    parsed at a time, and its rows are sent on with those of some others, so a
    task holds an Arrow batch of pages and little else."""
    kind = _arrow_schema(schema)

    def fn(batches: Iterator[_pa.RecordBatch]) -> Iterator[_pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for i in range(b.num_rows):
                page = [c[i].as_py() for c in b.columns]
                rows += rows_of(*page)
                size += len(page[-1] or "")
                if size > _SEND:
                    yield _pa.RecordBatch.from_pylist(rows, kind)
                    rows, size = [], 0
            if rows:
                yield _pa.RecordBatch.from_pylist(rows, kind)
    return pages.select(*columns).mapInArrow(fn, schema)


def extract_ptt_articles(pages: DataFrame, crawl_date: str | None = None) -> DataFrame:
    """X1 over a pages table ``(page_id, url, html)``; pages without
    ``#main-content`` produce no row."""
    def rows_of(pid: int, url: str, html: str | None) -> list[dict]:
        rec = parse_ptt_article(html, crawl_date)
        return [] if rec is None else [{"page_id": pid, "url": url, **rec}]
    return _rows_of_pages(pages, ["page_id", "url", "html"], rows_of, PTT_ARTICLE_SCHEMA)


def extract_ptt_board(pages: DataFrame) -> DataFrame:
    """X2 listing rows of board pages."""
    def rows_of(pid: int, html: str | None) -> list[dict]:
        return [{"page_id": pid, "entry_pos": i, **e} for i, e in enumerate(parse_ptt_board(html))]
    return _rows_of_pages(pages, ["page_id", "html"], rows_of, PTT_BOARD_SCHEMA)


def ptt_posts(board_pages: DataFrame, article_pages: DataFrame, crawl_date: str | None = None) -> DataFrame:
    """Listing entries joined to their parsed articles by URL (inner);
    the post keeps ``post_url``."""
    listing = extract_ptt_board(board_pages).select("post_url", "title", "author")
    arts = extract_ptt_articles(article_pages, crawl_date).withColumnRenamed("url", "post_url")
    return listing.join(arts.drop("page_id"), "post_url", "inner")


def extract_baha_floors(pages: DataFrame) -> DataFrame:
    """X4 over a pages table: one row per floor."""
    def rows_of(pid: int, html: str | None) -> list[dict]:
        return [{"page_id": pid, "floor_pos": i, **f} for i, f in enumerate(parse_baha_page(html))]
    return _rows_of_pages(pages, ["page_id", "html"], rows_of, BAHA_FLOOR_SCHEMA)
