"""Page extraction: HTML (X1, X2, X4), links and pages (X5, X6), Dcard
payloads (X7-X11), crawl planning and URLs (X12-X14)."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threadscope.operators import extract as X

PTT_ARTICLE = (
    '<div id="main-content"><div class="article-metaline"><span class="article-meta-value">a</span></div>'
    '<div class="article-metaline"><span class="article-meta-value">b</span></div>'
    '<div class="article-metaline-right"><span class="article-meta-value">c</span></div>'
    '<div class="article-metaline"><span class="article-meta-value">Wed Jan 15 10:20:30 2025</span></div>內文'
    '<div class="push"><span class="push-tag">推 </span><span class="push-userid">u1</span>'
    '<span class="push-content">: 好玩</span></div>'
    '<div class="push"><span class="push-tag">噓 </span><span class="push-content">: 缺作者</span></div></div>')
PTT_BOARD = ('<div class="r-ent"><div class="title"><a href="/bbs/P/M.1.html">[心得] 好</a></div>'
             '<div class="author">bob</div></div><div class="r-ent"><div class="title">(已刪除)</div></div>')
BAHA = ('<h1 class="c-post__header__title">主題</h1><section class="c-section">'
        '<div class="c-post__header__info"><a class="edittime" data-mtime="2025-03-04 05:06:07">t</a></div>'
        '<a class="username">甲</a><a class="count tippy-gpbp-list">x</a><div class="c-article__content"> 內容 </div>'
        '<div class="c-reply__item"><a class="reply-content__user">乙：</a>'
        '<article class="reply-content__article">回覆</article></div></section>')


def test_html_pages(spark):
    pages = spark.createDataFrame([(1, "https://www.ptt.cc/bbs/P/M.1.html", PTT_ARTICLE),
                                   (2, "https://www.ptt.cc/bbs/P/index.html", PTT_BOARD),
                                   (3, "https://forum.gamer.com.tw/C.php?snA=1", BAHA)],
                                  "page_id long, url string, html string")
    art = X.extract_ptt_articles(pages)
    assert rows(art, "page_id", "post_time", "content", "total_reac", "comment_count") == [
        (1, "2025-01-15", "內文噓 : 缺作者", "1", 1)]
    posts = X.ptt_posts(pages.filter("page_id = 2"), pages.filter("page_id = 1"))
    assert rows(posts, "title", "author", "content") == [("[心得] 好", "bob", "內文噓 : 缺作者")]
    floors = X.extract_baha_floors(pages)
    r = floors.collect()
    assert len(r) == 1 and r[0]["post_time"] == "2025-03-04" and r[0]["total_reac"] == "0"
    assert r[0]["comments_data"][0]["comment_author"] == "乙" and r[0]["title"] == "主題"


def test_links_and_pages(spark):
    html = ('<a class="b-list__main__title" href="C.php?bsn=1&amp;snA=11">x</a>'
            '<a href="C.php?bsn=1&snA=99">not a title</a>'
            '<a class="x b-list__main__title" href="C.php?bsn=1&snA=12">y</a>'
            '<a class="b-list__main__title" href="C.php?bsn=1&snA=11">dup</a>'
            '<p class="BH-pagebtnA"><a href="?page=2">2</a><a href="?page=17">17</a><a href="?page=x">n</a></p>')
    df = spark.createDataFrame([(html,), ("<p>none</p>",)], "html string")
    got = rows(df.select(X.extract_thread_ids(F.col("html")).alias("ids"), X.max_page(F.col("html")).alias("m")))
    assert got == [(["11", "12"], 17), ([], 1)]


DCARD = [
    ('[{"id": 1}, {"id": 2}]', ["1", "2"]),
    ('{"widgets": [{"forumlist": {"items": [{"post": {"id": 3}}, {"nopost": 1}]}}, 5], "items": [{"id": 9}]}', ["3"]),
    ('{"items": [{"searchPost": {"post": {"id": 4}}}, {"post": {"id": 5}}, {"id": 6}, {"other": 1}]}', ["4", "5", "6"]),
    ('{}', []), ('[]', []), ('null', []),
]


def test_dcard_payloads(spark):
    df = spark.createDataFrame([(p,) for p, _ in DCARD], "p string").select(F.parse_json("p").alias("v"))
    got = df.select(F.transform(X.dcard_posts(F.col("v")),
                                lambda x: F.try_variant_get(x, "$.id", "string")).alias("ids")).collect()
    assert [r.ids for r in got] == [e for _, e in DCARD]
    nxt = df.select(X.next_cursor(F.col("v")).alias("n")).collect()
    assert [r.n for r in nxt][:3] == ["2", None, None]


def test_dcard_format_and_comments(spark):
    post = ('{"id": 1, "createdAt": "2025-01-31T23:30:00.000+08:00", "school": "NTU", "anonymous": false,'
            ' "meta": {"annotation": ""}, "excerpt": "摘要", "likeCount": 7}')
    comments = '{"items": [{"content": "留言", "anonymous": true, "school": "X"}, 3]}'
    df = spark.createDataFrame([(post, comments)], "p string, c string")
    rec = df.select(X.dcard_format(F.parse_json("p"), X.dcard_comments(F.parse_json("c"))).alias("r")).collect()[0].r
    assert (rec.post_time, rec.author, rec.title, rec.content, rec.total_reac, rec.comment_count) == \
        ("2025-01-31", "NTU", "無標題", "摘要", "7", 0)
    assert [(c.comment_author, c.comment) for c in rec.comments_data] == [("Anonymous", "留言")]
    pj = spark.createDataFrame([("<pre>{\"a\": 1}</pre>",), ("<pre></pre>",), ("<pre>{bad</pre>",)], "h string")
    assert [r[0] is not None for r in pj.select(X.page_to_json(F.col("h"))).collect()] == [True, False, False]


def test_planning_and_urls(spark):
    df = spark.createDataFrame([(10, 2), (3, 2), (2, 5), (5, 0)], "t int, r int")
    got = rows(df.select(X.plan_reply_pages(F.col("t"), F.col("r")).alias("p")))
    assert [g[0] for g in got] == [[10, 9], [1, 2], [1, 2], []]
    one = spark.range(1)
    assert one.select(X.plan_ptt_index_pages(F.lit(961), F.lit(3))).first()[0] == [961, 960, 959]
    assert one.select(X.plan_baha_board_pages(F.lit(5), F.lit(3))).first()[0] == []
    assert one.select(X.ptt_board_url(F.lit("Gossiping"), F.lit(0))).first()[0] == \
        "https://www.ptt.cc/bbs/Gossiping/index.html"
    u = one.select(X.dcard_urls(F.lit("forum"), F.lit(None).cast("string"), F.lit("pokemon")).alias("u")).first().u
    assert u.api_url == "https://www.dcard.tw/service/api/v3/forums/pokemon/posts?sort=new"
    u = one.select(X.dcard_urls(F.lit("search"), F.lit("poke"), F.lit("game")).alias("u")).first().u
    assert u.front_url == "https://www.dcard.tw/f/game?tab=latest" and "query=poke&forum=game&field=all" in u.api_url
    for mode in ("search", "forum"):  # an empty forum counts as none
        u = one.select(X.dcard_urls(F.lit(mode), F.lit("poke"), F.lit("")).alias("u")).first().u
        assert "poke" in u.front_url and "forum=" not in u.api_url
    for field in ("front_url", "api_url"):
        with pytest.raises(Exception):
            one.select(X.dcard_urls(F.lit("hot"), F.lit("q"))[field]).collect()
    with pytest.raises(Exception):
        one.select(X.dcard_urls(F.lit("topic"), F.lit(""))).collect()


@pytest.mark.parametrize("extract, columns", [(X.extract_baha_floors, ["page_id", "html"]), (X.extract_ptt_articles, ["page_id", "url", "html"]),
                                              (X.extract_ptt_board, ["page_id", "html"])])
def test_pages_are_parsed_one_at_a_time(extract, columns):
    """A batch of 40 MB of pages: neither their texts nor their rows are held together."""
    import tracemalloc

    import pyarrow as pa
    text = "some words &amp; 中 " * 1000
    html = {X.extract_baha_floors: f'<section class="c-section"><div class="c-article__content">{text}</div></section>',
            X.extract_ptt_articles: f'<div id="main-content">{text}</div>',
            X.extract_ptt_board: f'<div class="r-ent"><div class="title"><a href="/x">{text}</a></div></div>'}[extract]
    n = (40 << 20) // len(html.encode())
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(n)), "url": ["u"] * n, "html": [html] * n}).select(columns)

    class Pages:
        def select(self, *_):
            return self

        def mapInArrow(self, fn, schema):  # noqa: N802
            return (b.to_pandas() for b in fn(iter([batch])))

        def mapInPandas(self, fn, schema):  # noqa: N802
            return fn(iter([batch.to_pandas()]))
    found = []
    tracemalloc.start()
    for rows in extract(Pages()):
        found += rows["page_id"].tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == list(range(n)) and peak < 16 << 20, peak
