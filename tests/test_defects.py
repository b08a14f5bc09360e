"""One test per behaviour-bearing row of the survey's defect table (§0.1):
the reference's quirks are reproduced on purpose."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threadscope.operators import cleaning as C
from threadscope.operators import extract as X
from threadscope.operators import keywords as K
from threadscope.operators import relational as R

POSTS = "post_key long, platform string, post_time string, content string, total_reac string, comment_count long"
COMMENTS = "post_key long, pos long, platform string, comment_tag string, comment_author string, comment string"


def _clean(spark, platform, comments):
    posts = spark.createDataFrame([(1, platform, "2025-05-06", "內容", "5", len(comments))], POSTS)
    cm = spark.createDataFrame([(1, i, platform, "推", f"u{i}", c) for i, c in enumerate(comments)], COMMENTS)
    return C.clean_all(posts, cm, "post_key", ["pos"], year="2025")


def test_d3_comment_needs_more_than_five_characters(spark):
    _, c = _clean(spark, "baha", ["123456", "12345", "  12345  "])
    assert rows(c, "comment") == [("123456",)]


def test_d4_ptt_comments_are_cleaned_twice(spark):
    text = "9ZbW],Q#Q天"          # pass 1 drops '#', which makes 'QQ' for pass 2
    _, once = _clean(spark, "baha", [text])
    _, twice = _clean(spark, "ptt", [text])
    assert rows(once, "comment") == [("9ZbW],QQ天",)]
    assert rows(twice, "comment") == [("9ZbW],難過天",)]


def test_d8_fb_is_a_known_platform(spark):
    p, c = _clean(spark, "fb", ["這是一則夠長的留言"])
    assert p.count() == 1 and c.count() == 1


def test_d9_empty_keyword_is_rejected(spark):
    df = spark.createDataFrame([("abc",)], "comment string")
    with pytest.raises(ValueError):
        R.keyword_match(df, ["abc", ""])


def test_d10_single_cjk_character_is_a_keyword(spark):
    df = spark.createDataFrame([("好 a 7 ! 真的 bug",)], "t string")
    got = df.select(K.filter_tokens(K.segment(F.col("t"))).alias("k")).collect()[0].k
    assert got == ["好", "a", "bug"]               # '7' and '!' are dropped, the stop word too


def test_d13_unparseable_post_time(spark):
    html = ('<div id="main-content"><div class="article-metaline"><span class="article-meta-value">a</span></div>'
            '<span class="article-meta-value">b</span><span class="article-meta-value">c</span>'
            '<span class="article-meta-value">not a time</span>body</div>')
    assert X.parse_ptt_article(html, crawl_date="2025-01-31")["post_time"] == "2025-01-31"
    floor = X.parse_baha_page('<section class="c-section"><div class="c-article__content">x</div></section>')[0]
    assert floor["post_time"] is None


def test_d14_comment_count_is_not_recomputed(spark):
    p, c = _clean(spark, "baha", ["這是一則夠長的留言", "短"])
    assert c.count() == 1
    assert rows(p, "comment_count") == [(2,)]


def test_page_parser_takes_deep_and_broken_markup():
    """Unclosed tags nest without end; one such page must not fail the job."""
    html = "<div id='main-content'>" + "<p>x" * 5000 + "<div class='push'><span class='push-tag'>推</span>" \
           "<span class='push-userid'>u</span><span class='push-content'>: hi</span></div></b></i>"
    got = X.parse_ptt_article(html)
    assert got["like"] == 1 and got["content"] == "x" * 5000 and got["comments_data"][0]["comment"] == " hi"
    assert X.parse_baha_page("<section class='c-section'>" * 3000) is not None
