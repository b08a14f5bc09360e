"""P2 weak-label sample with the default (CJK) keyword lists: several
sentiments per comment, SQLite LIKE rules, empty comments, and the
reaction-ordered per-platform limit."""
from tests.conftest import rows
from threadscope.plans.weak_label import weak_label_sample

POSTS = [(1, "A", "爆"), (2, "B", "10"), (3, "C", "5"), (4, "D", None)]
COMMENTS = [
    (1, 0, "ptt", "這次活動超讚 好玩"),
    (1, 1, "ptt", "機率低 又是 BUG 垃圾"),       # 'bug' matches 'BUG' (ASCII case is ignored)
    (2, 0, "ptt", "地點普通"),
    (2, 1, "ptt", "超讚但是騙錢"),               # positive and negative
    (3, 0, "baha", ""),
    (3, 1, "baha", "感謝S社"),
    (4, 0, "dcard", "還好吧"),
    (4, 1, "dcard", None),
]


def _frames(spark):
    p = spark.createDataFrame(POSTS, "post_key long, title string, total_reac string")
    c = spark.createDataFrame(COMMENTS, "post_key long, pos long, platform string, comment string")
    return c, p


def test_default_keyword_lists(spark):
    c, p = _frames(spark)
    got = sorted(rows(weak_label_sample(c, p), "platform", "sentiment", "comment", "label", "remark"))
    assert got == sorted([
        ("ptt", "positive", "這次活動超讚 好玩", "", ""), ("ptt", "positive", "超讚但是騙錢", "", ""),
        ("ptt", "negative", "機率低 又是 BUG 垃圾", "", ""), ("ptt", "negative", "超讚但是騙錢", "", ""),
        ("ptt", "neutral", "地點普通", "", ""), ("baha", "positive", "感謝S社", "", ""),
        ("dcard", "neutral", "還好吧", "", "")])


def test_limit_keeps_most_reacted(spark):
    c, p = _frames(spark)
    out = weak_label_sample(c, p, {"negative": (["騙錢", "垃圾"], 1)})
    # '10' ranks above '爆' (a non-number casts to 0, as in SQLite)
    assert rows(out, "platform", "comment", "total_reac") == [("ptt", "超讚但是騙錢", "10")]
