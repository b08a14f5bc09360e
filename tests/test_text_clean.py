"""C2 clean_text: golden cases per rule and a differential fuzz test against
Python ``re`` running the same rule table (the reference's engine)."""
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from threadscope.functions import text as TX

ORIGINAL = dict((n, p) for n, p, _ in TX.CLEAN_RULES)


def py_clean(s):
    if s is None:
        return None
    s = unicodedata.normalize("NFKC", str(s))
    for _, p, r in TX.CLEAN_RULES:
        s = re.sub(p, r, s)
    return s.strip()


def spark_clean(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, s string")
    got = dict(df.select("i", TX.clean_text(F.col("s")).alias("c")).collect())
    return [got[i] for i in range(len(values))]


GOLDEN = [
    ("全形ＡＢＣ１２３", "全形ABC123"),                       # NFKC
    ("看這裡https://a.b/c?d=1好", "看這裡好"),                 # url stops at CJK
    ("去www.example.com看", "去看"),
    ("找@user.name/path?x=1 玩", "找 玩"),                     # mention
    ("連結 h t t p s : / / x", "連結 h t t p s : / / x"),      # not a broken url (letters split)
    ("看 https : //spaced.url 喔", "看 喔"),                   # space-broken url
    ("看 https : // spaced.url 喔", "看 https : // spaced.url 喔"),  # \\S+ must follow //
    ("序號ABC12345DEF送你", "序號ABC12345DEF送你"),           # CJK neighbour is no boundary
    ("序號 ABC12345DEF 送你", "序號 送你"),                   # gift code
    ("好友 1234 5678 9012 加我", "好友 加我"),                # friend code
    ("HOT 熱門", "熱門"),
    ("tag #活動:限時# 結束", "tag 結束"),
    ("去[公告]看", "去看"),
    ("今天好開心(笑)明天", "明天"),                           # bracket emoticon eats the run before it
    ("c 好", "好"), ("CC 好", "好"), ("000 好", "好"),        # lone c, cc, 0.0 with unescaped dot
    ("QAQ", "好難過"), ("QQ", "難過"), ("orz", "無奈倒地"), ("LOL", "大笑"),
    ("™", "他媽"), ("XDDD", "笑"), ("www", "哈"), ("zzz", "睡"), ("w", "哈"),
    ("= =", "無言"), ("=-=", "無言"), ("@@@", "無奈"), ("><", "害羞"), ("= 3 =", "嘟嘴"),
    ("好:P", "好"), ("好 :D", "好 大笑"), ("=D", "大笑"),
    ("讚😀讚", "讚讚"),                                       # emoji
    ("Q😀Q", "難過"),                                         # emoji split a pattern
    ("好♥好", "好好"),                                         # whitelist drops symbols
    ("空() []{} <>", "空"),
    ("啊啊啊啊啊", "啊啊"), ("1000000", "100"),                 # collapse repeats (every char)
    ("  多   空白\n\t換行  ", "多 空白 換行"),
    ("", ""), (None, None), ("\x1c\x1d好\x1f", "好"),
]


def test_golden(spark):
    got = spark_clean(spark, [g[0] for g in GOLDEN])
    for (inp, exp), g in zip(GOLDEN, got):
        assert g == exp, (inp, g, exp)
    # the golden table is also what Python re gives with the same rules
    for inp, exp in GOLDEN:
        assert py_clean(inp) == exp, inp


def test_java_patterns_compile_in_order():
    assert [n for n, _, _ in TX.JAVA_RULES] == [n for n, _, _ in TX.CLEAN_RULES]
    assert TX.java_pattern(r"[a[b]") == "(?dU)[a\\[b]"
    assert TX.java_replacement(r"\1\1") == "$1$1"


def test_paren_rule_linear_form_equivalent():
    orig = re.compile(ORIGINAL["paren_emoticon"])
    random.seed(3)
    alpha = list("ab( )x)(") + ["\t"]
    for _ in range(3000):
        s = "".join(random.choice(alpha) for _ in range(random.randint(0, 25)))
        # \G form reproduced in Python with a scan that only starts matches
        # at the previous end or after white space
        out, pos, last = [], 0, 0
        pat = re.compile(r"\S*?\([^\s)]+?\)")
        while pos <= len(s):
            if pos == last or pos == 0 or s[pos - 1].isspace():
                m = pat.match(s, pos)
                if m:
                    out.append(s[last:m.start()])
                    last = pos = m.end()
                    continue
            pos += 1
        out.append(s[last:])
        assert "".join(out) == orig.sub("", s), s


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_differential_fuzz(spark, seed):
    random.seed(seed)
    alpha = list("abcwzCWZQXDTMlorz0123456789 \t\n\r\xa0\x1c\x85 　()[]{}<>=@#:;-_.,!?/*~%+'\"") + \
        list("今天好開心啊笑") + ["😀", "👍🏻", "1️⃣", "™", "ｗｗ", "Ｑ", "é", "ß", "‍", "ﾟ∀ﾟ", "http://", "https:// ",
                               "www.", "@user", "HOT", "lol", "orz", "QAQ", "XDDD", "=D", ":P", ":d", "= =", "=-=",
                               "@@@", "><", "=3=", "0.0", "abc12345xyz", "1234 5678 9012", "123456789012",
                               "#tag:x#", "[x]", "(y)", "\u0301", "٣", "²", "Ⅻ", "a1b2c3d4e5", "9" * 12, "x" * 9]
    data = ["".join(random.choice(alpha) for _ in range(random.randint(0, 40))) for _ in range(2500)]
    got = spark_clean(spark, data)
    bad = [(d, g, py_clean(d)) for d, g in zip(data, got) if g != py_clean(d)]
    assert not bad, bad[:3]


def test_documents_match_python(spark):
    from tests.conftest import SF001
    docs = [r[0] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    got = spark_clean(spark, docs)
    assert all(g == py_clean(d) for d, g in zip(docs, got))


def test_rules_with_a_first_test_match_the_same(spark):
    """the rules that rule places out by one character first, against the plain translations."""
    import random

    from pyspark.sql import functions as F

    from threadscope.functions import text as X
    rng = random.Random(11)
    signs = [*"cCqQaAoOrRzZlLtTmMxXdDwW0019.=-3:(){}[]<>#*hHtpsP/_ \t\n", *" ©¨ª  　中é́ſKİı１️⃣‍☀〰", "😀", "\U000e0041", "https:", "1234 ", "12345678", " qaq ", " Orz ", " LoL "]
    rows = [("".join(rng.choice(signs) for _ in range(rng.choice([3, 12, 60]))),) for _ in range(6000)]
    df = spark.createDataFrame(rows, "t string")
    plain = {name: X.java_pattern(p) for name, p, _ in X.CLEAN_RULES}
    fast = {name: p for name, p, _ in X.JAVA_RULES}
    assert all(len(fast[n]) != len(plain[n]) for n in ("emoji_1", "lone_c", "spaces", "friend_code"))  # false before
    same = df.agg(*(F.count_if(F.regexp_replace("t", F.lit(fast[n]), F.lit(" " if n == "spaces" else "→"))
                               != F.regexp_replace("t", F.lit(plain[n]), F.lit(" " if n == "spaces" else "→"))).alias(n)
                    for n in plain if n != "paren_emoticon")).first().asDict()
    assert not any(same.values()), same
    changed = df.agg(*(F.count_if(F.col("t") != F.regexp_replace("t", F.lit(fast[n]), F.lit("→"))).alias(n) for n in X._START)).first().asDict()
    assert all(changed.values()), changed
