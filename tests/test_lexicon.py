"""Long word lists against the regular expression, and a plain search."""
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from threadscope.operators import keywords as K
from threadscope.operators import lexicon as L
from threadscope.operators import relational as R


def texts(rng, n, signs):
    return [(i, "".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 5, 40, 1300])))) for i in range(n)] + [(n, None), (n + 1, "")]


def test_segments_as_the_regular_expression(spark):
    rng = random.Random(3)
    rows = texts(rng, 60, "abc12 中文字😀.\n")
    words = ["a", "ab", "abc", "bc1", "中文", "中文字", "文字a", "😀", "1", "c 1", ".", "字中文字", "2中"]
    df = spark.createDataFrame(rows, "id long, body string")
    lexicon = spark.createDataFrame([(w,) for w in [*words, words[0], None, ""]], "word string")
    got = {r.id: r.tokens for r in L.segment_long(df, lexicon, "body", "id").collect()}
    want = {r.id: r.t for r in df.select("id", K.segment(F.col("body"), words).alias("t")).collect()}
    assert got == want
    none = {r.id: r.tokens for r in L.segment_long(df, lexicon.limit(0), "body", "id").collect()}
    assert none == {r.id: r.t for r in df.select("id", K.segment(F.col("body"), []).alias("t")).collect()}


def test_fifty_thousand_words(spark):
    rng = random.Random(4)
    signs = [chr(0x4E00 + i) for i in range(60)]
    words = {"".join(rng.choice(signs) for _ in range(rng.choice([2, 3, 4, 5]))) for _ in range(90_000)}
    assert len(words) > 50_000
    rows = [(i, "".join(rng.choice([*signs, *"abc "]) for _ in range(300))) for i in range(30)]

    def plain(text):
        out, at = [], 0
        while at < len(text):
            word = next((text[at:at + n] for n in (5, 4, 3, 2) if text[at:at + n] in words), None) or re.match(r"[A-Za-z0-9]+|\S|\s", text[at:])[0]
            out += [word] if word.strip() else []
            at += len(word)
        return out

    df = spark.createDataFrame(rows, "id long, body string")
    got = L.segment_long(df, spark.createDataFrame([(w,) for w in words], "word string"), "body", "id")
    assert {r.id: r.tokens for r in got.collect()} == {i: plain(t) for i, t in rows}


def test_matches_as_like(spark):
    rng = random.Random(5)
    df = spark.createDataFrame(texts(rng, 80, "aBcD 中é%_"), "id long, body string")
    for words in (["bC", "中中", "é A"], ["d", "a%c", "_中_"], ["nothing at all"]):
        got = {r.id for r in L.match_long(df, spark.createDataFrame([(w,) for w in words], "word string"), "body", "id").collect()}
        assert got == {r.id for r in R.keyword_match(df, words, "body").collect()}


def test_texts_are_not_shuffled(spark):
    """positions of texts were rows, which joins with the list shuffled and sorted."""
    df = spark.createDataFrame([(1, "ein Wort und Ωmega"), (1, "ein" * 40_000), (2, None)], "id long, body string")
    words = spark.createDataFrame([("Wort",), ("und",), ("Ωmega",), ("neinei",)], "word string")
    for out in (L.segment_long(df, words, "body", "id"), L.match_long(df, words, "body", "id")):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert L.match_long(df, words, "body", "id").count() == 2  # rows stay whole, also where they share a key
    got = [(r.id, r.tokens) for r in L.segment_long(df, words, "body", "id").collect()]
    assert got == [(1, ["ein", "Wort", "und", "Ωmega"]), (1, ["ein" * 40_000]), (2, [])]
    lists = L._bitmaps(L.word_hashes(L.word_table(words)).value)
    raw, at = L._text_bytes(pa.array(["ein" * 40_000, "ei", "neinei"]))
    start, length = L.hits(raw, at, lists)  # across blocks, not across texts
    assert sorted(start.tolist()) == [*range(2, 3 * 39_998, 3), at[2]] and set(length.tolist()) == {6}


def test_runs_are_tried_before_words_that_begin_otherwise(spark):
    """all words of the lexicon were tried at each token."""
    rng = random.Random(6)
    words = ["bug", "bugs", "a中", "1", "中文", "中文字", "文", "😀b", ".5", "é"]
    pattern = K.token_pattern(words)
    assert pattern.index("bugs") < pattern.index("bug|") < pattern.index("[A-Za-z0-9]+") < pattern.index("中文字") < pattern.index("中文|")
    inner = [re.sub(r"\.", r"\\.", w) for w in sorted(words, key=lambda w: (-len(w), w))]
    before = "(" + "|".join([*inner, "[A-Za-z0-9]+", pattern.split("|")[-1][:-1]]) + ")"
    df = spark.createDataFrame([("".join(rng.choice([*"abugs1 中文字.5é ", "😀"]) for _ in range(40)),) for _ in range(2000)], "t string")
    want = F.regexp_extract_all("t", F.lit(before), F.lit(1))
    assert df.filter(K.segment(F.col("t"), words) != want).count() == 0
    stop = F.array(*map(F.lit, K.STOP_WORDS))
    tokens = F.split("t", "")
    old = F.filter(tokens, lambda t: ~F.array_contains(stop, t) & ((F.length(t) >= 2) | t.rlike(r"^\p{L}+$")))
    assert df.filter(K.filter_tokens(tokens) != old).count() == 0
