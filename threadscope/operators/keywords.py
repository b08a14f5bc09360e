"""Keyword tables and term frequencies (survey §2.K).

Segmentation re-aims the reference's probabilistic Chinese segmenter (not
available, and a per-row library) as a native longest-match tokenizer:
lexicon words first (longest first, so a longer word wins at the same
position), then runs of ASCII letters/digits, then every other
non-white-space character on its own (so CJK text splits into single
characters unless the lexicon knows the word). One ``regexp_extract_all``
per text, fully inside whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Game-specific words added to the segmenter's dictionary.
GAME_WORDS = ["異色", "色違", "星塵", "復刻", "機率", "bug", "極巨", "背卡"]

# Stop words of the keyword table and the word cloud.
STOP_WORDS = [
    "今天", "又", "了", "根本", "是", "一堆", "太", "啦", "終於", "一",
    "真的", "不是", "沒有", "可以", "現在", "看到", "什麼", "不會", "只有", "怎麼",
    "一個", "可能", "這樣", "直接", "還是", "所以", "應該", "就是", "知道", "那個",
    "這個", "因為", "一樣", "有人", "好像", "如果",
]

# Python's white space (str.isspace): never part of a token.
_WS = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

WORD_CAP = 100  # word-cloud size

# The segmenter's dictionary: the game words plus the multi-character stop
# words, so that a stop word is cut out as one token (as a dictionary
# segmenter does) and can then be dropped, instead of falling apart into
# single characters that survive the filter.
LEXICON = GAME_WORDS + [w for w in STOP_WORDS if len(w) > 1]


def token_pattern(lexicon: Iterable[str] = LEXICON) -> str:
    """Regex with one capture group; valid in Java and RE2 syntax. Words that
    begin with other than an ASCII letter or digit come after the runs of these,
    which begin at other places: at most places they so need not be tried."""
    words = sorted({w for w in lexicon if w}, key=lambda w: (-len(w), w))
    plain = [[], []]
    for w in words:
        plain[not re.match("[A-Za-z0-9]", w)].append(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", w))
    return "(" + "|".join([*plain[0], r"[A-Za-z0-9]+", *plain[1], rf"[^{_WS}A-Za-z0-9]"]) + ")"


def segment(text: Column, lexicon: Iterable[str] = LEXICON) -> Column:
    """K1: tokens of a text (array); NULL text -> empty array."""
    toks = F.regexp_extract_all(text, F.lit(token_pattern(lexicon)), F.lit(1))
    return F.coalesce(toks, F.array().cast("array<string>"))


def _stop(stop_words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in stop_words]) if stop_words else F.array().cast("array<string>")


def filter_tokens(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """K2: drop stop words and tokens of one character unless it is a
    letter (a single CJK character is a letter, so it stays)."""
    stop = _stop(stop_words)
    longest = max([1, *map(len, stop_words)])  # longer tokens need not be looked up
    return F.filter(tokens, lambda t: (F.length(t) > longest) | (~F.array_contains(stop, t)
                    & ((F.length(t) >= 2) | t.rlike(r"^\p{L}+$"))))


def keyword_table(scored: DataFrame, id_col: str = "doc_id", label_col: str = "predict_label",
                  text_col: str = "comment", lexicon: Iterable[str] = LEXICON,
                  stop_words: Sequence[str] = STOP_WORDS, keep: Sequence[str] = ()) -> DataFrame:
    """K3: one row per kept token occurrence ``(doc_id, predict_label,
    Keyword)``; documents without keywords vanish."""
    toks = filter_tokens(segment(F.col(text_col), lexicon), stop_words)
    return scored.select(id_col, label_col, *keep, F.explode(toks).alias("Keyword"))


def label_corpus(scored: DataFrame, label: int, label_col: str = "predict_label",
                 text_col: str = "comment") -> DataFrame:
    """K4: texts predicted as ``label`` (NULL texts dropped)."""
    return scored.filter((F.col(label_col) == label) & F.col(text_col).isNotNull())


def term_frequency(texts: DataFrame, text_col: str = "comment", max_words: int = WORD_CAP,
                   lexicon: Iterable[str] = LEXICON, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """K5: the data behind the word cloud. Tokens of two or more characters,
    stop words removed, counted; the ``max_words`` most frequent (ties by
    word) with ``weight = count / top count``. Counting is a partial
    aggregate; the top-k is a distributed TakeOrdered."""
    stop = _stop(stop_words)
    longest = max([1, *map(len, stop_words)])
    toks = F.filter(segment(F.col(text_col), lexicon),
                    lambda t: (F.length(t) > longest) | ((F.length(t) >= 2) & ~F.array_contains(stop, t)))
    counts = texts.select(F.explode(toks).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc("word")).limit(max_words)
    w = Window.partitionBy()  # over at most max_words rows
    return top.withColumn("weight", F.col("count") / F.max("count").over(w))


def keyword_counts(keywords: DataFrame, by: Sequence[str] = ("platform", "predict_label")) -> DataFrame:
    """K6: keyword counts per platform and predicted label (dashboard feed)."""
    return keywords.groupBy(*by, "Keyword").agg(F.count(F.lit(1)).alias("n"))
