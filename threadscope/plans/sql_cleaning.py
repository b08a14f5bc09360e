"""The cleaning rules as DuckDB SQL, written out on their own: the oracle must
not be built from the code that it checks.

DuckDB's regular expressions know no look-around. A rule that looks at the
characters beside a match takes them along and puts them back; as matches then
cannot share such a character, it runs twice. A character repeated three times
or more is cut by position. DuckDB normalises to NFC only, which for the given
tables is the same as NFKC.
"""

from __future__ import annotations

from threadscope.plans.sql_keywords import SQL_SPACE as _S

_WORD = r"\p{L}\p{N}_"
# The characters that end a link, and the emoji.
_STOP = r"""<>"’‘指標“”@!,"""
_EMOJI = (r"[0-9#*]\x{FE0F}?\x{20E3}|[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{2300}-\x{23FF}\x{FE0F}\x{200D}"
          r"\x{E0020}-\x{E007F}\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}\x{21AA}\x{24C2}\x{25AA}\x{25AB}"
          r"\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2934}\x{2935}\x{3030}\x{303D}\x{3297}\x{3299}]")
#: Runs of eight or more ASCII letters and digits with both a letter and a digit: by the length of what comes first.
_CODE = "|".join([rf"{a}{{{i}}}{b}[A-Za-z0-9]{{{7 - i},}}" for a, b in (("[A-Za-z]", "[0-9]"), ("[0-9]", "[A-Za-z]")) for i in range(1, 8)]
                 + ["[A-Za-z]{8,}[0-9][A-Za-z0-9]*", "[0-9]{8,}[A-Za-z][A-Za-z0-9]*"])


def _apart(pattern: str, put: str = "", before: str = "a-zA-Z0-9", after: str = "a-zA-Z0-9", flags: str = "(?i)") -> list[tuple[str, str, str]]:
    """``pattern`` where none of the characters stands beside it."""
    return [(f"{flags}(^|[^{before}])(?:{pattern})($|[^{after}])", rf"\1{put}\2", "g")] * 2


def _not_before(pattern: str, put: str) -> list[tuple[str, str, str]]:
    """``pattern`` that no word character follows."""
    return [(f"(?i){pattern}($|[^{_WORD}])", rf"{put}\1", "g")] * 2


# The rules in their order, as (pattern, replacement, flags).
_RULES = [
    (r"[\x1C-\x1F]", " ", "g"),
    (r"[\n\r\x{A0}]", " ", "g"),
    (rf"https?://[^{_S}\x{{4e00}}-\x{{9fa5}}{_STOP}]+", "", "g"),
    (rf"www\.[^{_S}\x{{4e00}}-\x{{9fa5}}{_STOP}]+", "", "g"),
    (rf'@[a-zA-Z0-9_.]+(?:/[^{_S}<>"]*)?(?:\?[^{_S}<>"]*)?', "", "g"),
    (rf"(?i)https?[{_S}]*:[{_S}]*/[{_S}]*/[^{_S}]+", "", "g"),
    *_apart(_CODE, "", _WORD, _WORD, ""),
    *_apart(rf"\p{{Nd}}{{12}}|\p{{Nd}}{{4}}[{_S}]\p{{Nd}}{{4}}[{_S}]\p{{Nd}}{{4}}", "", _WORD, _WORD, ""),
    (r"(?i)^HOT", "", ""),
    (rf"#[{_WORD}:]+#", "", "g"),
    (r"\[.*?\]", "", "g"),
    (rf"[^{_S}]*?\([^{_S})]+?\)", "", "g"),
    (_EMOJI, "", "g"),
    *_apart("c"), *_apart("c{2,}"), *_apart("0.0"), *_apart("QAQ", "好難過"), *_apart("QQ", "難過"), *_apart("orz", "無奈倒地"),
    *_apart("lol", "大笑"), *_apart("TM", "他媽"), *_apart("XD+", "笑"), *_apart("w{2,}", "哈", after="a-zA-Z0-9."),
    *_apart("z{2,}", "睡", after="a-zA-Z0-9."), *_apart("w", "哈"),
    (rf"=[{_S}]*=+|=[{_S}]*-+[{_S}]*=", "無言", "g"),
    (r"@@+", "無奈", "g"),
    (r"><", "害羞", "g"),
    (rf"=[{_S}]*3[{_S}]*=", "嘟嘴", "g"),
    *_not_before(rf":[{_S}]*P", ""), *_not_before(rf":[{_S}]*D", "大笑"), *_not_before(rf"=[{_S}]*D", "大笑"),
    (_EMOJI, "", "g"),
    (rf"[^\x{{4e00}}-\x{{9fa5}}a-zA-Z0-9{_S}!?,.:;@_=\-+*/~%()\\\[\]{{}}<>]", "", "g"),
    (rf"\([{_S}]*\)|\[[{_S}]*\]|\{{[{_S}]*\}}|<[{_S}]*>", "", "g"),
]


def cleaned(source: str, text: str) -> str:
    """``source`` (a table or subquery) with its column ``text`` cleaned, as a subquery."""
    chain = f"nfc_normalize({text})"
    for pattern, put, flags in _RULES:
        chain = f"regexp_replace({chain}, '{pattern.replace(chr(39), chr(39) * 2)}', '{put}'" + (f", '{flags}'" if flags else "") + ")"
    return f"""(SELECT * EXCLUDE (_chars) REPLACE (trim(regexp_replace(array_to_string(list_filter(_chars,
        lambda x, i: i < 3 OR x <> _chars[i - 1] OR x <> _chars[i - 2]), ''), '[{_S}]+', ' ', 'g'), ' ') AS {text})
        FROM (SELECT *, regexp_extract_all({chain}, '(?s).') AS _chars FROM {source}))"""


#: CTEs ``kept`` (cleaned comments) and ``posts`` (their posts, cleaned) of the posts of 2025: lines of one
#: author that go on are merged on PTT, whose comments are cleaned twice.
CLEANED_POSTS = f"""
, given AS (SELECT c.* FROM fx_comments c JOIN fx_posts p ON p.doc_id = c.post_key WHERE p.post_time LIKE '2025%'),
starts AS (
  SELECT *, CASE WHEN lag(pos) OVER w IS NULL OR comment_tag <> '→' OR comment_author IS DISTINCT FROM lag(comment_author) OVER w
                 THEN 1 ELSE 0 END AS st
  FROM given WHERE platform = 'ptt' WINDOW w AS (PARTITION BY post_key ORDER BY pos)),
runs AS (SELECT *, sum(st) OVER (PARTITION BY post_key ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM starts),
merged AS (SELECT post_key, min(pos) AS pos, 'ptt' AS platform, arg_min(comment_author, pos) AS comment_author,
                  string_agg(comment, '' ORDER BY pos) AS comment, CAST(NULL AS VARCHAR) AS comment_tag FROM runs GROUP BY post_key, run),
both_kinds AS (SELECT * FROM {cleaned('merged', 'comment')} WHERE length(comment) >= 6
               UNION ALL SELECT post_key, pos, platform, comment_author, comment, comment_tag FROM given WHERE platform <> 'ptt'),
kept AS (SELECT * FROM {cleaned('both_kinds', 'comment')} WHERE length(comment) >= 6),
posts AS (
  SELECT * REPLACE (CASE WHEN platform <> 'ptt' THEN total_reac WHEN total_reac IS NULL OR total_reac = '' THEN '0'
                         WHEN total_reac = '爆' OR starts_with(total_reac, 'X') OR regexp_matches(total_reac, '^-*[0-9]+$') THEN '0'
                         ELSE total_reac END AS total_reac)
  FROM {cleaned('(SELECT * FROM fx_posts WHERE doc_id IN (SELECT post_key FROM kept))', 'content')})
"""
