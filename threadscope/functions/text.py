"""Rule-based text cleaning (survey §2.C2) as native Spark column expressions.

The rules are data: ``CLEAN_RULES`` lists (name, pattern, replacement) in
the order they must run, with patterns written in Python ``re`` syntax —
they are fixed values that must equal the reference's behaviour.
``java_pattern`` turns one into the equivalent ``java.util.regex`` form by
three systematic changes:

* prefix ``(?dU)``: ``U`` makes ``\\s \\d`` and case folding Unicode-aware
  as in Python; ``d`` (UNIX_LINES) makes ``.`` exclude only ``\\n`` as in
  Python; ``\\w`` and ``\\b`` are spelled out with Python's word character
  (letter, number or underscore — Java also counts combining marks);
* a bare ``[`` inside a character class becomes ``\\[`` (Java would read a
  nested class);
* ``\\UXXXXXXXX`` escapes become ``\\x{...}``; ``\\1`` in replacements
  becomes ``$1``.

Python's ``\\s`` also matches U+001C..U+001F (Java's does not), so those
are mapped to a space first; the final whitespace collapse would turn them
into spaces anyway.

Only NFKC normalisation has no Spark builtin; it is the one Arrow-batched
pandas UDF (pure-ASCII strings are passed through untouched).

Emoji removal approximates the emoji database (not available here) with
code point ranges; the whitelist rule later drops any remaining symbol, so
the approximation only matters where an emoji splits a pattern.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Approximate emoji set (code point ranges of the emoji
# blocks and the common stand-alone emoji symbols), plus keycap sequences.
EMOJI_CLASS = ("[\U0001F000-\U0001FAFF\u2600-\u27BF\u2B00-\u2BFF\u2300-\u23FF\uFE0F\u200D"
               "\U000E0020-\U000E007F\u00A9\u00AE\u203C\u2049\u2122\u2139\u2194-\u2199"
               "\u21A9\u21AA\u24C2\u25AA\u25AB\u25B6\u25C0\u25FB-\u25FE\u2934\u2935"
               "\u3030\u303D\u3297\u3299]")
EMOJI_PATTERN = r"[0-9#*]\uFE0F?\u20E3|" + EMOJI_CLASS

_B = r"(?<![a-zA-Z0-9])"
_A = r"(?![a-zA-Z0-9])"

# The cleaning rules, in order (Python ``re`` syntax).
CLEAN_RULES: list[tuple[str, str, str]] = [
    ("line_breaks", r"[\n\r\xa0]", " "),
    ("url", r'https?://[^\s\u4e00-\u9fa5<>""’‘指標“”‘’@!,]+', ""),
    ("www", r'www\.[^\s\u4e00-\u9fa5<>""’‘指標“”‘’@!,]+', ""),
    ("mention", r'@[a-zA-Z0-9_\.]+(?:/[^\s<>"]*)?(?:\?[^\s<>"]*)?', ""),
    ("broken_url", r"(?i)https?\s*:\s*/\s*/\S+", ""),
    ("gift_code", r"\b(?=[A-Za-z]*\d)(?=\d*[A-Za-z])[A-Za-z0-9]{8,}\b", ""),
    ("friend_code", r"\b\d{12}\b|\b\d{4}\s\d{4}\s\d{4}\b", ""),
    ("hot_prefix", r"(?i)^HOT", ""),
    ("hash_tag", r"#[\w:]+#", ""),
    ("square_brackets", r"\[.*?\]", ""),
    ("paren_emoticon", r"\S*?\([^\s)]+?\)\S*?", ""),
    ("emoji_1", EMOJI_PATTERN, ""),
    ("lone_c", rf"(?i){_B}c{_A}", ""),
    ("cc", rf"(?i){_B}c{{2,}}{_A}", ""),
    ("zero_dot_zero", rf"(?i){_B}0.0{_A}", ""),
    ("qaq", rf"(?i){_B}QAQ{_A}", "好難過"),
    ("qq", rf"(?i){_B}QQ{_A}", "難過"),
    ("orz", rf"(?i){_B}orz{_A}", "無奈倒地"),
    ("lol", rf"(?i){_B}lol{_A}", "大笑"),
    ("tm", rf"(?i){_B}TM{_A}", "他媽"),
    ("xd", rf"(?i){_B}XD+{_A}", "笑"),
    ("ww", rf"(?i){_B}[w]{{2,}}(?!\.){_A}", "哈"),
    ("zz", rf"(?i){_B}[z]{{2,}}(?!\.){_A}", "睡"),
    ("w", rf"(?i){_B}[w]{_A}", "哈"),
    ("speechless", r"=\s*=+|=\s*-+\s*=", "無言"),
    ("at_at", r"@@+", "無奈"),
    ("shy", r"><", "害羞"),
    ("pout", r"=\s*3\s*=", "嘟嘴"),
    ("tongue", r"(?i):\s*P\b", ""),
    ("colon_d", r"(?i):\s*D\b", "大笑"),
    ("equals_d", r"(?i)=\s*D\b", "大笑"),
    ("emoji_2", EMOJI_PATTERN, ""),
    ("whitelist", r"[^\u4e00-\u9fa5a-zA-Z0-9\s!?,.:;@_=\-+*/~%()\\[\]{}<>]", ""),
    ("empty_brackets", r"\(\s*\)|\[\s*\]|\{\s*\}|<\s*>", ""),
    ("repeats", r"(.)\1{2,}", r"\1\1"),
    ("spaces", r"\s+", " "),
]


# Python's word character is "alphanumeric or underscore" (letters and all
# number categories, no combining marks); Java's \w and \b differ on marks,
# so both are spelled out.
_W = r"\p{L}\p{N}_"
_WORD_ESCAPES = {
    "w": f"[{_W}]",
    "W": f"[^{_W}]",
    "b": f"(?:(?<=[{_W}])(?![{_W}])|(?<![{_W}])(?=[{_W}]))",
    "B": f"(?:(?<=[{_W}])(?=[{_W}])|(?<![{_W}])(?![{_W}]))",
}
_WORD_ESCAPES_IN_CLASS = {"w": _W}


def java_pattern(py: str) -> str:
    """Python ``re`` pattern -> equivalent ``java.util.regex`` pattern."""
    out = []
    i, n = 0, len(py)
    in_class = False
    class_start = -1
    while i < n:
        ch = py[i]
        if ch == "\\" and i + 1 < n:
            nxt = py[i + 1]
            if nxt == "U" and i + 9 < n + 0 and re.fullmatch(r"[0-9A-Fa-f]{8}", py[i + 2:i + 10] or ""):
                out.append("\\x{" + py[i + 2:i + 10].lstrip("0") + "}")
                i += 10
                continue
            if nxt in "wWbB":
                table = _WORD_ESCAPES_IN_CLASS if in_class else _WORD_ESCAPES
                if nxt not in table:
                    raise NotImplementedError(f"\\{nxt} inside a character class")
                out.append(table[nxt])
            else:
                out.append(py[i:i + 2])
            i += 2
            continue
        if in_class:
            if ch == "]" and i > class_start:
                in_class = False
                out.append(ch)
            elif ch == "[":
                out.append("\\[")
            else:
                out.append(ch)
            i += 1
            continue
        if ch == "[":
            in_class = True
            out.append(ch)
            i += 1
            if i < n and py[i] == "^":
                out.append("^")
                i += 1
            class_start = i + 1 if (i < n and py[i] == "]") else i  # a leading ']' is literal
            if i < n and py[i] == "]":
                out.append("\\]")
                i += 1
            continue
        out.append(ch)
        i += 1
    return "(?dU)" + "".join(out)


def java_replacement(py_repl: str) -> str:
    return re.sub(r"\\(\d)", r"$\1", py_repl.replace("$", "\\$"))


def _nfkc_series(s: pd.Series) -> pd.Series:
    def norm(x):
        if not isinstance(x, str) or x.isascii():
            return x
        return unicodedata.normalize("NFKC", x)
    return s.map(norm)


# Marked nondeterministic (it is not) as an optimizer barrier: a filter on
# the cleaned text, e.g. ``length(clean) >= 6``, would otherwise be pushed
# below the projection by substituting the whole regex chain, which then
# runs twice per row (filter and output). Operators here place their cheap
# filters (year, platform) before cleaning by hand.
nfkc = F.pandas_udf(_nfkc_series, T.StringType()).asNondeterministic()
nfkc.__doc__ = "Unicode NFKC normalisation (Arrow-batched; ASCII passes through)."

# The bracket-emoticon pattern backtracks quadratically on long unspaced
# runs. Same matches, linear time: a match can only start where the
# previous one ended (\G) or after white space, and the trailing lazy
# ``\S*?`` always matches the empty string.
JAVA_OVERRIDES = {"paren_emoticon": r"(?dU)(?:\G|(?<!\S))\S*?\([^\s)]+?\)"}


def _body(java: str) -> str:
    return java[len("(?dU)"):]


# Same matches, fewer tests per position:
# * a ``\b`` that stands next to a digit or ASCII letter (a word character)
#   only depends on the character on its other side, so it is one
#   look-behind (before the match) or one look-ahead (after it);
_NOT_W_BEFORE, _NOT_W_AFTER = f"(?<![{_W}])", f"(?![{_W}])"
JAVA_OVERRIDES["gift_code"] = (f"(?dU){_NOT_W_BEFORE}(?=[A-Za-z]*\\d)(?=\\d*[A-Za-z])[A-Za-z0-9]{{8,}}"
                               f"{_NOT_W_AFTER}")
JAVA_OVERRIDES["friend_code"] = (f"(?dU){_NOT_W_BEFORE}(?:\\d{{12}}|\\d{{4}}\\s\\d{{4}}\\s\\d{{4}})"
                                 f"{_NOT_W_AFTER}")

# * most places of a text are ruled out by their first character, or the one
#   before, before anything else is tried there. The letters of these rules
#   have no other forms than their upper and lower case.
_START = {"gift_code": "(?<![A-Za-z0-9_])", "friend_code": "(?=\\d)",
          "lone_c": "(?=[cC])", "cc": "(?=[cC])", "zero_dot_zero": "(?=0)", "qaq": "(?=[qQ])", "qq": "(?=[qQ])",
          "orz": "(?=[oO])", "lol": "(?=[lL])", "tm": "(?=[tT])", "xd": "(?=[xX])", "ww": "(?=[wW])", "zz": "(?=[zZ])",
          "w": "(?=[wW])"}
JAVA_OVERRIDES |= {name: "(?dU)" + _START[name] + _body(JAVA_OVERRIDES.get(name) or java_pattern(p))
                   for name, p, _ in CLEAN_RULES if name in _START}
# * no emoji is below U+00A9, but its class is a long list of ranges;
# * a single space needs no replacement by a space.
JAVA_OVERRIDES |= {name: "(?dU)[0-9#*]\\uFE0F?\\u20E3|(?![\\x00-\\xA8])" + _body(java_pattern(EMOJI_CLASS)) for name in ("emoji_1", "emoji_2")}
JAVA_OVERRIDES["spaces"] = r"(?dU)[^\S ]\s*| \s+"

JAVA_RULES = [(name, JAVA_OVERRIDES.get(name) or java_pattern(p), java_replacement(r))
              for name, p, r in CLEAN_RULES]


def clean_text_rules(c: Column, rules=None) -> Column:
    """The native rule chain (everything after NFKC), NULL-preserving."""
    out = F.regexp_replace(c, r"[\x1c-\x1f]", " ")
    for _, pat, rep in (rules or JAVA_RULES):
        out = F.regexp_replace(out, F.lit(pat), F.lit(rep))
    return F.trim(out)


def clean_text(c: Column) -> Column:
    """C2 ``clean_text``: NFKC, then the ordered rule chain, then trim.
    NULL stays NULL; non-string input is cast to string first. ASCII texts,
    which NFKC leaves as they are, do not go to Python."""
    text = c.cast("string")
    return clean_text_rules(F.coalesce(nfkc(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text))
