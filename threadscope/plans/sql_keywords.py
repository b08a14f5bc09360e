"""Keyword rules as DuckDB SQL, written out on their own: the oracle must not
be built from the code that it checks."""

# Words that are cut out whole, longest first, then the words
# that the keyword table drops.
_WHOLE = ("bug|一個|一堆|一樣|不是|不會|什麼|今天|只有|可以|可能|因為|好像|如果|就是|復刻|怎麼|應該|所以|星塵|"
          "有人|根本|極巨|機率|沒有|現在|異色|直接|看到|真的|知道|終於|背卡|色違|這個|這樣|還是|那個")
_DROPPED = ("今天 又 了 根本 是 一堆 太 啦 終於 一 真的 不是 沒有 可以 現在 看到 什麼 不會 只有 怎麼 "
            "一個 可能 這樣 直接 還是 所以 應該 就是 知道 那個 這個 因為 一樣 有人 好像 如果")

SQL_SPACE = "\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"

#: The tokens of ``comment``: a whole word, a run of ASCII letters and digits, or one other character.
SQL_TOKENS = f"regexp_extract_all(comment, '({_WHOLE}|[A-Za-z0-9]+|[^A-Za-z0-9{SQL_SPACE}])', 1)"
SQL_STOP = "['" + _DROPPED.replace(" ", "', '") + "']"
