"""Content-hash identity of posts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _py_str(c: Column) -> Column:
    # Python's f-string prints a missing value as "None".
    return F.coalesce(c.cast("string"), F.lit("None"))


def post_id(platform: Column, post_time: Column, author: Column, title: Column) -> Column:
    """md5 hex of ``platform_post_time_author_title[:10]``.

    NULL platform / time / author print as ``None``; a NULL or empty title
    contributes ``""``. ``concat`` (not ``concat_ws``) so NULLs are never
    skipped silently.
    """
    short_title = F.substring(F.coalesce(title.cast("string"), F.lit("")), 1, 10)
    return F.md5(F.concat(_py_str(platform), F.lit("_"), _py_str(post_time), F.lit("_"),
                          _py_str(author), F.lit("_"), short_title))
