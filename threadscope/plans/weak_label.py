"""Keyword weak-labelling sample and R13 hot-comment sample.

Reference behaviour: for each platform and sentiment, comments LEFT JOIN
posts, non-empty comments whose text LIKEs any keyword, ordered by
CAST(total_reac AS INTEGER) DESC, optionally LIMIT n; tagged and
concatenated. Here all platforms and sentiments are one plan:

* keyword tests are plain column expressions (no join with a keyword table);
* a comment matching several sentiments yields one row per sentiment;
* the filter runs before the join, so only matched comments are joined;
* one ``row_number`` window with a literal bound. Limited sentiments rank
  inside (platform, sentiment); unlimited sentiments get a per-row window
  key so every row ranks 1. Spark therefore inserts a partial
  WindowGroupLimit before the shuffle and a hot (platform, sentiment)
  group never moves more than ``limit`` rows per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadscope.operators import relational as R

KeywordSets = Mapping[str, tuple[Sequence[str], int | None]]

# The weak-labelling keyword lists and their per-platform
# limits (positive: every match; negative and neutral: the 30 comments of
# the most-reacted posts).
WEAK_LABEL_KEYWORDS: KeywordSets = {
    "positive": (["超讚", "很讚", "超強", "佛心", "真香", "畢業", "賺爛", "感謝N社", "感謝s社", "高興",
                  "優質", "感動", "好看", "好玩"], None),
    "negative": (["爛活動", "超爛", "討厭", "垃圾", "愛錢", "騙錢", "坑錢", "機率低", "bug"], 30),
    "neutral": (["普通", "地點", "還好吧", "兌換"], 30),
}


def weak_label_sample(comments: DataFrame, posts: DataFrame, keyword_sets: KeywordSets = WEAK_LABEL_KEYWORDS,
                      join_key: str = "post_key", tiebreak: Sequence[str] = ("post_key", "pos"),
                      platform_col: str = "platform", annotate: bool = True) -> DataFrame:
    """Rows ``platform, title, comment, total_reac, sentiment`` (+ blank
    ``label``/``remark``) plus the tiebreak key columns."""
    if not keyword_sets:
        raise ValueError("no keyword sets")
    limits = {s: lim for s, (_, lim) in keyword_sets.items()}
    bounded = [v for v in limits.values() if v is not None]
    if any(v <= 0 for v in bounded):
        raise ValueError("limits must be positive")

    c = comments.filter(R.non_empty("comment"))
    tags = F.array(*[F.when(R.like_any(F.col("comment"), kws), F.lit(s))
                     for s, (kws, _) in keyword_sets.items()])
    c = (c.withColumn("_tags", F.filter(tags, lambda x: x.isNotNull()))
          .filter(F.size("_tags") > 0)
          .withColumn("sentiment", F.explode("_tags")).drop("_tags"))

    p = posts.select(join_key, "title", "total_reac")
    joined = R.comments_with_posts(c, p, join_key)

    if not bounded:
        out = joined
    else:
        lim_map = F.create_map(*[x for s, v in limits.items() if v is not None for x in (F.lit(s), F.lit(v))])
        joined = joined.withColumn("_limit", lim_map[F.col("sentiment")])
        unlimited_key = F.when(F.col("_limit").isNull(), F.struct(*[F.col(k) for k in tiebreak]))
        w = Window.partitionBy(F.col(platform_col), F.col("sentiment"), unlimited_key) \
                  .orderBy(*R.reaction_order("total_reac", tiebreak))
        ranked = joined.withColumn("_rn", F.row_number().over(w))
        cond = F.col("_rn") <= F.lit(max(bounded))
        if len(set(bounded)) > 1:
            cond = cond & ((F.col("_rn") <= F.col("_limit")) | F.col("_limit").isNull())
        out = ranked.filter(cond).drop("_rn", "_limit")

    out = out.select(platform_col, "title", "comment", "total_reac", "sentiment", *tiebreak)
    return R.add_annotation_columns(out) if annotate else out


def hot_comments(comments: DataFrame, posts: DataFrame, limit: int = 180, join_key: str = "post_key",
                 tiebreak: Sequence[str] = ("post_key", "pos"), platform_col: str = "platform") -> DataFrame:
    """R13 ``fetch_platform``: top ``limit`` non-empty comments of the hottest
    posts per platform."""
    c = comments.filter(R.non_empty("comment"))
    joined = R.comments_with_posts(c, posts.select(join_key, "title", "total_reac"), join_key)
    top = R.top_n_per_group(joined, [platform_col], R.reaction_order("total_reac", tiebreak), limit)
    return top.select(platform_col, "title", "comment", "total_reac", *tiebreak, "rank")
