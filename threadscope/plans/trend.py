"""Daily volume per platform and predicted label (the dashboard feed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def volume_trend(scored: DataFrame, day_col: str = "post_time", post_key: str = "post_key",
                 by: Sequence[str] = ("platform", "predict_label")) -> DataFrame:
    """Posts and comments per day, platform and label. ``count(DISTINCT)`` is
    planned by Spark as a two-level aggregate, so a busy day is reduced
    map-side before the shuffle."""
    return scored.groupBy(day_col, *by).agg(
        F.count_distinct(post_key).alias("n_posts"),
        F.count(F.lit(1)).alias("n_comments"))
