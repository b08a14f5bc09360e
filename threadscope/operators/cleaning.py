"""Cleaning operators (survey §2.C) on the long data model.

Posts are one row per post (``key`` + post fields); comments are one row
per comment (``key``, order columns, ``comment_tag``, ``comment_author``,
``comment``). Keeping comments exploded lets Spark partition them freely:
a thread with many comments is never a single array in a single row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadscope.functions.dates import clean_date
from threadscope.functions.reactions import repair_total_reac
from threadscope.functions.text import clean_text
from threadscope.session import ensure_checkpoint_dir

PLATFORMS = ("ptt", "fb", "baha", "dcard")
ARROW = "→"
MIN_COMMENT_LEN = 6  # a kept comment has more than 5 code points after cleaning


# C9 ----------------------------------------------------------------------

def extract_article_tag(title: Column) -> Column:
    """``[tag]`` from the first ``[`` to the first ``]``; ``""`` otherwise
    (also when ``]`` comes first)."""
    s = F.instr(title, "[")
    e = F.instr(title, "]")
    return (F.when(title.isNull() | (title == ""), F.lit(""))
            .when((s > 0) & (e >= s), title.substr(s, e - s + 1))
            .otherwise(F.lit("")))


# C4 / C5 / C6 ------------------------------------------------------------

def filter_year(posts: DataFrame, year: str = "2025", col: str = "post_time") -> DataFrame:
    """Keep posts whose (cleaned) date starts with ``year``; NULL dates drop."""
    return posts.filter(F.col(col).startswith(year))


def clean_comments(comments: DataFrame, col: str = "comment", min_len: int = MIN_COMMENT_LEN) -> DataFrame:
    """Clean every comment text and keep those longer than ``min_len - 1``
    code points; other fields are kept as they are."""
    cleaned = comments.withColumn(col, clean_text(F.col(col)))
    return cleaned.filter(F.length(F.col(col)) >= min_len)


def drop_commentless_posts(posts: DataFrame, comments: DataFrame, key: str) -> DataFrame:
    """Posts with at least one surviving comment. The key set is made
    distinct first (partial aggregation collapses a hot thread map-side),
    so the semi join never sees a skewed build side."""
    return posts.join(comments.select(key).distinct(), key, "left_semi")


# C7 ----------------------------------------------------------------------

def merge_continuations(df: DataFrame, post_col: str, order_cols: Sequence[str],
                        author_col: str = "comment_author", tag_col: str = "comment_tag",
                        text_col: str = "comment", chunks: int | None = None,
                        carry: Sequence[str] = ()) -> DataFrame:
    """Merge PTT continuation lines into the comment they continue.

    A comment continues the current run when it has the same author and its
    tag is ``→``; its text is appended without a separator. Output: one row
    per run with the post key, the order columns of the run's first comment,
    ``comment_author``, ``comment`` and ``n_merged`` (plus ``carry``:
    columns constant within a post, such as its platform). Missing author,
    tag or text count as ``""``.

    Skew-safe gaps-and-islands: rows are range-partitioned on (post, order)
    into ``chunks`` slices, so one huge thread is split over many tasks.
    Run starts are found with ``lag`` inside each slice; a one-row-per-slice
    summary (bounded by ``chunks``, broadcast) carries the run that is open
    at each slice boundary. Run text is concatenated per (run, slice) first
    and then per run.
    """
    spark = df.sparkSession
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = list(order_cols)
    keys = [post_col] + order_cols
    carry = list(carry)
    d = df.select(*keys, *carry,
                  F.coalesce(F.col(author_col).cast("string"), F.lit("")).alias("_a"),
                  F.coalesce(F.col(tag_col).cast("string"), F.lit("")).alias("_t"),
                  F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_x"))
    d = d.repartitionByRange(n, *keys).withColumn("_chunk", F.spark_partition_id())
    w = Window.partitionBy("_chunk").orderBy(*keys)
    key = F.struct(*[F.col(k) for k in keys])
    d = (d.withColumn("_rn", F.row_number().over(w))
          .withColumn("_pp", F.lag(post_col).over(w))
          .withColumn("_pa", F.lag("_a").over(w)))
    local_start = (F.col("_rn") > 1) & (~F.col("_pp").eqNullSafe(F.col(post_col))
                                        | (F.col("_t") != F.lit(ARROW))
                                        | (F.col("_a") != F.col("_pa")))
    d = d.withColumn("_run_local", F.last(F.when(local_start, key), ignorenulls=True)
                     .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # Range bounds are sampled per evaluation, so the slice ids must be
    # materialised once before two branches read them (and before a lost
    # executor could make a recomputation disagree).
    ensure_checkpoint_dir(spark)
    d = d.checkpoint(eager=True)

    # One row per slice: its first row, and its last row with the run open there.
    summ = d.groupBy("_chunk").agg(
        F.min_by(F.struct(F.col(post_col).alias("p"), F.col("_a").alias("a"), F.col("_t").alias("t"),
                          key.alias("k")), F.col("_rn")).alias("f"),
        F.max_by(F.struct(F.col(post_col).alias("p"), F.col("_a").alias("a"),
                          F.col("_run_local").alias("open")), F.col("_rn")).alias("l"))
    sw = Window.orderBy("_chunk")  # over at most `chunks` rows
    prev_p, prev_a = F.lag("l.p").over(sw), F.lag("l.a").over(sw)
    prev_exists = F.lag("_chunk").over(sw).isNotNull()
    summ = summ.withColumn(
        "_fis", ~prev_exists | ~prev_p.eqNullSafe(F.col("f.p")) | (F.col("f.t") != F.lit(ARROW))
        | ~F.col("f.a").eqNullSafe(prev_a))
    summ = summ.withColumn("_own", F.coalesce(F.col("l.open"), F.when(F.col("_fis"), F.col("f.k"))))
    summ = summ.select("_chunk", "_fis", F.col("f.k").alias("_fk"),
                       F.last("_own", ignorenulls=True).over(sw.rowsBetween(Window.unboundedPreceding, -1))
                       .alias("_in"))

    d = d.join(F.broadcast(summ), "_chunk", "inner")
    d = d.withColumn("_run", F.coalesce(F.col("_run_local"), F.when(F.col("_fis"), F.col("_fk")), F.col("_in")))

    part = d.groupBy("_run", "_chunk").agg(
        F.first("_a").alias("_a"),
        *[F.first(c).alias(c) for c in carry],
        F.count(F.lit(1)).alias("_n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col("_x").alias("x")))),
                                 lambda s: s["x"]), "").alias("_p"))
    runs = part.groupBy("_run").agg(
        F.first("_a").alias(author_col),
        *[F.first(c).alias(c) for c in carry],
        F.sum("_n").alias("n_merged"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", "_p"))),
                                 lambda s: s["_p"]), "").alias(text_col))
    return runs.select(*[F.col(f"_run.`{k}`").alias(k) for k in keys], *carry, author_col, text_col, "n_merged")


# C8 / C10 ----------------------------------------------------------------

def repair_reactions(posts: DataFrame, col: str = "total_reac") -> DataFrame:
    """PTT ``total_reac`` repair from ``like``/``unlike`` (absent -> 0)."""
    like = F.col("like") if "like" in posts.columns else F.lit(0)
    unlike = F.col("unlike") if "unlike" in posts.columns else F.lit(0)
    is_str = F.col("total_reac_is_string") if "total_reac_is_string" in posts.columns else None
    return posts.withColumn(col, repair_total_reac(F.col(col), like, unlike, is_str))


def drop_post_url(posts: DataFrame) -> DataFrame:
    return posts.drop("post_url")


# C12 / C1 ----------------------------------------------------------------

def core_filter(posts: DataFrame, comments: DataFrame, key: str, year: str = "2025",
                comment_pre: Callable[[DataFrame], DataFrame] | None = None,
                min_len: int = MIN_COMMENT_LEN) -> tuple[DataFrame, DataFrame]:
    """Date clean -> year filter -> comment clean/filter -> drop posts without
    comments -> content clean. The filters run before the costly cleaning
    they do not depend on: only comments of kept posts, and only contents of
    posts that keep a comment, are cleaned."""
    p = filter_year(posts.withColumn("post_time", clean_date(F.col("post_time"))), year)
    c = comments.join(p.select(key), key, "left_semi")
    if comment_pre is not None:
        c = comment_pre(c)
    c = clean_comments(c, min_len=min_len)
    p = drop_commentless_posts(p, c, key)
    return p.withColumn("content", clean_text(F.col("content"))), c


def clean_ptt(posts: DataFrame, comments: DataFrame, key: str, order_cols: Sequence[str],
              year: str = "2025", chunks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """PTT: merge continuation lines, clean comments (a first time), repair
    ``total_reac``, drop ``post_url``; then the common pipeline, which
    cleans comments a second time (the reference does both)."""
    posts = drop_post_url(repair_reactions(posts))

    def pre(c: DataFrame) -> DataFrame:
        merged = merge_continuations(c, key, order_cols, chunks=chunks).drop("n_merged")
        return clean_comments(merged)
    return core_filter(posts, comments, key, year, comment_pre=pre)


def clean(platform: str, posts: DataFrame, comments: DataFrame, key: str,
          order_cols: Sequence[str], year: str = "2025") -> tuple[DataFrame, DataFrame]:
    """Dispatch on the platform name (case-insensitive)."""
    name = (platform or "").lower()
    if name not in PLATFORMS:
        raise ValueError(f"unknown platform, cannot clean: {platform}")
    if name == "ptt":
        return clean_ptt(posts, comments, key, order_cols, year)
    return core_filter(posts, comments, key, year)


def clean_all(posts: DataFrame, comments: DataFrame, key: str, order_cols: Sequence[str],
              year: str = "2025", platform_col: str = "platform",
              materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """C1 + C12 for every platform in one plan, platform kept as a column.

    Same result as ``clean(platform, ...)`` on each platform's rows: PTT
    comments are merged and cleaned a first time, PTT reactions repaired
    and ``post_url`` dropped; then all platforms share one year filter,
    one content-cleaning pass and one comment-cleaning pass. Comments carry
    ``platform_col`` (the posts' platform is joined in when absent).

    The cleaned comments feed both outputs (posts keep only those with a
    surviving comment). With ``materialize`` they are written once to the
    shared checkpoint folder, so the regex chain runs once per comment and
    is never fused into the key aggregation (whose generated code would
    pass the JVM's 64 KB method limit and fall back to interpretation).
    """
    # An unknown platform fails the job where it is met (no extra scan).
    plat = F.lower(F.col(platform_col))
    posts = posts.withColumn(platform_col, F.when(plat.isin(*PLATFORMS), F.col(platform_col)).otherwise(
        F.raise_error(F.concat(F.lit("unknown platform, cannot clean: "),
                               F.coalesce(F.col(platform_col), F.lit("NULL"))))))
    if platform_col not in comments.columns:
        comments = comments.join(posts.select(key, platform_col), key, "inner")
    is_ptt = F.lower(F.col(platform_col)) == "ptt"
    posts = repair_reactions(posts.withColumn("_raw_reac", F.col("total_reac")))
    posts = posts.withColumn("total_reac", F.when(is_ptt, F.col("total_reac"))
                             .otherwise(F.col("_raw_reac"))).drop("_raw_reac")
    if "post_url" in posts.columns:
        # C10 drops the PTT url; in one table that is a NULL on PTT rows.
        posts = posts.withColumn("post_url", F.when(~is_ptt, F.col("post_url")))
    p = filter_year(posts.withColumn("post_time", clean_date(F.col("post_time"))), year)
    c = comments.join(p.select(key), key, "left_semi")
    ptt = c.filter(is_ptt)
    merged = merge_continuations(ptt, key, order_cols, carry=[platform_col]).drop("n_merged")
    ptt_first = clean_comments(merged)
    # Non-PTT comments keep their other fields (PTT merged runs have none).
    c = clean_comments(ptt_first.unionByName(c.filter(~is_ptt), allowMissingColumns=True))
    if materialize:
        ensure_checkpoint_dir(c.sparkSession)
        c = c.checkpoint(eager=True)
    p = drop_commentless_posts(p, c, key)
    return p.withColumn("content", clean_text(F.col("content"))), c
