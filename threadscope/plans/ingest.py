"""Raw JSON folder -> cleaned long table (CSV) and/or posts/comments tables.

Shape of the job (survey §3, E1): S1 read -> C1 clean -> R1-R5 tabulate ->
S4 CSV; and R6 post id -> R7 first-wins posts -> R8 comments with a dense
id -> S7 tables partitioned by platform.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadscope.functions.ids import post_id
from threadscope.operators import cleaning as C
from threadscope.operators import relational as R
from threadscope.session import ensure_checkpoint_dir
from threadscope.sources import posts_json, tables
from threadscope.sources.open_fields import project

log = logging.getLogger(__name__)

#: Columns that the long export adds to the posts'.
LONG_COLS = ("comment_pos", *posts_json.COMMENT_KEYS)
POST_COLS = ["platform", "post_time", "author", "title", "content", "total_reac", "comment_count"]


def split_posts_comments(raw: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Bronze posts (one row each) and their comments (one row per comment
    object, keyed by ``post_key`` and array position ``pos``; ``keep``
    names post columns the comments carry along). Where ``raw`` holds whole
    records, their other keys become columns of posts and comments."""
    exploded = raw.select("post_key", *keep, F.posexplode("comments_data").alias("pos", "c")).filter(F.col("c").isNotNull())
    own = ["post_key", *keep, "pos", "c.comment_tag", "c.comment_author", "c.comment"]
    if "record" not in raw.columns:
        return raw.drop("comments_data"), exploded.select(*own)
    of_posts, of_comments = posts_json.open_keys(raw)
    columns = [c for c in raw.columns if c not in ("comments_data", "record")]
    posts = raw.select(*columns, *project(F.col("record"), of_posts, [*columns, "post_id", *LONG_COLS]).values())
    taken = [*posts.columns, "post_id", *LONG_COLS]
    return posts, exploded.select(*own, *project(F.col("c.record"), of_comments, taken, "comment.").values())


def tabulate(posts: DataFrame, comments: DataFrame, key: str = "post_key") -> DataFrame:
    """The long export: post columns repeated per comment; a post without
    comments keeps one row with NULL comment fields."""
    p = R.with_required_columns(posts, [c for c in POST_COLS])
    more = [c for c in comments.columns if c not in (key, "pos", *posts_json.COMMENT_KEYS, FOLDER_COL)]
    c = comments.select(key, F.col("pos").alias("comment_pos"), "comment_author", "comment", *(f"`{c}`" for c in more))
    out = p.join(c, key, "left")
    return R.ensure_comment_columns(out)


def build_tables(posts: DataFrame, comments: DataFrame, key: str = "post_key",
                 order: str = "ingest_seq") -> tuple[DataFrame, DataFrame]:
    """Posts keyed by content hash, first occurrence wins; comments of every
    post (duplicates included, as the reference appends them) with a dense
    ``comment_id`` in ingest order and the post id as foreign key."""
    p = R.with_required_columns(posts, POST_COLS)
    p = p.withColumn("post_id", post_id(F.col("platform"), F.col("post_time"), F.col("author"), F.col("title")))
    folder = [FOLDER_COL] if FOLDER_COL in p.columns else []
    keyed = p.select(key, order, "post_id", "platform", *folder)
    posts_t = R.dedupe_first_wins(p.select("post_id", order, *POST_COLS, *folder), "post_id", order)
    c = comments.join(keyed, key, "inner").select(
        "post_id", "platform", *folder, "comment_author", "comment",
        F.struct(F.col(order).alias("o"), F.col("pos").alias("p")).alias("_corder"))
    comments_t = R.dense_index(c, ["_corder"], name="comment_id").drop("_corder")
    return posts_t, comments_t


FOLDER_COL = tables.FOLDER_COL
# Columns of the job itself, which no export holds.
INTERNAL_COLS = ("post_key", "ingest_seq", "file_path", "pos", "comment_pos", "like", "unlike", "total_reac_is_string")


def _read_folders(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Raw posts of every platform folder, tagged with the configured
    platform name in ``FOLDER_COL`` (cleaning dispatches on it; the data
    keeps the platform value the crawler wrote)."""
    frames = [posts_json.read_posts_json(spark, folder, records=True).withColumn(FOLDER_COL, F.lit(platform.lower()))
              for platform, folder in folders.items()]
    return R.union_all(frames)


def _known(folders: dict[str, str]) -> dict[str, str]:
    out = {}
    for platform, folder in folders.items():
        if (platform or "").lower() in C.PLATFORMS:
            out[platform] = folder
        else:
            log.warning("no configuration for platform %s, skipped", platform)
    return out


def run_many(spark: SparkSession, folders: dict[str, str], out_dir: str, output_type: str = "csv",
             year: str = "2025", cleaned: bool = True) -> dict:
    """Read -> clean -> export for several platform folders in one job.

    ``folders`` maps a platform name to its raw folder; unknown platforms
    are skipped. All platforms are cleaned in one pass; the CSV export is
    partitioned by ``FOLDER_COL`` (one folder of CSV files per platform)
    and the posts / comments tables by platform. ``output_type``: csv,
    sqlite (the tables) or both.
    """
    folders = _known(folders)
    if not folders:
        return {}
    # Bronze: the parsed posts are written once to the shared checkpoint
    # folder; posts, comments and the merge all read them (parsing whole
    # JSON files is the costly part of the read).
    ensure_checkpoint_dir(spark)
    raw = _read_folders(spark, folders).checkpoint(eager=True)
    posts, comments = split_posts_comments(raw, keep=(FOLDER_COL,))
    # Both sinks (and the CSV emptiness test) read the cleaned data: the
    # comments are written once to the shared checkpoint folder inside
    # clean_all, the posts here, instead of re-running the regex chain per
    # action.
    cp, cc = C.clean_all(posts, comments, "post_key", ["pos"], year=year, platform_col=FOLDER_COL,
                         materialize=True)
    ensure_checkpoint_dir(spark)
    # Only PTT posts carry a url, and C10 drops it: the exports have none.
    cp = cp.drop("post_url").checkpoint(eager=True)
    outputs = {}
    if output_type in ("csv", "both"):
        path = f"{out_dir}/cleaned_csv"
        long = tabulate(cp, cc.drop(FOLDER_COL)).drop(*INTERNAL_COLS)
        if tables.write_csv(long, path, partition_by=[FOLDER_COL]):
            outputs["csv"] = path
    if output_type in ("sqlite", "both"):
        src_p, src_c = (cp, cc) if cleaned else (posts, comments)
        pt, ct = build_tables(src_p, src_c.drop(FOLDER_COL))
        tables.write_posts_comments(pt, ct, f"{out_dir}/tables")
        outputs["tables"] = f"{out_dir}/tables"
    return outputs


def run(spark: SparkSession, platform: str, raw_folder: str, out_dir: str, output_type: str = "csv",
        year: str = "2025", cleaned: bool = True) -> dict:
    """P1 for one platform folder (the reference's entry point). The CSV
    goes to ``{out_dir}/cleaned_csv/platform_folder={platform}``. An
    unknown platform is a no-op (returns an empty dict)."""
    return run_many(spark, {platform: raw_folder}, out_dir, output_type, year, cleaned)
