"""Raw post JSON: reader (S1, S2) and writer (S3).

A raw file holds one JSON array of post objects (the crawler format). The
reader keeps the reference's tolerance: a file that does not parse, or does
not hold an array at the top level, is skipped (``unread`` lists what is
skipped, and why); array elements that are not objects are skipped; a missing
folder is skipped with a warning. Files are cut into elements by byte ranges
(``json_arrays``), then each element is parsed as a VARIANT. One odd element so
never nulls its neighbours (a typed ``from_json`` would null the whole array),
the JSON type of ``total_reac`` (number vs string) is kept for the PTT repair
rule, and keys that nobody declared stay (``open_fields``).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.sources.json_arrays import array_elements
from threadscope.sources.json_sink import write_arrays
from threadscope.sources.open_fields import Field, discover_by, project, undeclared

log = logging.getLogger(__name__)

COMMENT_TYPE = T.StructType([
    T.StructField("comment_tag", T.StringType()),
    T.StructField("comment_author", T.StringType()),
    T.StructField("comment", T.StringType()),
])

POST_FIELDS_STRING = ["platform", "post_time", "author", "title", "content", "post_url"]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _s(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "string")


#: Keys of a post and of a comment that the columns hold.
POST_KEYS = [*POST_FIELDS_STRING, "total_reac", "comment_count", "like", "unlike", "comments_data"]
COMMENT_KEYS = COMMENT_TYPE.names


def existing_folders(spark: SparkSession, folders: Sequence[str] | str) -> list[str]:
    """Those of the folders that exist; the others are warned about."""
    found = []
    for f in [folders] if isinstance(folders, str) else list(folders):
        if path_exists(spark, f):
            found.append(f)
        else:
            log.warning("folder not found, skipped: %s", f)
    return found


def unread(spark: SparkSession, folders: Sequence[str] | str, glob: str = "*.json") -> DataFrame:
    """(file_path, pos, reason) of what the reader skips though it is, or should
    be, a record: whole files (pos null), and records too large to hold."""
    paths = existing_folders(spark, folders)
    if not paths:
        return spark.createDataFrame([], "file_path string, pos long, reason string")
    return array_elements(spark, paths, glob)[1]


def parse_posts(elements: DataFrame, records: bool = False) -> DataFrame:
    """Elements ``(file_path, pos, value)`` -> one row per post object.

    Output: ``file_path``, ``pos`` (position in the file), ``ingest_seq``
    (struct of both: the ingest order), ``post_key`` (string form of it),
    the post fields as strings, ``total_reac_is_string``, ``comment_count``,
    ``like``, ``unlike`` and ``comments_data`` (array of comment structs;
    a non-object element becomes a NULL struct, a non-array value NULL).
    ``records``: whole posts and comments too, as VARIANT column ``record``
    and VARIANT field ``record`` of the comments.
    """
    # A generator, which no filter passes, so that each text is parsed once; of what parses, only objects begin with a brace.
    parsed = F.filter(F.array(F.try_parse_json("value")), lambda v: v.isNotNull())
    recs = elements.filter(F.ltrim("value", F.lit(" \t\r\n")).startswith("{")).select(
        "file_path", F.col("pos").cast("int").alias("pos"), F.explode(parsed).alias("_r"))
    r = F.col("_r")
    reac = F.try_variant_get(r, "$.total_reac", "variant")
    comments_arr = F.try_variant_get(r, "$.comments_data", "array<variant>")
    comment_struct = F.transform(comments_arr, lambda c: F.when(
        F.schema_of_variant(c).startswith("OBJECT"),
        F.struct(_s(c, "comment_tag").alias("comment_tag"), _s(c, "comment_author").alias("comment_author"),
                 _s(c, "comment").alias("comment"), *([c.alias("record")] if records else []))))
    out = recs.select(
        "file_path", "pos",
        F.struct("file_path", "pos").alias("ingest_seq"),
        F.concat_ws("#", "file_path", F.lpad(F.col("pos").cast("string"), 19, "0")).alias("post_key"),
        *[_s(r, k).alias(k) for k in POST_FIELDS_STRING],
        F.when(F.schema_of_variant(reac) == "VOID", F.lit(None).cast("string"))
         .otherwise(F.try_variant_get(reac, "$", "string")).alias("total_reac"),
        (F.schema_of_variant(reac) == "STRING").alias("total_reac_is_string"),
        F.try_variant_get(r, "$.comment_count", "bigint").alias("comment_count"),
        F.try_variant_get(r, "$.like", "bigint").alias("like"),
        F.try_variant_get(r, "$.unlike", "bigint").alias("unlike"),
        (comment_struct if records else comment_struct.cast(T.ArrayType(COMMENT_TYPE))).alias("comments_data"),
        *([r.alias("record")] if records else []),
    )
    return out


def read_posts_json(spark: SparkSession, folders: Sequence[str] | str, glob: str = "*.json", records: bool = False) -> DataFrame:
    """Every ``*.json`` file directly in the folder(s), see ``parse_posts``."""
    paths = existing_folders(spark, folders)
    if not paths:
        return parse_posts(spark.createDataFrame([], "file_path string, pos long, value string"), records)
    return parse_posts(array_elements(spark, paths, glob)[0], records)


def posts_with_comments(raw: DataFrame) -> DataFrame:
    """Posts read with ``records``, one row a comment (a post without comments:
    one row of nulls), with all their keys: the declared columns, and a column
    for every other key of a post or a comment, nested ones joined with dots.
    A comment's key that a post has too gets ``comment.`` in front."""
    of_posts, of_comments = open_keys(raw)
    own = [c for c in raw.columns if c not in ("comments_data", "record")]
    more = project(F.col("record"), of_posts, [*own, "comment_pos", *COMMENT_KEYS])
    rows = raw.select(*own, *more.values(), F.posexplode_outer("comments_data").alias("comment_pos", "_c"))
    of_comment = project(F.col("_c.record"), of_comments, [*rows.columns, *COMMENT_KEYS], "comment.")
    return rows.select(*(f"`{c}`" for c in rows.columns if c != "_c"), *(F.col(f"_c.{c}").alias(c) for c in COMMENT_KEYS), *of_comment.values())


def open_keys(raw: DataFrame) -> tuple[list[Field], list[Field]]:
    """The keys of posts and of comments that no column holds (``raw``: read with ``records``)."""
    record = lambda v, of_post: F.struct(F.lit(of_post).alias("of_post"), v.alias("record"))
    comments = F.transform(F.filter("comments_data", lambda c: c.isNotNull()), lambda c: record(c["record"], False))
    none = F.array().cast("array<struct<of_post:boolean,record:variant>>")
    both = raw.select(F.inline(F.concat(F.array(record(F.col("record"), True)), F.coalesce(comments, none))))
    found = discover_by(both, "record", "of_post")
    return undeclared(found.get(True), POST_KEYS), undeclared(found.get(False), COMMENT_KEYS)


def write_posts_json(df: DataFrame, path: str, files: int | None = None, partition_by: str | None = None) -> bool:
    """S3: raw-post sink, one JSON array per file (UTF-8, not ASCII-escaped),
    overwriting ``path``. A failure is reported, not raised. Each output
    file holds one partition's rows: as many files as the frame has
    partitions, or ``files``.

    ``partition_by`` writes one sub-folder per value (``path/col=value``) in
    a single job; rows are spread over ``files`` buckets per value, so one
    large value (a platform holding most posts) is written by many tasks.
    """
    cols = [c for c in df.columns if c != partition_by]
    part = F.col(partition_by).cast("string") if partition_by else F.lit(None).cast("string")
    j = df.select(part.alias("_part"), F.to_json(F.struct(*cols)).alias("j"))
    return write_json_arrays(j, path, files, partition_by)


def write_json_arrays(j: DataFrame, path: str, files: int | None = None, partition_by: str | None = None) -> bool:
    """Write JSON element texts (column ``j``; folder value ``_part`` when
    ``partition_by`` names the folder column) as files that each hold one
    JSON array (``json_sink``). Used by the raw-post sink; elements need not be
    objects. File names follow the order of the partitions."""
    spark = j.sparkSession
    if "_part" not in j.columns:
        j = j.withColumn("_part", F.lit(None).cast("string"))
    if partition_by:
        n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        j = j.repartition(n, "_part", F.pmod(F.xxhash64("j"), F.lit(n)))
        # As Spark names the folders of a partitioned table.
        value = F.replace(F.url_encode("_part"), F.lit("+"), F.lit(" "))
        folder = F.concat(F.lit(f"{partition_by}="), F.when(F.col("_part") != "", value).otherwise(F.lit("__HIVE_DEFAULT_PARTITION__")))
        rows = j.select(folder.alias("folder"), "j").sortWithinPartitions("folder")
    else:
        rows = (j.repartition(files) if files else j).select(F.lit(None).cast("string").alias("folder"), "j")
    try:
        write_arrays(rows, path)
        return True
    except Exception as e:  # noqa: BLE001 - the sink reports instead of raising
        log.error("saving failed: %s", e)
        return False
