"""Tabular sources and sinks: CSV (S4, S5), Parquet in place of Excel (S6),
the partitioned posts/comments tables (S7) and SQL over them (S8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The platform that a raw folder is configured for.
FOLDER_COL = "platform_folder"

# Declared table schemas (the posts / comments DDL).
POSTS_SCHEMA = T.StructType([
    T.StructField("post_id", T.StringType(), False),
    T.StructField("platform", T.StringType()),
    T.StructField("post_time", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("total_reac", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("comment_count", T.LongType()),
])
COMMENTS_SCHEMA = T.StructType([
    T.StructField("comment_id", T.LongType(), False),
    T.StructField("post_id", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("comment_author", T.StringType()),
    T.StructField("comment", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema (missing columns, and values that
    are not of the declared type, become NULL)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append((c.cast(f.dataType) if f.name not in df.columns else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*cols)


# S4 / S5 -----------------------------------------------------------------

def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> bool:
    """CSV with a header and no index, white space at the ends of values kept;
    skipped (returns False) when empty. Spark has no byte-order-mark option, so
    files are plain UTF-8."""
    if df.isEmpty():
        return False
    w = (df.write.mode(mode).option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return True


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


# S6 ----------------------------------------------------------------------

def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# S7 / S8 -----------------------------------------------------------------

def write_posts_comments(posts: DataFrame, comments: DataFrame, base: str, mode: str = "overwrite") -> None:
    """Posts and comments as two Parquet tables (instead of one table pair per
    platform), partitioned by the configured platform where the frames name
    it (``FOLDER_COL``; crawlers write other names into ``platform``), else
    by ``platform``."""
    for df, schema, name in ((posts, POSTS_SCHEMA, "posts"), (comments, COMMENTS_SCHEMA, "comments")):
        by = FOLDER_COL if FOLDER_COL in df.columns else "platform"
        fields = schema.fields + ([T.StructField(by, T.StringType())] if by == FOLDER_COL else [])
        write_table(conform(df, T.StructType(fields)), f"{base}/{name}", mode, [by])


def save_co_located(posts: DataFrame, comments: DataFrame, base: str, name: str, buckets: int) -> None:
    """Posts and comments below ``base`` as tables ``{name}_posts`` and
    ``{name}_comments``, both bucketed and sorted by ``post_id``: a join of the
    two reads bucket by bucket and shuffles neither. ``buckets`` is chosen for
    the comments, the larger table."""
    for df, schema, table in ((posts, POSTS_SCHEMA, "posts"), (comments, COMMENTS_SCHEMA, "comments")):
        by = FOLDER_COL if FOLDER_COL in df.columns else "platform"
        fields = schema.fields + ([T.StructField(by, T.StringType())] if by == FOLDER_COL else [])
        (conform(df, T.StructType(fields)).repartition(buckets, "post_id").write.mode("overwrite").partitionBy(by)
         .bucketBy(buckets, "post_id").sortBy("post_id").option("path", f"{base}/{table}").saveAsTable(f"{name}_{table}"))


def register_platform_views(spark: SparkSession, base: str | None, platforms: Sequence[str], name: str | None = None) -> None:
    """Temp views ``{platform}_posts`` / ``{platform}_comments`` over the
    partitioned tables below ``base``, or over the co-located tables ``name``;
    the platform filter (case-insensitive) prunes partitions."""
    posts, comments = ((spark.table(f"{name}_{t}") if name else spark.read.parquet(f"{base}/{t}")) for t in ("posts", "comments"))
    for p in platforms:
        for df, table in ((posts, "posts"), (comments, "comments")):
            by = FOLDER_COL if FOLDER_COL in df.columns else "platform"
            df.filter(F.lower(F.col(by)) == p.lower()).createOrReplaceTempView(f"{p}_{table}")


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)
