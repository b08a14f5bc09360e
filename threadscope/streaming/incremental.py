"""ST1: incremental ingest of raw post files with Structured Streaming.

Re-running the reference's load keeps old posts (``INSERT OR IGNORE``) and
appends comments. Here two streams do it. The first picks up new ``*.json``
files (each once, tracked in its checkpoint), parses them, keeps the first post
of each id within the batch and writes posts and comments under ``batch_id=N``
with overwrite, so a retried batch replaces its own output (``foreachBatch`` is
at-least-once). The second, which runs after each batch of the first, reads those
posts and keeps the first of each id over all batches: the ids seen so far are
keyed state of the stream, so a batch costs its own rows, however many posts are
stored; its file sink writes every batch exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.functions.ids import post_id
from threadscope.operators import relational as R
from threadscope.plans.ingest import POST_COLS, split_posts_comments
from threadscope.session import ship_package
from threadscope.sources import json_arrays, posts_json

#: Posts as the first stream leaves them; file_path and pos order those of a batch.
ARRIVED = T.StructType([T.StructField("post_id", T.StringType()), T.StructField("file_path", T.StringType()), T.StructField("pos", T.IntegerType()),
                        *(T.StructField(c, T.LongType() if c == "comment_count" else T.StringType()) for c in POST_COLS),
                        T.StructField("batch_id", T.LongType())])
POSTS = T.StructType([f for f in ARRIVED.fields if f.name not in ("file_path", "pos")])
#: What the binary-file source gives; only the path is read.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
#: Files of a batch at most; their names come to the driver.
MAX_FILES = 10_000


def ingest_files(spark: SparkSession, paths: list[str], batch_id: int, out_dir: str) -> None:
    """Posts (the first of each id) and comments of the files, as batch ``batch_id``."""
    if paths:
        elements = json_arrays.array_elements(spark, paths)[0]
    else:
        elements = spark.createDataFrame([], "file_path string, pos long, value string")
    posts, comments = split_posts_comments(posts_json.parse_posts(elements))
    p = R.with_required_columns(posts, POST_COLS).withColumn(
        "post_id", post_id(F.col("platform"), F.col("post_time"), F.col("author"), F.col("title")))
    first = R.dedupe_first_wins(p.select("post_id", "ingest_seq", "file_path", "pos", *POST_COLS), "post_id", "ingest_seq")
    first.drop("ingest_seq").write.mode("overwrite").parquet(f"{out_dir}/arrived/batch_id={batch_id}")
    c = comments.join(p.select("post_key", "post_id", "ingest_seq"), "post_key", "inner").select(
        "post_id", "ingest_seq", "pos", "comment_author", "comment")
    c.write.mode("overwrite").parquet(f"{out_dir}/comments/batch_id={batch_id}")


def first_posts(arrived: DataFrame) -> DataFrame:
    """Streaming: the posts of ids that no earlier batch held. A batch of the
    first stream, and so one of this, holds an id once."""
    return arrived.dropDuplicates(["post_id"]).select(*POSTS.names)


class Ingest:
    """The streams of one ingest: each batch of files is followed by one of posts."""

    def __init__(self, spark: SparkSession, folder: str, out_dir: str, checkpoint: str, available_now: bool):
        trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
        files = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", MAX_FILES)
                 .load(folder).select("path"))

        self._posts = None

        def batch(df: DataFrame, n: int) -> None:
            # What a failed attempt has written whole stays: the posts' stream may have begun to read it.
            whole = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/whole/{n}")
            fs = whole.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if not fs.exists(whole):
                ingest_files(df.sparkSession, [r.path for r in df.collect()], n, out_dir)
                fs.create(whole).close()
            posts = first_posts(spark.readStream.schema(ARRIVED).parquet(f"{out_dir}/arrived"))
            self._posts = (posts.writeStream.option("checkpointLocation", f"{checkpoint}/posts").trigger(availableNow=True).outputMode("append")
                           .format("parquet").start(f"{out_dir}/posts"))
            self._posts.awaitTermination()
        self._files = files.writeStream.option("checkpointLocation", f"{checkpoint}/files").trigger(**trigger).foreachBatch(batch).start()

    def awaitTermination(self) -> None:  # noqa: N802 - as StreamingQuery names it
        self._files.awaitTermination()

    def stop(self) -> None:
        self._files.stop()
        if self._posts:
            self._posts.stop()


def start_ingest(spark: SparkSession, folder: str, out_dir: str, checkpoint: str, available_now: bool = True) -> Ingest:
    """Start the streams; with ``available_now`` they process what is there and
    stop (call ``awaitTermination``). ``checkpoint`` records which files have
    been read and which ids were seen: keep it as long as ``out_dir``, in durable
    storage of its own, else a restart reads all files again. Results:
    ``out_dir/posts`` (see ``stored_posts``) and ``out_dir/comments``."""
    ship_package(spark)
    return Ingest(spark, folder, out_dir, checkpoint, available_now)


def stored_posts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The posts that were kept, each with the batch that it came in."""
    if not posts_json.path_exists(spark, f"{out_dir}/posts"):
        return spark.createDataFrame([], POSTS)
    return spark.read.schema(POSTS).parquet(f"{out_dir}/posts")
