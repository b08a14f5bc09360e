"""Registered jobs over sources and sinks: raw-post JSON (S1-S3), tables
and SQL over them (S7, S8), the ingest job (P1), the keyword export (P3)
and the incremental streaming ingest (ST1).

Each job writes what Spark derives from the driver tables (the nested
fixture posts) under the shared checkpoint folder, reads it back through
the source under test and returns a frame whose oracle is the same data
computed directly by DuckDB: a lossless sink/source pair must give back
exactly what went in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from threadscope.catalog import query
from threadscope.functions.ids import post_id
from threadscope.operators import keywords as K
from threadscope.plans import ingest
from threadscope.plans.sql_cleaning import CLEANED_POSTS
from threadscope.plans.sql_keywords import SQL_STOP as _SQL_STOP
from threadscope.plans.sql_keywords import SQL_TOKENS as _SQL_TOKENS
from threadscope.session import scratch_path
from threadscope.sources import fixtures as fx
from threadscope.sources import posts_json, tables
from threadscope.sources.fixtures import with_fx

_POST_OUT = ["platform", "post_time", "author", "title", "content", "total_reac", "comment_count"]
_SQL_POST_ID_OF = ("md5(coalesce({t}platform, 'None') || '_' || coalesce({t}post_time, 'None') || '_' || "
                   "coalesce({t}author, 'None') || '_' || substr(coalesce({t}title, ''), 1, 10))")
_SQL_POST_ID = _SQL_POST_ID_OF.format(t="")
_SQL_COUNTS = """(SELECT p.*, coalesce(n, 0) AS comment_count FROM fx_posts p
   LEFT JOIN (SELECT post_key, count(*) AS n FROM fx_comments GROUP BY post_key) c ON c.post_key = p.doc_id)"""


def _tmp(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _raw_posts(spark, sf):
    """Nested fixture posts as the crawler writes them (``post_url`` keeps
    the source row id)."""
    n = fx.fx_nested_posts(spark, sf)
    return n.select(*_POST_OUT, "comments_data",
                    F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("post_url"))


def _write_raw(spark, df) -> str:
    path = _tmp(spark, "raw-posts")
    if not posts_json.write_posts_json(df, path):
        raise RuntimeError(f"could not write raw posts to {path}")
    return path


# --- S1 / S2 / S3 / R3 / R4 -----------------------------------------------

@query("s1_posts_json_roundtrip", sql=with_fx("""
SELECT 'doc-' || p.doc_id AS post_url, p.platform, p.post_time, p.author, p.title, p.content, p.total_reac,
       p.doc_id AS source_id, d.lang AS "origin.lang", d.n_chars AS "origin.size.chars",
       CAST(c.pos AS BIGINT) AS comment_pos, c.comment_tag, c.comment_author, c.comment,
       CAST(c.pos AS BIGINT) AS floor, CAST(length(c.comment) AS BIGINT) AS "meta.chars"
FROM fx_posts p JOIN documents d ON d.doc_id = p.doc_id LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY post_key ORDER BY pos) - 1 AS n FROM fx_comments) c ON c.post_key = p.doc_id""", "fx_posts", "fx_comments"))
def s1_posts_json_roundtrip(spark, sf):
    """Raw posts with keys that nobody declared, flat and nested ones, in posts
    and in comments, written and read back whole: one row a comment."""
    docs = fx.read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    raw = fx.fx_nested_posts(spark, sf).join(docs, "doc_id")
    comments = F.transform("comments_data", lambda c, i: F.struct(
        c["comment_tag"].alias("comment_tag"), c["comment_author"].alias("comment_author"), c["comment"].alias("comment"),
        i.alias("floor"), F.struct(F.length(c["comment"]).alias("chars")).alias("meta")))
    raw = raw.select(*_POST_OUT, comments.alias("comments_data"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("post_url"),
                     F.col("doc_id").alias("source_id"),
                     F.struct("lang", F.struct(F.col("n_chars").alias("chars")).alias("size")).alias("origin"))
    path = _write_raw(spark, raw)
    # A missing folder next to the real one is skipped with a warning.
    long = posts_json.posts_with_comments(posts_json.read_posts_json(spark, [path, path + "-missing"], records=True))
    known = {c: F.col(f"`{c}`") if c in long.columns else F.lit(None) for c in ("origin.lang", "origin.size.chars", "floor", "meta.chars")}
    return long.select("post_url", *[c for c in _POST_OUT if c != "comment_count"], F.col("source_id").cast("bigint").alias("source_id"),
                       known["origin.lang"].cast("string").alias("origin.lang"), known["origin.size.chars"].cast("bigint").alias("origin.size.chars"),
                       F.col("comment_pos").cast("bigint").alias("comment_pos"), *posts_json.COMMENT_KEYS,
                       known["floor"].cast("bigint").alias("floor"), known["meta.chars"].cast("bigint").alias("meta.chars"))


# --- C11 -------------------------------------------------------------------

@query("c11_skip_non_records", sql=with_fx("""
SELECT 'doc-' || p.doc_id AS post_url, p.title, p.content, p.total_reac, c.comment_tag, c.comment_author, c.comment
FROM fx_posts p LEFT JOIN fx_comments c ON c.post_key = p.doc_id""", "fx_posts", "fx_comments"))
def c11_skip_non_records(spark, sf):
    """Raw files whose arrays also hold numbers, strings and nulls, and
    whose comment lists start with a non-record on every fourth post: the
    reader keeps exactly the post objects and their comment records."""
    raw = _raw_posts(spark, sf).withColumn("_id", F.regexp_extract("post_url", r"(\d+)$", 1).cast("bigint"))
    cj = F.to_json(F.col("comments_data"))
    cj = F.when(F.col("_id") % 4 == 1, F.when(F.size("comments_data") > 0,
                                              F.regexp_replace(cj, r"^\[", '["not a record",'))
                .otherwise(F.lit('["not a record"]'))).otherwise(cj)
    obj = F.to_json(F.struct(*_POST_OUT, "post_url"))
    posts = raw.select(F.concat(F.regexp_replace(obj, r"\}$", ""), F.lit(',"comments_data":'), cj, F.lit("}"))
                       .alias("j"))
    junk = raw.filter(F.col("_id") % 10 == 0).select(
        F.when(F.col("_id") % 20 == 0, F.lit("7")).otherwise(F.lit('"x"')).alias("j"))
    nulls = raw.filter(F.col("_id") % 25 == 3).select(F.lit("null").alias("j"))
    path = _tmp(spark, "raw-mixed")
    if not posts_json.write_json_arrays(posts.unionByName(junk).unionByName(nulls), path):
        raise RuntimeError(f"could not write raw posts to {path}")
    back = posts_json.read_posts_json(spark, path)
    kept = F.filter("comments_data", lambda c: c.isNotNull())
    return back.select("post_url", "title", "content", "total_reac", F.explode_outer(kept).alias("c")).select(
        "post_url", "title", "content", "total_reac", "c.*")


# --- S7 / S8 ----------------------------------------------------------------

#: The first of the posts of an id, in ``from`` order, and the comments of all of them.
_SQL_STORED = """
, given AS ({given}),
posts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY nth, doc_id) AS r FROM given) WHERE r = 1),
comments AS (SELECT g.post_id, c.comment_author, c.comment FROM given g JOIN fx_comments c ON c.post_key = g.doc_id)
"""
_SQL_TABLES = with_fx(_SQL_STORED.format(given=f"SELECT {_SQL_POST_ID} AS post_id, 0 AS nth, * FROM fx_posts") + """
SELECT p.platform, p.post_time, p.author, p.title, p.content, TRY_CAST(p.total_reac AS INTEGER) AS total_reac, c.comment_author, c.comment
FROM comments c LEFT JOIN posts p ON c.post_id = p.post_id
WHERE c.comment IS NOT NULL AND c.comment != ''""", "fx_posts", "fx_comments").replace("\n\n, given AS", ",\ngiven AS", 1)


def _in_order(df):
    """The posts by their id, so that files and positions are in this order."""
    return df.withColumn("_id", F.regexp_extract("post_url", r"(\d+)$", 1).cast("bigint")).orderBy("_id").drop("_id")


_SQL_JOIN = """
        SELECT p.platform, p.post_time, p.author, p.title, p.content, p.total_reac, c.comment_author, c.comment
        FROM {pl}_comments c LEFT JOIN {pl}_posts p ON c.post_id = p.post_id
        WHERE c.comment IS NOT NULL AND c.comment != ''"""
_PLATFORMS = ["ptt", "baha", "dcard"]


def _tables_of(spark, sf):
    raw = posts_json.read_posts_json(spark, _write_raw(spark, _in_order(_raw_posts(spark, sf))))
    return ingest.build_tables(*ingest.split_posts_comments(raw))


@query("s8_sql_over_tables", sql=_SQL_TABLES)
def s8_sql_over_tables(spark, sf):
    base = _tmp(spark, "tables")
    tables.write_posts_comments(*_tables_of(spark, sf), base)       # S7
    tables.register_platform_views(spark, base, _PLATFORMS)
    return tables.run_sql(spark, "\nUNION ALL\n".join(_SQL_JOIN.format(pl=pl) for pl in _PLATFORMS))  # S8


@query("s8_sql_over_co_located", sql=_SQL_TABLES)
def s8_sql_over_co_located(spark, sf):
    """The same over tables bucketed by post id: the joins shuffle nothing."""
    name = f"posts_{uuid.uuid4().hex}"
    tables.save_co_located(*_tables_of(spark, sf), _tmp(spark, "co-located"), name, buckets=8)
    tables.register_platform_views(spark, None, _PLATFORMS, name)
    return tables.run_sql(spark, "\nUNION ALL\n".join(_SQL_JOIN.format(pl=pl) for pl in _PLATFORMS))


# --- P1 -------------------------------------------------------------------------

_P1_COLUMNS = ["platform", "post_time", "author", "title", "content", "total_reac", "comment_count", "comment_author", "comment", "platform_folder"]


@query("p1_ingest", sql=with_fx(CLEANED_POSTS + """
SELECT p.platform, p.post_time, nullif(p.author, '') AS author, nullif(p.title, '') AS title, nullif(p.content, '') AS content,
       nullif(p.total_reac, '') AS total_reac, CAST(n.n AS VARCHAR) AS comment_count,
       k.comment_author, k.comment, p.platform AS platform_folder
FROM kept k JOIN posts p ON p.doc_id = k.post_key JOIN (SELECT post_key, count(*) AS n FROM fx_comments GROUP BY post_key) n
  ON n.post_key = k.post_key""", "fx_posts", "fx_comments").replace("\n\n, given AS", ",\ngiven AS", 1))
def p1_ingest(spark, sf):
    """The ingest job over one raw folder per platform, CSV and tables both;
    the cleaned long table read back from the CSV, which has no empty text
    besides the missing one."""
    base = _tmp(spark, "raw-posts")
    # One folder per platform, written in one job.
    if not posts_json.write_posts_json(_raw_posts(spark, sf).withColumn("folder", F.col("platform")), base,
                                       partition_by="folder"):
        raise RuntimeError(f"could not write raw posts to {base}")
    folders = {p: f"{base}/folder={p}" for p in ("ptt", "baha", "dcard")}
    out = ingest.run_many(spark, folders, _tmp(spark, "ingest-out"), output_type="both", year="2025")
    if "csv" not in out:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in _P1_COLUMNS))
    return tables.read_csv(spark, out["csv"]).select(_P1_COLUMNS)


# --- P3 -------------------------------------------------------------------------



@query("p3_keyword_export", sql=with_fx(f"""
SELECT doc_id, predict_label, Keyword FROM (
  SELECT doc_id, predict_label, unnest({_SQL_TOKENS}) AS Keyword FROM fx_scored)
WHERE NOT list_contains({_SQL_STOP}, Keyword) AND (length(Keyword) >= 2 OR regexp_matches(Keyword, '^\\p{{L}}+$'))""",
                                         "fx_scored"))
def p3_keyword_export(spark, sf):
    path = _tmp(spark, "keywords-csv")
    kw = K.keyword_table(fx.fx_scored(spark, sf))
    if not tables.write_csv(kw, path):
        return kw.limit(0)
    return tables.read_csv(spark, path, "doc_id bigint, predict_label int, Keyword string")


# --- ST1 --------------------------------------------------------------------------

_SQL_ST1 = with_fx(_SQL_STORED.format(given=f"""
  SELECT {_SQL_POST_ID} AS post_id, 0 AS nth, * FROM fx_posts WHERE doc_id % 2 = 0
  UNION ALL SELECT {_SQL_POST_ID} AS post_id, 1 AS nth, * REPLACE (CASE WHEN doc_id % 2 = 0 THEN content || ' changed' ELSE content END AS content)
  FROM fx_posts WHERE doc_id % 2 = 1 OR doc_id % 3 = 0""") + """
SELECT p.post_id, p.platform, p.post_time, p.author, p.title, p.content, p.total_reac, p.nth AS batch_id, c.comment_author, c.comment
FROM posts p LEFT JOIN comments c ON c.post_id = p.post_id""", "fx_posts", "fx_comments").replace("\n\n, given AS", ",\ngiven AS", 1)


@query("st1_incremental_ingest", sql=_SQL_ST1)
def st1_incremental_ingest(spark, sf):
    """Two drops of raw files and a run without new ones. The second drop repeats
    a third of the first one's posts with other contents: those posts stay as
    they were, and their comments are appended. Stored posts with all stored
    comments."""
    from threadscope.streaming.incremental import start_ingest, stored_posts
    raw = _raw_posts(spark, sf).withColumn("_id", F.regexp_extract("post_url", r"(\d+)$", 1).cast("bigint"))
    folder, out, ckpt = _tmp(spark, "stream-in"), _tmp(spark, "stream-out"), _tmp(spark, "stream-ckpt")
    first = raw.filter(F.col("_id") % 2 == 0)
    second = raw.filter((F.col("_id") % 2 == 1) | (F.col("_id") % 3 == 0)).withColumn(
        "content", F.when(F.col("_id") % 2 == 0, F.concat("content", F.lit(" changed"))).otherwise(F.col("content")))
    for i, part in enumerate([first, second, None]):
        if part is not None:
            tmp = _write_raw(spark, _in_order(part).drop("_id"))
            src = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(tmp)
            fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            fs.mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder))
            for st in fs.listStatus(src):
                name = st.getPath().getName()
                if name.endswith(".json"):
                    fs.rename(st.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                        folder, f"drop{i}-{name}"))
        start_ingest(spark, folder, out, checkpoint=ckpt).awaitTermination()
    posts, comments = stored_posts(spark, out).drop("comment_count"), spark.read.parquet(f"{out}/comments")
    return posts.join(comments.select("post_id", "comment_author", "comment"), "post_id", "left").select(
        "post_id", "platform", "post_time", "author", "title", "content", "total_reac", F.col("batch_id").cast("int").alias("batch_id"),
        "comment_author", "comment")
