"""Forum-shaped views derived from the driver's parquet tables.

The test tables are generic (documents, conversations, events, ...). These
views map them onto the social-listening data model so that every operator
runs over whole tables. Each view has a Spark builder and the same
definition as a DuckDB CTE (``FX_SQL``) used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Text-heavy tables and their row keys: per-row work on them (regex
# cleaning, tokenizing, HTML parsing) is CPU-bound, and the test tables are
# single row groups, so the views deal them out by key over the session's
# shuffle partitions (at every size alike; see ``relational.spread``).
TEXT_TABLE_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in TEXT_TABLE_KEYS:
        from threadscope.operators.relational import spread
        df = spread(df, int(spark.conf.get("spark.sql.shuffle.partitions")), TEXT_TABLE_KEYS[name])
    return df


def platform_of(key: Column) -> Column:
    """Platform partition of a post key: 0 ptt, 1 baha, 2 dcard."""
    m = key % 3
    return F.when(m == 0, "ptt").when(m == 1, "baha").otherwise("dcard")


def fx_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts: one per document. ``total_reac`` keeps the raw crawled string."""
    d = read_table(spark, sf_dir, "documents")
    m5 = F.col("doc_id") % 5
    return d.select(
        F.col("doc_id"),
        platform_of(F.col("doc_id")).alias("platform"),
        F.date_add(F.lit("2024-12-01").cast("date"), (F.col("doc_id") % 400).cast("int"))
        .cast("string").alias("post_time"),
        F.col("source").alias("author"),
        F.substring("text", 1, 40).alias("title"),
        F.col("text").alias("content"),
        F.when(m5 == 0, F.lit("爆")).when(m5 == 1, F.lit("X3")).when(m5 == 2, F.lit(""))
        .when(m5 == 3, F.lit(None).cast("string"))
        .otherwise((F.col("n_chars") % 100).cast("string")).alias("total_reac"),
    )


def fx_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments: one per conversation turn; the post key is ``conv_id``."""
    c = read_table(spark, sf_dir, "conversations")
    m3 = F.col("turn") % 3
    return c.select(
        F.col("conv_id").alias("post_key"),
        F.col("turn").alias("pos"),
        platform_of(F.col("conv_id")).alias("platform"),
        F.when(m3 == 0, "推").when(m3 == 1, "→").otherwise("噓").alias("comment_tag"),
        F.col("role").alias("comment_author"),
        F.col("text").alias("comment"),
    )


def fx_nested_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in the crawler's nested shape: ``comments_data`` is the array of
    the post's comment records in turn order, ``comment_count`` its size.
    Comments are grouped per post only (one thread per row, as in the raw
    JSON), then joined to the posts by key."""
    c = fx_comments(spark, sf_dir)
    rec = F.struct(F.col("pos"), F.struct("comment_tag", "comment_author", "comment").alias("r"))
    nested = c.groupBy("post_key").agg(
        F.transform(F.array_sort(F.collect_list(rec)), lambda x: x["r"]).alias("comments_data"))
    p = fx_posts(spark, sf_dir)
    out = p.join(nested, p["doc_id"] == nested["post_key"], "left").drop("post_key")
    # The crawler always writes a list, empty for a post without comments.
    out = out.withColumn("comments_data", F.coalesce("comments_data", F.array().cast(nested.schema["comments_data"].dataType)))
    return out.withColumn("comment_count", F.size("comments_data").cast("bigint"))


def fx_pushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PTT-like push stream: post = day, order = (ts, event_id)."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").cast("date").cast("string").alias("post_key"),
        F.col("ts"),
        F.col("event_id"),
        (F.col("user_id") % 3).cast("string").alias("comment_author"),
        F.when(F.col("event_type") == "click", "→").otherwise("推").alias("comment_tag"),
        F.col("event_type").alias("comment"),
    )


def fx_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier output: three logits, each the sum of every third component
    of the embedding in steps of 1/1024 (whole numbers, so sums are exact)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id"),
        F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda j: F.aggregate(
            F.transform("embedding", lambda x, i: F.when(i % 3 == j, F.floor(x.cast("double") * 1024)).otherwise(F.lit(0))),
            F.lit(0).cast("long"), lambda total, v: total + v) / F.lit(1024.0)).alias("logits"),
        (F.col("label") % 3).alias("true_label"),
    )


def fx_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled comments: documents with ``quality + toxic`` as the class."""
    lab = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lab.join(docs, "doc_id", "inner").select(
        F.col("doc_id"),
        platform_of(F.col("doc_id")).alias("platform"),
        F.col("text").alias("comment"),
        (F.col("quality") + F.col("toxic")).alias("label"),
        F.when(F.col("doc_id") % 4 == 3, "T").otherwise("F").alias("is_generated"),
    )


def fx_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored comments: all documents with ``predict_label``, their label where
    they have one, else ``doc_id % 3``."""
    lab = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.join(lab, "doc_id", "left").select(
        "doc_id", platform_of(F.col("doc_id")).alias("platform"), F.col("text").alias("comment"),
        F.coalesce(F.col("quality") + F.col("toxic"), (F.col("doc_id") % 3).cast("int")).alias("predict_label"))


# Keyword lists for the weak-label plan on the Latin fixtures (parameters).
FX_WEAK_KEYWORDS = {
    "positive": (["elle", "und"], None),
    "negative": (["the"], 30),
    "neutral": (["con"], 30),
}


# Same views as DuckDB CTE bodies for oracle SQL.
FX_SQL = {
    "fx_posts": """
        SELECT doc_id,
               CASE doc_id % 3 WHEN 0 THEN 'ptt' WHEN 1 THEN 'baha' ELSE 'dcard' END AS platform,
               CAST(DATE '2024-12-01' + CAST(doc_id % 400 AS INTEGER) AS VARCHAR) AS post_time,
               source AS author,
               substr(text, 1, 40) AS title,
               text AS content,
               CASE doc_id % 5 WHEN 0 THEN '爆' WHEN 1 THEN 'X3' WHEN 2 THEN ''
                    WHEN 3 THEN NULL ELSE CAST(n_chars % 100 AS VARCHAR) END AS total_reac
        FROM documents""",
    "fx_comments": """
        SELECT conv_id AS post_key, turn AS pos,
               CASE conv_id % 3 WHEN 0 THEN 'ptt' WHEN 1 THEN 'baha' ELSE 'dcard' END AS platform,
               CASE turn % 3 WHEN 0 THEN '推' WHEN 1 THEN '→' ELSE '噓' END AS comment_tag,
               role AS comment_author, text AS comment
        FROM conversations""",
    "fx_pushes": """
        SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS post_key, ts, event_id,
               CAST(user_id % 3 AS VARCHAR) AS comment_author,
               CASE WHEN event_type = 'click' THEN '→' ELSE '推' END AS comment_tag,
               event_type AS comment
        FROM events""",
    "fx_logits": """
        SELECT vec_id,
               [list_sum([CAST(floor(CAST(embedding[i] AS DOUBLE) * 1024) AS BIGINT)
                          FOR i IN range(j, len(embedding) + 1, 3)]) / 1024.0::DOUBLE FOR j IN [1, 2, 3]] AS logits,
               label % 3 AS true_label
        FROM embeddings""",
    "fx_labelled": """
        SELECT l.doc_id,
               CASE l.doc_id % 3 WHEN 0 THEN 'ptt' WHEN 1 THEN 'baha' ELSE 'dcard' END AS platform,
               d.text AS comment, l.quality + l.toxic AS label,
               CASE WHEN l.doc_id % 4 = 3 THEN 'T' ELSE 'F' END AS is_generated
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
}
FX_SQL["fx_scored"] = """
        SELECT d.doc_id,
               CASE d.doc_id % 3 WHEN 0 THEN 'ptt' WHEN 1 THEN 'baha' ELSE 'dcard' END AS platform,
               d.text AS comment, coalesce(l.quality + l.toxic, CAST(d.doc_id % 3 AS INTEGER)) AS predict_label
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""


def with_fx(sql_body: str, *views: str) -> str:
    """Prefix a query with the CTEs it needs (dependencies first)."""
    order = ["fx_posts", "fx_comments", "fx_pushes", "fx_logits", "fx_labelled", "fx_scored"]
    need = set(views)
    ctes = [f"{v} AS ({FX_SQL[v]})" for v in order if v in need]
    return ("WITH " + ",\n".join(ctes) + "\n" + sql_body) if ctes else sql_body
