"""Relational operators (survey §2.R): every one is DataFrame -> DataFrame.

Skew note: several reference steps are "per group" (per post, per platform,
per label). Group keys such as platform or label have a handful of values,
so one group can hold a third of all rows. Operators here avoid putting a
whole group into one task: first-wins dedupe pre-aggregates map-side, top-N
uses a literal ``row_number() <= N`` so Spark inserts a partial
WindowGroupLimit before the shuffle, and ordered text concatenation is done
in two levels.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.functions.reactions import sqlite_integer
from threadscope.session import ensure_checkpoint_dir

# The eight post fields every tabular export carries.
REQUIRED_POST_FIELDS = ["platform", "post_time", "author", "title", "content",
                        "total_reac", "comment_count", "comments_data"]
COMMENT_FIELDS = ["comment_author", "comment"]

_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _cols(cols: Iterable) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


# Partitioning ------------------------------------------------------------

def spread(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """``df`` dealt over ``partitions`` by key (without keys: evenly). For
    CPU-heavy per-row work on tables that scan as too few splits; the caller
    decides, a table that scans as many splits needs no such shuffle."""
    return df.repartition(partitions, *[F.col(k) for k in keys])


# R1 / R5 -----------------------------------------------------------------

def with_required_columns(df: DataFrame, fields: Sequence[str] = REQUIRED_POST_FIELDS,
                          types: dict | None = None) -> DataFrame:
    """Add each missing field as a NULL column; extra columns are kept."""
    types = types or {}
    missing = {f: F.lit(None).cast(types.get(f, "string")) for f in fields if f not in df.columns}
    return df.withColumns(missing) if missing else df


def ensure_comment_columns(df: DataFrame) -> DataFrame:
    return with_required_columns(df, COMMENT_FIELDS)


# R2 / R3 / R4 ------------------------------------------------------------

def comments_or_empty(df: DataFrame, col: str = "comments_data") -> DataFrame:
    """A non-list ``comments_data`` becomes an empty list."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.ArrayType):
        return df.withColumn(col, F.coalesce(F.col(col), F.array().cast(dt)))
    # Anything that is not an array (e.g. a string or NULL column) is "not a list".
    return df.withColumn(col, F.array().cast(T.ArrayType(T.StringType())))


def explode_comments(df: DataFrame, col: str = "comments_data", pos_col: str = "comment_pos") -> DataFrame:
    """One row per comment; a post with no comments keeps one row of NULLs.

    The comment record's fields become columns (``flatten_struct``) and the
    array position is kept as ``pos_col`` (order matters downstream).
    """
    df = comments_or_empty(df, col)
    base = [c for c in df.columns if c != col]
    exploded = df.select(*base, F.posexplode_outer(col).alias(pos_col, "_c")) \
                 .withColumn(pos_col, F.col(pos_col).cast("bigint"))
    et = df.schema[col].dataType.elementType
    if isinstance(et, T.StructType):
        fields = flatten_struct_fields(et, "_c")
        exploded = exploded.select(*base, pos_col, *fields)
    else:
        exploded = exploded.drop("_c")
    return ensure_comment_columns(exploded)


def flatten_struct_fields(st: T.StructType, prefix: str, name_prefix: str = "") -> list[Column]:
    """Columns for every leaf of a struct; nested keys are joined with dots."""
    out = []
    for f in st.fields:
        path = f"{prefix}.`{f.name}`"
        name = f"{name_prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out.extend(flatten_struct_fields(f.dataType, path, name + "."))
        else:
            out.append(F.col(path).alias(name))
    return out


# R7 ----------------------------------------------------------------------

def dedupe_first_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the first row per ``key`` in ``order`` (INSERT OR IGNORE).

    The least order of each key is found on these two columns alone, with a
    map-side partial step, so a key that holds many copies is collapsed inside
    every map task; only the rows that hold it are then kept whole. ``order``
    must be unique per row for a deterministic winner.
    """
    first = df.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_order"))
    kept = df.join(first, F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_order")), "left_semi")
    return kept.select(key, *[c for c in df.columns if c != key])


# R8 / R24 ----------------------------------------------------------------

def dense_index(df: DataFrame, order_cols: Sequence, name: str = "row_index", start: int = 1) -> DataFrame:
    """Attach a dense 1-based position in a global order (AUTOINCREMENT / index+1).

    Distributed: a range-partitioned sort, then per-partition row counts
    (one row per partition, so the offset table is bounded by the number of
    partitions and safe to broadcast), then offset + local position. The
    tagged rows are checkpointed once. The order columns must be unique per
    row.
    """
    mask = (1 << 33) - 1
    tagged = df.orderBy(*_cols(order_cols)).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(mask)))
    # Range bounds are sampled per evaluation: materialise the tagged rows
    # once so the count branch and the row branch agree (also after a lost
    # executor). Written to the shared checkpoint folder.
    ensure_checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-partition window over it is bounded.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid", "inner")
    return out.withColumn(name, (F.col("_off") + F.col("_loc") + F.lit(start)).cast("bigint")) \
              .drop("_mid", "_pid", "_loc", "_off")


# R9 / R10 / R11 ----------------------------------------------------------

def comments_with_posts(comments: DataFrame, posts: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """comments LEFT JOIN posts. AQE picks broadcast vs sort-merge at runtime
    and splits a skewed comment partition (a hot post) for the outer side."""
    return comments.join(posts, on, "left")


def non_empty(col: str = "comment") -> Column:
    return F.col(col).isNotNull() & (F.col(col) != "")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _ASCII_UPPER, _ASCII_LOWER)


def like_any(c: Column, keywords: Sequence[str]) -> Column:
    """OR of ``c LIKE '%kw%'`` with SQLite rules: ASCII letters match either
    case, ``%`` and ``_`` in a keyword stay wildcards. Empty keywords are
    rejected (``'%%'`` would match everything)."""
    kws = list(keywords)
    if not kws:
        raise ValueError("keyword list is empty")
    if any((k is None) or (k == "") for k in kws):
        raise ValueError("empty keyword: LIKE '%%' would match every comment")
    low = ascii_lower(c)
    cond = None
    for k in kws:
        pat = "%" + k.translate(str.maketrans(_ASCII_UPPER, _ASCII_LOWER)).replace("\\", "\\\\") + "%"
        term = low.like(pat)
        cond = term if cond is None else (cond | term)
    return cond


def keyword_match(df: DataFrame, keywords: Sequence[str], col: str = "comment") -> DataFrame:
    return df.filter(like_any(F.col(col), keywords))


# R12 / R13 ---------------------------------------------------------------

def reaction_order(reac_col: str = "total_reac", tiebreak: Sequence[str] = ()) -> list[Column]:
    """``ORDER BY CAST(total_reac AS INTEGER) DESC`` (SQLite: NULL last) plus
    an explicit ascending tiebreak for a deterministic result."""
    return [sqlite_integer(F.col(reac_col)).desc_nulls_last()] + [F.col(t).asc() for t in tiebreak]


def order_by_reactions(df: DataFrame, reac_col: str = "total_reac",
                       tiebreak: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    out = df.orderBy(*reaction_order(reac_col, tiebreak))
    return out.limit(limit) if limit is not None else out


def top_n_per_group(df: DataFrame, group_cols: Sequence, order_cols: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """``row_number() <= n`` per group. The literal bound lets Spark add a
    partial WindowGroupLimit before the shuffle, so a hot group ships at
    most n rows per map task."""
    w = Window.partitionBy(*_cols(group_cols)).orderBy(*order_cols)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= F.lit(n))
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


# R14 / R15 / R16 / R17 ---------------------------------------------------

def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate rows by column name; missing columns become NULL; no dedupe."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def add_annotation_columns(df: DataFrame, cols: Sequence[str] = ("label", "remark")) -> DataFrame:
    return df.withColumns({c: F.lit("") for c in cols})


def project(df: DataFrame, cols: Sequence[str], rename: dict | None = None) -> DataFrame:
    out = df.select(*cols)
    for a, b in (rename or {}).items():
        out = out.withColumnRenamed(a, b)
    return out


# R18 / R19 ---------------------------------------------------------------

def ne_pandas(c: Column, value) -> Column:
    """pandas ``!=``: true against a missing value."""
    return ~c.eqNullSafe(F.lit(value) if not isinstance(value, Column) else value)


def fill_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.fill("", subset=list(cols))


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


# R20 / R21 / R22 ---------------------------------------------------------

def value_counts(df: DataFrame, col: str, share_col: str | None = "share") -> DataFrame:
    """Count per non-NULL value, largest first, with its share of the total.

    The total is a scalar subquery over the counts (Spark reuses their
    shuffle), so no step gathers the counts into a single partition and no
    join is needed.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if share_col:
        total = counts.agg(F.sum("count").alias("_total")).scalar()
        counts = counts.withColumn(share_col, F.col("count") / total)
    return counts.orderBy(F.desc("count"), F.asc(col))


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """One row of ``count(*)`` per named frame (a union of global counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("name", F.lit(name))
             for name, df in named.items()]
    return union_all(parts).select("name", "n_rows")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


# R23 ---------------------------------------------------------------------

def seeded_shuffle(df: DataFrame, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible full shuffle: order by a hash of the row key and seed
    (``rand`` would change with the partitioning)."""
    return df.orderBy(F.xxhash64(*_cols(key_cols), F.lit(seed)), *_cols(key_cols))


# R25 ---------------------------------------------------------------------

def concat_texts(df: DataFrame, group_cols: Sequence[str], text_col: str, order_cols: Sequence[str],
                 sep: str = " ", out_col: str = "text", chunk_rows: int = 1 << 16) -> DataFrame:
    """Ordered string concatenation per group, in two levels.

    Level one concatenates ordered slices of at most ``chunk_rows`` rows
    (slice = bucket of the global position in (group, order), computed from a
    range sort), level two joins the slice strings. A hot group is thus
    spread over many tasks; only its final (inherently large) string is
    built in one place. NULL texts are skipped, like ``dropna`` before join.
    """
    ranked = dense_index(df, list(group_cols) + list(order_cols), name="_gi")
    sliced = ranked.withColumn("_slice", F.floor(F.col("_gi") / F.lit(chunk_rows)))
    lvl1 = sliced.groupBy(*group_cols, "_slice").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_gi"), F.col(text_col).alias("t")))),
                                 lambda x: x["t"]), sep).alias("_part"))
    lvl2 = lvl1.groupBy(*group_cols).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_slice", "_part"))),
                                 lambda x: x["_part"]), sep).alias(out_col))
    return lvl2
