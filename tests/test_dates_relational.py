"""C3 dates, reaction casts, keyword LIKE, ids, dedupe, indexes, counts."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threadscope.functions.dates import clean_date
from threadscope.functions.ids import post_id
from threadscope.functions.reactions import repair_total_reac, sqlite_integer
from threadscope.operators import relational as R

DATES = [
    ("2025", "2025-01-01"), ("01/02/2025", "2025-01-02"), ("13/02/2025", "2025-02-13"),
    ("2025年1月2日", "2025-01-02"), ("2025年1月", None), ("5", None), ("1735689600", None),
    ("未成功抓取時間", None), ("Wed Jan 15 10:20:30 2025", "2025-01-15"),
    ("2025-01-02T23:30:00+08:00", "2025-01-02"), ("2025/1/2", "2025-01-02"), ("2025.01.02", "2025-01-02"),
    ("20250102", "2025-01-02"), ("2025-02-30", None), ("2025-1", "2025-01-01"), (None, None),
    ("  2025-03-04  ", "2025-03-04"), ("2025-03-04 12:00:00", "2025-03-04"), ("", None), ("now", None),
]


def test_clean_date(spark):
    df = spark.createDataFrame(DATES, "raw string, exp string")
    for raw, exp, got in rows(df.withColumn("got", clean_date(F.col("raw")))):
        assert got == exp, raw


def test_sqlite_integer(spark):
    cases = [("爆", 0), ("X3", 0), ("", 0), (None, None), ("57", 57), ("  -12abc", -12), ("3.7", 3), ("+4", 4),
             ("99999999999999999999", (1 << 63) - 1), ("-99999999999999999999x", -(1 << 63))]   # SQLite clamps
    df = spark.createDataFrame(cases, "s string, exp long")
    for s, exp, got in rows(df.withColumn("got", sqlite_integer(F.col("s")))):
        assert got == exp, s


def test_repair_total_reac(spark):
    cases = [("12", False, "12"), ("12", True, "4"), ("爆", True, "4"), ("X3", True, "4"), ("-5", True, "4"),
             ("--5", True, "4"), ("abc", True, "abc"), ("", True, "0"), (None, True, "0")]
    df = spark.createDataFrame(cases, "raw string, is_str boolean, exp string")
    out = df.withColumn("got", repair_total_reac(F.col("raw"), F.lit(5), F.lit(1), F.col("is_str")))
    for raw, _, exp, got in rows(out):
        assert got == exp, raw
    # like/unlike absent (the crawler never emits them) -> 0
    out = df.withColumn("got", repair_total_reac(F.col("raw"), F.lit(None), F.lit(None), F.col("is_str")))
    assert rows(out.filter("raw = '爆'"), "got") == [("0",)]


def test_like_any_sqlite_rules(spark):
    df = spark.createDataFrame([("Hello World",), ("ÉCOLE",), ("école",), ("a_b",), ("axb",)], "c string")
    def match(kws):
        return sorted(r[0] for r in df.filter(R.like_any(F.col("c"), kws)).collect())
    assert match(["hello"]) == ["Hello World"]          # ASCII case-insensitive
    assert match(["école"]) == ["école"]                # non-ASCII case-sensitive
    assert match(["a_b"]) == ["a_b", "axb"]             # _ stays a wildcard
    with pytest.raises(ValueError):
        R.like_any(F.col("c"), ["ok", ""])


def test_post_id_matches_python(spark):
    import hashlib
    def py(p, t, a, title):
        short = str(title)[:10] if title else ""
        return hashlib.md5(f"{p}_{t}_{a}_{short}".encode()).hexdigest()
    cases = [("ptt", "2025-01-02", "bob", "一二三四五六七八九十十一"), (None, None, None, None), ("baha", "x", "y", "")]
    df = spark.createDataFrame(cases, "p string, t string, a string, ti string")
    got = rows(df.select(post_id(F.col("p"), F.col("t"), F.col("a"), F.col("ti")).alias("id")))
    assert [g[0] for g in got] == [py(*c) for c in cases]


def test_dedupe_first_wins_hot_key(spark):
    data = [("hot", i, f"v{i}") for i in range(500, 0, -1)] + [("cold", 7, "c")]
    df = spark.createDataFrame(data, "k string, seq int, v string").repartition(8)
    assert sorted(rows(R.dedupe_first_wins(df, "k", "seq"), "k", "seq", "v")) == [("cold", 7, "c"), ("hot", 1, "v1")]


def test_dense_index(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    got = rows(R.dense_index(df, ["x"], name="i"), "x", "i")
    assert sorted(got) == [(x, x + 1) for x in range(1000)]


def test_explode_comments_outer(spark):
    schema = "pid int, comments_data array<struct<comment_author:string, comment:string, meta:struct<floor:int>>>"
    df = spark.createDataFrame([(1, [("a", "x", (1,)), ("b", "y", (2,))]), (2, []), (3, None)], schema)
    out = R.explode_comments(df)
    assert "meta.floor" in out.columns
    got = sorted(rows(out, "pid", "comment_pos", "comment_author", "comment"), key=lambda r: (r[0], r[1] or 0))
    assert got == [(1, 0, "a", "x"), (1, 1, "b", "y"), (2, None, None, None), (3, None, None, None)]


def test_value_counts_and_required(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    assert rows(R.value_counts(df, "v"), "v", "count", "share") == [(1, 2, 2 / 3), (2, 1, 1 / 3)]
    out = R.with_required_columns(spark.createDataFrame([("p",)], "platform string"))
    assert set(R.REQUIRED_POST_FIELDS) <= set(out.columns)


def test_top_n_per_group_plans_partial_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = R.top_n_per_group(df, ["g"], [F.col("v").desc()], 5)
    assert sorted(rows(top, "g", "v"))[:5] == [(0, 987), (0, 990), (0, 993), (0, 996), (0, 999)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_concat_texts_two_levels(spark):
    df = spark.createDataFrame([("a", i, f"t{i}") for i in range(10)] + [("b", 0, None)], "g string, o int, t string")
    out = dict(rows(R.concat_texts(df, ["g"], "t", ["o"], chunk_rows=3), "g", "text"))
    assert out["a"] == " ".join(f"t{i}" for i in range(10)) and out["b"] == ""
