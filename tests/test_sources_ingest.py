"""S1-S8, P1 and ST1 on small raw-post folders written by the tests."""
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threadscope.plans import ingest
from threadscope.sources import posts_json, tables

POSTS = [
    {"platform": "PTT", "post_time": "2025-01-02", "author": "a", "title": "[問題] 標題一", "content": "內容",
     "total_reac": "爆", "comment_count": 2, "post_url": "https://www.ptt.cc/bbs/P/M.1.html",
     "comments_data": [{"comment_tag": "推", "comment_author": "u1", "comment": " 這個活動真的很好玩"},
                       {"comment_tag": "→", "comment_author": "u1", "comment": " 接著說第二行"},
                       "not a record"]},
    {"platform": "PTT", "post_time": "Wed Jan 15 10:20:30 2025", "author": "b", "title": "標題二",
     "content": "內容二", "total_reac": 12, "comment_count": 1,
     "comments_data": [{"comment_tag": "噓", "comment_author": "u2", "comment": "去年今日也是一樣好玩"}]},
    7,
]


def _write(folder, name, payload, raw=False):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(payload if raw else json.dumps(payload, ensure_ascii=False))


@pytest.fixture
def raw_folder(tmp_path):
    d = str(tmp_path / "raw")
    _write(d, "a.json", POSTS)
    _write(d, "b.json", [POSTS[0]])                  # a duplicate post in a later file
    _write(d, "broken.json", "[{", raw=True)
    _write(d, "object.json", {"platform": "PTT"})
    _write(d, "note.txt", POSTS)
    return d


def test_read_posts_json(spark, raw_folder, tmp_path):
    df = posts_json.read_posts_json(spark, [raw_folder, str(tmp_path / "missing")])
    got = sorted(rows(df, "pos", "author", "total_reac", "total_reac_is_string"))
    assert got == [(0, "a", "爆", True), (0, "a", "爆", True), (1, "b", "12", False)]
    comments = rows(df.filter(F.col("author") == "b").select(F.size("comments_data")))
    assert comments == [(1,)]
    assert posts_json.read_posts_json(spark, str(tmp_path / "missing")).count() == 0


def test_posts_json_roundtrip(spark, raw_folder, tmp_path):
    df = posts_json.read_posts_json(spark, raw_folder).select(
        "platform", "post_time", "author", "title", "content", "total_reac", "comments_data")
    out = str(tmp_path / "out")
    assert posts_json.write_posts_json(df, out, files=2)
    again = posts_json.read_posts_json(spark, out)
    assert again.count() == 3 and set(r.author for r in again.collect()) == {"a", "b"}


def test_array_sink(spark, tmp_path):
    path = str(tmp_path / "arrays")
    df = spark.createDataFrame([(i, f"text {i} \"中\"", "a b" if i % 3 else None if i % 2 else "x/y") for i in range(100)], "n int, t string, kind string")
    assert posts_json.write_posts_json(df.repartition(5), path)
    names = sorted(f for f in os.listdir(path) if f.endswith(".json"))
    assert len(names) == 5 and not [f for f in os.listdir(path) if f.startswith(".part") and not f.endswith(".crc")]
    found = [r for f in names for r in json.load(open(os.path.join(path, f), encoding="utf-8"))]
    assert sorted(r["n"] for r in found) == list(range(100)) and "中" in open(os.path.join(path, names[0]), encoding="utf-8").read()
    with open(os.path.join(path, "part-99999-left-over.json"), "w") as f:
        f.write("[]")
    assert posts_json.write_posts_json(df.limit(10), path, files=3)  # overwrites all
    left = [r for f in os.listdir(path) if f.endswith(".json") for r in json.load(open(os.path.join(path, f), encoding="utf-8"))]
    assert len(left) == 10 and "part-99999-left-over.json" not in os.listdir(path)
    by = str(tmp_path / "by")
    assert posts_json.write_posts_json(df, by, files=4, partition_by="kind")
    assert {f for f in os.listdir(by) if "=" in f} == {"kind=a b", "kind=x%2Fy", "kind=__HIVE_DEFAULT_PARTITION__"}
    for folder in os.listdir(by):
        if "=" in folder:
            for f in os.listdir(os.path.join(by, folder)):
                if f.endswith(".json"):
                    assert all("kind" not in r for r in json.load(open(os.path.join(by, folder, f), encoding="utf-8")))
    # A failure is reported, and leaves nothing behind.
    broken = df.withColumn("t", F.when(F.col("n") == 50, F.raise_error(F.lit("no"))).otherwise(F.col("t")))
    assert not posts_json.write_posts_json(broken, str(tmp_path / "broken"))
    assert not [f for f in os.listdir(tmp_path / "broken") if f.endswith(".json")] if (tmp_path / "broken").exists() else True


def test_csv_sink_skips_empty_and_reads_back(spark, tmp_path):
    empty = spark.createDataFrame([], "a string")
    assert not tables.write_csv(empty, str(tmp_path / "e"))
    df = spark.createDataFrame([("x,\"y\"\nz", 1)], "t string, n int")
    assert tables.write_csv(df, str(tmp_path / "c"))
    back = tables.read_csv(spark, str(tmp_path / "c"), "t string, n int")
    assert rows(back) == [("x,\"y\"\nz", 1)]


def test_run_ingest_csv_and_tables(spark, raw_folder, tmp_path):
    out = ingest.run(spark, "ptt", raw_folder, str(tmp_path / "o"), output_type="both")
    assert set(out) == {"csv", "tables"}
    csv = tables.read_csv(spark, out["csv"])
    assert sorted(rows(csv, "author", "comment")) == [
        ("a", "這個活動真的很好玩 接著說第二行"), ("a", "這個活動真的很好玩 接著說第二行"), ("b", "去年今日也是一樣好玩")]  # the leading space of a push separates merged lines
    tables.register_platform_views(spark, out["tables"], ["PTT"])
    posts = spark.sql("SELECT post_id, total_reac FROM PTT_posts")
    assert posts.count() == 2                        # the duplicate post is ignored
    cm = spark.sql("SELECT c.comment_id, p.post_id FROM PTT_comments c LEFT JOIN PTT_posts p ON c.post_id = p.post_id")
    assert sorted(r[0] for r in cm.collect()) == [1, 2, 3]   # comments of duplicates appended, dense ids
    assert ingest.run(spark, "plurk", raw_folder, str(tmp_path / "o2")) == {}


def test_run_many_cleans_platform_folders_in_one_job(spark, raw_folder, tmp_path):
    baha = str(tmp_path / "baha")
    _write(baha, "p.json", [{"platform": "Bahamut", "post_time": "2025-03-04 10:00:00", "author": "c",
                             "title": "巴哈", "content": "本文", "total_reac": "3", "comment_count": 2,
                             "comments_data": [{"comment_author": "u3", "comment": "→ 不是接續的留言內容"},
                                               {"comment_author": "u3", "comment": "短"}]}])
    out = ingest.run_many(spark, {"ptt": raw_folder, "baha": baha, "plurk": baha}, str(tmp_path / "m"),
                          output_type="both")
    csv = tables.read_csv(spark, out["csv"])
    got = sorted(rows(csv, ingest.FOLDER_COL, "platform", "author", "comment"))
    assert got == [("baha", "Bahamut", "c", "不是接續的留言內容"),        # "→" is not whitelisted; "短" is too short
                   ("ptt", "PTT", "a", "這個活動真的很好玩 接著說第二行"),
                   ("ptt", "PTT", "a", "這個活動真的很好玩 接著說第二行"),
                   ("ptt", "PTT", "b", "去年今日也是一樣好玩")]
    assert spark.read.parquet(f"{out['tables']}/posts").count() == 3


def test_incremental_ingest_idempotent(spark, raw_folder, tmp_path):
    from threadscope.streaming.incremental import start_ingest, stored_posts
    out, ck = str(tmp_path / "inc"), str(tmp_path / "ck")
    assert stored_posts(spark, out).count() == 0
    start_ingest(spark, raw_folder, out, ck).awaitTermination()
    first = sorted(rows(stored_posts(spark, out), "post_id", "author", "content"))
    n_comments = spark.read.parquet(f"{out}/comments").count()
    assert len(first) == 2 and n_comments == 5          # comments of the duplicate post are appended
    start_ingest(spark, raw_folder, out, ck).awaitTermination()          # a restart with nothing new
    assert sorted(rows(stored_posts(spark, out), "post_id", "author", "content")) == first
    _write(raw_folder, "c.json", [dict(POSTS[1], content="changed"), dict(POSTS[1], author="new")])
    _write(raw_folder, "d.json", [dict(POSTS[1], author="new", content="later in the same batch")])
    start_ingest(spark, raw_folder, out, ck).awaitTermination()
    posts = stored_posts(spark, out)
    assert set(first) < set(rows(posts, "post_id", "author", "content"))   # the first content of an id stays
    assert rows(posts.filter("author = 'new'"), "content", "batch_id") == [(POSTS[1]["content"], 1)]
    comments = rows(spark.read.parquet(f"{out}/comments"), "post_id", "comment")
    assert len(comments) == 8 and {i for i, _ in comments} == {r[0] for r in rows(posts, "post_id")}


def test_posts_follow_each_batch_of_files(spark, tmp_path, monkeypatch):
    """Many batches in one run: the first content of an id stays, whose batch is its own; a batch that is written whole stays too."""
    from threadscope.streaming import incremental
    monkeypatch.setattr(incremental, "MAX_FILES", 1)
    folder, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i in range(4):
        _write(folder, f"{9 - i}.json", [dict(POSTS[1], author=a, content=f"file {i}") for a in ("always", f"from {i // 2}")])
        os.utime(os.path.join(folder, f"{9 - i}.json"), (1e9 + i, 1e9 + i))
    incremental.start_ingest(spark, folder, out, ck).awaitTermination()
    assert sorted(rows(incremental.stored_posts(spark, out), "author", "content", "batch_id")) == [
        ("always", "file 0", 0), ("from 0", "file 0", 0), ("from 1", "file 2", 2)]
    for name in ("3", ".3.crc"):                                   # as if the run had ended before the batch did
        os.remove(os.path.join(ck, "files", "commits", name))
    before = sorted(os.listdir(os.path.join(out, "arrived", "batch_id=3")))
    incremental.start_ingest(spark, folder, out, ck).awaitTermination()
    assert sorted(os.listdir(os.path.join(out, "arrived", "batch_id=3"))) == before
    assert incremental.stored_posts(spark, out).count() == 3


def test_posts_pass_no_python(spark, tmp_path):
    """The contents of stored posts stay in the JVM, and so does the state."""
    from threadscope.streaming import incremental
    (tmp_path / "arrived").mkdir()
    posts = incremental.first_posts(spark.readStream.schema(incremental.ARRIVED).parquet(str(tmp_path / "arrived")))
    assert "Pandas" not in posts._jdf.queryExecution().toString() and posts.schema == incremental.POSTS


def test_array_file_beyond_the_variant_limit(spark, tmp_path):
    """A VARIANT holds 128 MiB; a raw file may hold more."""
    folder = tmp_path / "big"
    folder.mkdir()
    with open(folder / "a.json", "w") as f:
        f.write("[")
        for i in range(140):
            f.write(("," if i else "") + json.dumps({"author": f"a{i}", "content": "x" * (1 << 20)}))
        f.write("]")
    df = posts_json.read_posts_json(spark, str(folder)).select("author", "pos", F.length("content").alias("n"))
    assert sorted(rows(df), key=lambda r: r[1]) == [(f"a{i}", i, 1 << 20) for i in range(140)]


def test_unread_files_are_listed(spark, tmp_path):
    texts = {"ok": ' [ {"a": "]"} , 7, null, {"b": [1, {"c": 2}]}\n] ', "empty": "[]", "cut": '[{"a": 1}', "object": '{"a": 1}',
             "tail": "[] x", "comma": "[{},]", "deep": "[" * 100_000}
    for k, t in texts.items():
        (tmp_path / f"{k}.json").write_text(t)
    assert sorted(rows(posts_json.read_posts_json(spark, str(tmp_path)), "pos")) == [(0,), (3,)]
    bad = {r.file_path.rsplit("/", 1)[1]: r.reason for r in posts_json.unread(spark, str(tmp_path)).collect()}
    assert set(bad) == {"cut.json", "object.json", "tail.json", "comma.json", "deep.json"} and all(bad.values())


OPEN = [{"platform": "PTT", "title": "t", "score": 3, "meta": {"lang": "zh", "deep": {"n": 1.5}}, "tags": ["a", 1], "pos": "own",
         "odd'key": True, "mixed": 1, "comments_data": [{"comment": "c1", "floor": 1, "meta": {"lang": "en"}, "score": "x"}, "no record",
                                                         {"comment": "c2", "by": {"id": 7}}]},
        {"platform": "PTT", "title": "u", "score": None, "mixed": {"a": 1}, "comments_data": []}]


def test_keys_that_nobody_declared_become_columns(spark, tmp_path):
    _write(str(tmp_path / "raw"), "a.json", OPEN)
    raw = posts_json.read_posts_json(spark, str(tmp_path / "raw"), records=True)
    long = posts_json.posts_with_comments(raw)
    got = sorted((r.asDict() for r in long.collect()), key=lambda r: (r["title"], r["comment_pos"] or 0))
    assert [(r["title"], r["comment_pos"], r["comment"]) for r in got] == [("t", 0, "c1"), ("t", 1, None), ("t", 2, "c2"), ("u", None, None)]
    first = got[0]
    assert (first["score"], first["meta.lang"], first["meta.deep.n"], first["tags"], first["_pos"], first["odd'key"], first["mixed"]) == (
        3, "zh", 1.5, '["a",1]', "own", True, "1")
    assert (first["floor"], first["comment.meta.lang"], first["comment.score"], first["by.id"], got[2]["by.id"]) == (1, "en", "x", None, 7)
    assert got[3]["mixed"] == '{"a":1}' and got[3]["score"] is None
    with pytest.raises(ValueError):
        from threadscope.sources.open_fields import discover
        discover(raw, "record", most=3)
    # The ingest job exports them too.
    whole = [dict(p, post_time="2025-03-04", comments_data=[{"comment": "a comment that is long", "floor": 4}]) for p in OPEN]
    _write(str(tmp_path / "baha"), "a.json", whole)
    out = ingest.run(spark, "baha", str(tmp_path / "baha"), str(tmp_path / "o"))
    csv = tables.read_csv(spark, out["csv"])
    assert sorted(rows(csv, "title", "`meta.deep.n`", "floor")) == [("t", "1.5", "4"), ("u", None, "4")]


def test_export_and_views_of_crawled_names(spark, raw_folder, tmp_path):
    """Crawlers write PTT and Bahamut; the views go by the configured folder."""
    baha = str(tmp_path / "baha2")
    _write(baha, "p.json", [{"platform": "Bahamut", "post_time": "2025-03-04", "author": "c", "title": "t", "content": "本文",
                             "total_reac": "3", "comments_data": [{"comment_author": "u", "comment": "這是一則夠長的留言"}]}])
    out = ingest.run_many(spark, {"ptt": raw_folder, "baha": baha}, str(tmp_path / "v"), output_type="both")
    assert not set(tables.read_csv(spark, out["csv"]).columns) & set(ingest.INTERNAL_COLS)
    tables.register_platform_views(spark, out["tables"], ["ptt", "baha"])
    n = {v: spark.table(v).count() for v in ("ptt_posts", "ptt_comments", "baha_posts", "baha_comments")}
    assert n == {"ptt_posts": 2, "ptt_comments": 3, "baha_posts": 1, "baha_comments": 1}
    assert dict(spark.table("baha_posts").dtypes)["total_reac"] == "int"


def test_checkpoint_folder_must_be_shared_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from threadscope import session
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))


def test_keys_are_found_in_one_pass(spark):
    """Texts are read and parsed once for the keys of posts and of comments."""
    from pyspark.sql import types as T
    seen = spark.sparkContext.accumulator(0)

    def count(text):
        seen.add(1)
        return text
    texts = [json.dumps(p) for p in OPEN] + ["[1]", " {}", "7", "null", "{cut", ""]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "file_path string, pos long, value string").coalesce(1)
    raw = posts_json.parse_posts(df.withColumn("value", F.udf(count, T.StringType()).asNondeterministic()("value")), records=True)
    of_posts, of_comments = posts_json.open_keys(raw)
    assert seen.value == len(texts)
    assert {f.name for f in of_posts} == {"score", "meta.lang", "meta.deep.n", "tags", "pos", "odd'key", "mixed"}
    assert {f.name for f in of_comments} == {"floor", "meta.lang", "score", "by.id"}
    assert [r[0] for r in rows(posts_json.parse_posts(df), "pos")] == [0, 1, 3]
