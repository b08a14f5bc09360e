"""The shards of a small table."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import DOCS, corpus
from threadscope.llm import sharding as S
from threadscope.llm.common import scratch, spread_copies


@pytest.mark.parametrize("shards", [1, 7, 200])
def test_law(spark, shards):
    rows = corpus(60)
    df = spark.createDataFrame([(*r, {"a": 1}, 5) for r in rows], DOCS + ", extra map<string,int>, slot int")
    got = S.shuffle_shards(df, shards=shards, bucket_bytes=3000).collect()
    assert Counter(r[:5] for r in got) == Counter(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_reruns_agree_and_order_is_mixed(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    deal = lambda d: {r.doc_id: (r.shard, r.slot) for r in S.shuffle_shards(d, bucket_bytes=2000).collect()}
    a = deal(df)
    assert a == deal(df.repartition(7).sortWithinPartitions("text"))
    place = np.array([a[i][0] * 1000 + a[i][1] for i in range(4000)])
    assert abs(np.corrcoef(place, np.arange(4000))[0, 1]) < 0.06


def test_empty_and_written(spark):
    df = spark.createDataFrame(corpus(10), DOCS)
    assert S.shuffle_shards(df.limit(0)).count() == 0
    path = scratch(spark, "shards")
    S.write_shards(S.shuffle_shards(df, shards=3), path)
    assert spark.read.parquet(path).count() == df.count()


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(S.fisher_yates(3, 1, i)) for i in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400


def test_settings_do_not_matter(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(tuple(r) for r in S.shuffle_shards(df.repartition(int(n))).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_very_many_equal_rows_are_spread(spark):
    rows = spark.range(30_000).selectExpr("CASE WHEN id < 20000 THEN 7 ELSE id END AS doc_id", "CASE WHEN id < 20000 THEN 'same' END AS text")
    spread = spread_copies(rows, "nth", 500)
    counts = {tuple(r) for r in spread.filter("doc_id = 7").groupBy("nth").count().collect()}
    assert counts == {(i, 500) for i in range(40)}
    assert Counter(spread.drop("nth").collect()) == Counter(rows.collect())
    got = S.shuffle_shards(rows, shards=4).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in rows.collect())
    same = Counter(r.shard for r in got if r.doc_id == 7)
    assert min(same.values()) > 3000  # blocks of 1024 equal rows in each of the 4 shards


def test_query_columns(spark, tmp_path):
    from threadscope.llm import queries as Q
    rows = corpus(40)
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = Q.op10_sharding(spark, str(tmp_path)).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)} and {r.shard for r in got} == set(range(24))
