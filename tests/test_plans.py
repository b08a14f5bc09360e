"""Plan shape of every registered query: no cross joins or nested-loop
joins, and the Python steps limited to the known ones."""
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

QUERIES = E.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON_NODES = re.compile(r"\b(BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas)\b")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert not [op for op in FORBIDDEN if op in plan], plan[:3000]


def test_no_row_at_a_time_python(spark):
    """Python steps are Arrow-batched (pandas UDF / mapInPandas), never the
    row-at-a-time BatchEvalPython."""
    for name, fn in QUERIES.items():
        nodes = set(PYTHON_NODES.findall(_plan(fn(spark, SF001))))
        assert "BatchEvalPython" not in nodes, name


def test_joins_of_co_located_tables_shuffle_nothing(spark, tmp_path):
    from threadscope.sources import tables
    posts = spark.createDataFrame([(f"p{i}", "ptt", "t") for i in range(200)], "post_id string, platform string, title string")
    comments = spark.createDataFrame([(i, f"p{i % 250}", "ptt", f"c{i}") for i in range(1000)], "comment_id long, post_id string, platform string, comment string")
    tables.save_co_located(posts, comments, str(tmp_path), "plan_test", 4)
    tables.register_platform_views(spark, None, ["ptt"], "plan_test")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.sql("SELECT c.comment, p.title FROM ptt_comments c LEFT JOIN ptt_posts p ON c.post_id = p.post_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 1000 and joined.filter("title is null").count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE plan_test_posts")
        spark.sql("DROP TABLE plan_test_comments")
