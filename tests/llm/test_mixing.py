"""Targets, rounding and the mix of a small table."""
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tests.llm.helpers import DOCS, corpus
from threadscope.llm import mixing as M


def targets(sizes, factor=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, out, open_ = factor * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("how,near", [({}, 0.002), ({"block_docs": 16, "fan_in": 3, "reserve": 4}, 0.01)])
def test_mix(spark, how, near):
    rows = [r for r in corpus(600) if not how or len(r[1] or "") < 5000]  # in small blocks, no text of a third of its source
    df = spark.createDataFrame([(*r, 9) for r in rows], DOCS + ", copies int")
    got = [r.asDict() for r in M.mix_sources(df, **how).collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["text"], r["source"], r["size"]) for r in got) == Counter(
        (r[0], r[1], r[3], size(r[1])) for r in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
        assert 0 <= r["copies"] <= 2 and (r["size"] or not r["copies"])
    want = targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
    for s in sizes:
        assert sizes[s] < 100 or abs(taken[s] - want[s]) <= near * want[s], s
    key = lambda r: str(sorted(r.items(), key=str))
    again = [r.asDict() for r in M.mix_sources(df.repartition(5), **how).collect()]
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_small_sources_are_paired_too(monkeypatch):
    rng = np.random.default_rng(3)
    paired = []
    plain = M.pivot
    monkeypatch.setattr(M, "pivot", lambda size, share, draws: paired.append(int(((share > 0) & (share < 1)).sum())) or plain(size, share, draws))
    for _ in range(20):  # sources of 50 documents
        group = pd.DataFrame({"key": rng.integers(0, 1 << 60, 50), "size": rng.integers(100, 250, 50), "share": np.full(50, 0.3), "blocks": 1, "open": True})
        out = M.round_block(group, 0, M.RESERVE, 11)
        assert not out["open"].any() and abs((out["share"] - 0.3) @ out["size"]) <= 250
    assert len(paired) == 20 and min(paired) >= 50 - 2 * M.RESERVE


def test_clashing_names_and_other_sources_do_not_matter(spark):
    rows = [(i, " ".join("w" * (i % 9 + 1)), f"s{i % 3}", 5, 6) for i in range(300)]
    schema = "doc_id long, text string, source string, sum int, rows int"
    got = M.mix_sources(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "source", "sum", "rows", "size", "source_size", "target", "copies"]
    assert all(r["sum"] == 5 and r["rows"] == 6 for r in got.collect())


def test_query_columns(spark, tmp_path):
    """Everything of the query but the draw, against plain sums."""
    from threadscope.llm import queries as Q
    rows = corpus(300)
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = Q.op3_mixing(spark, str(tmp_path)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = targets(sizes)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == Counter(
        (r[0], size(r[1]), sizes[r[3]], round(want[r[3]], 6)) for r in rows)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], DOCS)
    assert M.mix_sources(df).count() == 0
    only = spark.createDataFrame([(1, None, None, None, None), (2, " ", "en", "a", 1)], DOCS)
    assert [(r.copies, r.target) for r in M.mix_sources(only).collect()] == [(0, 0.0), (0, 0.0)]


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 500, 40).astype(float)
    share = rng.random(40)
    total = np.zeros(40)
    for _ in range(4000):
        out = M.pivot(size, share, rng.random(40))
        assert abs((out - share) @ size) < 1e-6
        assert ((out > 0) & (out < 1)).sum() <= 1
        total += out
    assert np.abs(total / 4000 - share).max() < 0.05
    assert set(np.unique(M.settle(size, share, rng.random(40)))) <= {0.0, 1.0}
