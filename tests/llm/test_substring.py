"""Removal of repeated windows against a dictionary of all windows."""
import re

import pytest

from tests.llm.helpers import DOCS, corpus
from threadscope.llm import substring as S


def brute(rows, length):
    first, words = {}, [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    for r, w in zip(rows, words, strict=True):
        for i in range(len(w) - length + 1):
            key, id_ = tuple(w[i:i + length]), float("inf") if r[0] is None else r[0]
            first[key] = min(first.get(key, id_), id_)
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < (float("inf") if r[0] is None else r[0]):
                gone.update(range(i, i + length))
        out.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [5, 13, 40])
def test_against_brute_force(spark, length):
    rows = corpus(80, seed=length)
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", chunk int")
    got = S.remove_repeats(df, length=length, joined=True, chunk_bytes=4000, bucket_bytes=4000)
    assert got.columns == [*df.columns, "n_words", "n_removed"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()), key=str) == brute(rows, length)


def test_text_is_cut_in_place(spark):
    a = " ".join(f"a{i}" for i in range(13))
    rows = [(1, f"x\n{a}\ty", "", "", 0), (2, f"p  q\n{a}\n r\t", "", "", 0), (3, f"{a}\n", "", "", 0), (4, None, "", "", 0)]
    got = {r.doc_id: r.text for r in S.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: rows[0][1], 2: "p  q\nr\t", 3: "", 4: None}


def test_empty(spark):
    assert S.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_levels():
    assert S.levels(13) == [7, 13] and S.levels(50) == [7, 13, 25, 50] and S.levels(5) == [5]
