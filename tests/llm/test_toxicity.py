"""Index against brute-force cosines; held-out accuracy on planted words."""
import pickle
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadscope.llm import toxicity as X
from tests.llm.helpers import DOCS, words


def planted(n=900, seed=6):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w, bad = words(rng, 60), rng.random() < 0.2
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(60), rng.choice(["Idiot", "moron.", "scum,", "TRASH"]))
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = planted()
    extra = [(5000, None, None, None, None), (5001, "", "en", "s", 0), (5002, " \n", "en", "s", 0), rows[0],
             (None, rows[1][1], "en", "s", 0), (5003, "idiot moron " * 20_000, "en", "s", 0), (5004, rows[1][1], "xx", "other", 7)]
    docs = spark.createDataFrame([(*r, "x") for r in rows + extra], DOCS + ", score string")
    more = [(None, 1, 1), (3, None, None), labels[5], (77777, 0, 1)]
    table = spark.createDataFrame(labels + more, "doc_id long, quality int, toxic int")
    model = X.fit(docs, table, train=~X.held_out(F.col("id")))
    got = X.score(docs, model).withColumn("held", X.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: y for i, _, y in labels}
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    by_text = {}
    for r in got:  # the text alone decides
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert by_text.setdefault(r.text, r.score) == r.score
        assert not any(i in truth and zlib.crc32(str(i).encode()) % 5 == 0 for i in r.evidence)
    scores = {r.doc_id: r.score for r in got}
    assert scores[5000] == scores[5001] == scores[5002] < 0.5 < scores[5003]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "", "", 1)], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.fit(docs, none)
    assert [r.score for r in X.score(docs, model).collect()] == [0.5]
    assert X.score(docs.limit(0), model).count() == 0


def test_index_is_exact():
    rng = np.random.default_rng(3)
    dense = rng.random((500, 40)) * (rng.random((500, 40)) < 0.1)
    dense[100:200] = dense[100]  # many ties
    row, term = np.nonzero(dense)
    index = X.BlockMaxIndex(500, row, term, dense[row, term], 40)
    for _ in range(200):
        q = rng.random(40) * (rng.random(40) < 0.1)
        t = np.flatnonzero(q)
        found, score = index.nearest(t, q[t], 7)
        truth = dense @ q
        best = sorted((-s, i) for i, s in enumerate(truth) if s > 0)[:7]
        assert np.allclose(score, [-s for s, _ in best])
        assert len(found) == len(best) and np.allclose(truth[found], score)


def test_terms():
    h, r = X.terms(pa.array(["Idiots! idiots", None, "", "ÉCOLE école"]))
    assert len(set(h[r == 0])) == 1 and len(set(h[r == 3])) == 1 and not (r == 1).any()


def test_rare_words_count(spark):
    """Each toxic text is marked by a word that few others have: it has neighbours all the same."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        w, bad = words(rng, 30, 60), i % 4 == 0
        if bad:
            w += [f"slur{i // 4 % 25}x"] * 2
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, DOCS)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.fit(docs, table, train=~X.held_out(F.col("id")))
    assert len(model.vocabulary) >= 80  # all words of the examples
    got = X.score(docs, model).filter(X.held_out(F.col("doc_id"))).collect()
    assert all(len(r.evidence) == 5 for r in got)
    toxic = [r for r in got if r.doc_id % 4 == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in got) - sum(r.predicted for r in toxic) <= 3


def test_pickled_index():
    rng = np.random.default_rng(5)
    dense = np.round(rng.random((300, 90)) * (rng.random((300, 90)) < np.linspace(0.01, 0.5, 90)) * X.UNIT) / X.UNIT
    row, term = np.nonzero(dense)
    index = X.BlockMaxIndex(300, row, term, dense[row, term], 90)
    again = pickle.loads(pickle.dumps(index))
    for q in dense[:40]:
        t = np.flatnonzero(q)
        (f, s), (g, u) = index.nearest(t, q[t], 7), again.nearest(t, q[t], 7)
        truth = dense @ q
        assert f.tolist() == g.tolist() == sorted(np.flatnonzero(truth > 0), key=lambda i: (-truth[i], i))[:7]
        assert np.allclose(s, truth[f]) and (s == u).all()
    assert 0 < index.matrix.shape[1] < 90 and (again.matrix == index.matrix).all() and (again.weight == index.weight).all()


def test_blocks_are_left_out_and_batches_agree():
    rng = np.random.default_rng(7)
    kinds = rng.integers(0, 5, 2000)  # five kinds of texts, each with its own common terms
    dense = np.zeros((2000, 300))
    for i, kind in enumerate(kinds):
        own = np.concatenate([rng.choice(40, 15, replace=False) + 40 * kind, 200 + rng.choice(100, 3, replace=False)])
        dense[i, own] = rng.random(18)
    dense = np.round(dense / np.sqrt((dense ** 2).sum(axis=1))[:, None] * X.UNIT) / X.UNIT
    row, term = np.nonzero(dense)
    index = X.BlockMaxIndex(2000, row, term, dense[row, term], 300)
    texts = 700
    row, term = np.nonzero(dense[:texts])
    text, example, cosine = index.search(row, term, dense[row, term], texts, 6)
    truth = dense[:texts] @ dense.T
    for i in range(texts):
        want = sorted(np.flatnonzero(truth[i] > 0), key=lambda j: (-truth[i, j], j))[:6]
        assert example[text == i].tolist() == want and np.allclose(cosine[text == i], truth[i, want])
    assert index.multiplied < index.met / 2
    assert sorted(index.order) == list(range(2000))


def test_index_takes_little_memory_where_it_is_made():
    """The driver packs the index and pickles it: a few bytes a posting, not several copies of all."""
    rng = np.random.default_rng(8)
    examples, each, terms_n = 2000, 1000, 20_000
    row = np.repeat(np.arange(examples, dtype=np.int32), each)
    term = np.sort(rng.integers(0, terms_n, (examples, each)), axis=1).astype(np.int32).ravel()
    weight = np.round(rng.random(len(row)) * X.UNIT) / X.UNIT
    tracemalloc.start()
    try:
        index = X.BlockMaxIndex(examples, row, term, weight, terms_n)
        held = tracemalloc.get_traced_memory()[0]
        size = len(pickle.dumps(index))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 8 * len(row) and size < 8 * len(row) and peak < 24 * len(row)


def test_index_takes_little_memory_where_it_is_searched():
    rng = np.random.default_rng(8)
    examples, terms_n = 4000, 60_000
    row = np.repeat(np.arange(examples, dtype=np.int32), 200)
    term = np.concatenate([np.sort(rng.choice(terms_n, 200, replace=False)) for _ in range(examples)]).astype(np.int32)
    weight = np.round(rng.random(len(row)) / 16 * X.UNIT).astype(np.int32)
    packed = pickle.dumps(X.BlockMaxIndex(examples, row, term, weight, terms_n))
    texts, longest = 128, 3000  # their terms have 5 million postings
    t = np.concatenate([np.sort(rng.choice(terms_n, longest, replace=False)) for _ in range(texts)])
    r, w = np.repeat(np.arange(texts), longest), np.full(len(t), 1 / 64)
    tracemalloc.start()
    try:
        index = pickle.loads(packed)
        index._build()
        built = tracemalloc.get_traced_memory()[1]
        found = index.search(r, t, w, texts, 7)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found[0]) == texts * 7 and built < 24 * len(row) and peak < 80 * len(row)
    dense = np.zeros((examples, terms_n), np.float32)
    dense[row, term] = weight / X.UNIT
    sums = dense[:, t[r == 5]].astype(np.float64).sum(axis=1) / 64
    assert np.allclose(found[2][found[0] == 5], np.sort(sums)[::-1][:7], atol=1e-6)


def test_texts_are_sent_to_python_once(spark):
    rows, labels = planted(200)
    docs = spark.createDataFrame(rows, DOCS)
    model = X.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scored = X.score(docs, model)
    assert "_source" not in scored._jdf.queryExecution().toString()
    raw = X.score(docs.withColumn("text", F.col("text").cast("binary")), model)  # any other type is cast
    assert sorted(scored.select("doc_id", "score").collect()) == sorted(raw.select("doc_id", "score").collect())
