"""M1/M2 against a pandas brute force on a skewed fixture, M5 scoring
completeness and consistency, M8 rounding, M14 loss history."""
import hashlib
import math
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, rows
from threadscope.operators import model as M
from threadscope.sources import fixtures as fx


def _brute_split(pdf: pd.DataFrame, test_size=0.2, seed=42) -> dict:
    out = {}
    for _, g in pdf.groupby("label"):
        keys = sorted((hashlib.md5(f"{i}{seed}".encode()).hexdigest(), i) for i in g["doc_id"])
        n_test = math.floor(test_size * len(keys) + 0.5)        # Spark round: half up
        for rank, (_, i) in enumerate(keys):
            out[i] = "test" if rank < n_test else "train"
    return out


def test_stratified_split_exact_on_skewed_labels(spark):
    # One label holds 90 % of the rows; tiny buckets force many bucket boundaries.
    data = [(i, 0 if i % 10 else (1 if i % 20 else 2)) for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, label int")
    got = dict(rows(M.stratified_split(df, "label", "doc_id", bucket_hex=2), "doc_id", "split"))
    assert got == _brute_split(pd.DataFrame(data, columns=["doc_id", "label"]))


def test_split_real_generated(spark):
    data = [(i, i % 3, "T" if i % 4 == 3 else "F") for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, label int, is_generated string")
    out = M.split_real_generated(df)
    assert out.count() == 400
    assert out.filter((F.col("is_generated") == "T") & (F.col("split") == "test")).count() == 0
    real = pd.DataFrame([d for d in data if d[2] == "F"], columns=["doc_id", "label", "is_generated"])
    want = _brute_split(real)
    got = dict(rows(out.filter(F.col("is_generated") == "F"), "doc_id", "split"))
    assert got == want


def test_confidence_string_rounding(spark):
    df = spark.createDataFrame([([0.125, 0.5, 0.375],), ([0.00125, 0.99, 0.00875],)], "p array<double>")
    got = [r[0] for r in df.select(M.confidence_string(F.col("p"))).collect()]
    assert got == ["負:12.50%, 中:50.00%, 正:37.50%", "負:0.12%, 中:99.00%, 正:0.88%"]
    assert [f"{x:.2%}" for x in (0.00125, 0.00875)] == ["0.12%", "0.88%"]   # Python agrees


def test_train_score_and_loss_history(spark):
    labelled = fx.fx_labelled(spark, SF001)
    split = M.stratified_split(labelled, "label", "doc_id")
    model = M.train_sentiment(split.filter(F.col("split") == "train").select(
        F.col("comment").alias("text"), "label"))
    docs = fx.fx_posts(spark, SF001).select("doc_id", "platform", F.col("content").alias("comment"))
    scored = M.score_comments(model, docs).collect()
    assert len(scored) == docs.count() and len({r.doc_id for r in scored}) == len(scored)
    for r in scored:
        assert r.predict_label in (0, 1, 2)
        pct = [float(x) for x in re.findall(r":([0-9.]+)%", r.confidence_matrix)]
        assert len(pct) == 3 and abs(sum(pct) - 100) < 0.05
        assert pct[r.predict_label] == max(pct)
    hist = M.loss_history(M.training_log(model, spark)).collect()
    assert len(hist) >= 2 and hist[-1].loss <= hist[0].loss
    assert len(hist) == M.training_log(model, spark).count() - 1  # the entry without losses goes
    assert all(r.loss and r.eval_loss for r in hist) and min(r.eval_loss for r in hist) == hist[model.best_epoch - 1].eval_loss == model.eval_loss


def test_percent_matches_python_formatting(spark):
    import random
    random.seed(11)
    vals = [random.random() for _ in range(5000)] + [k / 100000 for k in range(0, 100001, 37)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "p double").select(M.percent(F.col("p"))).collect()]
    assert got == [f"{v:.2%}" for v in vals]


def test_split_keeps_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(60)], "doc_id long, label int")
    got = M.stratified_split(df, "label", "doc_id").collect()
    assert sorted(r.doc_id for r in got) == list(range(60))
    assert sum(r.split == "test" for r in got if r.label is None) == 4


def test_confusion_matrix_keeps_other_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 3), (3, 3)], "true_label int, test_label int")
    got = {r.true_label: r.asDict() for r in M.confusion_matrix(df).collect()}
    assert got[0]["pred_0"] == 1 and got[0]["pred_3"] == 1 and got[3]["pred_3"] == 1


def test_whole_texts_count_and_input_text_stays(spark):
    rows = [(i, "filler " * 300 + ("bad", "plain", "good")[i % 3], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    model = M.train_sentiment(df)
    got = M.score_comments(model, df.withColumn("comment", F.col("text")).withColumn("text", F.lit("own"))).collect()
    assert all(r.predict_label == r.label and r.text == "own" for r in got)
    assert model.eval_loss is not None
    assert M.training_log(model, spark).filter("eval_loss is not null").count() == len(model.log) - 1
    again = M.train_sentiment(df.repartition(7))
    assert again.eval_loss == pytest.approx(model.eval_loss, rel=1e-6)


def test_validation_rows_of_every_label(spark):
    rows = [(f"t{i}", i % 2) for i in range(40)] + [("only", 2)] * 3 + [("a", 3), ("b", 3), ("b", 3)]
    for seed in range(6):
        df = spark.createDataFrame(rows, "text string, label int")
        train, valid = M.validation_side(df, "label", F.xxhash64("text", F.lit(seed)), 0.2)
        train, valid = [tuple(r) for r in train.collect()], [tuple(r) for r in valid.collect()]
        assert {y for _, y in train} == {y for _, y in valid} == {0, 1, 2, 3}
        assert set(train) & set(valid) == {("only", 2)}  # copies of one text are alike
        assert sorted(train + valid) == sorted(rows + [("only", 2)] * 3)


def test_evaluation_rows_choose_the_epoch(spark):
    train = spark.createDataFrame([(f"w{i % 7} w{i % 5}", i % 2) for i in range(60)], "text string, label int")
    other = spark.createDataFrame([(f"w{i % 7}", (i + 1) % 2) for i in range(20)], "text string, label int")
    model = M.train_sentiment(train, evaluation=other, epochs=5, iterations=1, patience=1)
    losses = [r[2] for r in model.log[:-1]]
    assert model.eval_loss == min(losses) and model.log[-1][1:] == (None, None)
    assert len(losses) <= model.best_epoch + 1
    none = M.train_sentiment(train, evaluation=other.limit(0), epochs=2, iterations=2)
    assert none.eval_loss is None and none.best_epoch == len(none.log) - 1


def test_external_network_is_loaded_once_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid
        import numpy as np
        open(os.path.join(folder, f"load-{uuid.uuid4().hex}"), "w").close()

        def predict(texts):
            assert len(texts) <= 32
            return np.array([[len(t), 2.0, t.count("z")] for t in texts], float)
        return predict

    rows = [(i, "z" * (i % 7) if i % 11 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, comment string, logits int").coalesce(1)
    got = {r.id: r for r in M.score_external(df, load).collect()}
    for i, text, _ in rows:
        n = float(len(text or ""))
        assert got[i].logits == [n, 2.0, n] and got[i].predict_label == (0 if n >= 2 else 1)
        assert got[i].confidence_matrix.startswith("負:")
    assert len(list(tmp_path.iterdir())) == 1


def test_training_partitions_follow_the_cores(spark, monkeypatch):
    """every partition of the training rows sent a gradient of all weights at each step."""
    from pyspark.ml.classification import LogisticRegression
    seen, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, d, *a: seen.append(d.rdd.getNumPartitions()) or fit(self, d, *a))
    train = spark.createDataFrame([(f"word{i % 3} other{i % 7}", i % 3) for i in range(300)], "text string, label int").repartition(40)
    M.train_sentiment(train, epochs=1, iterations=1)
    assert seen and max(seen) <= spark.sparkContext.defaultParallelism
