"""Model data work (survey §2.M): splits, scoring, probabilities, metrics.

The reference fine-tunes a transformer on one machine; that loop is not
data work and is re-aimed as a distributed ``pyspark.ml`` pipeline
(tokenize -> hashed term frequencies of the whole text -> IDF ->
multinomial logistic regression, the epoch of the lowest evaluation loss). Everything around it — splits, softmax / argmax, the confidence
string, metrics, confusion matrix, error analysis — is native and has SQL
oracles.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.operators import relational as R

log = logging.getLogger(__name__)

# The three sentiment classes and their display names.
CLASSES = [0, 1, 2]          # 0 negative, 1 neutral, 2 positive
CLASS_NAMES = ["負", "中", "正"]


# M1 / M2 -----------------------------------------------------------------

def split_key(id_col: str, seed: int) -> Column:
    """Per-row pseudo-random order: md5 of ``id || seed`` (hex string)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, label_col: str = "label", id_col: str = "doc_id",
                     test_size: float = 0.2, seed: int = 42, bucket_hex: int = 4,
                     split_col: str = "split") -> DataFrame:
    """Exact stratified split: per label the ``round(test_size * n)`` rows
    with the smallest ``md5(id || seed)`` go to ``test``, the rest to ``train``.

    A label is one group holding a large share of the rows, so no window
    runs over a whole label. Rows are bucketed by the first ``bucket_hex``
    hex digits of the key; per-(label, bucket) counts (at most
    labels × 16^bucket_hex rows) give each bucket the number of smaller
    keys of its label, and rows are ranked only inside their bucket.
    """
    key = split_key(id_col, seed)
    d = df.withColumn("_k", key).withColumn("_b", F.substring("_k", 1, bucket_hex))
    counts = d.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wl = Window.partitionBy(label_col)
    wb = wl.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.withColumn("_want", F.round(F.lit(test_size) * F.sum("_c").over(wl)).cast("bigint"))
              .withColumn("_before", F.coalesce(F.sum("_c").over(wb), F.lit(0)))
              .select(label_col, "_b", "_want", "_before"))
    # A missing label is a stratum of its own: its rows are split, not dropped.
    counts = counts.withColumnRenamed(label_col, "_label").withColumnRenamed("_b", "_bucket")
    d = d.join(counts, F.col(label_col).eqNullSafe(F.col("_label")) & (F.col("_b") == F.col("_bucket")), "inner")
    wr = Window.partitionBy(label_col, "_b").orderBy("_k", id_col)
    d = d.withColumn(split_col, F.when(F.col("_before") + F.row_number().over(wr) <= F.col("_want"), "test")
                     .otherwise("train"))
    return d.select(*df.columns, split_col)


def split_real_generated(df: DataFrame, label_col: str = "label", id_col: str = "doc_id",
                         flag_col: str = "is_generated", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Test rows only from real rows (flag ``'F'``), stratified; train = the
    other real rows plus every generated row (``'T'``), in a seeded shuffle."""
    real = df.filter(F.col(flag_col) == "F")
    gen = df.filter(F.col(flag_col) == "T").withColumn("split", F.lit("train"))
    both = stratified_split(real, label_col, id_col, test_size, seed).unionByName(gen)
    return R.seeded_shuffle(both, [id_col], seed)


# M6 / M7 / M8 ------------------------------------------------------------

def softmax(logits: Column) -> Column:
    m = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(values: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def percent(p: Column) -> Column:
    """``{p:.2%}`` for a probability: p × 100 to two decimals, rounded on
    the exact binary value as Python does (``format_number`` uses Java's
    DecimalFormat, half-even on the exact value; it would add thousands
    separators only from 1000 %, which a probability never reaches)."""
    return F.concat(F.format_number(p * 100, 2), F.lit("%"))


def confidence_string(probs: Column, names: Sequence[str] | None = CLASS_NAMES) -> Column:
    parts = []
    for i in range(len(CLASSES)):
        v = percent(F.element_at(probs, i + 1))
        parts.append(F.concat(F.lit(f"{names[i]}:"), v) if names else v)
    return F.concat_ws(", ", *parts)


# M3 / M4 / M5 / M14 --------------------------------------------------------

#: Private name of the model's text column, so that no input column is overwritten.
MODEL_TEXT = "_model_text"


def build_pipeline(text_col: str = MODEL_TEXT, label_col: str = "label", num_features: int = 1 << 16,
                   reg_param: float = 0.01, max_iter: int = 30):
    """Tokenize with the keyword tokenizer, hash, weight by IDF, multinomial
    logistic regression (``reg_param`` plays the role of weight decay). All
    tokens count: the reference's 128 are its network's input length, which a
    bag of words does not have."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    from threadscope.operators.keywords import token_pattern
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=token_pattern(), gaps=False,
                         toLowercase=False)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    lr = LogisticRegression(featuresCol="_features", labelCol=label_col, family="multinomial",
                            regParam=reg_param, maxIter=max_iter, rawPredictionCol="_raw",
                            probabilityCol="_prob", predictionCol="_pred")
    return Pipeline(stages=[tok, tf, idf, lr]), lr


def validation_side(data: DataFrame, label_col: str, key: Column, share: float) -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) of ``data``: by a hash ``key`` of each
    row, so that copies go together and neither partitioning nor cores matter.

    Every label has rows on both sides: one whose hashes all fall on one side
    gives its smallest or largest hash to the other. Copies are alike, so the
    rows of a label that are all copies of one text are on both sides. One row
    a label comes to the driver."""
    data = data.withColumn("_key", key)
    valid = F.pmod(F.col("_key"), F.lit(1000)) < int(share * 1000)
    sides = data.groupBy(label_col).agg(F.min("_key").alias("low"), F.max("_key").alias("high"),
                                        F.sum(valid.cast("long")).alias("valid"), F.count(F.lit(1)).alias("n")).collect()
    train = ~valid
    for r in sides:
        mine = F.col(label_col) == r[label_col]
        if r.low == r.high:
            valid, train = valid | mine, train | mine
        elif r.valid in (0, r.n):
            moved = mine & (F.col("_key") == (r.low if r.valid == 0 else r.high))
            valid, train = (valid | moved, train & ~moved) if r.valid == 0 else (valid & ~moved, train | moved)
    return data.filter(train).drop("_key"), data.filter(valid).drop("_key")


def train_sentiment(train: DataFrame, text_col: str = "text", label_col: str = "label", evaluation: DataFrame | None = None,
                    epochs: int = 6, iterations: int = 5, patience: int = 2, reg_param: float = 0.01, seed: int = 42,
                    valid_share: float = 0.2):
    """Fit the pipeline in epochs and keep that of the lowest evaluation loss, as
    the reference does; ``patience`` epochs without a lower one end it.

    The evaluation loss is the log loss over ``evaluation`` (rows like those of
    ``train``); without it, over validation rows that are taken from ``train``
    (``validation_side``). The optimiser cannot be continued from outside, but
    its path does not depend on where it ends: epoch ``n`` is the state after
    ``n * iterations`` steps from the start. The feature stages are fitted once,
    over whole texts of the training rows. The returned model has ``eval_loss``
    and ``best_epoch``, and ``log``: (epoch, loss, eval_loss) after each epoch,
    and a last entry for the run as a whole, without losses.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    pipe, lr = build_pipeline(MODEL_TEXT, label_col, reg_param=reg_param)
    # Every partition sends a gradient of all weights at every step, so there are no more of them than cores.
    cores = train.sparkSession.sparkContext.defaultParallelism

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.coalesce(F.col(text_col), F.lit("")).alias(MODEL_TEXT), F.col(label_col).cast("double").alias(label_col)) \
            .filter(F.col(label_col).isNotNull()).coalesce(cores)

    data = rows(train).persist()
    if evaluation is None:
        used, valid = validation_side(data, label_col, F.xxhash64(MODEL_TEXT, label_col, F.lit(seed)), valid_share)
    else:
        used, valid = data, rows(evaluation)
    features = Pipeline(stages=pipe.getStages()[:-1]).fit(used)
    used, valid = (features.transform(d).select("_features", label_col).persist() for d in (used, valid))
    ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="_pred", probabilityCol="_prob", metricName="logLoss")
    try:
        if valid.isEmpty():
            log.warning("no evaluation rows: the last epoch is kept")
        best, best_epoch, history = None, 0, []
        for epoch in range(1, epochs + 1):
            model = lr.copy({lr.maxIter: epoch * iterations}).fit(used)
            steps = list(model.summary.objectiveHistory)
            loss = float(ev.evaluate(model.transform(valid))) if not valid.isEmpty() else None
            history.append((float(epoch), float(steps[-1]), loss))
            lowest = min((h[2] for h in history[:-1] if h[2] is not None), default=None)
            if loss is None or lowest is None or loss < lowest:
                best, best_epoch = model, epoch
            if epoch - best_epoch >= patience or len(steps) <= epoch * iterations:  # no better, or converged
                break
    finally:
        for d in (used, valid, data):
            d.unpersist()
    model = PipelineModel(stages=features.stages + [best])
    model.eval_loss, model.best_epoch = history[best_epoch - 1][2], best_epoch
    model.log = [*history, (history[-1][0], None, None)]
    return model


def score_comments(model, df: DataFrame, text_col: str = "comment", model_text_col: str = MODEL_TEXT) -> DataFrame:
    """Add ``predict_label`` and ``confidence_matrix``; all input columns
    are kept, a NULL text is scored as ``""``."""
    from pyspark.ml.functions import vector_to_array
    data = df.withColumn(model_text_col, F.coalesce(F.col(text_col), F.lit("")))
    out = model.transform(data)
    probs = vector_to_array(F.col("_prob"))
    keep = [c for c in df.columns]
    return out.select(*keep, argmax(probs).alias("predict_label"),
                      confidence_string(probs).alias("confidence_matrix"))


def score_external(df: DataFrame, make_predict: Callable, text_col: str = "comment", batch_size: int = 32,
                   names: Sequence[str] | None = CLASS_NAMES) -> DataFrame:
    """M5 with a network that is not Spark's: add ``logits``, ``predict_label`` and
    ``confidence_matrix``; all input columns are kept, a NULL text is scored as ``""``.

    ``make_predict`` loads the model and returns a function from an array of
    texts to an array of one row of logits each; it is called once a Python
    worker, and the function with ``batch_size`` texts at most. The
    probabilities are computed by Spark."""
    from pyspark.ml.functions import predict_batch_udf
    predict = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    own = [c for c in df.columns if c not in ("logits", "predict_label", "confidence_matrix")]
    out = df.withColumn("_logits", predict(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    out = out.withColumn("_probs", softmax(F.col("_logits")))
    return out.select(*own, F.col("_logits").alias("logits"), argmax(F.col("_probs")).alias("predict_label"),
                      confidence_string(F.col("_probs"), names).alias("confidence_matrix"))


def loss_history(log: DataFrame, loss_col: str = "loss", eval_col: str = "eval_loss") -> DataFrame:
    """Training-log rows with a truthy train or eval loss (0 and NULL are falsy)."""
    truthy = lambda c: F.coalesce(F.col(c) != 0, F.lit(False))
    cond = truthy(loss_col)
    if eval_col in log.columns:
        cond = cond | truthy(eval_col)
    return log.filter(cond)


def training_log(model, spark) -> DataFrame:
    """The log of ``train_sentiment`` as a DataFrame, a row an entry."""
    return spark.createDataFrame(model.log, "epoch double, loss double, eval_loss double")


# M9 - M13 ----------------------------------------------------------------

def metrics(df: DataFrame, true_col: str = "true_label", pred_col: str = "test_label") -> DataFrame:
    """Accuracy and macro precision / recall / F1 over the union of labels
    (0 where undefined). One pass over the data (a (true, pred) count),
    the rest runs on a table of at most classes² rows."""
    pairs = df.groupBy(true_col, pred_col).agg(F.count(F.lit(1)).alias("n"))
    per_true = pairs.groupBy(F.col(true_col).alias("c")).agg(
        F.sum("n").alias("n_true"), F.sum(F.when(F.col(true_col) == F.col(pred_col), F.col("n"))).alias("tp"))
    per_pred = pairs.groupBy(F.col(pred_col).alias("c")).agg(F.sum("n").alias("n_pred"))
    per = per_true.join(per_pred, "c", "full").na.fill(0, ["n_true", "tp", "n_pred"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(F.lit(0.0))
    per = per.withColumn("p", prec).withColumn("r", rec)
    per = per.withColumn("f", F.when(F.col("p") + F.col("r") > 0,
                                     2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(F.lit(0.0)))
    return per.agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        F.avg("p").alias("precision"), F.avg("r").alias("recall"), F.avg("f").alias("f1"))


def confusion_matrix(df: DataFrame, true_col: str = "true_label", pred_col: str = "test_label",
                     classes: Sequence[int] = CLASSES) -> DataFrame:
    """Rows = every label seen as truth or prediction, columns ``pred_<c>`` for
    each of ``classes`` and each other label that is predicted (labels are
    few: one row each comes to the driver); missing cells are 0."""
    seen = [r[0] for r in df.select(pred_col).distinct().collect()]
    classes = [*classes, *sorted(c for c in seen if c is not None and c not in classes)]
    labels = df.select(F.col(true_col).alias("_l")).union(df.select(F.col(pred_col).alias("_l"))).distinct()
    counts = df.groupBy(true_col).pivot(pred_col, list(classes)).agg(F.count(F.lit(1)))
    for c in classes:
        counts = counts.withColumnRenamed(str(c), f"pred_{c}")
    out = labels.withColumnRenamed("_l", true_col).join(counts, true_col, "left")
    return out.na.fill(0, [f"pred_{c}" for c in classes])


def mispredictions(df: DataFrame, true_col: str = "true_label", pred_col: str = "test_label") -> DataFrame:
    return df.filter(R.ne_pandas(F.col(pred_col), F.col(true_col)))


def class_misses(df: DataFrame, cls: int = 1, true_col: str = "true_label", pred_col: str = "test_label") -> DataFrame:
    """Rows of class ``cls`` predicted as something else (neutral by default)."""
    return df.filter((F.col(true_col) == cls) & R.ne_pandas(F.col(pred_col), F.lit(cls)))


def label_ratio(scored: DataFrame, label_col: str = "predict_label") -> DataFrame:
    return R.value_counts(scored, label_col)


def export_class(scored: DataFrame, cls: int, label_col: str = "predict_label") -> DataFrame:
    """The rows of one predicted class (written with the CSV sink)."""
    return scored.filter(F.col(label_col) == cls)
