"""Classifiers on assembled features: training, scoring, evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from millrace.functions import numeric
from millrace.operators.skew import ROWS_PER_TASK, running
from millrace.session import stored

MODELS = ("lr", "lr_plain", "rf", "gbt")


def keep_columns(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    return df.select(label, *dict.fromkeys(features))


def complete_rows(df: DataFrame, label: str, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Label and features as doubles, with the ``keep`` columns, of the rows
    without nulls."""
    cols = [label, *dict.fromkeys(features)]
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).na.drop()


def estimator(kind: str, label: str, max_iter: int = 10, trees: int = 10, seed: int = 42, **params):
    """``lr``: elastic net 0.3/0.8; ``lr_plain``: no penalty; ``rf``; ``gbt``."""
    common = {"featuresCol": "features", "labelCol": label}
    if kind == "lr":
        return LogisticRegression(**{"maxIter": max_iter, "regParam": 0.3, "elasticNetParam": 0.8, **common, **params})
    if kind == "lr_plain":
        return LogisticRegression(**{"maxIter": max_iter, **common, **params})
    if kind == "rf":
        return RandomForestClassifier(**{"numTrees": trees, "seed": seed, **common, **params})
    if kind == "gbt":
        return GBTClassifier(**{"maxIter": max_iter, "seed": seed, **common, **params})
    raise ValueError(f"unknown model {kind!r}")


def portioned(train: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Label and features, dealt out so that a part holds about
    ``ROWS_PER_TASK`` rows.

    MLlib turns each part into objects that a task holds and, at every pass,
    reads whole; those of a split of well packed files are a hundred times its
    size. Rows that lie in enough parts stay where they are.
    """
    parts = -(-train.count() // ROWS_PER_TASK)
    columns = train.select(*[F.col(f"`{c}`") for c in dict.fromkeys([label, *features])])
    return columns if train.rdd.getNumPartitions() >= parts else columns.repartition(parts)


@contextmanager
def fitting(train: DataFrame, label: str, features: Sequence[str]) -> Iterator[Callable[..., PipelineModel]]:
    """``fit(kind, **params)`` for any number of models on the same rows.

    MLlib passes several times over its input before it holds it in a form of
    its own, and takes it up once more for a model's summary. Meanwhile the
    rows lie on the executors' disks: they are dealt once for all models, and
    the memory is left to MLlib.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    rows = portioned(train, label, features).persist(StorageLevel.DISK_ONLY)
    try:
        yield lambda kind, **params: Pipeline(stages=[assembler, estimator(kind, label, **params)]).fit(rows)
    finally:
        rows.unpersist()


def fit(train: DataFrame, label: str, features: Sequence[str], kind: str, **params) -> PipelineModel:
    """Assembler and classifier as one model that can be saved and reloaded."""
    with fitting(train, label, features) as fitted:
        return fitted(kind, **params)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Batch scoring: the rows with probability of class 1 and prediction."""
    from pyspark.ml.functions import vector_to_array

    return (
        model.transform(rows)
        .withColumn("p1", F.get(vector_to_array("probability"), F.lit(1)))
        .drop("features", "rawPrediction", "probability")
    )


def score_counts(scored: DataFrame, label: str, score: str = "p1", prediction: str = "prediction") -> DataFrame:
    """``(score, predicted, pos, neg)``: rows of each class per different
    score and prediction. All metrics below follow from it."""
    y = (F.col(label) == 1).cast("long")
    predicted = F.col(prediction) == 1 if prediction in scored.columns else F.lit(None).cast("boolean")
    return scored.groupBy(F.col(score).alias("score"), predicted.alias("predicted")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def _confusion(counts: DataFrame) -> DataFrame:
    """Metrics for class 1 from ``(predicted, pos, neg)``."""
    p, total = F.col("predicted"), lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = counts.agg(
        total(F.col("pos") + F.col("neg")).alias("rows"),
        total("pos").alias("positives"),
        total(F.when(p, F.col("pos"))).alias("tp"),
        total(F.when(~p, F.col("neg"))).alias("tn"),
        total(F.when(p, F.col("neg"))).alias("fp"),
        total(F.when(~p, F.col("pos"))).alias("fn"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return sums.select(
        "rows",
        numeric.ratio(F.col("positives"), F.col("rows")).alias("positive_rate"),
        numeric.ratio(tp + tn, F.col("rows")).alias("accuracy"),
        numeric.ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        numeric.ratio(tp, tp + fp).alias("precision"),
        numeric.ratio(tp, tp + fn).alias("recall"),
        numeric.ratio(fp, fp + tn).alias("false_positive_rate"),
        numeric.ratio(tp, tp + fn).alias("true_positive_rate"),
    )


def confusion_metrics(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row of metrics for class 1, from four conditional counts."""
    y = (F.col(label) == 1).cast("long")
    return _confusion(predictions.groupBy((F.col(prediction) == 1).alias("predicted")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


def _thresholds(counts: DataFrame) -> DataFrame:
    """``(score, pos, neg, tp, fp)`` per different score: rows with that
    score, and rows with at least that score, by class."""
    per_score = counts.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return running(per_score, [F.desc("score")], {"tp": "pos", "fp": "neg"})


def _ranking(counts: DataFrame) -> DataFrame:
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    here = tp / (tp + fp)
    before = F.when(tp + fp == pos + neg, here).otherwise(F.try_divide(tp - pos, tp - pos + fp - neg))
    sums = _thresholds(counts).agg(
        F.sum(neg * (2 * tp - pos) / 2).alias("_roc"), F.sum(pos * (here + before) / 2).alias("_pr"), F.max(tp).alias("_p"), F.max(fp).alias("_n")
    )
    return sums.select(numeric.ratio(F.col("_roc"), F.col("_p") * F.col("_n")).alias("auroc"), numeric.ratio(F.col("_pr"), F.col("_p")).alias("auprc"))


def ranking_metrics(scored: DataFrame, label: str, score: str = "p1") -> DataFrame:
    """One row, ``auroc`` and ``auprc``: areas under the curves through the
    points of all different scores, without binning; null where undefined."""
    return _ranking(score_counts(scored, label, score))


def roc_curve(scored: DataFrame, label: str, score: str = "p1") -> DataFrame:
    """``(FPR, TPR)`` at every different score, and the origin."""
    points = _thresholds(score_counts(scored, label, score))
    total = points.agg(F.struct(F.max("tp").alias("p"), F.max("fp").alias("n")).alias("t"))
    curve = points.withColumn("_t", total.scalar()).select(
        numeric.ratio(F.col("fp"), F.col("_t.n")).alias("FPR"), numeric.ratio(F.col("tp"), F.col("_t.p")).alias("TPR")
    )
    return curve.union(scored.sparkSession.createDataFrame([(0.0, 0.0)], "FPR double, TPR double"))


def report(rows: DataFrame, is_train: str, label: str, features: Sequence[str], kinds: Sequence[str], **params) -> DataFrame:
    """One row per model: ranking and class-1 metrics on the test rows.

    ``rows`` holds label, features and the train mark. It is written once
    before the first model: the joins behind it run once, not once per
    iteration, and a lost executor costs a re-read. Of the scores only the
    counts per different score are kept, and both kinds of metrics come from
    them.
    """
    rows = stored(rows)
    train, test = rows.where(F.col(is_train)), rows.where(~F.col(is_train))
    out = None
    with fitting(train, label, features) as fitted:
        for kind in kinds:
            counts = stored(score_counts(score(fitted(kind, **params), test), label))
            row = _ranking(counts).join(_confusion(counts)).select(F.lit(kind).alias("model"), "*")
            out = row if out is None else out.union(row)
    return out


def optimality(model: PipelineModel, rows: DataFrame, label: str, features: Sequence[str], reg: float = 0.0, elastic_net: float = 0.0) -> DataFrame:
    """``(feature, weight, violation)``: how far a fitted logistic regression
    is from the best weights, from one aggregate over its training rows.

    The penalty counts in units of each feature's spread. At the best weights
    the gradient of the loss balances the penalty's; a weight of zero may
    leave any gradient up to the lasso's share. The row ``intercept`` holds
    the mean residual. All violations are zero at the optimum only.
    """
    scored = score(model, rows)
    residual = F.col("p1") - F.col(label)
    names = list(features)
    sums = scored.agg(
        F.avg(residual).alias("r"),
        *[F.avg(residual * F.col(f"`{c}`")).alias(f"g{i}") for i, c in enumerate(names)],
        *[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(names)],
        *[F.stddev_samp(f"`{c}`").alias(f"s{i}") for i, c in enumerate(names)],
    )
    stage = model.stages[-1]
    l1, l2 = reg * elastic_net, reg * (1 - elastic_net)
    cells = [F.struct(F.lit("intercept").alias("feature"), F.lit(float(stage.intercept)).alias("weight"), F.abs("r").alias("violation"))]
    for i, (name, weight) in enumerate(zip(names, stage.coefficients.toArray().tolist())):
        spread = F.col(f"s{i}")
        slope = (F.col(f"g{i}") - F.col(f"m{i}") * F.col("r")) / spread
        if weight:
            away = F.abs(slope + l1 * (1 if weight > 0 else -1) + l2 * weight * spread)
        else:
            away = F.greatest(F.abs(slope) - l1, F.lit(0.0))
        cells.append(F.struct(F.lit(name).alias("feature"), F.lit(weight).alias("weight"), F.when(spread > 0, away).otherwise(0.0).alias("violation")))
    return sums.select(F.inline(F.array(*cells)))


def importances(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """``(feature, importance)`` of a fitted tree model."""
    scores = model.stages[-1].featureImportances
    rows = [(f, float(scores[i])) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

