"""Metrics, curves and error analysis against MLlib and small cases."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from reviewmill.operators import evaluation as ev
from reviewmill.operators import ranking


def preds(spark, n=3000, levels=None, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = float(rng.random() < 0.4)
        score = min(1.0, max(0.0, rng.gauss(0.35 + 0.3 * label, 0.25)))
        score = round(score * levels) / levels if levels else score
        rows.append((i, label, score, float(score >= 0.5)))
    return spark.createDataFrame(rows, "id int, label double, score double, prediction double")


@pytest.mark.parametrize("levels", [None, 7])
def test_auc_equals_mllib(spark, levels):
    df = preds(spark, levels=levels)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert ev.auc(df).first().roc_auc == pytest.approx(want, abs=6e-5)


def test_metrics_equal_mllib(spark):
    df = preds(spark)
    got = ev.metrics(df).first()
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        want = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert got[name] == pytest.approx(want, abs=6e-5)
    assert got.recall == got.accuracy
    assert sum(ev.confusion(df).first()) == df.count()


def test_running_counts(spark):
    df = preds(spark, n=500, levels=40)
    rows = sorted(((r.score, r.pos, r.neg, r.pos_above, r.neg_above, r.rank_above) for r in ev.cumulative_counts(df).collect()), reverse=True)
    pos = neg = 0
    for i, (_, p, n, pa, na, rank) in enumerate(rows):
        assert (pa, na, rank) == (pos, neg, i)
        pos, neg = pos + p, neg + n


def test_curve_is_monotone_and_complete(spark):
    rows = sorted((r.point, r.fpr, r.tpr) for r in ev.roc_curve(preds(spark, levels=50)).collect())
    assert rows[0] == (0, 0.0, 0.0) and rows[-1][1:] == (1.0, 1.0)
    assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(rows, rows[1:]))
    thin = ev.roc_curve(preds(spark, levels=500), points=60).count()
    assert 60 <= thin <= 125


def test_one_class_has_no_auc(spark):
    df = preds(spark, n=50).withColumn("label", F.lit(1.0))
    assert ev.auc(df).first().roc_auc is None
    assert {r.fpr for r in ev.roc_curve(df).collect()} == {0.0}


def test_error_analysis_without_errors_or_negation(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, "all fine", 0.9)], "id int, label double, prediction double, review string, confidence double")
    rows = ev.annotate(df, confidence=F.col("confidence"))
    row = ev.negation_errors(rows).first()
    assert (row.with_negation, row.negation_error_rate, row.error_negation_pct) == (0, None, None)
    assert ev.error_examples(rows, "id").collect() == []


def test_best_and_delta(spark):
    table = spark.createDataFrame([("a", 0.8, 0.7), ("b", 0.7, 0.8), ("c", 0.9, 0.8)], "experiment string, accuracy double, f1 double")
    assert ev.best_experiment(table).first().experiment == "c"
    assert {r.experiment: r.delta_f1 for r in ev.deltas(table, "a").collect()} == {"a": 0.0, "b": 0.1, "c": 0.1}


def test_weights_balance_classes(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(0.0,)] * 3, "label double")
    sums = ev.with_class_weight(df).groupBy("label").agg(F.round(F.sum("class_weight"), 3).alias("w")).collect()
    assert {r.w for r in sums} == {6.0}
    assert ev.class_balance(df).first().use_weights


def test_split_is_stable_and_disjoint(spark, views):
    docs = views.documents.select("doc_id")
    train, test = ranking.split_by_key(docs, "doc_id")
    again, _ = ranking.split_by_key(docs.repartition(13), "doc_id")
    a, b = ({r.doc_id for r in d.collect()} for d in (train, test))
    assert not a & b and len(a | b) == docs.count() and a == {r.doc_id for r in again.collect()}
    assert 0.7 < len(a) / docs.count() < 0.9


def test_seeded_sample_is_repeatable(spark, views):
    take = lambda seed: [r.doc_id for r in ranking.seeded_sample(views.documents.repartition(5), "doc_id", 10, seed).collect()]
    assert take(1) == take(1) and take(1) != take(2)
