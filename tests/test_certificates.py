"""Certificates of linear fits against plain arithmetic, and whether they see a bad fit."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewmill.operators import certificates, forests


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 6)) * (rng.random((120, 6)) < 0.6)
    x[0] = 0
    y = (x @ [2, -1, 0.5, 0, 3, -2] > 0.2).astype(float)
    return x, y, rng.random(120) + 0.5


def table(spark, rows, dense=False):
    x, y, w = rows
    vector = (lambda r: Vectors.dense(r)) if dense else (lambda r: Vectors.sparse(len(r), [(i, float(v)) for i, v in enumerate(r) if v]))
    return spark.createDataFrame([(float(b), float(c), vector(a.tolist())) for a, b, c in zip(x, y, w)], ["label", "class_weight", "features"])


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("weight", [None, "class_weight"])
def test_logistic_loss_and_gradient(spark, rows, dense, weight):
    x, y, w = rows
    w = w if weight else np.ones(len(y))
    df = table(spark, rows, dense)
    model = LogisticRegression(maxIter=3, **({"weightCol": weight} if weight else {})).fit(df)
    got = certificates.certificate(model, df, weight).first()
    z = x @ model.coefficients.toArray() + model.intercept
    sign = 2 * y - 1
    push = -sign * w / (1 + np.exp(sign * z))
    gradient = np.append(push @ x, push.sum()) / w.sum()
    assert got.loss == pytest.approx((np.log1p(np.exp(-sign * z)) * w).sum() / w.sum())
    assert got.gradient == pytest.approx(np.linalg.norm(gradient))
    assert got.start_loss == pytest.approx(np.log(2))


def test_hinge_loss(spark, rows):
    x, y, _ = rows
    df = table(spark, rows)
    model = LinearSVC(maxIter=5).fit(df)
    got = certificates.certificate(model, df).first()
    margin = (2 * y - 1) * (x @ model.coefficients.toArray() + model.intercept)
    assert got.loss == pytest.approx(np.maximum(0, 1 - margin).mean())


def test_an_unfinished_fit_is_seen(spark, rows):
    df = table(spark, rows)
    for kind, hinge in ((LogisticRegression, False), (LinearSVC, True)):
        good, bad = kind(maxIter=200, tol=1e-12).fit(df), kind(maxIter=1).fit(df)
        assert certificates.holds(certificates.certificate(good, df), hinge).first().certified
        assert not certificates.holds(certificates.certificate(bad, df), hinge).first().certified


@pytest.mark.parametrize("depth", [1, 5, 9])
def test_forest_as_nodes_predicts_like_the_library(spark, rows, depth):
    df = table(spark, rows).withColumn("row", F.monotonically_increasing_id()).cache()
    model = RandomForestClassifier(numTrees=7, maxDepth=depth, seed=1).fit(df)
    nodes = forests.nodes(model)
    own, entries = certificates.stored_entries(df)
    found = forests.leaves(own, entries, nodes, 7, max(t.depth for t in model.trees))
    mine = {r.row: r.prediction for r in forests.predictions(found, nodes).collect()}
    assert mine == {r.row: r.prediction for r in model.transform(df).collect()} and len(set(mine.values())) == 2
    assert spark.range(1).select(forests.sound(nodes)).first()[0]
    wrong = nodes.withColumn("stats", F.when(F.col("leaf") & (F.col("tree") == 0), F.reverse("stats")).otherwise(F.col("stats")))
    assert not spark.range(1).select(forests.sound(wrong)).first()[0]
