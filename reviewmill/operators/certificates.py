"""What a fitted linear model must satisfy, computed from its training rows without the library that fitted it.

The stored vectors are read as plain arrays, so margins, loss and gradient are ordinary joins and aggregates over
(row, place, value). For logistic regression the gradient of the loss at the fitted point must have vanished; for a linear support
vector machine without penalty the mean hinge loss bounds the distance to the optimum, which is at least 0. A wrong or
unfinished fit shows in either.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import session

VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def stored_entries(vectors: DataFrame, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(row, sign, weight) and (row, place, value) of labelled vectors, from a stored copy; rows are numbered unless they have a ``row``."""
    spark = vectors.sparkSession
    path = session.scratch_path(spark, "certified")
    columns = ["row", "label", *([weight] if weight else []), "features"]
    numbered = vectors if "row" in vectors.columns else vectors.withColumn("row", F.monotonically_increasing_id())
    numbered.select(*columns).write.parquet(path)
    kinds = {"row": "bigint", "label": "double", "features": VECTOR}
    raw = spark.read.schema(", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in columns)).parquet(path)
    places = F.coalesce(F.col("features.indices"), F.sequence(F.lit(0), F.size("features.values") - 1))
    rows = raw.select("row", (2 * F.col("label") - 1).alias("sign"), (F.col(weight) if weight else F.lit(1.0)).alias("weight"))
    return rows, raw.select("row", F.inline(F.arrays_zip(places.alias("place"), F.col("features.values").alias("value"))))


def coefficients(model: Model) -> DataFrame:
    """(place, coefficient) of the places that weigh something; the vector has a documented length."""
    spark = SparkSession.active()
    vector = spark.createDataFrame([(model.coefficients.toSparse() if hasattr(model.coefficients, "toSparse") else model.coefficients,)], ["features"])
    _, entries = stored_entries(vector.withColumn("label", F.lit(1.0)))
    return entries.select("place", F.col("value").alias("coefficient")).filter("coefficient != 0")


def certificate(model: Model, vectors: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: mean ``loss`` and ``gradient`` norm at the fitted point, ``start_loss`` and ``start_gradient`` at zero.

    ``model`` is a binary logistic regression, or a linear support vector machine (hinge loss, gradient of the active rows).
    """
    hinge = not hasattr(model, "setProbabilityCol")
    rows, entries = stored_entries(vectors, weight)
    dots = entries.join(coefficients(model), "place").groupBy("row").agg(F.sum(F.col("value") * F.col("coefficient")).alias("dot"))
    at = F.col("sign") * (F.coalesce("dot", F.lit(0.0)) + F.lit(float(model.intercept)))
    placed = rows.join(dots, "row", "left").withColumn("at", at)
    if hinge:
        loss, slope = F.greatest(F.lit(0.0), 1 - F.col("at")), F.when(F.col("at") < 1, -1.0).otherwise(0.0)
        start_loss, start_slope = F.lit(1.0), F.lit(-1.0)
    else:
        loss = F.when(F.col("at") > 0, F.log1p(F.exp(-F.col("at")))).otherwise(F.log1p(F.exp(F.col("at"))) - F.col("at"))
        slope, start_loss, start_slope = -1 / (1 + F.exp(F.col("at"))), F.log(F.lit(2.0)), F.lit(-0.5)
    felt = placed.withColumns({"loss": loss, "push": slope * F.col("sign") * F.col("weight"), "start_push": start_slope * F.col("sign") * F.col("weight")})
    total = felt.agg(F.sum("weight").alias("total"), (F.sum(F.col("loss") * F.col("weight")) / F.sum("weight")).alias("loss"),
                     F.sum("push").alias("p"), F.sum("start_push").alias("s"))
    steps = entries.join(felt.select("row", "push", "start_push"), "row").groupBy("place").agg(
        F.sum(F.col("value") * F.col("push")).alias("g"), F.sum(F.col("value") * F.col("start_push")).alias("g0"))
    squares = steps.agg(F.sum(F.col("g") * F.col("g")).alias("gg"), F.sum(F.col("g0") * F.col("g0")).alias("gg0"))
    # Two tables of one row each; the intercept is a place of its own.
    whole = squares.select(total.select(F.struct("*")).scalar().alias("t"), "gg", "gg0")
    return whole.select(
        F.col("t.loss").alias("loss"), start_loss.alias("start_loss"),
        (F.sqrt(F.col("gg") + F.col("t.p") * F.col("t.p")) / F.col("t.total")).alias("gradient"),
        (F.sqrt(F.col("gg0") + F.col("t.s") * F.col("t.s")) / F.col("t.total")).alias("start_gradient"))


def holds(found: DataFrame, hinge: bool, share: float = 0.05):
    """Whether the loss, and for a smooth loss the gradient, has fallen to ``share`` of what it was at zero."""
    low = F.col("loss") <= share * F.col("start_loss")
    return found.select((low if hinge else low & (F.col("gradient") <= share * F.col("start_gradient"))).alias("certified"))
