"""Random forests as a table of nodes (M7): descent by joins, level by level, and what must hold of every node.

A fitted forest is stored and read back as rows, so its predictions can be made without the library that fitted it: every row
starts at the root of each tree, and each level joins (tree, node) with the nodes and (row, place) with the row's values.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import session

#: Levels between two stored steps of a descent.
STORED_EVERY = 4


def nodes(model: RandomForestClassificationModel) -> DataFrame:
    """(tree, node, leaf, place, threshold, left, right, stats, impurity, prediction) of all trees; splits are on numbers."""
    spark = SparkSession.active()
    path = session.scratch_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    listed = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node.id.alias("node"), (node.leftChild < 0).alias("leaf"), node.split.featureIndex.alias("place"),
        F.get(node.split.leftCategoriesOrThreshold, F.lit(0)).alias("threshold"), node.leftChild.alias("left"), node.rightChild.alias("right"),
        node.impurityStats.alias("stats"), node.impurity.alias("impurity"), node.prediction.alias("prediction"))
    return session.publish(listed, "forest-nodes")


def leaves(rows: DataFrame, entries: DataFrame, table: DataFrame, trees: int, depth: int) -> DataFrame:
    """(row, tree, node): the leaf of every tree that each row ends in. ``entries`` has (row, place, value); places without one are 0."""
    at = rows.select("row", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    splits = table.select("tree", "node", "leaf", "place", "threshold", "left", "right")
    for level in range(depth):
        here = at.join(splits, ["tree", "node"])
        value = F.coalesce("value", F.lit(0.0))
        step = F.when(F.col("leaf"), F.col("node")).when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = here.join(entries, ["row", "place"], "left").select("row", "tree", step.alias("node"))
        if level % STORED_EVERY == STORED_EVERY - 1:
            at = session.publish(at, "descent")
    return at


def predictions(found: DataFrame, table: DataFrame) -> DataFrame:
    """(row, prediction): the class with most votes, each tree voting with the shares of its leaf."""
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    votes = found.join(table.select("tree", "node", "stats"), ["tree", "node"]).groupBy("row").agg(
        F.sum(F.col("stats")[0] / total).alias("no"), F.sum(F.col("stats")[1] / total).alias("yes"))
    return votes.select("row", F.when(F.col("yes") > F.col("no"), 1.0).otherwise(0.0).alias("prediction"))


def sound(table: DataFrame) -> Column:
    """Scalar: whether each node's impurity is the Gini index of its counts, its class the larger one, and its children hold its rows."""
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    gini = 1 - F.aggregate(F.transform("stats", lambda x: (x / total) * (x / total)), F.lit(0.0), lambda a, x: a + x)
    majority = F.when(F.col("stats")[1] > F.col("stats")[0], 1.0).otherwise(0.0)
    unsplit = F.col("leaf") & (F.col("impurity") == -1)  # the library's mark for a leaf of which no split was valid
    own = table.agg(F.every((unsplit | (F.abs(gini - F.col("impurity")) < 1e-9)) & (majority == F.col("prediction"))).alias("ok")).scalar()
    child = table.select("tree", F.col("node").alias("child"), F.col("stats").alias("part"))
    inner = table.filter("not leaf").select("tree", "node", "stats", F.explode(F.array("left", "right")).alias("child"))
    sums = inner.join(child, ["tree", "child"]).groupBy("tree", "node").agg(
        F.sum(F.col("part")[0]).alias("no"), F.sum(F.col("part")[1]).alias("yes"), F.first("stats").alias("stats"))
    kept = sums.agg(F.coalesce(F.every((F.abs(F.col("no") - F.col("stats")[0]) < 1e-6) & (F.abs(F.col("yes") - F.col("stats")[1]) < 1e-6)), F.lit(True))
                    .alias("ok")).scalar()
    return own & kept
