"""Running totals as a tree of partial sums, against plain sums in Python."""

import random

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import running


def rows_of(n, seed=3):
    rng = random.Random(seed)
    groups = ["hot"] * 6 + ["a", "b", None]
    return [(i, rng.choice(groups), rng.choice([None, *range(50)]), rng.randint(-3, 9) if rng.random() > 0.1 else None) for i in range(n)]


@pytest.mark.parametrize(("fan", "parts"), [(1024, 8), (2, 37), (3, 100)])
@pytest.mark.parametrize("per", [[], ["g"]])
def test_totals_of_a_tree_of_any_shape(spark, monkeypatch, fan, parts, per):
    monkeypatch.setattr(running, "FAN", fan)
    rows = rows_of(900)
    df = spark.createDataFrame(rows, "id int, g string, at int, v int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running.totals_before(df, [F.col("at"), F.col("id")], {"v": F.col("v"), "n": F.lit(1).cast("bigint")}, per)
        assert got.columns == ["id", "g", "at", "v", "n"]
        found = {r.id: (r.v, r.n) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sums, want = {}, {}
    for i, g, _, v in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        key = g if per else ""
        total, n = sums.get(key, (0, 0))
        want[i], sums[key] = (total, n), (total + (v or 0), n + 1)
    assert found == want


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "x", 5, 6)], "part int, row string, parent int, n_of int")
    got = running.numbered(df, [F.col("part")], "n", ["row"])
    assert got.columns == ["part", "row", "parent", "n_of", "n"] and got.first().n == 0
    assert running.numbered(df.limit(0), [F.col("part")], "n").count() == 0


def test_plan_has_no_forced_broadcast_and_no_single_partition(spark):
    df = spark.range(100_000)
    plan = running.numbered(df, [F.col("id")], "n")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "strategy=broadcast" not in plan
