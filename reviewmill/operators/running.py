"""Running totals over a whole table, or restarting per group, as a tree of partial sums over range partitions.

The rows are dealt out by ranges of the order, sorted inside their partition and stored with the number of the partition and of
the row. Partitions are summed, ``FAN`` partitions make a node, ``FAN`` nodes make one of the next level, until one is left; the
offsets then go down the same tree. A window never holds more than ``FAN`` nodes or the rows of one partition, no list of bounds
exists, and nothing is broadcast by force: the offsets have one row for each partition (and group that it holds), and Spark
chooses the join by their measured size. Every row moves twice whatever the size of the table, so the cost per row stays.
Results do not depend on where the ranges are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.names import free_names
from reviewmill.session import publish

#: Children of a node of the tree.
FAN = 1024


def most_partitions(df: DataFrame) -> int:
    """Partitions that a shuffle without a number of its own has at most."""
    conf = df.sparkSession.conf
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(conf.get("spark.sql.shuffle.partitions")), int(first or 0))


def place(df: DataFrame, order: list[Column], part: str, row: str, label: str = "ordered") -> DataFrame:
    """``df`` in the given order as a stored table: ``part`` numbers its ranges, ``row`` ascends with the order over all of them.

    Rows equal in ``order`` stay together in one range unless ``order`` ends with something that tells them apart.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return publish(ranged.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}), label)


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of the keys of two tables, nulls being equal."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def _descend(nodes: DataFrame, per: list[str], node: str, names: list[str], width: int) -> DataFrame:
    """(per, node, names): for each node the totals of all earlier nodes of its group."""
    parent, = free_names(nodes.columns, "parent")
    nodes = nodes.withColumn(parent, F.floor(F.col(node) / FAN).cast("bigint"))
    earlier = Window.partitionBy(*per, parent).orderBy(node).rowsBetween(Window.unboundedPreceding, -1)
    inside = nodes.select(*per, node, parent, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names])
    if width <= FAN:
        return inside.drop(parent)
    above = nodes.groupBy(*per, parent).agg(*[F.sum(n).alias(n) for n in names])
    above = _descend(above, per, parent, names, -(-width // FAN))
    return inside.join(above, same(inside, above, [*per, parent])).select(
        *[inside[k] for k in per], inside[node], *[(inside[n] + above[n]).alias(n) for n in names])


def totals_before(df: DataFrame, order: list[Column], sums: dict[str, Column], per: list[str] | None = None) -> DataFrame:
    """``df`` with, for every name in ``sums``, the total of that column over all earlier rows (0 for the first).

    With ``per``, totals restart for each combination of those columns, nulls being a value. Rows that ``order`` does not tell
    apart follow each other in an order of their own. A null counts as 0; ``sums`` are added as longs, or as the type of the column.
    """
    per = per or []
    part, row, *inputs = free_names([*df.columns, *sums], "part", "row", *[f"{name}_of" for name in sums])
    names = dict(zip(sums, inputs, strict=True))
    filled = df.withColumns({names[n]: F.coalesce(column, F.lit(0)) for n, column in sums.items()})
    stored = place(filled, [*[F.col(f"`{k}`") for k in per], *order], part, row)
    parts = stored.groupBy(*per, part).agg(*[F.sum(i).alias(n) for n, i in names.items()])
    offsets = _descend(parts, per, part, list(sums), most_partitions(df))
    earlier = Window.partitionBy(*per, part).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    inside = stored.withColumns({i: F.coalesce(F.sum(i).over(earlier), F.lit(0)) for i in inputs})
    kept = [inside[f"`{c}`"] for c in df.columns if c.lower() not in {n.lower() for n in sums}]
    return inside.join(offsets, same(inside, offsets, [*per, part])).select(
        *kept, *[(inside[i] + offsets[n]).alias(n) for n, i in names.items()])


def numbered(df: DataFrame, order: list[Column], name: str, per: list[str] | None = None) -> DataFrame:
    """``df`` with a gapless number from 0 in the given order, for each group of ``per`` anew."""
    return totals_before(df, order, {name: F.lit(1).cast("bigint")}, per)
