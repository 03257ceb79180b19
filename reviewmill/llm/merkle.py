"""Merkle manifest: a digest for every row, one tree for each group of rows, a tree over the groups, and a proof for every row.

Method: rows of a group are ranked by key, and every node of its tree is labelled with the interval [low, high) of ranks that it
covers. A node of level L with index i covers the ranks from i * 2**L, so nodes of one level fall in buckets of their intervals.
Leaves are hashed in blocks of ``2**TIER`` neighbours, block roots again in blocks of block roots, until one node is left: a task
holds one block at a time, whatever the group's size. Ancestors are attached to blocks by a join on (tree, level, bucket) with a
containment test; the siblings on the way to the root are the nodes whose interval is the difference between a parent's
interval and that of the node on the way. Inside a block the same differences are taken in place. So the upper part of a proof,
equal for all rows of a block, is joined once for each block and not for each row.

H is the SHA-256 of its inputs, one after the other, in lowercase hex. A last node without a neighbour is hashed alone.

Defined cases: a null field counts as ``-``; a null group is a group of its own and comes first. Rows without key come first in
their group, repeated rows are leaves of their own, next to each other, ordered by digest. An empty table has no rows. Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.operators import running
from reviewmill.session import publish

#: Levels of a block: 1,024 neighbours.
TIER = 10


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(column: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, so that no two rows read alike; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return max(n - 1, 0).bit_length()


def raised(hashes: list[str], levels: int) -> list[list[str]]:
    """``hashes`` and the nodes of each of the ``levels`` above them."""
    out = [hashes]
    for _ in range(levels):
        below = out[-1]
        out.append([_h("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return out


def sibling(low: int, high: int, parent: tuple[int, int]) -> tuple[int, int] | None:
    """The interval that a node's interval leaves of its parent's, if any."""
    if low > parent[0]:
        return parent[0], low
    return (high, parent[1]) if high < parent[1] else None


def _blocks(nodes: DataFrame, extra: list[str], tier: int) -> DataFrame:
    """(tree, leaves, block, items): neighbours below one node tier levels up, as a sorted array of at most 2**tier."""
    items = F.sort_array(F.collect_list(F.struct("place", "hash", *extra)))
    return nodes.groupBy("tree", "leaves", F.shiftright("place", tier).alias("block")).agg(items.alias("items"))


def _upper(blocks: DataFrame, base: int, tier: int) -> DataFrame:
    """Nodes above each block's items, which are of level ``base``: (tree, leaves, level, low, high, hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for tree, leaves, block, items in zip(*[batch.column(n).to_pylist() for n in ("tree", "leaves", "block", "items")], strict=True):
                levels = min(tier, height(leaves) - base)
                for up, hashes in enumerate(raised([i["hash"] for i in items], levels)):
                    level = base + up
                    if up and (base or up == levels):  # below the lowest blocks' roots, nodes are made again where they are needed
                        first = (block << tier) >> up
                        out += [(tree, leaves, level, i << level, min((i + 1) << level, leaves), h) for i, h in enumerate(hashes, first)]
            names = ["tree", "leaves", "level", "low", "high", "hash"]
            yield pa.RecordBatch.from_pydict({n: [row[i] for row in out] for i, n in enumerate(names)}, schema=schema)

    schema = pa.schema([("tree", pa.string()), ("leaves", pa.int64()), ("level", pa.int32()), ("low", pa.int64()),
                        ("high", pa.int64()), ("hash", pa.string())])
    return blocks.mapInArrow(run, "tree string, leaves long, level int, low long, high long, hash string")


def nodes_above(leaves: DataFrame, most: int, tier: int) -> DataFrame:
    """Stored nodes of the levels tier and up (and roots below) for (tree, leaves, place, hash); ``most`` is the largest number of leaves."""
    levels, base, items = [], 0, leaves
    while True:
        made = publish(_upper(_blocks(items, [], tier), base, tier), "nodes")
        levels.append(made)
        base += tier
        if height(most) <= base:
            break
        items = made.filter((F.col("level") == base) & (F.col("leaves") > 1 << base)).select(
            "tree", "leaves", F.expr("shiftright(low, level)").alias("place"), "hash")
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def _attached(blocks: DataFrame, nodes: DataFrame, tier: int) -> DataFrame:
    """(tree, block, above): for each block the (level, hash, before) of siblings on the way from its root to the tree's.

    One row for each block and level above it finds, in the bucket of its parent, the nodes of its level; of those the one that does
    not contain the block is the difference between the parent's interval and the interval of the node that does.
    """
    low = F.shiftleft(F.col("block"), tier)
    top = F.length(F.bin(F.col("leaves") - 1)) - 1  # the level below the root
    ways = blocks.select("tree", "block", low.alias("from"), F.explode(F.when(
        F.col("leaves") > 1 << tier, F.sequence(F.lit(tier), top)).otherwise(F.array().cast("array<int>"))).alias("level"))
    ways = ways.withColumn("bucket", F.expr("shiftright(`from`, level + 1)"))
    wanted = nodes.withColumn("bucket", F.expr("shiftright(low, level + 1)")).drop("leaves")
    contains = (F.col("low") <= F.col("from")) & (F.col("from") < F.col("high"))
    found = ways.join(wanted, ["tree", "level", "bucket"]).filter(~contains)
    return found.groupBy("tree", "block").agg(F.sort_array(F.collect_list(F.struct(
        "level", "hash", (F.col("low") < F.col("from")).alias("before")))).alias("above"))


def ways(leaves: DataFrame, most: int, extra: list[str], tier: int) -> tuple[DataFrame, DataFrame]:
    """Blocks with the upper siblings of each, and (tree, subroot).

    ``leaves`` has (tree, leaves, place, hash) and the columns ``extra``, which go along in the items of a block.
    """
    nodes = nodes_above(leaves, most, tier)
    blocks = _blocks(leaves, extra, tier)
    above = _attached(leaves.groupBy("tree", "leaves", F.shiftright("place", tier).alias("block")).count(), nodes, tier)
    joined = blocks.join(above, ["tree", "block"], "left")
    roots = nodes.filter(F.expr("low = 0 and high = leaves")).select("tree", F.col("hash").alias("subroot"))
    single = leaves.filter("leaves = 1").select("tree", F.col("hash").alias("subroot"))
    return joined, roots.unionByName(single)


def lower_siblings(hashes: list[str], first: int, leaves: int, tier: int) -> list[list[tuple[int, str, bool]]]:
    """For each of a block's items, (level, hash, before) of its siblings inside the block, by interval difference."""
    tiers = raised(hashes, min(tier, height(leaves)))
    out: list[list[tuple[int, str, bool]]] = [[] for _ in hashes]
    for level in range(len(tiers) - 1):
        start = first >> level
        for i in range(len(hashes)):
            n = (first + i) >> level
            own = (n << level, min((n + 1) << level, leaves))
            parent = ((n >> 1) << (level + 1), min(((n >> 1) + 1) << (level + 1), leaves))
            other = sibling(*own, parent)
            if other:
                out[i].append((level, tiers[level][(other[0] >> level) - start], other[0] < own[0]))
    return out


def fold(leaf: str, way: Iterable[tuple[int, str, bool]], levels: int) -> str:
    """The root that follows from a leaf and the siblings on its way up."""
    at = {level: (h, before) for level, h, before in way}
    for level in range(levels):
        h, before = at.get(level, ("", True))
        leaf = _h(h + leaf if before else leaf + h)
    return leaf


def _top(roots: DataFrame, order: Column, tier: int) -> DataFrame:
    """(tree, subroot, root, trees, way): for each tree its siblings in the tree over all trees."""
    ranked = running.numbered(roots, [order], "place")
    trees = ranked.count()
    leaves = publish(ranked.select(F.lit("").alias("tree"), F.lit(trees).cast("bigint").alias("leaves"), "place",
                                   F.col("subroot").alias("hash"), F.col("tree").alias("name")), "subroots")
    blocks, root = ways(leaves, trees, ["name"], tier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for n, items, above in zip(*[batch.column(c).to_pylist() for c in ("leaves", "items", "above")], strict=True):
                inside = lower_siblings([i["hash"] for i in items], items[0]["place"], n, tier)
                for item, way in zip(items, inside, strict=True):
                    way = way + [(a["level"], a["hash"], a["before"]) for a in above or []]
                    out.append({"tree": item["name"], "trees": n, "way": [{"level": a, "hash": b, "before": c} for a, b, c in way]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("tree", pa.string()), ("trees", pa.int64()), ("way", pa.list_(pa.struct(
                [("level", pa.int32()), ("hash", pa.string()), ("before", pa.bool_())])))]))

    found = blocks.mapInArrow(run, "tree string, trees long, way array<struct<level:int,hash:string,before:boolean>>")
    whole = root.first()
    return found.join(roots, "tree").withColumn("root", F.lit(whole.subroot if whole else None).cast("string"))


def manifest(rows: DataFrame, key: str, group: str, leaf: Column, changed: Column, tier: int = TIER) -> DataFrame:
    """(key, leaf, subroot, root, proof, folded_root, verified) of every row.

    ``leaf`` is the digest of a row, ``changed`` the one to verify against the proof. ``proof`` is the list of siblings from the leaf
    to the root, ``folded_root`` the root that follows from ``changed`` and that list. Blocks have ``2**tier`` nodes.
    """
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("tree")
    hashed = rows.select(F.col(key).alias("key"), tree, leaf.alias("hash"), changed.alias("changed"), F.monotonically_increasing_id().alias("copy"))
    order = [F.col("key").asc_nulls_first(), F.col("hash"), F.col("changed"), F.col("copy")]
    ranked = publish(running.numbered(hashed, order, "place", per=["tree"]).drop("copy"), "leaves")
    sizes = publish(ranked.groupBy("tree").agg(F.count(F.lit(1)).alias("leaves")), "trees")
    most = sizes.agg(F.max("leaves")).first()[0] or 0
    leaves = ranked.join(sizes, "tree")
    blocks, roots = ways(leaves, most, ["key", "changed"], tier)
    tops = publish(_top(publish(roots, "roots"), F.col("tree"), tier), "tops")
    joined = blocks.join(tops, "tree")
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(result)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                items, n, levels = row["items"], row["leaves"], height(row["leaves"])
                shared = [(a["level"], a["hash"], a["before"]) for a in row["above"] or []]
                top = [(levels + w["level"], w["hash"], w["before"]) for w in row["way"]]
                made = []
                for item, way in zip(items, lower_siblings([i["hash"] for i in items], items[0]["place"], n, tier), strict=True):
                    way = [*way, *shared, *top]
                    folded = fold(item["changed"], way, levels + height(row["trees"]))
                    made.append({"key": item["key"], "leaf": item["hash"], "subroot": row["subroot"], "root": row["root"],
                                 "proof": [w[1] for w in way], "folded_root": folded, "verified": folded == row["root"]})
                yield pa.RecordBatch.from_pylist(made, schema=schema)

    result = StructType.fromDDL(f"key {kind}, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean")
    return joined.mapInArrow(run, result).withColumnRenamed("key", key)
