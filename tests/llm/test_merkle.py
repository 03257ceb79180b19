import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """All levels of a tree, and the siblings of each leaf."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    proofs = [[level[i >> n ^ 1] for n, level in enumerate(levels[:-1]) if (i >> n ^ 1) < len(level)] for i in range(len(leaves))]
    return levels[-1][0], proofs


def make(spark, rows, tier=10):
    df = spark.createDataFrame(rows, "id long, lang string, v string, place int, tree string")
    leaf = merkle.digest(merkle.field(F.col("id")), merkle.field(F.col("v")))
    changed = F.when(F.col("v") == "bad", merkle.digest(F.lit("other"))).otherwise(leaf)
    return merkle.manifest(df, "id", "lang", leaf, changed, tier)


def check(rows, got):
    def leaf(r):
        enc = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
        return h(enc(r[0]), enc(r[2]))
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        trees.setdefault(r[1], []).append((r[0], leaf(r), r[2]))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subs = [plain_tree([x[1] for x in trees[n]]) for n in names]
    root, tops = plain_tree([s[0] for s in subs])
    want = [(key, lf, sub, root, tuple(proof + top), v != "bad")
            for n, (sub, proofs), top in zip(names, subs, tops) for (key, lf, v), proof in zip(trees[n], proofs)]
    order = lambda rows: sorted(rows, key=str)
    assert order([(r.id, r.leaf, r.subroot, r.root, tuple(r.proof), r.verified) for r in got]) == order(want)
    assert all((r.folded_root == r.root) == r.verified for r in got)


@pytest.mark.parametrize("tier", [1, 2, 10])
def test_trees_of_all_shapes(spark, tier):
    rng = random.Random(tier)
    rows, n = [], 0
    for lang, size in [("en", 37), (None, 8), ("", 1), ("é", 17), ("zz", 2), ("z", 33)]:
        for _ in range(size):
            n += 1
            rows.append((n, lang, rng.choice(["a", "bad", None, "ü"]), 1, "x"))
    rng.shuffle(rows)
    check(rows, make(spark, rows, tier).collect())


def test_more_trees_than_a_block_holds(spark):
    rows = [(i, f"l{i % 23}", "a", 1, "x") for i in range(50)]
    check(rows, make(spark, rows, 2).collect())


def test_repeated_rows_null_keys_and_small_tables(spark):
    rows = [(1, "a", "x", 0, ""), (1, "a", "x", 0, ""), (None, "a", "y", 0, ""), (None, "a", None, 0, ""), (2, None, "bad", 0, "")]
    check(rows, make(spark, rows).collect())
    check(rows[:1], make(spark, rows[:1]).collect())
    empty = spark.createDataFrame(rows, "id long, lang string, v string, place int, tree string").limit(0)
    leaf = merkle.digest(merkle.field(F.col("id")))
    assert merkle.manifest(empty, "id", "lang", leaf, leaf).count() == 0


def test_fields_do_not_run_into_each_other(spark):
    row = spark.range(1).select(F.concat(merkle.field(F.lit("a")), merkle.field(F.lit("1:b"))).alias("x"),
                                F.concat(merkle.field(F.lit("a3:1")), merkle.field(F.lit("b"))).alias("y"),
                                merkle.field(F.lit("é")).alias("z"), merkle.field(F.lit(None)).alias("n")).first()
    assert row.x != row.y and row.z == "2:é" and row.n == "-"
