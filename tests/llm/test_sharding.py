import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from reviewmill.llm import queries, sharding


def smallest(sizes, shards):
    """The least possible largest shard, by trying every place of every cut (dynamic programme)."""
    ends = [0, *np.cumsum(sizes).tolist()]
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[i], ends[j] - ends[i]) for i in range(j + 1)) for j in range(len(ends))]
    return best[-1]


@pytest.mark.parametrize("points", [4, 16, 1 << 16])
@pytest.mark.parametrize("shards", [1, 3, 7])
def test_capacity_is_exact_at_any_number_of_runs(spark, monkeypatch, points, shards):
    monkeypatch.setattr(sharding, "POINTS", points)
    rng = random.Random(points + shards)
    sizes = [rng.choice([1, 2, 3, 5, 40, 17]) * rng.randint(1, 9) for _ in range(150)]
    starts = [0, *np.cumsum(sizes).tolist()]
    ends = spark.createDataFrame([(a, s) for a, s in zip(starts, sizes)], "before long, bytes long").repartition(5)
    capacity, cuts = sharding.find_cuts(ends, sum(sizes), shards)
    assert capacity == smallest(sizes, shards)
    borders = [0, *cuts, sum(sizes)]
    assert set(cuts) <= set(starts) and len(cuts) == shards - 1
    assert all(0 < b - a <= capacity for a, b in zip(borders, borders[1:]))


def check(rows, got, shards):
    """rows: (doc_id, text). Sizes, groups, slots and the largest shard."""
    held, size, count = defaultdict(list), defaultdict(int), defaultdict(int)
    by_shard = defaultdict(set)
    for r in got:
        held[r.shard].append(r.slot)
        size[r.shard] += r.size
        count[r.doc_id, r.size, r.text_crc32] += 1
    want = defaultdict(int)
    for key, text in rows:
        raw = (text or "").encode()
        want[key, len(raw) + 16, zlib.crc32(raw)] += 1
        by_shard[text or ""].add(key)
    assert count == want
    assert all(sorted(slots) == list(range(len(slots))) for slots in held.values())
    assert all(0 <= s < shards for s in held)
    return size


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    got = queries.op12_sharding(spark, SF).collect()
    size = check(rows, got, 40)
    shard = {r.doc_id: r.shard for r in got}
    groups, first = defaultdict(int), {}
    for key, text in sorted(rows):
        groups[text or ""] += len((text or "").encode()) + 16
        first.setdefault(text or "", key)
    assert all(len({shard[k] for k, t in rows if t == text}) == 1 for text in groups)
    total, left, alone = sum(groups.values()), 40, []
    for text, n in sorted(groups.items(), key=lambda g: -g[1]):
        if n * left <= total:
            break
        alone.append(text)
        total, left = total - n, left - 1
    others = [n for text, n in sorted(groups.items(), key=lambda g: first[g[0]]) if text not in alone]
    assert max(size.values()) == max(smallest(others, left), max([groups[t] for t in alone], default=0))
    assert len(size) == 40 and {r.law for r in got} == {"bytes"} and all(r.grown_shard is None for r in got)


def test_hot_group_nulls_and_repeated_rows(spark):
    rng = random.Random(4)
    rows = [(i, "the same" if i % 3 == 0 else "x" * rng.randint(0, 60)) for i in range(600)]
    rows += [(None, None), (None, "no id"), (7, "twice"), (7, "twice"), (8, ""), (9, None)]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, shard int, digest string")
    got = sharding.assign(df, 10).collect()
    size = check(rows, got, 10)
    hot = {r.shard for r in got if r.doc_id is not None and r.doc_id % 3 == 0 and r.doc_id not in (8, 9) and r.size == 24}
    assert hot == {0}
    rest = [n for s, n in size.items() if s != 0]
    assert len(rest) == 9 and max(rest) - min(rest) < 0.4 * max(rest)


def test_few_groups_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(df, 40).collect()}
    assert got[1][0] == got[2][0] != got[3][0] and {got[1][1], got[2][1]} == {0, 1}
    assert sharding.assign(df.limit(0), 40).count() == 0


def test_files_hold_every_row_once(spark, tmp_path):
    docs = queries.table(spark, SF, "documents")
    sharding.write(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    placed = sharding.assign(docs, 5).select("doc_id", F.col("shard").alias("s"))
    assert back.join(placed, "doc_id").filter("shard != s").count() == 0
