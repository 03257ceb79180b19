import random
import re

import numpy as np
import pytest

from conftest import SF
from reviewmill.llm import neardup, queries


def brute(rows, width=3, percent=85):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {key: (len(sets[key]), root(key)) for key in sets}


def mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return " ".join(words)


def check(spark, rows):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, component_id string")
    out = {r.doc_id: r for r in neardup.link(df).collect()}
    want = brute(rows)
    assert len(out) == len(rows)
    for key, (size, component) in want.items():
        assert (out[key].n_shingles, out[key].component_id) == (size, component)
        assert out[key].kept == (key == component)


def test_odd_texts(spark):
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (9, "one TWO"), (5, "one"), (6, "a b c d"), (7, "A b\nc  d"),
                  (8, "é É x y"), (10, "long " * 30_000), (11, "long long long")])


def test_groups_near_the_threshold(spark):
    rng = random.Random(5)
    rows, key = [], 0
    for size, changes in ((220, 6), (60, 3), (3, 2), (2, 5)):
        base = [f"v{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(size):
            rows.append((key := key + 1, mutated(rng, base, rng.randrange(changes + 1))))
    rng.shuffle(rows)
    check(spark, rows)


def test_chain_reaches_the_smallest(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(200)]
    rows = []
    for i in range(40):
        rows.append((100 - i, " ".join(words)))
        words[5 * i] = f"n{i}"
    check(spark, rows)


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (5, "a b c"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.link(df).collect())
    assert got == [(0, 0, True), (0, 0, True), (3, 3, True), (3, 3, True), (5, 3, False)]
    assert neardup.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    first, second = np.concatenate([shared, a]), np.concatenate([shared, b])
    one, two = neardup.registers(first), neardup.registers(second)
    assert (np.maximum(one, two) == neardup.registers(np.concatenate([first, b]))).all()
    got = neardup.estimate(one[None], two[None], np.array([900.0]), np.array([900.0]))[0]
    assert got == pytest.approx(0.8, abs=0.12)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op4_near_duplicates(spark, SF).collect()}
    assert got == want
