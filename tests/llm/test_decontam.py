import random

from conftest import SF
from reviewmill.llm import decontam, queries
from test_llm_helpers import word_sets


def brute(docs, items, width=5, share=0.8):
    held, wanted = word_sets(docs, width), word_sets(items, width)
    out = set()
    for d, a in held.items():
        for i, b in wanted.items():
            if b and len(a & b) >= share * len(b) - 1e-9:
                out.add((d, i, len(a & b), len(b)))
    return out


def test_items_of_all_sizes_in_long_documents(spark):
    rng = random.Random(3)
    words = [f"w{n}" for n in range(4000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(text(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 12, 20, 33, 60, 64, 68, 69, 140, 700])]
    items += [(100, None), (101, " \n"), (102, items[7][1])]
    docs = []
    for k, body in items:
        own = (body or "").split()
        before, after = text(rng.randrange(6000)), text(rng.randrange(3000))
        docs.append((len(docs), " ".join(before + own + after)))
        if len(own) > 20:
            changed = list(own)
            changed[len(own) // 2] = "other"
            docs.append((len(docs), " ".join(before[:50] + changed + after)))
            half = len(own) // 2  # scattered over the document
            docs.append((len(docs), " ".join(own[:half] + before + own[half - 4:])))
            docs.append((len(docs), " ".join(own[:half] + after)))
        docs.append((len(docs), (body or "").upper()))
    docs += [(9000, None), (9001, ""), (9002, "x")]
    df = spark.createDataFrame([(k, t, "e") for k, t in docs], "doc_id long, text string, item_id string")
    got = decontam.contained(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {tuple(r[:4]) for r in got} == brute(docs, items)
    assert all(abs(r.containment - r.found / r.n_shingles) < 1e-12 for r in got)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2000)
    docs, items = queries.table(spark, SF, "documents"), queries.table(spark, SF, "benchmark")
    got = {tuple(r[:4]) for r in decontam.contained(docs, items).collect()}
    rows = [[(r[0], r[1]) for r in t.select(k, "text").collect()] for t, k in ((docs, "doc_id"), (items, "item_id"))]
    assert got == brute(*rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contained(docs, items).count() == 0
    assert decontam.contained(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
