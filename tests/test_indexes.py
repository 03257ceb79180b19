"""Page and search indexes against sorting and scanning."""

import random
import re

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import indexes


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=4)) for _ in range(3)) for _ in range(1500)]
    return spark.createDataFrame([(n, rng.randint(0, 30), t, "part") for n, t in enumerate(texts)], "id int, score int, text string, part string").cache()


def test_any_page_equals_sorting(spark, rows):
    order = [F.desc("score"), F.col("id")]
    index = indexes.page_index(rows, order, 7)
    want = [r.id for r in rows.orderBy(*order).collect()]
    for number, size in ((1, 20), (2, 20), (37, 20), (75, 20), (76, 20), (1000, 20), (3, 400)):
        page = index.page(number, size)
        assert page.columns == rows.columns
        assert [r.id for r in page.collect()] == want[(number - 1) * size:number * size]
    assert indexes.page_index(rows.limit(0), order).page(1).count() == 0


def test_a_deep_page_reads_one_range(spark, rows):
    index = indexes.page_index(rows, [F.col("id")], 8)
    assert index.counts.count() > 3
    for number in (1, 70):
        plan = index.page(number, 20)._jdf.queryExecution().executedPlan().toString()
        asked = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
        assert "part" in asked and asked.count(",") <= 2  # one range, or two


def test_search_equals_a_scan(spark, rows):
    index = indexes.search_index(rows, ["text", "part"], [F.col("text")], 6)
    for term in ("abcd", "A", "ab", "c d", "jihg", "zzz", "PART", "hij abc", ""):
        want = {r.id for r in rows.collect() if term.lower() in r.text or term.lower() in r.part}
        assert {r.id for r in index.search(term).collect()} == want


def test_a_rare_term_opens_few_ranges(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("order "), F.sha2(F.col("id").cast("string"), 256).substr(1, 6),
                                                   F.when(F.col("id") == 777, " zyxwv").otherwise("")).alias("text"))
    index = indexes.search_index(df, ["text"], [F.col("id")], 8)
    assert index.filters.count() > 3 and len(index.parts("zyxwv")) == 1 and len(index.parts("order")) == index.filters.count()
    assert [r.id for r in index.search("XWV").collect()] == [777]


def test_runs_of_letters_are_reduced_by_hashing_before_bitmaps_sort_them(spark, monkeypatch):
    plans, publish = [], indexes.session.publish
    monkeypatch.setattr(indexes.session, "publish", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), publish(df, label))[1])
    texts = ["Lot 977,\nline 1", "a\U0001F600b\U0001F600c lot", "ab", "", None, "ПРИВЕТ lot"] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    index = indexes.search_index(rows, ["content"], [F.col("content"), F.col("id")], 4)
    assert re.search(r"HashAggregate\(keys=\[part#\d+, slot#\d+L?\]", plans[-1])
    for term in ("lot", "7,\nl", "\U0001F600b\U0001F600", "b\U0001F600c", "привет", "ab", "none of them"):
        want = sorted(n for n, t in enumerate(texts) if t is not None and term.lower() in t.lower())
        assert sorted(r.id for r in index.search(term).collect()) == want, term
