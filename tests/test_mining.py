"""Aspects and complaints."""

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import rules
from reviewmill.operators import aspects, complaints


def reviews(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string")


def contexts(spark, *texts):
    rows = aspects.aspect_contexts(reviews(spark, *texts), "content", ["id"]).collect()
    return {(r.id, r.aspect): r.context for r in rows}


def test_contrast_splits_aspects(spark):
    got = contexts(spark, "The battery life is terrible but the build quality is excellent.")
    assert got == {(0, "Battery"): "The battery life is terrible",
                   (0, "Build Quality"): "the build quality is excellent"}


def test_no_aspect_gives_no_rows(spark):
    assert contexts(spark, "I really enjoyed reading this book.") == {}


def test_clauses_of_one_aspect_are_joined(spark):
    got = contexts(spark, "Price is high. Nice color. The cost is silly!\nMoney gone")
    assert got == {(0, "Price / Value"): "Price is high ... The cost is silly ... Money gone"}


def test_short_clauses_are_dropped_but_a_short_text_is_kept(spark):
    # "box" alone is too short for a clause next to others, but is the whole text of the second review.
    got = contexts(spark, "box. Lovely thing here", "box")
    assert got == {(1, "Delivery / Packaging"): "box"}


def test_keywords_match_whole_words_only(spark):
    assert contexts(spark, "A priceless boxing agenda") == {}


def test_aspect_filter_agrees_with_contexts(spark, views):
    flagged = {r.id for r in views.reviews.filter(aspects.mentions_aspect("content", "Customer Support")).select("id").collect()}
    rows = aspects.aspect_contexts(views.reviews, "content", ["id"]).filter(F.col("aspect") == "Customer Support")
    assert flagged == {r.id for r in rows.collect()}


def test_pain_point_threshold(spark):
    stats = spark.createDataFrame(
        [("a", 50, 40.0), ("b", 49, 90.0), ("c", 500, 28.0), ("d", 500, 27.99)],
        "aspect string, mentions bigint, negative_pct double")
    got = {r.aspect: (r.is_pain_point, r.status) for r in aspects.with_status(stats).collect()}
    assert got == {"a": (True, "High Negative Feedback"), "b": (False, "Moderate Concern"),
                   "c": (False, "Moderate Concern"), "d": (False, "Healthy / Positive")}


def test_rollup_without_mentions(spark):
    rows = spark.createDataFrame([("a", 0, 0, 0)], "aspect string, mentions int, positive_count int, negative_count int")
    assert aspects.aspect_rollup(rows).first().positive_pct is None
    assert aspects.aspect_rollup(rows, empty=50.0).first().positive_pct == 50.0


def test_filter_comes_before_top_k(spark):
    # 300 frequent harmless phrases must not push the one complaint out of the list.
    texts = [f"lorem{i:03d} ipsum{i:03d}" for i in range(300) for _ in range(2)] + ["hinge cracked"]
    rows = complaints.top_complaints(reviews(spark, *texts), "content", k=5).collect()
    assert [r.phrase for r in rows] == ["hinge cracked"]


def test_occurrences_and_reviews_are_counted_apart(spark):
    rows = complaints.top_complaints(reviews(spark, "poor quality poor quality", "fine words here", "poor quality",
                                             "pretty colors shown"), "content").collect()
    top = next(r for r in rows if r.phrase == "poor quality")
    assert (top.frequency, top.percentage, top.review_pct) == (3, 75.0, 50.0)


def test_empty_input_gives_empty_tables(spark):
    none = reviews(spark, "x").filter(F.lit(False))
    assert complaints.top_complaints(none, "content").collect() == []


def test_every_aspect_keeps_a_row(spark):
    mined = complaints.mined_complaints(reviews(spark, *["battery failed"] * 3), "content")
    rows = complaints.complaints_by_aspect(mined).collect()
    assert {r.aspect for r in rows if r.phrase is None} == {
        "Build Quality", "Price / Value", "Customer Support", "Delivery / Packaging", "General Dissatisfaction"}


def test_single_review_matches_keep_list_order_and_limit(spark):
    text = "Stopped working, poor quality, cheap plastic, fell apart, broke after a day, not worth it"
    row = reviews(spark, text).select(complaints.matched_patterns(
        "content", known=[("broke after a day", "Mined Phrase", "Battery")], limit=5).alias("m")).first()
    assert [m.phrase for m in row.m] == ["broke after a day", "stopped working", "poor quality", "cheap plastic", "fell apart"]


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_phrase_join_equals_brute_force(spark, sent):
    texts = ["whate it now", "i hate it", "hate  it", "it is bad  idea", "a bad idea x", "abad ideas", "no b c here",
             "ab cd", "xab cdx", "ab\ncd", "", "to be or not to be", "stopped working entirely", "STOPPED WORKING"]
    phrases = ["hate it", "bad idea", "b c", "ab cd", "to be", "stopped working", "or not to", " x", "a ", "hate", "b", "idea", "or", "zzz"]
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    got = {(r.id, r.phrase) for r in complaints.match_phrases(reviews(spark, *texts), table, sent=sent).collect()}
    want = {(i, p) for i, t in enumerate(texts) for p in phrases if p in t.lower()}
    assert got == want


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_pairs_of_repeated_keys_alone_are_made_distinct(spark, sent, monkeypatch):
    """Texts of a key that occurs once have no pair twice; those of other keys, null among them, are brought together."""
    monkeypatch.setattr(complaints, "TASK_TEXTS", 3)
    table = spark.createDataFrame([("lot",), ("ot",), ("bad box",)] * 2, "phrase string").localCheckpoint()
    text = "a lot and a slot, a lot of pilots: bad box bad box"
    rows = [(1, text), (2, text), (2, text), (2, "lot"), (None, text), (None, "bad box"), (3, "none"), (4, None), (5, ""), (6, "x")]
    df = spark.createDataFrame(rows, "id int, content string").localCheckpoint()
    got = [tuple(r) for r in complaints.match_phrases(df, table, sent=sent).collect()]
    assert sorted(got, key=str) == sorted(((i, p) for i in (1, 2, None) for p in ("lot", "ot", "bad box")), key=str)
    if sent:
        plans = [complaints.match_phrases(part, table)._jdf.queryExecution().executedPlan().toString() for part in (df.filter("id = 1 or id > 2"), df)]
        assert ["hashpartitioning(key" in plan for plan in plans] == [False, True]


def test_phrases_are_filed_under_their_rarest_gap(spark):
    texts = ["one two three"] * 5 + ["two three four"] * 2 + ["xone two threes"]
    bodies = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key int, body string")
    gaps = complaints.phrase_gaps(spark.createDataFrame([("one two three four",), ("one two three",), ("four five",), ("solo",)], "phrase string"))
    filed = {r.phrase: (r.anchor, r.texts) for r in complaints.file_phrases(bodies, gaps, [(3, 3)]).collect()}
    assert filed == {"one two three four": ("ree fou", 2), "one two three": ("one two", 6)}


def test_only_candidate_texts_move(spark):
    bodies = spark.range(100_000).select(F.col("id").alias("key"), F.lit("text").alias("body"))
    wanted = bodies.filter("key % 1000 = 7").select("key")
    kept = {r.key for r in complaints._only_candidates(bodies, "key", wanted).select("key").collect()}
    assert {r.key for r in wanted.collect()} <= kept and len(kept) < 200


def test_keywords_inside_and_across_others_count_for_every_aspect(spark):
    dictionary = {"Service": ["service", "life time"], "Phone line": ["customer service line"], "Battery": ["battery life"], "Customer": ["customer"]}
    texts = ["The Customer Service Line was busy.", "What a battery life time!", "servicemen only", "customer, service; life"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    got = {}
    for r in aspects.aspect_contexts(df, "content", ["id"], dictionary).collect():
        got.setdefault(r.id, set()).add(r.aspect)
    assert got == {0: {"Service", "Phone line", "Customer"}, 1: {"Service", "Battery"}, 3: {"Service", "Customer"}}


def test_contexts_are_searched_once(spark):
    plan = aspects.aspect_contexts(spark.range(5).select("id", F.lit("the price").alias("content")), "content", ["id"])
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 1 and "Join" not in plan


def test_words_of_texts_stay_in_place_and_pairs_are_dealt_out_by_their_number(spark, monkeypatch):
    table = spark.createDataFrame([("lot",), ("bad box",)], "phrase string").localCheckpoint()
    rows = reviews(spark, *["a lot and a slot"] * 7, "bad box").localCheckpoint()
    monkeypatch.setattr(complaints, "TASK_TEXTS", 3, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = complaints.match_phrases(rows, table)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(_word" not in plan
    assert found.rdd.getNumPartitions() == 3
    assert got == sorted([(r.id, "lot") for r in rows.collect()[:7]] + [(rows.collect()[7].id, "bad box")])


def test_patterns_are_searched_in_generated_code(spark):
    """No lambda runs per row and the text is put in lower case once; a text without any pattern or without letters has none."""
    rows = reviews(spark, "POOR QUALITY, not worth it. Not worth it", "fine", None)
    found = complaints.complaint_matches(rows, keep=["content"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("lower(") == 1
    assert [(r.phrase, r.n_gram_type, r.aspect) for r in found.collect()] == [
        ("poor quality", "Bigram", "Build Quality"), ("not worth", "Bigram", "Price / Value")]
    assert [r[0] for r in rows.select(F.size(complaints.matched_patterns("content"))).collect()] == [2, 0, 0]


def test_words_that_begin_alike_share_a_branch():
    """The grouped alternation finds what the plain one finds, longest word first."""
    import re

    from reviewmill.functions import lexicon as lex
    from reviewmill.functions import text as tx

    words = [w for listed in lex.ASPECT_KEYWORDS.values() for w in listed]
    assert tx.one_of(["box", "bond", "cat"]) == "(?=[bc])(?:b(?:ond|ox)|c(?:at))"
    texts = [" ".join(words), "Charging-speed, CHARGER charged; boxes box. value4money worthless", "", "Delivery timed delivery time"]
    for pattern in (tx.one_of(words), tx.word_alternation(words)):
        assert [re.findall(rf"(?i)\b(?:{pattern})\b", t) for t in texts] == [
            re.findall(rf"(?i)\b(?:{tx.word_alternation(words)})\b", t) for t in texts]


def test_complaint_words_are_whole_words_of_a_phrase(spark):
    rows = spark.createDataFrame([("slow charger",), ("charger is SLOW",), ("slowly charged",), ("slow",), ("",), ("a slow\n",)], "p string")
    assert [r[0] for r in rows.select(rules.signals_complaint("p")).collect()] == [True, True, False, True, False, False]
    assert [r[0] for r in rows.select(rules.signals_complaint("p", [])).collect()] == [False] * 6
