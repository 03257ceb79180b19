"""Cleaning, tokens and small scalars on hand-written cases and properties."""

import collections

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex
from reviewmill.functions import rules
from reviewmill.functions import text as tx


def apply(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


CONTRACTED = "I don't like this, it's bad and won't work. Couldn't be worse! I’m happy though."


@pytest.mark.parametrize("variant,text,expected", [
    ("a", "Hello,  WORLD!! 42\tok", "hello world 42 ok"),
    ("b", CONTRACTED, "i do not like this it is bad and will not work could not be worse i am happy though"),
    ("c", "This is not good, nobody was happy, and never have I seen such a terrible thing.",
     "this is not_good nobody was happy and never_have i seen such a terrible thing"),
    ("c", "not no good", "not_no good"),
])
def test_variants(spark, variant, text, expected):
    assert apply(spark, [text], tx.clean("t", variant)) == [expected]


@pytest.mark.parametrize("short,full", [
    *lex.IRREGULAR_CONTRACTIONS.items(),
    *[(f"{v}n't", f"{v} not") for v in "could would should must do does did is was were are have has had might".split()],
    *[(f"{stem}{suffix}", f"{stem} {full}") for suffix, (stems, full) in lex.SUFFIX_CONTRACTIONS.items()
      for stem in stems.split()],
])
def test_every_contraction(spark, short, full):
    assert apply(spark, [f"So {short.upper()} ok"], tx.clean_expanded("t")) == [f"so {full} ok"]


def test_unlisted_contraction_only_loses_its_apostrophe(spark):
    assert apply(spark, ["the dog's toy", "she's"], tx.clean_expanded("t")) == ["the dog s toy", "she s"]


def test_cleaning_is_idempotent_and_marking_keeps_characters(spark, views):
    rows = views.documents.select(
        tx.clean_basic("review").alias("a"), tx.clean_expanded("review").alias("b"), tx.clean_marked("review").alias("c"))
    again = rows.select("a", "b", "c", tx.clean_basic("a").alias("a2"), tx.clean_expanded("b").alias("b2")).collect()
    for r in again:
        assert r.a == r.a2 and r.b == r.b2
        plain, marked = (collections.Counter(s.replace(" ", "").replace("_", "")) for s in (r.b, r.c))
        assert plain == marked


def test_word_count_ignores_blank_text(spark):
    assert apply(spark, ["", "a", "a b  c"], tx.word_count(tx.clean_basic("t"))) == [0, 1, 3]


def test_tokens_and_ngrams(spark):
    tokens = tx.content_tokens("t", ["the"])
    assert apply(spark, ["the big big 100 ox cat", ""], tokens) == [["big", "big", "cat"], []]
    texts = ["one two three", "one two", "one"]
    assert apply(spark, texts, tx.ngrams(F.split("t", " "), 2)) == [["one two", "two three"], ["one two"], []]
    assert apply(spark, texts, tx.ngrams(F.split("t", " "), 3)) == [["one two three"], [], []]


def test_stop_words_keep_four_negations():
    dropped = set(lex.english_stop_words()) - set(lex.sentiment_stop_words())
    assert dropped == {"no", "nor", "not", "cannot"}  # all the preserved list changes in practice


def test_has_words_agrees_with_cleaning(spark):
    texts = ["!!!", "é", "a", "7", "K", "İ", "   ", "Ça"]
    kept = apply(spark, texts, tx.has_words("t"))
    clean = apply(spark, texts, tx.clean_expanded("t"))
    assert kept == [c != "" for c in clean]


def test_shorten_slug_parameter(spark):
    assert apply(spark, ["abcdef", "abc"], tx.shorten("t", 3)) == ["abc...", "abc"]
    assert apply(spark, ["Acme Toys/Games"], tx.slug("t")) == ["acme-toys-games"]
    text = "regParam=0.05, maxIter=200"
    assert apply(spark, [text], tx.parameter("t", "regParam")) == ["0.05"]
    assert apply(spark, [text], tx.parameter("t", "maxIter")) == ["200"]
    assert apply(spark, [text], tx.parameter("t", "Param")) == [None]


def test_negation_flag_reads_unmarked_text(spark):
    marked, plain = tx.clean_marked("t"), tx.clean_expanded("t")
    assert apply(spark, ["It is not good"], rules.has_negation(marked)) == [False]
    assert apply(spark, ["It is not good"], rules.has_negation(plain)) == [True]


@pytest.mark.parametrize("text,now,before", [
    ("I would not buy again", 0, 0),
    ("I wouldn't buy again", 0, 1),
    ("I don't recommend it", 0, 1),
    ("It doesn't work", 0, None),
    ("Whatever, fine", None, 0),
    ("Works perfectly, I love it", 1, 1),
    ("plain words", None, None),
])
def test_guardrail_and_its_legacy_form(spark, text, now, before):
    assert apply(spark, [text], rules.guardrail("t")) == [now]
    assert apply(spark, [text], rules.guardrail("t", legacy=True)) == [before]


def test_a_border_is_tried_only_ahead_of_a_first_letter(spark):
    assert tx.border(["not", "no", "hardly"]) == r"(?=[hn])\b"
    assert tx.border([]) == tx.border([".x", "y"]) == tx.border(["", "y"]) == tx.border(["été"]) == r"\b"
    texts = ["not good", "knot good", "no  no never", "cannot", "_not x9", "9not it", "é not ok", "it's i'm iti'm they'd", "won't wwon't", "can't've", ""]
    plain = F.regexp_replace("t", rf"\b({'|'.join(lex.NEGATION_MARKERS)})\s+([a-z0-9]+)", "$1_$2")
    assert apply(spark, texts, tx.mark_negation("t")) == apply(spark, texts, plain)
    spelled = apply(spark, texts, tx.expand_contractions("t"))
    assert spelled[-4:] == ["it is i am iti'm they would", "will not wwo not", "cannot've", ""]
    custom = apply(spark, ["so-so .x b", "a .x b"], tx.mark_negation("t", [r"\.x", "so"]))
    assert custom == ["so-so .x b", "a .x b"]


@pytest.mark.parametrize("phrase,aspect", [
    ("waste money", "Price / Value"), ("stopped working", "General Dissatisfaction"),
    ("poor quality", "Build Quality"), ("battery died", "Battery"), ("arrived late", "Delivery / Packaging"),
])
def test_phrase_aspect(spark, phrase, aspect):
    assert apply(spark, [phrase], rules.phrase_aspect("t")) == [aspect]


def test_priority_order(spark):
    ranks = apply(spark, ["HIGH", "MEDIUM", "LOW"], rules.priority_rank("t"))
    assert ranks == sorted(ranks, reverse=True)


def test_search_takes_wildcards_literally(spark):
    assert apply(spark, ["100% cotton", "100 cotton"], rules.matches_any(["t"], "0% C")) == [True, False]
