import pytest

from conftest import SF
from reviewmill.llm import langid, queries

BIG = SF.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def judged(spark):
    return queries.op1_language_id(spark, BIG).join(queries.table(spark, BIG, "documents").select("doc_id", "lang", "text"), "doc_id").collect()


def test_held_out_accuracy(judged):
    held = [r for r in judged if r.held_out]
    assert 250 < len(held) < 420
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in judged) and len(judged) == 1000


def test_no_clean_document_scores_low(judged):
    assert all(r.score >= 0.35 for r in judged)


def test_whole_text_counts(spark):
    english, german = "the house and the garden ", "der Hund und die Katze "
    rows = [(i, (english if i % 2 else german) * 20, "en" if i % 2 else "de") for i in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    long = english * 40 + german * 4000
    odd = [(1, None), (2, ""), (3, "123 .,;\n\t"), (4, long), (5, long), (6, "der Hund"), (None, english)]
    df = spark.createDataFrame([(a, b, 0, "x") for a, b in odd], "doc_id long, text string, SCORE int, extra string")
    out = langid.predict(df, model)
    assert out.columns == ["doc_id", "text", "extra", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4] == got[5] and got[4][0] == "de" and got[6][0] == "de" and got[None][0] == "en"


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.fit(empty) is None
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert langid.predict(df, None).first().lang_pred == "und"
    assert langid.predict(empty, None).count() == 0
