import random

import pytest

from conftest import SF
from reviewmill.llm import queries, toxicity

BIG = SF.replace("sf0.001", "sf0.01")
PLAIN = ["you are an idiot and a moron", "what a worthless clown he is", "the garden is lovely this morning", "they read a book in the library",
         "pathetic people write pathetic words", "the train leaves the station at noon"] * 6


@pytest.fixture(scope="module")
def letters(spark):
    docs = spark.createDataFrame([(t,) for t in PLAIN], "text string")
    return toxicity.Letters([(r.trigram, r.n) for r in toxicity.letter_counts(docs).collect()])


@pytest.mark.parametrize("hidden, plain", [
    ("1d1ot", "idiot"), ("id!0t", "idiot"), ("i.d.i.o.t", "idiot"), ("idioooot", "idiot"), ("m0r0n", "moron"), ("p@thetic", "pathetic"),
    ("cl*o*wn", "clown"), ("w0rth1ess", "worthless"), ("i d i o t", "idiot"), ("lllibrary", "library"), ("cl-0-wn", "clown")])
def test_hidden_words_are_restored(letters, hidden, plain):
    assert letters.restore(hidden) == plain


PROSE = ["a boob and a fool met", "leet is the speech of a fool", "the bastard is a worthless idiot", "stupid people and an asshole",
         "what an ass", "such shit is stupid", "the garden is lovely", "an idiot and a moron", "he is worthless", "they call the taxi", "all people and all ideas"] * 20


@pytest.mark.parametrize("token, words", [
    ("b00b", "boob"), ("l33t", "leet"), ("f00l", "fool"), ("id10t", "idiot"), ("b4574rd", "bastard"), ("5h17", "shit"), ("5tupid", "stupid"),
    ("worthle55", "worthless"), ("$tupid", "stupid"), ("'$tupid',", "stupid"), ("@sshole", "asshole"), ("a$$", "ass"), ("!diot", "idiot"),
    ("garden!", "garden"), ("(garden)", "garden"), ("(all", "all"), ("taxi!!", "taxi"), ("idiot!?!", "idiot"), ("a s s", "ass"),
    ("$5", "5"), ("2024.", "2024"), ("!!!", "")])
def test_whole_tokens_are_read(spark, token, words):
    docs = spark.createDataFrame([(t,) for t in PROSE], "text string")
    reader = toxicity.Reader(toxicity.Letters([(r.trigram, r.n) for r in toxicity.letter_counts(docs).collect()]))
    assert " ".join(word for part in reader.tokens(token) for word in reader.words(part)) == words


def test_restored_text(spark, letters):
    df = spark.createDataFrame([("You 1d1ot, m o r o n! The book.", 1), (None, 2), ("", 3), ("a a a a", 4)], "text string, restored int")
    out = toxicity.restore(df, letters)
    assert out.columns == ["text", "restored"]
    assert [r.restored for r in out.collect()] == ["you idiot moron the book", None, "", "a a a a"]


def test_scores(spark):
    rng, common = random.Random(4), [word for t in PLAIN[2::3] for word in t.split()]
    rows = []
    for n in range(120):
        words = rng.choices(common, k=12)
        words[3] = rng.choice(["idiot", "moron", "clown"]) if n % 3 == 0 else words[3]
        rows.append((n, " ".join(words), int(n % 3 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    odd = [(1, None), (2, ""), (3, "you 1d1ot"), (4, "the g4rden"), (5, "word " * 50_000 + "i d i o t"), (5, "word " * 50_000 + "i d i o t"), (None, "clown idiot")]
    out = toxicity.score(spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "'x' AS SCORE"), model)
    assert out.columns == ["doc_id", "text", "score"]
    got = [r.score for r in out.collect()]
    assert got[0] == got[1] < 0.5 and got[2] > 0.5 and got[3] < 0.5 and got[4] == got[5] > 0.5 and got[6] > 0.5
    empty = docs.limit(0)
    assert toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert toxicity.score(docs, None).agg({"score": "max"}).first()[0] == 0 and toxicity.score(empty, model).count() == 0


def test_held_out_documents(spark):
    rows = queries.op9_toxicity(spark, BIG).join(queries.table(spark, BIG, "labels"), "doc_id", "left").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert len(held) > 50 and sum(r.predicted == r.toxic for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
