import random
from collections import defaultdict

import pytest

from conftest import SF
from reviewmill.llm import linededup, queries

PASSAGE = ("The old mill stood by the river. Nobody had ground corn there for many years. Its wheel was broken and the roof let in the rain. "
           "Children came to play in the empty rooms.")


def brute(rows):
    """Doc -> text without repeated runs, by sorting all units."""
    first = defaultdict(lambda: None)
    for key, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for n, unit in enumerate(linededup.units(text or "")):
            normal = " ".join((text[unit[0]:unit[1]]).encode().lower().decode().split())
            if first[normal] is None:
                first[normal] = (key, n)
    out = {}
    for key, text in rows:
        parts, run, gone = linededup.units(text or ""), [], set()
        for n, unit in [*enumerate(parts), (len(parts), None)]:
            normal = unit and " ".join((text[unit[0]:unit[1]]).encode().lower().decode().split())
            if unit and key is not None and first[normal] != (key, n):
                run.append(n)
            else:
                if sum(parts[i][2] for i in run) >= linededup.MIN_RUN:
                    gone.update(run)
                run = []
        out[key] = text and "".join(
            text[(0 if n == 0 else unit[0]):(parts[n + 1][0] if n + 1 < len(parts) else len(text))]
            for n, unit in enumerate(parts) if n not in gone) if parts else text
    return out


def test_units_cover_all_words():
    text = " Hi there. Some longer sentence follows here\nshort\n\nEnd of it. a. b. c. d. e.\n"
    parts = linededup.units(text)
    assert [text[a:b] for a, b, _, _ in parts] == ["Hi there. Some longer sentence follows here", "short", "End of it. a.", "b. c. d. e."]
    assert [p[2] for p in parts] == [7, 1, 4, 4]
    assert linededup.units("") == linededup.units(" \n ") == []


def test_passage_inside_sentences_stays_once(spark):
    rows = [(5, f"Some words before it {PASSAGE} and some after it."), (7, f"Quite another text begins {PASSAGE} and goes on alone."),
            (6, PASSAGE), (8, "Best regards from the harbour office. " + PASSAGE[:33]), (9, None), (10, ""), (None, PASSAGE)]
    df = spark.createDataFrame([(k, t, "x", 1, 2) for k, t in rows], "doc_id long, text string, removed string, key int, marked int")
    out = linededup.dedup(df)
    assert out.columns == ["doc_id", "text", "key", "marked", "removed", "kept"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[5].text == rows[0][1] and got[None].text == PASSAGE and got[9].text is None and got[10].text == ""
    assert got[7].text == "Quite another text begins and goes on alone."
    assert got[6].text == "" and got[8].text == rows[3][1]
    for key, text in rows:
        if text and key:
            assert got[key].text == "".join(text[s.begin:s.until] for s in got[key].kept)
            assert sum(s.until - s.begin for s in got[key].kept + got[key].removed) == len(text)


@pytest.mark.parametrize("change", [str.upper, str.title, str.lower])
@pytest.mark.parametrize("lead", ["", "so", "well it is", "no. but", "he said to all of them that", "one two three four five six seven eight nine"])
def test_passage_without_sentences_is_found_at_any_offset(spark, change, lead):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(3, 8))) for _ in range(70)]
    passage = change(" ".join(words))
    rows = [(1, passage), (2, f"{change(lead)} {passage} {change('and so it goes on')}".strip())]
    got = {r.doc_id: r.text for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == passage
    assert len(got[2].split()) <= len(rows[1][1].split()) - 40


def test_scripts_without_blanks_are_counted_by_letters(spark):
    page = "古い水車小屋は川のそばに立っていた。長い間だれもそこで粉をひかなかった。屋根から雨がもれていた。"
    rows = [(1, page), (2, page), (3, f"これは別の話である。{page}そして終わりが来た。"), (4, "屋根から雨がもれていた。"), (5, "โรงสีเก่าตั้งอยู่ริมแม่น้ำมานานหลายปี"),
            (6, "โรงสีเก่าตั้งอยู่ริมแม่น้ำมานานหลายปี")]
    got = {r.doc_id: r.text for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: page, 2: "", 3: "これは別の話である。そして終わりが来た。", 4: rows[3][1], 5: rows[4][1], 6: ""}


def test_repeats_within_a_document_and_repeated_rows(spark):
    twice = f"{PASSAGE}\n{PASSAGE}"
    df = spark.createDataFrame([(1, twice), (2, "unlike anything else here"), (2, "unlike anything else here")], "doc_id long, text string")
    got = [r.text for r in linededup.dedup(df).orderBy("doc_id").collect()]
    assert got == [PASSAGE + "\n", "unlike anything else here", "unlike anything else here"]
    assert linededup.dedup(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    got = {r.doc_id: r.text for r in queries.op7_substring_dedup(spark, SF).collect()}
    want = brute(rows)
    assert {k for k in want if want[k] != dict(rows)[k]}
    assert got == want


@pytest.mark.parametrize("min_words", [1, 8, 25])
def test_repeated_sentences_by_their_own_segmentation(spark, min_words):
    """Texts are made of known sentences, so what must go follows from the sentences alone."""
    rng = random.Random(min_words)
    say = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n)).capitalize() + "."
    pool = [say(n) for n in (5, 9, 26, 31, 40)]
    docs = {}
    for key in range(60):
        docs[key] = [rng.choice(pool) if rng.random() < 0.3 else say(rng.randint(5, 30)) for _ in range(rng.randint(1, 8))]
    first = {}
    for key, sentences in docs.items():
        for n, sentence in enumerate(sentences):
            first.setdefault(sentence, (key, n))
    want = {}
    for key, sentences in docs.items():
        runs, kept = [], []
        for n, sentence in enumerate(sentences):
            if first[sentence] == (key, n):
                kept += runs if sum(len(r.split()) for r in runs) < min_words else []
                runs = []
                kept.append(sentence)
            else:
                runs.append(sentence)
        kept += runs if sum(len(r.split()) for r in runs) < min_words else []
        want[key] = " ".join(kept)
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in docs.items()], "doc_id long, text string")
    got = {r.doc_id: r.text.strip() for r in linededup.dedup(df, min_words=min_words).collect()}
    assert got == want
