import json

import corpus_pipeline
from conftest import SF
from reviewmill.llm import decontam, linededup, neardup


def test_stages_keep_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns and out.schema.names == docs.schema.names, name
        before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
        if name == "language":
            assert set(before) == set(after)
        elif name == "near_duplicates":
            linked = neardup.link(docs, width=5, percent=80).collect()
            assert set(after) == {r.component_id for r in linked}
        elif name == "repeated_passages":
            want = {r.doc_id: r.text for r in linededup.dedup(docs).collect() if r.text.strip()}
            assert after == want
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            leaks = {r.doc_id for r in decontam.contained(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert leaks and set(after) == set(before) - leaks
        docs = out


def test_rejected_documents_go(spark):
    rows = [(1, "The house and the garden are here", "en"), (2, None, "en"), (3, "123 ...", None), (4, "", "de")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, SF).collect()} == {1}


UNLEARNED = {
    "Greek": "Το παλιό σπίτι στέκεται δίπλα στο ποτάμι και κανείς δεν ζει πια εκεί εδώ και πολλά χρόνια.",
    "Russian": "Старый дом стоит у реки, и уже много лет в нём никто не живёт, только птицы прилетают весной.",
    "Japanese": "古い家は川のそばに立っていて、長い間だれも住んでいない。春になると鳥だけがやって来る。",
}


def test_unlearned_languages_go_and_clean_documents_stay(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    strange = spark.createDataFrame([(10_000_000 + n, text * 3, None, "x", len(text) * 3) for n, text in enumerate(UNLEARNED.values())], given.schema)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, given.unionByName(strange), SF).collect()}
    assert kept == {r.doc_id for r in given.collect()}


def test_columns_of_the_documents_stay(spark):
    passage = ("The old mill stood by the river. Nobody had ground corn there for many years. Its wheel was broken and the roof let in the rain. "
               "Children came to play in the empty rooms. In winter the snow lay on the floor.")
    rows = [(1, f"First words. {passage}", "a", 5, 9), (2, f"Other words come first. {passage}", "b", 6, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed string, Kept int, n_chars long")
    out = corpus_pipeline.repeated_passages(spark, docs, SF)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and (got[2].removed, got[2].Kept) == ("b", 6) and got[2].n_chars == len(got[2].text) < len(rows[1][1])
    assert corpus_pipeline.repeated_passages(spark, docs.limit(0), SF).count() == 0


def test_run_is_repeatable(spark):
    first, second = ({json.dumps(r.asDict()) for r in corpus_pipeline.run(spark, SF).collect()} for _ in range(2))
    assert first == second and len(first) > 100
