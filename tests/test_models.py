"""Training, tuning, scoring and topics on small corpora."""

import math

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex
from reviewmill.operators import corpus, evaluation, features, models, ranking, scoring
from reviewmill.plans import jobs
from reviewmill.sources import sinks

GOOD = ["great battery", "love the quality", "works perfectly", "excellent value", "fast delivery and nice box"]
BAD = ["terrible battery", "poor quality", "stopped working", "waste of money", "late delivery and damaged box"]


@pytest.fixture(scope="module")
def sample(spark):
    rows = []
    for i in range(200):
        words = GOOD if i % 2 else BAD
        rows.append((i, float(i % 2), f"{words[i % 5]} but {words[(i // 5) % 5]} item{i % 17}"))
    df = spark.createDataFrame(rows, "id int, label double, review string")
    return corpus.with_clean_text(df, "review", "c").cache()


@pytest.fixture(scope="module")
def parts(sample):
    return ranking.split_by_key(sample, "id")


@pytest.fixture(scope="module")
def fitted(parts):
    return models.fit(parts[0], models.logistic_regression(), min_df=1.0, stop_words=lex.sentiment_stop_words())


@pytest.mark.parametrize("classifier", [models.naive_bayes, models.logistic_regression,
                                        lambda: models.linear_svc(maxIter=10),
                                        lambda: models.random_forest(numTrees=10, maxDepth=4)])
def test_every_classifier_beats_the_majority(parts, classifier):
    row = models.evaluate(models.fit(parts[0], classifier(), ngrams=(1,), dims=256), parts[1], "x").first()
    assert row.accuracy > 0.7 and row.recall == row.accuracy and row.roc_auc > 0.7
    assert row.tp + row.tn + row.fp + row.fn == parts[1].count()


def test_margin_is_flagged(parts):
    row = models.evaluate(models.fit(parts[0], models.linear_svc(maxIter=5), ngrams=(1,)), parts[1], "svc").first()
    assert row.roc_auc_note == "(margin-based, uncalibrated)"


def test_feature_sizes_follow_the_ngrams(sample):
    from pyspark.ml import Pipeline

    sizes = []
    for n in ((1,), (1, 2), (1, 2, 3)):
        model = Pipeline(stages=features.tfidf_stages(n, dims=64)).fit(sample)
        sizes.append(model.transform(sample).first().features.size)
        assert sizes[-1] == 64 * len(n)
    assert sizes == sorted(sizes) and len(set(sizes)) == 3


def test_feature_table_adds_up_the_weights(sample):
    n = sample.count()
    table = features.tfidf_table(sample, "id").groupBy("term").agg(F.count(F.lit(1)).alias("d"), F.sum("tfidf").alias("s"))
    want = {r.term: (r.d, r.s / n) for r in table.collect()}
    got = {r.term: (r.documents, r.mean_tfidf) for r in features.feature_table(sample, "id").collect()}
    assert got.keys() == want.keys()
    assert all(got[t][0] == want[t][0] and abs(got[t][1] - want[t][1]) < 2e-5 for t in got)


def test_hashed_weights_equal_the_table(sample, spark):
    from pyspark.ml import Pipeline

    model = Pipeline(stages=features.tfidf_stages((1,), min_df=2.0)).fit(sample)
    places = {r.term: r["index"] for r in features.term_index(model, sample).collect()}
    assert len(set(places.values())) == len(places)  # no two share a place here
    vectors = {r.id: r.features for r in model.transform(sample).collect()}
    for r in features.tfidf_table(sample, "id").collect():
        assert vectors[r.id][places[r.term]] == pytest.approx(r.tfidf, abs=1e-5)


def test_closed_form_bayes_equals_the_fitted_one(parts):
    train, test = parts
    terms = models.bayes_terms(train, "id", min_df=1)
    mine = {r.id: r.prediction for r in models.bayes_predict(test, "id", terms, train).collect()}
    size = terms.count()
    fitted = models.fit(train, models.naive_bayes(), ngrams=(1,), min_df=1.0)
    theirs = {r.id: r.prediction for r in fitted.transform(test).collect()}
    assert mine == theirs and size > 20
    prior = models.bayes_predict(test.withColumn("clean_text", F.lit("unheard")), "id", terms, train).select("score").distinct()
    assert prior.count() == 1


def test_a_task_takes_apart_few_bytes_of_text(sample, monkeypatch):
    want = sorted(tuple(r) for r in features.feature_table(sample, "id", ngrams=(1, 2)).collect())
    size = sample.agg(F.sum(F.octet_length("clean_text"))).first()[0]
    monkeypatch.setattr(features, "TASK_TEXT", size // 40)
    counts = features.term_frequencies(sample, "id")
    assert counts.select(F.spark_partition_id()).rdd.getNumPartitions() >= 40  # Spark would have merged them
    assert sorted(tuple(r) for r in features.feature_table(sample, "id", ngrams=(1, 2)).collect()) == want


def test_rare_and_hot_terms_give_one_table(sample, monkeypatch):
    want = sorted(tuple(r) for r in features.tfidf_table(sample, "id").collect())
    monkeypatch.setattr(features, "HOT_TERMS", 3)
    assert sorted(tuple(r) for r in features.tfidf_table(sample, "id").collect()) == want


def test_tuning_returns_the_grid_and_a_refit(parts):
    base = models.logistic_regression(maxIter=5)
    grid = models.lr_grid(base)
    assert len(grid) == 10 and len(models.svc_grid(models.linear_svc())) == 5
    model, table = models.tune(parts[0], "id", base, grid[:3], final_iterations=10, ngrams=(1,), min_df=1.0)
    assert table.count() == 3 and model.stages[-1].getMaxIter() == 10


def test_weighted_fit_sees_weights(parts):
    skewed = parts[0].filter("label = 1 or id % 10 = 0")
    model = models.weighted_fit(skewed, models.logistic_regression(maxIter=5), ngrams=(1,), min_df=1.0)
    assert model.stages[-1].getOrDefault("weightCol") == "class_weight"
    assert evaluation.class_balance(skewed).first().use_weights


def test_sweep_records_failures(parts):
    table = models.sweep(parts[0], parts[1], [
        ("ok", models.naive_bayes(), dict(ngrams=(1,))),
        ("bad", models.naive_bayes(), dict(ngrams=(1,), input_col="missing")),
    ])
    rows = {r.experiment: r.asDict() for r in table.collect()}
    assert rows["ok"]["error"] is None and rows["ok"]["accuracy"] is not None
    assert rows["bad"]["accuracy"] is None and "missing" in rows["bad"]["error"]
    assert evaluation.best_experiment(table.filter("error is null").select("experiment", "accuracy", "f1")).first().experiment == "ok"


def test_sweep_query_fails_with_a_configuration(parts, monkeypatch):
    """A configuration that fails is no result with a row less."""
    from reviewmill.catalog import modelling

    tried, timed_fit = [], models.timed_fit

    def broken(train, classifier, stored=False, **options):
        tried.append(options["ngrams"])
        if options["min_df"] == 2.0:
            raise ValueError("out of room")
        return timed_fit(train, classifier, stored, **options)

    monkeypatch.setattr(modelling, "split", lambda v: parts)
    monkeypatch.setattr(models, "timed_fit", broken)
    with pytest.raises(RuntimeError, match="1 of 3 .* 20k, minDF 2: out of room"):
        modelling._sweep(None)
    assert len(tried) == 3
    monkeypatch.setattr(models, "timed_fit", timed_fit)
    rows = modelling._sweep(None).collect()
    assert [r.experiment for r in rows] == ["20k, minDF 2", "50k, minDF 5", "1+2+3-grams"] and all(r.agrees and r.total for r in rows)


def test_top_terms(parts, spark):
    model = models.fit(parts[0], models.naive_bayes(), ngrams=(1,))
    best = [r.term for r in models.top_terms(model, parts[0], 5).filter("class = 'positive'").collect()]
    assert {"great", "love", "excellent", "perfectly", "nice", "fast", "value", "works"} >= set(best)


def test_scoring_applies_the_guardrail(spark, fitted):
    rows = spark.createDataFrame(
        [(1, "I love this product! It is amazing, excellent, and works perfectly."), (2, "This is terrible waste, never buy"),
         (3, "!!!"), (4, "great battery, would not buy again"), (5, None)], "id int, review string")
    got = {r.id: r for r in scoring.predict(rows, fitted, "review", ["id"]).collect()}
    assert got.keys() == {1, 2, 3, 4, 5}
    empty = [got.pop(3), got.pop(5)]
    assert all((r.prediction, r.sentiment, r.confidence, r.guardrail) == (None, None, None, False) for r in empty)
    assert got[1].sentiment == "POSITIVE" and got[1].confidence >= 50
    assert got[2].sentiment == "NEGATIVE" and got[4].sentiment == "NEGATIVE"
    for r in got.values():
        assert r.prob_positive + r.prob_negative == pytest.approx(100, abs=0.11)
        assert not r.guardrail or (r.confidence, {r.prob_positive, r.prob_negative}) == (98.0, {98.0, 2.0})


def test_aspects_of_a_mixed_review(spark, fitted):
    rows = spark.createDataFrame([(1, "The battery life is terrible but the build quality is excellent."),
                                  (2, "I really enjoyed reading this book.")], "id int, review string")
    got = {(r.id, r.aspect): r.sentiment for r in scoring.aspect_predictions(rows, fitted, "review", ["id"]).collect()}
    assert got == {(1, "Battery"): "NEGATIVE", (1, "Build Quality"): "POSITIVE"}


def test_saved_model_scores_the_same(spark, fitted, parts, tmp_path):
    path = str(tmp_path / "m")
    assert not sinks.save_model(fitted, path, score=0.7, best=0.8)
    assert sinks.save_model(fitted, path, score=0.9, best=0.8)
    again = sinks.load_model(path)
    a, b = (sorted((r.id, r.prob_positive) for r in scoring.predict(parts[1], m, "review", ["id"]).collect())
            for m in (fitted, again))
    assert a == b


def test_error_report(parts, fitted):
    report = jobs.error_report(fitted, parts[1], "id")
    summary = report["summary"].first()
    assert summary.total == parts[1].count() == summary.correct + summary.incorrect
    assert summary.incorrect == summary.false_positives + summary.false_negatives
    assert report["length"].agg(F.sum("total")).first()[0] == summary.total


def test_topics(spark, sample):
    topics = models.lda_topics(sample, "review", k=3, iterations=3, terms=4, dims=256)
    assert topics.count() == 12 and topics.select("topic_id").distinct().count() == 3
    weights = models.topic_weights(topics).collect()
    assert all(len(r.top_terms.split(", ")) == 4 and 0 < r.top_weight <= 1.01 for r in weights)
    assert models.lda_topics(sample.filter("id < 0"), "review").count() == 0


def test_coherence_counts_texts_with_both_terms(spark):
    texts = ["apple pear plum", "apple pear", "apple stone", "plum stone stone", "apple"]
    tokens = spark.createDataFrame([(n, t.split()) for n, t in enumerate(texts)], "row long, tokens array<string>")
    terms = spark.createDataFrame([(1, 1, "apple"), (1, 2, "pear"), (1, 3, "plum"), (2, 1, "stone"), (2, 2, "pear")], "topic_id long, position long, term string")
    got = {r.topic_id: r.coherence for r in models.topic_coherence(terms, tokens).collect()}
    assert got == {1: pytest.approx(math.log(3 / 4) + math.log(2 / 4) + math.log(2 / 2), abs=1e-6), 2: pytest.approx(math.log(1 / 2), abs=1e-6)}
    dealt = {r.row: r.tokens for r in models.shuffled_tokens(tokens).collect()}
    assert sorted(w for t in dealt.values() for w in t) == sorted(" ".join(texts).split())
    assert all(len(dealt[n]) == len(t.split()) for n, t in enumerate(texts))


def test_topics_of_a_shuffled_corpus_score_lower(spark):
    kinds = ["wheel engine road driver brake garage", "flour sugar butter oven cake recipe", "violin concert chorus melody singer stage"]
    rows = [(n, " ".join(kinds[n % 3].split()[(n // 3 + k) % 6] for k in range(4))) for n in range(300)]
    found = models.fit_topics(spark.createDataFrame(rows, "id int, text string"), "text", k=3, iterations=20, terms=4, dims=512)
    score = lambda tokens: models.topic_coherence(found.terms, tokens).agg(F.avg("coherence")).first()[0]
    assert score(found.tokens) > score(models.shuffled_tokens(found.tokens)) + 1


def test_shares_of_topics_add_up(spark, sample):
    found = models.fit_topics(sample, "review", k=3, iterations=3, dims=256)
    shares = models.topic_shares(found).collect()
    assert len(shares) == sample.count() and all(abs(sum(r.shares) - 1) < 1e-6 for r in shares)


def test_analysis_of_single_reviews(spark, fitted):
    text = "Charging takes all night, yet I like the sturdy metal design. After a month it stopped working."
    rows = spark.createDataFrame([(1, text), (2, "great value"), (3, None), (2, "great value")], "id int, review string")
    found = scoring.analyze(rows, fitted, "review", ["id"]).collect()
    assert sorted(r.id for r in found) == [1, 2, 2, 3]
    got = {r.id: r for r in found}
    assert [a.aspect for a in got[1].aspects] == ["Battery", "Build Quality"] and [c.phrase for c in got[1].complaints] == ["stopped working"]
    alone = {r.id: r.sentiment for r in scoring.predict(rows, fitted, "review", ["id"]).collect()}
    assert {k: r.sentiment for k, r in got.items()} == alone and got[3].aspects == []
    contexts = {(r.id, r.aspect): (r.sentiment, r.confidence) for r in scoring.aspect_predictions(rows, fitted, "review", ["id"]).collect()}
    assert {(r.id, a.aspect): (a.sentiment, a.confidence) for r in found for a in r.aspects} == contexts


def test_places_of_whole_texts_are_those_of_the_vectors(spark):
    """Terms of every length up to some blocks of four bytes, with stop words between them and texts that keep none."""
    import pyarrow as pa
    from pyspark.ml import PipelineModel

    from reviewmill.functions import hashing

    texts = ["", "the", "a bb ccc dddd eeeee ffffff the ggggggg hhhhhhhh iiiiiiiii", "not_good not_good battery", "the cat of the house", "x"]
    stages = features.tfidf_stages((1, 2, 3), dims={1: 50, 2: 64, 3: 7})[:-1]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "id int, clean_text string")
    want = {r.id: {n: v for n, v in enumerate(r.counts.toArray()) if v} for r in PipelineModel(stages=stages).transform(rows).collect()}
    owner, places = hashing.text_places(pa.array(texts), pa.array(lex.english_stop_words()), [(1, 50), (2, 64), (3, 7)])
    got = {n: {} for n in range(len(texts))}
    for n, place in zip(owner.tolist(), places.tolist()):
        got[n][place] = got[n].get(place, 0) + 1
    assert got == want
    parts = hashing.slices(pa.array([*texts, None, "yy"]), 20)
    assert pa.concat_arrays(parts).to_pylist() == [*texts, None, "yy"] and len(parts) > 2 and hashing.slices(pa.array([], pa.string()))[0].to_pylist() == []


def test_linear_models_score_as_the_library_does(spark, fitted, monkeypatch):
    """All texts of a row are scored in one pass over Arrow batches; the stages of the model, one text after the other, give the same."""
    texts = ["The charger is awful, but I don’t recommend the price!", None, "", "  ", "Очень хорошо", "great", "not good, would not buy again",
             "LOVE IT. The battery life is poor; delivery was late, yet the design is fine and support helped\nnever", "the and of"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, review string")
    found = {}
    for name in ("weights", "stages"):
        if name == "stages":
            monkeypatch.setattr(scoring, "_linear", lambda model: None)
        out = [scoring.analyze(rows, fitted, "review", ["id"]), *[scoring.predict(rows, fitted, "review", ["id"], variant) for variant in "abc"],
               scoring.predict(rows, fitted, "review", ["id"], legacy_guardrail=True), scoring.aspect_predictions(rows, fitted, "review", ["id"])]
        found[name] = [sorted(map(str, df.collect())) for df in out]
        plan = out[0]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == (name == "weights")
    assert found["weights"] == found["stages"]


def test_analysis_keeps_columns_of_any_name(spark, fitted):
    names = ["_text", "_spelled", "_any", "kept", "body", "own", "clean_text", "features", "tokens", "found", "context_0", "pieces", "raw", "a.b"]
    rows = spark.createDataFrame([(*range(len(names)), "the price is bad")], ", ".join(f"`{n}` int" for n in names) + ", review string")
    for out in (scoring.predict(rows, fitted, "review", names), scoring.analyze(rows, fitted, "review", names)):
        assert out.columns[:len(names)] == names and tuple(out.first())[:len(names)] == tuple(range(len(names)))
    assert scoring.predict(rows.withColumn("prediction", F.lit("mine")), fitted, "review", ["prediction", "raw"]).columns.count("prediction") == 1


def test_analysis_has_no_exchange(spark, fitted):
    rows = spark.range(10).select("id", F.lit("the price is bad").alias("review"))
    plan = scoring.analyze(rows, fitted, "review", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_texts_are_taken_apart_once_for_a_fit(spark):
    """One stage is fitted, on stored counts; its weights are those of each n-gram size fitted by itself."""
    from pyspark.ml import Estimator, Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = spark.createDataFrame([(0, 1.0, "good sturdy good box"), (1, 0.0, "bad box"), (2, 1.0, "good sturdy box"), (3, 0.0, "")],
                                 "id int, label double, clean_text string")
    assert sum(isinstance(stage, Estimator) for stage in features.tfidf_stages((1, 2))) == 1
    weights = {}
    for n in ((1,), (2,), (1, 2)):
        found = Pipeline(stages=features.tfidf_stages(n, dims=32, min_df=1.0)).fit(rows).transform(rows)
        weights[n] = [list(r[0]) for r in found.orderBy("id").select(vector_to_array("features")).collect()]
    assert weights[1, 2] == [a + b for a, b in zip(weights[1,], weights[2,], strict=True)]
    model = models.fit(rows, models.naive_bayes(), dims=32, min_df=1.0)
    assert [list(r[0]) for r in model.transform(rows).orderBy("id").select(vector_to_array("features")).collect()] == weights[1, 2]


def test_stored_counts_are_those_of_the_stages(spark, monkeypatch):
    """Texts as they come, not only cleaned ones; a fit stores the counts and nothing else."""
    from pyspark.ml import PipelineModel

    from reviewmill import session

    texts = ["", " ", "  two  blanks ", "the", "Good GOOD\tÉté good\u00a0box", "a bb ccc dddd eeeee the ffffff bb ccc", "\n", "Очень хорошо"]
    rows = spark.createDataFrame([(n, float(n % 2), t) for n, t in enumerate(texts)], "id int, label double, clean_text string")
    for sizes, dims in (((1,), 50), ((1, 2), 1 << 16), ((1, 2, 3), {1: 50, 2: 64, 3: 7})):
        stages = features.tfidf_stages(sizes, dims=dims)
        found = features.counted(stages, rows, ["id", "label"], "counts")
        want = PipelineModel(stages=stages[:-1]).transform(rows)
        got, plain = ({r.id: (r.label, r.counts.size, {int(n): r.counts[int(n)] for n in r.counts.toArray().nonzero()[0]}) for r in df.collect()}
                      for df in (found, want.select("id", "label", "counts")))
        assert got == plain and found.schema["counts"].dataType == want.schema["counts"].dataType
        assert found.schema["counts"].metadata == {"ml_attr": {"num_attrs": plain[0][1]}}
    labels, publish = [], session.publish
    monkeypatch.setattr(session, "publish", lambda df, label, *rest: (labels.append(label), publish(df, label, *rest))[1])
    models.fit(rows, models.naive_bayes(), min_df=1.0)
    assert labels == ["train-counts"]


def test_documents_of_one_row_group_are_dealt_out(spark, tmp_path):
    """What is stored for fits lies in several files, so that every later step has several tasks."""
    from reviewmill.catalog import modelling
    from reviewmill.catalog.views import Views

    texts = spark.createDataFrame([(n, f"src{n % 3}", f"word{n} is a fine text of number {n}", "en") for n in range(200)],
                                  "doc_id bigint, source string, text string, lang string")
    texts.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    texts.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    v = Views(spark, str(tmp_path))
    tasks = lambda df: df.select(F.spark_partition_id()).distinct().count()
    assert tasks(v.documents) == 1 and tasks(v.dealt_documents) > 1
    assert sorted(v.dealt_documents.collect()) == sorted(v.documents.collect())
    train, test = modelling.split(v)
    assert train.count() + test.count() == 200
    assert train.select(F.input_file_name()).distinct().count() > 1
