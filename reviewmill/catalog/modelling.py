"""Feature, model and scoring queries.

Features and naive Bayes are checked exactly. The other fits return what SQL can know of them: the sizes of the split, that
counts and metrics agree, one row per review, probabilities that add up, guardrail rows, terms of the corpus.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import session
from reviewmill.catalog.corpus import SQL_A, SQL_C, sql_grams, sql_words
from reviewmill.catalog.mining import CLAUSES, CONTEXT_LIST, CONTEXTS, PATTERNS, guardrail_sql
from reviewmill.catalog.views import Views, with_views
from reviewmill.functions import lexicon as lex
from reviewmill.functions import rules
from reviewmill.operators import certificates, corpus, evaluation, features, forests, models, ranking, scoring
from reviewmill.plans import jobs
from reviewmill.sources import sinks


def labelled(v: Views, variant: str = "c"):
    """Labelled corpus, cleaned for training; dealt out before its texts are cleaned, since what is stored here is read as it lies."""
    ready = v.deal_documents(corpus.prepare(v.dealt_corpus))
    return corpus.with_clean_text(ready, "review", variant).select("doc_id", "label", "review", "clean_text")


def split(v: Views, variant: str = "c"):
    """Train and test rows of one stored table, so that cleaning and deduplication run once."""
    return ranking.split_by_key(session.publish(labelled(v, variant), "corpus"), "doc_id")


def _feature_table(ngrams):
    def run(v: Views):
        rows = corpus.with_clean_text(v.corpus, "review").select("doc_id", "clean_text")
        return features.feature_table(rows, "doc_id", ngrams=ngrams)
    return run


def _facts(measured: DataFrame) -> DataFrame:
    """Sizes of the test rows, and whether accuracy and recall follow from the confusion counts and the area is a share."""
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    share = F.round((F.col("tp") + F.col("tn")) / total, 4)
    same = (F.abs(F.col("accuracy") - share) < 1e-9) & (F.abs(F.col("recall") - share) < 1e-9) & F.col("roc_auc").between(0, 1)
    return measured.select("experiment", total.alias("total"), (F.col("tp") + F.col("fn")).alias("positives"),
                           (F.col("tn") + F.col("fp")).alias("negatives"), same.alias("agrees"))


#: The metrics of stored predictions, per class and then weighted by its size.
METRICS_SQL = """SELECT sum(hit) / sum(n) AS accuracy, sum(p * n) / sum(n) AS precision, sum(r * n) / sum(n) AS recall, sum(f * n) / sum(n) AS f1 FROM (
  SELECT n, hit, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM (
    SELECT n, hit, CASE WHEN named > 0 THEN hit / named ELSE 0 END AS p, hit / n AS r FROM (
      SELECT c, count(*) FILTER (WHERE label = c) AS n, count(*) FILTER (WHERE prediction = c) AS named, count(*) FILTER (WHERE label = c AND prediction = c) AS hit
      FROM {preds} LATERAL VIEW explode(array(0.0D, 1.0D)) t AS c GROUP BY c) WHERE n > 0))"""


def _evaluated(model, test: DataFrame, name: str) -> DataFrame:
    """The facts of a model, which agree only with metrics computed anew, in SQL and by the library, from the same stored predictions."""
    preds = models.stored_predictions(model, test)
    again = preds.sparkSession.sql(METRICS_SQL, preds=preds)
    area = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(preds)
    measured = models.evaluate(model, test, name, preds=preds)
    same = F.abs(F.col("roc_auc") - area) < 6e-5
    for metric in ("accuracy", "precision", "recall", "f1"):
        same = same & (F.abs(F.col(metric) - again.select(metric).scalar()) < 6e-5)
    return _facts(measured).join(measured.select("experiment", F.coalesce(same, F.lit(False)).alias("same")), "experiment").withColumn(
        "agrees", F.col("agrees") & F.col("same")).drop("same")


def _measured(classifier, **options):
    def run(v: Views):
        train, test = split(v)
        model = models.fit(train, classifier(), stored=True, **options)
        return _evaluated(model, test, classifier.__name__)
    return run


def _certified(model, train: DataFrame, measured: DataFrame, weight: str | None = None) -> DataFrame:
    """The facts of a linear model, which agree only if its loss and gradient on the training rows have vanished as well."""
    fitted = model.stages[-1]
    vectors = features.training_vectors(model, train, ["label", *([weight] if weight else [])])
    sure = certificates.holds(certificates.certificate(fitted, vectors, weight), not models.model_has_probability(fitted))
    return measured.withColumn("agrees", F.col("agrees") & sure.scalar())


def _linear(classifier):
    def run(v: Views):
        train, test = split(v)
        model = models.fit(train, classifier(), stored=True)
        return _certified(model, train, _evaluated(model, test, classifier.__name__))
    return run


def _forest(v: Views):
    """The facts of a forest, which agree only if its nodes are sound and joins with them predict every test row as the library does."""
    train, test = split(v)
    model = models.fit(train, models.random_forest(), stored=True, dims=4096)
    fitted = model.stages[-1]
    vectors = features.training_vectors(model, test, ["label"]).withColumn("row", F.monotonically_increasing_id())
    vectors = session.publish(vectors, "forest-rows")
    rows, entries = certificates.stored_entries(vectors)
    table = forests.nodes(fitted)
    depth = max(tree.depth for tree in fitted.trees)
    mine = forests.predictions(forests.leaves(rows, entries, table, fitted.getNumTrees, depth), table)
    theirs = fitted.transform(vectors).select("row", F.col("prediction").alias("theirs"))
    same = theirs.join(mine, "row", "left").agg(F.every(F.coalesce(F.col("prediction") == F.col("theirs"), F.lit(False)))).scalar()
    return _evaluated(model, test, "random_forest").withColumn("agrees", F.col("agrees") & forests.sound(table) & same)


def _bayes(v: Views):
    """Naive Bayes in closed form: confusion counts and accuracy on the test rows."""
    train, test = split(v)
    terms = models.bayes_terms(train, "doc_id")
    preds = models.bayes_predict(test, "doc_id", terms, train)
    hit, total = F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return evaluation.confusion(preds).withColumn("accuracy", F.round(hit / total, 4))


def _bayes_terms(v: Views):
    train, _ = split(v, "a")
    return models.bayes_terms(train, "doc_id").select("term", F.round("idf", 6).alias("idf"), F.round("weight", 6).alias("weight"))


def _tuned(classifier, grid):
    def run(v: Views):
        train, test = split(v)
        base = classifier(maxIter=100)
        model, _ = models.tune(train, "doc_id", base, grid(base), min_df=5.0, dims=1 << 14, stop_words=lex.sentiment_stop_words(), stored=True)
        return _evaluated(model, test, f"tuned {classifier.__name__}")
    return run


def _grid(v: Views):
    train, _ = split(v)
    base = models.logistic_regression(maxIter=100)
    _, table = models.tune(train, "doc_id", base, models.lr_grid(base), min_df=5.0, dims=1 << 14, stored=True)
    return table.select("params", F.col("accuracy").between(0, 1).alias("is_share"))


def _weighted(v: Views):
    train, test = split(v)
    model = models.weighted_fit(train, models.logistic_regression(), stored=True)
    return _certified(model, evaluation.with_class_weight(train), _evaluated(model, test, "weighted"), "class_weight")


def _sweep(v: Views):
    """Feature configurations of the second experiment series with one classifier (M3, M12); the query fails if one of them does."""
    train, test = split(v)
    stops = lex.sentiment_stop_words()
    plans = [
        ("20k, minDF 2", dict(ngrams=(1, 2), dims=20000, min_df=2.0)),
        ("50k, minDF 5", dict(ngrams=(1, 2), dims=50000, min_df=5.0)),
        ("1+2+3-grams", dict(ngrams=(1, 2, 3), dims={1: 50000, 2: 50000, 3: 20000}, min_df=5.0)),
    ]
    return _facts(models.sweep(train, test, [
        (name, models.logistic_regression(), {**options, "stop_words": stops}) for name, options in plans
    ], stored=True, strict=True))


def _preprocessing(v: Views):
    """Cleaning variants compared with one classifier."""
    rows = []
    for variant in "abc":
        train, test = split(v, variant)
        model = models.fit(train, models.logistic_regression(), stored=True)
        rows.append(_evaluated(model, test, f"variant {variant}"))
    return reduce(DataFrame.unionByName, rows)


def _falling(group: str, order: str, weight: str) -> Column:
    """Whether the weights of a group fall, or stay, in the given order."""
    sorted_ = F.transform(F.array_sort(F.collect_list(F.struct(order, weight))), lambda e: e[weight])
    return (sorted_ == F.reverse(F.array_sort(F.collect_list(F.col(weight))))).alias("falling")


def _lr_terms(v: Views):
    train, _ = split(v, "a")
    train = session.publish(train, "train")
    best = models.top_terms(models.fit(train, models.logistic_regression(), stored=True), train)
    known = features.term_frequencies(train, "doc_id").select("term").union(
        features.term_frequencies(train, "doc_id", n=2).select("term")).distinct().withColumn("_known", F.lit(True))
    return best.join(known, "term", "left").groupBy("class").agg(
        F.count(F.lit(1)).alias("terms"), F.every(F.coalesce("_known", F.lit(False))).alias("known"), F.every(F.col("score") >= 0).alias("scored"))


def _topics(v: Views):
    return models.lda_topics(v.dealt_documents, "review")


def _topic_facts(v: Views):
    from reviewmill.operators import complaints

    words = complaints.with_tokens(v.dealt_documents, "review", out="tokens").select(F.explode("tokens").alias("term")).distinct()
    topics = _topics(v).join(words.withColumn("_known", F.lit(True)), "term", "left")
    return topics.groupBy("topic_id").agg(
        F.count(F.lit(1)).alias("terms"), F.every(F.coalesce("_known", F.lit(False))).alias("known"), _falling("topic_id", "position", "weight"))


def _topic_weights(v: Views):
    weights = models.topic_weights(_topics(v))
    return weights.select("topic_id", "label", F.size(F.split("top_terms", ", ")).cast("bigint").alias("terms"),
                          F.col("top_weight").between(0, 1.001).alias("is_share"))


COHERENCE_SQL = """WITH held AS (SELECT row, t.topic_id, t.position, t.term FROM (SELECT DISTINCT row, explode(tokens) AS term FROM {tokens}) w JOIN {terms} t USING (term)),
alone AS (SELECT topic_id, position, count(*) AS n FROM held GROUP BY 1, 2),
both AS (SELECT a.topic_id, a.position AS p, b.position AS q, count(*) AS n FROM held a JOIN held b ON a.row = b.row AND a.topic_id = b.topic_id AND a.position < b.position GROUP BY 1, 2, 3)
SELECT x.topic_id, round(sum(ln((coalesce(both.n, 0) + 1) / alone.n)), 6) AS wanted FROM {terms} x JOIN {terms} y ON x.topic_id = y.topic_id AND x.position < y.position
JOIN alone ON alone.topic_id = x.topic_id AND alone.position = x.position
LEFT JOIN both ON both.topic_id = x.topic_id AND both.p = x.position AND both.q = y.position GROUP BY 1"""


def _coherence(v: Views):
    """Coherence of every topic next to SQL over the same stored tables, and whether the shares of every text add up."""
    found = models.fit_topics(v.dealt_documents, "review")
    mine = models.topic_coherence(found.terms, found.tokens)
    wanted = v.spark.sql(COHERENCE_SQL, tokens=found.tokens, terms=found.terms)
    shares = models.topic_shares(found).join(found.tokens, "row").agg(F.every(F.when(
        F.size("tokens") > 0, F.abs(F.aggregate("shares", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-6).otherwise(True))).scalar()
    return mine.join(wanted, "topic_id").select("topic_id", (F.abs(F.col("coherence") - F.col("wanted")) < 2e-6).alias("equal"),
                                                shares.alias("shares_add_up"))


def review_model(v: Views):
    """Sentiment model for the review texts, stored and loaded again as a scoring job would."""
    rows = v.dealt_reviews.select("id", F.col("content").alias("review"),
                            rules.import_is_positive("content", "rating").cast("double").alias("label"))
    ready = corpus.with_clean_text(corpus.prepare(rows, "review", "id"), "review", "c")
    model = models.fit(ready, models.logistic_regression(), stop_words=lex.sentiment_stop_words(), min_df=1.0)
    path = session.scratch_path(v.spark, "model")
    sinks.save_model(model, path)
    return sinks.load_model(path)


def score_facts(scored: DataFrame, *keep: str) -> DataFrame:
    """What must hold of every scored row: probabilities add up, and a guardrail row has 98 against 2."""
    adds = F.abs(F.col("prob_positive") + F.col("prob_negative") - 100) < 0.11
    named = F.col("sentiment") == F.when(F.col("prob_positive") >= F.col("prob_negative"), "POSITIVE").otherwise("NEGATIVE")
    close = F.abs(F.col("prob_positive") - F.col("prob_negative")) < 0.21  # rounded halves
    ruled = ~F.col("guardrail") | (F.greatest("prob_positive", "prob_negative") == 98.0)
    empty = F.col("prediction").isNull() & F.col("prob_positive").isNull() & F.col("sentiment").isNull()
    return scored.select(*keep, F.coalesce(adds & (named | close) & ruled, empty).alias("holds"))


def _score_batch(v: Views):
    scored = scoring.predict(v.dealt_reviews, review_model(v), "content", ["id", "content"])
    guard = rules.guardrail("content").cast("bigint")
    named = F.when(guard.isNotNull(), F.col("prediction") == guard).otherwise(True).alias("obeyed")
    return score_facts(scored, "id", guard.alias("guard"), named)


def _score_aspects(v: Views):
    return score_facts(scoring.aspect_predictions(v.dealt_reviews, review_model(v), "content", ["id"]), "id", "aspect", "context")


def _review_analysis(v: Views):
    """Every review with its contexts and complaint phrases in one row, and whether it has a sentiment."""
    rows = scoring.analyze(v.dealt_reviews, review_model(v), "content", ["id"])
    named = F.transform("aspects", lambda a: F.concat(a["aspect"], F.lit(": "), a["context"]))
    judged = F.forall("aspects", lambda a: a["sentiment"].isin("POSITIVE", "NEGATIVE") & a["confidence"].between(0, 100))
    return rows.select("id", F.array_join(named, " | ").alias("contexts"), F.array_join(F.col("complaints")["phrase"], ", ").alias("phrases"),
                       F.col("sentiment").isNotNull().alias("has_sentiment"), judged.alias("judged"))


def _aspect_report(v: Views):
    report = scoring.aspect_report(v.dealt_reviews, review_model(v), "content", ["id"])
    adds = F.col("positive_mentions") + F.col("negative_mentions") == F.col("mentions")
    share = F.abs(F.col("positive_pct") + F.col("negative_pct") - 100) < 0.02
    return report.select("aspect", "mentions", (adds & share & F.col("avg_confidence").between(50, 100)).alias("holds"))


def _stored_errors(v: Views) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables of an error analysis, and the annotated predictions they were made of, as stored."""
    train, test = split(v)
    model = models.fit(train, models.logistic_regression(), stored=True)
    rows = session.publish(jobs.error_rows(model, test), "errors")
    return jobs.error_tables(rows, "doc_id"), rows


#: Each table of the analysis as SQL over the stored predictions.
ERROR_SQL = {
    "summary": """SELECT count(*) AS total, count(*) FILTER (WHERE label = prediction) AS correct, count(*) FILTER (WHERE label <> prediction) AS incorrect,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS false_positives, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS false_negatives,
  round(count(*) FILTER (WHERE label <> prediction) / count(*), 4) AS error_rate FROM {rows}""",
    "negation": """SELECT n AS with_negation, wrong AS errors_with_negation, CASE WHEN n > 0 THEN round(wrong / n, 4) END AS negation_error_rate,
  CASE WHEN total > 0 THEN round(n / total * 100, 2) END AS overall_negation_pct, CASE WHEN errors > 0 THEN round(wrong / errors * 100, 2) END AS error_negation_pct
  FROM (SELECT count(*) AS total, sum(CAST(label <> prediction AS INT)) AS errors, sum(CAST(has_negation AS INT)) AS n,
        sum(CAST(has_negation AND label <> prediction AS INT)) AS wrong FROM {rows})""",
    "length": """SELECT CASE WHEN review_length < 15 THEN 'Short (<15 words)' WHEN review_length <= 50 THEN 'Medium (15-50 words)' ELSE 'Long (>50 words)' END AS length_bucket,
  count(*) AS total, sum(CAST(label <> prediction AS INT)) AS errors, round(avg(confidence), 4) AS avg_confidence,
  round(sum(CAST(label <> prediction AS INT)) / count(*), 4) AS error_rate FROM {rows} GROUP BY 1""",
    "confidence": """SELECT round(avg(confidence) FILTER (WHERE label = prediction), 4) AS avg_confidence_correct,
  round(avg(confidence) FILTER (WHERE label <> prediction), 4) AS avg_confidence_incorrect FROM {rows}""",
    "examples": """SELECT doc_id, CASE WHEN length(review) > 250 THEN substr(review, 1, 250) || '...' ELSE review END AS review,
  if(label = 1, 'Positive', 'Negative') AS true_sentiment, if(prediction = 1, 'Positive', 'Negative') AS predicted_sentiment, round(confidence, 4) AS confidence,
  review_length AS length_words, if(prediction = 1, 'FP', 'FN') AS error_type, CASE WHEN has_negation THEN 'Negation / Polarity Inversion'
  WHEN review_length < 15 THEN 'Short / Sparse Context' ELSE 'Mixed Sentiment / Sarcasm' END AS apparent_cause
  FROM (SELECT * FROM {rows} WHERE label <> prediction ORDER BY md5(concat(doc_id, ':42')), doc_id LIMIT 8)""",
}


def _error_checks(v: Views):
    """Every table of the error analysis next to SQL over the same stored predictions, and the test rows they cover."""
    tables, rows = _stored_errors(v)
    checks = []
    for name, sql in ERROR_SQL.items():
        want = v.spark.sql(sql, rows=rows)
        got = tables[name].select(*want.columns)
        differ = got.exceptAll(want).unionByName(want.exceptAll(got)).agg((F.count(F.lit(1)) == 0).alias("equal"))
        checks.append(differ.select(F.lit(name).alias("section"), "equal"))
    total = rows.agg(F.count(F.lit(1)).alias("total")).scalar()
    return reduce(DataFrame.unionByName, checks).withColumn("total", total)


def _error_summary(v: Views):
    holds = (F.col("correct") + F.col("incorrect") == F.col("total")) & (
        F.col("false_positives") + F.col("false_negatives") == F.col("incorrect"))
    return _stored_errors(v)[0]["summary"].select("total", holds.alias("holds"))


def _error_examples(v: Views):
    tables, _ = _stored_errors(v)
    wrong = tables["summary"].select(F.least("incorrect", F.lit(8)).cast("bigint").alias("n"))
    shown = tables["examples"].agg(F.count(F.lit(1)).alias("n"))
    return shown.select((F.col("n") == wrong.scalar()).alias("complete"))


QUERIES = {
    "tfidf_uni": _feature_table((1,)),
    "tfidf_bi": _feature_table((1, 2)),
    "tfidf_tri": _feature_table((1, 2, 3)),
    "model_nb": _bayes,
    "model_nb_vectors": _measured(models.naive_bayes, ngrams=(1,)),
    "model_lr": _linear(models.logistic_regression),
    "model_rf": _forest,
    "model_svc": _linear(models.linear_svc),
    "model_tuned_lr": _tuned(models.logistic_regression, models.lr_grid),
    "model_tuned_svc": _tuned(models.linear_svc, models.svc_grid),
    "model_grid": _grid,
    "model_weighted": _weighted,
    "model_sweep_features": _sweep,
    "model_sweep_cleaning": _preprocessing,
    "model_terms": _bayes_terms,
    "model_terms_lr": _lr_terms,
    "lda_topics": _topic_facts,
    "lda_topic_weight": _topic_weights,
    "lda_coherence": _coherence,
    "score_batch": _score_batch,
    "score_aspects": _score_aspects,
    "review_analysis": _review_analysis,
    "absa_model": _aspect_report,
    "error_report": _error_summary,
    "error_report_examples": _error_examples,
    "error_report_tables": _error_checks,
}


def _feature_sql(sizes: tuple[int, ...]) -> str:
    grams = " UNION ALL ".join(f"SELECT doc_id, phrase AS term FROM ({sql_grams(n, 'tok')}) g{n}" for n in sizes)
    return with_views("fx_corpus", """SELECT term, count(*) AS documents,
round(sum(tf) * ln(((SELECT count(*) FROM fx_corpus) + 1) / CAST(count(*) + 1 AS DOUBLE)) / (SELECT count(*) FROM fx_corpus), 6) AS mean_tfidf
FROM tf GROUP BY term HAVING count(*) >= 2""",
                      tok=f"""SELECT doc_id, list_filter(string_split({SQL_A}, ' '),
  lambda x: x <> '' AND x NOT IN ({sql_words(lex.english_stop_words())})) AS w FROM fx_corpus""",
                      tf=f"SELECT doc_id, term, count(*) AS tf FROM ({grams}) a GROUP BY doc_id, term")


SLOT = "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 100"
PREPARED = f"""SELECT doc_id, label, review, {SLOT} < 80 AS is_train FROM (
  SELECT *, row_number() OVER (PARTITION BY review ORDER BY doc_id) AS rn FROM fx_corpus
  WHERE review IS NOT NULL AND length(trim(review)) > 0) t WHERE rn = 1"""


def _facts_sql(*experiments: str) -> str:
    names = ", ".join(f"'{name}'" for name in experiments)
    return with_views("fx_corpus", f"""SELECT e.experiment, count(*) AS total, count(*) FILTER (WHERE label = 1) AS positives,
count(*) FILTER (WHERE label = 0) AS negatives, TRUE AS agrees
FROM (SELECT unnest([{names}]) AS experiment) e, rows WHERE NOT is_train GROUP BY 1""", rows=PREPARED)


def _bayes_sql(cleaned: str, body: str) -> str:
    """Multinomial naive Bayes on TF-IDF, by its formula."""
    stops = sql_words(lex.english_stop_words())
    return with_views(
        "fx_corpus", body, rows=PREPARED,
        tf=f"""SELECT doc_id, label, is_train, term, count(*) AS tf FROM (
  SELECT doc_id, label, is_train, unnest(string_split({cleaned}, ' ')) AS term FROM rows) w
  WHERE term <> '' AND term NOT IN ({stops}) GROUP BY ALL""",
        sums="""SELECT term, count(*) AS df, coalesce(sum(tf) FILTER (WHERE label = 1), 0) AS pos, coalesce(sum(tf) FILTER (WHERE label = 0), 0) AS neg
  FROM tf WHERE is_train GROUP BY term HAVING count(*) >= 2""",
        idf="""SELECT term, pos, neg, ln(((SELECT count(*) FROM rows WHERE is_train) + 1) / CAST(df + 1 AS DOUBLE)) AS idf FROM sums""",
        total="SELECT count(*) AS v, sum(pos * idf) AS p, sum(neg * idf) AS n FROM idf",
        terms="""SELECT term, idf, (ln(pos * idf + 1) - ln(total.p + total.v)) - (ln(neg * idf + 1) - ln(total.n + total.v)) AS weight
  FROM idf, total""")


ORACLES = {
    "tfidf_uni": _feature_sql((1,)),
    "tfidf_bi": _feature_sql((1, 2)),
    "tfidf_tri": _feature_sql((1, 2, 3)),
    "model_nb": _bayes_sql(SQL_C, """SELECT count(*) FILTER (WHERE label = 1 AND hit) AS tp, count(*) FILTER (WHERE label = 0 AND NOT hit) AS tn,
count(*) FILTER (WHERE label = 0 AND hit) AS fp, count(*) FILTER (WHERE label = 1 AND NOT hit) AS fn,
round(count(*) FILTER (WHERE (label = 1) = hit) / CAST(count(*) AS DOUBLE), 4) AS accuracy
FROM (SELECT r.doc_id, r.label, (SELECT ln(count(*) FILTER (WHERE label = 1) + 1) - ln(count(*) FILTER (WHERE label = 0) + 1) FROM rows WHERE is_train)
      + coalesce(s.x, 0) > 0 AS hit FROM rows r LEFT JOIN (
  SELECT doc_id, sum(tf * idf * weight) AS x FROM tf JOIN terms USING (term) WHERE NOT is_train GROUP BY 1) s ON s.doc_id = r.doc_id
  WHERE NOT r.is_train) t"""),
    "model_terms": _bayes_sql(SQL_A, "SELECT term, round(idf, 6) AS idf, round(weight, 6) AS weight FROM terms"),
    "model_nb_vectors": _facts_sql("naive_bayes"),
    "model_lr": _facts_sql("logistic_regression"),
    "model_rf": _facts_sql("random_forest"),
    "model_svc": _facts_sql("linear_svc"),
    "model_tuned_lr": _facts_sql("tuned logistic_regression"),
    "model_tuned_svc": _facts_sql("tuned linear_svc"),
    "model_weighted": _facts_sql("weighted"),
    "model_sweep_features": _facts_sql("20k, minDF 2", "50k, minDF 5", "1+2+3-grams"),
    "model_sweep_cleaning": _facts_sql("variant a", "variant b", "variant c"),
    "model_grid": """SELECT 'elasticNetParam=' || e || ', regParam=' || r AS params, TRUE AS is_share
FROM (SELECT unnest(['0.0', '0.5']) AS e) a, (SELECT unnest(['0.001', '0.01', '0.05', '0.1', '0.5']) AS r) b""",
    "model_terms_lr": """SELECT class, CAST(15 AS BIGINT) AS terms, TRUE AS known, TRUE AS scored
FROM (SELECT unnest(['positive', 'negative']) AS class) t""",
    "lda_topics": "SELECT unnest(range(1, 6)) AS topic_id, CAST(8 AS BIGINT) AS terms, TRUE AS known, TRUE AS falling",
    "lda_coherence": "SELECT unnest(range(1, 6)) AS topic_id, TRUE AS equal, TRUE AS shares_add_up",
    "lda_topic_weight": """SELECT t AS topic_id, 'Topic ' || CAST(t AS VARCHAR) AS label, CAST(8 AS BIGINT) AS terms, TRUE AS is_share
FROM (SELECT unnest(range(1, 6)) AS t) x""",
    "score_batch": f"SELECT id, guardrail AS guard, TRUE AS obeyed, TRUE AS holds FROM ({guardrail_sql()}) g",
    "score_aspects": with_views("fx_reviews", "SELECT id, aspect, context, TRUE AS holds FROM ctx", clauses=CLAUSES, ctx=CONTEXTS),
    "review_analysis": with_views("fx_reviews", f"""SELECT id, array_to_string(list_filter([{CONTEXT_LIST}], lambda x: x IS NOT NULL), ' | ') AS contexts,
  array_to_string(list_transform(list_filter([{PATTERNS}], lambda x: contains(lower(coalesce(content, '')), x.phrase)), lambda x: x.phrase), ', ') AS phrases,
  regexp_matches(coalesce(content, ''), '[A-Za-z0-9]') AS has_sentiment, TRUE AS judged FROM clauses""", clauses=CLAUSES),
    "absa_model": with_views("fx_reviews", "SELECT aspect, count(*) AS mentions, TRUE AS holds FROM ctx GROUP BY aspect",
                             clauses=CLAUSES, ctx=CONTEXTS),
    "error_report": with_views("fx_corpus", "SELECT count(*) AS total, TRUE AS holds FROM rows WHERE NOT is_train", rows=PREPARED),
    "error_report_examples": "SELECT TRUE AS complete",
    "error_report_tables": with_views("fx_corpus", f"""SELECT section, TRUE AS equal, (SELECT count(*) FROM rows WHERE NOT is_train) AS total
FROM (SELECT unnest([{", ".join(f"'{n}'" for n in ERROR_SQL)}]) AS section) s""", rows=PREPARED),
}
