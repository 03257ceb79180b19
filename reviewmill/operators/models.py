"""Training, tuning, comparison and inspection of sentiment classifiers."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, LogisticRegressionModel, NaiveBayes, \
    NaiveBayesModel, RandomForestClassifier
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import session
from reviewmill.operators import complaints, evaluation, features, ranking, running

SEED = 42
REG_PARAMS = [0.001, 0.01, 0.05, 0.1, 0.5]   # fixed values of the tuning grid
ELASTIC_NET_PARAMS = [0.0, 0.5]


def naive_bayes() -> NaiveBayes:
    return NaiveBayes(labelCol="label", featuresCol="features", modelType="multinomial")


def logistic_regression(**params) -> LogisticRegression:
    return LogisticRegression(labelCol="label", featuresCol="features", **{"maxIter": 20, **params})


def random_forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", seed=SEED,
                                  **{"numTrees": 60, "maxDepth": 12, **params})


def linear_svc(**params) -> LinearSVC:
    return LinearSVC(labelCol="label", featuresCol="features", **{"maxIter": 100, **params})


def fit(train: DataFrame, classifier: Estimator, stored: bool = False, **feature_options) -> PipelineModel:
    """Features and classifier fitted on the same rows.

    The count vectors of the rows go to the shared folder. They are the one thing read from ``train``, so cleaning and deduplication
    run once, stored or not, and texts are taken apart once; the weights of places and the classifier are fitted on the
    counts. An executor lost half-way costs a re-read of its part. The counts are deleted at the end.
    """
    text = feature_options.get("input_col", "clean_text")
    columns = [c for c in ("label", "class_weight") if c in train.columns]
    rows = train.select(*columns, text)
    with session.scratch_scope(train.sparkSession):
        stages = features.tfidf_stages(**feature_options)
        return _fit_counts(features.counted(stages, rows, columns, "train-counts"), stages, classifier, columns)


def _fit_counts(counts: DataFrame, stages: list, classifier: Estimator, columns: list[str]) -> PipelineModel:
    """Model of the feature stages, whose counts are given, and the classifier."""
    weights = stages[-1].fit(counts)
    return PipelineModel(stages=[*stages[:-1], weights, classifier.fit(features.weighed(weights, counts, columns))])


def positive_score(columns: list[str]) -> Column:
    """Probability of the positive class, or the margin for models without one."""
    source = "probability" if "probability" in columns else "rawPrediction"
    return F.element_at(vector_to_array(source), 2)


def with_score(preds: DataFrame) -> DataFrame:
    return preds.withColumn("score", positive_score(preds.columns))


def stored_predictions(model: Model, test: DataFrame) -> DataFrame:
    """(label, prediction, score) of every test row, stored."""
    return session.publish(with_score(model.transform(test)).select("label", "prediction", "score"), "predictions")


def evaluate(model: Model, test: DataFrame, experiment: str, train_time: float | None = None,
             params: str = "", preds: DataFrame | None = None) -> DataFrame:
    """One row of metrics, confusion counts and times.

    Predictions are stored once and then read by every metric; ``preds`` takes those of ``stored_predictions``.
    """
    started = time.time()
    preds = stored_predictions(model, test) if preds is None else preds
    took = time.time() - started
    note = "" if model_has_probability(model) else "(margin-based, uncalibrated)"
    area = evaluation.auc(preds)
    measured = evaluation.metrics(preds.withColumn("experiment", F.lit(experiment)), ("experiment",))
    counts = evaluation.confusion(preds.withColumn("experiment", F.lit(experiment)), ("experiment",))
    return measured.join(counts, "experiment").select(
        "experiment", "accuracy", "precision", "recall", "f1", area.scalar().alias("roc_auc"),
        F.lit(note).alias("roc_auc_note"), "tp", "tn", "fp", "fn",
        F.lit(None if train_time is None else round(train_time, 2)).cast("double").alias("train_time"),
        F.lit(round(took, 2)).alias("predict_time"), F.lit(params).alias("best_params"),
    )


def model_has_probability(model: Model) -> bool:
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    return hasattr(last, "setProbabilityCol")


def timed_fit(train: DataFrame, classifier: Estimator, stored: bool = False,
              **feature_options) -> tuple[PipelineModel, float]:
    started = time.time()
    model = fit(train, classifier, stored, **feature_options)
    return model, time.time() - started


# --- tuning ---------------------------------------------------------------------------

def lr_grid(lr: LogisticRegression) -> list[dict]:
    return (ParamGridBuilder().addGrid(lr.regParam, REG_PARAMS)
            .addGrid(lr.elasticNetParam, ELASTIC_NET_PARAMS).build())


def svc_grid(svc: LinearSVC) -> list[dict]:
    return ParamGridBuilder().addGrid(svc.regParam, REG_PARAMS).build()


def tune(train: DataFrame, key: str, classifier: Estimator, grid: list[dict], parallelism: int = 4,
         final_iterations: int = 200, seed: int = SEED, stored: bool = False,
         **feature_options) -> tuple[PipelineModel, DataFrame]:
    """Grid search on an 80/20 split of the training rows, then a refit on all of them (M9).

    The split is drawn with another seed than the one that set the test rows apart; with the same one it would keep
    all training rows. Features are fitted once, on the 80 % only, so no grid point sees validation rows
    through the IDF weights and none pays for the features again. Texts are hashed once, for the grid and the refit. The
    weighed rows are stored, and grid points train on them in parallel.
    """
    from multiprocessing.pool import ThreadPool

    spark = train.sparkSession
    text = feature_options.get("input_col", "clean_text")
    rows = train.select(key, "label", text)
    rows = rows if stored else session.publish(rows, "tune-rows")
    stages = features.tfidf_stages(**feature_options)
    counts = features.counted(stages, rows, [key, "label"], "tune-counts")
    inner, held_out = ranking.split_by_key(counts, key, seed=seed + 1)
    weights = stages[-1].fit(inner)
    inner = session.publish(features.weighed(weights, inner, ["label"]), "tune-train")
    held_out = session.publish(features.weighed(weights, held_out, ["label"]), "tune-valid")
    accuracy = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")

    def score(point: dict) -> tuple[dict, float]:
        return point, float(accuracy.evaluate(classifier.fit(inner, point).transform(held_out)))

    with ThreadPool(parallelism) as pool:
        scores = pool.map(score, grid)
    best, _ = max(scores, key=lambda item: item[1])
    table = spark.createDataFrame(
        [(", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda x: x[0].name)), value)
         for point, value in scores],
        "params string, accuracy double",
    )
    final = classifier.copy(best)
    final.setMaxIter(final_iterations)
    return _fit_counts(counts, stages, final, ["label"]), table


def weighted_fit(train: DataFrame, classifier: Estimator, stored: bool = False, **feature_options) -> PipelineModel:
    """Refit with inverse-frequency class weights."""
    weighted = evaluation.with_class_weight(train)
    return fit(weighted, classifier.copy().setWeightCol("class_weight"), stored, **feature_options)


def sweep(train: DataFrame, test: DataFrame, experiments: list[tuple[str, Estimator, dict]],
          stored: bool = False, strict: bool = False) -> DataFrame:
    """Results of several configurations; one that fails becomes a row with its error.

    With ``strict`` all are still tried, but a failed one then fails the sweep: for callers whose result has no place for an error.
    """
    spark = train.sparkSession
    rows, failed = [], {}
    for name, classifier, options in experiments:
        try:
            model, took = timed_fit(train, classifier, stored, **options)
            rows.append(evaluate(model, test, name, took).withColumn("error", F.lit(None).cast("string")))
        except Exception as failure:  # noqa: BLE001 - the sweep records it and goes on
            failed[name] = failure
            rows.append(spark.createDataFrame([(name, str(failure)[:500])], "experiment string, error string"))
    if strict and failed:
        told = "; ".join(f"{name}: {str(failure)[:500]}" for name, failure in failed.items())
        raise RuntimeError(f"{len(failed)} of {len(experiments)} configurations failed: {told}") from next(iter(failed.values()))
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row, allowMissingColumns=True)
    return out


# --- inspection -------------------------------------------------------------------------

def term_weights(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Every term of ``rows`` with its weight towards the positive class.

    Logistic regression gives coefficients, naive Bayes the difference of log
    probabilities. One number per place of the feature vector comes to the driver, as many as the model itself holds.
    """
    last = model.stages[-1]
    if isinstance(last, NaiveBayesModel):
        theta = last.theta.toArray()
        weights = theta[1] - theta[0]
    elif isinstance(last, LogisticRegressionModel):
        weights = last.coefficients.toArray()
    else:
        raise TypeError(f"no term weights for {type(last).__name__}")
    places = weights.nonzero()[0]
    table = rows.sparkSession.createDataFrame([(int(n), float(weights[n])) for n in places], "index int, weight double")
    return features.term_index(model, rows).join(table, "index", "left").select("term", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def top_terms(model: PipelineModel, rows: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` strongest terms of each class with absolute scores."""
    weights = term_weights(model, rows)
    score = F.round(F.abs("weight"), 4).alias("score")
    best = weights.orderBy(F.desc("weight"), "term").limit(k).select(F.lit("positive").alias("class"), "term", score)
    worst = weights.orderBy("weight", "term").limit(k).select(F.lit("negative").alias("class"), "term", score)
    return best.unionByName(worst)


# --- naive Bayes as aggregates -----------------------------------------------------------

def bayes_terms(train: DataFrame, key: str, text: str = "clean_text", n: int = 1, min_df: int = 2,
                stop_words: list[str] | None = None) -> DataFrame:
    """(term, idf, weight): multinomial naive Bayes on TF-IDF in closed form, for vocabularies of any size.

    ``weight`` is the difference of the smoothed log probabilities of the classes. Sums per term and class are all
    that is shuffled; terms in fewer than ``min_df`` documents are left out, as in the vector form.
    """
    labels = train.select(key, F.col("label").alias("_label"))
    counts = features.term_frequencies(train, key, text, n, stop_words).join(labels, key)
    documents = train.agg(F.count(F.lit(1))).scalar()
    sums = counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("_df"), F.sum(F.when(F.col("_label") == 1, F.col("tf")).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col("_label") == 0, F.col("tf")).otherwise(0)).alias("_neg")).filter(F.col("_df") >= min_df)
    idf = F.log((documents + 1) / (F.col("_df") + 1))
    weighed = session.publish(sums.select("term", idf.alias("idf"), (F.col("_pos") * idf).alias("_pos"), (F.col("_neg") * idf).alias("_neg")), "bayes")
    total = weighed.agg(F.struct(F.count(F.lit(1)).alias("v"), F.sum("_pos").alias("p"), F.sum("_neg").alias("n"))).scalar()
    weight = (F.log(F.col("_pos") + 1) - F.log(total["p"] + total["v"])) - (F.log(F.col("_neg") + 1) - F.log(total["n"] + total["v"]))
    return weighed.select("term", "idf", weight.alias("weight"))


def bayes_predict(rows: DataFrame, key: str, terms: DataFrame, train: DataFrame, text: str = "clean_text", n: int = 1,
                  stop_words: list[str] | None = None) -> DataFrame:
    """(key, label, score, prediction): log odds of the positive class of every row; one without known terms gets the prior."""
    prior = train.agg(F.log(F.count_if(F.col("label") == 1) + 1.0) - F.log(F.count_if(F.col("label") == 0) + 1.0)).scalar()
    found = features.term_frequencies(rows, key, text, n, stop_words).join(terms, "term")
    sums = found.groupBy(key).agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("_sum"))
    scored = rows.select(key, "label").join(sums, key, "left").withColumn("score", prior + F.coalesce("_sum", F.lit(0.0)))
    return scored.select(key, "label", "score", F.when(F.col("score") > 0, 1.0).otherwise(0.0).alias("prediction"))


# --- topics ---------------------------------------------------------------------------------

#: Texts of one step of a topic fit, where a twentieth of all has fewer: a step on a handful of texts is left to chance.
TOPIC_BATCH = 1000
TOPIC_TERMS = "topic_id bigint, position bigint, term string, weight double"


@dataclass
class Topics:
    """A fitted topic model: its terms, and the stored token lists and count vectors (with ids) it was fitted on."""

    model: LDAModel | None
    terms: DataFrame
    tokens: DataFrame
    counts: DataFrame | None


def fit_topics(texts: DataFrame, text: str, k: int = 5, iterations: int = 15, dims: int = 1 << 14,
               terms: int = 8, seed: int = SEED, stop_words: list[str] | None = None) -> Topics:
    """Topics of texts (M14); without any text there are none.

    Words are hashed to ``dims`` places, so none is left out; a place goes by the word found in most documents, and one that no
    word is hashed to is no term. Topics carry
    numbers only: a label chosen by topic index would say nothing about its content (D12).
    """
    spark = texts.sparkSession
    tokens = complaints.with_tokens(texts, text, stop_words, out="tokens").select(F.monotonically_increasing_id().alias("row"), "tokens")
    tokens = session.publish(tokens, "topic-tokens")
    if tokens.isEmpty():
        return Topics(None, spark.createDataFrame([], TOPIC_TERMS), tokens, None)
    counts = HashingTF(inputCol="tokens", outputCol="features", numFeatures=dims).transform(tokens).select("row", "features")
    counts = session.publish(counts, "topic-counts")
    share = min(1.0, max(0.05, TOPIC_BATCH / counts.count()))
    model = LDA(k=k, maxIter=iterations, seed=seed, featuresCol="features", subsamplingRate=share).fit(counts)
    described = model.describeTopics(maxTermsPerTopic=dims)
    flat = described.select(
        (F.col("topic") + 1).cast("bigint").alias("topic_id"),
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("position", "_t"),
    )
    words = tokens.select(F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
    names = features.hashed_place(words, "term", dims).groupBy("index").agg(F.max_by("term", F.struct("_n", "term")).alias("term"))
    held = flat.join(names, F.col("_t.termIndices") == F.col("index")).select("topic_id", F.col("position").alias("_at"), "term", "_t.termWeights")
    named = ranking.top_per_group(held, ["topic_id"], [F.col("_at")], terms, "position").select(
        "topic_id", "position", "term", F.round("termWeights", 6).alias("weight"))
    return Topics(model, session.publish(named, "topic-terms"), tokens, counts)


def lda_topics(texts: DataFrame, text: str, **options) -> DataFrame:
    """Topic terms and weights; no rows for an empty input."""
    return fit_topics(texts, text, **options).terms


def topic_coherence(terms: DataFrame, tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """(topic_id, coherence): for each topic the sum of ln((texts with both + 1) / texts with the first) over pairs of its terms in order.

    A text emits the topic terms it holds and their pairs, a number bounded by the topics and not by the text; counts per term and
    pair are partial aggregates, and the pairs of all topics then look up a few rows.
    """
    wanted = [r.term for r in terms.select("term").distinct().orderBy("term").collect()]  # topics times terms of a topic
    held = F.array_sort(F.array_distinct(F.filter(F.col(column), lambda t: t.isin(wanted))))
    pairs = F.flatten(F.transform("held", lambda a: F.transform(F.filter("held", lambda b: b >= a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    counts = tokens.select(held.alias("held")).select(F.inline(pairs)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    first = terms.select("topic_id", F.col("position").alias("p"), F.col("term").alias("x"))
    second = terms.select(F.col("topic_id").alias("t"), F.col("position").alias("q"), F.col("term").alias("y"))
    ordered = first.join(second, (F.col("topic_id") == F.col("t")) & (F.col("p") < F.col("q")))
    ordered = ordered.withColumns({"a": F.least("x", "y"), "b": F.greatest("x", "y")})
    alone = counts.filter("a = b").select(F.col("a").alias("x"), F.col("n").alias("n_first"))
    found = ordered.join(counts, ["a", "b"], "left").join(alone, "x")
    value = F.sum(F.log((F.coalesce("n", F.lit(0)) + 1) / F.col("n_first")))
    return found.groupBy("topic_id").agg(F.round(value, 6).alias("coherence"))


def shuffled_tokens(tokens: DataFrame, column: str = "tokens", seed: int = SEED) -> DataFrame:
    """The same words dealt at random to texts of the same lengths: what co-occurs is left to chance."""
    words = tokens.select("row", F.posexplode(column).alias("at", "word"))
    slots = running.numbered(words.select("row", "at"), [F.xxhash64("row", "at", F.lit(seed)), F.col("row"), F.col("at")], "nth")
    dealt = running.numbered(words, [F.xxhash64("row", "at", F.lit(seed + 1)), F.col("row"), F.col("at")], "nth")
    return slots.select("nth", "row").join(dealt.select("nth", "word"), "nth").groupBy("row").agg(F.collect_list("word").alias(column))


def topic_shares(topics: Topics) -> DataFrame:
    """(row, shares): how much of each text belongs to each topic (M15); a text without words has none."""
    return topics.model.transform(topics.counts).select("row", vector_to_array("topicDistribution").alias("shares"))


def topic_weights(topics: DataFrame, first: int = 4) -> DataFrame:
    """Terms of each topic as one text, and the weight of the first four."""
    entry = F.struct("position", "term")
    return topics.groupBy("topic_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["term"]), ", ").alias("top_terms"),
        F.round(F.sum(F.when(F.col("position") <= first, F.col("weight"))), 4).alias("top_weight"),
    ).withColumn("label", F.concat(F.lit("Topic "), F.col("topic_id").cast("string")))
