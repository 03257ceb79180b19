"""Batch jobs that turn reviews into stored analyses."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill import session
from reviewmill.functions import lexicon as lex
from reviewmill.functions import rules
from reviewmill.functions import text as tx
from reviewmill.operators import aspects, complaints, corpus, evaluation, kpis, scoring, tenancy
from reviewmill.sources import readers, sinks


def is_positive() -> F.Column:
    return F.col("sentiment") == "POSITIVE"


# --- analysis rows from reviews that already carry a sentiment --------------------------

def product_aspects(reviews: DataFrame, text: str = "content") -> DataFrame:
    """Aspect results per product (A14 in the shape of the aspect results table).

    Contexts are found in one narrow pass; counts per (product, aspect) combine before the shuffle.
    """
    rows = aspects.aspect_contexts(reviews, text, ["organization_id", "product_id", "sentiment"])
    counts = rows.groupBy("organization_id", "product_id", "aspect").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.count_if(is_positive()).alias("positive_count"),
        F.count_if(F.col("sentiment") == "NEGATIVE").alias("negative_count"),
    )
    share = tx.percent(F.col("positive_count"), F.col("mentions"), 1)
    return counts.withColumn("positive_pct", share).withColumn(
        "negative_pct", F.round(F.lit(100.0) - F.col("positive_pct"), 1))


def product_issues(reviews: DataFrame, text: str = "content", high: float = 10.0, medium: float = 5.0) -> DataFrame:
    """Issue results per product: complaint phrases of its reviews (F15, A17 per product).

    ``frequency`` counts negative reviews with the phrase, ``percentage`` their share of
    the product's negative reviews, ``negative_pct`` how often a review with the phrase is
    negative. The share sets the priority.
    """
    hits = complaints.complaint_matches(reviews, text, ["organization_id", "product_id", "sentiment"])
    counts = hits.groupBy("organization_id", "product_id", "phrase", "aspect").agg(
        F.count_if(F.col("sentiment") == "NEGATIVE").alias("frequency"), F.count(F.lit(1)).alias("_all"))
    totals = reviews.groupBy("product_id").agg(F.count_if(F.col("sentiment") == "NEGATIVE").alias("_negatives"))
    share = F.round(F.col("frequency") / F.col("_negatives") * 100, 2)
    return (
        counts.filter(F.col("frequency") > 0).join(totals, "product_id")
        .withColumn("percentage", share)
        .select(
            "organization_id", "product_id", "phrase", "aspect", "frequency", "percentage",
            F.when(F.col("percentage") >= high, "HIGH").when(F.col("percentage") >= medium, "MEDIUM")
            .otherwise("LOW").alias("priority"),
            F.round(F.col("frequency") / F.col("_all") * 100, 1).alias("negative_pct"),
        )
    )


def mined_phrases(reviews: DataFrame, text: str = "content") -> DataFrame:
    """Two- and three-word phrases with a complaint word, mined per product from its negative reviews (M17 per product).

    ``frequency`` counts occurrences, ``percentage`` their number per negative review of the product.
    """
    negative = reviews.filter(F.col("sentiment") == "NEGATIVE")
    tokens = complaints.with_tokens(negative.select("organization_id", "product_id", "id", text), text, out="_tokens")
    grams = F.concat(*[complaints.long_enough(tx.ngrams("_tokens", n), complaints.MIN_PHRASE_LENGTH[n]) for n in (2, 3)])
    words = tokens.select("organization_id", "product_id", F.explode(grams).alias("phrase")).filter(rules.signals_complaint("phrase"))
    counts = words.groupBy("organization_id", "product_id", "phrase").agg(F.count(F.lit(1)).alias("frequency"))
    totals = negative.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(totals, "product_id").select(
        "organization_id", "product_id", "phrase", rules.ngram_type("phrase").alias("n_gram_type"),
        rules.phrase_aspect("phrase").alias("aspect"), "frequency", F.round(F.col("frequency") / F.col("_n") * 100, 2).alias("percentage"))


# --- jobs --------------------------------------------------------------------------------

def complaint_report(negatives: DataFrame, text: str, top: int = 25) -> dict[str, DataFrame]:
    """All tables of a complaint mining run; empty input gives empty tables."""
    negatives = session.publish(negatives.select(*[c for c in ("id", text) if c in negatives.columns]), "negatives")
    mined = session.publish(complaints.mined_complaints(negatives, text), "mined")
    return {
        "top_complaints": mined.orderBy(F.desc("frequency"), "phrase").limit(top),
        "top_bigrams": complaints.top_phrases(negatives, text, top, 2),
        "top_trigrams": complaints.top_phrases(negatives, text, top, 3),
        "aspect_complaints": complaints.complaints_by_aspect(mined),
    }


def error_rows(model: PipelineModel, test: DataFrame, key: str = "doc_id", text: str = "review",
               negations: list[str] = lex.NEGATION_WORDS_BASELINE) -> DataFrame:
    """Predictions with everything that an error analysis asks of a row; ``test`` holds label, text and clean_text."""
    scored = model.transform(test)
    chance = rules.confidence() if "probability" in scored.columns else F.lit(None).cast("double")
    return evaluation.annotate(scored.select(key, text, "label", "prediction", chance.alias("confidence")), text, negations)


def error_tables(rows: DataFrame, key: str, text: str = "review", examples: int = 8) -> dict[str, DataFrame]:
    """All tables of an error analysis of annotated predictions."""
    return {
        "summary": evaluation.error_summary(rows),
        "negation": evaluation.negation_errors(rows),
        "length": evaluation.length_errors(rows),
        "confidence": evaluation.confidence_split(rows),
        "examples": evaluation.error_examples(rows, key, examples, text),
    }


def error_report(model: PipelineModel, test: DataFrame, key: str, text: str = "review", examples: int = 8,
                 negations: list[str] = lex.NEGATION_WORDS_BASELINE) -> dict[str, DataFrame]:
    """All tables of an error analysis (M18). The model runs once: its annotated predictions are stored."""
    return error_tables(session.publish(error_rows(model, test, key, text, negations), "errors"), key, text, examples)


def corpus_report(df: DataFrame, text: str = "review", key: str = "doc_id") -> dict[str, DataFrame]:
    """All tables of a corpus description."""
    ready = corpus.with_clean_text(corpus.prepare(df, text, key), text)
    return {
        "cleaning": corpus.cleaning_report(df, text),
        "classes": corpus.class_distribution(ready),
        "length": corpus.length_stats(ready),
        "histogram": corpus.length_histogram(ready),
        "words": corpus.top_words(ready),
        "insights": corpus.business_insights(ready),
    }


def aspect_job(reviews: DataFrame, model: PipelineModel, text: str, keep: list[str]) -> dict[str, DataFrame]:
    """Aspect sentiment with model predictions (M16), which are stored: the model runs once."""
    rows = session.publish(scoring.aspect_predictions(reviews, model, text, keep, override=False), "aspect-predictions")
    stats = aspects.aspect_stats(rows.withColumn("_score", F.col("confidence") / 100), F.col("prediction") == 1,
                                 score="_score")
    return {"rows": rows, "stats": aspects.with_status(stats), "pain_points": aspects.pain_points(stats)}


# --- import and analyse --------------------------------------------------------------------

def classify_imports(records: DataFrame, model: PipelineModel | None = None, keep: list[str] = ("id",)) -> DataFrame:
    """Sentiment of import rows, from a model or else from the rating rule."""
    if model is None:
        return records.withColumn(
            "sentiment", F.when(rules.import_is_positive("content", "rating"), "POSITIVE").otherwise("NEGATIVE"))
    others = [c for c in records.columns if c not in keep]
    scored = scoring.predict(records, model, "content", [*keep, *others])
    return scored.select(*keep, *others, "sentiment", (F.col("confidence") / 100).alias("sentiment_score"))


def _with_dataset(df: DataFrame) -> T.StructType:
    """Schema of a stored table: the data set is the name of its folder."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.drop("dataset_id").schema] + [T.StructField("dataset_id", T.StringType())])


def import_and_analyse(raw: DataFrame, members: DataFrame, out: str, dataset_id: str,
                       model: PipelineModel | None = None) -> dict[str, DataFrame]:
    """Gate, clean, classify, store and analyse one data set of imported records (Q11).

    ``raw`` holds id, user_id, organization_id, product_id and the record fields. Every
    table is written to a folder of the data set, so importing it again replaces it. Summary,
    aspects, issues and mined phrases are computed from the stored rows; the analyses have the columns that the reports read.
    """
    spark = raw.sparkSession
    ids = ["id", "user_id", "organization_id", "product_id"]

    def path(table: str) -> str:
        return f"{out.rstrip('/')}/{table}/dataset_id={dataset_id}"

    def store(df: DataFrame, table: str) -> DataFrame:
        df.drop("dataset_id").write.mode("overwrite").parquet(path(table))
        return spark.read.option("basePath", f"{out.rstrip('/')}/{table}").schema(_with_dataset(df)).parquet(path(table))

    def analysis_id() -> F.Column:
        return sinks.new_id(F.lit(dataset_id), "product_id", "organization_id")

    accepted, _ = tenancy.write_gate(raw, members)
    records = classify_imports(readers.import_records(accepted, ids), model, ids)
    stored = store(sinks.review_rows(records, ["id"]), "reviews")
    summary = kpis.import_summary(stored, ("organization_id", "product_id")).withColumns(
        {"id": analysis_id(), "status": F.lit("completed"), "created_at": F.current_timestamp()})
    return {
        "reviews": stored,
        "aspect_results": store(sinks.aspect_rows(product_aspects(stored), analysis_id()), "aspect_results"),
        "issue_results": store(sinks.issue_rows(product_issues(stored), analysis_id()), "issue_results"),
        "mined_phrases": store(mined_phrases(stored), "mined_phrases"),
        "analyses": store(summary, "analyses"),
    }
