"""Evaluation queries.

A deterministic rule stands in for the model, so every figure has an exact check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog.corpus import SQL_B
from reviewmill.catalog.views import Views, with_views
from reviewmill.functions import rules
from reviewmill.operators import evaluation as ev


def annotated(v: Views):
    chance = F.when(F.col("prediction") == 1, F.col("score")).otherwise(1 - F.col("score"))
    return ev.annotate(v.predictions, confidence=chance)


def experiments(v: Views):
    """Three cut-offs of one score, measured in a single pass."""
    cuts = F.array(*[
        F.struct(F.lit(name).alias("experiment"), F.lit(cut).alias("cut"))
        for name, cut in (("cut-40", 0.4), ("cut-50", 0.5), ("cut-60", 0.6))
    ])
    rows = v.predictions.select("label", "score", F.inline(cuts))
    return ev.metrics(rows.withColumn("prediction", F.when(F.col("score") >= F.col("cut"), 1.0).otherwise(0.0)),
                      ("experiment",))


def _weights(v: Views):
    return ev.with_class_weight(v.corpus.select("doc_id", "label")).select("doc_id", "class_weight")


QUERIES = {
    "eval_confusion": lambda v: ev.confusion(v.predictions),
    "eval_metrics": lambda v: ev.metrics(v.predictions),
    "eval_auc": lambda v: ev.auc(v.predictions),
    "eval_roc": lambda v: ev.roc_curve(v.predictions),
    "eval_roc_thinned": lambda v: ev.roc_curve(v.predictions, points=30),
    "eval_outcomes": lambda v: annotated(v).select(
        "doc_id", "outcome", "is_correct", "has_negation", "review_length", "length_bucket"),
    "eval_errors": lambda v: ev.error_summary(annotated(v)),
    "eval_negation": lambda v: ev.negation_errors(annotated(v)),
    "eval_length_buckets": lambda v: ev.length_errors(annotated(v)),
    "eval_confidence": lambda v: ev.confidence_split(annotated(v)),
    "eval_error_sample": lambda v: ev.error_examples(annotated(v), "doc_id"),
    "class_balance": lambda v: ev.class_balance(v.corpus),
    "class_weights": _weights,
    "experiment_table": experiments,
    "experiment_best": lambda v: ev.best_experiment(experiments(v)),
    "experiment_delta": lambda v: ev.deltas(experiments(v), "cut-40"),
    "sentiment_names": lambda v: v.predictions.select("doc_id", rules.sentiment_name("prediction").alias("sentiment")),
}

CONF = """SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn"""


def _metrics(source: str, keys: str = "") -> str:
    pre, group = (f"{keys}, ", f" GROUP BY {keys}") if keys else ("", "")
    return f"""SELECT {pre}round((tp + tn) / n, 4) AS accuracy,
  round((p1 * (tp + fn) + p0 * (tn + fp)) / n, 4) AS precision, round((r1 * (tp + fn) + r0 * (tn + fp)) / n, 4) AS recall,
  round((coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * (tp + fn) + coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * (tn + fp)) / n, 4) AS f1
FROM (SELECT *, tp + tn + fp + fn AS n, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
        coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0
      FROM ({CONF.replace('SELECT', f'SELECT {pre}', 1)} FROM {source}{group}) c) m"""


CUTS = """SELECT experiment, label, CASE WHEN score >= cut THEN 1 ELSE 0 END AS prediction FROM fx_predictions
JOIN (VALUES ('cut-40', 0.4), ('cut-50', 0.5), ('cut-60', 0.6)) c(experiment, cut) ON true"""
CURVE = """SELECT 0 AS point, 0.0 AS fpr, 0.0 AS tpr UNION ALL
SELECT row_number() OVER (ORDER BY score DESC), round(sum(n) OVER (ORDER BY score DESC) / sum(n) OVER (), 6),
  round(sum(p) OVER (ORDER BY score DESC) / sum(p) OVER (), 6)
FROM (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM fx_predictions GROUP BY score) g"""
ROWS = f"""SELECT *, CASE WHEN c = '' THEN 0 ELSE len(string_split(c, ' ')) END AS words,
  regexp_matches(c, '\\b(not|no|never|neither|nor|nothing|nowhere|hardly|barely|cannot)\\b') AS negated, label <> prediction AS wrong,
  CASE WHEN prediction = 1 THEN score ELSE 1 - score END AS conf,
  CASE WHEN label = 1 AND prediction = 1 THEN 'TP' WHEN label = 0 AND prediction = 0 THEN 'TN'
       WHEN label = 0 THEN 'FP' ELSE 'FN' END AS outcome FROM (SELECT *, {SQL_B} AS c FROM fx_predictions) t"""
BUCKET = """CASE WHEN words < 15 THEN 'Short (<15 words)' WHEN words <= 50 THEN 'Medium (15-50 words)' ELSE 'Long (>50 words)' END"""
BALANCE = """SELECT n AS rows, p AS positive, n - p AS negative, round(p / n, 4) AS positive_fraction,
  round((n - p) / n, 4) AS negative_fraction, round(abs(2 * p - n) / n, 4) AS imbalance, abs(2 * p - n) / n > 0.05 AS use_weights,
  round(n / (2 * p), 6) AS positive_weight, round(n / (2 * (n - p)), 6) AS negative_weight
FROM (SELECT count(*) AS n, CAST(sum(label) AS BIGINT) AS p FROM fx_corpus) t"""


def pred(body: str, **ctes: str) -> str:
    return with_views("fx_predictions", body, **ctes)


ORACLES = {
    "eval_confusion": pred(f"{CONF} FROM fx_predictions"),
    "eval_metrics": pred(_metrics("fx_predictions")),
    "eval_auc": pred("""SELECT round((sum(CASE WHEN label = 1 THEN r ELSE 0 END) - p * (p + 1) / 2) / (p * n), 4) AS roc_auc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r,
        sum(label) OVER () AS p, sum(1 - label) OVER () AS n FROM fx_predictions) t GROUP BY p, n"""),
    "eval_roc": pred("SELECT CAST(point AS BIGINT) AS point, CAST(fpr AS DOUBLE) AS fpr, CAST(tpr AS DOUBLE) AS tpr FROM curve",
                     curve=CURVE),
    "eval_roc_thinned": pred("""SELECT CAST(point AS BIGINT) AS point, CAST(fpr AS DOUBLE) AS fpr, CAST(tpr AS DOUBLE) AS tpr FROM curve
WHERE point % greatest(1, (SELECT count(*) FROM curve) // 30) = 0""", curve=CURVE),
    "eval_outcomes": pred(f"""SELECT doc_id, outcome, NOT wrong AS is_correct, negated AS has_negation,
CAST(words AS BIGINT) AS review_length, {BUCKET} AS length_bucket FROM ann""", ann=ROWS),
    "eval_errors": pred("""SELECT count(*) AS total, count(*) FILTER (WHERE NOT wrong) AS correct,
count(*) FILTER (WHERE wrong) AS incorrect, count(*) FILTER (WHERE outcome = 'FP') AS false_positives,
count(*) FILTER (WHERE outcome = 'FN') AS false_negatives,
round(count(*) FILTER (WHERE wrong) / count(*), 4) AS error_rate FROM ann""", ann=ROWS),
    "eval_negation": pred("""SELECT a AS with_negation, b AS errors_with_negation, round(b / nullif(a, 0), 4) AS negation_error_rate,
round(a / n * 100, 2) AS overall_negation_pct, round(b / nullif(w, 0) * 100, 2) AS error_negation_pct
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE wrong) AS w, count(*) FILTER (WHERE negated) AS a,
  count(*) FILTER (WHERE negated AND wrong) AS b FROM ann) t""", ann=ROWS),
    "eval_length_buckets": pred(f"""SELECT {BUCKET} AS length_bucket, count(*) AS total, count(*) FILTER (WHERE wrong) AS errors,
round(avg(conf), 4) AS avg_confidence, round(count(*) FILTER (WHERE wrong) / count(*), 4) AS error_rate FROM ann GROUP BY 1""",
                                ann=ROWS),
    "eval_confidence": pred("""SELECT round(avg(conf) FILTER (WHERE NOT wrong), 4) AS avg_confidence_correct,
round(avg(conf) FILTER (WHERE wrong), 4) AS avg_confidence_incorrect FROM ann""", ann=ROWS),
    "eval_error_sample": pred("""SELECT doc_id, CASE WHEN length(review) > 250 THEN substr(review, 1, 250) || '...' ELSE review END AS review,
CASE WHEN label = 1 THEN 'Positive' ELSE 'Negative' END AS true_sentiment,
CASE WHEN prediction = 1 THEN 'Positive' ELSE 'Negative' END AS predicted_sentiment, round(conf, 4) AS confidence,
CAST(words AS BIGINT) AS length_words, outcome AS error_type,
CASE WHEN negated THEN 'Negation / Polarity Inversion' WHEN words < 15 THEN 'Short / Sparse Context'
     ELSE 'Mixed Sentiment / Sarcasm' END AS apparent_cause
FROM ann WHERE wrong ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id LIMIT 8""", ann=ROWS),
    "class_balance": with_views("fx_corpus", BALANCE),
    "class_weights": with_views("fx_corpus", """SELECT doc_id, CASE WHEN label = 1 THEN positive_weight ELSE negative_weight END
AS class_weight FROM fx_corpus, bal""", bal=BALANCE),
    "experiment_table": pred(_metrics("cuts", "experiment"), cuts=CUTS),
    "experiment_best": pred("SELECT * FROM res ORDER BY f1 DESC, accuracy DESC, experiment LIMIT 1", cuts=CUTS,
                            res=_metrics("cuts", "experiment")),
    "experiment_delta": pred("""SELECT r.experiment, r.accuracy, r.f1, round(r.accuracy - b.accuracy, 4) AS delta_accuracy,
round(r.f1 - b.f1, 4) AS delta_f1 FROM res r, (SELECT * FROM res WHERE experiment = 'cut-40') b""", cuts=CUTS,
                             res=_metrics("cuts", "experiment")),
    "sentiment_names": pred("SELECT doc_id, CASE WHEN prediction = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment FROM fx_predictions"),
}
