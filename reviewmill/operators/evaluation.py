"""Classifier evaluation and error analysis over prediction rows.

Inputs are rows with ``label`` and ``prediction``, and ``score`` (probability or
margin of the positive class) where a curve is wanted. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex
from reviewmill.functions import rules
from reviewmill.functions import text as tx
from reviewmill.operators import ranking, running


def confusion(preds: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Confusion counts in one aggregate."""
    kind = rules.outcome()
    return preds.groupBy(*keys).agg(*[F.count_if(kind == name).alias(name.lower()) for name in ("TP", "TN", "FP", "FN")])


def metrics(preds: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 from the confusion counts."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    total, pos, neg = tp + tn + fp + fn, tp + fn, tn + fp

    def safe(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    p1, r1 = safe(tp, tp + fp), safe(tp, pos)
    p0, r0 = safe(tn, tn + fn), safe(tn, neg)
    f1, f0 = safe(2 * p1 * r1, p1 + r1), safe(2 * p0 * r0, p0 + r0)
    return confusion(preds, keys).select(
        *keys,
        F.round((tp + tn) / total, 4).alias("accuracy"),
        F.round((p1 * pos + p0 * neg) / total, 4).alias("precision"),
        F.round((r1 * pos + r0 * neg) / total, 4).alias("recall"),
        F.round((f1 * pos + f0 * neg) / total, 4).alias("f1"),
    )


# --- ROC curve and AUC ---------------------------------------------------------------

def _score_groups(preds: DataFrame, score: str) -> DataFrame:
    """Positives and negatives per distinct score; ties collapse before the shuffle."""
    return preds.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def cumulative_counts(preds: DataFrame, score: str = "score") -> DataFrame:
    """Per distinct score, class counts at this score and strictly above it (W3): running totals in falling order."""
    return running.totals_before(_score_groups(preds, score), [F.desc("score")], {
        "pos_above": F.col("pos"), "neg_above": F.col("neg"), "rank_above": F.lit(1).cast("bigint")})


def auc(preds: DataFrame, score: str = "score") -> DataFrame:
    """Exact area under the ROC curve; ties count half."""
    curve = cumulative_counts(preds, score)
    area = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2))
    pos, neg = F.sum("pos"), F.sum("neg")
    return curve.agg(F.when((pos > 0) & (neg > 0), F.round(area / pos / neg, 4)).alias("roc_auc"))


def roc_curve(preds: DataFrame, score: str = "score", points: int | None = None) -> DataFrame:
    """Curve points from (0, 0) in order of falling score; ``points`` thins them evenly."""
    curve = cumulative_counts(preds, score)
    whole = preds.agg(F.struct(
        F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))).scalar()
    pos, neg = whole["p"], whole["n"]

    def rate(part: Column, all_: Column) -> Column:
        return F.when(all_ > 0, F.round(part / all_, 6)).otherwise(0.0)

    rows = curve.select(
        (F.col("rank_above") + 1).cast("bigint").alias("point"),
        rate(F.col("neg_above") + F.col("neg"), neg).alias("fpr"),
        rate(F.col("pos_above") + F.col("pos"), pos).alias("tpr"),
    )
    start = preds.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("point"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    rows = start.unionByName(rows)
    if points:
        size = _score_groups(preds, score).agg(F.count(F.lit(1)) + 1).scalar()
        step = F.greatest(F.lit(1), F.floor(size / points)).cast("bigint")
        rows = rows.filter(F.col("point") % step == 0)
    return rows


# --- error analysis -------------------------------------------------------------------

def annotate(preds: DataFrame, text: str = "review", negations: list[str] = lex.NEGATION_WORDS_TUNED,
             confidence: Column | None = None) -> DataFrame:
    """Outcome, correctness, negation flag, length, bucket and confidence of each row.

    The negation flag reads cleaned but unmarked text, since a marked ``not_good`` no longer
    holds the word ``not`` (D2). Contractions are spelled out, so ``didn't`` counts.
    """
    out = preds.withColumn("clean_text", tx.clean_expanded(text))
    out = out.withColumns({
        "outcome": rules.outcome(),
        "is_correct": F.col("label") == F.col("prediction"),
        "has_negation": rules.has_negation("clean_text", negations),
        "review_length": tx.word_count("clean_text"),
    }).withColumn("length_bucket", rules.length_bucket("review_length"))
    return out.withColumn("confidence", confidence) if confidence is not None else out


def error_summary(rows: DataFrame) -> DataFrame:
    """Totals, error rate and error kinds in one aggregate."""
    wrong = ~F.col("is_correct")
    return rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_correct").alias("correct"),
        F.count_if(wrong).alias("incorrect"),
        F.count_if(F.col("outcome") == "FP").alias("false_positives"),
        F.count_if(F.col("outcome") == "FN").alias("false_negatives"),
    ).withColumn("error_rate", tx.ratio(F.col("incorrect"), F.col("total"), 4))


def negation_errors(rows: DataFrame) -> DataFrame:
    """How often negation occurs overall and among errors (A10)."""
    wrong, negated = ~F.col("is_correct"), F.col("has_negation")
    sums = rows.agg(
        F.count(F.lit(1)).alias("_total"), F.count_if(wrong).alias("_wrong"),
        F.count_if(negated).alias("with_negation"), F.count_if(wrong & negated).alias("errors_with_negation"),
    )
    hits = F.col("errors_with_negation")
    return sums.select(
        "with_negation", "errors_with_negation",
        tx.ratio(hits, F.col("with_negation"), 4).alias("negation_error_rate"),
        tx.percent(F.col("with_negation"), F.col("_total"), 2).alias("overall_negation_pct"),
        tx.percent(hits, F.col("_wrong"), 2).alias("error_negation_pct"),
    )


def length_errors(rows: DataFrame) -> DataFrame:
    """Errors and mean confidence per length bucket."""
    return rows.groupBy("length_bucket").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.col("is_correct")).alias("errors"),
        F.round(F.avg("confidence"), 4).alias("avg_confidence"),
    ).withColumn("error_rate", tx.ratio(F.col("errors"), F.col("total"), 4))


def confidence_split(rows: DataFrame) -> DataFrame:
    """Mean confidence of right and of wrong predictions."""
    return rows.agg(
        F.round(F.avg(F.when(F.col("is_correct"), F.col("confidence"))), 4).alias("avg_confidence_correct"),
        F.round(F.avg(F.when(~F.col("is_correct"), F.col("confidence"))), 4).alias("avg_confidence_incorrect"),
    )


def error_examples(rows: DataFrame, key: str, k: int = 8, text: str = "review", size: int = 250,
                   seed: int = 42) -> DataFrame:
    """Seeded sample of wrong predictions with their apparent cause."""
    picked = ranking.seeded_sample(rows.filter(~F.col("is_correct")), key, k, seed)
    return picked.select(
        key, tx.shorten(text, size).alias("review"),
        rules.sentiment_name("label", "Positive", "Negative").alias("true_sentiment"),
        rules.sentiment_name("prediction", "Positive", "Negative").alias("predicted_sentiment"),
        F.round("confidence", 4).alias("confidence"), F.col("review_length").alias("length_words"),
        F.col("outcome").alias("error_type"),
        rules.error_cause("has_negation", "review_length").alias("apparent_cause"),
    )


# --- class balance and experiments ------------------------------------------------------

def class_balance(df: DataFrame, label: str = "label", threshold: float = 0.05) -> DataFrame:
    """Class shares, imbalance, whether to weight, and inverse-frequency weights."""
    sums = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positive"),
        F.count_if(F.col(label) == 0).alias("negative"),
    )
    n, pos, neg = F.col("rows"), F.col("positive"), F.col("negative")
    gap = F.abs(pos / n - neg / n)
    return sums.select(
        "rows", "positive", "negative",
        F.round(pos / n, 4).alias("positive_fraction"), F.round(neg / n, 4).alias("negative_fraction"),
        F.round(gap, 4).alias("imbalance"), (gap > threshold).alias("use_weights"),
        F.when(pos > 0, F.round(n / (2 * pos), 6)).alias("positive_weight"),
        F.when(neg > 0, F.round(n / (2 * neg), 6)).alias("negative_weight"),
    )


def with_class_weight(df: DataFrame, label: str = "label", out: str = "class_weight") -> DataFrame:
    """Weight n / (2 * class size) on every row, from one scalar aggregate."""
    balance = class_balance(df, label)
    pos, neg = balance.select("positive_weight").scalar(), balance.select("negative_weight").scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, pos).otherwise(neg))


def best_experiment(results: DataFrame, name: str = "experiment") -> DataFrame:
    """Experiment with the highest F1, then accuracy, then the first name."""
    rank = F.struct(-F.col("f1"), -F.col("accuracy"), F.col(name))
    return results.agg(F.min_by(F.struct(*results.columns), rank).alias("_best")).select("_best.*")


def deltas(results: DataFrame, baseline: str, name: str = "experiment") -> DataFrame:
    """Change of every metric against one experiment of the results table."""
    base = results.filter(F.col(name) == baseline)
    columns = [c for c in ("accuracy", "f1", "roc_auc") if c in results.columns]
    return results.select(
        name, *columns,
        *[F.round(F.col(c) - base.select(c).scalar(), 4).alias(f"delta_{c}") for c in columns],
    )


def best_first() -> list[Column]:
    return [F.desc("f1"), F.desc("accuracy"), F.col("experiment")]


def ordered_results(results: DataFrame) -> DataFrame:
    """Results table, best first."""
    return results.orderBy(*best_first())
