"""Writing tables, reports and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex


# --- report sinks ----------------------------------------------------------------------

def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_section(df: DataFrame, root: str, section: str) -> None:
    """One section of the consolidated report; the others stay as they are."""
    df.write.mode("overwrite").json(f"{root.rstrip('/')}/section={section}")


def read_section(spark: SparkSession, root: str, section: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/section={section}")


def write_text(df: DataFrame, column: str, path: str) -> None:
    """Plain text, one value per line."""
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


# --- models -----------------------------------------------------------------------------

def save_model(model: PipelineModel, path: str, score: float | None = None, best: float | None = None) -> bool:
    """Save a fitted pipeline; with a previous best score, only if it is beaten."""
    if best is not None and (score is None or score <= best):
        return False
    model.write().overwrite().save(path)
    return True


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- rows with defaults -----------------------------------------------------------------------

def new_id(*keys):
    """Reproducible row id from its keys, columns or their names, so a retried task writes the same id.

    The keys together must be unique in the source. They are written as JSON with their nulls, so different keys
    never read the same.
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.sha2(F.to_json(F.struct(*[part.cast("string").alias(f"k{n}") for n, part in enumerate(parts)]), {"ignoreNullFields": "false"}), 256)


def review_rows(df: DataFrame, id_keys: list[str], now=None) -> DataFrame:
    """Review rows ready to append: ids and defaults filled (S13, P24). ``id_keys`` name a unique key of the source."""
    stamp = F.current_timestamp() if now is None else now
    have = set(df.columns)

    def col(name: str, kind: str) -> F.Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    score = col("sentiment_score", "double")
    return df.select(
        F.coalesce(F.nullif(col("id", "string"), F.lit("")), new_id(*id_keys)).alias("id"),
        "organization_id", "product_id", col("dataset_id", "string").alias("dataset_id"),
        F.coalesce(col("title", "string"), F.lit("")).alias("title"), "content",
        col("rating", "int").alias("rating"),
        F.coalesce(F.nullif(col("sentiment", "string"), F.lit("")), F.lit("POSITIVE")).alias("sentiment"),
        F.coalesce(F.nullif(score, F.lit(0.0)), F.lit(0.95)).alias("sentiment_score"),
        F.coalesce(col("review_date", "timestamp"), stamp).alias("review_date"), stamp.alias("created_at"),
    )


def aspect_rows(df: DataFrame, analysis_id, now=None) -> DataFrame:
    """Aspect results of an analysis with zero defaults."""
    stamp = F.current_timestamp() if now is None else now
    return df.withColumn("analysis_id", analysis_id).select(
        new_id("analysis_id", "product_id", "aspect").alias("id"), "analysis_id", "organization_id", "product_id",
        "aspect",
        *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in ("mentions", "positive_count", "negative_count")],
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("positive_pct", "negative_pct")],
        stamp.alias("created_at"),
    )


def issue_rows(df: DataFrame, analysis_id, now=None) -> DataFrame:
    """Issue results of an analysis with the defaults of each field."""
    stamp = F.current_timestamp() if now is None else now
    return df.withColumn("analysis_id", analysis_id).select(
        new_id("analysis_id", "product_id", "phrase", "aspect").alias("id"), "analysis_id", "organization_id",
        "product_id", F.coalesce("phrase", F.lit("")).alias("phrase"),
        F.coalesce(F.nullif("aspect", F.lit("")), F.lit(lex.GENERAL_ASPECT)).alias("aspect"),
        F.coalesce("frequency", F.lit(0)).cast("int").alias("frequency"),
        F.coalesce("percentage", F.lit(0.0)).alias("percentage"),
        F.coalesce(F.nullif("priority", F.lit("")), F.lit("MEDIUM")).alias("priority"),
        F.coalesce(F.nullif("negative_pct", F.lit(0.0)), F.lit(80.0)).alias("negative_pct"),
        stamp.alias("created_at"),
    )


def audit_rows(df: DataFrame, action: str, resource_type: str, details: list[str], id_keys: list[str],
               now=None) -> DataFrame:
    """Audit events with their details as JSON."""
    stamp = F.current_timestamp() if now is None else now
    return df.select(
        new_id(*id_keys).alias("id"), "organization_id", F.col("user_id").cast("string").alias("user_id"),
        F.lit(action).alias("action"), F.lit(resource_type).alias("resource_type"),
        F.to_json(F.struct(*details)).alias("details"), stamp.alias("created_at"),
    )


def append(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_reviews(df: DataFrame, path: str) -> None:
    """Append review rows by month of the review (S13). Rows of a month meet, in several tasks if they are many, before they are written."""
    months = df.withColumn("review_month", F.date_format("review_date", "yyyy-MM"))
    append(months.hint("rebalance", "review_month"), path, ["review_month"])


# --- merging ------------------------------------------------------------------------------------

def merge_latest(current: DataFrame, updates: DataFrame, keys: list[str], version: str = "updated_at",
                 created: str | None = "created_at", tie: str | None = None) -> DataFrame:
    """Last writer wins per key; the first creation time survives.

    One aggregate over the union: versions of a key combine before the shuffle, so
    a key that is rewritten very often stays cheap.
    """
    columns = current.columns
    rest = [c for c in columns if c not in keys]
    # On equal versions an update beats the stored row.
    union = current.withColumn("_side", F.lit(0)).unionByName(updates.select(*columns).withColumn("_side", F.lit(1)))
    order = F.struct(F.col(version), F.col("_side"), *([F.col(tie)] if tie else []))
    picked = [F.max_by(F.struct(*rest), order).alias("_row")]
    if created:
        picked.append(F.min(created).alias("_created"))
    merged = union.groupBy(*keys).agg(*picked)
    return merged.select(*[
        F.col(c) if c in keys else (F.col("_created").alias(c) if c == created else F.col(f"_row.{c}").alias(c))
        for c in columns
    ])
