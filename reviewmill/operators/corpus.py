"""Corpus preparation and description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex
from reviewmill.functions import text as tx


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows where any of the columns is null."""
    return df.dropna(subset=columns)


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose text is only blanks."""
    return df.filter(tx.non_blank(column))


def join_title(df: DataFrame, title: str = "title", body: str = "review", out: str = "review") -> DataFrame:
    """Title and body as one text."""
    return df.withColumn(out, F.concat_ws(" ", title, body))


def text_key(column: str) -> Column:
    """256-bit digest that stands for a text in comparisons and shuffles."""
    return F.sha2(F.col(column), 256)


def drop_duplicates(df: DataFrame, column: str, key: str) -> DataFrame:
    """One row per distinct text: the one with the lowest key.

    Grouping on the digest, as bytes, keeps the sort keys short, and copies meet in the
    partial aggregate, so a text that makes up a third of the rows sends one row
    per partition.
    """
    rest = [F.col(c) for c in df.columns]
    return (
        df.groupBy(F.unhex(text_key(column)).alias("_digest"))
        .agg(F.min_by(F.struct(*rest), F.col(key)).alias("_row"))
        .select("_row.*")
    )


def prepare(df: DataFrame, text: str = "review", key: str = "doc_id", title: str | None = None) -> DataFrame:
    """Null, blank and duplicate removal, optionally on title and body joined."""
    if title:
        df = join_title(drop_missing(df, [title, text]), title, text, text)
    else:
        df = drop_missing(df, [text])
    return drop_duplicates(drop_blank(df, text), text, key)


def cleaning_report(df: DataFrame, text: str = "review") -> DataFrame:
    """Rows before and after cleaning, without writing the cleaned rows (A5).

    The distinct count runs as two hash aggregates over digests.
    """
    kept = F.when(F.col(text).isNotNull() & tx.non_blank(text), text_key(text))
    per_text = df.groupBy(kept.alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count("digest").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def with_clean_text(df: DataFrame, text: str = "review", variant: str = "a", out: str = "clean_text",
                    length: str | None = "review_length") -> DataFrame:
    """Cleaned text and its length in words."""
    df = df.withColumn(out, tx.clean(text, variant))
    return df.withColumn(length, tx.word_count(out)) if length else df


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class (A1)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("reviews"))


def length_stats(df: DataFrame, length: str = "review_length") -> DataFrame:
    """Shortest, longest and mean text in words (A2)."""
    return df.agg(
        F.min(length).alias("min_words"), F.max(length).alias("max_words"),
        F.round(F.avg(length), 2).alias("avg_words"),
    )


def length_histogram(df: DataFrame, length: str = "review_length", width: int = 20, cap: int = 200) -> DataFrame:
    """Rows per length bucket, the last one open."""
    bucket = F.least(F.floor(F.col(length) / width) * width, F.lit(cap)).cast("bigint")
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("reviews"))


def word_counts(df: DataFrame, clean_text: str = "clean_text", stop_words: list[str] | None = None,
                min_length: int = 3) -> DataFrame:
    """Frequency of every word over all rows.

    Words are filtered after the explode, where the test runs as a hash lookup in
    generated code; counts combine before the shuffle.
    """
    banned = lex.english_stop_words() if stop_words is None else stop_words
    return (
        df.select(F.explode(F.split(F.col(clean_text), " ")).alias("word"))
        .filter((F.length("word") >= min_length) & ~F.col("word").isin(banned))
        .groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))
    )


def top_words(df: DataFrame, clean_text: str = "clean_text", k: int = 25,
              stop_words: list[str] | None = None) -> DataFrame:
    """The ``k`` most frequent words of the full data."""
    return word_counts(df, clean_text, stop_words).orderBy(F.desc("occurrences"), "word").limit(k)


def business_insights(df: DataFrame, label: str = "label", length: str = "review_length") -> DataFrame:
    """Totals, class shares and mean lengths in one pass."""
    positive, negative = F.col(label) == 1, F.col(label) == 0
    stats = df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(positive).alias("positive_reviews"),
        F.count_if(negative).alias("negative_reviews"),
        F.avg(length).alias("_all"),
        F.avg(F.when(positive, F.col(length))).alias("_pos"),
        F.avg(F.when(negative, F.col(length))).alias("_neg"),
    )
    return stats.select(
        "total_reviews", "positive_reviews", "negative_reviews",
        tx.percent(F.col("positive_reviews"), F.col("total_reviews"), 2).alias("percent_positive"),
        tx.percent(F.col("negative_reviews"), F.col("total_reviews"), 2).alias("percent_negative"),
        F.round("_all", 2).alias("avg_words_overall"),
        F.round("_pos", 2).alias("avg_words_positive"),
        F.round("_neg", 2).alias("avg_words_negative"),
        F.round(F.col("_neg") - F.col("_pos"), 2).alias("length_difference"),
    )


def dataset_facts(df: DataFrame, source: str) -> DataFrame:
    """Source, size and columns of a corpus (Q16)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(source).alias("source"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )
