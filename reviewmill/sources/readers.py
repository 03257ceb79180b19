"""Scans and upload handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill import schemas
from reviewmill.functions import lexicon as lex


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = schemas.LABELLED_CORPUS,
                **options) -> DataFrame:
    """Labelled corpus with an explicit schema, so columns can never change places."""
    reader = spark.read.format(fmt).options(**options)
    # Parquet carries its own types; text formats take the schema's.
    df = reader.load(path) if fmt == "parquet" else reader.schema(schema).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_upload(spark: SparkSession, path: str, separator: str | None = None, multi_line: bool = True) -> DataFrame:
    """Delimited upload with a header row; ``.tsv`` means tabs (S3).

    Quoted values may hold line breaks, at the price of one task per file. ``multi_line=False`` splits files among tasks; it is
    for files known to have no line break inside quotes, whose records it would break.
    """
    sep = separator or ("\t" if path.rstrip("/").endswith(".tsv") else ",")
    return (
        spark.read.option("header", True).option("sep", sep).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"').csv(path)
    )


def column_roles(columns: list[str], roles: dict[str, list[str]] = lex.UPLOAD_ROLES) -> dict[str, str | None]:
    """Column that plays each role, by name and ignoring case; the first match wins."""
    return {role: next((c for c in columns if c.lower() in names), None) for role, names in roles.items()}


def by_role(upload: DataFrame) -> DataFrame:
    """Upload with its columns renamed to title, content and rating; missing roles are null."""
    found = column_roles(upload.columns)

    def pick(role: str) -> F.Column:
        return F.col(f"`{found[role]}`") if found[role] else F.lit(None)

    return upload.select(
        pick("title").cast("string").alias("title"), pick("text").cast("string").alias("content"),
        pick("rating").cast("string").try_cast("double").cast("int").alias("rating"),
    )


def upload_profile(upload: DataFrame) -> DataFrame:
    """Row counts, columns and detected roles of an upload in one pass."""
    found = column_roles(upload.columns)
    valid = F.count(F.col(f"`{found['text']}`")) if found["text"] else F.lit(0).cast("bigint")
    return upload.agg(F.count(F.lit(1)).alias("row_count"), valid.alias("valid_rows")).select(
        "row_count", "valid_rows", (F.col("row_count") - F.col("valid_rows")).alias("invalid_rows"),
        F.lit(",".join(upload.columns)).alias("columns"),
        F.lit(found["text"] is not None).alias("has_review_column"),
        *[F.lit(found[role]).cast("string").alias(f"detected_{role}_column") for role in ("text", "rating", "title")],
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows with nulls blanked."""
    head = df.limit(rows)
    return head.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def read_import(spark: SparkSession, path: str) -> DataFrame:
    """JSON review records, one per line."""
    return spark.read.schema(schemas.IMPORT_RECORD).json(path)


def import_records(raw: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Usable import rows: first non-empty text field, empty title and rating 4 by default."""
    text = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("content", "review", "text")])
    return raw.select(
        *keep, F.coalesce("title", F.lit("")).alias("title"), text.alias("content"),
        # A rating of zero counts as missing, like an absent one.
        F.coalesce(F.nullif("rating", F.lit(0)), F.lit(4)).cast("int").alias("rating"),
    ).filter(F.col("content").isNotNull())


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One relational table under its fixed schema."""
    return spark.read.format(fmt).schema(schemas.TABLES[name]).load(f"{root.rstrip('/')}/{name}")


def read_jdbc(spark: SparkSession, url: str, name: str, key: str | None = None, lower: int = 0, upper: int = 0,
              partitions: int = 1, **options) -> DataFrame:
    """One relational table over JDBC, split on a numeric key when one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if key:
        reader = (reader.option("partitionColumn", key).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", partitions))
    return reader.load()


def check_enums(df: DataFrame, table: str) -> DataFrame:
    """Rows whose enumerated columns hold allowed values; null is allowed."""
    for (name, column), values in schemas.ENUMS.items():
        if name == table and column in df.columns:
            df = df.filter(F.col(column).isNull() | F.col(column).isin(list(values)))
    return df
