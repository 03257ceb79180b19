"""From raw documents to token ids: language, near duplicates, repeated passages, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a table that is stored as Parquet
in the shared folder before the next stage reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.names import free_names
from reviewmill.llm import bpe, decontam, langid, linededup, neardup
from reviewmill.session import publish

#: A text of which fewer runs of three letters occur in the training windows is in no language that was learned.
LEAST_FAMILIAR = 0.5
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the network has learned; nulls, texts without letters and unfamiliar ones go."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    label, score, familiar = free_names(docs.columns, "lang_pred", "score", "familiar")
    judged = langid.predict(docs, model, out=label, score=score, familiar=familiar)
    known = judged.filter((F.col(label) != langid.UNDETERMINED) & (F.col(familiar) >= LEAST_FAMILIAR))
    return known.select(*[F.col(f"`{name}`") for name in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest doc_id of every group with similarity >= 0.8 on five-word shingles."""
    linked = neardup.link(docs.select("doc_id", "text"), width=5, percent=80)
    gone = linked.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{name}`") for name in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document holds; documents of which nothing is left go."""
    spans = ("removed", "kept")  # columns of these names are the documents' own and stay
    own = [name for name in docs.columns if name.lower() in spans]
    aside = dict(zip(own, free_names([*docs.columns, *spans], *[f"own_{name}" for name in own]), strict=True))
    cut = linededup.dedup(docs.withColumnsRenamed(aside)).filter(F.col("text").isNotNull() & (F.trim("text") != ""))
    columns = [F.char_length("text").cast("long").alias(n) if n == "n_chars" else F.col(f"`{aside.get(n, n)}`").alias(n) for n in docs.columns]
    return cut.select(*columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold less than 0.8 of the five-word shingles of every benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontam.contained(docs.select("doc_id", "text"), items).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*[F.col(f"`{name}`") for name in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANK_FILE, public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]

#: Language, components and tokens are beyond SQL. tests/llm/test_pipeline.py holds each stage against its operator, and the tests of
#: the operators hold those against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = publish(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
