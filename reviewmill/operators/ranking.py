"""Sorting, paging, top-k per group, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators import running

REVIEW_SORTS = {
    "default": lambda: F.col("review_date").desc(),
    "confidence_desc": lambda: F.col("sentiment_score").desc(),
    "longest": lambda: F.length("content").desc(),
    "shortest": lambda: F.length("content").asc(),
}


def review_order(sort_by: str = "default", tie: str = "id") -> list[Column]:
    """Sort keys of a named review order, made total by the id."""
    return [REVIEW_SORTS.get(sort_by, REVIEW_SORTS["default"])(), F.col(tie)]


def in_order(df: DataFrame, order: list[Column], place: str = "place", per: list[str] | None = None) -> DataFrame:
    """``df`` with the position of each row in the order, from 1, for each group of ``per`` anew (T1, T14); no task holds them all."""
    return running.numbered(df, order, place, per).withColumn(place, F.col(place) + 1)


def page(df: DataFrame, order: list[Column], number: int = 1, size: int = 20) -> DataFrame:
    """One page; each partition keeps only ``number * size`` rows before the merge (T5)."""
    skip = (number - 1) * size
    ordered = df.orderBy(*order)
    return ordered.offset(skip).limit(size) if skip else ordered.limit(size)


def page_after(df: DataFrame, seen: Column, order: list[Column], size: int = 20) -> DataFrame:
    """Next page by key: rows past the last one seen. Cost does not grow with depth."""
    return df.filter(seen).orderBy(*order).limit(size)


def page_counts(df: DataFrame, size: int = 20) -> DataFrame:
    """Total rows and number of pages, at least one."""
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"),
        F.greatest(F.lit(1), F.ceil(total / size)).cast("bigint").alias("total_pages"),
    )


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group.

    A row-number filter this small becomes a group limit before the shuffle, so a
    group holding a third of all rows still sends only ``k`` rows per partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint")).filter(F.col(rank) <= k)


def seeded_order(key: str, seed: int = 42) -> Column:
    """A reproducible shuffle order: digest of the key and the seed."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def seeded_sample(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """``k`` rows in a reproducible random order, as a per-partition top-k."""
    return df.orderBy(seeded_order(key, seed), F.col(key)).limit(k)


def bernoulli_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Sample of about ``fraction`` of the rows by a digest of their key (T9): the same rows however the table is stored."""
    return df.filter(digest_slot(key, 10_000, seed) < round(fraction * 10_000))


def digest_slot(key: str, slots: int, seed: int = 42) -> Column:
    """0..slots - 1 from a digest of the key: the same row gets the same slot in every run."""
    return F.pmod(F.conv(F.substring(seeded_order(key, seed), 1, 8), 16, 10).cast("bigint"), F.lit(slots))


def split_slot(key: str, seed: int = 42) -> Column:
    """0..99 from a digest of the key."""
    return digest_slot(key, 100, seed)


def split_by_key(df: DataFrame, key: str, train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by digest, independent of partitioning and retries."""
    slot = split_slot(key, seed)
    return df.filter(slot < train_percent), df.filter(slot >= train_percent)


def split_random(df: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> list[DataFrame]:
    """Spark's own seeded split, which depends on row order within partitions."""
    return df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
