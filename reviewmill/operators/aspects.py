"""Aspect detection and aspect statistics."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex
from reviewmill.functions import rules
from reviewmill.functions import text as tx
from reviewmill.functions.names import free_names


def keyword_pattern(words: list[str]) -> str:
    """Case-insensitive whole-word alternation."""
    return starting_word(words) + r"\b"


def starting_word(words: list[str]) -> str:
    """One of the words at a word's start; the first letter is tested before the border, as it turns more places away."""
    test, rest = tx.one_of(words).split(")", 1)
    return rf"(?i){test})\b{rest}"


def clause_pattern(contrast: list[str] = lex.CONTRAST_WORDS, punctuation: str = lex.CLAUSE_PUNCTUATION) -> str:
    """Sentence ends, or a contrast word with the comma before it."""
    ends = "".join("\\n" if c == "\n" else c for c in punctuation)
    first = "".join(sorted({word[0] for word in contrast}))
    return rf"(?i)(?=[{ends},{first}])(?:[{ends}]+|(?:,\s+)?\b{tx.one_of(contrast)}\b)"


def clauses(text: Column | str) -> Column:
    """Clauses longer than three characters, or the whole text if there is none."""
    col = tx.as_column(text)
    pieces = F.transform(F.split(col, clause_pattern()), lambda c: tx.strip_space(c))
    kept = F.filter(pieces, lambda c: F.length(c) > 3)
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(tx.strip_space(col)))


def keyword_starts(dictionary: dict[str, list[str]]) -> tuple[str, dict[str, list[str]]]:
    """A pattern whose first group is the longest keyword at each place where one starts, and each aspect's keywords.

    The match itself is empty, so a keyword inside or across another one is found at its own start. A keyword that begins with a
    keyword of another aspect counts for that aspect too.
    """
    every = [w for words in dictionary.values() for w in words]
    owned = {aspect: sorted({w.lower() for w in every if any(re.match(rf"{re.escape(k)}\b", w, re.IGNORECASE) for k in words)})
             for aspect, words in dictionary.items()}
    test, rest = tx.one_of(every).split(")", 1)
    return rf"(?i){test})\b(?=({rest})\b)", owned


def _entries(reviews: DataFrame, text: str, marked: str, dictionary: dict[str, list[str]],
             named: Column | None = None) -> tuple[DataFrame, Column]:
    """``reviews`` with the clauses that hold keywords, and an array of (aspect, context) made of them; an empty context is none.

    A text is cut into clauses once, and each clause is searched once for all keywords; the aspects then look at the few words
    found. Texts that are not ``named`` hold no keyword and are not cut. The work is per row: no shuffle.
    """
    pattern, owned = keyword_starts(dictionary)
    body = F.col(text)
    pieces, = free_names([*reviews.columns, marked], "pieces")
    cut = F.filter(F.transform(F.split(body, clause_pattern()), lambda c: tx.strip_space(c)), lambda c: F.length(c) > 3)
    rows = reviews.withColumn(pieces, cut if named is None else F.when(named, cut))
    whole = F.when(F.size(pieces) > 0, F.col(pieces)).when(F.col(pieces).isNotNull(), F.array(tx.strip_space(body)))
    found = F.transform(whole, lambda c: F.struct(
        c.alias("clause"), F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda w: F.lower(w)).alias("words")))
    found = F.filter(found, lambda m: F.size(m["words"]) > 0)
    rows = rows.withColumn(marked, F.coalesce(found, F.array().cast("array<struct<clause:string,words:array<string>>>"))).drop(pieces)

    def entry(aspect: str, words: list[str]) -> Column:
        own = F.filter(F.col(marked), lambda m: F.exists(m["words"], lambda w: w.isin(words)))
        return F.struct(F.lit(aspect).alias("aspect"), F.array_join(own["clause"], " ... ").alias("context"))

    return rows, F.array(*[entry(a, w) for a, w in owned.items()])


def with_aspects(reviews: DataFrame, text: str, out: str, dictionary: dict[str, list[str]] = lex.ASPECT_KEYWORDS) -> DataFrame:
    """``reviews`` with an array of (aspect, context): the clauses that mention each aspect (F10-F12), in dictionary order."""
    marked, = free_names([*reviews.columns, out], "marked")
    named = F.coalesce(F.col(text).rlike(keyword_pattern([w for words in dictionary.values() for w in words])), F.lit(False))
    rows, entries = _entries(reviews, text, marked, dictionary, named)
    return rows.withColumn(out, F.filter(entries, lambda e: e["context"] != "")).drop(marked)


def aspect_contexts(reviews: DataFrame, text: str, keep: list[str],
                    dictionary: dict[str, list[str]] = lex.ASPECT_KEYWORDS) -> DataFrame:
    """One row per review and aspect it mentions, with the clauses that mention it.

    Texts without any keyword are dropped by a scan-side filter. The filter on contexts follows the explosion, so that the
    optimizer does not repeat the search in a condition of its own.
    """
    marked, = free_names([*reviews.columns, "aspect", "context"], "marked")
    any_keyword = keyword_pattern([w for words in dictionary.values() for w in words])
    rows, entries = _entries(reviews.filter(F.col(text).rlike(any_keyword)), text, marked, dictionary)
    return rows.select(*keep, F.inline(entries)).filter(F.col("context") != "")


def mentions_aspect(text: Column | str, aspect: str,
                    dictionary: dict[str, list[str]] = lex.ASPECT_KEYWORDS) -> Column:
    """Whether a clause of the text mentions the aspect; the explorer's aspect filter."""
    pattern = keyword_pattern(dictionary[aspect])
    return tx.as_column(text).rlike(pattern) & F.exists(clauses(text), lambda c: c.rlike(pattern))


def aspect_stats(rows: DataFrame, positive: Column, score: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mentions, class counts, shares and mean confidence per aspect.

    ``positive`` is a condition on a row of ``rows``; ``keys`` adds grouping columns.
    """
    measures = [
        F.count(F.lit(1)).alias("mentions"),
        F.count_if(positive).alias("positive_mentions"),
        F.count_if(~positive).alias("negative_mentions"),
    ]
    if score:
        measures.append(F.round(F.avg(score) * 100, 2).alias("avg_confidence"))
    stats = rows.groupBy(*keys, "aspect").agg(*measures)
    return stats.withColumns({
        "positive_pct": F.round(F.col("positive_mentions") / F.col("mentions") * 100, 2),
        "negative_pct": F.round(F.col("negative_mentions") / F.col("mentions") * 100, 2),
    })


def with_status(stats: DataFrame, pct: float = 40.0, volume: int = 50, concern: float = 28.0) -> DataFrame:
    """Pain-point flag, status and class of each aspect."""
    negative, mentions = F.col("negative_pct"), F.col("mentions")
    pain = rules.aspect_is_pain(negative, mentions, pct, volume)
    return stats.withColumns({
        "is_pain_point": pain,
        "status": rules.aspect_status(negative, mentions, pct, volume, concern),
        "classification": F.when(pain, "Potential Customer Pain Point").otherwise("Standard Aspect"),
    })


def pain_points(stats: DataFrame, **limits) -> DataFrame:
    """Aspects with a high share of negative mentions, worst first, with the total volume."""
    total = stats.agg(F.sum("mentions")).scalar()
    note = F.format_string("%s%% negative feedback across %,d mentions.", F.col("negative_pct").cast("string"),
                           F.col("mentions"))
    return (
        with_status(stats, **limits).filter("is_pain_point")
        .select("aspect", "negative_pct", "mentions", "status", note.alias("note"),
                total.alias("total_aspect_mentions"))
        .orderBy(F.desc("negative_pct"), "aspect")
    )


def aspect_rollup(results: DataFrame, keys: tuple[str, ...] = (), empty: float | None = None) -> DataFrame:
    """Aspect results of many analyses added up (A18). ``empty`` is the share without mentions."""
    sums = results.groupBy(*keys, "aspect").agg(
        F.sum("mentions").alias("mentions"),
        F.sum("positive_count").alias("positive_count"),
        F.sum("negative_count").alias("negative_count"),
    )
    share = tx.percent(F.col("positive_count"), F.col("mentions"), 1, empty)
    return sums.withColumn("positive_pct", share).withColumn(
        "negative_pct", F.round(F.lit(100.0) - F.col("positive_pct"), 1)
    )


def health_from_aspects(stats: DataFrame) -> DataFrame:
    """Mention-weighted positive share and its band."""
    weighted = F.sum(F.col("mentions") * F.col("positive_pct")) / F.sum("mentions")
    return stats.agg(
        F.sum("mentions").alias("total_aspect_mentions"),
        F.round(weighted, 0).cast("bigint").alias("score"),
    ).withColumn("status", rules.health_band(F.col("score")))

