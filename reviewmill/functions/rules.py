"""Row-level classification rules."""

from __future__ import annotations

import re

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex
from reviewmill.functions import text as tx

as_column = tx.as_column

# ---------------------------------------------------------------------------
# Names of buckets, causes, states and priorities, and the limits between them.
# ---------------------------------------------------------------------------
SHORT_BELOW, MEDIUM_TO = 15, 50
SHORT, MEDIUM, LONG = "Short (<15 words)", "Medium (15-50 words)", "Long (>50 words)"
NEGATED, SPARSE, MIXED = "Negation / Polarity Inversion", "Short / Sparse Context", "Mixed Sentiment / Sarcasm"
PAIN_PCT, PAIN_VOLUME, CONCERN_PCT = 40.0, 50, 28.0
PAIN, CONCERN, FINE = "High Negative Feedback", "Moderate Concern", "Healthy / Positive"
HEALTHY_FROM, HEALTHY, MODERATE = 75.0, "Healthy", "Moderate"
PRIORITIES = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}
IMPORT_STARS = 4


# --- filters --------------------------------------------------------------------

def matches_any(columns: list[str], term: str) -> Column:
    """Case-insensitive substring of any column; ``%`` and ``_`` are plain characters."""
    needle = F.lit(term.lower())
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(name)), needle), F.lit(False))
    return hit


def same_word(column: str, value: str) -> Column:
    return F.lower(F.col(column)) == F.lit(value.lower())


# --- prediction outcomes ---------------------------------------------------------

def outcome(label: Column | str = "label", prediction: Column | str = "prediction") -> Column:
    """TP, TN, FP or FN."""
    truth, guess = as_column(label), as_column(prediction)
    return (
        F.when((truth == 1) & (guess == 1), "TP")
        .when((truth == 0) & (guess == 0), "TN")
        .when((truth == 0) & (guess == 1), "FP")
        .otherwise("FN")
    )


def confidence(probability: Column | str = "probability", prediction: Column | str = "prediction") -> Column:
    """Probability of the predicted class, from an ML vector."""
    return F.element_at(vector_to_array(as_column(probability)), as_column(prediction).cast("int") + 1)


def sentiment_name(prediction: Column | str, positive: str = "POSITIVE", negative: str = "NEGATIVE") -> Column:
    return F.when(as_column(prediction) == 1, positive).otherwise(negative)


def has_negation(clean_text: Column | str, words: list[str] = lex.NEGATION_WORDS_TUNED) -> Column:
    """Whether unmarked text contains a negation word; run it before negation marking."""
    return as_column(clean_text).rlike(rf"\b({'|'.join(words)})\b")


def length_bucket(words: Column | str) -> Column:
    count = as_column(words)
    return (
        F.when(count < SHORT_BELOW, SHORT)
        .when(count <= MEDIUM_TO, MEDIUM)
        .otherwise(LONG)
    )


def error_cause(negated: Column | str, words: Column | str) -> Column:
    return (
        F.when(as_column(negated), NEGATED)
        .when(as_column(words) < SHORT_BELOW, SPARSE)
        .otherwise(MIXED)
    )


# --- status bands -----------------------------------------------------------------

def aspect_is_pain(negative_pct: Column, mentions: Column, pct: float = PAIN_PCT, volume: int = PAIN_VOLUME) -> Column:
    return (negative_pct >= pct) & (mentions >= volume)


def aspect_status(negative_pct: Column, mentions: Column, pct: float = PAIN_PCT, volume: int = PAIN_VOLUME,
                  concern: float = CONCERN_PCT) -> Column:
    """High, moderate or healthy, from the negative share and the number of mentions."""
    return (
        F.when(aspect_is_pain(negative_pct, mentions, pct, volume), PAIN)
        .when(negative_pct >= concern, CONCERN)
        .otherwise(FINE)
    )


def health_band(score: Column, healthy: float = HEALTHY_FROM) -> Column:
    return F.when(score >= healthy, HEALTHY).otherwise(MODERATE)


def priority_rank(priority: Column | str) -> Column:
    """HIGH=3, MEDIUM=2, LOW=1, so the largest is the most urgent."""
    col = as_column(priority)
    out = F.when(F.lit(False), 0)
    for name, rank in PRIORITIES.items():
        out = out.when(col == name, rank)
    return out.otherwise(0)


def priority_name(rank: Column | str) -> Column:
    col = as_column(rank)
    out = F.when(F.lit(False), "MEDIUM")
    for name, known in PRIORITIES.items():
        out = out.when(col == known, name)
    return out.otherwise("MEDIUM")


# --- rules on raw text ----------------------------------------------------------------

def import_is_positive(content: Column | str, rating: Column | str,
                       words: list[str] = lex.IMPORT_POSITIVE_WORDS) -> Column:
    """Polarity of an unscored import: four stars or a positive word anywhere (P20)."""
    return (as_column(rating) >= IMPORT_STARS) | F.lower(as_column(content)).rlike("|".join(words))


def guardrail(content: Column | str, negative: list[str] = lex.GUARDRAIL_NEGATIVE,
              positive: list[str] = lex.GUARDRAIL_POSITIVE, legacy: bool = False, cleaned: bool = False) -> Column:
    """0 or 1 if a decisive phrase occurs, else null; negative phrases are tried first.

    Text and phrases go through the same cleaning and match on word boundaries,
    so ``don't recommend`` is found and ``whatever`` is not ``hate``. With
    ``legacy=True`` contractions stay unexpanded and phrases match as substrings.
    ``cleaned=True`` takes text that has been through that cleaning already.
    """
    if legacy:
        body = tx.as_column(content) if cleaned else tx.squash(content)
        find = lambda phrases: body.rlike("|".join(re.escape(p) for p in phrases))
    else:
        body = tx.as_column(content) if cleaned else tx.clean_expanded(content)
        find = lambda phrases: body.rlike(
            rf"{tx.border(_expanded(phrases))}(?:{tx.word_alternation(_expanded(phrases))})\b")
    return F.when(find(negative), F.lit(0)).when(find(positive), F.lit(1))


def _expanded(phrases: list[str]) -> list[str]:
    """Phrases as the cleaned text spells them."""
    plain = []
    for phrase in phrases:
        spelled = phrase
        for short, full in lex.IRREGULAR_CONTRACTIONS.items():
            spelled = re.sub(rf"\b{short}\b", full, spelled)
        plain.append(spelled.replace("n't", " not"))
    return sorted(set(plain))


def phrase_aspect(phrase: Column | str, mapping: dict[str, list[str]] = lex.PHRASE_ASPECTS,
                  default: str = lex.GENERAL_ASPECT) -> Column:
    """Aspect whose keyword occurs anywhere in the phrase, in mapping order."""
    body = F.lower(as_column(phrase))
    out = None
    for aspect, words in mapping.items():
        hit = body.rlike("|".join(re.escape(w) for w in words))
        out = F.when(hit, aspect) if out is None else out.when(hit, aspect)
    return out.otherwise(default)


def signals_complaint(phrase: Column | str, words: list[str] = lex.COMPLAINT_WORDS) -> Column:
    """Whether any word of the phrase is a complaint word."""
    listed = [w for w in words if w and " " not in w]
    return F.lower(as_column(phrase)).rlike(rf"(?:^| ){tx.one_of(listed)}(?: |\z)") if listed else F.lit(False)


def ngram_type(phrase: Column | str) -> Column:
    return F.when(F.size(F.split(as_column(phrase), " ")) == 3, "Trigram").otherwise("Bigram")
