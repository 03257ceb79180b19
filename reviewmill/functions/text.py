"""Text functions as Catalyst expressions.

Each takes and returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions import lexicon as lex


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def word_alternation(words: Iterable[str]) -> str:
    """Regex alternation, longest word first so a phrase wins over its prefix."""
    return "|".join(re.escape(word) for word in sorted(words, key=lambda w: (-len(w), w)))


def one_of(words: Iterable[str]) -> str:
    """Alternation behind a test of the first character, which turns most places of a text away at once.

    For use without regard to case. Words that begin alike share a branch, so at the other places only these few are tried.
    """
    listed = list(words)
    first = "".join(re.escape(c) for c in sorted({word[0].lower() for word in listed}))
    if not first.isascii():
        return rf"(?=[{first}])(?:{word_alternation(listed)})"
    groups: dict[str, list[str]] = {}
    for word in sorted(listed, key=lambda w: (-len(w), w)):
        groups.setdefault(word[0].lower(), []).append(word[1:])
    branches = (re.escape(c) + (f"(?:{'|'.join(re.escape(rest) for rest in rests)})" if rests != [""] else "") for c, rests in sorted(groups.items()))
    return rf"(?=[{first}])(?:{'|'.join(branches)})"


def border(words: Iterable[str]) -> str:
    r"""``\b`` ahead of one of these words, behind a test of the next character, which costs less than the border and fails at most places."""
    first = sorted({word[:1] for word in words})
    plain = first and all(c.isascii() and c.isalnum() for c in first)
    return rf"(?=[{''.join(first)}])\b" if plain else r"\b"


# --- cleaning -------------------------------------------------------------

def squash(text: Column | str) -> Column:
    """Lower-case and reduce every run of other characters to one space.

    ``[^a-z0-9]+`` covers both the punctuation and the white space, so one pass
    gives what a strip pass followed by a collapse pass would.
    """
    return F.trim(F.regexp_replace(F.lower(as_column(text)), "[^a-z0-9]+", " "))


def expand_contractions(text: Column | str) -> Column:
    """Spell out English contractions in lower-cased text with plain apostrophes.

    Regular negations (``couldn't``) all end in the suffix rule ``n't`` -> `` not``, so
    only the irregular ones need rules of their own. No expansion contains
    an apostrophe, hence rules cannot feed each other. Rows without an
    apostrophe skip the chain.
    """
    source = as_column(text)
    out = source
    for short, full in lex.IRREGULAR_CONTRACTIONS.items():
        out = F.regexp_replace(out, rf"{border([short])}{short}\b", full)
    out = F.regexp_replace(out, r"n't\b", " not")
    for suffix, (stems, full) in lex.SUFFIX_CONTRACTIONS.items():
        out = F.regexp_replace(out, rf"{border(stems.split())}({'|'.join(stems.split())}){suffix}\b", f"$1 {full}")
    return F.when(F.contains(source, F.lit("'")), out).otherwise(source)


def plain_apostrophes(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), f"[{lex.APOSTROPHES}]", "'")


def mark_negation(clean: Column | str, markers: list[str] = lex.NEGATION_MARKERS) -> Column:
    """Join a negation to its next word: ``not good`` -> ``not_good``, in one pass."""
    return F.regexp_replace(as_column(clean), rf"{border(markers)}({'|'.join(markers)})\s+([a-z0-9]+)", "$1_$2")


def clean_basic(text: Column | str) -> Column:
    """Variant A."""
    return squash(text)


def clean_expanded(text: Column | str) -> Column:
    """Variant B: contractions spelled out, then variant A."""
    return squash(expand_contractions(F.lower(plain_apostrophes(text))))


def clean_marked(text: Column | str) -> Column:
    """Variant C: variant B with negations marked."""
    return mark_negation(clean_expanded(text))


VARIANTS = {"a": clean_basic, "b": clean_expanded, "c": clean_marked}


def clean(text: Column | str, variant: str) -> Column:
    return VARIANTS[variant](text)


def strip_space(text: Column | str) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(as_column(text), F.lit(" \t\n\x0b\f\r"))


def non_blank(text: Column | str) -> Column:
    return F.length(F.trim(as_column(text))) > 0


def has_words(text: Column | str) -> Column:
    """Whether cleaning leaves anything, without cleaning.

    Besides ASCII letters and digits, two characters lower-case to ASCII letters:
    the dotted capital I and the Kelvin sign.
    """
    return as_column(text).rlike("[A-Za-z0-9\\u0130\\u212A]")


def word_count(clean_text: Column | str) -> Column:
    """Number of words in cleaned text; empty text has none."""
    col = as_column(clean_text)
    return F.when(col == "", F.lit(0)).otherwise(F.size(F.split(col, " "))).cast("bigint")


# --- tokens and n-grams -----------------------------------------------------

def tokenize(clean_text: Column | str) -> Column:
    return F.split(F.lower(as_column(clean_text)), r"\s")


def drop_words(tokens: Column | str, words: Iterable[str]) -> Column:
    """Remove stop words and keep duplicates; the list is hashed once per plan."""
    banned = list(words)
    return F.filter(as_column(tokens), lambda t: ~t.isin(banned))


def content_tokens(clean_text: Column | str, stop_words: Iterable[str], min_length: int = 3) -> Column:
    """Words of at least ``min_length`` characters that are neither numbers nor stop words."""
    banned = list(stop_words)
    return F.filter(
        F.split(as_column(clean_text), " "),
        lambda t: (F.length(t) >= min_length) & ~t.isin(banned) & ~t.rlike("^[0-9]+$"),
    )


def ngrams(tokens: Column | str, n: int) -> Column:
    """Adjacent ``n``-word phrases, empty when there are fewer than ``n`` words (F8)."""
    col = as_column(tokens)
    count = F.greatest(F.size(col) - F.lit(n - 1), F.lit(0))
    out = F.slice(col, F.lit(1), count)
    for start in range(2, n + 1):
        out = F.zip_with(out, F.slice(col, F.lit(start), count), lambda a, b: F.concat_ws(" ", a, b))
    return out


# --- display and small scalars -------------------------------------------------

def shorten(text: Column | str, size: int) -> Column:
    """First ``size`` characters plus an ellipsis, for display only."""
    col = as_column(text)
    return F.when(F.length(col) > size, F.concat(F.substring(col, 1, size), F.lit("..."))).otherwise(col)


def percent(part: Column, whole: Column, digits: int, empty: float | None = None) -> Column:
    """``part`` of ``whole`` in percent; ``empty`` when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(empty).cast("double"))


def ratio(part: Column, whole: Column, digits: int, empty: float | None = None) -> Column:
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(empty).cast("double"))


def slug(name: Column | str) -> Column:
    """Lower case with blanks and slashes as dashes (P25)."""
    return F.translate(F.lower(as_column(name)), " /", "--")


def parameter(text: Column | str, key: str) -> Column:
    """Value of ``key=value`` in a comma-separated parameter string."""
    found = F.regexp_extract(as_column(text), rf"(?:^|[\s,]){re.escape(key)}=([^,\s]+)", 1)
    return F.when(found != "", found)
