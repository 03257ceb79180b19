"""Corpus queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog.views import Views, with_views
from reviewmill.functions import lexicon as lex
from reviewmill.functions import text as tx
from reviewmill.operators import complaints, corpus, features, ranking


def sql_words(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# --- SQL building blocks, written without the library's expressions -------------------

def sql_squash(expr: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({expr}), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_expand(expr: str) -> str:
    """One replacement per contraction, in order, as nested calls."""
    rules = [(rf"\b{short}\b", full) for short, full in lex.IRREGULAR_CONTRACTIONS.items()]
    for verb in "could would should must do does did is was were are have has had".split():
        rules.append((rf"\b{verb}n't\b", f"{verb} not"))
    for suffix, (stems, full) in lex.SUFFIX_CONTRACTIONS.items():
        rules += [(rf"\b{stem}{suffix}\b", f"{stem} {full}") for stem in stems.split()]
    rules.append((r"n't\b", " not"))
    out = f"lower(translate({expr}, '’‘`´', ''''''''''))"
    for pattern, replacement in rules:
        out = "regexp_replace({}, '{}', '{}', 'g')".format(out, pattern.replace("'", "''"), replacement)
    return out


def sql_mark(expr: str) -> str:
    return (f"regexp_replace({expr}, '\\b(not|no|never|neither|nor|nothing|nowhere|hardly|barely|cannot)\\s+"
            "([a-z0-9]+)', '\\1_\\2', 'g')")


SQL_A, SQL_B = sql_squash("review"), sql_squash(sql_expand("review"))
SQL_C = sql_mark(SQL_B)
SQL_WORDS = "CASE WHEN c = '' THEN 0 ELSE len(string_split(c, ' ')) END"


def all_texts(v: Views):
    """Documents and reviews under one key."""
    docs = v.documents.select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"), "review")
    return docs.unionByName(v.reviews.select(F.concat(F.lit("L"), "id").alias("id"), F.col("content").alias("review")))


ALL_TEXTS = """SELECT 'D' || CAST(doc_id AS VARCHAR) AS id, text AS review FROM documents
UNION ALL SELECT 'L' || id, content FROM fx_reviews"""


def _clean(variant):
    def run(v: Views):
        source = all_texts(v)
        return source.select("id", tx.clean("review", variant).alias("clean_text"))
    return run


def _lengths(v: Views):
    return corpus.with_clean_text(v.corpus, "review")


LENGTHS = f"SELECT doc_id, label, c, {SQL_WORDS} AS n FROM (SELECT *, {SQL_A} AS c FROM fx_corpus) t"


def _tokens(v: Views):
    out = complaints.with_tokens(v.documents, "review")
    return out.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                      F.array_join("tokens", " ").alias("tokens"))


STOP = sql_words(lex.complaint_stop_words())
TOKENS = f"""SELECT doc_id, list_filter(string_split({sql_squash('text')}, ' '), lambda t: length(t) > 2
  AND NOT regexp_full_match(t, '[0-9]+') AND t NOT IN ({STOP})) AS w FROM documents"""


def sql_grams(n: int, source: str, key: str = "doc_id") -> str:
    joined = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(n))
    return (f"SELECT {key}, {joined} AS phrase FROM (SELECT {key}, w, unnest(range(1, len(w) - {n - 2})) AS i "
            f"FROM {source}) t")


def _grams(n: int):
    def run(v: Views):
        counts = complaints.phrase_counts(complaints.with_tokens(v.documents, "review"), sizes=(n,))
        return counts.orderBy(F.desc("frequency"), "phrase").limit(200)
    return run


def _sql_gram_top(n: int) -> str:
    return with_views("", f"""
SELECT phrase, CAST(count(*) AS BIGINT) AS frequency, count(DISTINCT doc_id) AS reviews
FROM ({sql_grams(n, 'tok')}) g WHERE length(phrase) > {complaints.MIN_PHRASE_LENGTH[n]}
GROUP BY phrase ORDER BY frequency DESC, phrase LIMIT 200""", tok=TOKENS)


def _title_body(v: Views):
    joined = corpus.prepare(v.reviews.withColumnRenamed("content", "review"), "review", "id", "title")
    return joined.select("id", "review")


QUERIES = {
    "corpus_clean_a": _clean("a"),
    "corpus_clean_b": _clean("b"),
    "corpus_clean_c": _clean("c"),
    "corpus_drop_blank": lambda v: corpus.drop_blank(corpus.drop_missing(v.documents, ["review"]), "review")
    .select("doc_id", F.length("review").cast("bigint").alias("chars")),
    "corpus_dedupe": lambda v: corpus.prepare(v.documents).select("doc_id", "title", "lang"),
    "corpus_title_body": _title_body,
    "corpus_cleaning_report": lambda v: corpus.cleaning_report(v.documents),
    "corpus_class_distribution": lambda v: corpus.class_distribution(v.corpus),
    "corpus_length_stats": lambda v: corpus.length_stats(_lengths(v)),
    "corpus_length_histogram": lambda v: corpus.length_histogram(_lengths(v)),
    "corpus_top_words": lambda v: corpus.top_words(
        v.documents.select(tx.clean("review", "a").alias("clean_text"))),
    "corpus_insights": lambda v: corpus.business_insights(_lengths(v)),
    "corpus_facts": lambda v: corpus.dataset_facts(v.corpus, "documents"),
    "tokens_filtered": _tokens,
    "ngram_bigrams": _grams(2),
    "ngram_trigrams": _grams(3),
    "split_by_key": lambda v: v.documents.select(
        "doc_id", (ranking.split_slot("doc_id") < 80).alias("is_train")),
    "sample_bernoulli": lambda v: ranking.bernoulli_sample(v.documents.select("doc_id", "lang"), "doc_id", 0.05),
    "tfidf_sql": lambda v: features.tfidf_table(
        v.documents.select("doc_id", tx.clean("review", "a").alias("clean_text")), "doc_id"),
}

_DEDUPED = """SELECT doc_id, source AS title, lang FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
  WHERE text IS NOT NULL AND length(trim(text)) > 0) t WHERE rn = 1"""

ORACLES = {
    **{f"corpus_clean_{name}": with_views("fx_reviews", f"SELECT id, {sql} AS clean_text FROM texts", texts=ALL_TEXTS)
       for name, sql in (("a", SQL_A), ("b", SQL_B), ("c", SQL_C))},
    "corpus_drop_blank": """SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents
WHERE text IS NOT NULL AND length(trim(text)) > 0""",
    "corpus_dedupe": _DEDUPED,
    "corpus_title_body": with_views("fx_reviews", """SELECT id, review FROM (
  SELECT id, review, row_number() OVER (PARTITION BY review ORDER BY id) AS rn
  FROM (SELECT id, title || ' ' || content AS review FROM fx_reviews
        WHERE title IS NOT NULL AND content IS NOT NULL) a WHERE length(trim(review)) > 0) t WHERE rn = 1"""),
    "corpus_cleaning_report": f"""SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed
FROM (SELECT (SELECT count(*) FROM documents) AS b, (SELECT count(*) FROM ({_DEDUPED}) d) AS a) t""",
    "corpus_class_distribution": with_views("fx_corpus", "SELECT label, count(*) AS reviews FROM fx_corpus GROUP BY label"),
    "corpus_length_stats": with_views("fx_corpus", """SELECT CAST(min(n) AS BIGINT) AS min_words,
CAST(max(n) AS BIGINT) AS max_words, round(avg(n), 2) AS avg_words FROM lengths""", lengths=LENGTHS),
    "corpus_length_histogram": with_views("fx_corpus", """SELECT CAST(CASE WHEN n >= 200 THEN 200 ELSE n - n % 20 END AS BIGINT)
AS bucket, count(*) AS reviews FROM lengths GROUP BY 1""", lengths=LENGTHS),
    "corpus_top_words": f"""SELECT word, count(*) AS occurrences FROM (
  SELECT unnest(string_split({sql_squash('text')}, ' ')) AS word FROM documents) t
WHERE length(word) > 2 AND word NOT IN ({sql_words(lex.english_stop_words())})
GROUP BY word ORDER BY occurrences DESC, word LIMIT 25""",
    "corpus_insights": with_views("fx_corpus", """SELECT count(*) AS total_reviews,
CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive_reviews,
CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_reviews,
round(sum(label) / count(*) * 100, 2) AS percent_positive,
round(sum(1 - label) / count(*) * 100, 2) AS percent_negative,
round(avg(n), 2) AS avg_words_overall, round(avg(CASE WHEN label = 1 THEN n END), 2) AS avg_words_positive,
round(avg(CASE WHEN label = 0 THEN n END), 2) AS avg_words_negative,
round(avg(CASE WHEN label = 0 THEN n END) - avg(CASE WHEN label = 1 THEN n END), 2) AS length_difference
FROM lengths""", lengths=LENGTHS),
    "corpus_facts": with_views("fx_corpus", """SELECT 'documents' AS source, count(*) AS rows, CAST(5 AS BIGINT) AS columns,
'doc_id,label,title,review,lang' AS column_names FROM fx_corpus"""),
    "tokens_filtered": with_views("", """SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens,
array_to_string(w, ' ') AS tokens FROM tok""", tok=TOKENS),
    "ngram_bigrams": _sql_gram_top(2),
    "ngram_trigrams": _sql_gram_top(3),
    "split_by_key": """SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT)
% 100 < 80 AS is_train FROM documents""",
    "sample_bernoulli": """SELECT doc_id, lang FROM documents
WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 10000 < 500""",
    "tfidf_sql": with_views("", """SELECT t.doc_id, t.term, t.tf, d.df,
round(t.tf * ln((SELECT count(*) + 1 FROM documents) / CAST(d.df + 1 AS DOUBLE)), 6) AS tfidf
FROM tf t JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2) d ON d.term = t.term""",
                            tf=f"""SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest(string_split({sql_squash('text')}, ' ')) AS term FROM documents) w
WHERE term <> '' AND term NOT IN ({sql_words(lex.english_stop_words())}) GROUP BY doc_id, term"""),
}
