"""Complaint mining over negative reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import session
from reviewmill.functions import lexicon as lex
from reviewmill.functions import rules
from reviewmill.functions import text as tx
from reviewmill.functions.names import free_names
from reviewmill.operators import ranking

MIN_PHRASE_LENGTH = {2: 4, 3: 6}  # fixed values: a phrase must be longer than this (P26)
ANCHOR = 3                        # characters taken from each side of a word gap


def with_tokens(df: DataFrame, text: str, stop_words: list[str] | None = None, out: str = "tokens",
                normalize: bool = True) -> DataFrame:
    """Content words of a text; ``normalize=False`` if it is already cleaned."""
    words = lex.complaint_stop_words() if stop_words is None else stop_words
    clean = tx.squash(text) if normalize else F.col(text)
    return df.withColumn(out, tx.content_tokens(clean, words))


def long_enough(phrases: Column, limit: int) -> Column:
    return F.filter(phrases, lambda p: F.length(p) > limit)


def phrase_counts(df: DataFrame, tokens: str = "tokens", sizes: tuple[int, ...] = (2, 3),
                  only_signals: bool = False) -> DataFrame:
    """Occurrences of every n-gram and the number of reviews that contain it.

    One scan and one shuffle serve all sizes and both counts: each review emits its
    phrases once per occurrence and once more per distinct phrase, and both sums
    combine before the shuffle. With ``only_signals`` other phrases never leave
    the map side.
    """
    per_size = [long_enough(tx.ngrams(tokens, n), MIN_PHRASE_LENGTH.get(n, 0)) for n in sizes]
    phrases = df.select(F.concat(*per_size).alias("_phrases"))
    marked = F.concat(
        F.transform("_phrases", lambda p: F.struct(p.alias("phrase"), F.lit(1).alias("n"), F.lit(0).alias("r"))),
        F.transform(F.array_distinct("_phrases"),
                    lambda p: F.struct(p.alias("phrase"), F.lit(0).alias("n"), F.lit(1).alias("r"))),
    )
    rows = phrases.select(F.inline(marked))
    if only_signals:
        rows = rows.filter(rules.signals_complaint("phrase"))
    return rows.groupBy("phrase").agg(F.sum("n").alias("frequency"), F.sum("r").alias("reviews"))


def with_shares(counts: DataFrame, negatives: DataFrame) -> DataFrame:
    """Type, aspect and both percentages of each phrase.

    ``percentage`` divides occurrences by reviews; ``review_pct`` divides distinct
    reviews by reviews (D10). The total enters as a scalar subquery.
    """
    total = negatives.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        "phrase",
        rules.ngram_type("phrase").alias("n_gram_type"),
        "frequency",
        F.round(F.col("frequency") / total * 100, 2).alias("percentage"),
        F.round(F.col("reviews") / total * 100, 2).alias("review_pct"),
        rules.phrase_aspect("phrase").alias("aspect"),
    )


def _by_frequency() -> list[Column]:
    return [F.desc("frequency"), F.col("phrase")]


def top_phrases(negatives: DataFrame, text: str, k: int = 25, size: int = 2,
                stop_words: list[str] | None = None) -> DataFrame:
    """Most frequent n-grams of one size, complaint or not."""
    counts = phrase_counts(with_tokens(negatives, text, stop_words), sizes=(size,))
    best = counts.orderBy(*_by_frequency()).limit(k)
    return with_shares(best, negatives)


def mined_complaints(negatives: DataFrame, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """Every phrase with a complaint word, with its shares; filtered before any top-k."""
    counts = phrase_counts(with_tokens(negatives, text, stop_words), only_signals=True)
    return with_shares(counts, negatives)


def top_complaints(negatives: DataFrame, text: str, k: int = 25,
                   stop_words: list[str] | None = None) -> DataFrame:
    """Most frequent complaint phrases of both sizes."""
    counts = phrase_counts(with_tokens(negatives, text, stop_words), only_signals=True)
    return with_shares(counts.orderBy(*_by_frequency()).limit(k), negatives)


def complaints_by_aspect(complaints: DataFrame, k: int = 6) -> DataFrame:
    """Up to ``k`` complaints per aspect; an aspect without any keeps one empty row."""
    spark = complaints.sparkSession
    names = [*lex.PHRASE_ASPECTS, lex.GENERAL_ASPECT]
    aspects = spark.createDataFrame([(name,) for name in names], "aspect string")
    best = ranking.top_per_group(complaints, ["aspect"], _by_frequency(), k)
    # Six names on the left; the right side holds at most 6 * k rows.
    return aspects.join(best, "aspect", "left")


# --- matching phrases in single reviews --------------------------------------------

def _pattern_rows(patterns: list[tuple[str, str]], kind: Column | None) -> list[tuple[Column, str]]:
    rows = []
    for phrase, aspect in patterns:
        n_type = kind if kind is not None else F.lit("Trigram" if len(phrase.split()) == 3 else "Bigram")
        rows.append((F.struct(F.lit(phrase).alias("phrase"), n_type.alias("n_gram_type"),
                              F.lit(aspect).alias("aspect")), phrase))
    return rows


def matched_patterns(content: Column | str, known: list[tuple[str, str, str]] = (), limit: int | None = None,
                     patterns: list[tuple[str, str]] = lex.COMPLAINT_PATTERNS) -> Column:
    """Complaints found in one text: known phrases first, then the built-in ones.

    ``known`` holds (phrase, type, aspect). A phrase is reported once, in list order. ``limit`` is for
    showing a single review, where five are displayed; counts take all. The list is
    short by contract; use ``match_phrases`` for a table of phrases.
    """
    return _matched(F.lower(tx.as_column(content)), known, limit, patterns)


def _matched(lowered: Column, known: list[tuple[str, str, str]] = (), limit: int | None = None,
             patterns: list[tuple[str, str]] = lex.COMPLAINT_PATTERNS) -> Column:
    """Complaints found in a text in lower case."""
    candidates, seen = [], set()
    for phrase, kind, aspect in known:
        if phrase not in seen:
            seen.add(phrase)
            candidates.append((F.struct(F.lit(phrase).alias("phrase"), F.lit(kind).alias("n_gram_type"),
                                        F.lit(aspect).alias("aspect")), phrase))
    candidates += _pattern_rows([p for p in patterns if p[0] not in seen], None)
    # Joined arrays run in generated code; dropping nulls from an array of all candidates would not.
    none = F.array().cast("array<struct<phrase:string,n_gram_type:string,aspect:string>>")
    found = F.concat(none, *[F.when(F.contains(lowered, F.lit(phrase)), F.array(row)).otherwise(none) for row, phrase in candidates])
    return F.slice(found, 1, limit) if limit else found


def complaint_matches(reviews: DataFrame, content: str = "content", keep: list[str] = ("id",),
                      **options) -> DataFrame:
    """One row per complaint found in each review; texts are put in lower case once, ahead of the search."""
    body, = free_names(reviews.columns, "body")
    return reviews.select(*keep, F.lower(F.col(content)).alias(body)).select(*keep, F.inline(_matched(F.col(body), **options)))


def phrase_gaps(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(phrase, a, b, anchor): a row for each blank of each phrase of two or more words.

    A text that contains the phrase has, around one of its single blanks, the end of the word before and the start of the word
    after. The anchor is that end and start, at most three characters each; ``a`` and ``b`` are their lengths.
    """
    words = F.split(F.col("phrase"), " ")
    pairs = F.arrays_zip(F.slice(words, F.lit(1), F.size(words) - 1).alias("l"), F.slice(words, F.lit(2), F.size(words) - 1).alias("r"))
    several = phrases.select(F.col(phrase).alias("phrase")).filter(F.contains("phrase", F.lit(" "))).distinct()
    cut = several.select("phrase", F.inline(pairs).alias("l", "r"))
    cut = cut.withColumns({"a": F.least(F.length("l"), F.lit(ANCHOR)), "b": F.least(F.length("r"), F.lit(ANCHOR))})
    return cut.select("phrase", "a", "b", F.concat(F.right("l", F.col("a")), F.lit(" "), F.left("r", F.col("b"))).alias("anchor"))


def _text_anchors(body: Column, shapes: list[tuple[int, int]]) -> Column:
    """The distinct anchors around the blanks of a text."""
    words = F.split(body, " ")
    gaps = F.greatest(F.size(words) - 1, F.lit(0))
    around = F.zip_with(F.slice(words, F.lit(1), gaps), F.slice(words, F.lit(2), gaps), lambda l, r: F.array(*[
        F.concat(F.right(l, F.lit(a)), F.lit(" "), F.left(r, F.lit(b))) for a, b in shapes or [(ANCHOR, ANCHOR)]]))
    return F.array_distinct(F.flatten(around))


def file_phrases(bodies: DataFrame, gaps: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """(phrase, anchor, texts): each phrase under that of its anchors which the fewest texts hold.

    A phrase of which an anchor occurs in no text is left out, as it cannot occur either. Anchors are counted in a partial
    aggregate, so an anchor that every text holds sends one row a task.
    """
    wanted = gaps.select("anchor").distinct()
    held = bodies.select(F.explode(_text_anchors(F.col("body"), shapes)).alias("anchor")).join(wanted, "anchor", "left_semi")
    counts = held.groupBy("anchor").agg(F.count(F.lit(1)).alias("texts"))
    filed = gaps.join(counts, "anchor", "left").groupBy("phrase").agg(
        F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "anchor")).alias("least"))
    return filed.select("phrase", "least.anchor", "least.texts").filter("texts > 0")


#: Bits of the filter of candidate keys: 512 bitmaps of 32,768 bits each, 2 MB in all.
BITMAPS = 512


def _only_candidates(rows: DataFrame, key: str, candidates: DataFrame) -> DataFrame:
    """Rows whose key may be among the candidates, by a bit for the key's digest; most others never move."""
    return may_match(rows, [key], candidates)


def may_match(rows: DataFrame, keys: list[str], candidates: DataFrame, bitmaps: int = BITMAPS) -> DataFrame:
    """Rows whose keys may be among the candidates' by a bit for their digest, 4 kB a bitmap.

    The filter has a fixed size. Where it fills up it lets more rows pass, and the join that follows settles them.
    """
    passes, = free_names(rows.columns, "passes")
    return _marked(rows, keys, candidates, passes, bitmaps).filter(passes).drop(passes)


def _marked(rows: DataFrame, keys: list[str], candidates: DataFrame, out: str, bitmaps: int = BITMAPS) -> DataFrame:
    """Rows with whether their keys may be among the candidates'; no row moves."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(bitmaps * 32768)) + 1  # bitmaps count positions from 1
    bits = candidates.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    bucket, held = free_names([*rows.columns, out], "bucket", "bits")
    bits = bits.select(F.col("bucket").alias(bucket), F.col("bits").alias(held))
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(held), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    passes = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) != 0, F.lit(False))
    found = rows.withColumn(bucket, F.bitmap_bucket_number(slot)).join(F.broadcast(bits), bucket, "left")
    return found.withColumn(out, passes).drop(bucket, held)


#: Phrase tables of up to so many bytes travel to the texts.
SENT = 8 << 20
#: Texts whose pairs one task makes distinct.
TASK_TEXTS = 100_000


def match_phrases(reviews: DataFrame, phrases: DataFrame, content: str = "content", key: str = "id",
                  phrase: str = "phrase", sent: int = SENT) -> DataFrame:
    """Reviews and the phrases of a table that occur in them as substrings, as distinct pairs.

    Each phrase is filed under the rarest of the anchors around its blanks, by counts over the texts. A text emits its distinct
    anchors and meets the few phrases filed there; ``contains`` settles them. The filed phrases travel to the texts if they have
    at most ``sent`` bytes, and no text moves. A larger table meets (key, anchor) pairs in a shuffled join, and a filter of a
    fixed size over the candidates' keys sees to it that of the texts only the candidates move.

    A phrase of one word lies inside a word of the text. The distinct words of all texts meet those phrases over runs
    of up to three letters, and the texts then fetch the phrases of their words. Those words that hold a phrase travel to the texts
    under the same limit, as a word that most texts hold would bring them all into one task.

    Where the phrases travel, a text yields no pair twice, so pairs are made distinct, which moves them all, for those texts only
    whose key occurs again. Digests of the keys, counted, tell which: a filter of a fixed size over those found more than once.

    ``phrases`` is read several times, so pass a stored table.
    """
    gaps = session.publish(phrase_gaps(phrases, phrase), "gaps")
    # At most 16 pairs of lengths; mined phrases have words of three or more letters, hence one.
    shapes = [(r.a, r.b) for r in gaps.select("a", "b").distinct().collect()]
    digests = reviews.groupBy(F.xxhash64(key).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    several = session.publish(digests.filter("n > 1").select("digest"), "repeated")
    texts = reviews.select(F.col(key).alias("key"), F.lower(F.col(content)).alias("body"), F.xxhash64(key).alias("digest"))
    unique = several.isEmpty()
    texts = (texts.withColumn("again", F.lit(False)) if unique else _marked(texts, ["digest"], several, "again")).drop("digest")
    bodies = texts.select("key", "body")
    filed = session.publish(file_phrases(reviews.select(F.lower(F.col(content)).alias("body")), gaps, shapes).drop("texts"), "filed")
    size = filed.agg(F.coalesce(F.sum(F.octet_length("phrase") + F.octet_length("anchor") + 32), F.lit(0))).first()[0]
    anchors = F.explode(_text_anchors(F.col("body"), shapes)).alias("anchor")
    inside = _words_with_phrases(reviews.select(F.split(F.lower(F.col(content)), " ").alias("_words")), phrases, phrase)
    travels = inside.agg(F.coalesce(F.sum(F.octet_length("_word") + F.octet_length("phrase") + 32), F.lit(0))).first()[0] <= sent

    def matches(rows: DataFrame) -> DataFrame:
        """Pairs of the phrases that travel; each once for a row of texts, as a phrase counts with the first word that holds it."""
        met = rows.select("key", "body", anchors).join(F.broadcast(filed), "anchor").filter(F.contains("body", F.col("phrase")))
        pairs = [met.select("key", "phrase")] if size <= sent else []
        if travels:
            words = rows.select("key", F.array_distinct(F.split("body", " ")).alias("_words"))
            held = words.select("key", "_words", F.explode("_words").alias("_word")).join(F.broadcast(inside), "_word")
            first = F.get(F.filter("_words", lambda w: F.contains(w, F.col("phrase"))), F.lit(0))
            pairs.append(held.filter(first == F.col("_word")).select("key", "phrase"))
        return reduce(DataFrame.unionByName, pairs) if pairs else None

    moved = [] if unique else [matches(texts.filter("again"))]
    if size > sent:
        candidates = session.publish(bodies.select("key", anchors).join(filed, "anchor").select("key", "phrase"), "candidates")
        held = candidates.distinct().withColumnRenamed("key", "held")  # a text without a key has pairs as well
        met = held.join(_only_candidates(bodies, "key", candidates), F.col("held").eqNullSafe(F.col("key")))
        moved.append(met.filter(F.contains("body", F.col("phrase"))).select("key", "phrase"))
    if not travels:
        moved.append(bodies.select("key", F.explode(F.array_distinct(F.split("body", " "))).alias("_word")).join(inside, "_word")
                     .select("key", "phrase"))
    tasks = -(-reviews.count() // TASK_TEXTS) or 1
    moved = [part for part in moved if part is not None]
    whole = [part for part in [matches(texts.filter("not again"))] if part is not None]
    if moved:
        whole.append(reduce(DataFrame.unionByName, moved).repartition(tasks, "key", "phrase").distinct())
    return reduce(DataFrame.unionByName, whole).select(F.col("key").alias(key), F.col("phrase").alias(phrase)).coalesce(tasks)


def _runs(word: str, n: int) -> Column:
    """All runs of ``n`` letters of a word; a shorter word is its own run."""
    places = F.sequence(F.lit(1), F.greatest(F.length(word) - (n - 1), F.lit(1)))
    return F.transform(places, lambda at: F.substring(word, at, F.lit(n)))


def _words_with_phrases(cut: DataFrame, phrases: DataFrame, phrase: str) -> DataFrame:
    """Words of texts, cut into ``_words``, with the phrases without a blank that lie inside them; stored."""
    single = phrases.filter(~F.contains(F.col(phrase), F.lit(" ")) & (F.length(phrase) > 0)).select(phrase).distinct()
    single = single.withColumn("_run", F.left(F.col(phrase), F.lit(ANCHOR)))
    lengths = sorted(r[0] for r in single.select(F.length("_run")).distinct().collect())  # at most 3
    words = cut.select(F.explode(F.array_distinct("_words")).alias("_word")).distinct()
    runs = F.flatten(F.array(*[_runs("_word", n) for n in lengths or [ANCHOR]]))
    known = words.select("_word", F.explode(F.array_distinct(runs)).alias("_run"))
    inside = known.join(single, "_run").filter(F.contains(F.col("_word"), F.col(phrase))).select("_word", F.col(phrase).alias("phrase")).distinct()
    return session.publish(inside, "inside")
