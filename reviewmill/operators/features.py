"""TF-IDF features: MLlib stages and their SQL form (M1-M4)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF, IDFModel, NGram, StopWordsRemover, Tokenizer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill import session
from reviewmill.functions import hashing
from reviewmill.functions import lexicon as lex
from reviewmill.functions import text as tx

NAMES = {1: "uni", 2: "bi", 3: "tri"}
#: Length of the feature vector of each n-gram size. Terms are hashed to it, so none is dropped and no vocabulary is gathered.
DIMENSIONS = 1 << 16
#: Column of the count vectors of all n-gram sizes.
COUNTS = "counts"


def tfidf_stages(ngrams: tuple[int, ...] = (1, 2), dims: int | dict[int, int] = DIMENSIONS, min_df: float = 2.0,
                 stop_words: list[str] | None = None, input_col: str = "clean_text") -> list:
    """Stages from cleaned text to a ``features`` vector (M1-M3); the last one, the weights of all places, is the only one to be fitted.

    Terms that share a place of the vector share its weight. Places that fewer than ``min_df`` documents fill weigh nothing.
    ``stop_words=None`` takes Spark's list; ``lexicon.sentiment_stop_words()`` keeps negations (M4).
    """
    remover = StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens")
    if stop_words is not None:
        remover = remover.setStopWords(stop_words)
    stages: list = [Tokenizer(inputCol=input_col, outputCol="tokens"), remover]
    outputs = []
    for n in ngrams:
        name, source = NAMES[n], "filtered_tokens"
        if n > 1:
            source = f"{name}grams"
            stages.append(NGram(n=n, inputCol="filtered_tokens", outputCol=source))
        size = dims[n] if isinstance(dims, dict) else dims
        out = COUNTS if len(ngrams) == 1 else f"{name}_counts"
        stages.append(HashingTF(inputCol=source, outputCol=out, numFeatures=size))
        outputs.append(out)
    if len(ngrams) > 1:
        stages.append(VectorAssembler(inputCols=outputs, outputCol=COUNTS))
    return [*stages, IDF(inputCol=COUNTS, outputCol="features", minDocFreq=int(min_df))]


def counted(stages: list, rows: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Stored count vectors of ``rows``: texts are taken apart and hashed once, whatever is fitted on the counts.

    The words come from the first two stages. The vectors are those of the stages that follow, counted for whole Arrow batches
    in the tasks, and stored in the form in which the library stores its own.
    """
    words = stages[1].getOutputCol()
    cut = PipelineModel(stages=stages[:2]).transform(rows)
    line = F.when(F.size(words) > 0, F.array_join(words, " "))
    vectors = cut.select(*columns, _counter(stages)(line).alias(COUNTS))
    schema = T.StructType([*[vectors.schema[c] for c in columns], T.StructField(COUNTS, VectorUDT(), True, _length(stages))])
    return session.publish(vectors, label, schema)


def _counter(stages: list):
    """A function of words, with blanks between them, to their count vector."""
    by_source = {stage.getOutputCol(): stage.getN() for stage in stages if isinstance(stage, NGram)}
    sizes = [(by_source.get(stage.getInputCol(), 1), stage.getNumFeatures()) for stage in stages if isinstance(stage, HashingTF)]

    @F.arrow_udf("struct<type:tinyint,size:int,indices:array<int>,values:array<double>>")
    def counts(texts: pa.Array) -> pa.Array:
        return hashing.count_vectors(texts, sizes)

    return counts


def weighed(weights: IDFModel, counts: DataFrame, columns: list[str]) -> DataFrame:
    """Feature vectors of count vectors."""
    size = counts.schema[COUNTS].metadata
    return weights.transform(counts).select(*columns, F.col("features").alias("features", metadata=size))


def hashers(model: PipelineModel) -> list[HashingTF]:
    return [stage for stage in model.stages if isinstance(stage, HashingTF)]


def training_vectors(model: PipelineModel, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Feature vectors whose metadata is their length alone, which is all a classifier needs."""
    return model.transform(rows).select(*columns, F.col("features").alias("features", metadata=_length(model.stages)))


def _length(stages: list) -> dict:
    return {"ml_attr": {"num_attrs": sum(stage.getNumFeatures() for stage in stages if isinstance(stage, HashingTF))}}


def hashed_place(terms: DataFrame, column: str, dims: int, out: str = "index") -> DataFrame:
    """Append the place of each term in a hashed vector; the vector of one term prints as (size,[place],[1.0])."""
    hashed = HashingTF(inputCol="_one", outputCol="_vector", numFeatures=dims).transform(terms.withColumn("_one", F.array(column)))
    place = F.regexp_extract(F.col("_vector").cast("string"), r"\[([0-9]+)\]", 1).cast("int")
    return hashed.withColumn(out, place).drop("_one", "_vector")


def term_index(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(term, documents, index): every term of ``rows`` with its place in the model's feature vector."""
    cut = PipelineModel(stages=[s for s in model.stages if isinstance(s, (Tokenizer, StopWordsRemover, NGram))]).transform(rows)
    offset, out = 0, None
    for stage in hashers(model):
        terms = cut.select(F.explode(F.array_distinct(stage.getInputCol())).alias("term")).groupBy("term")
        placed = hashed_place(terms.agg(F.count(F.lit(1)).alias("documents")), "term", stage.getNumFeatures())
        placed = placed.withColumn("index", F.col("index") + offset)
        offset += stage.getNumFeatures()
        out = placed if out is None else out.unionByName(placed)
    return out


HOT_TERMS = 10000
#: Bytes of text that one task takes apart; its terms, as rows of a hash table, take some twenty times as much.
TASK_TEXT = 8 << 20


def dealt(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Texts by key in as many partitions as their bytes ask for.

    Spark would merge small partitions by their size before the texts are taken apart, and a task would hold the terms of them all.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return texts.repartition(-(-size // TASK_TEXT) or 1, F.col(key))


def term_frequencies(df: DataFrame, key: str, text: str = "clean_text", n: int = 1,
                     stop_words: list[str] | None = None) -> DataFrame:
    """Count of every term in every document.

    Documents are placed by key before they are taken apart, so the count needs no
    further shuffle: what moves is the text once, not one row per word. The texts are
    read once more for their size, so pass a stored table.
    """
    banned = lex.english_stop_words() if stop_words is None else stop_words
    words = F.filter(F.split(F.col(text), " "), lambda t: (t != "") & ~t.isin(banned))
    placed = dealt(df.select(key, text), key, text).select(key, words.alias("_words"))
    terms = placed.select(key, F.explode(tx.ngrams("_words", n)).alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_table(df: DataFrame, key: str, text: str = "clean_text", n: int = 1, min_df: int = 2,
                stop_words: list[str] | None = None) -> DataFrame:
    """TF-IDF weights as rows, for vocabularies of any size.

    A term in a third of all documents would put their rows into one task of a join on
    the term. The ``HOT_TERMS`` most frequent terms, a fixed number of rows, are
    therefore broadcast and their document rows never move; all others have few
    document rows each and meet their frequency in an ordinary join. Counts and
    frequencies are stored, so the texts are read once.
    """
    df = session.publish(df.select(key, text), "texts")
    counts = session.publish(term_frequencies(df, key, text, n, stop_words), "counts")
    documents = df.agg(F.count(F.lit(1))).scalar()
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    frequency = session.publish(frequency, "frequency")
    hot = frequency.orderBy(F.desc("df"), "term").limit(HOT_TERMS)
    names = F.broadcast(hot.select("term"))
    rare = counts.join(names, "term", "left_anti").join(frequency.join(names, "term", "left_anti"), "term")
    found = counts.join(F.broadcast(hot), "term").unionByName(rare)
    return found.select(
        key, "term", "tf", "df",
        F.round(F.col("tf") * F.log((documents + 1) / (F.col("df") + 1)), 6).alias("tfidf"),
    )


def feature_table(df: DataFrame, key: str, text: str = "clean_text", ngrams: tuple[int, ...] = (1,), min_df: int = 2,
                  stop_words: list[str] | None = None) -> DataFrame:
    """Document count and mean TF-IDF weight of every term (M1-M3), for vocabularies of any size.

    The inverse document frequency is one number per term, so texts and counts per term are all that is shuffled. Cleaned texts are
    stored and read once for each n-gram size.
    """
    df = session.publish(df.select(key, text), "texts")
    counts = term_frequencies(df, key, text, ngrams[0], stop_words)
    for n in ngrams[1:]:
        counts = counts.unionByName(term_frequencies(df, key, text, n, stop_words))
    documents = df.agg(F.count(F.lit(1))).scalar()
    terms = counts.groupBy("term").agg(F.count(F.lit(1)).alias("documents"), F.sum("tf").alias("_tf")).filter(F.col("documents") >= min_df)
    weight = F.col("_tf") * F.log((documents + 1) / (F.col("documents") + 1)) / documents
    return terms.select("term", "documents", F.round(weight, 6).alias("mean_tfidf"))
