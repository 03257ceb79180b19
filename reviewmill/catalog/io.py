"""Upload, import, upsert and sink queries.

Files are written from the given tables to the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill import session
from reviewmill.catalog.mining import ASPECT_CASE, CLAUSES, CONTEXTS, GRAMS, MATCHES, SIGNAL, TOKENS
from reviewmill.catalog.views import Views, with_views
from reviewmill.functions import rules
from reviewmill.functions import text as tx
from reviewmill.operators import kpis
from reviewmill.plans import jobs
from reviewmill.sources import readers, sinks, upserts


def _uploaded(v: Views, separator: str = ","):
    """All reviews as a delimited file with its own column names; some texts are missing."""
    path = session.scratch_path(v.spark, "upload") + (".tsv" if separator == "\t" else ".csv")
    text = F.when(F.col("rating") == 3, None).otherwise(F.col("content"))
    rows = v.reviews.select(F.col("id").alias("Key"), F.col("title").alias("Headline"), text.alias("Review"),
                            F.col("rating").alias("Stars"))
    rows.write.option("header", True).option("sep", separator).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_upload(v.spark, path)


def _imported(v: Views):
    """Reviews as JSON records whose text sits in different fields."""
    path = session.scratch_path(v.spark, "records")
    slot = F.col("rating") % 3
    rows = v.reviews.select(
        "title",
        F.when(slot == 0, F.col("content")).otherwise("").alias("content"),
        F.when(slot == 1, F.col("content")).alias("review"),
        F.when((slot == 2) & (F.col("rating") != 5), F.col("content")).alias("text"),
        F.when(F.col("rating") != 2, F.col("rating")).cast("int").alias("rating"),
    )
    rows.write.json(path)
    return readers.import_records(readers.read_import(v.spark, path))


def _classified(v: Views):
    return jobs.classify_imports(v.reviews.select("id", "organization_id", "product_id", "content", "rating"))


def _analysis(v: Views):
    """Import all reviews as one data set and read the stored analyses."""
    raw = v.reviews.select(
        "id", "organization_id", "product_id", "title", "content", F.lit(None).cast("string").alias("review"),
        F.lit(None).cast("string").alias("text"), F.col("rating").cast("int").alias("rating"))
    raw = raw.join(v.members.groupBy("organization_id").agg(F.min("user_id").alias("user_id")), "organization_id")
    out = session.scratch_path(v.spark, "tenant")
    first = jobs.import_and_analyse(raw, v.members, out, "upload-1")["analyses"]
    again = jobs.import_and_analyse(raw.filter("rating = 5"), v.members, out, "upload-2")["analyses"]
    both = first.unionByName(again)
    ids = both.agg(F.count_distinct("id")).scalar()
    return both.select("dataset_id", "organization_id", "product_id", "total", "positive_count", "negative_count", "health_score",
                       "status", ids.alias("distinct_ids"))


def _mined(v: Views):
    return jobs.mined_phrases(v.reviews)


def _stored_customers(v: Views):
    return v.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(1).cast("bigint").alias("updated_at"),
        F.lit(1).cast("bigint").alias("created_at"))


def _order_updates(v: Views):
    """Every order renames its customer; the latest order wins."""
    when = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 1_000_000 + F.col("o_orderkey")
    return v.table("orders").select(
        F.col("o_custkey").alias("id"), F.concat(F.lit("by order "), F.col("o_orderkey").cast("string")).alias("name"),
        when.alias("updated_at"), when.alias("created_at"))


def _merge(v: Views):
    return sinks.merge_latest(_stored_customers(v), _order_updates(v), ["id"])


def _upsert(v: Views):
    """The same merge through the stored table: first load, then the updates."""
    path = session.scratch_path(v.spark, "profiles")
    stored, updates = _stored_customers(v), _order_updates(v)
    upserts.upsert(stored, path, ["id"])
    upserts.compact(v.spark, path, tie="name")
    upserts.upsert(updates, path, ["id"])
    return upserts.read_upserted(v.spark, path, tie="name").select("id", "name", "updated_at", "created_at")


def _defaults(v: Views):
    gaps = v.reviews.select(
        F.col("id").alias("source_key"), F.when(F.col("rating") != 1, F.col("id")).alias("id"), "organization_id", "product_id", "content",
        F.when(F.col("rating") != 2, F.col("title")).alias("title"), "rating",
        F.when(F.col("rating") != 3, F.col("sentiment")).alias("sentiment"),
        F.when(F.col("rating") != 4, F.col("sentiment_score")).otherwise(0.0).alias("sentiment_score"),
    )
    path = session.scratch_path(v.spark, "reviews")
    sinks.append_reviews(sinks.review_rows(gaps, ["source_key"]), path)
    out = v.spark.read.parquet(path)
    return out.withColumn("kept_id", F.length("id") != 64).groupBy("product_id", "kept_id", "title", "sentiment").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.round(F.sum("sentiment_score"), 2).alias("score"))


def _sections(v: Views):
    """Two report sections, one of them replaced, read back."""
    root = session.scratch_path(v.spark, "report")
    by_class = v.reviews.groupBy("sentiment").agg(F.count(F.lit(1)).alias("reviews"))
    by_rating = v.reviews.groupBy(F.col("rating").cast("string").alias("sentiment")).agg(
        F.count(F.lit(1)).alias("reviews"))
    sinks.write_section(by_class, root, "classes")
    sinks.write_section(by_class, root, "ratings")
    sinks.write_section(by_rating, root, "ratings")
    schema = "sentiment string, reviews bigint"
    parts = [sinks.read_section(v.spark, root, s, schema).withColumn("section", F.lit(s)) for s in ("classes", "ratings")]
    return parts[0].unionByName(parts[1])


def _csv_report(v: Views):
    path = session.scratch_path(v.spark, "csv")
    sinks.write_csv(kpis.review_stats(v.reviews, "organization_id"), path)
    return v.spark.read.option("header", True).schema(
        "organization_id string, reviews bigint, positives bigint, negatives bigint").csv(path)


def _slugs(v: Views):
    """Slugs of all products, numbered where a name occurs again."""
    return kpis.unique_slugs(_named(v), "name", "created_seq").select("id", "slug")


def _named(v: Views):
    """Products of which every third is named like its neighbour, and every fifth like a numbered slug."""
    number = F.col("created_seq")
    name = F.when(number % 3 == 0, F.concat(F.lit("Item "), (number % 40).cast("string"))).when(
        number % 5 == 0, F.concat(F.lit("Item "), (number % 40).cast("string"), F.lit(" 2"))).otherwise(F.col("name"))
    return v.products.withColumn("name", name)


def _slug_facts(v: Views):
    return kpis.unique_slugs(_named(v), "name", "created_seq").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("slug").alias("slugs"))


def _parameters(v: Views):
    text = F.concat(F.lit("regParam="), F.col("p_retailprice").cast("string"), F.lit(", elasticNetParam="),
                    (F.col("p_size") / 100).cast("string"), F.lit(", maxIter="), F.col("p_size").cast("string"))
    rows = v.table("part").select("p_partkey", text.alias("params"))
    return rows.select("p_partkey", tx.parameter("params", "regParam").cast("double").alias("reg"),
                       tx.parameter("params", "maxIter").cast("bigint").alias("max_iter"),
                       tx.parameter("params", "tol").alias("tol"))


def _audit_rows(v: Views):
    events = v.table("events").select(
        F.col("event_id"), F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("organization_id"), "user_id",
        F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    out = sinks.audit_rows(events, "IMPORT", "REVIEW", ["kind", "k"], ["event_id"])
    return out.select("organization_id", "user_id", "action", "resource_type", "details")


def _corpus_read(v: Views):
    """The labelled corpus as JSON lines, read by column name."""
    path = session.scratch_path(v.spark, "corpus")
    v.corpus.select("title", "review", "label").write.json(path)
    return readers.read_corpus(v.spark, path, "json").groupBy("title", "label").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("review")).alias("chars"))


def _table_read(v: Views):
    """A relational table under its fixed schema; columns it does not hold are null."""
    root = session.scratch_path(v.spark, "tables")
    v.members.select(F.col("user_id").cast("string").alias("user_id"), "role", "organization_id").write.parquet(f"{root}/organization_members")
    return readers.read_table(v.spark, root, "organization_members").select("id", "organization_id", "user_id", "role")


def _text_report(v: Views):
    path = session.scratch_path(v.spark, "names")
    sinks.write_text(v.products, "name", path)
    return sinks.read_text(v.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("rows"))


def _aspect_table(v: Views):
    """Aspect results of one analysis per product, as stored."""
    path = session.scratch_path(v.spark, "aspects")
    key = sinks.new_id(F.lit("analysis"), "product_id", "organization_id")
    sinks.append(sinks.aspect_rows(jobs.product_aspects(v.reviews), key), path)
    stored = v.spark.read.parquet(path)
    ids = stored.agg(F.count_distinct("id")).scalar()
    return stored.select("organization_id", "product_id", "aspect", "mentions", "positive_count", "negative_count", ids.alias("distinct_ids"))


def _issue_table(v: Views):
    """Issue results of one analysis per product, as stored."""
    path = session.scratch_path(v.spark, "issues")
    key = sinks.new_id(F.lit("analysis"), "product_id", "organization_id")
    sinks.append(sinks.issue_rows(jobs.product_issues(v.reviews), key), path)
    stored = v.spark.read.parquet(path)
    ids = stored.agg(F.count_distinct("id")).scalar()
    return stored.select("organization_id", "product_id", "phrase", "aspect", "frequency", ids.alias("distinct_ids"))


QUERIES = {
    "corpus_read": _corpus_read,
    "table_read": _table_read,
    "report_text": _text_report,
    "aspect_table": _aspect_table,
    "issue_table": _issue_table,
    "preview_rows": lambda v: readers.preview(v.reviews.select("id", "title", F.when(F.col("rating") > 2, F.col("rating")).alias("rating")).orderBy("id")),
    "upload_profile": lambda v: readers.upload_profile(_uploaded(v)),
    "upload_profile_tsv": lambda v: readers.upload_profile(_uploaded(v, "\t")),
    "column_roles": lambda v: readers.by_role(_uploaded(v)).groupBy("title", "rating").agg(
        F.count(F.lit(1)).alias("rows"), F.count("content").alias("texts")),
    "import_records": lambda v: _imported(v).groupBy("content", "rating").agg(F.count(F.lit(1)).alias("rows")),
    "import_polarity": lambda v: v.reviews.select("id", rules.import_is_positive("content", "rating").alias("positive")),
    "import_summary": lambda v: kpis.import_summary(_classified(v), ("organization_id",)),
    "import_analysis": _analysis,
    "upsert_latest": _merge,
    "upsert_table": _upsert,
    "append_defaults": _defaults,
    "report_sections": _sections,
    "report_csv": _csv_report,
    "org_slug": _slugs,
    "org_slug_unique": _slug_facts,
    "import_mined_phrases": _mined,
    "param_extract": _parameters,
    "audit_append": _audit_rows,
}

_POSITIVE = ("rating >= 4 OR " + " OR ".join(
    f"contains(lower(content), '{w}')" for w in ("great", "love", "amazing", "perfect", "good", "best")))
_LATEST = """SELECT id, arg_max(name, updated_at) AS name, max(updated_at) AS updated_at, min(created_at) AS created_at
FROM (SELECT c_custkey AS id, c_name AS name, CAST(1 AS BIGINT) AS updated_at, CAST(1 AS BIGINT) AS created_at FROM customer
  UNION ALL SELECT o_custkey, 'by order ' || CAST(o_orderkey AS VARCHAR), w, w FROM (SELECT *,
    CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 1000000 + o_orderkey AS BIGINT) AS w FROM orders) o) t
GROUP BY id"""


def rev(body: str, **ctes: str) -> str:
    return with_views("fx_reviews", body, **ctes)


_PROFILE = rev("""SELECT count(*) AS row_count, count(CASE WHEN rating <> 3 THEN 1 END) AS valid_rows,
count(CASE WHEN rating = 3 THEN 1 END) AS invalid_rows, 'Key,Headline,Review,Stars' AS columns, true AS has_review_column,
'Review' AS detected_text_column, 'Stars' AS detected_rating_column, 'Headline' AS detected_title_column FROM fx_reviews""")

_NAMED = """SELECT *, row_number() OVER (PARTITION BY base ORDER BY created_seq) AS rn FROM (
  SELECT id, created_seq, replace(replace(lower(CASE WHEN created_seq % 3 = 0 THEN 'Item ' || CAST(created_seq % 40 AS VARCHAR)
    WHEN created_seq % 5 = 0 THEN 'Item ' || CAST(created_seq % 40 AS VARCHAR) || ' 2' ELSE name END), ' ', '-'), '/', '-') AS base
  FROM fx_products) p"""

ORACLES = {
    "corpus_read": with_views("fx_corpus", """SELECT title, label, count(*) AS rows, CAST(sum(length(review)) AS BIGINT) AS chars
FROM fx_corpus GROUP BY title, label"""),
    "table_read": with_views("fx_members", """SELECT CAST(NULL AS VARCHAR) AS id, organization_id, CAST(user_id AS VARCHAR) AS user_id, role
FROM fx_members"""),
    "report_text": with_views("fx_products", "SELECT name AS value, count(*) AS rows FROM fx_products GROUP BY name"),
    "aspect_table": with_views("fx_reviews", """SELECT organization_id, product_id, aspect, CAST(count(*) AS INTEGER) AS mentions,
CAST(count(*) FILTER (WHERE sentiment = 'POSITIVE') AS INTEGER) AS positive_count,
CAST(count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS INTEGER) AS negative_count, count(*) OVER () AS distinct_ids
FROM ctx GROUP BY organization_id, product_id, aspect""", clauses=CLAUSES, ctx=CONTEXTS),
    "issue_table": with_views("fx_reviews", """SELECT organization_id, product_id, m.phrase AS phrase, m.aspect AS aspect,
CAST(count(*) AS INTEGER) AS frequency, count(*) OVER () AS distinct_ids FROM matches WHERE sentiment = 'NEGATIVE'
GROUP BY organization_id, product_id, m.phrase, m.aspect""", matches=MATCHES),
    "preview_rows": with_views("fx_reviews", """SELECT id, title, CASE WHEN rating > 2 THEN CAST(rating AS VARCHAR) ELSE '' END AS rating
FROM fx_reviews ORDER BY id LIMIT 5"""),
    "upload_profile": _PROFILE,
    "upload_profile_tsv": _PROFILE,
    "column_roles": rev("""SELECT title, CAST(rating AS INTEGER) AS rating, count(*) AS rows,
count(CASE WHEN rating <> 3 THEN 1 END) AS texts FROM fx_reviews GROUP BY title, rating"""),
    "import_records": rev("""SELECT content, CAST(CASE WHEN rating = 2 THEN 4 ELSE rating END AS INTEGER) AS rating, count(*) AS rows
FROM fx_reviews WHERE rating <> 5 GROUP BY 1, 2"""),
    "import_polarity": rev(f"SELECT id, ({_POSITIVE}) AS positive FROM fx_reviews"),
    "import_summary": rev(f"""SELECT organization_id, count(*) AS total, count(*) FILTER (WHERE {_POSITIVE}) AS positive_count,
count(*) FILTER (WHERE NOT ({_POSITIVE})) AS negative_count,
CAST(round(round(count(*) FILTER (WHERE {_POSITIVE}) / count(*) * 100, 1), 0) AS BIGINT) AS health_score
FROM fx_reviews GROUP BY organization_id"""),
    "import_analysis": with_views("fx_reviews fx_members", f"""SELECT *, 'completed' AS status, count(*) OVER () AS distinct_ids FROM (
SELECT dataset_id, organization_id, product_id, count(*) AS total,
count(*) FILTER (WHERE {_POSITIVE}) AS positive_count, count(*) FILTER (WHERE NOT ({_POSITIVE})) AS negative_count,
CAST(round(round(count(*) FILTER (WHERE {_POSITIVE}) / count(*) * 100, 1), 0) AS BIGINT) AS health_score
FROM fx_reviews r, (SELECT unnest(['upload-1', 'upload-2']) AS dataset_id) d
WHERE (dataset_id = 'upload-1' OR rating = 5) AND organization_id IN (
  SELECT organization_id FROM fx_members m WHERE role <> 'viewer' AND user_id = (
    SELECT min(user_id) FROM fx_members x WHERE x.organization_id = m.organization_id))
GROUP BY dataset_id, organization_id, product_id) t"""),
    "import_mined_phrases": with_views("fx_reviews", f"""SELECT organization_id, product_id, phrase,
CASE len(string_split(phrase, ' ')) WHEN 3 THEN 'Trigram' ELSE 'Bigram' END AS n_gram_type, {ASPECT_CASE} AS aspect,
count(*) AS frequency, round(count(*) / any_value(n) * 100, 2) AS percentage
FROM grams JOIN neg USING (id) JOIN (SELECT product_id, count(*) AS n FROM neg GROUP BY 1) t USING (product_id)
WHERE {SIGNAL} GROUP BY organization_id, product_id, phrase""",
                                       neg="SELECT id, organization_id, product_id, content FROM fx_reviews WHERE sentiment = 'NEGATIVE'",
                                       tok=TOKENS, grams=GRAMS),
    "upsert_latest": _LATEST,
    "upsert_table": _LATEST,
    "append_defaults": rev("""SELECT product_id, rating <> 1 AS kept_id, CASE WHEN rating = 2 THEN '' ELSE title END AS title,
CASE WHEN rating = 3 THEN 'POSITIVE' ELSE sentiment END AS sentiment, count(*) AS rows, count(*) AS ids,
round(sum(CASE WHEN rating = 4 THEN 0.95 ELSE sentiment_score END), 2) AS score FROM fx_reviews GROUP BY 1, 2, 3, 4"""),
    "report_sections": rev("""SELECT sentiment, count(*) AS reviews, 'classes' AS section FROM fx_reviews GROUP BY sentiment
UNION ALL SELECT CAST(rating AS VARCHAR), count(*), 'ratings' FROM fx_reviews GROUP BY rating"""),
    "report_csv": rev("""SELECT organization_id, count(*) AS reviews, count(*) FILTER (WHERE sentiment = 'POSITIVE') AS positives,
count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS negatives FROM fx_reviews GROUP BY organization_id"""),
    "org_slug": with_views("fx_products", """SELECT id, CASE WHEN slug <> base AND slug IN (SELECT base FROM named)
  THEN slug || '-' || substr(sha256(CAST(created_seq AS VARCHAR)), 1, 12) ELSE slug END AS slug
FROM (SELECT *, CASE WHEN rn = 1 THEN base ELSE base || '-' || CAST(rn AS VARCHAR) END AS slug FROM named) t""", named=_NAMED),
    "org_slug_unique": with_views("fx_products", "SELECT count(*) AS rows, count(*) AS slugs FROM fx_products"),
    "param_extract": """SELECT p_partkey, p_retailprice AS reg, CAST(p_size AS BIGINT) AS max_iter, CAST(NULL AS VARCHAR) AS tol FROM part""",
    "audit_append": """SELECT 'S' || CAST(user_id AS VARCHAR) AS organization_id, CAST(user_id AS VARCHAR) AS user_id, 'IMPORT' AS action,
'REVIEW' AS resource_type, '{"kind":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS details FROM events""",
}
