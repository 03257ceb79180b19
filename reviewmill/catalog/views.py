"""The review data model derived from the given tables.

``Views`` builds the DataFrames; ``SQL`` holds the same definitions as DuckDB text
for the checks. Both read whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First clauses of the review texts; the given prose has no apostrophes and names no product aspect.
# ``content_of`` varies them by the row's own values, so that texts grow in number with the table.
SENTENCES = [
    "The charger is awful, although the build quality is excellent.",
    "I don’t recommend it, total waste of money.",
    "Great value for the price, works perfectly!",
    "It stopped working after a week; customer service never responded.",
    "Arrived late and the box was damaged, however support was helpful.",
    "I love it. Not bad at all.",
    "Poor quality plastic, it cracked. Never buy this again.",
    "Charging is slow, yet the design is nice.",
    "It wasn't cheap and they haven't sent the refund.",
    "Excellent, would buy again.",
    "Broken on arrival. Useless junk, want my money back.",
    "Fast delivery, sturdy packaging, no problem.",
]


#: Rows whose texts one task works on, where texts are cleaned, scored or fitted.
TASK_ROWS = 200_000
#: Documents whose texts one task works on; they are some fifty times as long.
TASK_DOCUMENTS = 4_000


def _text(col):
    return F.col(col).cast("string")


class Views:
    """Lazily built DataFrames over one data folder.

    ``partitions``, where the caller sets it, deals the tables that texts are derived from out over so many tasks. A table of one row
    group is read by one task, and its texts would be worked on there; larger tables are split by their row groups.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.partitions = partitions

    def table(self, name: str) -> DataFrame:
        found = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return found.repartition(self.partitions) if self.partitions and name in ("lineitem", "documents") else found

    def _count(self, name: str):
        # Uncorrelated scalar subquery over the parquet row counts.
        return self.table(name).agg(F.count(F.lit(1))).scalar()

    @cached_property
    def organizations(self) -> DataFrame:
        sellers = self.table("supplier").select(
            F.concat(F.lit("S"), _text("s_suppkey")).alias("id"),
            F.col("s_name").alias("name"),
            F.lit("seller").alias("organization_type"),
        )
        platforms = self.table("region").select(
            F.concat(F.lit("R"), _text("r_regionkey")).alias("id"),
            F.col("r_name").alias("name"),
            F.lit("platform").alias("organization_type"),
        )
        return sellers.unionByName(platforms)

    @cached_property
    def links(self) -> DataFrame:
        slot = F.col("s_suppkey") % 7
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
            .select(
                F.concat(F.lit("R"), _text("n_regionkey")).alias("platform_organization_id"),
                F.concat(F.lit("S"), _text("s_suppkey")).alias("seller_organization_id"),
                F.when(slot == 0, "suspended").when(slot == 1, "pending").otherwise("active").alias("status"),
            )
        )

    @cached_property
    def members(self) -> DataFrame:
        seller = F.concat(F.lit("S"), (F.col("c_custkey") % self._count("supplier")).cast("string"))
        segment = F.col("c_mktsegment")
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
            .select(
                F.col("c_custkey").alias("user_id"),
                F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("R"), _text("n_regionkey")))
                .otherwise(seller).alias("organization_id"),
                F.when(segment == "BUILDING", "owner").when(segment == "MACHINERY", "admin")
                .when(segment == "HOUSEHOLD", "viewer").otherwise("analyst").alias("role"),
            )
        )

    @cached_property
    def profiles(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("P"), _text("p_partkey")).alias("id"),
            F.concat(F.lit("S"), (F.col("p_partkey") % self._count("supplier")).cast("string"))
            .alias("organization_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("sku"),
            F.col("p_type").alias("category"),
            F.concat_ws(" ", "p_brand", "p_name").alias("description"),
            F.col("p_partkey").alias("created_seq"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return review_columns(self.table("lineitem"), self._count("supplier"))

    @cached_property
    def dealt_reviews(self) -> DataFrame:
        """The reviews, for work on their texts: dealt out over tasks by their number, however few row groups hold them."""
        lines = self.table("lineitem")
        return review_columns(lines if self.partitions else lines.repartition(self.review_tasks), self._count("supplier"))

    @cached_property
    def review_tasks(self) -> int:
        """Tasks that work on the texts of the reviews, by the number of these, which is counted in the footers."""
        return self.partitions or max(-(-self.table("lineitem").count() // TASK_ROWS), self.spark.sparkContext.defaultParallelism)

    @cached_property
    def analyses(self) -> DataFrame:
        part = F.col("o_orderkey") % self._count("part")
        state = F.col("o_orderstatus")
        return self.table("orders").select(
            F.concat(F.lit("A"), _text("o_orderkey")).alias("id"),
            F.concat(F.lit("P"), part.cast("string")).alias("product_id"),
            F.concat(F.lit("S"), (part % self._count("supplier")).cast("string")).alias("organization_id"),
            F.when(state == "F", "completed").when(state == "O", "running").otherwise("failed").alias("status"),
            (F.floor("o_totalprice").cast("bigint") % 101).alias("health_score"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def audit(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("S"), (F.col("user_id") % self._count("supplier")).cast("string"))
            .alias("organization_id"),
            F.col("user_id"),
            F.upper("event_type").alias("action"),
            F.lit("EVENT").alias("resource_type"),
            F.col("props").alias("details"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents").select(
            "doc_id", F.col("source").alias("title"), F.col("text").alias("review"), "lang"
        )

    @cached_property
    def dealt_documents(self) -> DataFrame:
        """The documents, for work on their texts: dealt out over tasks by their number, however few row groups hold them."""
        return self.documents if self.partitions else self.deal_documents(self.documents)

    def deal_documents(self, rows: DataFrame) -> DataFrame:
        """Rows made of documents in as many tasks as those ask for; a count that is asked for is not merged by size again."""
        tasks = self.partitions or max(-(-self.table("documents").count() // TASK_DOCUMENTS), self.spark.sparkContext.defaultParallelism)
        return rows.repartition(tasks, "doc_id", "review")

    @cached_property
    def corpus(self) -> DataFrame:
        return self._labelled(self.documents)

    @cached_property
    def dealt_corpus(self) -> DataFrame:
        return self._labelled(self.dealt_documents)

    def _labelled(self, documents: DataFrame) -> DataFrame:
        labels = self.table("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
        return documents.join(labels, "doc_id").select("doc_id", "label", "title", "review", "lang")

    @cached_property
    def datasets(self) -> DataFrame:
        """One data set per document source, owned by the seller of its number."""
        number = F.substring("source", 4, 10).cast("bigint")
        return (
            self.table("documents").groupBy("source").agg(F.count(F.lit(1)).alias("row_count"),
                                                         F.min("doc_id").alias("created_seq"))
            .select(
                F.concat(F.lit("D"), number.cast("string")).alias("id"),
                F.concat(F.lit("S"), (number % self._count("supplier")).cast("string")).alias("organization_id"),
                F.col("source").alias("name"), "row_count", "created_seq",
            )
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """A rule in place of a fitted model, with scores that are exact in both engines."""
        points = F.lit(40) * F.col("label") + (F.col("doc_id") * 37) % 61
        return (
            self.corpus.select("doc_id", "label", "review", points.cast("bigint").alias("points"))
            .select(
                "doc_id", "label", "review",
                (F.col("points").cast("double") / 100).alias("score"),
                F.when(F.col("points") >= 50, 1.0).otherwise(0.0).alias("prediction"),
            )
        )


# Texts without letters of the Latin alphabet, and without any.
FOREIGN, BLANK = "Очень хорошо, спасибо.", "   "


def content_of(sentence: Column) -> Column:
    """Review text: a sentence with the lot of the row; some are in capitals, some in another alphabet, some blank."""
    kind = F.col("l_orderkey") % 50
    lot = F.concat(sentence, F.lit(" Lot "), _text("l_partkey"), F.lit(", line "), _text("l_linenumber"), F.lit("."))
    return F.when(kind == 7, FOREIGN).when(kind == 8, BLANK).when(kind == 9, F.upper(lot)).otherwise(lot)


def review_columns(lineitem: DataFrame, suppliers, *extra: str) -> DataFrame:
    """Review rows from order lines, with further columns as they are; works on a table and on a stream."""
    pick = (F.col("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey")) % len(SENTENCES)
    return lineitem.select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey"), _text("l_suppkey"),
                    F.col("l_quantity").cast("bigint").cast("string")).alias("id"),
        F.concat(F.lit("S"), (F.col("l_partkey") % suppliers).cast("string")).alias("organization_id"),
        F.concat(F.lit("P"), _text("l_partkey")).alias("product_id"),
        F.when(F.col("l_returnflag") == "R", "Not happy").otherwise("As expected").alias("title"),
        content_of(F.element_at(F.array(*[F.lit(s) for s in SENTENCES]), (pick + 1).cast("int"))).alias("content"),
        (F.lit(1) + F.col("l_quantity").cast("bigint") % 5).alias("rating"),
        F.when(F.col("l_returnflag") == "R", "NEGATIVE").otherwise("POSITIVE").alias("sentiment"),
        F.round(F.lit(1) - F.col("l_discount"), 2).alias("sentiment_score"),
        F.col("l_shipdate").alias("review_date"),
        *extra,
    )


def _sentence_case() -> str:
    arms = " ".join("WHEN {} THEN '{}'".format(i, s.replace("'", "''")) for i, s in enumerate(SENTENCES))
    pick = f"CASE (l_orderkey + l_linenumber + l_partkey) % {len(SENTENCES)} {arms} END"
    lot = f"({pick}) || ' Lot ' || CAST(l_partkey AS VARCHAR) || ', line ' || CAST(l_linenumber AS VARCHAR) || '.'"
    return f"CASE l_orderkey % 50 WHEN 7 THEN '{FOREIGN}' WHEN 8 THEN '{BLANK}' WHEN 9 THEN upper({lot}) ELSE {lot} END"


SQL = {
    "fx_organizations": """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'seller' AS organization_type FROM supplier
UNION ALL SELECT 'R' || CAST(r_regionkey AS VARCHAR), r_name, 'platform' FROM region""",
    "fx_links": """
SELECT 'R' || CAST(n_regionkey AS VARCHAR) AS platform_organization_id,
       'S' || CAST(s_suppkey AS VARCHAR) AS seller_organization_id,
       CASE s_suppkey % 7 WHEN 0 THEN 'suspended' WHEN 1 THEN 'pending' ELSE 'active' END AS status
FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "fx_members": """
SELECT c_custkey AS user_id,
       CASE WHEN c_custkey % 10 = 0 THEN 'R' || CAST(n_regionkey AS VARCHAR)
            ELSE 'S' || CAST(c_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) END AS organization_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'owner' WHEN 'MACHINERY' THEN 'admin'
                         WHEN 'HOUSEHOLD' THEN 'viewer' ELSE 'analyst' END AS role
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "fx_profiles": """
SELECT c_custkey AS id, c_name AS full_name, lower(replace(c_name, '#', '.')) || '@example.com' AS email
FROM customer""",
    "fx_products": """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS id,
       'S' || CAST(p_partkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS organization_id,
       p_name AS name, p_brand AS sku, p_type AS category,
       p_brand || ' ' || p_name AS description, p_partkey AS created_seq
FROM part""",
    "fx_reviews": f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
       || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS id,
       'S' || CAST(l_partkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS organization_id,
       'P' || CAST(l_partkey AS VARCHAR) AS product_id,
       CASE WHEN l_returnflag = 'R' THEN 'Not happy' ELSE 'As expected' END AS title,
       {_sentence_case()} AS content,
       1 + CAST(l_quantity AS BIGINT) % 5 AS rating,
       CASE WHEN l_returnflag = 'R' THEN 'NEGATIVE' ELSE 'POSITIVE' END AS sentiment,
       round(1 - l_discount, 2) AS sentiment_score, l_shipdate AS review_date
FROM lineitem""",
    "fx_analyses": """
SELECT 'A' || CAST(o_orderkey AS VARCHAR) AS id,
       'P' || CAST(o_orderkey % (SELECT count(*) FROM part) AS VARCHAR) AS product_id,
       'S' || CAST((o_orderkey % (SELECT count(*) FROM part)) % (SELECT count(*) FROM supplier) AS VARCHAR)
           AS organization_id,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
       CAST(floor(o_totalprice) AS BIGINT) % 101 AS health_score, o_orderdate AS created_at
FROM orders""",
    "fx_audit": """
SELECT event_id AS id, 'S' || CAST(user_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS organization_id,
       user_id, upper(event_type) AS action, 'EVENT' AS resource_type, props AS details, ts AS created_at
FROM events""",
    "fx_corpus": """
SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, d.source AS title, d.text AS review, d.lang
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
    "fx_datasets": """
SELECT 'D' || CAST(n AS VARCHAR) AS id, 'S' || CAST(n % (SELECT count(*) FROM supplier) AS VARCHAR) AS organization_id,
       source AS name, row_count, created_seq
FROM (SELECT source, CAST(substr(source, 4) AS BIGINT) AS n, count(*) AS row_count, min(doc_id) AS created_seq
      FROM documents GROUP BY source) t""",
    "fx_predictions": """
SELECT doc_id, label, review, CAST(points AS DOUBLE) / 100 AS score,
       CAST(CASE WHEN points >= 50 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
FROM (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, d.text AS review,
             40 * l.quality + (d.doc_id * 37) % 61 AS points
      FROM documents d JOIN labels l ON l.doc_id = d.doc_id) t""",
}


def with_views(names: str, body: str, **ctes: str) -> str:
    """SQL text with the named views, then extra named queries, then the body."""
    parts = [f"{name} AS ({SQL[name].strip()})" for name in names.split()]
    parts += [f"{name} AS ({sql.strip()})" for name, sql in ctes.items()]
    return f"WITH {', '.join(parts)} {body.strip()}" if parts else body.strip()
