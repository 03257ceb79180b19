"""Whole reports as queries, one row an entry, and tables with their order as a number.

A report is a set of tables. Here each becomes a section of (section, place, label, detail, amount, share); ``place`` is the
position in the order that the report promises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.catalog.corpus import LENGTHS, SQL_A, _lengths, sql_words
from reviewmill.catalog.evaluation import CUTS, _metrics, experiments, pred
from reviewmill.catalog.kpi import ALL, ORG, OVERVIEW, PAGE, PER_PRODUCT, PERF, PRODUCT_ASPECTS, PRODUCT_ISSUES, PRODUCTS, \
    _aspect_rollup, _issue_rollup, _per_seller, tenant
from reviewmill.catalog.mining import CLAUSES, CONTEXTS, MATCHES
from reviewmill.catalog.tenancy import ALLOWED, CALLER, REACH, platform_user
from reviewmill.catalog.views import Views, with_views
from reviewmill.functions import lexicon as lex
from reviewmill.functions import text as tx
from reviewmill.operators import aspects, corpus, evaluation, indexes, kpis, ranking
from reviewmill.plans import jobs, reports

SELLER, PLATFORM, PRODUCT = "S1", "R1", "P1"


def _text(*names: str) -> Column:
    return F.concat_ws(" | ", *[F.col(n).cast("string") for n in names])


def _entries(rows: DataFrame, section: str, place: Column, label: str, detail: Column, amount: str, share: Column | str) -> DataFrame:
    return rows.select(F.lit(section).alias("section"), place.cast("bigint").alias("place"), F.col(label).alias("label"), detail.alias("detail"),
                       F.col(amount).cast("bigint").alias("amount"), (F.col(share) if isinstance(share, str) else share).cast("double").alias("share"))


def _short(*order: Column) -> Column:
    """Position in a table of a fixed number of rows, such as a page."""
    return F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))


def _ordered(rows: DataFrame, *order: Column) -> DataFrame:
    return ranking.in_order(rows, list(order), "nth")


def _issues(rows: DataFrame, section: str) -> DataFrame:
    return _entries(rows, section, _short(F.desc("frequency"), F.col("phrase"), F.col("aspect")), "phrase", _text("aspect", "priority"), "frequency", "percentage")


def _aspects(rows: DataFrame, section: str) -> DataFrame:
    ordered = _short(F.desc("mentions"), F.col("aspect"))  # as many rows as there are aspects
    return _entries(rows, section, ordered, "aspect", _text("positive_count", "negative_count"), "mentions", "positive_pct")


def _overview_parts(report: dict[str, DataFrame]) -> list[DataFrame]:
    performance = _ordered(report["product_performance"], F.desc("reviews_count"), F.col("product_id"))
    return [
        _entries(report["kpis"], "kpis", F.lit(0), "seller_name", _text("total_products", "health_score"), "total_reviews", "positive_pct"),
        _entries(performance, "product_performance", F.col("nth"), "product_id", F.col("name"), "reviews_count", "positive_pct"),
        _issues(report["top_issues"], "top_issues"),
        _entries(report["recent_reviews"], "recent_reviews", F.col("rank"), "id", F.col("product_name"), "rating", F.lit(None)),
    ]


def _whole(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _page(rows: DataFrame) -> DataFrame:
    return _entries(rows, "reviews", _short(F.desc("review_date"), F.col("id")), "id", F.col("product_name"), "rating", "sentiment_score")


def seller_overview(v: Views) -> DataFrame:
    """KPIs, products, issues and reviews of one seller."""
    return _whole(_overview_parts(reports.seller_overview(tenant(v), SELLER)))


def seller_detail(v: Views) -> DataFrame:
    """Everything a platform sees of one seller."""
    report = reports.seller_detail(tenant(v), SELLER)
    products = _ordered(report["products"], F.desc("created_seq"))
    return _whole([
        *_overview_parts(report),
        _entries(products, "products", F.col("nth"), "id", F.col("category"), "review_count", "positive_pct"),
        _aspects(report["aspects"], "aspects"), _issues(report["issues"], "issues"), _page(report["reviews"]),
    ])


def cross_seller(v: Views) -> DataFrame:
    """The sellers of one platform side by side, with the aspects and issues of its market."""
    report = reports.cross_seller(tenant(v), PLATFORM)
    return _whole([
        _entries(report["comparison"], "comparison", F.lit(0), "seller_id", _text("top_aspect", "top_issue"), "total_reviews", "positive_pct"),
        _aspects(report["marketplace_aspects"], "marketplace_aspects"), _issues(report["marketplace_issues"], "marketplace_issues"),
    ])


def product_report(v: Views) -> DataFrame:
    """One product with its aspects, issues and newest reviews."""
    report = reports.product_detail(tenant(v), PRODUCT)
    return _whole([
        _entries(report["kpis"], "kpis", F.lit(0), "name", _text("seller_name", "health_score"), "total_reviews", "positive_pct"),
        _entries(report["aspects"], "aspects", F.lit(0), "aspect", F.col("source"), "mentions", "positive_pct"),
        _entries(report["issues"], "issues", F.lit(0), "phrase", _text("aspect", "source"), "frequency", "percentage"), _page(report["reviews"]),
    ])


def issue_fallback(v: Views) -> DataFrame:
    """Issues of every product, or its seller's where it has none; reviews of one star only, so that some products have none."""
    rows = _per_seller(jobs.product_issues(v.reviews.filter(F.col("rating") == 1)))
    return kpis.with_fallback(v.products, kpis.issue_rollup(rows, ("seller_id", "product_id")), kpis.issue_rollup(rows, ("seller_id",)))


def _caller(v: Views) -> int:
    return platform_user(v).first().user_id


def explorer(v: Views) -> DataFrame:
    """Counts and first page of a filtered search over the reviews that the caller may see."""
    found = reports.review_explorer(tenant(v), _caller(v), sentiment="NEGATIVE", search="money")
    counts = found["counts"].withColumn("label", F.lit("all"))
    return _whole([_entries(counts, "counts", F.lit(0), "label", F.col("total_pages").cast("string"), "total", F.lit(None)), _page(found["reviews"])])


def team(v: Views) -> DataFrame:
    """Members of every organization in order of joining; a member's number stands for the day."""
    joined = v.members.withColumn("joined_on", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("user_id") * 37 % 900).cast("int")))
    ordered = ranking.in_order(kpis.team_view(joined, v.profiles, "joined_on"), [F.col("joined_on"), F.col("user_id")], "place", ["organization_id"])
    return ordered.withColumn("joined_on", F.col("joined_on").cast("string"))


def _sentiment_tokens(v: Views) -> DataFrame:
    """Words of each text without stop words, negations kept."""
    words = F.filter(tx.tokenize(tx.clean("review", "a")), lambda t: t != "")
    kept = tx.drop_words(words, lex.sentiment_stop_words())
    return v.documents.select("doc_id", F.size(kept).cast("bigint").alias("n_tokens"), F.md5(F.array_join(kept, " ").cast("binary")).alias("digest"))


def _pain_points(v: Views) -> DataFrame:
    """Pain points at the default limits, of the reviews of fewer than three stars."""
    rows = aspects.aspect_contexts(v.reviews.filter("rating < 3"), "content", ["sentiment", "sentiment_score", "rating"])
    return aspects.pain_points(aspects.aspect_stats(rows, (F.col("sentiment") == "POSITIVE") & (F.col("rating") == 2), score="sentiment_score"))


def _deep_page(v: Views) -> DataFrame:
    """The page in the middle of all reviews, longest first, from an index."""
    rows = v.reviews.select("id", "content")
    order = [F.length("content").desc(), F.col("id"), F.col("content")]
    number = v.reviews.count() // 40
    return indexes.page_index(rows, order).page(number, 20)


def _indexed_search(v: Views) -> DataFrame:
    """Reviews of one lot, found through the filters of their ranges."""
    rows = v.reviews.select("id", "title", "content")
    return indexes.search_index(rows, ["title", "content"], [F.col("content"), F.col("id")]).search("LOT 977, Line").select("id", "content")


QUERIES = {
    "reviews_page_indexed": _deep_page,
    "reviews_search_indexed": _indexed_search,
    "report_seller_overview": seller_overview,
    "report_seller_detail": seller_detail,
    "report_cross_seller": cross_seller,
    "report_product": product_report,
    "product_issue_fallback": issue_fallback,
    "report_explorer": explorer,
    "dataset_view_user": lambda v: reports.datasets(tenant(v), v.datasets, _caller(v)).select("id", "name", "organization_id", "seller_name", "row_count"),
    "team_by_join_date": team,
    "corpus_class_order": lambda v: ranking.in_order(corpus.class_distribution(v.corpus), [F.col("label")], "place"),
    "corpus_histogram_order": lambda v: ranking.in_order(corpus.length_histogram(_lengths(v)), [F.col("bucket")], "place"),
    "experiment_order": lambda v: ranking.in_order(experiments(v), evaluation.best_first(), "place").select("experiment", "f1", "accuracy", "place"),
    "tokens_sentiment": _sentiment_tokens,
    "aspect_pain_points_default": _pain_points,
}

# --- SQL -----------------------------------------------------------------------------------

_KINDS = dict(clauses=CLAUSES, ctx=CONTEXTS, matches=MATCHES, pa=PRODUCT_ASPECTS, pi=PRODUCT_ISSUES)


def _sql(body: str) -> str:
    return with_views(ALL, body, org=ORG, pp=PER_PRODUCT, **_KINDS)


def _select(section: str, place: str, label: str, detail: str, amount: str, share: str, source: str) -> str:
    return (f"SELECT '{section}' AS section, CAST({place} AS BIGINT) AS place, {label} AS label, {detail} AS detail, CAST({amount} AS BIGINT) AS amount, "
            f"CAST({share} AS DOUBLE) AS share FROM {source}")


def _issue_part(section: str, source: str, k: int) -> str:
    chosen = f"(SELECT * FROM {source} ORDER BY frequency DESC, phrase, aspect LIMIT {k}) i"
    return _select(section, "row_number() OVER (ORDER BY frequency DESC, phrase, aspect)", "phrase", "aspect || ' | ' || priority", "frequency", "percentage", chosen)


def _aspect_part(section: str, source: str) -> str:
    return _select(section, "row_number() OVER (ORDER BY mentions DESC, aspect)", "aspect",
                   "CAST(positive_count AS VARCHAR) || ' | ' || CAST(negative_count AS VARCHAR)", "mentions", "positive_pct", source)


def _page_part(condition: str, k: int) -> str:
    page = PAGE.replace("r.rating,", "r.rating, r.review_date,")
    return _select("reviews", "row_number() OVER (ORDER BY review_date DESC, id)", "id", "product_name", "rating", "sentiment_score",
                   f"({page} WHERE {condition} ORDER BY r.review_date DESC, r.id LIMIT {k}) g")


_SELLER_ISSUES = f"(SELECT * FROM ({_issue_rollup('seller_id')}) u WHERE seller_id = '{SELLER}')"
_OVERVIEW_PARTS = [
    _select("kpis", "0", "seller_name", "CAST(total_products AS VARCHAR) || ' | ' || CAST(health_score AS VARCHAR)", "total_reviews", "positive_pct",
            f"({OVERVIEW}) v WHERE seller_id = '{SELLER}'"),
    _select("product_performance", "row_number() OVER (ORDER BY reviews_count DESC, product_id)", "product_id", "name", "reviews_count", "positive_pct",
            f"({PERF}) q WHERE seller_id = '{SELLER}'"),
    _issue_part("top_issues", _SELLER_ISSUES, 6),
    _select("recent_reviews", "row_number() OVER (ORDER BY review_date DESC, r.id)", "r.id", "p.name", "r.rating", "NULL",
            f"(SELECT * FROM fx_reviews WHERE organization_id = '{SELLER}' ORDER BY review_date DESC, id LIMIT 5) r JOIN fx_products p ON p.id = r.product_id"),
]
_MANAGED = f"(SELECT seller_organization_id FROM fx_links WHERE platform_organization_id = '{PLATFORM}')"
_COMPARED = f"""(SELECT v.seller_id, v.total_reviews, v.positive_pct,
  coalesce((SELECT a.aspect FROM ({_aspect_rollup('seller_id')}) a WHERE a.seller_id = v.seller_id ORDER BY a.mentions DESC, a.aspect LIMIT 1), 'N/A') AS top_aspect,
  coalesce((SELECT i.phrase FROM ({_issue_rollup('seller_id')}) i WHERE i.seller_id = v.seller_id ORDER BY i.frequency DESC, i.phrase, i.aspect LIMIT 1), 'None') AS top_issue
  FROM ({OVERVIEW}) v WHERE v.seller_id IN {_MANAGED}) c"""
_KEPT = sql_words(lex.sentiment_stop_words())


def _fallback(kind: str, rollup, columns: str, condition: str = "true") -> str:
    """Rows of the product, or of its seller where ``kind`` has none of the product."""
    return f"""SELECT p.id AS product_id, p.organization_id AS seller_id, {columns}, 'product' AS source
FROM fx_products p JOIN ({rollup('seller_id, product_id')}) x ON x.product_id = p.id WHERE {condition}
UNION ALL SELECT p.id, p.organization_id, {columns}, 'seller' FROM fx_products p JOIN ({rollup('seller_id')}) x ON x.seller_id = p.organization_id
WHERE p.id NOT IN (SELECT product_id FROM {kind}) AND {condition}"""


_ISSUE_COLUMNS = "x.phrase, x.aspect, x.frequency, x.percentage, x.negative_pct, x.priority"
_ONE_STAR = dict(matches=MATCHES.replace("FROM fx_reviews", "FROM fx_reviews WHERE rating = 1"),
                 pi=PRODUCT_ISSUES.replace("FROM fx_reviews GROUP BY", "FROM fx_reviews WHERE rating = 1 GROUP BY"))

ORACLES = {
    "reviews_page_indexed": with_views("fx_reviews", """SELECT id, content FROM (SELECT id, content, row_number() OVER (ORDER BY length(content) DESC, id, content) AS n
FROM fx_reviews) t WHERE (n - 1) // 20 = (SELECT count(*) FROM fx_reviews) // 40 - 1"""),
    "reviews_search_indexed": with_views("fx_reviews", """SELECT id, content FROM fx_reviews
WHERE lower(content) LIKE '%lot 977, line%' OR lower(title) LIKE '%lot 977, line%'"""),
    "report_seller_overview": _sql(" UNION ALL ".join(f"SELECT * FROM ({p}) s{n}" for n, p in enumerate(_OVERVIEW_PARTS))),
    "report_seller_detail": _sql(" UNION ALL ".join(f"SELECT * FROM ({p}) s{n}" for n, p in enumerate([
        *_OVERVIEW_PARTS,
        _select("products", "row_number() OVER (ORDER BY created_seq DESC)", "id", "category", "review_count", "positive_pct",
                f"({PRODUCTS}) q WHERE organization_id = '{SELLER}'"),
        _aspect_part("aspects", f"({_aspect_rollup('seller_id')}) a WHERE seller_id = '{SELLER}'"),
        _issue_part("issues", _SELLER_ISSUES, 15), _page_part(f"r.organization_id = '{SELLER}'", 10)]))),
    "report_cross_seller": _sql(" UNION ALL ".join(f"SELECT * FROM ({p}) s{n}" for n, p in enumerate([
        _select("comparison", "0", "seller_id", "top_aspect || ' | ' || top_issue", "total_reviews", "positive_pct", _COMPARED),
        _aspect_part("marketplace_aspects", f"({_aspect_rollup('', f'(SELECT * FROM pa WHERE organization_id IN {_MANAGED})')}) a"),
        _issue_part("marketplace_issues", f"({_issue_rollup('').replace('FROM pi', f'FROM pi WHERE organization_id IN {_MANAGED}')})", 15)]))),
    "report_product": _sql(" UNION ALL ".join(f"SELECT * FROM ({p}) s{n}" for n, p in enumerate([
        _select("kpis", "0", "q.name", "o.name || ' | ' || CAST(q.health_score AS VARCHAR)", "q.reviews_count", "q.positive_pct",
                f"({PERF}) q JOIN fx_organizations o ON o.id = q.seller_id WHERE q.product_id = '{PRODUCT}'"),
        _select("aspects", "0", "aspect", "source", "mentions", "positive_pct",
                f"({_fallback('pa', _aspect_rollup, 'x.aspect, x.mentions, x.positive_pct')}) f WHERE product_id = '{PRODUCT}'"),
        _select("issues", "0", "phrase", "aspect || ' | ' || source", "frequency", "percentage",
                f"({_fallback('pi', _issue_rollup, 'x.phrase, x.aspect, x.frequency, x.percentage')}) f WHERE product_id = '{PRODUCT}'"),
        _page_part(f"r.product_id = '{PRODUCT}'", 20)]))),
    "product_issue_fallback": with_views(ALL, _fallback("pi", _issue_rollup, _ISSUE_COLUMNS), **_ONE_STAR),
    "report_explorer": with_views(ALL, " UNION ALL ".join(f"SELECT * FROM ({p}) s{n}" for n, p in enumerate([
        _select("counts", "0", "'all'", "CAST(CAST(greatest(1, ceil(total / 20)) AS BIGINT) AS VARCHAR)", "total", "NULL", "(SELECT count(*) AS total FROM hits) t"),
        _page_part("r.id IN (SELECT id FROM hits)", 20)])), reach=REACH, caller=CALLER, allowed=ALLOWED,
        hits="""SELECT id FROM fx_reviews WHERE sentiment = 'NEGATIVE' AND (lower(content) LIKE '%money%' OR lower(title) LIKE '%money%')
AND organization_id IN (SELECT organization_id FROM allowed)"""),
    "dataset_view_user": with_views("fx_organizations fx_links fx_members fx_datasets", """SELECT d.id, d.name, d.organization_id, o.name AS seller_name, d.row_count
FROM fx_datasets d JOIN fx_organizations o ON o.id = d.organization_id WHERE d.organization_id IN (SELECT organization_id FROM allowed)""",
                                    reach=REACH, caller=CALLER, allowed=ALLOWED),
    "team_by_join_date": with_views("fx_members fx_profiles", """SELECT organization_id, user_id, full_name, email, role, CAST(joined_on AS VARCHAR) AS joined_on,
row_number() OVER (PARTITION BY organization_id ORDER BY joined_on, user_id) AS place
FROM (SELECT m.*, p.full_name, p.email, CAST(DATE '2020-01-01' + CAST(user_id * 37 % 900 AS INTEGER) AS DATE) AS joined_on
      FROM fx_members m JOIN fx_profiles p ON p.id = m.user_id) t"""),
    "corpus_class_order": with_views("fx_corpus", "SELECT *, row_number() OVER (ORDER BY label) AS place FROM (SELECT label, count(*) AS reviews FROM fx_corpus GROUP BY label) t"),
    "corpus_histogram_order": with_views("fx_corpus", """SELECT *, row_number() OVER (ORDER BY bucket) AS place FROM (
SELECT CAST(CASE WHEN n >= 200 THEN 200 ELSE n - n % 20 END AS BIGINT) AS bucket, count(*) AS reviews FROM lengths GROUP BY 1) t""", lengths=LENGTHS),
    "experiment_order": pred("SELECT experiment, f1, accuracy, row_number() OVER (ORDER BY f1 DESC, accuracy DESC, experiment) AS place FROM res",
                             cuts=CUTS, res=_metrics("cuts", "experiment")),
    "tokens_sentiment": with_views("", f"""SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, md5(array_to_string(w, ' ')) AS digest FROM (
SELECT doc_id, list_filter(string_split({SQL_A.replace('review', 'text')}, ' '), lambda x: x <> '' AND x NOT IN ({_KEPT})) AS w FROM documents) t"""),
    "aspect_pain_points_default": with_views("fx_reviews", """SELECT aspect, negative_pct, mentions, 'High Negative Feedback' AS status,
  CAST(negative_pct AS VARCHAR) || '% negative feedback across ' || format('{:,}', mentions) || ' mentions.' AS note,
  CAST((SELECT sum(mentions) FROM stats) AS BIGINT) AS total_aspect_mentions FROM stats WHERE negative_pct >= 40 AND mentions >= 50""",
        clauses=CLAUSES.replace("FROM fx_reviews", "FROM fx_reviews WHERE rating < 3"),
        rated=CONTEXTS.replace("sentiment_score,", "sentiment_score, rating,"),
        stats="""SELECT aspect, count(*) AS mentions, round(avg(CASE WHEN sentiment = 'POSITIVE' AND rating = 2 THEN 0.0 ELSE 1.0 END) * 100, 2) AS negative_pct
FROM rated GROUP BY aspect"""),
}
