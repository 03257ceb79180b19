"""KPI, product, review and people queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog.mining import CLAUSES, CONTEXTS, MATCHES
from reviewmill.catalog.tenancy import ALLOWED, CALLER, REACH, allowed
from reviewmill.catalog.views import Views, with_views
from reviewmill.operators import aspects, kpis, ranking, tenancy
from reviewmill.plans import jobs, reports


def tenant(v: Views) -> reports.Tenant:
    return reports.Tenant(v.organizations, v.links, v.members, v.products, v.reviews, v.analyses)


def breakdown(v: Views):
    return kpis.seller_breakdown(v.links, v.organizations, v.products, v.reviews, v.analyses)


def overview(v: Views):
    return kpis.seller_overview(v.organizations, v.products, v.reviews, v.analyses)


def flagship(v: Views):
    """Every platform's sellers with products, reviews, shares and health, plus the platform's own health."""
    rows = breakdown(v)
    return rows.drop("positives", "negatives").join(kpis.marketplace_health(rows), "platform_id")


def _platforms(v: Views):
    """All platforms, and a new one that has no sellers yet."""
    known = v.organizations.filter("organization_type = 'platform'").select(F.col("id").alias("platform_id"))
    return known.union(v.spark.range(1).select(F.lit("R-new")))


def _per_seller(rows):
    return rows.withColumnRenamed("organization_id", "seller_id")


def _compare(v: Views):
    aspect = aspects.aspect_rollup(_per_seller(jobs.product_aspects(v.reviews)), ("seller_id",))
    issues = kpis.issue_rollup(_per_seller(jobs.product_issues(v.reviews)), ("seller_id",))
    return kpis.seller_comparison(overview(v), aspect, issues)


def _sorted(name):
    def run(v: Views):
        return kpis.review_page(v.reviews, v.products, v.organizations, name, 3, 20).drop("review_date")
    return run


def _explorer(v: Views):
    """Second page of a filtered search inside the caller's organizations."""
    rows = kpis.filter_reviews(v.reviews, sentiment="positive", search="BATTERY", aspect="Battery")
    page = kpis.review_page(tenancy.scope(rows, allowed(v)), v.products, v.organizations, "default", 2, 20)
    return page.drop("review_date")


def _keyset(v: Views):
    """Page after the newest review of the middle day, by key instead of offset."""
    bounds = v.reviews.agg(F.min("review_date").alias("a"), F.max("review_date").alias("b"))
    first = bounds.select("a").scalar()
    seen = F.col("review_date") < F.date_add(first.cast("date"), 900).cast("timestamp_ntz")
    rows = ranking.page_after(v.reviews, seen, ranking.review_order(), 20)
    return rows.select("id", F.date_format("review_date", "yyyy-MM-dd").alias("day"))


def _counts(v: Views):
    return ranking.page_counts(kpis.filter_reviews(v.reviews, sentiment="NEGATIVE", search="money"), 20)


def _recent(key, k):
    def run(v: Views):
        rows = kpis.recent_reviews(v.reviews, v.products, key, k)
        return rows.select(key, "rank", "id", "product_name", "rating", "sentiment")
    return run


def _search(v: Views):
    hits = kpis.filter_products(v.products, category="ECONOMY", search="RING")
    return tenancy.scope(hits, allowed(v)).select("id", "organization_id", "name", "sku")


def _fallback(v: Views):
    rows = jobs.product_aspects(v.reviews.filter(F.col("rating") == 1))
    return kpis.with_fallback(
        v.products, aspects.aspect_rollup(_per_seller(rows), ("seller_id", "product_id")),
        aspects.aspect_rollup(_per_seller(rows), ("seller_id",)),
    )


def _datasets(v: Views):
    return kpis.dataset_view(v.datasets, v.organizations).select(
        "id", "name", "organization_id", "seller_name", "row_count")


def _detail(v: Views):
    """Totals, best product, top aspect and issue and last review of every seller in one row."""
    best = kpis.product_performance(v.products, v.reviews).groupBy("seller_id").agg(
        F.min_by("product_id", F.struct(-F.col("reviews_count"), F.col("product_id"))).alias("top_product"))
    last = kpis.recent_reviews(v.reviews, v.products, k=1).select(
        F.col("organization_id").alias("seller_id"), F.col("id").alias("last_review"))
    return _compare(v).join(best, "seller_id", "left").join(last, "seller_id", "left")


def _invitations(v: Views):
    """Newest invitations of the caller's organizations; every order stands for one."""
    invitations = v.table("orders").select(
        F.concat(F.lit("I"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("S"), (F.col("o_custkey") % v._count("supplier")).cast("string")).alias("organization_id"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.lower("o_orderpriority").alias("note"), F.col("o_orderdate").alias("created_at"),
    )
    newest = kpis.open_invitations(tenancy.scope(invitations, allowed(v)), 50)
    return newest.select("id", "organization_id", "email", "note",
                         F.date_format(kpis.expiry("created_at"), "yyyy-MM-dd").alias("expires_at"))


QUERIES = {
    "tenant_seller_kpis": flagship,
    "tenant_platform_totals": lambda v: kpis.platform_totals(breakdown(v), platforms=_platforms(v)),
    "tenant_marketplace_health": lambda v: kpis.marketplace_health(breakdown(v)),
    "tenant_seller_overview": overview,
    "tenant_product_perf": lambda v: kpis.product_performance(v.products, v.reviews),
    "tenant_compare": _compare,
    "tenant_seller_detail": _detail,
    "platform_overview": lambda v: reports.platform_overview(tenant(v))["totals"],
    "product_list": lambda v: kpis.product_list(v.products, v.organizations, v.reviews, v.analyses),
    "product_list_user": lambda v: kpis.product_list(
        tenancy.scope(v.products, allowed(v)), v.organizations, tenancy.scope(v.reviews, allowed(v)),
        tenancy.scope(v.analyses, allowed(v)), parity=True),
    "product_detail": lambda v: kpis.product_detail(v.products, v.organizations, v.reviews),
    "product_search": _search,
    "product_aspect_fallback": _fallback,
    "reviews_page": _explorer,
    "reviews_page_counts": _counts,
    "reviews_page_keyset": _keyset,
    **{f"reviews_sorted_{name}": _sorted(name) for name in ranking.REVIEW_SORTS},
    "reviews_recent_seller": _recent("organization_id", 5),
    "reviews_recent_product": _recent("product_id", 20),
    "aspect_results": lambda v: aspects.aspect_rollup(
        _per_seller(jobs.product_aspects(v.reviews)), ("seller_id",)),
    "aspect_results_market": lambda v: aspects.aspect_rollup(jobs.product_aspects(v.reviews)),
    "issue_results": lambda v: kpis.top_issues(
        kpis.issue_rollup(_per_seller(jobs.product_issues(v.reviews)), ("seller_id",)), ("seller_id",)),
    "issue_results_market": lambda v: kpis.top_issues(kpis.issue_rollup(jobs.product_issues(v.reviews))),
    "dashboard_summary": lambda v: kpis.dashboard(v.reviews, aspects.aspect_rollup(jobs.product_aspects(v.reviews))),
    "dashboard_no_aspects": lambda v: kpis.dashboard(
        v.reviews, aspects.aspect_rollup(jobs.product_aspects(v.reviews, "title"))),
    "invitation_view": _invitations,
    "audit_view": lambda v: kpis.audit_view(tenancy.scope(v.audit, allowed(v)), v.profiles, v.organizations, 40),
    "audit_details": lambda v: v.audit.select(
        "id", F.get_json_object("details", "$.k").cast("bigint").alias("k")),
    "team_view": lambda v: kpis.team_view(v.members, v.profiles),
    "dataset_view": _datasets,
    "invite_expiry": lambda v: v.table("orders").select(
        "o_orderkey", F.date_format(kpis.expiry("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("expires_at")),
}

# --- SQL -----------------------------------------------------------------------------------

ALL = "fx_organizations fx_links fx_members fx_products fx_reviews fx_analyses"


def kpi_sql(body: str, **ctes: str) -> str:
    return with_views(ALL, body, **ctes)


def scoped_sql(body: str, **ctes: str) -> str:
    return with_views(ALL, body, reach=REACH, caller=CALLER, allowed=ALLOWED, **ctes)


def result_sql(body: str) -> str:
    return with_views(ALL, body, clauses=CLAUSES, ctx=CONTEXTS, matches=MATCHES, pa=PRODUCT_ASPECTS, pi=PRODUCT_ISSUES)


ORG = "SELECT organization_id, count(*) AS n, " \
      "count(*) FILTER (WHERE sentiment = 'POSITIVE') AS pos, count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS neg " \
      "FROM fx_reviews GROUP BY organization_id"
BREAKDOWN = """SELECT l.platform_organization_id AS platform_id, o.id AS seller_id, o.name AS seller_name, l.status,
  (SELECT count(*) FROM fx_products p WHERE p.organization_id = o.id) AS products_count,
  coalesce(r.n, 0) AS reviews_count, round(r.pos / r.n * 100, 1) AS positive_pct,
  round(100.0 - round(r.pos / r.n * 100, 1), 1) AS negative_pct,
  CAST(coalesce((SELECT a.health_score FROM fx_analyses a WHERE a.organization_id = o.id
                 ORDER BY a.created_at DESC, a.id DESC LIMIT 1),
                round(round(r.pos / r.n * 100, 1) * 0.95, 0)) AS BIGINT) AS health_score,
  coalesce(r.pos, 0) AS pos, coalesce(r.neg, 0) AS neg
FROM fx_links l JOIN fx_organizations o ON o.id = l.seller_organization_id LEFT JOIN org r ON r.organization_id = o.id"""
HEALTH = """SELECT platform_id, CAST(round(sum(health_score * greatest(reviews_count, 1)) / sum(greatest(reviews_count, 1)), 0)
  AS BIGINT) AS marketplace_health FROM bd GROUP BY platform_id"""
TOTALS = """SELECT platform_id, count(*) AS total_sellers, CAST(sum(products_count) AS BIGINT) AS total_products,
  CAST(sum(reviews_count) AS BIGINT) AS total_reviews, round(sum(pos) / sum(reviews_count) * 100, 1) AS overall_positive_pct,
  round(sum(neg) / sum(reviews_count) * 100, 1) AS overall_negative_pct FROM bd GROUP BY platform_id"""
OVERVIEW = """SELECT o.id AS seller_id, o.name AS seller_name,
  (SELECT count(*) FROM fx_products p WHERE p.organization_id = o.id) AS total_products, coalesce(r.n, 0) AS total_reviews,
  round(r.pos / r.n * 100, 1) AS positive_pct, round(r.neg / r.n * 100, 1) AS negative_pct,
  CAST(coalesce((SELECT a.health_score FROM fx_analyses a WHERE a.organization_id = o.id
                 ORDER BY a.created_at DESC, a.id DESC LIMIT 1), round(round(r.pos / r.n * 100, 1), 0)) AS BIGINT) AS health_score
FROM fx_organizations o LEFT JOIN org r ON r.organization_id = o.id WHERE o.organization_type = 'seller'"""
PER_PRODUCT = """SELECT product_id, count(*) AS n, count(*) FILTER (WHERE sentiment = 'POSITIVE') AS pos
FROM fx_reviews GROUP BY product_id"""
PERF = """SELECT p.organization_id AS seller_id, p.id AS product_id, p.name, p.sku, p.category, coalesce(r.n, 0) AS reviews_count,
  round(r.pos / r.n * 100, 1) AS positive_pct, round(100.0 - round(r.pos / r.n * 100, 1), 1) AS negative_pct,
  CAST(round(round(r.pos / r.n * 100, 1), 0) AS BIGINT) AS health_score
FROM fx_products p LEFT JOIN pp r ON r.product_id = p.id"""
PRODUCTS = """SELECT p.id, p.organization_id, o.name AS seller_name, p.name, p.sku, p.category, p.created_seq,
  coalesce(r.n, 0) AS review_count, coalesce(round(r.pos / r.n * 100, 1), 0.0) AS positive_pct,
  CASE WHEN r.n > 0 THEN round(100.0 - round(r.pos / r.n * 100, 1), 1) ELSE 0.0 END AS negative_pct,
  (SELECT max(a.health_score) FROM fx_analyses a WHERE a.product_id = p.id AND a.status = 'completed') AS health_score
FROM fx_products p JOIN fx_organizations o ON o.id = p.organization_id LEFT JOIN pp r ON r.product_id = p.id"""
PRODUCT_ASPECTS = """SELECT organization_id, product_id, aspect, count(*) AS mentions,
  count(*) FILTER (WHERE sentiment = 'POSITIVE') AS positive_count,
  count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS negative_count FROM ctx GROUP BY organization_id, product_id, aspect"""
PRODUCT_ISSUES = """SELECT organization_id, product_id, phrase, aspect, frequency, percentage,
  CASE WHEN percentage >= 10 THEN 3 WHEN percentage >= 5 THEN 2 ELSE 1 END AS urgency,
  round(frequency / all_hits * 100, 1) AS negative_pct
FROM (SELECT h.*, round(h.frequency / t.negatives * 100, 2) AS percentage FROM
  (SELECT organization_id, product_id, m.phrase AS phrase, m.aspect AS aspect, count(*) AS all_hits,
     count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS frequency FROM matches GROUP BY ALL) h
  JOIN (SELECT product_id, count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS negatives FROM fx_reviews GROUP BY product_id) t
    ON t.product_id = h.product_id WHERE h.frequency > 0) x"""


def _aspect_rollup(keys: str, source: str = "pa") -> str:
    pre = f"{keys}, " if keys else ""
    return f"""SELECT {pre}aspect, CAST(sum(mentions) AS BIGINT) AS mentions,
  CAST(sum(positive_count) AS BIGINT) AS positive_count, CAST(sum(negative_count) AS BIGINT) AS negative_count,
  round(sum(positive_count) / sum(mentions) * 100, 1) AS positive_pct,
  round(100.0 - round(sum(positive_count) / sum(mentions) * 100, 1), 1) AS negative_pct
FROM (SELECT *, organization_id AS seller_id FROM {source}) a GROUP BY {pre}aspect"""


def _issue_rollup(keys: str) -> str:
    pre = f"{keys}, " if keys else ""
    return f"""SELECT {pre}phrase, aspect, CAST(sum(frequency) AS BIGINT) AS frequency,
  (2 * sum(CAST(round(percentage * 100) AS BIGINT)) + count(*)) // (2 * count(*)) / 100 AS percentage,
  (2 * sum(CAST(round(negative_pct * 10) AS BIGINT)) + count(*)) // (2 * count(*)) / 10 AS negative_pct,
  CASE max(urgency) WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS priority
FROM (SELECT *, organization_id AS seller_id FROM pi) a GROUP BY {pre}phrase, aspect"""


COMPARE = f"""SELECT v.*,
  coalesce((SELECT a.aspect FROM ({_aspect_rollup('seller_id')}) a WHERE a.seller_id = v.seller_id
            ORDER BY a.mentions DESC, a.aspect LIMIT 1), 'N/A') AS top_aspect,
  coalesce((SELECT i.phrase FROM ({_issue_rollup('seller_id')}) i WHERE i.seller_id = v.seller_id
            ORDER BY i.frequency DESC, i.phrase, i.aspect LIMIT 1), 'None') AS top_issue
FROM ({OVERVIEW}) v"""

PAGE = """SELECT r.id, r.product_id, p.name AS product_name, p.sku AS product_sku, o.name AS seller_name, r.organization_id,
  r.title, r.content AS review, r.rating, r.sentiment,
  CASE WHEN r.sentiment_score = 0 THEN 0.95 ELSE r.sentiment_score END AS sentiment_score
FROM fx_reviews r JOIN fx_products p ON p.id = r.product_id JOIN fx_organizations o ON o.id = r.organization_id"""
_ORDERS = {
    "default": "r.review_date DESC", "confidence_desc": "r.sentiment_score DESC",
    "longest": "length(r.content) DESC", "shortest": "length(r.content) ASC",
}


def _recent_sql(key: str, k: int) -> str:
    return kpi_sql(f"""SELECT r.{key}, r.rank, r.id, p.name AS product_name, r.rating, r.sentiment FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY review_date DESC, id) AS rank FROM fx_reviews) r
JOIN fx_products p ON p.id = r.product_id WHERE r.rank <= {k}""")


DASH = """SELECT n AS total_reviews, p AS positive_count, n - p AS negative_count, round(p / n * 100, 1) AS positive_percent,
  round((n - p) / n * 100, 1) AS negative_percent"""
DASH_FROM = "(SELECT count(*) AS n, count(*) FILTER (WHERE sentiment = 'POSITIVE') AS p FROM fx_reviews) t"

_compare_ctes = dict(org=ORG, clauses=CLAUSES, ctx=CONTEXTS, matches=MATCHES, pa=PRODUCT_ASPECTS, pi=PRODUCT_ISSUES)

ORACLES = {
    "tenant_seller_kpis": kpi_sql("""SELECT b.platform_id, seller_id, seller_name, status, products_count, reviews_count,
  positive_pct, negative_pct, health_score, marketplace_health FROM bd b JOIN hl h ON h.platform_id = b.platform_id""",
                                  org=ORG, bd=BREAKDOWN, hl=HEALTH),
    "tenant_platform_totals": kpi_sql("""SELECT platform_id, coalesce(total_sellers, 0) AS total_sellers, coalesce(total_products, 0) AS total_products,
  coalesce(total_reviews, 0) AS total_reviews, overall_positive_pct, overall_negative_pct
FROM (SELECT id AS platform_id FROM fx_organizations WHERE organization_type = 'platform' UNION ALL SELECT 'R-new') p LEFT JOIN tt USING (platform_id)""",
                                     org=ORG, bd=BREAKDOWN, tt=TOTALS),
    "tenant_marketplace_health": kpi_sql(HEALTH, org=ORG, bd=BREAKDOWN),
    "platform_overview": kpi_sql("SELECT t.*, h.marketplace_health FROM tt t JOIN hl h ON h.platform_id = t.platform_id",
                                 org=ORG, bd=BREAKDOWN, hl=HEALTH, tt=TOTALS),
    "tenant_seller_overview": kpi_sql(OVERVIEW, org=ORG),
    "tenant_product_perf": kpi_sql(PERF, pp=PER_PRODUCT),
    "tenant_compare": kpi_sql(COMPARE, **_compare_ctes),
    "tenant_seller_detail": kpi_sql(f"""SELECT c.*,
  (SELECT product_id FROM ({PERF}) q WHERE q.seller_id = c.seller_id ORDER BY reviews_count DESC, product_id LIMIT 1) AS top_product,
  (SELECT id FROM fx_reviews r WHERE r.organization_id = c.seller_id ORDER BY review_date DESC, id LIMIT 1) AS last_review
FROM ({COMPARE}) c""", pp=PER_PRODUCT, **_compare_ctes),
    "product_list": kpi_sql(PRODUCTS, pp=PER_PRODUCT),
    "product_list_user": scoped_sql(f"""SELECT * REPLACE (coalesce(health_score, 80) AS health_score) FROM ({PRODUCTS}) t
WHERE organization_id IN (SELECT organization_id FROM allowed)""", pp=PER_PRODUCT),
    "product_detail": kpi_sql(f"""SELECT q.product_id, q.name, q.seller_id, o.name AS seller_name, o.organization_type,
  q.reviews_count AS total_reviews, q.positive_pct, q.negative_pct, q.health_score
FROM ({PERF}) q JOIN fx_organizations o ON o.id = q.seller_id""", pp=PER_PRODUCT),
    "product_search": scoped_sql("""SELECT id, organization_id, name, sku FROM fx_products WHERE category = 'ECONOMY'
AND (lower(name) LIKE '%ring%' OR lower(sku) LIKE '%ring%' OR lower(description) LIKE '%ring%')
AND organization_id IN (SELECT organization_id FROM allowed)"""),
    "product_aspect_fallback": kpi_sql(f"""SELECT p.id AS product_id, p.organization_id AS seller_id, a.aspect, a.mentions,
  a.positive_count, a.negative_count, a.positive_pct, a.negative_pct, 'product' AS source
FROM fx_products p JOIN ({_aspect_rollup('seller_id, product_id')}) a ON a.product_id = p.id
UNION ALL SELECT p.id, p.organization_id, a.aspect, a.mentions, a.positive_count, a.negative_count, a.positive_pct,
  a.negative_pct, 'seller' FROM fx_products p JOIN ({_aspect_rollup('seller_id')}) a ON a.seller_id = p.organization_id
WHERE p.id NOT IN (SELECT product_id FROM pa)""",
                                       clauses=CLAUSES.replace("FROM fx_reviews", "FROM fx_reviews WHERE rating = 1"),
                                       ctx=CONTEXTS, pa=PRODUCT_ASPECTS),
    "reviews_page": scoped_sql(f"""{PAGE} WHERE r.sentiment = 'POSITIVE' AND (lower(r.content) LIKE '%battery%'
OR lower(r.title) LIKE '%battery%') AND r.organization_id IN (SELECT organization_id FROM allowed)
AND r.id IN (SELECT id FROM ctx WHERE aspect = 'Battery')
ORDER BY r.review_date DESC, r.id LIMIT 20 OFFSET 20""", clauses=CLAUSES, ctx=CONTEXTS),
    "reviews_page_counts": kpi_sql("""SELECT count(*) AS total, CAST(greatest(1, ceil(count(*) / 20)) AS BIGINT) AS total_pages
FROM fx_reviews WHERE sentiment = 'NEGATIVE' AND (lower(content) LIKE '%money%' OR lower(title) LIKE '%money%')"""),
    "reviews_page_keyset": kpi_sql("""SELECT id, strftime(review_date, '%Y-%m-%d') AS day FROM fx_reviews
WHERE review_date < (SELECT CAST(min(review_date) AS DATE) + 900 FROM fx_reviews) ORDER BY review_date DESC, id LIMIT 20"""),
    **{f"reviews_sorted_{name}": kpi_sql(f"{PAGE} ORDER BY {order}, r.id LIMIT 20 OFFSET 40")
       for name, order in _ORDERS.items()},
    "reviews_recent_seller": _recent_sql("organization_id", 5),
    "reviews_recent_product": _recent_sql("product_id", 20),
    "aspect_results": result_sql(_aspect_rollup("seller_id")),
    "aspect_results_market": result_sql(_aspect_rollup("")),
    "issue_results": result_sql(f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seller_id
  ORDER BY frequency DESC, phrase, aspect) AS rank FROM ({_issue_rollup('seller_id')}) i) t WHERE rank <= 15"""),
    "issue_results_market": result_sql(f"{_issue_rollup('')} ORDER BY frequency DESC, phrase, aspect LIMIT 15"),
    "dashboard_summary": result_sql(f"""{DASH}, CAST(round(w.s, 0) AS BIGINT) AS score,
  CASE WHEN round(w.s, 0) >= 75 THEN 'Healthy' ELSE 'Moderate' END AS status, CAST(w.m AS BIGINT) AS total_aspect_mentions
FROM (SELECT sum(mentions * positive_pct) / sum(mentions) AS s, sum(mentions) AS m FROM ({_aspect_rollup('')}) a) w, {DASH_FROM}"""),
    "dashboard_no_aspects": kpi_sql(f"""{DASH}, CAST(round(round(p / n * 100, 1), 0) AS BIGINT) AS score,
  CASE WHEN round(round(p / n * 100, 1), 0) >= 75 THEN 'Healthy' ELSE 'Moderate' END AS status,
  CAST(0 AS BIGINT) AS total_aspect_mentions FROM {DASH_FROM}"""),
    "invitation_view": scoped_sql("""SELECT id, organization_id, email, note, strftime(created_at + INTERVAL 7 DAY, '%Y-%m-%d') AS expires_at
FROM (SELECT 'I' || CAST(o_orderkey AS VARCHAR) AS id,
  'S' || CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS organization_id,
  'user' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email, lower(o_orderpriority) AS note, o_orderdate AS created_at
  FROM orders) i WHERE organization_id IN (SELECT organization_id FROM allowed) ORDER BY created_at DESC, id LIMIT 50"""),
    "audit_view": with_views("fx_organizations fx_links fx_members fx_audit fx_profiles", """SELECT a.id, a.organization_id, o.name AS org_name,
  a.user_id, p.full_name AS user_name, p.email AS user_email, a.action, a.resource_type, a.details,
  strftime(a.created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM fx_audit a LEFT JOIN fx_profiles p ON p.id = a.user_id LEFT JOIN fx_organizations o ON o.id = a.organization_id
WHERE a.organization_id IN (SELECT organization_id FROM allowed) ORDER BY a.created_at DESC, a.id LIMIT 40""",
                             reach=REACH, caller=CALLER, allowed=ALLOWED),
    "audit_details": with_views("fx_audit", "SELECT id, CAST(json_extract_string(details, '$.k') AS BIGINT) AS k FROM fx_audit"),
    "team_view": with_views("fx_members fx_profiles", """SELECT m.organization_id, m.user_id, p.full_name, p.email, m.role
FROM fx_members m JOIN fx_profiles p ON p.id = m.user_id"""),
    "dataset_view": with_views("fx_datasets fx_organizations", """SELECT d.id, d.name, d.organization_id, o.name AS seller_name,
d.row_count FROM fx_datasets d JOIN fx_organizations o ON o.id = d.organization_id"""),
    "invite_expiry": """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS expires_at FROM orders""",
}
