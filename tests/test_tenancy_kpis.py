"""Tenant isolation, write gates and KPIs on a small hand-made market."""

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import aspects, kpis, ranking, tenancy
from reviewmill.plans import reports


@pytest.fixture(scope="module")
def market(spark):
    orgs = spark.createDataFrame(
        [("R", "Mall", "platform"), ("A", "Alpha", "seller"), ("B", "Beta", "seller"), ("C", "Gamma", "seller")],
        "id string, name string, organization_type string")
    links = spark.createDataFrame([("R", "A", "active"), ("R", "B", "suspended")],
                                  "platform_organization_id string, seller_organization_id string, status string")
    members = spark.createDataFrame(
        [(1, "R", "owner"), (2, "A", "analyst"), (3, "B", "viewer"), (4, "C", "admin"), (5, "A", "owner"), (5, "C", "viewer")],
        "user_id bigint, organization_id string, role string")
    products = spark.createDataFrame(
        [("p1", "A", "Lamp", "L1", "Home", "a lamp", 1), ("p2", "A", "Desk", "D1", "Home", "a desk", 2),
         ("p3", "B", "Pen", "P1", "Office", "a pen", 3), ("p4", "C", "Cup", "C1", "Home", "a cup", 4)],
        "id string, organization_id string, name string, sku string, category string, description string, created_seq bigint")
    rows = [(f"r{i}", "A", "p1", "t", "battery is great", 5, "POSITIVE" if i % 4 else "NEGATIVE", 0.9, f"2024-01-{i + 1:02d}")
            for i in range(24)]
    rows += [("s1", "B", "p3", "t", "stopped working", 1, "NEGATIVE", 0.0, "2024-02-01")]
    reviews = spark.createDataFrame(
        rows, "id string, organization_id string, product_id string, title string, content string, rating int, "
              "sentiment string, sentiment_score double, review_date string").withColumn(
        "review_date", F.to_timestamp("review_date"))
    analyses = spark.createDataFrame(
        [("a1", "p1", "A", "completed", 60, "2024-01-01"), ("a2", "p1", "A", "completed", 70, "2024-01-02"),
         ("a3", "p1", "A", "failed", 99, "2024-01-02")],
        "id string, product_id string, organization_id string, status string, health_score bigint, created_at string")
    return reports.Tenant(orgs, links, members, products, reviews, analyses)


def edges(t):
    return tenancy.reach(t.organizations, t.links)


def users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id bigint")


def reachable(t, spark, *ids):
    rows = tenancy.accessible(users(spark, *ids), t.members, edges(t)).collect()
    return {(r.user_id, r.organization_id) for r in rows}


def test_platform_reaches_all_its_sellers(market, spark):
    assert reachable(market, spark, 1) == {(1, "R"), (1, "A"), (1, "B")}
    active = tenancy.reach(market.organizations, market.links, active_only=True)
    got = tenancy.accessible(users(spark, 1), market.members, active).collect()
    assert {r.organization_id for r in got} == {"R", "A"}


def test_sellers_see_only_themselves(market, spark):
    assert reachable(market, spark, 2, 4) == {(2, "A"), (4, "C")}


def test_counts_without_pairs_equal_pairs(market, spark):
    got = {r.user_id: r.organizations for r in tenancy.accessible_counts(market.members, edges(market)).collect()}
    assert got == {1: 3, 2: 1, 3: 1, 4: 1, 5: 2}


def test_seller_rows_partition_the_table(market):
    sellers = [r.id for r in market.organizations.filter("organization_type = 'seller'").collect()]
    parts = []
    for s in sellers:
        allowed = market.organizations.filter(F.col("id") == s).select(F.col("id").alias("organization_id"))
        parts += [r.id for r in tenancy.scope(market.reviews, allowed).collect()]
    assert sorted(parts) == sorted(r.id for r in market.reviews.collect())


def test_empty_access_gives_no_rows(market):
    none = market.organizations.filter("id = '?'").select(F.col("id").alias("organization_id"))
    assert tenancy.scope(market.reviews, none).count() == 0


def test_visible_profiles_and_links(market):
    got = {r.user_id for r in tenancy.visible_profiles(1, market.members, edges(market)).collect()}
    assert got == {1, 2, 3, 5}
    assert {r.user_id for r in tenancy.visible_profiles(99, market.members, edges(market)).collect()} == {99}
    own = market.members.filter("user_id = 2").select("organization_id")
    assert [r.seller_organization_id for r in tenancy.visible_links(market.links, own).collect()] == ["A"]


def test_viewers_cannot_write(market, spark):
    rows = spark.createDataFrame([(2, "A"), (3, "B"), (2, "B"), (4, "C"), (5, "C")], "user_id bigint, organization_id string")
    ok, rejected = tenancy.write_gate(rows, market.members)
    assert {tuple(r) for r in ok.collect()} == {(2, "A"), (4, "C")}
    assert {tuple(r) for r in rejected.collect()} == {(3, "B"), (2, "B"), (5, "C")}
    admins, _ = tenancy.write_gate(rows, market.members, tenancy.ADMINS)
    assert {tuple(r) for r in admins.collect()} == {(4, "C")}


def test_spoofed_tenant_is_replaced(market, spark):
    rows = spark.createDataFrame([("x", 2, "B"), ("y", 1, "A"), ("z", 1, "C"), ("w", 1, ""), ("u", 999, "A")],
                                 "id string, user_id bigint, requested string")
    twice = market.members.unionByName(market.members.filter("user_id = 2").withColumn("organization_id", F.lit("B")))
    out = tenancy.assign_tenant(rows, twice, market.organizations, market.links)
    assert out.count() == 5
    got = {r.id: (r.organization_id, r.accepted) for r in out.collect()}
    assert got == {"x": ("A", True), "y": ("A", True), "z": ("C", False), "w": ("R", True), "u": (None, False)}


def test_product_list_does_not_multiply_counts(market):
    row = kpis.product_list(market.products, market.organizations, market.reviews, market.analyses).filter("id = 'p1'").first()
    assert (row.review_count, row.positive_pct, row.negative_pct, row.health_score) == (24, 75.0, 25.0, 70)


def test_product_detail_uses_all_reviews(market):
    row = reports.product_detail(market, "p1")["kpis"].first()
    assert (row.total_reviews, row.positive_pct, row.health_score) == (24, 75.0, 75)


def test_latest_analysis_breaks_ties_by_id(market):
    assert kpis.latest_analysis(market.analyses).first().latest_health == 99


def test_empty_sellers_are_null_or_parity(market):
    def of(parity):
        rows = kpis.seller_overview(market.organizations, market.products, market.reviews, market.analyses, parity)
        return rows.filter("seller_id = 'C'").first()
    assert (of(False).positive_pct, of(False).health_score) == (None, None)
    assert (of(True).positive_pct, of(True).negative_pct, of(True).health_score) == (84.0, 16.0, 84)


def test_platform_overview(market):
    report = reports.platform_overview(market, "R")
    totals = report["totals"].first()
    assert (totals.total_sellers, totals.total_products, totals.total_reviews) == (2, 3, 25)
    assert totals.overall_positive_pct == 72.0
    # (99 * 24 + 0 * 1) / 25
    assert totals.marketplace_health == 95
    assert {r.seller_id for r in report["sellers"].collect()} == {"A", "B"}


def test_issue_rollup_takes_the_most_urgent_priority(spark):
    rows = spark.createDataFrame(
        [("x", "Battery", 2, 1.0, "LOW", 50.0), ("x", "Battery", 3, 2.0, "HIGH", 70.0), ("x", "Battery", 1, 3.0, "MEDIUM", 60.0)],
        "phrase string, aspect string, frequency int, percentage double, priority string, negative_pct double")
    row = kpis.issue_rollup(rows).first()
    assert (row.frequency, row.percentage, row.priority, row.negative_pct) == (6, 2.0, "HIGH", 60.0)


def test_reports_run(market):
    detail = reports.seller_detail(market, "A")
    assert {k: v.count() for k, v in detail.items()} == {
        "kpis": 1, "product_performance": 2, "top_issues": 0, "recent_reviews": 5, "products": 2, "aspects": 1,
        "issues": 0, "reviews": 10}
    compared = reports.cross_seller(market, "R")
    got = {r.seller_id: (r.top_aspect, r.top_issue) for r in compared["comparison"].collect()}
    assert got == {"A": ("Battery", "None"), "B": ("N/A", "stopped working")}
    assert reports.product_list(market, 1, search="LAMP").count() == 1
    page = reports.review_explorer(market, 2, "longest", 2, 20)
    assert page["counts"].first().total_pages == 2 and page["reviews"].count() == 4
    assert reports.seller_analytics(market, "B")["issues"].first().priority == "HIGH"


def test_zero_score_is_replaced_on_read(market):
    page = kpis.review_page(market.reviews.filter("id = 's1'"), market.products, market.organizations)
    assert page.first().sentiment_score == 0.95


def test_fallback_to_seller_aspects(market):
    per_product = market.products.limit(0).select(
        F.col("organization_id").alias("seller_id"), F.col("id").alias("product_id"), F.lit("x").alias("aspect"))
    per_seller = market.products.filter("id = 'p1'").select(F.col("organization_id").alias("seller_id"), F.lit("Battery").alias("aspect"))
    rows = kpis.with_fallback(market.products, per_product, per_seller).collect()
    assert {(r.product_id, r.aspect, r.source) for r in rows} == {("p1", "Battery", "seller"), ("p2", "Battery", "seller")}


def test_health_from_aspects(spark):
    stats = spark.createDataFrame([("a", 30, 90.0), ("b", 10, 20.0)], "aspect string, mentions bigint, positive_pct double")
    row = aspects.health_from_aspects(stats).first()
    assert (row.score, row.status) == (73, "Moderate")


def test_slugs_of_a_hot_name(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "Same Name").otherwise(F.concat(F.lit("n"), "id")).alias("name"))
    rows = kpis.unique_slugs(df, "name", "id").collect()
    assert len({r.slug for r in rows}) == 2000
    hot = sorted((r.id, r.slug) for r in rows if r.name == "Same Name")
    few = spark.createDataFrame([(1, "foo"), (2, "foo"), (3, "foo 2"), (4, "foo 2")], "id long, name string")
    slugs = {r.id: r.slug for r in kpis.unique_slugs(few, "name", "id").collect()}
    assert len(set(slugs.values())) == 4 and (slugs[1], slugs[3]) == ("foo", "foo-2") and slugs[2].startswith("foo-2-")
    assert [s for _, s in hot] == ["same-name"] + [f"same-name-{i}" for i in range(2, len(hot) + 1)]


def test_pages_cover_the_table_once(market):
    seen = [r.id for n in (1, 2, 3) for r in ranking.page(market.reviews, ranking.review_order(), n, 10).collect()]
    assert sorted(seen) == sorted(r.id for r in market.reviews.collect())
    assert ranking.page_counts(market.reviews.limit(0)).first().total_pages == 1


def test_expiry_is_seven_days(spark):
    row = spark.sql("SELECT timestamp '2024-02-26 10:00:00' AS c").select(kpis.expiry("c").cast("string").alias("e")).first()
    assert row.e == "2024-03-04 10:00:00"
