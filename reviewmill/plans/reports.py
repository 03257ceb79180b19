"""The named reports a user asks for (Q1-Q9, Q12-Q15), as sets of DataFrames.

A report is lazy: each value runs when it is read, and filters on a platform,
seller or product reach the scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import aspects, kpis, ranking, tenancy
from reviewmill.plans import jobs


@dataclass
class Tenant:
    """The tables behind the reports."""

    organizations: DataFrame
    links: DataFrame
    members: DataFrame
    products: DataFrame
    reviews: DataFrame
    analyses: DataFrame
    aspect_results: DataFrame | None = None
    issue_results: DataFrame | None = None

    def aspect_rows(self) -> DataFrame:
        return self.aspect_results if self.aspect_results is not None else jobs.product_aspects(self.reviews)

    def issue_rows(self) -> DataFrame:
        return self.issue_results if self.issue_results is not None else jobs.product_issues(self.reviews)

    def of(self, organization_id: str) -> Tenant:
        """The same tables, cut to one organization's rows."""
        def mine(df: DataFrame | None) -> DataFrame | None:
            return None if df is None else df.filter(F.col("organization_id") == organization_id)

        return Tenant(
            self.organizations.filter(F.col("id") == organization_id), self.links, self.members, mine(self.products),
            mine(self.reviews), mine(self.analyses), mine(self.aspect_results), mine(self.issue_results),
        )


def platform_overview(t: Tenant, platform_id: str | None = None, parity: bool = False) -> dict[str, DataFrame]:
    """Totals, health and sellers of one platform, or of all (Q1, Q2)."""
    links = t.links.filter(F.col("platform_organization_id") == platform_id) if platform_id else t.links
    sellers = kpis.seller_breakdown(links, t.organizations, t.products, t.reviews, t.analyses, parity)
    totals = kpis.platform_totals(sellers, parity).join(kpis.marketplace_health(sellers), "platform_id")
    return {"totals": totals, "sellers": sellers}


def seller_overview(t: Tenant, seller_id: str, parity: bool = False) -> dict[str, DataFrame]:
    """KPIs, product performance, top issues and recent reviews of a seller (Q5)."""
    own = t.of(seller_id)
    return {
        "kpis": kpis.seller_overview(own.organizations, own.products, own.reviews, own.analyses, parity),
        "product_performance": kpis.product_performance(own.products, own.reviews, parity)
        .orderBy(F.desc("reviews_count"), "product_id"),
        "top_issues": kpis.top_issues(kpis.issue_rollup(own.issue_rows()), k=6),
        "recent_reviews": kpis.recent_reviews(own.reviews, own.products, k=5),
    }


def seller_detail(t: Tenant, seller_id: str, parity: bool = False) -> dict[str, DataFrame]:
    """Everything a platform sees of one seller."""
    own = t.of(seller_id)
    report = seller_overview(t, seller_id, parity)
    report.update({
        "products": kpis.product_list(own.products, own.organizations, own.reviews, own.analyses, parity),
        "aspects": aspects.aspect_rollup(own.aspect_rows()),
        "issues": kpis.top_issues(kpis.issue_rollup(own.issue_rows())),
        "reviews": kpis.review_page(own.reviews, own.products, own.organizations, size=10),
    })
    return report


def seller_analytics(t: Tenant, seller_id: str) -> dict[str, DataFrame]:
    """Aspects and issues of a seller (Q6, Q13)."""
    own = t.of(seller_id)
    return {
        "aspects": aspects.aspect_rollup(own.aspect_rows()).orderBy(F.desc("mentions"), "aspect"),
        "issues": kpis.top_issues(kpis.issue_rollup(own.issue_rows())),
    }


def _by_seller(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("organization_id", "seller_id")


def cross_seller(t: Tenant, platform_id: str, parity: bool = False) -> dict[str, DataFrame]:
    """Sellers of a platform side by side, with market-wide aspects and issues (Q4)."""
    managed = t.links.filter(F.col("platform_organization_id") == platform_id).select(
        F.col("seller_organization_id").alias("organization_id"))
    orgs = t.organizations.join(managed.withColumnRenamed("organization_id", "id"), "id", "left_semi")
    products, reviews, analyses = (tenancy.scope(df, managed) for df in (t.products, t.reviews, t.analyses))
    aspect_rows, issue_rows = tenancy.scope(t.aspect_rows(), managed), tenancy.scope(t.issue_rows(), managed)
    overview = kpis.seller_overview(orgs, products, reviews, analyses, parity)
    return {
        "comparison": kpis.seller_comparison(
            overview, aspects.aspect_rollup(_by_seller(aspect_rows), ("seller_id",)),
            kpis.issue_rollup(_by_seller(issue_rows), ("seller_id",))),
        "marketplace_aspects": aspects.aspect_rollup(aspect_rows),
        "marketplace_issues": kpis.top_issues(kpis.issue_rollup(issue_rows)),
    }


def product_list(t: Tenant, user_id, organization_id: str | None = None, category: str | None = None,
                 search: str | None = None, parity: bool = False) -> DataFrame:
    """Products a user may see, newest first (Q7)."""
    allowed = _allowed(t, user_id)
    products = tenancy.scope(kpis.filter_products(t.products, organization_id, category, search), allowed)
    return kpis.product_list(products, t.organizations, tenancy.scope(t.reviews, allowed),
                             tenancy.scope(t.analyses, allowed), parity).orderBy(F.desc("created_seq"))


def product_detail(t: Tenant, product_id: str, parity: bool = False) -> dict[str, DataFrame]:
    """One product with its aspects, issues and newest reviews (Q8)."""
    product = t.products.filter(F.col("id") == product_id)
    reviews = t.reviews.filter(F.col("product_id") == product_id)
    aspect_rows, issue_rows = _by_seller(t.aspect_rows()), _by_seller(t.issue_rows())
    return {
        "kpis": kpis.product_detail(product, t.organizations, reviews, parity),
        "aspects": kpis.with_fallback(product, aspects.aspect_rollup(aspect_rows, ("seller_id", "product_id")),
                                      aspects.aspect_rollup(aspect_rows, ("seller_id",))),
        "issues": kpis.with_fallback(product, kpis.issue_rollup(issue_rows, ("seller_id", "product_id")),
                                     kpis.issue_rollup(issue_rows, ("seller_id",))),
        "reviews": kpis.review_page(reviews, t.products, t.organizations, size=20),
    }


def _allowed(t: Tenant, user_id) -> DataFrame:
    users = t.members.select("user_id").filter(F.col("user_id") == user_id).distinct()
    return tenancy.accessible(users, t.members, tenancy.reach(t.organizations, t.links)).select("organization_id")


def review_explorer(t: Tenant, user_id, sort_by: str = "default", page: int = 1, limit: int = 20,
                    **filters) -> dict[str, DataFrame]:
    """Filtered page of the reviews a user may see, with the page counts (Q9)."""
    rows = tenancy.scope(kpis.filter_reviews(t.reviews, **filters), _allowed(t, user_id))
    return {
        "counts": ranking.page_counts(rows, limit),
        "reviews": kpis.review_page(rows, t.products, t.organizations, sort_by, page, limit),
    }


def dashboard(t: Tenant) -> DataFrame:
    """Review totals and health over all reviews (Q12)."""
    return kpis.dashboard(t.reviews, aspects.aspect_rollup(t.aspect_rows()))


def people(t: Tenant, profiles: DataFrame, audit: DataFrame, user_id, organization_id: str) -> dict[str, DataFrame]:
    """Team and audit trail of an organization (Q14)."""
    team = kpis.team_view(t.members.filter(F.col("organization_id") == organization_id), profiles)
    return {"team": team, "audit": kpis.audit_view(tenancy.scope(audit, _allowed(t, user_id)), profiles,
                                                   t.organizations, 40)}


def datasets(t: Tenant, table: DataFrame, user_id) -> DataFrame:
    """Data sets a user may see (Q15)."""
    return kpis.dataset_view(tenancy.scope(table, _allowed(t, user_id)), t.organizations)
