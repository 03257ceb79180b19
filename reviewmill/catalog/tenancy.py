"""Visibility and write-gate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog.views import Views, with_views
from reviewmill.operators import tenancy


def edges(v: Views):
    return tenancy.reach(v.organizations, v.links)


def platform_user(v: Views):
    """First user who belongs to a platform, as the caller of the scoped queries."""
    platforms = v.organizations.filter(F.col("organization_type") == "platform").select(
        F.col("id").alias("organization_id"))
    return v.members.join(platforms, "organization_id", "left_semi").agg(F.min("user_id").alias("user_id"))


def allowed(v: Views):
    return tenancy.accessible(platform_user(v), v.members, edges(v)).select("organization_id")


def incoming(v: Views):
    """Review rows with the user who sends them; most, not all, send for their own organization."""
    sellers, users = v._count("supplier"), v._count("customer")
    user = (
        F.col("l_partkey") % sellers + sellers * (F.col("l_orderkey") % F.floor(users / sellers))
        + F.when(F.col("l_linenumber") % 4 == 0, 1).otherwise(0)
    ).cast("bigint")
    rows = v.table("lineitem")
    return rows.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    F.col("l_quantity").cast("bigint").cast("string")).alias("id"),
        F.concat(F.lit("S"), (F.col("l_partkey") % sellers).cast("string")).alias("organization_id"),
        user.alias("user_id"),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
        .otherwise("").alias("requested"),
    )


INCOMING = """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
  || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS id,
  'S' || CAST(l_partkey % s AS VARCHAR) AS organization_id,
  CAST(l_partkey % s + s * (l_orderkey % (c // s)) + CASE WHEN l_linenumber % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS user_id,
  CASE WHEN l_linenumber % 3 = 0 THEN 'S' || CAST(l_suppkey AS VARCHAR) ELSE '' END AS requested
FROM lineitem, (SELECT (SELECT count(*) FROM supplier) AS s, (SELECT count(*) FROM customer) AS c) k"""


def _rows(v: Views):
    """Rows of every tenant table visible to members of each organization."""
    e = edges(v)
    out = tenancy.visible_counts(v.reviews, e, "reviews")
    for name, df in (("products", v.products), ("analyses", v.analyses), ("audit_logs", v.audit),
                     ("datasets", v.datasets), ("members", v.members)):
        out = out.join(tenancy.visible_counts(df, e, name), "viewer_id")
    return out


def _links(v: Views):
    home = v.members.join(platform_user(v), "user_id", "left_semi").select("organization_id")
    return tenancy.visible_links(v.links, home)


def _verdicts(roles):
    def run(v: Views):
        rows = incoming(v).select("id", "organization_id", "user_id")
        return tenancy.with_verdict(rows, v.members, roles).select("id", "accepted")
    return run


def _rejects(v: Views):
    _, rejected = tenancy.write_gate(incoming(v).select("id", "organization_id", "user_id"), v.members)
    return rejected.select("id", "organization_id", "user_id")


def _override(v: Views):
    payload = incoming(v).select("id", "user_id", "requested")
    return tenancy.assign_tenant(payload, v.members, v.organizations, v.links).select(
        "id", "organization_id", "accepted")


QUERIES = {
    "memberships": lambda v: tenancy.memberships(v.members, v.organizations),
    "primary_membership": lambda v: tenancy.primary_membership(
        v.members.select("user_id", "organization_id", "role"), ["organization_id", "role"]),
    "managed_sellers": lambda v: tenancy.managed_sellers(v.links, v.organizations),
    "managed_sellers_active": lambda v: tenancy.managed_sellers(v.links, v.organizations, active_only=True),
    "access_reach": edges,
    "access_orgs": lambda v: tenancy.accessible_counts(v.members, edges(v)),
    "access_orgs_user": lambda v: tenancy.accessible(platform_user(v), v.members, edges(v)),
    "access_rows": _rows,
    "access_rows_user": lambda v: tenancy.scope(v.reviews, allowed(v)).select("id", "organization_id"),
    "access_profiles": lambda v: tenancy.visible_profile_counts(v.members, edges(v)),
    "access_profiles_user": lambda v: tenancy.visible_profiles(0, v.members, edges(v)),
    "access_links_user": _links,
    "write_gate": _verdicts(tenancy.WRITERS),
    "write_gate_rejects": _rejects,
    "admin_gate": _verdicts(tenancy.ADMINS),
    "tenant_override": _override,
    "preferences_own": lambda v: tenancy.own_rows(v.profiles.withColumnRenamed("id", "user_id"), 7),
}

REACH = """SELECT id AS viewer_id, id AS organization_id FROM fx_organizations
UNION SELECT l.platform_organization_id, l.seller_organization_id FROM fx_links l
JOIN fx_organizations o ON o.id = l.platform_organization_id AND o.organization_type = 'platform'"""
CALLER = "SELECT min(user_id) AS user_id FROM fx_members WHERE organization_id LIKE 'R%'"
ALLOWED = """SELECT DISTINCT m.user_id, r.organization_id FROM fx_members m JOIN reach r ON r.viewer_id = m.organization_id
WHERE m.user_id IN (SELECT user_id FROM caller)"""

_BASE = "fx_organizations fx_links fx_members"


def access_sql(body: str, views: str = "", **more: str) -> str:
    return with_views(f"{_BASE} {views}".strip(), body, reach=REACH, caller=CALLER, allowed=ALLOWED, **more)


def _visible(table: str) -> str:
    return f"(SELECT count(*) FROM {table} t JOIN reach r ON r.organization_id = t.organization_id WHERE r.viewer_id = o.id)"


def _verdict_sql(roles: str) -> str:
    return with_views("fx_members", f"""SELECT i.id, EXISTS (SELECT 1 FROM fx_members m WHERE m.user_id = i.user_id
  AND m.organization_id = i.organization_id AND m.role IN ({roles})) AS accepted FROM incoming i""", incoming=INCOMING)


ORACLES = {
    "memberships": with_views(_BASE, """SELECT m.organization_id, m.user_id, m.role, o.name AS organization_name,
o.organization_type FROM fx_members m JOIN fx_organizations o ON o.id = m.organization_id"""),
    "primary_membership": with_views(_BASE, """SELECT user_id, organization_id, role FROM (
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY organization_id, role) AS rn FROM fx_members) t WHERE rn = 1"""),
    "managed_sellers": with_views(_BASE, """SELECT l.platform_organization_id, l.seller_organization_id, o.name AS seller_name,
l.status FROM fx_links l JOIN fx_organizations o ON o.id = l.seller_organization_id"""),
    "managed_sellers_active": with_views(_BASE, """SELECT l.platform_organization_id, l.seller_organization_id,
o.name AS seller_name, l.status FROM fx_links l JOIN fx_organizations o ON o.id = l.seller_organization_id
WHERE l.status = 'active'"""),
    "access_reach": access_sql("SELECT viewer_id, organization_id FROM reach"),
    "access_orgs": access_sql("""SELECT m.user_id, count(DISTINCT r.organization_id) AS organizations
FROM fx_members m JOIN reach r ON r.viewer_id = m.organization_id GROUP BY m.user_id"""),
    "access_orgs_user": access_sql("SELECT user_id, organization_id FROM allowed"),
    "access_rows": access_sql(f"""SELECT o.id AS viewer_id, {_visible('fx_reviews')} AS reviews,
{_visible('fx_products')} AS products, {_visible('fx_analyses')} AS analyses, {_visible('fx_audit')} AS audit_logs,
{_visible('fx_datasets')} AS datasets, {_visible('fx_members')} AS members FROM fx_organizations o""",
                              "fx_reviews fx_products fx_analyses fx_audit fx_datasets"),
    "access_rows_user": access_sql("""SELECT id, organization_id FROM fx_reviews
WHERE organization_id IN (SELECT organization_id FROM allowed)""", "fx_reviews"),
    "access_profiles": access_sql("""SELECT r.viewer_id, count(DISTINCT m.user_id) AS profiles FROM reach r
JOIN fx_members m ON m.organization_id = r.organization_id GROUP BY r.viewer_id"""),
    "access_profiles_user": access_sql("""SELECT DISTINCT p.c_custkey AS user_id FROM customer p WHERE p.c_custkey = 0
OR p.c_custkey IN (SELECT m.user_id FROM fx_members m WHERE m.organization_id IN (
  SELECT r.organization_id FROM reach r JOIN fx_members me ON me.organization_id = r.viewer_id WHERE me.user_id = 0))"""),
    "access_links_user": access_sql("""SELECT l.* FROM fx_links l WHERE l.platform_organization_id IN (
  SELECT organization_id FROM fx_members WHERE user_id IN (SELECT user_id FROM caller))
OR l.seller_organization_id IN (SELECT organization_id FROM fx_members WHERE user_id IN (SELECT user_id FROM caller))"""),
    "write_gate": _verdict_sql("'owner', 'admin', 'analyst'"),
    "write_gate_rejects": with_views("fx_members", """SELECT i.id, i.organization_id, i.user_id FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM fx_members m WHERE m.user_id = i.user_id AND m.organization_id = i.organization_id
  AND m.role <> 'viewer')""", incoming=INCOMING),
    "admin_gate": _verdict_sql("'owner', 'admin'"),
    "preferences_own": with_views("fx_profiles", "SELECT id AS user_id, full_name, email FROM fx_profiles WHERE id = 7"),
    "tenant_override": access_sql("""SELECT i.id,
  CASE WHEN o.organization_type = 'platform' AND i.requested <> '' THEN i.requested ELSE m.organization_id END AS organization_id,
  m.organization_id IS NOT NULL AND (NOT (o.organization_type = 'platform' AND i.requested <> '') OR EXISTS (SELECT 1 FROM reach r
    WHERE r.viewer_id = m.organization_id AND r.organization_id = i.requested)) AS accepted
FROM incoming i LEFT JOIN (SELECT user_id, min(organization_id) AS organization_id FROM fx_members GROUP BY 1) m ON m.user_id = i.user_id
LEFT JOIN fx_organizations o ON o.id = m.organization_id""",
                                  incoming=INCOMING),
}
