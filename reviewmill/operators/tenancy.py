"""Who may see and write which rows.

Reach is kept as organization-to-organization edges, which grow with the number of
links. User-to-row pairs are never written out: users join their own few
organizations, and rows semi-join the organizations in reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import complaints

WRITERS = ("owner", "admin", "analyst")
ADMINS = ("owner", "admin")


def memberships(members: DataFrame, organizations: DataFrame) -> DataFrame:
    """Each membership with its organization's name and type."""
    orgs = organizations.select(F.col("id").alias("organization_id"), F.col("name").alias("organization_name"),
                                "organization_type")
    return members.join(orgs, "organization_id")


def primary_membership(members: DataFrame, order: list[str]) -> DataFrame:
    """One membership per user, the first in the given order."""
    keyed = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in members.columns if c != "user_id"])
    return members.groupBy("user_id").agg(F.min_by(row, keyed).alias("_m")).select("user_id", "_m.*")


def managed_sellers(links: DataFrame, organizations: DataFrame, active_only: bool = False) -> DataFrame:
    """Sellers of each platform (J2). Every status counts unless ``active_only``."""
    if active_only:
        links = links.filter(F.col("status") == "active")
    sellers = organizations.select(F.col("id").alias("seller_organization_id"), F.col("name").alias("seller_name"))
    return links.join(sellers, "seller_organization_id").select(
        "platform_organization_id", "seller_organization_id", "seller_name", "status"
    )


def reach(organizations: DataFrame, links: DataFrame, active_only: bool = False, distinct: bool = True) -> DataFrame:
    """Organizations a member of ``viewer_id`` may see: its own and those it manages.

    Ids and links are unique by schema, so the two parts can only repeat each other through
    a link of a platform to itself. ``distinct=False`` relies on that and spares the aggregate.
    """
    if active_only:
        links = links.filter(F.col("status") == "active")
    own = organizations.select(F.col("id").alias("viewer_id"), F.col("id").alias("organization_id"))
    platforms = organizations.filter(F.col("organization_type") == "platform").select(F.col("id").alias("viewer_id"))
    managed = links.select(F.col("platform_organization_id").alias("viewer_id"),
                           F.col("seller_organization_id").alias("organization_id"))
    edges = own.union(managed.filter("viewer_id <> organization_id").join(platforms, "viewer_id", "left_semi"))
    return edges.distinct() if distinct else edges


def accessible(users: DataFrame, members: DataFrame, edges: DataFrame) -> DataFrame:
    """Organizations each of the given users may see. ``users`` has a ``user_id`` column."""
    own = members.join(users, "user_id", "left_semi").select("user_id", F.col("organization_id").alias("viewer_id"))
    return own.join(edges, "viewer_id").select("user_id", "organization_id").distinct()


def accessible_counts(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of organizations every user may see, without listing user-organization pairs.

    Users with one membership, nearly all, read the count of their organization. Only
    users with several need the union of their reaches.
    """
    sizes = edges.groupBy("viewer_id").agg(F.count(F.lit(1)).alias("organizations"))
    own = members.groupBy("user_id").agg(F.min("organization_id").alias("viewer_id"),
                                         F.max("organization_id").alias("_last"))
    single = own.filter(F.col("viewer_id") == F.col("_last")).join(sizes, "viewer_id")
    several = own.filter(F.col("viewer_id") != F.col("_last"))
    merged = accessible(several, members, edges).groupBy("user_id").agg(F.count(F.lit(1)).alias("organizations"))
    return single.select("user_id", "organizations").unionByName(merged)


def scope(df: DataFrame, allowed: DataFrame, column: str = "organization_id") -> DataFrame:
    """Rows of the allowed organizations; none if nothing is allowed.

    A semi-join needs no distinct keys. Leaving the aggregate out also lets Spark split
    the partition of an organization that owns a large part of the rows.
    """
    return df.join(allowed.select(F.col("organization_id").alias(column)), column, "left_semi")


def visible_counts(df: DataFrame, edges: DataFrame, name: str, column: str = "organization_id") -> DataFrame:
    """Rows of a table that members of each organization may see (J4 for all at once).

    Counts are taken per owning organization first, so the join carries one row per
    organization whatever its share of the table.
    """
    per_org = df.groupBy(F.col(column).alias("organization_id")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        edges.join(per_org, "organization_id", "left")
        .groupBy("viewer_id").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))
    )


def visible_profiles(user_id, members: DataFrame, edges: DataFrame) -> DataFrame:
    """Profiles a user may see: their own or any member of a reachable organization.

    Two branches and a distinct union in place of a join on an OR condition.
    """
    me = members.sparkSession.range(1).select(F.lit(user_id).alias("user_id"))
    own = members.filter(F.col("user_id") == user_id).select(F.col("organization_id").alias("viewer_id"))
    fellow = scope(members, edges.join(own, "viewer_id", "left_semi")).select("user_id")
    return me.union(fellow).distinct()


def visible_profile_counts(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct profiles the members of each organization may see (J5 for all at once).

    Users of one organization are counted per organization and the counts added along the edges. Only users of several
    organizations, who could be counted twice, are listed with their viewers.
    """
    pairs = members.select("organization_id", "user_id").distinct()
    several = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("user_id")
    single = pairs.join(several, "user_id", "left_anti").groupBy("organization_id").agg(F.count(F.lit(1)).alias("_n"))
    added = edges.join(single, "organization_id").groupBy("viewer_id").agg(F.sum("_n").alias("_n"))
    listed = edges.join(pairs.join(several, "user_id", "left_semi"), "organization_id")
    listed = listed.groupBy("viewer_id").agg(F.count_distinct("user_id").alias("_n"))
    return added.unionByName(listed).groupBy("viewer_id").agg(F.sum("_n").alias("profiles"))


def visible_links(links: DataFrame, own: DataFrame) -> DataFrame:
    """Links seen from either side by members of the given organizations."""
    as_platform = scope(links, own, "platform_organization_id")
    as_seller = scope(links, own, "seller_organization_id")
    return as_platform.unionByName(as_seller).distinct()


# --- write gates -------------------------------------------------------------------

def write_gate(incoming: DataFrame, members: DataFrame, roles: tuple[str, ...] = WRITERS,
               user: str = "user_id", organization: str = "organization_id", bitmaps: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows whose writer holds one of the roles in the row's organization, and the rest.

    The join moves whole rows. With ``bitmaps``, a filter of 4 kB each over the writers who may pass keeps most of the others from it;
    the join is then one with distinct writers, since Spark would carry out a semi join ahead of the filter.
    """
    allowed = members.filter(F.col("role").isin(list(roles))).select(
        F.col("user_id").alias(user), F.col("organization_id").alias(organization))
    if bitmaps:
        likely = complaints.may_match(incoming, [user, organization], allowed, bitmaps)
        return likely.join(allowed.distinct(), [user, organization]), incoming.join(allowed, [user, organization], "left_anti")
    return incoming.join(allowed, [user, organization], "left_semi"), \
        incoming.join(allowed, [user, organization], "left_anti")


def with_verdict(incoming: DataFrame, members: DataFrame, roles: tuple[str, ...] = WRITERS) -> DataFrame:
    """Incoming rows with an ``accepted`` flag, for one pass over both outcomes.

    A user has one role per organization, so the left join repeats no row.
    """
    allowed = members.filter(F.col("role").isin(list(roles))).select(
        "user_id", "organization_id", F.lit(True).alias("_ok"))
    return (
        incoming.join(allowed, ["user_id", "organization_id"], "left")
        .withColumn("accepted", F.coalesce(F.col("_ok"), F.lit(False))).drop("_ok")
    )


def own_rows(df: DataFrame, user_id, column: str = "user_id") -> DataFrame:
    """Rows that only their owner may touch, such as preferences."""
    return df.filter(F.col(column) == F.lit(user_id))


def assign_tenant(payload: DataFrame, members: DataFrame, organizations: DataFrame, links: DataFrame) -> DataFrame:
    """Tenant of each incoming row, decided by the server.

    Sellers always write to their own organization, whatever the payload asks for.
    Platform users may name a seller they manage; naming another one rejects the row.
    Without a request the row belongs to the user's own organization, the first of their memberships. Every row comes
    back once; a sender without membership is refused, with no organization.
    """
    first = primary_membership(members.select("user_id", "organization_id"), ["organization_id"])
    home = memberships(first, organizations).select(
        "user_id", F.col("organization_id").alias("_home"), "organization_type"
    )
    edges = reach(organizations, links, distinct=False).select(
        F.col("viewer_id").alias("_home"), F.col("organization_id").alias("_key"), F.lit(True).alias("_ok"))
    asked = F.coalesce(F.col("organization_type") == "platform", F.lit(False)) & (F.coalesce(F.col("requested"), F.lit("")) != "")
    # Most rows ask for nothing. A key that matches no organization, made from the row, keeps
    # them from meeting in one partition.
    spread = F.concat(F.lit("?"), F.xxhash64(*payload.columns).cast("string"))
    rows = payload.join(home, "user_id", "left").withColumn("_asked", asked)
    rows = rows.withColumn("_key", F.when(F.col("_asked"), F.col("requested")).otherwise(spread))
    return rows.join(edges, ["_home", "_key"], "left").select(
        *payload.columns,
        F.when(F.col("_asked"), F.col("requested")).otherwise(F.col("_home")).alias("organization_id"),
        (F.col("_home").isNotNull() & (~F.col("_asked") | F.coalesce(F.col("_ok"), F.lit(False)))).alias("accepted"),
    )
