"""Tenant KPIs as set-based queries.

Facts are reduced to one row per organization or product before any join, so join
fan-out cannot inflate a count and a very large seller costs no more than a small one.
``parity`` fills the constants the original views show for empty data; the default is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions import rules
from reviewmill.functions import text as tx
from reviewmill.functions.names import free_names
from reviewmill.operators import aspects, ranking, running

# Fixed values shown for empty data, per view: (positive, negative).
EMPTY_PLATFORM = (85.0, 15.0)
EMPTY_PLATFORM_SELLER = (82.0, 18.0)
EMPTY_SELLER = (84.0, 16.0)
EMPTY_PRODUCT = (84.0, 16.0)
EMPTY_HEALTH = 80


def _empty(pair: tuple[float, float], parity: bool) -> tuple[float | None, float | None]:
    return pair if parity else (None, None)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


# --- one row per key ---------------------------------------------------------------

def review_stats(reviews: DataFrame, key: str) -> DataFrame:
    """Reviews and class counts per key in one conditional aggregate."""
    return reviews.groupBy(key).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(F.col("sentiment") == "POSITIVE").alias("positives"),
        F.count_if(F.col("sentiment") == "NEGATIVE").alias("negatives"),
    )


def product_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("organization_id").agg(F.count(F.lit(1)).alias("products"))


def latest_analysis(analyses: DataFrame, key: str = "organization_id") -> DataFrame:
    """Health score of the newest analysis per key, ties broken by id."""
    newest = F.struct("created_at", "id")
    return analyses.groupBy(key).agg(F.max_by("health_score", newest).alias("latest_health"))


# --- platform and seller KPIs ----------------------------------------------------------

def with_facts(sellers: DataFrame, products: DataFrame, reviews: DataFrame, analyses: DataFrame) -> DataFrame:
    """Sellers with their products, review counts and latest health, null where they have none.

    Each fact is one row per organization by then, so the left joins are on small,
    equally keyed tables.
    """
    return (
        sellers.join(review_stats(reviews, "organization_id"), "organization_id", "left")
        .join(latest_analysis(analyses), "organization_id", "left")
        .join(product_counts(products), "organization_id", "left")
    )


def seller_breakdown(links: DataFrame, organizations: DataFrame, products: DataFrame, reviews: DataFrame,
                     analyses: DataFrame, parity: bool = False) -> DataFrame:
    """Every platform's sellers with their KPIs, all platforms at once.

    Health is the latest analysis, else 95 % of the positive share.
    """
    names = organizations.select(F.col("id").alias("organization_id"), F.col("name").alias("seller_name"))
    sellers = links.select(F.col("platform_organization_id").alias("platform_id"),
                           F.col("seller_organization_id").alias("organization_id"), "status")
    rows = with_facts(sellers.join(names, "organization_id"), products, reviews, analyses)
    pos, neg = _empty(EMPTY_PLATFORM_SELLER, parity)
    n = _zero("reviews")
    rows = rows.withColumn("positive_pct", tx.percent(_zero("positives"), n, 1, pos))
    return rows.select(
        "platform_id", F.col("organization_id").alias("seller_id"), "seller_name", "status",
        _zero("products").alias("products_count"), n.alias("reviews_count"),
        "positive_pct",
        F.when(n > 0, F.round(F.lit(100.0) - F.col("positive_pct"), 1)).otherwise(F.lit(neg).cast("double"))
        .alias("negative_pct"),
        F.coalesce("latest_health", F.round(F.col("positive_pct") * 0.95, 0)).cast("bigint").alias("health_score"),
        _zero("positives").alias("positives"), _zero("negatives").alias("negatives"),
    )


def platform_totals(breakdown: DataFrame, parity: bool = False, platforms: DataFrame | None = None) -> DataFrame:
    """Totals of each platform from its seller rows.

    With ``platforms`` (platform_id) a platform without sellers has a row too, with zero totals.
    """
    pos, neg = _empty(EMPTY_PLATFORM, parity)
    sums = breakdown.groupBy("platform_id").agg(
        F.count(F.lit(1)).alias("total_sellers"),
        F.sum("products_count").alias("total_products"),
        F.sum("reviews_count").alias("total_reviews"),
        F.sum("positives").alias("_pos"), F.sum("negatives").alias("_neg"),
    )
    if platforms is not None:
        sums = platforms.select("platform_id").join(sums, "platform_id", "left").fillna(
            0, ["total_sellers", "total_products", "total_reviews", "_pos", "_neg"])
    return sums.select(
        "platform_id", "total_sellers", "total_products", "total_reviews",
        tx.percent(F.col("_pos"), F.col("total_reviews"), 1, pos).alias("overall_positive_pct"),
        tx.percent(F.col("_neg"), F.col("total_reviews"), 1, neg).alias("overall_negative_pct"),
    )


def marketplace_health(breakdown: DataFrame) -> DataFrame:
    """Health of each platform, weighted by reviews with at least one per seller."""
    weight = F.greatest(F.col("reviews_count"), F.lit(1))
    known = F.when(F.col("health_score").isNotNull(), weight)
    return breakdown.groupBy("platform_id").agg(
        F.round(F.sum(F.col("health_score") * weight) / F.sum(known), 0).cast("bigint").alias("marketplace_health")
    )


def seller_overview(organizations: DataFrame, products: DataFrame, reviews: DataFrame, analyses: DataFrame,
                    parity: bool = False) -> DataFrame:
    """KPIs of every seller; health is the latest analysis, else the positive share."""
    sellers = organizations.filter(F.col("organization_type") == "seller").select(
        F.col("id").alias("organization_id"), F.col("name").alias("seller_name"))
    rows = with_facts(sellers, products, reviews, analyses)
    pos, neg = _empty(EMPTY_SELLER, parity)
    n = _zero("reviews")
    rows = rows.withColumn("positive_pct", tx.percent(_zero("positives"), n, 1, pos))
    return rows.select(
        F.col("organization_id").alias("seller_id"), "seller_name",
        _zero("products").alias("total_products"), n.alias("total_reviews"), "positive_pct",
        tx.percent(_zero("negatives"), n, 1, neg).alias("negative_pct"),
        F.coalesce("latest_health", F.round("positive_pct", 0)).cast("bigint").alias("health_score"),
    )


def product_performance(products: DataFrame, reviews: DataFrame, parity: bool = False) -> DataFrame:
    """Reviews, shares and health of every product, with or without reviews."""
    pos, neg = _empty(EMPTY_PRODUCT, parity)
    stats = review_stats(reviews, "product_id").withColumnRenamed("product_id", "id")
    rows = products.select("id", "organization_id", "name", "sku", "category").join(stats, "id", "left")
    n = _zero("reviews")
    rows = rows.withColumn("positive_pct", tx.percent(_zero("positives"), n, 1, pos))
    return rows.select(
        F.col("organization_id").alias("seller_id"), F.col("id").alias("product_id"), "name", "sku", "category",
        n.alias("reviews_count"), "positive_pct",
        F.when(n > 0, F.round(F.lit(100.0) - F.col("positive_pct"), 1)).otherwise(F.lit(neg).cast("double"))
        .alias("negative_pct"),
        F.round("positive_pct", 0).cast("bigint").alias("health_score"),
    )


# --- products ------------------------------------------------------------------------

def product_list(products: DataFrame, organizations: DataFrame, reviews: DataFrame, analyses: DataFrame,
                 parity: bool = False) -> DataFrame:
    """Products with review metrics and best completed health.

    Reviews and analyses are aggregated per product before they meet, so neither
    multiplies the other (D5).
    """
    orgs = organizations.select(F.col("id").alias("organization_id"), F.col("name").alias("seller_name"))
    stats = review_stats(reviews, "product_id").withColumnRenamed("product_id", "id")
    health = (
        analyses.filter(F.col("status") == "completed")
        .groupBy(F.col("product_id").alias("id")).agg(F.max("health_score").alias("best_health"))
    )
    rows = products.join(orgs, "organization_id").join(stats, "id", "left").join(health, "id", "left")
    n = _zero("reviews")
    share = F.coalesce(tx.percent(_zero("positives"), n, 1), F.lit(0.0))
    return rows.select(
        "id", "organization_id", "seller_name", "name", "sku", "category", "created_seq", n.alias("review_count"),
        share.alias("positive_pct"),
        F.when(n > 0, F.round(F.lit(100.0) - share, 1)).otherwise(0.0).alias("negative_pct"),
        F.coalesce("best_health", F.lit(EMPTY_HEALTH if parity else None)).cast("bigint").alias("health_score"),
    )


def filter_products(products: DataFrame, organization_id: str | None = None, category: str | None = None,
                    search: str | None = None) -> DataFrame:
    """Optional filters of the product list; "All" disables the category."""
    if organization_id:
        products = products.filter(F.col("organization_id") == organization_id)
    if category and category != "All":
        products = products.filter(F.col("category") == category)
    if search:
        products = products.filter(rules.matches_any(["name", "sku", "description"], search))
    return products


def product_detail(products: DataFrame, organizations: DataFrame, reviews: DataFrame,
                   parity: bool = False) -> DataFrame:
    """KPIs of every product over all its reviews, not over its first page."""
    orgs = organizations.select(F.col("id").alias("seller_id"), F.col("name").alias("seller_name"),
                                "organization_type")
    return product_performance(products, reviews, parity).join(orgs, "seller_id").select(
        "product_id", "name", "seller_id", "seller_name", "organization_type",
        F.col("reviews_count").alias("total_reviews"), "positive_pct", "negative_pct", "health_score",
    )


def with_fallback(products: DataFrame, per_product: DataFrame, per_seller: DataFrame) -> DataFrame:
    """Result rows of each product, or its seller's where it has none."""
    pairs = products.select(F.col("id").alias("product_id"), F.col("organization_id").alias("seller_id"))
    own = pairs.join(per_product, ["product_id", "seller_id"]).withColumn("source", F.lit("product"))
    gaps = pairs.join(per_product.select("product_id").distinct(), "product_id", "left_anti")
    borrowed = gaps.join(per_seller, "seller_id").withColumn("source", F.lit("seller"))
    return own.unionByName(borrowed)


# --- reviews ------------------------------------------------------------------------------

def filter_reviews(reviews: DataFrame, organization_id: str | None = None, product_id: str | None = None,
                   sentiment: str | None = None, search: str | None = None, aspect: str | None = None) -> DataFrame:
    """Optional filters of the review explorer (P9-P11, D8); all are row-local and reach the scan."""
    if organization_id:
        reviews = reviews.filter(F.col("organization_id") == organization_id)
    if product_id:
        reviews = reviews.filter(F.col("product_id") == product_id)
    if sentiment and sentiment != "All":
        reviews = reviews.filter(rules.same_word("sentiment", sentiment))
    if search:
        reviews = reviews.filter(rules.matches_any(["content", "title"], search))
    if aspect and aspect != "All":
        reviews = reviews.filter(aspects.mentions_aspect("content", aspect))
    return reviews


def with_names(reviews: DataFrame, products: DataFrame, organizations: DataFrame) -> DataFrame:
    """Product and seller names of reviews (J8, J11). Every review has both by foreign key."""
    prods = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                            F.col("sku").alias("product_sku"))
    orgs = organizations.select(F.col("id").alias("organization_id"), F.col("name").alias("seller_name"))
    return reviews.join(prods, "product_id").join(orgs, "organization_id")


def review_page(reviews: DataFrame, products: DataFrame, organizations: DataFrame, sort_by: str = "default",
                number: int = 1, size: int = 20) -> DataFrame:
    """One page of the explorer with names and defaults.

    The page is cut first and named afterwards: the joins carry ``size`` rows.
    """
    cut = ranking.page(reviews, ranking.review_order(sort_by), number, size)
    named = with_names(cut, products, organizations)
    return named.select(
        "id", "product_id", "product_name", "product_sku", "seller_name", "organization_id",
        F.coalesce("title", F.lit("")).alias("title"), F.col("content").alias("review"), "rating",
        F.coalesce("sentiment", F.lit("POSITIVE")).alias("sentiment"),
        F.coalesce(F.nullif("sentiment_score", F.lit(0.0)), F.lit(0.95)).alias("sentiment_score"),
        "review_date",
    )


def recent_reviews(reviews: DataFrame, products: DataFrame, key: str = "organization_id", k: int = 5) -> DataFrame:
    """Newest ``k`` reviews of every key with product names."""
    newest = ranking.top_per_group(
        reviews.select("id", "organization_id", "product_id", "rating", "sentiment", "review_date"),
        [key], [F.desc("review_date"), F.col("id")], k,
    )
    prods = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    return newest.join(prods, "product_id")


# --- issues -------------------------------------------------------------------------------

def issue_rollup(results: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Issue results of many analyses added up, with the most urgent priority.

    Means run on decimals, so they do not depend on the order in which tasks finish.
    """
    def mean(name: str, digits: int) -> Column:
        return F.round(F.avg(F.col(name).cast("decimal(20,10)")), digits).cast("double").alias(name)

    return results.groupBy(*keys, "phrase", "aspect").agg(
        F.sum("frequency").alias("frequency"), mean("percentage", 2),
        F.max(rules.priority_rank("priority")).alias("_rank"), mean("negative_pct", 1),
    ).withColumn("priority", rules.priority_name("_rank")).drop("_rank")


def top_issues(rollup: DataFrame, keys: tuple[str, ...] = (), k: int = 15) -> DataFrame:
    """Most frequent issues overall or per key."""
    order = [F.desc("frequency"), F.col("phrase"), F.col("aspect")]
    if keys:
        return ranking.top_per_group(rollup, list(keys), order, k)
    return rollup.orderBy(*order).limit(k)


def seller_comparison(overview: DataFrame, aspects: DataFrame, issues: DataFrame) -> DataFrame:
    """Seller KPIs side by side with each seller's top aspect and issue."""
    top_aspect = aspects.groupBy("seller_id").agg(
        F.min_by("aspect", F.struct(-F.col("mentions"), F.col("aspect"))).alias("_aspect"))
    top_issue = issues.groupBy("seller_id").agg(
        F.min_by("phrase", F.struct(-F.col("frequency"), F.col("phrase"), F.col("aspect"))).alias("_issue"))
    return (
        overview.join(top_aspect, "seller_id", "left").join(top_issue, "seller_id", "left")
        .select(*overview.columns, F.coalesce("_aspect", F.lit("N/A")).alias("top_aspect"),
                F.coalesce("_issue", F.lit("None")).alias("top_issue"))
    )


# --- imports --------------------------------------------------------------------------------

def import_summary(imported: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Imported reviews by class and the health they give."""
    sums = imported.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("sentiment") == "POSITIVE").alias("positive_count"),
        F.count_if(F.col("sentiment") == "NEGATIVE").alias("negative_count"),
    )
    share = tx.percent(F.col("positive_count"), F.col("total"), 1)
    return sums.withColumn("health_score", F.round(share, 0).cast("bigint"))


# --- corpus dashboard -------------------------------------------------------------------------

def dashboard(reviews: DataFrame, aspect_stats: DataFrame) -> DataFrame:
    """Review totals and health: from aspects, or from the class share where none is mentioned."""
    totals = reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col("sentiment") == "POSITIVE").alias("positive_count"),
        F.count_if(F.col("sentiment") == "NEGATIVE").alias("negative_count"),
    )
    health = aspects.health_from_aspects(aspect_stats)
    classed = F.col("positive_count") + F.col("negative_count")
    out = totals.withColumns({
        "positive_percent": tx.percent(F.col("positive_count"), classed, 1),
        "negative_percent": tx.percent(F.col("negative_count"), classed, 1),
        "total_aspect_mentions": F.coalesce(health.select("total_aspect_mentions").scalar(), F.lit(0)),
    })
    score = F.coalesce(health.select("score").scalar(), F.round("positive_percent", 0).cast("bigint"))
    return out.withColumn("score", score).withColumn("status", rules.health_band(F.col("score")))


# --- people, log and data sets ----------------------------------------------------------------

def audit_view(audit: DataFrame, profiles: DataFrame, organizations: DataFrame, limit: int | None = 50) -> DataFrame:
    """Newest audit entries with user and organization names."""
    if limit is not None:
        audit = audit.orderBy(F.desc("created_at"), "id").limit(limit)
    users = profiles.select(F.col("id").alias("user_id"), F.col("full_name").alias("user_name"),
                            F.col("email").alias("user_email"))
    orgs = organizations.select(F.col("id").alias("organization_id"), F.col("name").alias("org_name"))
    return audit.join(users, "user_id", "left").join(orgs, "organization_id", "left").select(
        "id", "organization_id", "org_name", "user_id", "user_name", "user_email", "action", "resource_type",
        "details", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


def team_view(members: DataFrame, profiles: DataFrame, joined: str | None = None) -> DataFrame:
    """Members with names and roles (J13), with the day they joined and in its order where ``joined`` names it; callers scope it."""
    people = profiles.select(F.col("id").alias("user_id"), "full_name", "email")
    named = members.join(people, "user_id").select("organization_id", "user_id", "full_name", "email", "role", *([joined] if joined else []))
    return named.orderBy(joined, "user_id") if joined else named


def dataset_view(datasets: DataFrame, organizations: DataFrame) -> DataFrame:
    """Data sets with their seller's name."""
    orgs = organizations.select(F.col("id").alias("organization_id"), F.col("name").alias("seller_name"))
    return datasets.join(orgs, "organization_id")


def expiry(created_at: Column | str, days: int = 7) -> Column:
    """Moment an invitation lapses."""
    return tx.as_column(created_at) + F.make_dt_interval(F.lit(days))


def open_invitations(invitations: DataFrame, limit: int | None = None) -> DataFrame:
    """Invitations, newest first."""
    ordered = invitations.orderBy(F.desc("created_at"), "id")
    return ordered.limit(limit) if limit else ordered


def unique_slugs(df: DataFrame, name: str, order: str) -> DataFrame:
    """Slug per row; the first holder of a slug keeps it, later ones get a number (P25).

    A numbered slug that is the plain slug of another name gets a digest of the order key as well, so all slugs differ.
    Rows are numbered per slug by running totals, so a name held by a third of all rows is numbered in many tasks.
    """
    base, number, slug, taken = free_names(df.columns, "base", "number", "slug_text", "taken")
    counted = running.numbered(df.withColumn(base, tx.slug(name)), [F.col(order)], number, per=[base])
    place = F.col(number) + 1
    named = counted.withColumn(slug, F.when(place == 1, F.col(base)).otherwise(F.concat_ws("-", base, place.cast("string"))))
    plain = counted.filter(F.col(number) == 0).select(F.col(base).alias(slug), F.lit(True).alias(taken))
    digest = F.substring(F.sha2(F.col(order).cast("string"), 256), 1, 12)
    clash = F.coalesce(F.col(taken), F.lit(False)) & (F.col(slug) != F.col(base))
    return named.join(plain, slug, "left").select(
        *df.columns, F.when(clash, F.concat_ws("-", slug, digest)).otherwise(F.col(slug)).alias("slug"))
