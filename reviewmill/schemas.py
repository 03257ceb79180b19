"""Explicit schemas. Columns are always read by name, never by position."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


STR, INT, LONG, DBL, TS, BOOL = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.BooleanType(),
)

LABELLED_CORPUS = _struct(("label", DBL), ("title", STR), ("review", STR))

ASPECT_LIST = T.ArrayType(
    T.StructType([T.StructField("aspect", STR, False), T.StructField("context", STR, False)])
)

PROFILES = _struct(
    ("id", STR), ("auth_user_id", STR), ("full_name", STR), ("email", STR), ("avatar_url", STR),
    ("created_at", TS), ("updated_at", TS),
)
ORGANIZATIONS = _struct(
    ("id", STR), ("name", STR), ("organization_type", STR), ("slug", STR), ("logo_url", STR),
    ("created_at", TS), ("updated_at", TS),
)
ORGANIZATION_MEMBERS = _struct(
    ("id", STR), ("organization_id", STR), ("user_id", STR), ("role", STR), ("created_at", TS),
)
PLATFORM_SELLERS = _struct(
    ("id", STR), ("platform_organization_id", STR), ("seller_organization_id", STR), ("status", STR),
    ("created_at", TS),
)
INVITATIONS = _struct(
    ("id", STR), ("organization_id", STR), ("email", STR), ("role", STR), ("token", STR), ("status", STR),
    ("invited_by", STR), ("expires_at", TS), ("created_at", TS),
)
PRODUCTS = _struct(
    ("id", STR), ("organization_id", STR), ("name", STR), ("sku", STR), ("category", STR),
    ("description", STR), ("created_at", TS), ("updated_at", TS),
)
DATASETS = _struct(
    ("id", STR), ("organization_id", STR), ("name", STR), ("file_name", STR), ("storage_path", STR),
    ("row_count", INT), ("status", STR), ("created_at", TS),
)
REVIEWS = _struct(
    ("id", STR), ("organization_id", STR), ("product_id", STR), ("dataset_id", STR), ("title", STR),
    ("content", STR), ("rating", INT), ("sentiment", STR), ("sentiment_score", DBL),
    ("review_date", TS), ("created_at", TS),
)
ANALYSES = _struct(
    ("id", STR), ("organization_id", STR), ("product_id", STR), ("dataset_id", STR), ("status", STR),
    ("total_reviews", INT), ("positive_reviews", INT), ("negative_reviews", INT), ("health_score", INT),
    ("accuracy", DBL), ("f1_score", DBL), ("roc_auc", DBL), ("model_name", STR),
    ("created_at", TS), ("completed_at", TS),
)
ASPECT_RESULTS = _struct(
    ("id", STR), ("analysis_id", STR), ("organization_id", STR), ("product_id", STR), ("aspect", STR),
    ("mentions", INT), ("positive_count", INT), ("negative_count", INT),
    ("positive_pct", DBL), ("negative_pct", DBL), ("created_at", TS),
)
ISSUE_RESULTS = _struct(
    ("id", STR), ("analysis_id", STR), ("organization_id", STR), ("product_id", STR), ("phrase", STR),
    ("aspect", STR), ("frequency", INT), ("percentage", DBL), ("priority", STR), ("negative_pct", DBL),
    ("created_at", TS),
)
USER_PREFERENCES = _struct(
    ("id", STR), ("user_id", STR), ("theme", STR), ("notifications", BOOL), ("default_aspect", STR),
    ("created_at", TS), ("updated_at", TS),
)
AUDIT_LOGS = _struct(
    ("id", STR), ("organization_id", STR), ("user_id", STR), ("action", STR), ("resource_type", STR),
    ("resource_id", STR), ("details", STR), ("ip_address", STR), ("created_at", TS),
)

IMPORT_RECORD = _struct(
    ("title", STR), ("content", STR), ("review", STR), ("text", STR), ("rating", INT),
)

TABLES = {
    "profiles": PROFILES,
    "organizations": ORGANIZATIONS,
    "organization_members": ORGANIZATION_MEMBERS,
    "platform_sellers": PLATFORM_SELLERS,
    "organization_invitations": INVITATIONS,
    "products": PRODUCTS,
    "datasets": DATASETS,
    "reviews": REVIEWS,
    "analyses": ANALYSES,
    "aspect_results": ASPECT_RESULTS,
    "issue_results": ISSUE_RESULTS,
    "user_preferences": USER_PREFERENCES,
    "audit_logs": AUDIT_LOGS,
}

# Enumerations the relational schema checks.
ENUMS = {
    ("organizations", "organization_type"): ("platform", "seller"),
    ("organization_members", "role"): ("owner", "admin", "analyst", "viewer"),
    ("platform_sellers", "status"): ("active", "suspended", "pending"),
    ("organization_invitations", "status"): ("pending", "accepted", "expired", "revoked"),
    ("datasets", "status"): ("uploading", "ready", "analyzing", "error"),
    ("analyses", "status"): ("queued", "running", "completed", "failed"),
    ("reviews", "sentiment"): ("POSITIVE", "NEGATIVE", "NEUTRAL"),
    ("issue_results", "priority"): ("HIGH", "MEDIUM", "LOW"),
}
