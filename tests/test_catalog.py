"""Every registered query with a SQL text equals DuckDB; plans keep their shape."""

import re

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from reviewmill.catalog.views import Views

SF = "/root/testdata/sf0.001"


def names(module):
    from importlib import import_module

    return list(import_module(f"reviewmill.catalog.{module}").ORACLES)


# Dozens of fits each; tests/compare.py and tests/test_models.py cover them.
SLOW = {"model_tuned_lr", "model_tuned_svc", "model_grid", "model_sweep_features", "model_sweep_cleaning"}
#: Modules whose queries are one plan; the others write tables or fit models while they are built.
PLANNED = [n for m in ("corpus", "mining", "tenancy", "kpi", "evaluation") for n in names(m)]
ALL = PLANNED + [n for m in ("io", "modelling", "streams") for n in names(m) if n not in SLOW]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def registry():
    import __spark_entry__ as entry

    return entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", ALL)
def test_query_equals_duckdb(spark, con, registry, name):
    queries, oracles = registry
    problem, _ = compare(queries[name](spark, SF), con, oracles[name])
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query(registry):
    queries, oracles = registry
    assert oracles.keys() <= queries.keys()


def plan(spark, registry, name):
    df = registry[0][name](spark, SF)
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join(spark, registry, name):
    text = plan(spark, registry, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_group_limits_run_before_the_shuffle(spark, registry):
    for name in ("reviews_recent_seller", "reviews_recent_product", "issue_results", "complaint_by_aspect"):
        assert plan(spark, registry, name).count("WindowGroupLimit") >= 2, name


def test_pages_are_top_k_not_sorts(spark, registry):
    for name in ("reviews_sorted_default", "reviews_page", "corpus_top_words", "complaint_top", "eval_error_sample"):
        assert "TakeOrderedAndProject" in plan(spark, registry, name), name


def test_scans_read_only_needed_columns(spark, registry):
    text = plan(spark, registry, "tenant_seller_kpis")
    found = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_partkey" in s]
    assert found and all(set(re.findall(r"(\w+):", s)) == {"l_partkey", "l_returnflag"} for s in found)


def test_filters_reach_the_scan(spark, views):
    from pyspark.sql import functions as F

    text = views.table("lineitem").filter(F.col("l_returnflag") == "R").select("l_partkey")._jdf.queryExecution().toString()
    assert "EqualTo(l_returnflag,R)" in text
    from reviewmill.operators import kpis

    rows = kpis.filter_reviews(views.reviews, sentiment="negative", product_id="P1")
    assert "DataFilters: [" in rows._jdf.queryExecution().toString()


def test_texts_of_one_row_group_are_dealt_out(spark, tmp_path):
    """A table of one row group is read by one task; its texts are worked on by as many as there are cores."""
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_shipdate date"
    lines = spark.range(400).selectExpr("id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "5.0D AS l_quantity",
                                        "0.1D AS l_discount", "'R' AS l_returnflag", "DATE'2020-01-01' AS l_shipdate")
    lines.select([c.split()[0] for c in columns.split(", ")]).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(3).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    found = Views(spark, str(tmp_path))
    busy = found.dealt_reviews.select(F.spark_partition_id().alias("p")).distinct().count()
    assert busy > 1 and found.dealt_reviews.exceptAll(found.reviews).count() == 0 == found.reviews.exceptAll(found.dealt_reviews).count()
