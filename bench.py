"""Times headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Results go to Spark's no-op sink, so every column of every row is computed and
nothing is collected. The given tables are one row group each, so they are dealt out over the cores first. Fitting the review model and scoring all reviews with it are timed apart. Stored
intermediate tables go to $BENCH_SHARED, a folder that all executors share, or below the warehouse of the local session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewmill import catalog  # noqa: E402
from reviewmill.session import build_session  # noqa: E402

HEADLINE = [
    "tenant_seller_kpis", "tenant_compare", "product_list", "reviews_page", "reviews_recent_seller",
    "access_rows", "write_gate", "corpus_clean_c", "corpus_dedupe", "corpus_top_words", "ngram_bigrams",
    "complaint_top", "complaint_match_phrases", "aspect_stats", "tfidf_sql", "eval_roc", "upsert_table",
    "model_nb", "model_lr", "lda_topics", "fit_review_model", "score_reviews", "stream_kpis",
]


def timed_parts(spark, sf_dir: str, partitions: int) -> dict:
    """Queries of the catalog, and the two halves of the scoring job."""
    from reviewmill.catalog.modelling import review_model
    from reviewmill.catalog.views import Views
    from reviewmill.operators import scoring

    views, fitted = Views(spark, sf_dir, partitions), []

    def fit(*_):
        fitted.append(review_model(views))
        return spark.range(1)

    def score(*_):
        return scoring.predict(views.reviews, fitted[0] if fitted else review_model(views), "content", ["id"])

    return catalog.all_queries(partitions) | {"fit_review_model": fit, "score_reviews": score}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    shared = {"spark__checkpoint__dir": os.environ["BENCH_SHARED"]} if os.environ.get("BENCH_SHARED") else {}
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", **shared)
    spark.sparkContext.setLogLevel("ERROR")
    queries = timed_parts(spark, sf_dir, int(cpus))
    # One untimed query, so the first timed one does not pay for starting Spark.
    queries["corpus_class_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in names:
        started = time.time()
        try:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - started, 3)
        except Exception as error:  # noqa: BLE001 - one failure must not hide the other times
            failed[name] = str(error)[:300]
    line = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
            "sf": os.path.basename(sf_dir.rstrip("/"))}
    if failed:
        line["failed"] = failed
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
